"""Token ids in seekable zstandard files.

File format (one file per writing task and roll):

* one independent zstandard frame per document: its ids as little-endian
  unsigned 32-bit integers;
* a skippable frame (magic 0x184D2A50) with the document directory: an Arrow
  IPC stream of the column ``doc_id``, one row per document frame;
* the trailing seek table of the public zstandard seekable format: a skippable
  frame (magic 0x184D2A5E) with compressed size, decompressed size and
  checksum (low 32 bits of the content's xxHash64) of every frame before it,
  then the frame count, a descriptor byte and the magic 0x8F92EAB1.

A reader takes the last bytes of a file, the directory, and then only the
frames of the documents it wants; each frame is checked against its checksum.

Files lie in ascending doc_id order: a manifest (a small table, one row per
file) holds their order and id counts, from which a document's start (ids of
all documents before it) follows.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from dimweave.llm.common import shared_path, small_batches, worker_model, written
from dimweave.llm.word_ids import WordIds

# Fixed values of the seekable format.
DIRECTORY_MAGIC = 0x184D2A50
SEEK_TABLE_MAGIC = 0x184D2A5E
SEEK_FOOTER_MAGIC = 0x8F92EAB1
_FOOTER = struct.Struct("<IBI")
_ENTRY = struct.Struct("<III")

#: A writing task starts another file beyond this many bytes.
FILE_BYTES = 256 << 20


class FrameFile:
    """Writes one file: documents one by one, then directory and seek table."""

    def __init__(self, out, level: int = 3):
        self.out, self.compressor = out, zstandard.ZstdCompressor(level=level)
        self.entries: list[tuple[int, int, int]] = []
        self.doc_ids: list = []
        self.bytes = self.ids = 0

    def _skippable(self, magic: int, content: bytes) -> bytes:
        return struct.pack("<II", magic, len(content)) + content

    def add(self, doc_id, ids: bytes) -> None:
        frame = self.compressor.compress(ids)
        self.out.write(frame)
        self.entries.append((len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.doc_ids.append(doc_id)
        self.bytes += len(frame)
        self.ids += len(ids) // 4

    def close(self, id_type: pa.DataType) -> None:
        sink = io.BytesIO()
        batch = pa.record_batch([pa.array(self.doc_ids, id_type)], ["doc_id"])
        with pa.ipc.new_stream(sink, batch.schema) as stream:
            stream.write_batch(batch)
        directory = self._skippable(DIRECTORY_MAGIC, sink.getvalue())
        self.out.write(directory)
        entries = [*self.entries, (len(directory), 0, 0)]
        table = b"".join(_ENTRY.pack(*e) for e in entries) + _FOOTER.pack(len(entries), 0x80, SEEK_FOOTER_MAGIC)
        self.out.write(self._skippable(SEEK_TABLE_MAGIC, table))
        self.out.close()


def read_directory(file) -> tuple[list, list[tuple[int, int, int]]]:
    """doc_ids and seek-table entries (frames of documents only) of a file
    opened for random access."""
    size = file.size()
    file.seek(size - _FOOTER.size)
    n, descriptor, magic = _FOOTER.unpack(file.read(_FOOTER.size))
    if magic != SEEK_FOOTER_MAGIC or not descriptor & 0x80:
        raise ValueError("not a seekable zstandard file with checksums")
    file.seek(size - _FOOTER.size - n * _ENTRY.size)
    entries = list(_ENTRY.iter_unpack(file.read(n * _ENTRY.size)))
    file.seek(sum(e[0] for e in entries[:-1]) + 8)
    with pa.ipc.open_stream(file.read(entries[-1][0] - 8)) as stream:
        doc_ids = stream.read_all().column(0).to_pylist()
    return doc_ids, entries[:-1]


def read_frames(file, wanted: set | None = None) -> Iterator[tuple[object, int, bytes]]:
    """(doc_id, ids before it in the file, ids as bytes) of the wanted
    documents (None: all); other frames are skipped by seeking."""
    doc_ids, entries = read_directory(file)
    decompressor, at, before = zstandard.ZstdDecompressor(), 0, 0
    for doc_id, (compressed, size, checksum) in zip(doc_ids, entries, strict=True):
        if wanted is None or doc_id in wanted:
            file.seek(at)
            ids = decompressor.decompress(file.read(compressed), max_output_size=size)
            if len(ids) != size or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != checksum:
                raise ValueError(f"checksum of the frame of document {doc_id} differs")
            yield doc_id, before, ids
        at += compressed
        before += size // 4


def open_for_reading(path: str):
    system, where = fs.FileSystem.from_uri(path)
    return system.open_input_file(where)


def _writer(spec: str, end_id: int, folder: str):
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_model(("ids", spec), lambda: WordIds(spec))
        task = TaskContext.get().partitionId()
        system, where = fs.FileSystem.from_uri(folder)
        system.create_dir(where, recursive=True)
        rows, file, id_type = [], None, None

        def finish() -> None:
            file.close(id_type)
            rows.append({"task": task, "roll": len(rows), "path": f"{folder}/{name}", "n_docs": len(file.doc_ids), "n_ids": file.ids})

        for batch in small_batches(batches, "text", 4 << 20):
            id_type = batch.column("doc_id").type
            ids, begins = encoder.encode(batch.column("text").to_pylist())
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                if file is None:
                    # a name of its own for every attempt: the manifest names
                    # the files of the attempts that were committed
                    name = f"ids-{task:06d}-{len(rows):04d}-{uuid.uuid4().hex}.zst"
                    file = FrameFile(system.open_output_stream(f"{where}/{name}", compression=None))
                file.add(doc_id, ids[begins[i] : begins[i + 1]].tobytes() + end)
                if file.bytes >= FILE_BYTES:
                    finish()
                    file = None
        if file is not None:
            finish()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("task", pa.int64()), ("roll", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    return run


def write_token_ids(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Encode every text, append ``end_id`` and write the ids in ascending
    doc_id order below ``folder`` (default: a fresh one in the shared
    checkpoint folder).  Returns the manifest: path, n_docs, n_ids, start (ids
    of all files before it), one row per file.

    Null text is empty (only the end id).  Null ids come first; rows with the
    same id follow each other in an order that their texts fix (a hash, then
    the text), also over several tasks.  An empty table gives an empty
    manifest.  A lost task is run again under new file names, and the manifest
    holds only committed files.  The rows are shuffled once, by ranges of
    doc_id and that hash; each task holds one small batch of texts.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    folder = folder or shared_path(spark, "token-ids")
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    ordered = hashed.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text")
    files = ordered.select("doc_id", "text").mapInArrow(_writer(spec, end_id, folder), "task long, roll long, path string, n_docs long, n_ids long")
    files = written(files, "token-id-files")  # runs the writing once; one row per file
    before = Window.orderBy("task", "roll").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("path", "n_docs", "n_ids", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))


def read_token_ids(manifest: DataFrame, id_type: str = "bigint", wanted: Iterable | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids (bytes, little-endian unsigned 32 bit) of
    the wanted documents (a bounded list given by the caller; None: all), one
    task per file."""
    keep = None if wanted is None else set(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_for_reading(row["path"]) as file:
                    out, size, arrow_type = [], 0, None
                    for doc_id, before, ids in read_frames(file, keep):
                        out.append((doc_id, row["start"] + before, len(ids) // 4, ids))
                        size += len(ids)
                        if size >= 4 << 20:
                            yield _batch(out)
                            out, size = [], 0
                    if out:
                        yield _batch(out)

    id_arrow = to_arrow_type(DataType.fromDDL(id_type))

    def _batch(rows: list) -> pa.RecordBatch:
        kinds = (id_arrow, pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "start", "n_tokens", "ids"])

    # an explicit number, so that tiny manifest rows aren't coalesced into one task
    n_files = max(1, manifest.count())
    spread = manifest.select("path", "start").repartition(n_files)
    return spread.mapInArrow(run, f"doc_id {id_type}, start long, n_tokens long, ids binary")


def id_checksums(ids: DataFrame) -> DataFrame:
    """ids replaced by their unsigned crc32."""
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
