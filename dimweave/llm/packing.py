"""Packing by concatenating and cutting.

All documents' ids, an end id after each, are one long sequence that is cut
into windows of a fixed length.  The first pass encodes the documents in place
and writes their ids with the number of ids before them in their partition;
the prefix sums of the partitions' totals (one row per task) then give every
document its global offset, without a shuffle of ids.  The second pass cuts
each document at the window boundaries: one boundary record per piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimweave.llm.common import small_batches, worker_model, written
from dimweave.llm.word_ids import WordIds

PIECE_COLUMNS = ["start", "length", "doc_tokens", "sequence_id", "offset"]


def _encoder(spec: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_model(("ids", spec), lambda: WordIds(spec))
        part, before = TaskContext.get().partitionId(), 0
        for batch in small_batches(batches, "text", 4 << 20):
            n = batch.num_rows
            ids, begins = encoder.encode(batch.column("text").to_pylist())
            flat = np.insert(ids, begins[1:], end_id).astype("<i4")
            ends = begins + np.arange(n + 1)
            rows = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(4 * ends.astype(np.int64)), pa.py_buffer(flat)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(n, part)), pa.array(before + ends[:-1]), rows.cast(pa.binary())],
                ["doc_id", "part", "before", "ids"],
            )
            before += int(ends[-1])

    return run


def pieces_of(begin: np.ndarray, size: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Of stretches of ``size`` ids at global positions ``begin``: the stretch
    each piece belongs to, its start in it, length, window and place there."""
    first, last = begin // window, (begin + size - 1) // window
    count = last - first + 1
    owner = np.repeat(np.arange(len(begin)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    sequence = first[owner] + nth
    low = np.maximum(begin[owner], sequence * window)
    high = np.minimum((begin + size)[owner], (sequence + 1) * window)
    return owner, low - begin[owner], high - low, sequence, low - sequence * window


def _cutter(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "ids", 8 << 20):
            raw = batch.column("ids").to_pylist()
            size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) // 4
            begin = batch.column("begin").to_numpy()
            owner, start, length, sequence, offset = pieces_of(begin, size, window)
            ids = [raw[o][4 * s : 4 * (s + n)] for o, s, n in zip(owner.tolist(), start.tolist(), length.tolist(), strict=True)]
            numbers = [pa.array(a, pa.int64()) for a in (start, length, size[owner], sequence, offset)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(owner)), *numbers, pa.array(ids, pa.binary())], ["doc_id", *PIECE_COLUMNS, "ids"])

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, window: int = 2048) -> DataFrame:
    """Pieces of the documents' ids in sequences of ``window`` ids: doc_id,
    start (its document's ids before it), length, doc_tokens (with the end
    id), sequence_id, offset (in the sequence), ids (little-endian unsigned 32
    bit).

    Every sequence but the last is full, so only that one needs padding; a
    document lies in as few pieces as the windows allow, and all its ids in
    order.  Documents follow each other as the table is read, which the
    contents of the table and its splits fix; nothing is sorted.

    Null and empty texts are the end id alone.  Null and repeated ids pass
    through, every row is a document of its own; other columns are ignored,
    whatever their names; an empty table gives no pieces.  Texts are encoded
    whole: a task holds 4 MB of text (or one longer text) and a bounded cache.
    A lost task is run again; offsets come from what was committed.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    kind = docs.schema["doc_id"].dataType.simpleString()
    encoded = docs.select("doc_id", "text").mapInArrow(_encoder(spec, end_id), f"doc_id {kind}, part long, before long, ids binary")
    rows = written(encoded, "packed-ids")
    totals = rows.groupBy("part").agg(F.max(F.col("before") + F.expr("octet_length(ids) div 4")).alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))  # one row per task
    placed = rows.join(F.broadcast(offsets), "part").select("doc_id", (F.col("base") + F.col("before")).alias("begin"), "ids")
    names = ", ".join(f"{c} long" for c in PIECE_COLUMNS)
    return placed.mapInArrow(_cutter(window), f"doc_id {kind}, {names}, ids binary")


def piece_checksums(pieces: DataFrame) -> DataFrame:
    """ids replaced by their unsigned crc32."""
    return pieces.select("doc_id", *PIECE_COLUMNS, F.crc32("ids").alias("ids_crc32"))
