import struct
import zlib

import pytest
from tokenizers import Tokenizer

from dimweave.llm import id_frames
from dimweave.llm.id_frames import open_for_reading, read_directory, read_frames, read_token_ids, write_token_ids
from dimweave.llm.queries import QUERIES

from .conftest import ODD_TEXTS, SF


@pytest.fixture(scope="module")
def library(word_bpe):
    return Tokenizer.from_file(word_bpe)


def ids_of(library, text):
    ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
    return struct.pack(f"<{len(ids)}I", *ids)


def test_query_equals_the_library(spark, documents, library):
    got = {r.doc_id: r for r in QUERIES["op8_id_frames"](spark, SF).collect()}
    start = 0
    for r in sorted(documents.collect(), key=lambda r: r.doc_id):
        ids = ids_of(library, r.text)
        x = got.pop(r.doc_id)
        assert (x.start, x.n_tokens, x.ids_crc32) == (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
    assert not got


def test_odd_texts_and_wanted_documents(odd, library, word_bpe):
    manifest = write_token_ids(odd, word_bpe, end_id=2)
    rows = read_token_ids(manifest).orderBy("start").collect()
    assert [r.doc_id for r in rows] == list(range(len(ODD_TEXTS)))
    assert [bytes(r.ids) for r in rows] == [ids_of(library, t) for t in ODD_TEXTS]
    some = {r.doc_id: (r.start, bytes(r.ids)) for r in read_token_ids(manifest, wanted=[3, 7]).collect()}
    assert some == {k: (rows[k].start, bytes(rows[k].ids)) for k in (3, 7)}


def test_repeated_ids_and_empty_tables(repeated, nothing, library, word_bpe):
    rows = read_token_ids(write_token_ids(repeated, word_bpe, end_id=2)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, None, 1, 3, 3, 3]
    starts = [0]
    for r in rows:
        starts.append(starts[-1] + r.n_tokens)
    assert [r.start for r in rows] == starts[:-1]
    assert read_token_ids(write_token_ids(nothing, word_bpe, end_id=2)).count() == 0


def test_a_damaged_frame_is_noticed(spark, tmp_dir):
    path = f"{tmp_dir}/x.zst"
    file = id_frames.FrameFile(open(path, "wb"))
    import pyarrow as pa

    for k in range(5):
        file.add(k, struct.pack("<3I", k, k, 2))
    file.close(pa.int64())
    with open_for_reading(path) as f:
        assert read_directory(f)[0] == list(range(5))
        assert [(d, at) for d, at, _ in read_frames(f)] == [(k, 3 * k) for k in range(5)]
    # the seek table is that of the public seekable format: a plain decoder reads the frames
    import zstandard

    raw = open(path, "rb").read()
    reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
    assert reader.read(12 * 5) == b"".join(struct.pack("<3I", k, k, 2) for k in range(5))
    # another checksum for the first document
    at = raw.index(struct.pack("<I", 0x184D2A5E)) + 8 + 8
    open(path, "wb").write(raw[:at] + b"\0\0\0\0" + raw[at + 4 :])
    with open_for_reading(path) as f, pytest.raises(ValueError, match="checksum"):
        list(read_frames(f))
