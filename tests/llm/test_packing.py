import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from dimweave.llm import packing
from dimweave.llm.queries import QUERIES

from .conftest import ODD_TEXTS, SF


@pytest.fixture(scope="module")
def library(word_bpe):
    return Tokenizer.from_file(word_bpe)


def expected(library, text, end_id):
    return [*library.encode(text or "", add_special_tokens=False).ids, end_id]


def check_layout(pieces, window):
    """Sequences are gapless, all but the last full; documents are whole."""
    sequences, documents = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert 0 < p.length <= window
        sequences[p.sequence_id].append((p.offset, p.length))
        documents[p.doc_id].append((p.start, p.length, p.doc_tokens))
    assert sorted(sequences) == list(range(len(sequences)))
    for s, own in sequences.items():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == window or s == len(sequences) - 1
    for own in documents.values():
        at = 0
        for start, length, total in sorted(own):
            assert start == at
            at += length
        assert at == own[0][2]


def test_query_equals_the_library(spark, documents, library):
    pieces = QUERIES["op12_concat_cut"](spark, SF).collect()
    check_layout(pieces, 2048)
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert {p.doc_id for p in pieces} == texts.keys()
    ids = {i: expected(library, t, 1) for i, t in texts.items()}
    for p in pieces:
        own = ids[p.doc_id]
        assert p.doc_tokens == len(own)
        cut = own[p.start : p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(struct.pack(f"<{len(cut)}I", *cut))


def test_odd_texts_in_small_windows(odd, nothing, repeated, library, word_bpe):
    pieces = packing.pack_documents(odd.repartition(3), word_bpe, end_id=7, window=5).collect()
    check_layout(pieces, 5)
    got = defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        got[p.doc_id] += struct.unpack(f"<{p.length}I", p.ids)
    assert got == {i: expected(library, t, 7) for i, t in enumerate(ODD_TEXTS)}
    assert packing.pack_documents(nothing, word_bpe, end_id=7).count() == 0
    rows = packing.pack_documents(repeated, word_bpe, end_id=7, window=4).collect()
    assert sum(p.length for p in rows) == sum(len(expected(library, r.text, 7)) for r in repeated.collect())
    assert sum(p.doc_id is None for p in rows) >= 2


def test_pieces_at_exact_boundaries():
    owner, start, length, sequence, offset = packing.pieces_of(np.array([0, 4, 8, 9]), np.array([4, 4, 1, 8]), 4)
    assert list(zip(owner.tolist(), start.tolist(), length.tolist(), sequence.tolist(), offset.tolist(), strict=True)) == [
        (0, 0, 4, 0, 0),
        (1, 0, 4, 1, 0),
        (2, 0, 1, 2, 0),
        (3, 0, 3, 2, 1),
        (3, 3, 4, 3, 0),
        (3, 7, 1, 4, 0),
    ]
