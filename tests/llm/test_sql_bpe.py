import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from dimweave.llm import sql_bpe
from dimweave.llm.queries import QUERIES
from dimweave.llm.word_ids import WordTable

from .conftest import ODD_TEXTS, SF

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = sql_bpe.parse_ranks(open(PATH, "rb").read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def digests(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_query_equals_the_library(spark, documents, library):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op10_sql_bpe"](spark, SF).collect()}
    assert got == {r.doc_id: digests(library, r.text) for r in documents.collect()}


def test_odd_texts(odd, nothing, repeated, library):
    rows = sql_bpe.bpe_round_trip(odd, PATH, public_tokenizers.PATTERN).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == {i: digests(library, t) for i, t in enumerate(ODD_TEXTS)}
    assert sql_bpe.bpe_round_trip(nothing, PATH, public_tokenizers.PATTERN).count() == 0
    assert sql_bpe.bpe_round_trip(repeated, PATH, public_tokenizers.PATTERN).count() == repeated.count()


@pytest.fixture(scope="module")
def model():
    return sql_bpe.SqlBpe(sql_bpe.parse_ranks(open(PATH, "rb").read()), sql_bpe.character_kinds())


def equal(model, library, texts):
    ids, begins = model.encode(texts)
    for i, t in enumerate(texts):
        assert ids[begins[i] : begins[i + 1]].tolist() == library.encode_ordinary(t or ""), t
    assert model.decode(ids, begins) == [(t or "").encode() for t in texts]


def test_bounded_queries_reach_the_same_fixpoint(model, library, monkeypatch):
    """Few rows a query: many rounds; the long-segment query on short words."""
    words = ["internationalization", "etaoinshrdluetaoinshrdlu", "aaaaaaaaaaaaaaaaaaaaaaaa", "éèê", "zzzyzzzy"]
    raw = [w.encode() for w in words]
    want = [library.encode_ordinary(w) for w in words]
    for rows in (sql_bpe.QUERY_ROWS, 1):
        monkeypatch.setattr(sql_bpe, "QUERY_ROWS", rows)
        assert [i.tolist() for i in model.contract(raw, sql_bpe._STEP)] == want
        assert [i.tolist() for i in model.contract(raw, sql_bpe._STEP_LONG)] == want


def test_every_character_has_the_librarys_class(model, library):
    """Every code point, assigned or not, before a contraction and between a
    letter and a digit."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 100_000):
        own = points[at : at + 100_000]
        ids, begins = model.encode(own_texts := [f"{c}'s {c}a{c}1" for c in own[:: 1 if at == 0 else 7]])
        want = library.encode_ordinary_batch(own_texts, num_threads=4)
        assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == want


def test_white_space_and_contractions(model, library):
    rng = random.Random(2)
    alphabet = "abst'' '  \n\t\r,.!12é漢\u3000\xa0\u0301 lrevdm\x85\x1c"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(3000)]
    equal(model, library, [*texts, "", None, " ", "  ", "a  ", "\n\n's", "x's 's ''s", "\U00018e2f's", "a's'tx  "])
    equal(model, library, [])


@pytest.mark.parametrize("alphabet", ["abcdefghijklmnopqrstuvwxyz", "0123456789", "的一是不了人我在有他这中大来上国", "ACGT", "a", "=-", "0"])
def test_long_words(model, library, alphabet, monkeypatch):
    """One pre-token of very many characters: segments that meet anywhere, and
    the query for long segments."""
    rng = random.Random(len(alphabet))
    equal(model, library, ["".join(rng.choices(alphabet, k=n)) for n in (65, 200, 999, 20_000)])
    model.words = WordTable(model.learn)
    monkeypatch.setattr(sql_bpe, "LONG_SEGMENT", 20)
    monkeypatch.setattr(sql_bpe, "SEGMENT", 5)
    equal(model, library, ["".join(rng.choices(alphabet, k=n)) for n in (65, 300)])


def test_decoding_in_several_queries(model, library, monkeypatch):
    monkeypatch.setattr(sql_bpe, "DECODE_IDS", 7)
    equal(model, library, ["one text of some words", None, "é漢 and another one", ""])


def test_other_patterns_are_refused(odd):
    with pytest.raises(ValueError):
        sql_bpe.bpe_round_trip(odd, PATH, r"\S+")


def test_documents_keep_their_columns(odd, library):
    out = sql_bpe.encode_documents(odd, PATH, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "text", "lang", "row", "score", "n_tokens", "token_ids"]
    for r in out.collect():
        assert r.text == ODD_TEXTS[r.doc_id]
        assert list(r.token_ids) == library.encode_ordinary(r.text or "")
        assert r.n_tokens == len(r.token_ids) and r.row == "n"
