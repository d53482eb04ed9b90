import pytest
from tokenizers import Tokenizer

from dimweave.llm.queries import QUERIES
from dimweave.llm.token_counts import CountModel, merged, token_counts

from .conftest import ODD_TEXTS, SF


@pytest.fixture(scope="module")
def library(word_bpe):
    return Tokenizer.from_file(word_bpe)


def n_tokens(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_query_equals_the_library(spark, documents, library):
    got = {r.doc_id: r for r in QUERIES["op2_token_counts"](spark, SF).collect()}
    for r in documents.collect():
        n = n_tokens(library, r.text)
        assert got[r.doc_id].n_tokens == n
        assert got[r.doc_id].n_bytes == len((r.text or "").encode())
        assert got[r.doc_id].over_limit == (n > 2048)
    assert len(got) == documents.count()


def test_odd_texts(odd, library, word_bpe):
    got = {r.doc_id: r.n_tokens for r in token_counts(odd, word_bpe).collect()}
    assert got == {i: n_tokens(library, t) for i, t in enumerate(ODD_TEXTS)}


def test_repeated_ids_and_empty_tables(repeated, nothing, library, word_bpe):
    rows = sorted((r.doc_id or -1, r.n_tokens) for r in token_counts(repeated, word_bpe).collect())
    want = sorted((r.doc_id or -1, n_tokens(library, r.text)) for r in repeated.collect())
    assert rows == want
    assert token_counts(nothing, word_bpe).count() == 0


def test_whole_tokens_are_proved(library, word_bpe):
    model = CountModel(open(word_bpe, encoding="utf-8").read())
    some = sorted(model.whole)[::97]
    for word in some:
        assert len(merged([*word[:-1], word[-1] + "</w>"], model.ranks)) == 1
    # every vocabulary word that isn't in the table really splits
    ends = [v.removesuffix("</w>") for v in model.vocabulary if v.endswith("</w>") and v != "</w>"]
    for word in [w for w in ends if w not in model.whole][:200]:
        assert len(merged([*word[:-1], word[-1] + "</w>"], model.ranks)) > 1


def test_long_words_merge_alike(word_bpe):
    model = CountModel(open(word_bpe, encoding="utf-8").read())
    for word in ("etaoinshrdlu" * 30, "a" * 777, "the" * 100):
        parts = [*word[:-1], word[-1] + "</w>"]
        scan = list(parts)
        while True:  # the definition itself
            ranks = [(model.ranks[p], i) for i, p in enumerate(zip(scan, scan[1:], strict=False)) if p in model.ranks]
            if not ranks:
                break
            i = min(ranks)[1]
            scan[i : i + 2] = [scan[i] + scan[i + 1]]
        assert merged(parts, model.ranks) == scan
