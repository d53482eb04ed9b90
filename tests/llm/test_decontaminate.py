import hashlib
import random
import re

import numpy as np
import pytest

from dimweave.llm import decontaminate as D
from dimweave.llm.queries import QUERIES

from .conftest import SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def by_definition(texts, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(item)
    out = []
    for text in texts:
        w = words(text)
        hit, found = [0] * len(w), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                owners = windows.get(tuple(w[k : k + n]))
                if owners:
                    found |= owners
                    hit[k : k + n] = [1] * n
        out.append((len(w), sum(hit), sorted(found)))
    return out


def test_query_equals_definition(spark, documents):
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = documents.collect()
    got = {r.doc_id: r for r in QUERIES["op7_decontaminate"](spark, SF).collect()}
    assert len(got) == len(docs)
    for r, (n, hit, found) in zip(docs, by_definition([r.text for r in docs], items), strict=True):
        x = got[r.doc_id]
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert (x.n_words, x.n_hit, x.n_items, x.items_sha256) == (n, hit, len(found), digest)
        assert x.contaminated == (hit > 0 and 20 * hit >= n)


@pytest.mark.parametrize("letters", [1, 2, 3, 8])
def test_random_repetitive_texts(letters):
    rng = random.Random(letters)

    def text(n):
        return " ".join(rng.choice("abcdefgh"[:letters]) for _ in range(n))

    for _ in range(6):
        texts = [text(rng.randint(0, 200)) for _ in range(12)] + [None, "", "é É a1"]
        items = [(str(k), text(rng.choice([0, 1, 3, 12, 13, 14, 30]))) for k in range(rng.randint(0, 6))]
        counts, spans, found = D.Phrases(items).find(texts)
        got = [(n, sum(e - b for b, e in s), sorted(f)) for n, s, f in zip(counts, spans, found, strict=True)]
        assert got == by_definition(texts, items)


def test_index_counts_and_locates():
    rng = np.random.default_rng(2)
    for symbols in (2, 5, 40):
        run = np.concatenate([rng.integers(1, symbols, 100), [0], rng.integers(1, symbols, 57), [0]])
        index = D.FmIndex(run, np.array([0, 101]), symbols)
        for n in (1, 2, 4):
            windows = np.unique(np.array([run[k : k + n] for k in range(90)]), axis=0)
            begin, end = index.search(windows)
            for w, b, e in zip(windows, begin, end, strict=True):
                want = [k for k in range(len(run) - n + 1) if (run[k : k + n] == w).all()]
                assert sorted(index.locate(np.arange(b, e)).tolist()) == want


def test_blocks_of_the_benchmark(spark, documents):
    """Small blocks, each a pass of its own, find the same."""
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert len(list(D.benchmark_blocks(benchmark, 3000))) > 1
    want = sorted(map(tuple, D.contamination(documents, benchmark).collect()))
    before, D.BLOCK_BYTES = D.BLOCK_BYTES, 3000
    try:
        blocks = D.benchmark_blocks
        D.benchmark_blocks = lambda b: blocks(b, 3000)
        got = sorted(map(tuple, D.contamination(documents, benchmark).collect()))
    finally:
        D.BLOCK_BYTES, D.benchmark_blocks = before, blocks
    assert got == want


def test_repeated_items_are_fetched_once(spark):
    items = spark.createDataFrame([(1, "one two three")] * 500 + [(2, "four"), (None, None)], "item_id long, text string")
    blocks = [block() for block in D.benchmark_blocks(items, 10)]
    assert sorted(str(x) for block in blocks for x in block) == sorted(str(x) for x in [("1", "one two three"), ("2", "four"), ("", None)])


def test_odd_tables(spark, odd, nothing, repeated):
    items = spark.createDataFrame([(1, "word word"), (1, "word word"), (None, "twice"), (2, None), (3, ""), (4, "one two")], "item_id long, text string")
    rows = {r.doc_id: r for r in D.contamination(odd, items).collect()}
    assert (rows[12].n_words, rows[12].n_hit, rows[12].n_items) == (20000, 20000, 1)
    assert (rows[14].n_hit, rows[14].n_items, rows[14].contaminated) == (1, 1, True)
    assert (rows[0].n_words, rows[1].n_words, rows[0].contaminated) == (0, 0, False)
    assert sorted(str((r.doc_id, r.n_hit)) for r in D.contamination(repeated, items).collect()) == sorted(
        str(x) for x in [(3, 2), (3, 2), (3, 0), (None, 0), (None, 0), (1, 0)]
    )
    assert D.contamination(nothing, items).count() == 0
    assert D.contamination(odd, items.limit(0)).filter("n_hit > 0 or n_items > 0").count() == 0


def test_filter_and_cut(spark, odd):
    items = spark.createDataFrame([(1, "same text twice")], "item_id long, text string")
    kept = D.without_contaminated(odd, items)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(14))
    assert sorted(map(str, kept.collect())) == sorted(map(str, odd.filter("doc_id < 14").collect()))
    assert D.cut_spans("One, two; three été!", [(1, 3)]) == "One,  été!"
    assert D.cut_spans("a b", []) == "a b"
