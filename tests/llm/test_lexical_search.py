import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from dimweave.llm import lexical_search as ls
from dimweave.llm.queries import QUERIES

from .conftest import SF

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, k=10):
    """(item, rank, doc, score) from the formula, every document scored."""
    bags = [(i, Counter(split(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(split(text))
    out = []
    for item, own in wanted.items():
        scores = []
        for doc, bag in bags:
            m = 10 + 90 * sum(bag.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m)) for t in own if t in bag)
            if s > 0:
                scores.append((-s, doc is not None, doc))
        out += [(item, r, doc, -s) for r, (s, _, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_query_equals_brute_force(spark, documents):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in benchmark.collect()])
    assert rows(QUERIES["op11_best_position"](spark, SF)) == want


def test_shards_blocks_ties_nulls_and_repeats(spark):
    """Copies that tie beyond k, null and repeated ids, null and empty texts,
    clashing columns, odd characters; shards of a few documents and a block an
    item give the same rows."""
    rng = random.Random(3)
    words = ["Aé", "b2", "c", "d-e", "f_g", "中文", "h\x1ci"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(1, 9)))) for i in range(120)]
    docs += [(i, "same words c b2") for i in range(500, 530)] + [(None, "same words c b2"), (None, None), (7, "c"), (7, "c"), (600, ""), (601, " - ")]
    rng.shuffle(docs)
    items = [(1, "same WORDS"), (2, "c"), (2, "b2 c c"), (3, None), (4, ""), (5, "nowhere"), (None, "中文 aé"), (6, "h i d e f g")]
    d = spark.createDataFrame([(*r, 0, "x") for r in docs], "doc_id long, text string, score long, item_id string").repartition(3)
    b = spark.createDataFrame([(*r, 1.0) for r in items], "item_id long, text string, df double")
    want = brute(docs, items)
    assert rows(ls.lexical_search(d, b)) == want
    assert rows(ls.lexical_search(d, b, shard_bytes=200, query_bytes=10)) == want


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([("i", "a")], "item_id string, text string")
    assert rows(ls.lexical_search(d.limit(0), b)) == []
    assert rows(ls.lexical_search(d, b.limit(0))) == []
    assert rows(ls.lexical_search(spark.createDataFrame([(1, None)], d.schema), b)) == []
    assert [r[:3] for r in rows(ls.lexical_search(d, b))] == [("i", 1, 1)]


@pytest.mark.parametrize("first_depth", [1, 4, 32])
def test_search_stops_early_and_keeps_the_best(first_depth):
    rng = np.random.default_rng(0)
    n, v = 4000, 6
    mask = rng.random((v, n)) < 0.5
    term, doc = np.nonzero(mask)
    tf = rng.zipf(1.6, len(term)).clip(1, 500)
    lengths = np.bincount(doc, tf, n).astype(np.int64) + rng.integers(1, 2000, n)
    weights = np.array([ls.term_weight(n, int(d)) for d in mask.sum(axis=1)])
    shard = ls.Shard(term, doc, tf, lengths, weights, n, int(lengths.sum()))
    whole = np.zeros(n, dtype=np.int64)
    np.add.at(whole, shard.keys % n, shard.impact)
    docs, scores, read = shard.search(np.arange(v), 10, first_depth=first_depth)
    best = np.lexsort((np.arange(n), -whole))[:10]
    assert docs.tolist() == best.tolist() and scores.tolist() == whole[best].tolist()
    assert read < mask.sum(axis=1).max()
    # a floor above all scores ends the search after its first reads
    assert len(shard.search(np.arange(v), 10, floor=int(whole.max()) + 1)[0]) == 0
