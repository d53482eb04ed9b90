import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from dimweave.llm import ngram_join as N
from dimweave.llm.queries import QUERIES

from .conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def by_definition(rows):
    sets, inverted, parent = [shingle_set(t) for _, t in rows], defaultdict(list), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        common = defaultdict(int)
        for t in s:
            for j in inverted[t]:
                common[j] += 1
            inverted[t].append(i)
        for j, k in common.items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                parent[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)].append(doc_id)
    return sorted(((d, len(sets[i]), min(ids[find(i)], default=None)) for i, (d, _) in enumerate(rows)), key=str)


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, N.similarity_components(df).collect()), key=str)


def test_query_equals_definition(spark, documents):
    got = sorted(map(tuple, QUERIES["op1_ngram_join"](spark, SF).collect()), key=str)
    assert got == by_definition([(r.doc_id, r.text) for r in documents.collect()])


@pytest.fixture(scope="module")
def crowded():
    """Near copies around a few texts at all distances, and texts that share
    one line and little else."""
    rng = random.Random(11)
    base = [[rng.choice("abcdefghijklmnop") + str(rng.randrange(30)) for _ in range(n)] for n in (5, 7, 12, 40, 90, 200)]
    texts = []
    for _ in range(500):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4, 6])):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    for _ in range(200):
        texts.append(" ".join([*base[3], *(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(14)))]))
    for _ in range(100):  # chains: each a little longer than the last
        n = rng.randrange(60, 90)
        texts.append(" ".join(base[4][:n]))
    rows = list(enumerate([*texts, "", None, " ", "a", "A", "a", "a b c", "a b c d e", "a b c d e f"]))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("frequent", "block"), [(16, 512), (2, 7), (10**6, 512)])
def test_crowded_groups(spark, crowded, monkeypatch, frequent, block):
    """All shingles rare, most frequent, and many blocks: the same links."""
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "FREQUENT", frequent)
    assert found(spark, crowded) == by_definition(crowded)


@pytest.mark.parametrize(("documents", "at_most"), [(2, 10**6), (30, 10**6), (2, 500)])
def test_hot_shingles_and_many_buckets(spark, crowded, monkeypatch, documents, at_most):
    """Shingles that go past the buckets, and many small buckets: the same links."""
    monkeypatch.setattr(N, "HOT_IN_FLUSH", 2)
    monkeypatch.setattr(N, "HOT_DOCUMENTS", documents)
    monkeypatch.setattr(N, "HOT_SHINGLES", at_most)
    monkeypatch.setattr(N, "BUCKET_SHINGLES", 400)
    rows = spark.createDataFrame(crowded, "node long, text string").repartition(3)
    total, tokens, counts = N.hot_shingles(rows, 2, documents, at_most)
    sets = [shingle_set(text) for _, text in crowded]
    df = Counter(s for own in sets for s in own)
    assert total == sum(map(len, sets)) and 0 < len(tokens) <= at_most
    assert (np.diff(tokens.astype(float)) > 0).all() and counts.min() >= max(documents, total / at_most)
    assert sorted(counts.tolist(), reverse=True)[0] <= max(df.values())
    assert found(spark, crowded) == by_definition(crowded)


def test_one_shingle_in_a_third_of_the_documents(spark, monkeypatch):
    """No group of the counting takes the hot shingle's documents."""
    monkeypatch.setattr(N, "HOT_DOCUMENTS", 50)
    rng = random.Random(5)
    rows = []
    for i in range(900):
        own = " ".join(f"w{rng.randrange(10**7)}" for _ in range(rng.randrange(3, 40)))
        rows.append((i, "the one hot line here " + own if i % 3 == 0 else own))
    rows += [(900 + i, rows[i][1]) for i in range(0, 60, 7)]
    df = spark.createDataFrame(rows, "node long, text string").repartition(4)
    total, *hot = N.hot_shingles(df, N.HOT_IN_FLUSH, N.HOT_DOCUMENTS, N.HOT_SHINGLES)
    assert N.shingles("the one hot line here")[0] in hot[0]
    packed = df.mapInArrow(N._pack(8, spark.sparkContext.broadcast(hot)), N._PACKED).toPandas()
    per_bucket = packed[packed.df.isna()].groupby("bucket")["low"].apply(lambda x: sum(len(b) for b in x) // 4)
    assert per_bucket.max() < 2 * per_bucket.median()
    assert found(spark, rows) == by_definition(rows)


def test_buckets_of_any_number():
    x = np.sort(np.random.default_rng(1).integers(0, 2**64, 20000, dtype=np.uint64))
    for n in (1, 7, 1 << 16, (1 << 16) + 1, 5_000_000):
        bucket = N._bucket(x, n).astype(np.int64)
        assert 0 <= bucket.min() and bucket.max() < n and (np.diff(bucket) >= 0).all()
        assert bucket.max() >= n * 0.99 - 1


def test_linking_sets_share_a_signature():
    """The prefix argument itself, over random sets and frequencies."""
    rng = np.random.default_rng(4)
    universe = np.unique(rng.integers(1, 2**63, 600, dtype=np.uint64))
    df = rng.choice([1, 2, 5, 20, 400], len(universe))
    for _ in range(300):
        n = int(rng.integers(2, 200))
        x = rng.choice(len(universe), n, replace=False)
        rest = np.setdiff1d(np.arange(len(universe)), x)
        y = np.concatenate([x[int(rng.integers(0, n // 5 + 1)) :], rng.choice(rest, int(rng.integers(0, n // 4 + 1)), replace=False)])
        common = len(np.intersect1d(x, y))
        if 100 * common < 80 * (len(x) + len(y) - common):
            continue
        freq = np.maximum(df, np.where(np.isin(np.arange(len(universe)), np.intersect1d(x, y)), 2, 1))

        def signatures(s):
            shared = s[freq[s] > 1]
            order = np.lexsort((universe[shared], freq[shared]))
            return N.prefix_signatures(len(s), universe[shared][order], freq[shared][order])

        assert len(np.intersect1d(signatures(x), signatures(y)))


def test_null_and_repeated_ids(spark, crowded, odd, nothing):
    rows = [*crowded[:120], (None, "a"), (None, "q q q"), (3, "a b c"), (3, "new text here"), (5, None), (3, "a b c")]
    assert found(spark, rows) == by_definition(rows)
    got = sorted(map(tuple, N.similarity_components(odd).collect()), key=str)
    assert got == by_definition([(r.doc_id, r.text) for r in odd.collect()])
    assert N.similarity_components(nothing).count() == 0
    texts = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y")], "doc_id string, text string")
    assert {r.component_id for r in N.similarity_components(texts).collect()} == {"a"}


def test_one_of_each_group(spark, crowded):
    df = spark.createDataFrame([(i, t, i, "s") for i, t in crowded], "doc_id long, text string, node long, n string")
    kept = N.one_of_each_group(df)
    assert kept.columns == df.columns
    want = {d for d, _, c in by_definition(crowded) if d == c}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    twice = df.unionByName(df.limit(5)).unionByName(spark.createDataFrame([(None, "only here now", 1, "s")], df.schema))
    assert N.one_of_each_group(twice).count() == len(by_definition_groups([(r.doc_id, r.text) for r in twice.collect()]))


def by_definition_groups(rows):
    numbered = [(i, t) for i, (_, t) in enumerate(rows)]
    return {c for _, _, c in by_definition(numbered)}


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 200)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in N.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    neighbours = defaultdict(set)
    for a, b in edges:
        if a != b:
            neighbours[a].add(b)
            neighbours[b].add(a)
    want = {}
    for start in sorted(neighbours):
        stack = [start] if start not in want else []
        while stack:
            x = stack.pop()
            if x not in want:
                want[x] = start
                stack.extend(neighbours[x])
    assert got == want
