import hashlib
import random
import re
import zlib

import pytest

from dimweave.llm import periodic_runs as pr
from dimweave.llm.queries import QUERIES

from .conftest import ODD_TEXTS, SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, min_length=6, min_exponent=4):
    """Every period and every maximal stretch with it; of several periods of
    one stretch the least."""
    n, least = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_length, min_exponent * q):
                least.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in least.items())


def report(words):
    runs = brute(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(kept).encode()).hexdigest())


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_equals_brute_force(spark, documents):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    docs = [(r.doc_id, planted(r.doc_id, WORD.findall(r.text or ""))) for r in documents.collect()]
    assert got.keys() == {i for i, _ in docs}
    assert all(got[i] == report(words) for i, words in docs if len(words) <= 1500)
    assert sum(r[0] > 0 for r in got.values()) > 5


@pytest.mark.parametrize("bounds", [(6, 4), (2, 2), (10, 3), (1, 5), (8, 2)])
def test_random_words_of_few_letters(bounds):
    rng = random.Random(sum(bounds))
    for _ in range(150):
        docs = []
        for _ in range(rng.randint(1, 4)):
            words = [b"w%d" % rng.randint(0, rng.randint(1, 4)) for _ in range(rng.randint(0, 60))]
            if words and rng.random() < 0.5:
                p, a = rng.randint(1, 8), rng.randrange(len(words))
                words = [words[min(len(words) - 1, i if i < a else a + (i - a) % p)] for i in range(len(words))]
            docs.append(words)
        assert pr.batch_runs(docs, *bounds) == [brute(d, *bounds) for d in docs]


def test_odd_texts_nulls_and_repeats(odd, nothing, repeated):
    rows = pr.run_report(pr.periodic_runs(odd)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows if r.doc_id != 12} == {i: report(WORD.findall(t or "")) for i, t in enumerate(ODD_TEXTS) if i != 12}
    (long,) = [r for r in rows if r.doc_id == 12]
    assert (long.n_runs, long.start, long.length, long.period, long.exponent_milli) == (1, 0, 20000, 1, 20_000_000)
    assert pr.run_report(pr.periodic_runs(nothing)).count() == 0
    assert pr.run_report(pr.periodic_runs(pr.with_planted_runs(repeated))).count() == repeated.count()


def test_very_long_texts(spark):
    """A long period, a run within a run, and a text of one word."""
    block = [f"v{i}" for i in range(20_000)]
    nested = (["x"] * 6 + ["y"]) * 400
    df = spark.createDataFrame([(1, " ".join(block * 4)), (2, " ".join(nested)), (3, "z " * 300_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in pr.periodic_runs(df).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 80_000, 20_000)] and got[1].collapsed == " ".join(block)
    assert len(got[2].runs) == 401 and tuple(got[2].runs[0]) == (0, 6, 1) and (0, 2800, 7) in map(tuple, got[2].runs)
    assert [tuple(x) for x in got[3].runs] == [(0, 300_000, 1)] and got[3].collapsed == "z"
