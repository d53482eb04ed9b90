"""Periodic runs of words by uniting suffix classes in order of falling LCP.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) that is at least ``min_exponent`` periods and ``min_length``
words long and that no neighbouring word extends.

The suffixes of a text, sorted, form a path whose edges weigh the longest
common prefix (LCP) of neighbours.  Taking the edges by falling weight, as
Kruskal does, unites at weight l exactly the suffixes that share l words.  A
union-find holds the classes and each class its positions in ascending order.
When two classes unite, positions p < p + d that become neighbours and lie
within l of each other have an LCP of exactly l, so the words p .. p + d + l
have period d and end there.  They begin there, too, unless the word before p
equals the one before p + d.  For a run of smallest period q that starts at s
no position between s and s + q shares as many words with them (it would make
the period shorter), so every run is found at its start; of several periods
found for the same stretch the least is its period.

Suffixes matter only where a gram of a few words occurs again in the same
text: the rest of a batch is left out before anything is sorted.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import small_batches

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: Bytes of text that a task works on at once (or one longer text).
BATCH_BYTES = 4 << 20

RUN_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"
_ODD = np.uint64(0x9E3779B97F4A7C15)  # any odd number mixes; it only has to be fixed


def gram_size(min_length: int, min_exponent: int) -> int:
    """Words of the grams that occur again from every word of a run on, to its
    last such gram."""
    return max(1, min(max(min_length, min_exponent * q) - 2 * q + 1 for q in range(1, min_length + 2)))


def repeated_grams(ids: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """Positions whose gram occurs again in the same document.  Grams are
    compared by 64-bit hashes: a collision only keeps a position too many."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    h = doc[:n].astype(np.uint64)
    for i in range(size):
        h = (h ^ (h >> np.uint64(29))) * _ODD + ids[i : i + n].astype(np.uint64)
    h = (h ^ (h >> np.uint64(32))) * _ODD
    inside = np.flatnonzero(doc[:n] == doc[size - 1 :])
    bits = min(26, int(n).bit_length() + 2)
    bucket = (h[inside] >> np.uint64(64 - bits)).astype(np.int64)
    maybe = inside[np.bincount(bucket, minlength=1 << bits)[bucket] > 1]
    order = np.argsort(h[maybe], kind="stable")
    ordered = h[maybe][order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(maybe), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return maybe[twice]


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes.  Prefix doubling; a position
    is sorted again only while others share its prefix.  The last symbol must
    be unique."""
    n = len(text)
    _, symbols, sizes = np.unique(text, return_inverse=True, return_counts=True)
    rank = (np.cumsum(sizes) - sizes)[symbols]  # suffixes with a lower prefix
    open_ = np.flatnonzero(sizes[symbols] > 1)
    step = 1
    while len(open_):
        key = rank[open_] * n + rank[open_ + step]  # open: the unique end lies behind
        by = np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        old = rank[open_]
        at = np.arange(len(open_))
        first_old = np.maximum.accumulate(np.where(np.diff(old, prepend=-1) != 0, at, 0))
        fresh = np.diff(key, prepend=-1) != 0
        first_new = np.maximum.accumulate(np.where(fresh, at, 0))
        rank[open_] = old + first_new - first_old
        alone = fresh & np.append(fresh[1:], True)
        open_ = open_[~alone]
        step *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    return order


def common_prefixes(text: list, order: list[int]) -> list[int]:
    """LCP of each suffix with the one before it in ``order`` (0 for the
    first), carried from one position to the next."""
    n = len(text)
    rank = [0] * n
    for r, p in enumerate(order):
        rank[p] = r
    out, shared = [0] * n, 0
    for i in range(n):
        r = rank[i]
        if not r:
            shared = 0
            continue
        j = order[r - 1]
        while text[i + shared] == text[j + shared]:
            shared += 1
        out[r] = shared
        if shared:
            shared -= 1
    return out


def runs_of(text: np.ndarray, min_length: int, min_exponent: int, least_lcp: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``text``, whose stretches end
    with symbols that occur nowhere else (the last one too)."""
    if len(text) < min_length:
        return []
    order_ = suffix_order(text)
    symbols, order = text.tolist(), order_.tolist()
    lcp = np.array(common_prefixes(symbols, order), dtype=np.int64)
    edges = np.flatnonzero(lcp >= least_lcp)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]

    parent: dict[int, int] = {}
    positions: dict[int, list[int]] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    least: dict[tuple[int, int], int] = {}  # period by (start, length)

    def seed(p: int, q: int, shared: int) -> None:
        d = q - p
        if shared + d < min_exponent * d or shared + d < min_length:
            return
        if p and symbols[p - 1] == symbols[q - 1]:
            return  # the run begins further left and is found there
        key = (p, d + shared)
        if d < least.get(key, d + 1):
            least[key] = d

    for r, shared in zip(edges.tolist(), lcp[edges].tolist(), strict=True):
        a, b = find(r - 1), find(r)
        large, small = positions.get(a) or [order[a]], positions.get(b) or [order[b]]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        for i, p in enumerate(small):
            k = bisect_left(large, p)
            if k and (not i or large[k - 1] > small[i - 1]):
                seed(large[k - 1], p, shared)
            if k < len(large) and (i + 1 == len(small) or large[k] < small[i + 1]):
                seed(p, large[k], shared)
        if len(small) > 32 and len(small) * 16 > len(large):
            large = sorted(large + small)  # two sorted runs: one linear merge
        else:
            for p in small:
                insort(large, p)
        parent[b] = a
        positions.pop(b, None)
        positions[a] = large
    return [(s, length, q) for (s, length), q in least.items()]


def batch_runs(docs: list[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """The runs of each document's words as (start, length, period), by start,
    then period."""
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for words in docs for w in words), dtype=np.int64)
    sizes = np.array([len(words) for words in docs], dtype=np.int64)
    doc = np.repeat(np.arange(len(docs)), sizes)
    begins = np.cumsum(sizes) - sizes
    size = gram_size(min_length, min_exponent)
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    at = repeated_grams(ids, doc, size)
    if not len(at):
        return out
    depth = np.zeros(len(ids) + 1, dtype=np.int32)
    np.add.at(depth, at, 1)
    np.add.at(depth, at + size, -1)
    covered = np.flatnonzero(np.cumsum(depth[:-1]) > 0)
    new_stretch = (np.diff(covered, prepend=-2) != 1) | (np.diff(doc[covered], prepend=-1) != 0)
    stretch = np.cumsum(new_stretch) - 1
    # a text of the stretches, each followed by a symbol of its own; words of
    # different documents are different symbols
    place = np.arange(len(covered)) + stretch
    text = np.empty(len(covered) + stretch[-1] + 1, dtype=np.int64)
    origin = np.zeros(len(text), dtype=np.int64)
    ends = np.append(place[1:][new_stretch[1:]] - 1, len(text) - 1)
    text[place] = doc[covered] * len(number) + ids[covered]
    text[ends] = len(docs) * len(number) + np.arange(len(ends))
    origin[place] = covered
    for s, length, q in runs_of(text, min_length, min_exponent, size):
        i = origin[s]
        out[doc[i]].append((int(i - begins[doc[i]]), length, q))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by spaces."""
    if runs:
        drop = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in runs:
            drop[start + period] += 1
            drop[start + length] -= 1
        words = [w for w, d in zip(words, np.cumsum(drop[:-1]).tolist(), strict=True) if not d]
    return b" ".join(words)


def _finder(min_length: int, min_exponent: int):
    runs_type = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH_BYTES):
            # bytes.split() cuts at the six ASCII white-space characters only
            docs = [(t or "").encode("utf-8", "surrogatepass").split() for t in batch.column("text").to_pylist()]
            found = batch_runs(docs, min_length, min_exponent)
            flat = np.array([r for runs in found for r in runs], dtype=np.int64).reshape(-1, 3)
            offsets = np.concatenate(([0], np.cumsum([len(r) for r in found]))).astype(np.int32)
            structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(runs_type.value_type))
            kept = [collapsed(words, runs).decode("utf-8", "surrogatepass") for words, runs in zip(docs, found, strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(offsets), structs, type=runs_type)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, pa.array(kept, pa.string())], ["doc_id", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Per row of ``docs``: doc_id, runs (start, length, period in words, by
    start, then period) and collapsed (the words that no run holds after its
    first period, joined by spaces).  Words are separated by the six ASCII
    white-space characters.

    One output row per input row, in place (no shuffle).  Null and empty texts
    have no words: no runs, an empty collapsed text.  Null and repeated ids
    pass through; other columns are ignored, whatever their names; an empty
    table gives an empty table.  Texts are processed whole: a task holds 4 MB
    of text (or one longer text), and suffixes only of its repeated parts.
    """
    if min_exponent < 2:
        raise ValueError("a run has at least two periods")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_finder(min_length, min_exponent), f"doc_id {kind}, runs {RUN_TYPE}, collapsed string")


def run_report(found: DataFrame) -> DataFrame:
    """Digest columns of ``periodic_runs``: n_runs, the longest run (ties:
    smallest start, then period) and sha256 of all runs and of the text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    listed = F.when(F.size("runs") == 0, F.lit("")).otherwise(F.concat(F.array_join(lines, "\n"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(F.expr("1000 * best.length div -best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the text of every tenth document (by the crc32 h
    of its decimal id) repeats itself from word a = g % n on with period
    1 + (n - a) div (3 + g % 8), g = h div 10.  Null ids and texts stay as they
    are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")
    cut = docs.select("doc_id", "text", h.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    cut = cut.withColumn("n", F.size("words")).withColumn("g", F.expr("h div 10"))
    cut = cut.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    cut = cut.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.expr("words")[(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")]))
    return cut.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))
