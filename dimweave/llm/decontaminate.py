"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded batch of whole documents, taken as one sequence of word
symbols.  Words that no benchmark item uses can't be part of an occurrence;
they separate the runs that can, and runs shorter than the shortest window
can't hold one.  The rest is indexed: suffix array (prefix doubling), its
Burrows-Wheeler transform in a wavelet matrix, and the suffix positions
sampled at every eighth word of a run.  All benchmark windows are searched
backward at once through the wavelet ranks, the rows found are walked to the
next sampled position, and the located spans are merged per document.

The benchmark is taken in blocks of bounded size, one after the other: a block
is fetched, sent out, and searched for in one pass over the rows in place,
whose result is written before the next block.  So one block at a time is in
memory, however large the benchmark is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import small_batches, written

WINDOW = 13
#: Bytes of benchmark text that go to the executors at once.
BLOCK_BYTES = 8 << 20
#: Bytes of text of a shard (or one longer document).
SHARD_BYTES = 16 << 20
SAMPLE_EVERY = 8

# Bytes of words: 0-9, a-z (A-Z lower-cased) and everything from 80 up.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


class BitRanks:
    """Number of ones before a place, for many places at once."""

    def __init__(self, bits: np.ndarray):
        words = np.zeros(len(bits) // 64 + 1, dtype=np.uint64)
        packed = np.packbits(bits, bitorder="little")
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))
        self.ones = int(self.before[-1])

    def ones_before(self, i: np.ndarray) -> np.ndarray:
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        below = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def at(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) > 0


class WaveletMatrix:
    """Ranks over a sequence of small integers, bit by bit from the top."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels: list[BitRanks] = []
        self.shifts = range(max(1, (n_symbols - 1).bit_length()) - 1, -1, -1)
        rest = symbols
        for shift in self.shifts:
            bits = (rest >> shift & 1).astype(bool)
            self.levels.append(BitRanks(bits))
            rest = np.concatenate([rest[~bits], rest[bits]])
        self.size = len(symbols)
        # where a symbol's rows begin on the lowest level
        self.base = self._down(np.arange(n_symbols), np.zeros(n_symbols, dtype=np.int64))

    def _down(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, ranks in zip(self.shifts, self.levels, strict=True):
            ones = ranks.ones_before(i)
            i = np.where(symbols >> shift & 1, self.size - ranks.ones + ones, i - ones)
        return i

    def rank(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before its place i."""
        return self._down(symbols, i) - self.base[symbols]

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at i and its rank there."""
        symbols = np.zeros(len(i), dtype=np.int64)
        for ranks in self.levels:
            one, ones = ranks.at(i), ranks.ones_before(i)
            i = np.where(one, self.size - ranks.ones + ones, i - ones)
            symbols = symbols << 1 | one
        return symbols, i - self.base[symbols]


def suffix_order(first: np.ndarray) -> np.ndarray:
    """Suffix array of a sequence given by the ranks of its symbols, by prefix
    doubling; the last symbol of every run must be unique.  A suffix's rank is
    its group's first place in the order, and only groups of several suffixes
    are sorted again."""
    n = len(first)
    order = np.argsort(first, kind="stable")
    at = np.arange(n)
    by_order = first[order]
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(np.concatenate(([True], by_order[1:] != by_order[:-1])), at, 0))
    open_, step = order, 1
    while True:
        open_ = open_[np.bincount(rank[open_], minlength=n)[rank[open_]] > 1]
        if not len(open_):
            break
        after = open_ + step
        next_ = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        sort = np.lexsort((next_, rank[open_]))
        open_, next_ = open_[sort], next_[sort]
        own = rank[open_]
        new_group = np.concatenate(([True], own[1:] != own[:-1]))
        differs = new_group | np.concatenate(([True], next_[1:] != next_[:-1]))
        place = np.arange(len(open_))
        rank[open_] = own + np.maximum.accumulate(np.where(differs, place, 0)) - np.maximum.accumulate(np.where(new_group, place, 0))
        step *= 2
    order[rank] = at
    return order


class FmIndex:
    """FM-index of runs of symbols (1 and up); every run ends in a separator."""

    def __init__(self, runs: np.ndarray, starts: np.ndarray, n_symbols: int):
        """runs: all runs, each followed by 0; starts: where each begins."""
        n = len(runs)
        separators = runs == 0
        first = runs + np.int64(len(starts))
        first[separators] = np.arange(separators.sum())
        order = suffix_order(first)
        self.n_symbols = n_symbols
        self.bwt = WaveletMatrix(runs[order - 1], n_symbols)
        counts = np.bincount(runs, minlength=n_symbols)
        self.less = np.cumsum(counts) - counts
        offset = np.arange(n) - starts[np.searchsorted(starts, np.arange(n), side="right") - 1]
        sampled = (offset % SAMPLE_EVERY == 0)[order]
        self.sampled = BitRanks(sampled)
        self.samples = order[sampled]

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [begin, end) of the suffixes that start with each window (one
        window a row, all of one length)."""
        begin = np.zeros(len(windows), dtype=np.int64)
        end = np.full(len(windows), self.bwt.size, dtype=np.int64)
        live = np.arange(len(windows))
        for k in range(windows.shape[1] - 1, -1, -1):
            symbols = windows[live, k]
            begin[live] = self.less[symbols] + self.bwt.rank(symbols, begin[live])
            end[live] = self.less[symbols] + self.bwt.rank(symbols, end[live])
            live = live[end[live] > begin[live]]
        found = np.zeros(len(windows), dtype=bool)
        found[live] = True
        return begin, np.where(found, end, begin)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position of each row's suffix: back word by word to a sampled one
        (a run's first word always is)."""
        rows = rows.copy()
        position = np.zeros(len(rows), dtype=np.int64)
        walked, live = 0, np.arange(len(rows))
        while len(live):
            at = self.sampled.at(rows[live])
            done = live[at]
            position[done] = self.samples[self.sampled.ones_before(rows[done])] + walked
            live = live[~at]
            symbols, ranks = self.bwt.access(rows[live])
            rows[live] = self.less[symbols] + ranks
            walked += 1
        return position


class Phrases:
    """The windows of a block of benchmark items, over the items' own words."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        groups: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, text in items:
            symbols = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            length = min(window, len(symbols))
            if length:
                group = groups.setdefault(length, {})
                for i in range(len(symbols) - length + 1):
                    group.setdefault(tuple(symbols[i : i + length]), set()).add(item)
        self.groups = [(n, np.array(list(g), dtype=np.int64), [sorted(x) for x in g.values()]) for n, g in sorted(groups.items())]
        self.shortest = min(groups, default=0)

    def find(self, texts: list[str | None]) -> tuple[list[int], list[list[tuple[int, int]]], list[set[str]]]:
        """Of each text: its number of words, the merged spans (in words) that
        occurrences cover, and the items with an occurring window."""
        counts, parts = [], []
        known = self.vocabulary.get
        for text in texts:
            words = words_of(text)
            counts.append(len(words))
            # a 0 after each document
            parts.append(np.fromiter(map(known, words, repeat(0)), dtype=np.int64, count=len(words)))
            parts.append(np.zeros(1, dtype=np.int64))
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[set[str]] = [set() for _ in texts]
        symbols = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
        begins, ends = _runs(symbols > 0, max(1, self.shortest))
        if not self.shortest or not len(begins):
            return counts, spans, items
        lengths = ends - begins + 1  # with the 0 behind the run
        starts = np.cumsum(lengths) - lengths
        source = np.arange(lengths.sum()) + np.repeat(begins - starts, lengths)
        index = FmIndex(symbols[source] * (np.arange(len(source)) != np.repeat(starts + lengths - 1, lengths)), starts, len(self.vocabulary) + 1)
        doc_begins = np.concatenate(([0], np.cumsum(np.array(counts) + 1)))
        found_doc, found_begin, found_end = [], [], []
        for length, windows, owners in self.groups:
            begin, end = index.search(windows)
            hit = np.flatnonzero(end > begin)
            if not len(hit):
                continue
            n = (end - begin)[hit]
            rows = np.repeat(begin[hit] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            at = source[index.locate(rows)]
            doc = np.searchsorted(doc_begins, at, side="right") - 1
            found_doc.append(doc)
            found_begin.append(at - doc_begins[doc])
            found_end.append(at - doc_begins[doc] + length)
            pairs = np.unique(doc * np.int64(len(windows)) + np.repeat(hit, n))
            for d, w in zip((pairs // len(windows)).tolist(), (pairs % len(windows)).tolist(), strict=True):
                items[d].update(owners[w])
        if found_doc:
            doc, begin, end = map(np.concatenate, (found_doc, found_begin, found_end))
            order = np.lexsort((begin, doc))
            for d, b, e in zip(doc[order].tolist(), begin[order].tolist(), end[order].tolist(), strict=True):
                own = spans[d]
                if own and b <= own[-1][1]:
                    own[-1] = (own[-1][0], max(e, own[-1][1]))
                else:
                    own.append((b, e))
        return counts, spans, items


def _runs(mask: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """[begin, end) of the runs of True of at least that length; the last
    element is False."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask)).astype(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    long = ends - begins >= least
    return begins[long], ends[long]


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Callable[[], list[tuple[str, str | None]]]]:
    """All items, (item_id as text, text), in blocks of about ``block_bytes``
    bytes of text, each fetched when it is called; a null item_id is the empty
    text, and repeated items come once."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    for k in range(n):
        block = items if n == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield lambda block=block: [(r.item, r.text) for r in block.collect()]


_SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
_FOUND = "n_words long, spans array<struct<begin:bigint,end:bigint>>, items array<string>"


def _search(phrases: Phrases, first: bool, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", SHARD_BYTES):
            counts, spans, items = phrases.find(batch.column("text").to_pylist())
            if not first:  # add what earlier blocks have found
                for k, (before, own) in enumerate(zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True)):
                    spans[k] = merge_spans([*((s["begin"], s["end"]) for s in before), *spans[k]])
                    items[k].update(own)
            columns = [batch.column("row"), *[batch.column("text")] * with_text, pa.array(counts, pa.int64())]
            columns.append(pa.array([[{"begin": b, "end": e} for b, e in s] for s in spans], pa.list_(_SPAN)))
            columns.append(pa.array([sorted(x) for x in items], pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays(columns, ["row", *["text"] * with_text, "n_words", "spans", "items"])

    return run


def find_passages(docs: DataFrame, benchmark: DataFrame, keep: list[str], with_text: bool = True) -> DataFrame:
    """row (a struct of the kept columns of docs), text (unless not wanted),
    n_words, spans (merged, in words, end exclusive) and items (sorted ids) of
    every document.

    An item's windows are its runs of 13 words, or the whole item if it is
    shorter; words are lower-cased (A-Z) runs of digits, a-z and non-ASCII
    characters.  Null text and null items have no words.  Repeated documents
    are searched each, repeated items count once by id.  An empty benchmark
    finds nothing; an empty table gives an empty table.  Rows stay in place.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), "text")
    kind = rows.schema["row"].dataType.simpleString()
    blocks = list(benchmark_blocks(benchmark))
    for k, block in enumerate(blocks):
        rows = written(rows, "searched") if k else rows
        text = with_text or k < len(blocks) - 1
        run = _search(Phrases(block()), k == 0, text)
        rows = rows.mapInArrow(run, f"row {kind}, {'text string, ' * text}{_FOUND}")
    return rows


def _span_words():
    return F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"]), F.lit(0).cast("long"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit (words inside an occurrence), n_items,
    items_sha256 (of the sorted item ids joined by commas) and contaminated (at
    least a twentieth of the words is hit) of every document."""
    found = find_passages(docs, benchmark, ["doc_id"], with_text=False)
    out = found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        _span_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
    )
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that aren't contaminated, with all their columns and
    their texts as they are.  Null and empty texts have no words and stay, so
    does everything when the benchmark is empty; repeated rows are judged each;
    an empty table gives an empty table."""
    others = [c for c in docs.columns if c.lower() != "text"]
    found = find_passages(docs, benchmark, others).withColumn("hit", _span_words())
    clean = found.filter((F.col("hit") == 0) | (20 * F.col("hit") < F.col("n_words")))
    return clean.select(*["text" if c.lower() == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the spans (in words) and what lies between their words."""
    if not spans:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    is_word = np.frombuffer(raw.translate(_WORD_BYTES), dtype=np.uint8) != 0x20
    begins, ends = _runs(np.append(is_word, False), 1)
    out, at = [], 0
    for begin, end in spans:
        out.append(raw[at : begins[begin]])
        at = ends[end - 1]
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")
