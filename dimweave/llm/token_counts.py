"""Token counts by the whole-token shortcut.

A byte-pair vocabulary with word ends (``</w>``) holds most frequent words as
one token.  ``CountModel`` proves offline, by running the merges on every
word-final vocabulary string, which of them really come out as a single token;
a pre-token found in that table counts one without any merging.  Only the
others are merged, many words at once, and each distinct chunk of text once
while a worker remembers it.

Special strings inside a text count as one token each, as the tokenizers
library does by default; none is added at the ends.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import small_batches, white_space_chunks, worker_model

WORD_END = "</w>"
#: Distinct chunks whose counts a worker remembers (about 150 bytes each);
#: beyond it starts anew.
CACHE_ENTRIES = 800_000
_TABLE_LIMIT = 64  # symbols; longer pre-tokens are merged one by one
_SCAN_LIMIT = 48  # symbols; beyond it, by a heap
_NO_RANK = np.int32(2**31 - 1)


def merged(parts: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """``parts`` after contracting the leftmost pair of least rank until no
    pair has a rank."""
    if len(parts) > _SCAN_LIMIT:
        return _merged_long(parts, ranks)
    known = [ranks.get(pair, -1) for pair in zip(parts, parts[1:], strict=False)]
    while True:
        best, at = -1, -1
        for i, r in enumerate(known):
            if r >= 0 and (best < 0 or r < best):
                best, at = r, i
        if at < 0:
            return parts
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del known[at]
        if at < len(known):
            known[at] = ranks.get((parts[at], parts[at + 1]), -1)
        if at:
            known[at - 1] = ranks.get((parts[at - 1], parts[at]), -1)


def _merged_long(parts: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The same with a heap over linked positions: O(n log n)."""
    n = len(parts)
    after = [*range(1, n), -1]
    before = [-1, *range(n - 1)]
    heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get((parts[i], parts[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if j < 0 or parts[i] != a or parts[j] != b:
            continue  # one of the two has been contracted meanwhile
        parts[i], parts[j], after[i] = a + b, "", after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for left in (before[i], i):
            right = after[left] if left >= 0 else -1
            if right >= 0 and (r := ranks.get((parts[left], parts[right]))) is not None:
                heapq.heappush(heap, (r, left, parts[left], parts[right]))
    return [p for p in parts if p]


class PairTable:
    """Merges as sorted numbers, for many words of one length at once."""

    def __init__(self, vocabulary: dict[str, int], ranks: dict[tuple[str, str], int]):
        self.size = max(vocabulary.values()) + 1
        pairs = list(ranks)
        left, right, result = (np.array([vocabulary[x] for x in column], dtype=np.int64) for column in zip(*((a, b, a + b) for a, b in pairs), strict=True))
        keys = left * self.size + right
        order = np.argsort(keys)
        self.keys, self.ranks, self.result = keys[order], order.astype(np.int32), result

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NO_RANK)

    def counts(self, symbols: np.ndarray) -> np.ndarray:
        """Tokens that each row of symbols ends up as.  Every step contracts
        one pair in every row that has one, so rows keep one length."""
        out = np.zeros(len(symbols), dtype=np.int64)
        index = np.arange(len(symbols))
        ranks = self.rank(symbols[:, :-1], symbols[:, 1:])
        while len(index):
            n = symbols.shape[1]
            if n == 1:
                out[index] = 1
                break
            row = np.arange(len(index))
            best = ranks.argmin(axis=1)  # the leftmost of the least
            least = ranks[row, best]
            open_ = least != _NO_RANK
            out[index[~open_]] = n
            index, symbols, ranks, best, least = index[open_], symbols[open_], ranks[open_], best[open_], least[open_]
            row = np.arange(len(index))
            symbols[row, best] = self.result[least]
            keep = np.ones(symbols.shape, dtype=bool)
            keep[row, best + 1] = False
            symbols = symbols[keep].reshape(len(index), n - 1)
            keep = np.ones(ranks.shape, dtype=bool)
            keep[row, best] = False
            ranks = ranks[keep].reshape(len(index), n - 2)
            for at in (best - 1, best):
                r = row[(at >= 0) & (at < n - 2)]
                a = at[r]
                ranks[r, a] = self.rank(symbols[r, a], symbols[r, a + 1])
        return out


class CountModel:
    """Counts tokens of chunks of text under one tokenizer file (its JSON)."""

    def __init__(self, spec: str):
        self.spec = spec
        model = json.loads(spec)["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != WORD_END:
            raise ValueError("the whole-token shortcut needs a BPE model with </w> word ends")
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a, b): r for r, (a, b) in enumerate(pairs)}
        self.vocabulary = model["vocab"]
        self.table = PairTable(self.vocabulary, self.ranks)
        self.known: dict[str, int] = {}

    @cached_property
    def whole(self) -> frozenset[str]:
        """Pre-tokens proved to encode as exactly one token."""
        words = [v.removesuffix(WORD_END) for v in self.vocabulary if v.endswith(WORD_END) and v != WORD_END]
        return frozenset(w for w, n in self.merge(words).items() if n == 1)

    def merge(self, words: Iterable[str]) -> dict[str, int]:
        """Tokens of each distinct pre-token, by merging."""
        by_length: dict[int, list[str]] = {}
        for w in set(words):
            by_length.setdefault(len(w), []).append(w)
        first, out = self.vocabulary, {}
        last = {v[0]: i for v, i in self.vocabulary.items() if len(v) == 1 + len(WORD_END) and v.endswith(WORD_END)}
        for n, own in by_length.items():
            if n > _TABLE_LIMIT:
                out.update((w, len(merged([*w[:-1], w[-1] + WORD_END], self.ranks))) for w in own)
                continue
            flat = np.fromiter(map(first.__getitem__, "".join(own)), dtype=np.int64, count=n * len(own))
            symbols = flat.reshape(len(own), n)
            symbols[:, -1] = [last[w[-1]] for w in own]
            out.update(zip(own, self.table.counts(symbols).tolist(), strict=True))
        return out

    @cached_property
    def _library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.spec)

    @cached_property
    def _special(self) -> re.Pattern:
        special = [a["content"] for a in json.loads(self.spec)["added_tokens"]]
        return re.compile("|".join(map(re.escape, special)) or r"(?!)")

    def _pre_tokens(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        return self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))

    def learn(self, chunks: Iterable[str]) -> None:
        """Count new chunks (without white space; they are independent of each
        other because no pre-token spans white space)."""
        words: list[str] = []  # pre-tokens
        owners: list[tuple[str, int, int]] = []  # chunk, special strings, pre-tokens
        plain, size = [], 0

        def split_plain() -> None:
            """All plain chunks at once: chunks meet where offsets have a gap."""
            found = self._pre_tokens(" ".join(plain))
            begins = [i for i, (_, (start, _)) in enumerate(found) if i == 0 or start > found[i - 1][1][1]]
            if len(begins) != len(plain):  # not one run of pre-tokens for each
                for c in plain:
                    own = [w for w, _ in self._pre_tokens(c)]
                    words.extend(own)
                    owners.append((c, 0, len(own)))
                return
            words.extend(w for w, _ in found)
            owners.extend((c, 0, b - a) for c, a, b in zip(plain, begins, [*begins[1:], len(found)], strict=True))

        for c in chunks:
            if c.isascii() and c.isalpha():
                words.append(c.lower())  # normalizing and splitting change nothing else here
                owners.append((c, 0, 1))
            elif self._special.search(c):
                own = [w for piece in self._special.split(c) if piece for w, _ in self._pre_tokens(piece)]
                words.extend(own)
                owners.append((c, len(self._special.findall(c)), len(own)))
            else:
                plain.append(c)
                size += len(c)
                if size > 100_000:
                    split_plain()
                    plain, size = [], 0
        if plain:
            split_plain()
        whole = self.whole
        merged_words = self.merge(w for w in words if w not in whole)
        counts = [merged_words.get(w, 1) for w in words]
        at = 0
        for chunk, special, n in owners:
            self.known[chunk] = special + (counts[at] if n == 1 else sum(counts[at : at + n]))
            at += n

    def count(self, texts: list[str | None]) -> list[int]:
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        split = [white_space_chunks(t) if t else [] for t in texts]
        self.learn(set().union(*split) - self.known.keys())
        return [sum(map(self.known.__getitem__, chunks)) for chunks in split]


def _proved(spec: str, whole: frozenset[str]) -> CountModel:
    model = CountModel(spec)
    model.whole = whole  # proved on the driver
    return model


def _counter(spec: str, whole: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(("counts", spec), lambda: _proved(spec, whole))
        for batch in small_batches(batches, "text", 4 << 20):
            counts = model.count(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048) -> DataFrame:
    """Per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens >
    limit).

    One output row per input row, in place (no shuffle).  Null text counts as
    empty: 0 bytes, 0 tokens.  Null and repeated ids pass through; other
    columns are ignored, whatever their names; an empty table gives an empty
    table.  Texts are processed whole, at any length: working memory is a
    batch of at most 4 MB of text (or one longer text) and a bounded cache.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    whole = CountModel(spec).whole
    rows = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = rows.mapInArrow(_counter(spec, whole), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
