"""Token ids of whole batches of text at once.

A batch of texts becomes one array of code points.  Pre-tokens are found on
that array by character classes and looked up all at once among those that the
worker remembers; each new one is encoded once.  The ids of the texts are then
taken from those of the pre-tokens by one gather.

``WordIds`` does this for a tokenizers file with word ends (``</w>``).  It
works out by itself the chunks between white space that hold nothing but
characters whose case, composition and class are beyond doubt (ASCII and the
Latin letters up to U+017F); other chunks, and all chunks under a tokenizer of
another make, are encoded by the library, each distinct one once.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from functools import cached_property

import numpy as np
import pyarrow as pa

from dimweave.llm.token_counts import WORD_END, PairTable, merged

#: Distinct pre-tokens that a worker remembers (some 200 bytes each).
CACHE_ENTRIES = 600_000
#: Symbols; longer pre-tokens are merged one by one.
_TABLE_LIMIT = 64
#: Characters of new chunks that the library encodes in one call.
_CALL_CHARS = 200_000

# Unicode's White_Space, and the splitting and normalizing that
# the classes below stand for.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PRE_TOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]

SPACE, LETTER, NUMBER, OTHER, END, ODD = range(6)
APOSTROPHE = 0x27

_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)  # the first n bytes
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)  # any odd numbers


def joined_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each followed by one line feed, and where
    each text begins (and the last one's end)."""
    text = "".join([(t or "") + "\n" for t in texts])
    sizes = np.fromiter((len(t) + 1 if t else 1 for t in texts), dtype=np.int64, count=len(texts))
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4"), np.concatenate(([0], np.cumsum(sizes)))


def contractions(points: np.ndarray, kinds: np.ndarray, starts: np.ndarray) -> None:
    """Cut 's 't 're 've 'm 'll 'd off where an apostrophe starts a pre-token."""
    at = np.flatnonzero((points == APOSTROPHE) & starts)
    at = at[at + 2 < len(points)]
    at = at[kinds[at + 1] == LETTER]
    one, two = points[at + 1], points[at + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l")))
    for found, size in ((at[short], 2), (at[long], 3)):
        starts[found + 1] = False
        after = found + size
        after = after[after < len(points)]
        starts[after[kinds[after] == LETTER]] = True


class Words:
    """The pre-tokens of a batch: ``points`` holds nothing else, and ``starts``
    marks where each begins."""

    def __init__(self, points: np.ndarray, starts: np.ndarray):
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        ends = np.concatenate(([0], np.cumsum(width)))
        self.offsets = np.append(ends[np.flatnonzero(starts)], ends[-1])
        self.data = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass") + bytes(16)

    def binary(self) -> pa.Array:
        kind, offset = (pa.binary(), np.int32) if len(self.data) < 1 << 31 else (pa.large_binary(), np.int64)
        return pa.Array.from_buffers(kind, len(self.offsets) - 1, [None, pa.py_buffer(self.offsets.astype(offset)), pa.py_buffer(self.data)])

    def halves(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Length, first eight and next eight bytes (as numbers) of each."""
        begin, length = self.offsets[:-1], np.diff(self.offsets)
        eight = np.ndarray((len(self.data) - 7,), dtype="<u8", buffer=self.data, strides=(1,))
        low = eight[begin] & _MASKS[np.minimum(length, 8)]
        high = eight[np.minimum(begin + 8, len(eight) - 1)] & _MASKS[np.clip(length - 8, 0, 8)]
        return length, low, high


class WordTable:
    """Ids of the pre-tokens that a worker remembers.

    Words of at most 16 bytes are looked up all at once in a table with one
    place for each hash; what isn't found there is looked up by its distinct
    words, and those that are new are learned (as little-endian 32-bit ids).
    When there are too many, those that nobody has asked for again since they
    were learned are forgotten."""

    def __init__(self, learn: Callable[[list[bytes]], list[bytes]], entries: int = CACHE_ENTRIES, bits: int = 20):
        self.learn, self.entries, self.bits = learn, entries, np.uint64(64 - bits)
        self._start({}, np.empty(0, dtype="<i4"), np.empty(0, dtype=np.int64))

    def _start(self, numbers: dict[bytes, int], flat: np.ndarray, sizes: np.ndarray) -> None:
        places = 1 << (64 - int(self.bits))
        self.numbers, self.flat, self.sizes = numbers, flat, sizes
        self.begins = np.cumsum(sizes) - sizes
        self.asked = np.zeros(len(sizes), dtype=bool)
        self.low, self.high = np.zeros(places, dtype=np.uint64), np.zeros(places, dtype=np.uint64)
        self.length, self.number = np.zeros(places, dtype=np.uint8), np.zeros(places, dtype=np.int32)

    def _forget(self) -> None:
        kept = np.flatnonzero(self.asked)
        fresh = np.full(len(self.asked), -1, dtype=np.int64)
        fresh[kept] = np.arange(len(kept))
        flat, _ = self.gathered(kept)
        self._start({w: int(fresh[n]) for w, n in self.numbers.items() if fresh[n] >= 0}, flat, self.sizes[kept])

    def lookup(self, words: Words) -> np.ndarray:
        """The number of each word."""
        if len(self.numbers) > self.entries:
            self._forget()
        length, low, high = words.halves()
        place = ((low * _ODD[0]) ^ (high * _ODD[1]) ^ (length.astype(np.uint64) * _ODD[2])) >> self.bits
        hit = (length <= 16) & (self.length[place] == length) & (self.low[place] == low) & (self.high[place] == high)
        out = self.number[place].astype(np.int64)
        self.asked[out[hit]] = True
        missing = np.flatnonzero(~hit)
        if len(missing):
            encoded = words.binary().take(pa.array(missing)).dictionary_encode()
            code, distinct = encoded.indices.to_numpy(), encoded.dictionary.to_pylist()
            numbers = self._numbers(distinct)
            out[missing] = numbers[code]
            first = missing[np.flatnonzero(np.diff(np.maximum.accumulate(code), prepend=-1) > 0)]
            first = first[length[first] <= 16]
            own, at = np.unique(place[first], return_index=True)
            first = first[at]
            self.low[own], self.high[own], self.length[own], self.number[own] = low[first], high[first], length[first], out[first]
        return out

    def _numbers(self, distinct: list[bytes]) -> np.ndarray:
        known = list(map(self.numbers.get, distinct))
        new = [w for w, n in zip(distinct, known, strict=True) if n is None]
        self.asked[[n for n in known if n is not None]] = True
        if new:
            ids = self.learn(new)
            sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
            at = len(self.sizes)
            self.numbers.update(zip(new, range(at, at + len(new)), strict=True))
            self.begins = np.concatenate((self.begins, len(self.flat) + np.cumsum(sizes) - sizes))
            self.flat = np.concatenate((self.flat, np.frombuffer(b"".join(ids), dtype="<i4")))
            self.sizes = np.concatenate((self.sizes, sizes))
            self.asked = np.concatenate((self.asked, np.zeros(len(new), dtype=bool)))
            fresh = iter(range(at, at + len(new)))
            known = [next(fresh) if n is None else n for n in known]
        return np.array(known, dtype=np.int64)

    def gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a sequence of word numbers, and how many each word has."""
        counts = self.sizes[numbers]
        shift = self.begins[numbers] - (np.cumsum(counts) - counts)
        return self.flat[np.arange(int(counts.sum())) + np.repeat(shift, counts)], counts

    def ids(self, words: Words, word_begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's begin (and the last end);
        ``word_begins`` has the same for the texts' words."""
        flat, counts = self.gathered(self.lookup(words))
        return flat, np.concatenate(([0], np.cumsum(counts)))[word_begins]


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordIds:
    """Encodes texts under one tokenizers file (its JSON)."""

    def __init__(self, spec: str, entries: int = CACHE_ENTRIES):
        self.spec = json.loads(spec)
        self._text = spec
        self.words = WordTable(self._learn, entries)
        model, added = self.spec["model"], self.spec["added_tokens"]
        plain = [a for a in added if not (a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"])]
        self.marker = plain[0] if plain else None
        self.special = re.compile("|".join(re.escape(a["content"]) for a in added) or r"(?!)")
        normalizer, splitter = self.spec["normalizer"] or {}, self.spec["pre_tokenizer"] or {}
        self.own = (
            model["type"] == "BPE"
            and model.get("end_of_word_suffix") == WORD_END
            and not (model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges") or model.get("continuing_subword_prefix"))
            and normalizer.get("normalizers") == NORMALIZERS
            and splitter.get("pretokenizers") == PRE_TOKENIZERS
            and all(a in plain and a["content"].startswith("<|") for a in added)
        )
        # what a character is in a chunk of safe characters, and in lower case
        self.kinds = np.full(0x110000, ODD, dtype=np.uint8)
        self.lower = np.arange(0x110000, dtype=np.uint32)
        if self.own:
            import unicodedata

            for c in [*range(0x21, 0x7F), *range(0xA1, 0x180)]:
                if len(chr(c).lower()) == 1:
                    self.kinds[c] = {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], OTHER)
                    self.lower[c] = ord(chr(c).lower())
        self._safe = re.compile("[" + "".join(re.escape(chr(c)) for c in np.flatnonzero(self.kinds < ODD)) + "]+" if self.own else r"(?!)").fullmatch
        self.kinds[WHITE_SPACE] = SPACE

    @cached_property
    def _library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self._text)

    @cached_property
    def _merges(self) -> tuple[PairTable, dict, dict, np.ndarray, np.ndarray]:
        model = self.spec["model"]
        vocabulary = model["vocab"]
        ranks = {tuple(m.split(" ")) if isinstance(m, str) else tuple(m): r for r, m in enumerate(model["merges"])}
        symbols = byte_symbols()
        inner, last = (np.array([vocabulary[s + end] for s in symbols], dtype=np.int64) for end in ("", WORD_END))
        return PairTable(vocabulary, ranks), ranks, vocabulary, inner, last

    def split(self, texts: list[str | None]) -> tuple[Words, np.ndarray]:
        """The texts' pre-tokens, and where each text's begin (and the last
        one's end)."""
        points, begins = joined_points(texts)
        kinds = self.kinds[points]
        space = kinds == SPACE
        before = np.concatenate(([SPACE], kinds[:-1])).astype(np.uint8)
        chunk_starts = ~space & (before == SPACE)
        odd = kinds == ODD
        odd[:-1] |= (points[:-1] == ord("<")) & (points[1:] == ord("|"))
        starts = ~space & ((before != kinds) | (kinds == NUMBER))
        low = self.lower[points]
        contractions(low, kinds, starts)
        if odd.any():
            chunk = np.cumsum(chunk_starts) - 1
            of_odd = np.zeros(chunk[-1] + 1, dtype=bool)
            of_odd[chunk[odd]] = True
            in_odd = ~space & of_odd[chunk]
            starts = np.where(in_odd, chunk_starts, starts)
            points = np.where(in_odd, points, low)
        else:
            points = low
        kept = ~space
        starts &= kept
        word_begins = np.concatenate(([0], np.cumsum(starts)))[begins]
        return Words(points[kept], starts[kept]), word_begins

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's begin (and the last end)."""
        return self.words.ids(*self.split(texts))

    def _learn(self, words: list[bytes]) -> list[bytes]:
        texts = [w.decode("utf-8", "surrogatepass") for w in words]
        safe = [self.own and self._safe(t) is not None and "<|" not in t for t in texts]
        own = iter(self._merged([w for w, s in zip(words, safe, strict=True) if s]))
        library = iter(self._encoded([t for t, s in zip(texts, safe, strict=True) if not s]))
        return [next(own if s else library) for s in safe]

    def _merged(self, words: list[bytes]) -> list[bytes]:
        """Ids of pre-tokens by the merges, all words of a length at once."""
        out: list[bytes] = [b""] * len(words)
        if not words:
            return out
        table, ranks, vocabulary, inner, last = self._merges
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        symbols = byte_symbols()
        for n, own in by_length.items():
            if n > _TABLE_LIMIT:
                for i in own:
                    parts = [symbols[b] for b in words[i]]
                    parts[-1] += WORD_END
                    out[i] = np.array([vocabulary[p] for p in merged(parts, ranks)], dtype="<i4").tobytes()
                continue
            raw = np.frombuffer(b"".join([words[i] for i in own]), dtype=np.uint8).reshape(len(own), n)
            rows = inner[raw]
            rows[:, -1] = last[raw[:, -1]]
            for index, done in fixpoints(table, rows):
                size, flat = 4 * done.shape[1], done.astype("<i4").tobytes()
                for j, k in enumerate(index.tolist()):
                    out[own[k]] = flat[j * size : (j + 1) * size]
        return out

    def _encoded(self, chunks: list[str]) -> Iterable[bytes]:
        """Ids of chunks by the library: many in a call, set apart by a special
        string (which it cuts out before anything else)."""
        out: dict[str, bytes] = {}
        plain, size = [], 0

        def call() -> None:
            text = self.marker["content"].join(plain)
            ids = np.array(self._library.encode(text, add_special_tokens=False).ids, dtype="<i4")
            cuts = np.flatnonzero(ids == self.marker["id"]).tolist()
            for chunk, begin, end in zip(plain, [0, *(c + 1 for c in cuts)], [*cuts, len(ids)], strict=True):
                out[chunk] = ids[begin:end].tobytes()

        for c in chunks:
            if self.marker is None or self.special.search(c):
                out[c] = np.array(self._library.encode(c, add_special_tokens=False).ids, dtype="<i4").tobytes()
                continue
            plain.append(c)
            size += len(c)
            if size >= _CALL_CHARS:
                call()
                plain, size = [], 0
        if plain:
            call()
        return [out[c] for c in chunks]


def fixpoints(table: PairTable, symbols: np.ndarray):
    """(row numbers, their symbols when no pair is left) of rows of one length.
    Every step contracts the leftmost pair of least rank in every row that has
    one, so that rows keep one length."""
    none = np.int32(2**31 - 1)  # PairTable's rank of pairs that don't merge
    index = np.arange(len(symbols))
    ranks = table.rank(symbols[:, :-1], symbols[:, 1:])
    while len(index):
        n = symbols.shape[1]
        if n == 1:
            yield index, symbols
            return
        best = ranks.argmin(axis=1)
        least = ranks[np.arange(len(index)), best]
        open_ = least != none
        if not open_.all():
            yield index[~open_], symbols[~open_]
            index, symbols, ranks, best, least = index[open_], symbols[open_], ranks[open_], best[open_], least[open_]
        row = np.arange(len(index))
        symbols[row, best] = table.result[least]
        keep = np.ones(symbols.shape, dtype=bool)
        keep[row, best + 1] = False
        symbols = symbols[keep].reshape(len(index), n - 1)
        keep = np.ones(ranks.shape, dtype=bool)
        keep[row, best] = False
        ranks = ranks[keep].reshape(len(index), n - 2)
        for at in (best - 1, best):
            r = row[(at >= 0) & (at < n - 2)]
            a = at[r]
            ranks[r, a] = table.rank(symbols[r, a], symbols[r, a + 1])
