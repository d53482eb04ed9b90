"""Language identification with hyperdimensional n-gram profiles.

Every letter has a random vector of +1 and -1.  An n-gram's vector binds
(multiplies) its letters' vectors, each permuted (rotated) by its distance
from the n-gram's end.  A text's vector bundles (sums) the vectors of its
n-grams; a language's prototype bundles those of all its training texts.
Documents are compared with the prototypes by cosine, after the mean prototype
has been taken from both (what all languages share says nothing).

Centred prototypes sum to zero, so the best of their cosines is above zero for
any text: it tells languages apart, not whether a text is in one of them.  That
is decided before centring, by a text's likeness: the mean of its n-grams'
products with the prototype, as a share of what the language's own texts get on
average (1), near 0 for other scripts, code or random letters.

Bundling is linear, so training needs only each language's n-gram counts,
summed over all training documents by Spark; the n-gram vectors are applied to
the sums.  What reaches the driver is bounded by languages x n-grams.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import small_batches, worker_model

UNDETERMINED = "und"
#: Symbols: 0 is everything but letters, 1 to 26 are a to z, the other letters
#: share the rest by code point.
N_SYMBOLS = 40
N_GRAM = 3
DIMENSIONS = 512
SEED = 20240501
#: A text is recognised down to this share of the likeness that all but
#: LOW_QUANTILE of its language's learned texts of its length reach, and where
#: it is within so many standard errors of 1 (what short texts always are).
LEAST_SHARE = 0.3
LOW_QUANTILE = 0.05
STANDARD_ERRORS = 3.0
#: Histograms of likeness: bins of a hundredth from -2 to 4; lengths with fewer
#: texts use another length's.
BINS = 600
FEW_TEXTS = 20

_symbols: np.ndarray | None = None


def symbol_table() -> np.ndarray:
    """Symbol of every code point; letters of both cases share one."""
    global _symbols
    if _symbols is None:
        table = np.zeros(0x110000, dtype=np.uint8)
        for cp in range(0x110000):
            ch = chr(cp)
            if ch.isalpha():
                low = ord(ch.lower()[0])
                table[cp] = low - 96 if 97 <= low <= 122 else 27 + low % (N_SYMBOLS - 27)
        _symbols = table
    return _symbols


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Distinct n-gram codes of a text and their counts; runs without letters
    count as one boundary, and so do both ends.  None without any letter."""
    if not text:
        return None
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    s = symbol_table()[codes]
    s = s[(s > 0) | np.append(True, s[:-1] > 0)]  # one boundary in a row
    if not s.any():
        return None
    s = np.concatenate(([0], s[int(s[0] == 0) :], [0] * int(s[-1] > 0))).astype(np.int64)
    grams = s[:-2] * N_SYMBOLS**2 + s[1:-1] * N_SYMBOLS + s[2:]
    if len(grams) < 20_000:
        return np.unique(grams, return_counts=True)
    counts = np.bincount(grams)
    seen = np.flatnonzero(counts)
    return seen, counts[seen]


class GramVectors:
    """Vectors of the n-grams met so far (at most N_SYMBOLS ** N_GRAM)."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        letters = np.random.default_rng(seed).integers(0, 2, (N_SYMBOLS, dimensions), dtype=np.int8) * 2 - 1
        # a letter k places before the n-gram's end is rotated k times
        self.placed = [np.roll(letters, k, axis=1) for k in range(N_GRAM - 1, -1, -1)]
        self.row = np.full(N_SYMBOLS**N_GRAM, -1, dtype=np.int32)
        self.rows = np.zeros((0, dimensions), dtype=np.int8)
        self.used = 0

    def bound(self, grams: np.ndarray) -> np.ndarray:
        out = np.ones((len(grams), self.rows.shape[1]), dtype=np.int8)
        for k, place in enumerate(self.placed):
            out *= place[grams // N_SYMBOLS ** (N_GRAM - 1 - k) % N_SYMBOLS]
        return out

    def of(self, grams: np.ndarray) -> np.ndarray:
        new = grams[self.row[grams] < 0]
        if len(new):
            if self.used + len(new) > len(self.rows):
                more = np.zeros((max(4096, len(new), len(self.rows) // 2), self.rows.shape[1]), dtype=np.int8)
                self.rows = np.concatenate([self.rows, more])
            self.rows[self.used : self.used + len(new)] = self.bound(new)
            self.row[new] = np.arange(self.used, self.used + len(new))
            self.used += len(new)
        return self.rows[self.row[grams]].astype(np.float32)

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return counts.astype(np.float32) @ self.of(grams)


def _task_vectors() -> GramVectors:
    return worker_model("grams", GramVectors)


@dataclass(frozen=True)
class Profiles:
    """Language names and their prototypes (per n-gram, mean taken off); and,
    for the likeness, the prototypes before that, the n-grams learned, the
    likeness's unit and the standard error of one n-gram."""

    languages: list[str]
    mean: np.ndarray
    prototypes: np.ndarray
    plain: np.ndarray
    sizes: np.ndarray
    units: np.ndarray
    errors: np.ndarray

    def _best(self, bundle: np.ndarray, n: float) -> tuple[int, float]:
        v = bundle - n * self.mean
        norm = float(np.linalg.norm(v))
        if norm == 0.0:
            return 0, 0.0
        cosines = self.prototypes @ v / norm
        best = int(np.argmax(cosines))
        return best, float(np.clip(cosines[best], 0.0, 1.0))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, cosine clipped to 0..1); UNDETERMINED and 0 for a text
        without letters or without any learned language.  Ties go to the
        language that sorts first."""
        found = gram_counts(text) if self.languages else None
        if found is None:
            return UNDETERMINED, 0.0
        best, score = self._best(_task_vectors().bundle(*found), float(found[1].sum()))
        return self.languages[best], score

    def learned_likeness(self, text: str, lang: str) -> tuple[int, float] | None:
        """Length class and likeness of a learned text, with its own part taken
        out of its language's prototype.  None without any other text."""
        found = gram_counts(text)
        if found is None:
            return None
        i, n = self.languages.index(lang), float(found[1].sum())
        if self.sizes[i] <= n:
            return None
        v = _task_vectors().bundle(*found).astype(np.float64)
        others = (v @ self.plain[i] * self.sizes[i] - v @ v) / (self.sizes[i] - n)
        return length_class(n), float(others / n / self.units[i])

    def recognised(self, text: str | None, bounds: Bounds, min_score: float = 0.0) -> bool:
        """Whether a text is like the language it is predicted as."""
        found = gram_counts(text)
        if found is None:
            return False
        bundle, n = _task_vectors().bundle(*found), float(found[1].sum())
        best, score = self._best(bundle, n)
        likeness = float(self.plain[best] @ bundle) / n / self.units[best]
        size = _effective(found[1])
        usual = bounds.get((self.languages[best], length_class(n)))
        if usual is None:
            usual = bounds.get((self.languages[best], None), bounds.get((None, None), -np.inf))
        # the widest error: of a short text the predicted language is uncertain too
        bound = min(usual * LEAST_SHARE, 1.0 - STANDARD_ERRORS * self.errors.max() / size**0.5)
        return score >= min_score and likeness >= bound


#: Longest length class (numbers of n-grams, by powers of two).
LONGEST = 31
#: Likeness that all but LOW_QUANTILE of the learned texts reach, by language
#: and length class; class None: of all lengths, language None: of all texts.
Bounds = dict[tuple[str | None, int | None], float]


def _effective(counts: np.ndarray) -> float:
    """As how many different n-grams a text's n-grams count: (sum of counts)
    squared / sum of squared counts."""
    c = counts.astype(np.float64)
    return float(c.sum() ** 2 / (c * c).sum())


def length_class(n: float) -> int:
    return min(LONGEST, int(np.log2(n)))


def held_out(doc_id: Column, modulus: int = 3, remainder: int = 1) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text
    (null: as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in small_batches(batches, "text", 16 << 20):
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            found = gram_counts(text)
            if found is not None:
                total = totals.setdefault(lang, np.zeros(N_SYMBOLS**N_GRAM, dtype=np.int64))
                total[found[0]] += found[1]
    for lang, total in totals.items():
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen)), pa.array(seen, pa.int64()), pa.array(total[seen])], ["lang", "gram", "n"])


def learn_profiles(labelled: DataFrame) -> Profiles:
    """Profiles from all rows of (text, lang) with both present.  The counts
    are summed in each task and then by (lang, gram); only the sums (at most
    languages x 64,000 rows) come to the driver."""
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    sums = rows.mapInArrow(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sums["lang"].unique())
    vectors = GramVectors()
    prototypes = np.zeros((len(languages), DIMENSIONS), dtype=np.float32)
    sizes, units, errors = (np.ones(len(languages)) for _ in range(3))
    for i, lang in enumerate(languages):
        own = sums[sums["lang"] == lang].sort_values("gram")
        n = own["n"].to_numpy(dtype=np.float64)
        prototypes[i] = vectors.bundle(own["gram"].to_numpy(), n / n.sum())
        q, sizes[i] = n / n.sum(), n.sum()
        # sum of squared shares, without what a small sample adds to it
        same = float((n * (n - 1)).sum() / max(1.0, n.sum() * (n.sum() - 1))) or float(q @ q)
        units[i] = same * DIMENSIONS
        errors[i] = max(0.0, float((q**3).sum()) / float(q @ q) ** 2 - 1 + 1 / units[i]) ** 0.5
    plain = prototypes.copy()
    mean = prototypes.mean(axis=0) if len(languages) > 1 else np.zeros(DIMENSIONS, dtype=np.float32)
    prototypes -= mean
    norms = np.linalg.norm(prototypes, axis=1, keepdims=True)
    return Profiles(languages, mean, prototypes / np.where(norms > 0, norms, 1), plain, sizes, units, errors)


def learn_bounds(labelled: DataFrame, profiles: Profiles) -> Bounds:
    """Bounds from all rows that the profiles were learned from.  Histograms of
    their likeness are made in each task and summed; the sums (at most
    languages x length classes x bins) come to the driver."""
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[tuple[str, int, int]] = Counter()
        for batch in small_batches(batches, "text", 16 << 20):
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                found = profiles.learned_likeness(text, lang)
                if found is not None:
                    seen[lang, found[0], int(np.clip((found[1] + 2) * 100, 0, BINS - 1))] += 1
        if seen:
            langs, sizes, bins = (list(x) for x in zip(*seen, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(langs), pa.array(sizes, pa.int32()), pa.array(bins, pa.int32()), pa.array(list(seen.values()), pa.int64())], ["lang", "size", "bin", "n"])

    sums = rows.mapInArrow(count, "lang string, size int, bin int, n long").groupBy("lang", "size", "bin").agg(F.sum("n").alias("n")).collect()
    histograms: dict[tuple[str | None, int | None], np.ndarray] = {}
    for r in sums:
        for key in ((r["lang"], r["size"]), (r["lang"], None), (None, None)):
            histograms.setdefault(key, np.zeros(BINS, dtype=np.int64))[r["bin"]] += r["n"]
    enough = {k: h for k, h in histograms.items() if k == (None, None) or h.sum() >= FEW_TEXTS}
    low = {k: float(np.searchsorted(h.cumsum(), LOW_QUANTILE * h.sum(), side="right")) / 100 - 2 for k, h in enough.items()}
    # a length without enough texts: the nearest one with enough, the shorter of two
    for lang in {k[0] for k in low if k[1] is not None}:
        known = [k[1] for k in low if k[0] == lang and k[1] is not None]
        for size in range(LONGEST + 1):
            low[lang, size] = low[lang, min(known, key=lambda s: (abs(s - size), s))]
    return low


def identify_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learned from the
    labelled documents that aren't held out.

    One row per row, no shuffle of texts.  Null text and text without a letter
    give ``und`` with score 0, as every text does when nothing can be learned.
    Null ids count as empty text for the split; repeated rows are learned from
    and answered each; only doc_id, text and lang are read, and of these only
    the text enters a prediction.  An empty table gives an empty table.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    profiles = learn_profiles(rows.filter(~F.col("held_out")).select("text", "lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 16 << 20):
            found = [profiles.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return rows.select("doc_id", "held_out", "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, min_score: float = 0.0) -> DataFrame:
    """The documents whose language is recognised: without those that have no
    letter, whose likeness to their predicted language is below LEAST_SHARE of
    what nearly all learned texts of that language and length reach, or whose
    score is below ``min_score``.  Texts too short to tell (with fewer than
    some 25 different n-grams) stay.  All columns are kept as they are.

    Profiles and bounds are learned from all documents' own ``lang`` where it
    is given (held-out ones aside); when no document has one, nothing can be
    recognised and only documents without a letter (null and empty texts among
    them) go.  Repeated rows are judged each; an empty table gives an empty
    table."""
    labelled = docs.filter(~held_out(F.col("doc_id"))).select("text", "lang")
    profiles = learn_profiles(labelled)
    bounds = learn_bounds(labelled, profiles) if profiles.languages else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 16 << 20):
            texts = batch.column("text").to_pylist()
            if profiles.languages:
                keep = [profiles.recognised(t, bounds, min_score) for t in texts]
            else:
                keep = [gram_counts(t) is not None for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
