"""Ranked lexical search by the best position algorithm.

The documents are indexed in shards (about 16 MB of text, in place, without a
shuffle).  A shard holds for every query term an impact list: the documents
with the term, by falling contribution to a score, and the same entries by
document for direct access.

A search reads its terms' lists in parallel from the top.  Every document it
meets is looked up in all lists (direct access), which gives its whole score
and its position in each.  A list's best position is the last one up to which
all positions have been seen, whether by reading or by direct access; an
unseen document lies behind it in every list, so the sum of the contributions
that follow the best positions bounds what is still to come.  That bound falls
faster than one from the last positions read.  The search of a shard stops
when it is strictly below the k-th best score (an equal score could still win
by its doc_id); the k-th score of a task's earlier shards counts, too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimweave.llm.common import release_memory, small_batches, written

#: Text of a shard, and of the queries that one pass over the shards answers.
SHARD_BYTES = 16 << 20
QUERY_BYTES = 8 << 20
#: Positions of each list read before the bound is looked at; doubles.
FIRST_DEPTH = 32
#: Groups that an item's candidates are ranked in before they meet.
SALTS = 64

# Term characters: digits, letters and all that isn't ASCII; A-Z in lower case.
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Shard:
    """Impact lists of some documents, which are numbered by ascending id."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, tf: np.ndarray, n_terms: np.ndarray, weights: np.ndarray, n_docs: int, total: int):
        m = 100 - 90 + (90 * n_terms * n_docs) // total
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        some = impact > 0
        term, doc, impact = term[some].astype(np.int64), doc[some], impact[some]
        self.n_docs = len(n_terms)
        self.keys, self.impact = term * self.n_docs + doc, impact  # ascending
        self.begin = np.searchsorted(term, np.arange(len(weights) + 1))
        order = np.lexsort((doc, -impact, term))
        self.listed_doc, self.listed_impact = doc[order], impact[order]
        self.position = np.empty(len(order), dtype=np.int64)
        self.position[order] = np.arange(len(order)) - self.begin[term]

    def search(self, query: np.ndarray, k: int, floor: int = 0, first_depth: int = FIRST_DEPTH) -> tuple[np.ndarray, np.ndarray, int]:
        """(document numbers, scores, positions read) of the k best documents
        with a score of at least ``floor`` and above 0, best first."""
        query = query[self.begin[query + 1] > self.begin[query]]
        begin, size = self.begin[query], self.begin[query + 1] - self.begin[query]
        own = np.cumsum(size) - size  # where each list's marks begin
        marks = int(size.sum())
        seen = np.zeros(marks, dtype=bool)
        met = np.zeros(self.n_docs, dtype=bool)
        docs, scores = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        depth, step = 0, first_depth
        while marks:
            at = np.arange(depth, depth + step)
            read = (begin[:, None] + at)[at < size[:, None]]
            found = self.listed_doc[read]
            new = np.unique(found[~met[found]])
            met[new] = True
            key = (query[:, None] * self.n_docs + new).ravel()
            entry = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[entry] == key
            score = np.where(hit, self.impact[entry], 0).reshape(len(query), -1).sum(axis=0)
            seen[np.repeat(own, len(new))[hit] + self.position[entry[hit]]] = True
            good = score >= max(1, floor)
            docs, scores = np.concatenate((docs, new[good])), np.concatenate((scores, score[good]))
            best = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[best], scores[best]
            depth, step = depth + step, 2 * step
            # best positions: the first mark of each list that isn't set
            unseen = np.append(np.flatnonzero(~seen), marks)
            best_position = np.minimum(unseen[np.searchsorted(unseen, own)] - own, size)
            rest = best_position < size
            if not rest.any():
                break
            bound = int(self.listed_impact[(begin + best_position)[rest]].sum())
            if bound < max(floor, int(scores[-1]) if len(docs) == k else 0):
                break
        return docs, scores, depth


def _indexer(vocabulary: dict[bytes, int], id_type: pa.DataType, shard_bytes: int):
    width = max(1, len(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        lengths: list[int] = []
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        size = 0

        def shard() -> pa.RecordBatch:
            n = np.array(lengths, dtype=np.int64)
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i]))
            place = np.empty(len(ids), dtype=np.int64)
            place[order] = np.arange(len(ids))
            key, tf = np.concatenate(keys), np.concatenate(counts)
            doc, term = place[key // width], key % width
            by = np.lexsort((doc, term))
            row = [
                pa.array([[ids[i] for i in order]], pa.list_(id_type)),
                pa.array([n[order].astype("<i8").tobytes()], pa.binary()),
                *(pa.array([a[by].astype("<i4").tobytes()], pa.binary()) for a in (term, doc, tf)),
                pa.array([int((n > 0).sum())], pa.int64()),
                pa.array([int(n.sum())], pa.int64()),
            ]
            for held in (ids, lengths, keys, counts):
                held.clear()
            return pa.RecordBatch.from_arrays(row, ["doc_ids", "lengths", "term", "doc", "tf", "n_docs", "n_terms"])

        for batch in small_batches(batches, "text", min(4 << 20, shard_bytes)):
            known = []
            first = len(ids)
            for text in batch.column("text").to_pylist():
                words = terms(text)
                lengths.append(len(words))
                known.append(np.array([t for w in words if (t := vocabulary.get(w, -1)) >= 0], dtype=np.int64))
            ids.extend(batch.column("doc_id").to_pylist())
            doc = np.repeat(np.arange(first, len(ids)), [len(k) for k in known])
            key, count = np.unique(doc * width + np.concatenate(known), return_counts=True)
            keys.append(key)
            counts.append(count)
            size += batch.column("text").nbytes
            if size >= shard_bytes:
                yield shard()
                size = 0
        if ids:
            yield shard()
        release_memory()

    return run


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for raw in batch.column("term").to_pylist():
            term, df = np.unique(np.frombuffer(raw, dtype="<i4"), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term.astype(np.int64)), pa.array(df.astype(np.int64))], ["term", "df"])


def _searcher(items: list[tuple[object, np.ndarray]], item_type: pa.DataType, id_type: pa.DataType, weights: np.ndarray, n_docs: int, total: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in items]  # (-score, id is known, id) of the task's shards
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids = row.column("doc_ids")[0].values
                n = np.frombuffer(row.column("lengths")[0].as_py(), dtype="<i8")
                term, doc, tf = (np.frombuffer(row.column(c)[0].as_py(), dtype="<i4").astype(np.int64) for c in ("term", "doc", "tf"))
                shard = Shard(term, doc, tf, n, weights, n_docs, total)
                for j, (_, query) in enumerate(items):
                    floor = -best[j][-1][0] if len(best[j]) == k else 0
                    docs, scores, _ = shard.search(query, k, floor)
                    if len(docs):
                        names = ids.take(pa.array(docs)).to_pylist()
                        best[j].extend((-s, name is not None, name) for s, name in zip(scores.tolist(), names, strict=True))
                        best[j].sort()
                        del best[j][k:]
        rows = [(items[j][0], name, -score) for j, own in enumerate(best) for score, _, name in own]
        if rows:
            item, doc, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(item, item_type), pa.array(doc, id_type), pa.array(score, pa.int64())], ["item_id", "doc_id", "score"])
        release_memory()

    return run


def _first(rows: DataFrame, keys: list, k: int) -> DataFrame:
    ordered = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return rows.withColumn("rank", F.row_number().over(ordered)).filter(F.col("rank") <= k)


def _queries(benchmark: DataFrame, query_bytes: int) -> Iterator[tuple[dict[bytes, int], list[tuple[object, np.ndarray]]]]:
    """Blocks of queries of about ``query_bytes`` of text: term numbers, and
    (item_id, ascending term numbers) of every item that has a term."""
    rows = benchmark.select("item_id", "text").filter("text is not null").distinct()
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = 1 + n_bytes // query_bytes
    for block in range(n_blocks):
        vocabulary: dict[bytes, int] = {}
        found: dict[object, set[int]] = {}
        for item, text in rows.filter(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == block).collect():
            own = {vocabulary.setdefault(t, len(vocabulary)) for t in terms(text)}
            if own:
                found.setdefault(item, set()).update(own)
        if found:
            yield vocabulary, [(item, np.array(sorted(own), dtype=np.int64)) for item, own in found.items()]


def lexical_search(docs: DataFrame, benchmark: DataFrame, k: int = 10, shard_bytes: int = SHARD_BYTES, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` documents with the
    highest scores above 0 for every item of ``benchmark`` (all, if fewer),
    equal scores by ascending doc_id.

    Null and empty texts have no terms: such documents are never found and
    don't count, such items return nothing.  Rows that repeat an item_id form
    one item with the terms of all of them; every row of ``docs`` is a
    document of its own, null ids first among equals.  Empty tables give an
    empty table; other columns are ignored, whatever their names.

    Texts are indexed whole, in shards of 16 MB of text (or one longer text).
    Queries go out in blocks of 8 MB of text (or one longer item), one after
    the other; a block's terms and their document counts are all that the
    driver holds.  A task returns at most ``k`` rows an item, which are ranked
    in salted groups first.
    """
    item_field, id_field = benchmark.schema["item_id"], docs.schema["doc_id"]
    item_kind, id_kind = item_field.dataType.simpleString(), id_field.dataType.simpleString()
    no_rows = docs.sparkSession.createDataFrame([], f"item_id {item_kind}, doc_id {id_kind}, score long")
    item_type, id_type = _arrow_type(no_rows, "item_id"), _arrow_type(no_rows, "doc_id")
    candidates = no_rows
    for vocabulary, items in _queries(benchmark, query_bytes):
        kind = f"doc_ids array<{id_kind}>, lengths binary, term binary, doc binary, tf binary, n_docs long, n_terms long"
        shards = written(docs.select("doc_id", "text").mapInArrow(_indexer(vocabulary, id_type, shard_bytes), kind), "impact-lists")
        n_docs, total = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        if not total:
            continue
        counted = shards.select("term").mapInArrow(_document_counts, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
        weights = np.zeros(len(vocabulary), dtype=np.int64)
        for term, df in counted.collect():  # at most the block's terms
            weights[term] = term_weight(n_docs, df)
        search = _searcher(items, item_type, id_type, weights, n_docs, total, k)
        found = shards.select("doc_ids", "lengths", "term", "doc", "tf").mapInArrow(search, f"item_id {item_kind}, doc_id {id_kind}, score long")
        candidates = candidates.unionByName(written(found, "search-candidates"))
    salted = candidates.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    best = _first(_first(salted, ["item_id", "salt"], k).drop("rank"), ["item_id"], k)
    return best.select("item_id", "rank", "doc_id", "score")


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)
