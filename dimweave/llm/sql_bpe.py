"""Byte-level BPE encoding and decoding by recursive SQL in every partition.

Each task holds a DuckDB connection with two tables made from the rank file:
``merges`` (left id, right id, merged id; the merged id is also the rank) and
``pieces`` (id, bytes).  The distinct pre-tokens of a batch become rows (word,
position, token id).  One recursive query contracts in each step the leftmost
pair of least rank of every word, found by joining neighbouring positions with
``merges``, until no word has a pair left.  Ids are decoded by joining them
with ``pieces`` and aggregating the pieces in order.

A pre-token that is itself a vocabulary entry is that entry, as in the
tiktoken library, which also says which characters are letters, numbers and
white space: Unicode tables differ between libraries and their versions.

Long pre-tokens are cut into segments.  Ids are what a word contracts to if
and only if every two neighbours are what their joined bytes contract to:
until a merge crosses a boundary, the steps inside the two neighbours are the
same in the word and in the two alone, and so is the first step that crosses.
So segments are contracted on their own, the pairs at their seams are
contracted, too, and segments whose pair doesn't stay as it is are joined and
contracted again, until all seams hold.
"""

from __future__ import annotations

import base64
import hashlib
import os
import tempfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import small_batches, worker_model
from dimweave.llm.word_ids import CACHE_ENTRIES, END, LETTER, NUMBER, OTHER, SPACE, Words, WordTable, contractions, joined_points

#: Symbols that one recursive query starts from, and rows it may pile up.
QUERY_SYMBOLS = 200_000
QUERY_ROWS = 2_000_000


@dataclass(frozen=True)
class Limits:
    """What one worker's model may hold: remembered words, symbols and rows of
    a recursive query, DuckDB's memory, bytes of text in a batch."""

    entries: int = CACHE_ENTRIES
    symbols: int = QUERY_SYMBOLS
    rows: int = QUERY_ROWS
    duckdb_mb: int = 256
    batch_bytes: int = 2 << 20


#: For stages of a pipeline, whose executors still hold what the stages before
#: have left: some 240 MB less a worker, for a third more time.
FRUGAL = Limits(entries=200_000, symbols=50_000, rows=500_000, duckdb_mb=96, batch_bytes=512 << 10)
#: Longer words (bytes) are cut into segments of ``SEGMENT`` bytes.
LONG_WORD = 64
SEGMENT = 12
#: Longer joined segments go through the query that contracts many pairs a step.
LONG_SEGMENT = 1024
#: Ids that one query decodes.
DECODE_IDS = 1_000_000

_STEP = """
WITH RECURSIVE state AS (
    SELECT w, pos, id, 0 AS step FROM symbols
    UNION ALL
    (WITH best AS (
        SELECT a.w, min(m.merged::BIGINT << 32 | a.pos) AS least
        FROM state a
        JOIN state b ON b.w = a.w AND b.pos = a.pos + 1
        JOIN merges m ON m.l = a.id AND m.r = b.id
        GROUP BY a.w)
     SELECT s.w,
            CASE WHEN s.pos > (least & 4294967295) THEN s.pos - 1 ELSE s.pos END,
            CASE WHEN s.pos = (least & 4294967295) THEN (least >> 32)::INTEGER ELSE s.id END,
            s.step + 1
     FROM state s JOIN best USING (w)
     WHERE s.pos <> (least & 4294967295) + 1 AND s.step < $steps)
)
SELECT w, pos, id, step FROM state
JOIN (SELECT w, max(step) AS step FROM state GROUP BY w) USING (w, step)
"""

# As above, but all occurrences of the least pair in one step, left to right
# without overlap, where no vocabulary entry that begins or ends with the
# merged one has a lower rank: then the steps that contract them one by one
# follow each other anyway.
_STEP_LONG = """
WITH RECURSIVE state AS (
    SELECT w, pos, id, 0 AS step FROM symbols
    UNION ALL
    (WITH pairs AS (
        SELECT a.w, a.pos, m.merged, m.alone
        FROM state a
        JOIN state b ON b.w = a.w AND b.pos = a.pos + 1
        JOIN merges m ON m.l = a.id AND m.r = b.id),
     best AS (SELECT w, min(merged) AS merged, min(merged::BIGINT << 32 | pos) & 4294967295 AS leftmost FROM pairs GROUP BY w),
     runs AS (
        SELECT p.w, p.pos, p.merged, p.pos - row_number() OVER (PARTITION BY p.w ORDER BY p.pos) AS run
        FROM pairs p JOIN best USING (w, merged)
        WHERE p.alone OR p.pos = leftmost),
     cut AS (
        SELECT w, pos, merged FROM (SELECT *, row_number() OVER (PARTITION BY w, run ORDER BY pos) AS nth FROM runs)
        WHERE nth % 2 = 1),
     marked AS (
        SELECT s.w, s.pos, coalesce(c.merged, s.id) AS id, s.step,
               lag(c.pos IS NOT NULL, 1, false) OVER (PARTITION BY s.w ORDER BY s.pos) AS gone
        FROM state s JOIN best USING (w) LEFT JOIN cut c ON c.w = s.w AND c.pos = s.pos
        WHERE s.step < $steps)
     SELECT w, (row_number() OVER (PARTITION BY w ORDER BY pos))::INTEGER - 1, id, step + 1
     FROM marked WHERE NOT gone)
)
SELECT w, pos, id, step FROM state
JOIN (SELECT w, max(step) AS step FROM state GROUP BY w) USING (w, step)
"""

_DECODE = "SELECT d, string_agg(piece, '' ORDER BY p) AS piece FROM ids JOIN pieces USING (id) GROUP BY d"


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line.strip())}


def character_kinds() -> bytes:
    """The class of every code point as the tiktoken library's own patterns
    see it (compressed: one byte a code point)."""
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    points = np.array([c for c in range(0x110000) if not 0xD800 <= c < 0xE000], dtype="<u4")
    text = points.tobytes().decode("utf-32-le")
    kinds = np.full(0x110000, OTHER, dtype=np.uint8)
    for kind, pattern in ((SPACE, r"\s"), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        library = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        matched = bytes(library.encode_ordinary(text)).decode()  # what doesn't match gives no ids
        kinds[np.frombuffer(matched.encode("utf-32-le"), dtype="<u4")] = kind
    return zlib.compress(kinds.tobytes())


class SqlBpe:
    """One task's connection, tables and remembered words."""

    def __init__(self, ranks: dict[bytes, int], kinds: bytes, limits: Limits = Limits()):
        import duckdb

        self.ranks, self.limits = ranks, limits
        self.kinds = np.frombuffer(zlib.decompress(kinds), dtype=np.uint8)
        self.words = WordTable(self.learn, limits.entries)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.names = [str(i) for i in range(max(ranks.values()) + 1)]
        spill = os.path.join(tempfile.gettempdir(), f"bpe-spill-{os.getpid()}")
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": f"{limits.duckdb_mb}MB", "temp_directory": spill})
        least = {}  # of the entries that begin or end with an entry, the least rank
        left, right, whole = [], [], []
        for piece, rank in ranks.items():
            for i in range(1, len(piece)):
                a, b = piece[:i], piece[i:]
                if a in ranks and b in ranks:
                    left.append(ranks[a])
                    right.append(ranks[b])
                    whole.append(rank)
                    for part in (a, b):
                        least[part] = min(rank, least.get(part, rank))
        alone = {rank: least.get(piece, rank + 1) > rank for piece, rank in ranks.items()}
        i32 = pa.int32()
        self.load("merges", pa.table({"l": pa.array(left, i32), "r": pa.array(right, i32), "merged": pa.array(whole, i32), "alone": pa.array([alone[r] for r in whole])}))
        # bytes as characters 0 to 255
        self.load("pieces", pa.table({"id": pa.array(ranks.values(), i32), "piece": [p.decode("latin-1") for p in ranks]}))
        self.pieces = {rank: piece for piece, rank in ranks.items()}

    def load(self, name: str, rows: pa.Table) -> None:
        self.db.register("incoming", rows)
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def contract(self, words: list[bytes], query: str = _STEP) -> list[np.ndarray]:
        """Token ids of each word at the fixpoint."""
        lengths = np.array([len(w) for w in words])
        w = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        pos = (np.arange(len(w)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
        ids = self.single[np.frombuffer(b"".join(words), dtype=np.uint8)]
        done: list[np.ndarray] = [ids[:0]] * len(words)
        while len(w):
            self.load("symbols", pa.table({"w": w, "pos": pos, "id": ids}))
            steps = max(1, min(QUERY_ROWS, self.limits.rows) // len(w))
            out = self._ordered(query, steps)
            ow, opos, oids, ostep = (out.column(c).to_numpy() for c in ("w", "pos", "id", "step"))
            open_ = ostep == steps  # more pairs may be left
            starts = np.flatnonzero(np.diff(ow, prepend=-1))
            ends = np.append(starts[1:], len(ow))
            closed = ~open_[starts]
            for word, begin, end in zip(ow[starts[closed]].tolist(), starts[closed].tolist(), ends[closed].tolist(), strict=True):
                done[word] = oids[begin:end]
            w, pos, ids = ow[open_], opos[open_], oids[open_]
        return done

    def _ordered(self, query: str, steps: int) -> pa.Table:
        text = query.replace("$steps", str(int(steps)))
        return self.db.sql(f"SELECT w, pos, id, step FROM ({text}) ORDER BY w, pos").to_arrow_table()

    def contracted(self, words: list[bytes]) -> list[np.ndarray]:
        """``contract`` in queries of a bounded number of symbols."""
        out: list[np.ndarray] = [self.single[:0]] * len(words)
        short, size = [], 0
        for i, word in enumerate(words):
            if len(word) > LONG_SEGMENT:
                out[i] = self.contract([word], _STEP_LONG)[0]
                continue
            short.append(i)
            size += len(word)
            if size >= self.limits.symbols or i + 1 == len(words):
                for k, ids in zip(short, self.contract([words[k] for k in short]), strict=True):
                    out[k] = ids
                short, size = [], 0
        if short:
            for k, ids in zip(short, self.contract([words[k] for k in short]), strict=True):
                out[k] = ids
        return out

    def contracted_long(self, word: bytes) -> np.ndarray:
        """The ids of one long word, by segments."""
        segments = [word[i : i + SEGMENT] for i in range(0, len(word), SEGMENT)]
        ids = self.contracted(segments)
        holds: dict[tuple[int, int], bool] = {}
        while True:
            seams = [(int(a[-1]), int(b[0])) for a, b in zip(ids, ids[1:], strict=False)]
            new = [pair for pair in dict.fromkeys(seams) if pair not in holds]
            joined = self.contracted([self.pieces[a] + self.pieces[b] for a, b in new])
            holds.update({pair: own.tolist() == list(pair) for pair, own in zip(new, joined, strict=True)})
            if all(holds[pair] for pair in seams):
                return np.concatenate(ids)
            cuts = [0, *(i + 1 for i, pair in enumerate(seams) if holds[pair]), len(segments)]
            groups = list(zip(cuts, cuts[1:], strict=False))
            again = [(a, b) for a, b in groups if b - a > 1]
            fresh = dict(zip(again, self.contracted([b"".join(segments[a:b]) for a, b in again]), strict=True))
            ids = [fresh[g] if g in fresh else ids[g[0]] for g in groups]
            segments = [b"".join(segments[a:b]) for a, b in groups]

    def learn(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        short = []
        for i, word in enumerate(words):
            if (rank := self.ranks.get(word)) is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(word) > LONG_WORD:
                out[i] = self.contracted_long(word).astype("<i4").tobytes()
            else:
                short.append(i)
        for i, ids in zip(short, self.contracted([words[i] for i in short]), strict=True):
            out[i] = ids.astype("<i4").tobytes()
        return out

    def split(self, texts: list[str | None]) -> tuple[Words, np.ndarray]:
        """The texts' pre-tokens, and where each text's begin (and the last
        one's end): the matches of public_tokenizers.PATTERN, found by the
        characters' classes."""
        points, begins = joined_points(texts)
        kinds = self.kinds[points]
        kinds[begins[1:] - 1] = END
        before = np.concatenate(([END], kinds[:-1])).astype(np.uint8)
        after = np.append(kinds[1:], np.uint8(END))
        space, blank = kinds == SPACE, points == 0x20
        blank[begins[1:] - 1] = False
        after_blank = np.concatenate(([False], blank[:-1]))
        # a run of white space keeps all but its last character, unless the
        # text ends there; a last blank begins the next pre-token
        starts = np.where(space, (before != SPACE) | ((after != SPACE) & (after != END)), (before != kinds) & ~after_blank)
        kept = kinds != END
        starts &= kept
        contractions(points, kinds, starts)
        word_begins = np.concatenate(([0], np.cumsum(starts)))[begins]
        return Words(points[kept], starts[kept]), word_begins

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's begin (and the last end)."""
        return self.words.ids(*self.split(texts))

    def decimal(self, ids: np.ndarray) -> str:
        return ",".join(map(self.names.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray, begins: np.ndarray) -> list[bytes]:
        """The bytes that each text's ids stand for."""
        out = [b""] * (len(begins) - 1)
        text = np.repeat(np.arange(len(out), dtype=np.int32), np.diff(begins))
        for at in range(0, len(ids), DECODE_IDS):
            own = ids[at : at + DECODE_IDS]
            self.load("ids", pa.table({"d": text[at : at + DECODE_IDS], "p": np.arange(len(own), dtype=np.int32), "id": own}))
            rows = self.db.sql(_DECODE).to_arrow_table()
            for d, piece in zip(rows.column("d").to_pylist(), rows.column("piece").to_pylist(), strict=True):
                out[d] += piece.encode("latin-1")
        return out


def task_model(ranks_file: bytes, kinds: bytes, limits: Limits) -> SqlBpe:
    """The worker's model for a rank file's content."""
    key = ("bpe", hashlib.sha256(ranks_file).hexdigest(), limits)
    return worker_model(key, lambda: SqlBpe(parse_ranks(ranks_file), kinds, limits))


def _round_trip(ranks_file: bytes, pattern: str, outputs, limits: Limits = Limits()):
    if pattern != public_tokenizers.PATTERN:
        raise ValueError("pre-tokens are split by the classes of public_tokenizers.PATTERN")
    kinds = character_kinds()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = task_model(ranks_file, kinds, limits)
        for batch in small_batches(batches, "text", limits.batch_bytes):
            ids, begins = model.encode(batch.column("text").to_pylist())
            yield outputs(model, batch, ids, begins, model.decode(ids, begins))

    return run


def _digests(model: SqlBpe, batch: pa.RecordBatch, ids: np.ndarray, begins: np.ndarray, decoded: list[bytes]) -> pa.RecordBatch:
    own = [ids[a:b] for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.array(np.diff(begins).astype(np.int64)),
            pa.array([hashlib.sha256(model.decimal(i).encode()).hexdigest() for i in own]),
            pa.array([hashlib.sha256(raw).hexdigest() for raw in decoded]),
        ],
        ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    )


def _rank_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def bpe_round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas),
    decoded_sha256 (of the decoded bytes): one row per row, in place, without
    a shuffle.

    Null text is empty: no ids, digests of nothing.  Null and repeated ids pass
    through; other columns are ignored; an empty table gives an empty table.
    Memory is bounded by a batch of text (``Limits.batch_bytes``, or one longer text), the
    remembered words and DuckDB's limit (beyond it, the task's temp folder).
    The work grows in proportion to a text's length, also where it is one
    pre-token: that is cut into segments.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    run = _round_trip(_rank_file(ranks_path), pattern, _digests)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, limits: Limits = FRUGAL) -> DataFrame:
    """The documents with their columns, ``text`` decoded from its ids, and
    n_tokens and token_ids (which replace columns of these names).  Null text
    has no ids and stays null; otherwise as ``bpe_round_trip``."""
    kept = [c for c in docs.columns if c.lower() not in ("text", "n_tokens", "token_ids")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), "text")

    def outputs(model: SqlBpe, batch: pa.RecordBatch, ids: np.ndarray, begins: np.ndarray, decoded: list[bytes]) -> pa.RecordBatch:
        known = batch.column("text").is_valid().to_pylist()
        return pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                pa.array([raw.decode("utf-8", "surrogatepass") if k else None for k, raw in zip(known, decoded, strict=True)], pa.string()),
                pa.array(np.diff(begins).astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(ids.astype(np.int32))),
            ],
            ["row", "text", "n_tokens", "token_ids"],
        )

    kind = rows.schema["row"].dataType.simpleString()
    out = rows.mapInArrow(_round_trip(_rank_file(ranks_path), pattern, outputs, limits), f"row {kind}, text string, n_tokens long, token_ids array<int>")
    names = [c for c in docs.columns if c.lower() not in ("n_tokens", "token_ids")]
    return out.select(*["text" if c.lower() == "text" else F.col(f"row.`{c}`").alias(c) for c in names], "n_tokens", "token_ids")
