"""Document quality by a byte-level convolutional network in numpy.

Bytes are embedded, filters of 8 bytes slide over them by 4, and their
responses are max-pooled in chunks of 512 bytes that overlap by one filter
step, so that every window of the whole document lies in a chunk.  The chunks'
pooled responses are averaged (by their number of windows) and combined into
one probability.

The network is learned with Adam on the driver from a bounded, documented
sample of labelled documents, each whole: at most ``SAMPLE_DOCUMENTS`` of them
(those with the least hash of their id) and ``SAMPLE_BYTES`` bytes of text (a
document that doesn't fit any more is passed over).  Scoring reads every
document whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import small_batches, written

BLOCK = 4  # bytes of a filter step; a filter spans two
CHUNK_BLOCKS = 128
EMBEDDING = 8
FILTERS = 32
PAD = 256  # stands for the bytes behind a text's end
SAMPLE_DOCUMENTS = 3000
SAMPLE_BYTES = 32 << 20
EPOCHS = 8
SEED = 7
#: Bytes that pass through the network at once.
TILE_BYTES = 1 << 20
#: Chunks that pass through the network at once while it is learned.
TILE_CHUNKS = 1024


def padded(raw: bytes) -> np.ndarray:
    """Byte numbers, padded to whole blocks and by one block more."""
    n = max(BLOCK, -(-len(raw) // BLOCK) * BLOCK) + BLOCK
    out = np.full(n, PAD, dtype=np.int16)
    out[: len(raw)] = np.frombuffer(raw, dtype=np.uint8)
    return out


@dataclass
class Network:
    embedding: np.ndarray  # 257 x EMBEDDING
    filters: np.ndarray  # 2 x (BLOCK * EMBEDDING) x FILTERS: first and second block
    shift: np.ndarray  # FILTERS
    weights: np.ndarray  # FILTERS
    bias: np.ndarray  # 1

    @classmethod
    def fresh(cls, seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        f32 = np.float32
        return cls(
            rng.normal(0, 0.5, (257, EMBEDDING)).astype(f32),
            rng.normal(0, (2 * BLOCK * EMBEDDING) ** -0.5, (2, BLOCK * EMBEDDING, FILTERS)).astype(f32),
            np.zeros(FILTERS, f32),
            rng.normal(0, FILTERS**-0.5, FILTERS).astype(f32),
            np.zeros(1, f32),
        )

    def responses(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embedded blocks and the filters' responses to every window."""
        blocks = self.embedding[symbols].reshape(-1, BLOCK * EMBEDDING)
        return blocks, blocks[:-1] @ self.filters[0] + blocks[1:] @ self.filters[1] + self.shift

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1 of each text; texts are joined in tiles of
        about TILE_BYTES, and a longer text passes in parts."""
        logits = np.zeros(len(texts), dtype=np.float64)
        totals = np.zeros(len(texts), dtype=np.float64)
        tile, owners, size = [], [], 0

        def run() -> None:
            lengths = np.array([len(t) // BLOCK for t in tile])
            starts = np.cumsum(lengths) - lengths
            _, out = self.responses(np.concatenate(tile))
            begins, ends, owner = [], [], []
            for start, n, who in zip(starts.tolist(), lengths.tolist(), owners, strict=True):
                for at in range(0, n - 1, CHUNK_BLOCKS - 1):
                    begins.append(start + at)
                    ends.append(start + min(at + CHUNK_BLOCKS, n) - 1)
                    owner.append(who)
            # windows [begin, end) of each chunk; the gaps between are dropped
            cuts = np.array([begins, ends]).T.reshape(-1)
            last = cuts[-1] >= len(out)
            pooled = np.maximum(np.maximum.reduceat(out, cuts[: -1 if last else None], axis=0)[::2], 0)
            n = np.array(ends) - np.array(begins)
            np.add.at(logits, owner, n * (pooled @ self.weights))
            np.add.at(totals, owner, n)

        part = TILE_BYTES // BLOCK // (CHUNK_BLOCKS - 1) * (CHUNK_BLOCKS - 1) * BLOCK
        for i, raw in enumerate(texts):
            symbols = padded(raw)
            for at in range(0, len(symbols) - BLOCK, part):  # parts end where a chunk does
                tile.append(symbols[at : at + part + BLOCK])
                owners.append(i)
                size += len(tile[-1])
                if size >= TILE_BYTES:
                    run()
                    tile, owners, size = [], [], 0
        if tile:
            run()
        z = logits / np.maximum(totals, 1) + float(self.bias[0])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def chunks_of(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A text's chunks, each a row filled up with padding, and their numbers of
    windows."""
    begins = range(0, max(1, -(-len(raw) // BLOCK)) * BLOCK, (CHUNK_BLOCKS - 1) * BLOCK)
    rows = np.full((len(begins), CHUNK_BLOCKS * BLOCK), PAD, dtype=np.int16)
    for row, at in zip(rows, begins, strict=True):
        part = raw[at : at + len(row)]
        row[: len(part)] = np.frombuffer(part, dtype=np.uint8)
    left = -(-(len(raw) - np.array(begins)) // BLOCK)
    return rows, np.clip(left, 1, CHUNK_BLOCKS - 1)


def gradients(net: Network, symbols: np.ndarray, windows: np.ndarray, who: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean logistic loss of some documents in the order of
    the network's parameters; ``who`` owns each chunk.  Chunks pass in tiles,
    so memory doesn't grow with a document."""
    tiles = [slice(at, at + TILE_CHUNKS) for at in range(0, len(symbols), TILE_CHUNKS)]
    top, best = [], []
    for tile in tiles:
        blocks = net.embedding[symbols[tile]].reshape(-1, CHUNK_BLOCKS, BLOCK * EMBEDDING)
        out = blocks[:, :-1] @ net.filters[0] + blocks[:, 1:] @ net.filters[1] + net.shift
        out[np.arange(CHUNK_BLOCKS - 1) >= windows[tile][:, None]] = -np.inf
        best.append(out.argmax(axis=1))  # chunks x filters
        top.append(np.take_along_axis(out, best[-1][:, None, :], 1)[:, 0])
    top = np.concatenate(top)
    share = (windows / np.bincount(who, windows)[who]).astype(np.float32)[:, None]
    feature = np.zeros((len(labels), FILTERS), net.weights.dtype)
    np.add.at(feature, who, share * np.maximum(top, 0))
    p = 1 / (1 + np.exp(-np.clip(feature @ net.weights + net.bias[0], -30, 30)))
    error = ((p - labels) / len(labels)).astype(net.weights.dtype)
    d_top = error[who][:, None] * share * net.weights * (top > 0)
    d_filters, d_embedding = np.zeros_like(net.filters), np.zeros_like(net.embedding)
    for tile, at in zip(tiles, best, strict=True):
        s, d = symbols[tile], d_top[tile]
        row = np.arange(len(s))[:, None, None]
        for k in (0, 1):
            read = s[row, (at + k)[:, :, None] * BLOCK + np.arange(BLOCK)]  # chunks x filters x bytes
            block = net.embedding[read].reshape(len(s), FILTERS, BLOCK * EMBEDDING)
            d_filters[k] += np.einsum("rf,rfb->bf", d, block)
            d_block = d[:, :, None] * net.filters[k].T[None]
            np.add.at(d_embedding, read, d_block.reshape(len(s), FILTERS, BLOCK, EMBEDDING))
    return [d_embedding, d_filters, d_top.sum(axis=0), error @ feature, error.sum(keepdims=True)]


def learn(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """Network learned from whole documents and their labels 0 or 1, by Adam on
    the logistic loss of small groups of documents.  With one label only, or
    none, the network's answer is that label's rate."""
    net = Network.fresh(seed)
    rate = (labels.sum() + 1) / (len(labels) + 2)
    net.bias[0] = np.log(rate / (1 - rate))
    if len(np.unique(labels)) < 2:
        net.weights[:] = 0
        return net
    parameters = [net.embedding, net.filters, net.shift, net.weights, net.bias]
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    rng, step, size = np.random.default_rng(seed), 0, 32
    total = epochs * -(-len(labels) // size)
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), size):
            docs = order[at : at + size]
            own = [chunks_of(texts[d]) for d in docs]
            who = np.repeat(np.arange(len(docs)), [len(rows) for rows, _ in own])
            symbols, windows = (np.concatenate(x) for x in zip(*own, strict=True))
            step += 1
            pace = 0.004 * (1 - step / (total + 1))
            for q, g, m, v in zip(parameters, gradients(net, symbols, windows, who, labels[docs]), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                q -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def held_out(doc_id: Column, modulus: int = 4, remainder: int = 2) -> Column:
    """Whether a document's label is kept from learning: crc32 of its id as
    text (null: as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def learn_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", documents: int = SAMPLE_DOCUMENTS, max_bytes: int = SAMPLE_BYTES) -> Network:
    """Network for ``labels.<label>`` from at most ``documents`` labelled
    documents that aren't held out, whole and of ``max_bytes`` bytes together.
    Rows without id or label are ignored; of several labels of a document the
    largest counts, of several texts of an id the least, null as empty.  Only
    the sample reaches the driver."""
    spark = docs.sparkSession
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    ids = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents).collect()  # ids and labels only
    ids = F.broadcast(spark.createDataFrame(ids, f"doc_id {labels.schema['doc_id'].dataType.simpleString()}, label int"))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    found = docs.select("doc_id", text.alias("text")).join(ids, "doc_id")
    found = written(found.groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text")), "sample")
    chosen, left = [], max_bytes
    for r in found.select("doc_id", F.octet_length("text").alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect():
        if r.n <= left:
            chosen.append((r.doc_id,))
            left -= r.n
    chosen = F.broadcast(spark.createDataFrame(chosen, found.select("doc_id").schema))
    rows = found.join(chosen, "doc_id").orderBy("doc_id").collect()
    return learn([bytes(r.text) for r in rows], np.array([float(r.label > 0) for r in rows]))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score (probability of quality label 1) and predicted
    (1 from ``threshold`` on) of every document, one row per row, in place.

    Only the text enters a score.  Null text is empty; an empty text is one
    window of padding.  Without labels the score is 0.5, with one label that
    label's smoothed rate.  Null and repeated ids pass through, other columns
    are ignored, an empty table gives an empty table.
    """
    network = learn_quality(docs, labels)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 8 << 20):
            scores = network.score([(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"])

    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    scored = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
