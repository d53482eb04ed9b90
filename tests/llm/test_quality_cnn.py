import zlib

import numpy as np
import pytest

from dimweave.llm import quality_cnn as Q
from dimweave.llm.queries import QUERIES

from .conftest import SF


def auc(scores, labels):
    pos, neg = scores[labels == 1], scores[labels == 0]
    return np.mean([(p > neg).mean() + (p == neg).mean() / 2 for p in pos])


def logit_by_definition(net, raw):
    """Windows of two blocks, pooled per chunk of windows, averaged by count."""
    s = Q.padded(raw)
    e = [net.embedding[s[i : i + 2 * Q.BLOCK]].reshape(2, -1) for i in range(0, len(s) - Q.BLOCK, Q.BLOCK)]
    out = np.array([w[0] @ net.filters[0] + w[1] @ net.filters[1] + net.shift for w in e])
    total = 0.0
    for at in range(0, len(out), Q.CHUNK_BLOCKS - 1):
        chunk = out[at : at + Q.CHUNK_BLOCKS - 1]
        total += len(chunk) * float(np.maximum(chunk.max(axis=0), 0) @ net.weights)
    return total / len(out) + float(net.bias[0])


def test_scores_follow_the_definition(monkeypatch):
    rng = np.random.default_rng(1)
    net = Q.Network.fresh()
    texts = [b"", b"a", b"abcdefg", bytes(rng.integers(0, 256, 5000, dtype=np.uint8)), b"x" * 511, b"y" * 512, b"z" * 1700]
    want = [1 / (1 + np.exp(-logit_by_definition(net, t))) for t in texts]
    assert np.allclose(net.score(texts), want, atol=1e-5)
    monkeypatch.setattr(Q, "TILE_BYTES", 1024)  # long texts pass in parts
    assert np.allclose(net.score(texts), want, atol=1e-5)
    assert len(net.score([])) == 0


def test_chunks_cover_every_window_of_whole_texts():
    net = Q.Network.fresh()
    for n in (0, 1, 4, 5, 507, 508, 509, 512, 513, 1016, 1017, 5000):
        raw = bytes(np.random.default_rng(n).integers(0, 256, n, dtype=np.uint8))
        rows, windows = Q.chunks_of(raw)
        total = 0.0
        for row, w in zip(rows, windows, strict=True):
            blocks = net.embedding[row].reshape(Q.CHUNK_BLOCKS, -1)
            out = (blocks[:-1] @ net.filters[0] + blocks[1:] @ net.filters[1] + net.shift)[:w]
            total += w * float(np.maximum(out.max(axis=0), 0) @ net.weights)
        assert windows.sum() == max(1, -(-n // Q.BLOCK))
        assert total / windows.sum() + float(net.bias[0]) == pytest.approx(logit_by_definition(net, raw), abs=1e-4)


def test_gradients_are_those_of_the_loss(monkeypatch):
    monkeypatch.setattr(Q, "TILE_CHUNKS", 3)
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 105, n, dtype=np.uint8)) for n in (0, 30, 700, 3000)]
    labels = np.array([1.0, 0.0, 1.0, 0.0])
    net = Q.Network.fresh()
    names = ["embedding", "filters", "shift", "weights", "bias"]
    for name in names:
        setattr(net, name, getattr(net, name).astype(np.float64))

    def loss():
        z = np.array([logit_by_definition(net, t) for t in texts])
        return float(np.mean(np.log1p(np.exp(z)) - labels * z))

    own = [Q.chunks_of(t) for t in texts]
    who = np.repeat(np.arange(4), [len(rows) for rows, _ in own])
    symbols, windows = (np.concatenate(x) for x in zip(*own, strict=True))
    for name, gradient in zip(names, Q.gradients(net, symbols, windows, who, labels), strict=True):
        values = getattr(net, name).reshape(-1)
        for k in np.argsort(-np.abs(gradient.reshape(-1)))[:3].tolist():
            before, step = values[k], 1e-6
            values[k] = before + step
            up = loss()
            values[k] = before - step
            down = loss()
            values[k] = before
            assert gradient.reshape(-1)[k] == pytest.approx((up - down) / (2 * step), rel=1e-3, abs=1e-7)


def test_sample_is_whole_documents_within_the_bytes(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "x" * n) for i, n in enumerate([2000, 10, 900, 5000, 40])] + [(5, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, quality int")
    seen = {}
    monkeypatch.setattr(Q, "learn", lambda texts, own: seen.update(texts=texts, labels=own))
    open_ids = [i for i in range(6) if zlib.crc32(str(i).encode()) % 4 != 2]
    Q.learn_quality(docs, labels)
    assert sorted(map(len, seen["texts"])) == sorted([2000, 10, 900, 5000, 40, 0][i] for i in open_ids)
    Q.learn_quality(docs, labels, max_bytes=3000)
    assert sum(map(len, seen["texts"])) <= 3000 and len(seen["texts"]) == len(seen["labels"]) > 0
    assert 5000 not in map(len, seen["texts"])


def test_held_out_ranking(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op5_quality_cnn"](spark, sf).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got.values())
    mine = [(got[d].score, q) for d, q in labels.items() if got[d].held_out]
    scores, truth = map(np.array, zip(*mine, strict=True))
    assert auc(scores, truth) > 0.95
    assert ((scores >= 0.7) == (truth == 1)).mean() > 0.95


def test_odd_tables(spark, odd, nothing, repeated):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(12)] + [(3, None, 1), (None, 1, 1), (4, 1, 0)], "doc_id long, quality int, toxic int")
    rows = Q.quality_scores(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r.score for r in rows}
    assert by_id[0] == by_id[1] and by_id[14] == by_id[15]
    assert Q.quality_scores(nothing, labels).count() == 0
    none = Q.quality_scores(repeated, labels.limit(0)).collect()
    assert [r.score for r in none] == pytest.approx([0.5] * len(none))
    one = Q.quality_scores(repeated, spark.createDataFrame([(1, 1, 0), (3, 1, 0)], labels.schema)).collect()
    assert len({r.score for r in one}) == 1 and one[0].score > 0.5
