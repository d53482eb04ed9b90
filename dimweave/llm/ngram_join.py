"""N-gram Jaccard join with token-combination prefixes.

Documents are sets of 5-word shingles (64-bit hashes); two link when their
Jaccard similarity is at least 0.8.  A set with n shingles can miss at most
d = n - ceil(0.8 n) of them in any partner.

1. Every task cuts its documents' shingles into packed buckets by hash (as many
   as their number asks for); one task per bucket counts in how many documents
   each shingle is, and sends back, per document, those that others have too.
   Shingles of very many documents would fill a bucket of their own: they are
   found before, by counts that each task takes of its documents, and go
   straight to their documents' buckets.  Their counts are lower bounds, which
   is enough: any order that all documents agree on will do for the prefixes.
2. A document with more than d shingles of its own has no partner.  The others
   order their shared shingles from rare to frequent and index a prefix.  Rare
   shingles are indexed singly.  Frequent ones fall into groups by hash, the
   prefix is extended by one shingle per group, and all pairs of one group are
   indexed: a partner shares a rare shingle or, by the pigeonhole principle,
   two frequent ones of a group.  The number of groups follows the size class
   of the smaller of the two sets, so a document indexes a number of pairs in
   proportion to its prefix.
3. Documents with a common signature are compared with the signature's leader
   (the one whose shingles are the most shared), and the links found give
   components.  Documents of one leader that are still apart are compared with
   each other in blocks.  Pairs within a component need no comparison, so a
   group of copies costs one comparison per copy.

Exact copies (equal sets) are one set from step 2 on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import release_memory, small_batches, written

SHINGLE = 5
#: Documents a shingle must be in to count as frequent.
FREQUENT = 16
#: Signature groups for frequent shingles: one per so many shingles.
GROUP_SHINGLES = 32
#: Members of a leader that are compared with each other at once.
BLOCK = 512
#: Shingles that a task gathers before it sends them off.
FLUSH_SHINGLES = 1_000_000
#: Shingles of all documents per bucket (more buckets are used beyond it).
BUCKET_SHINGLES = 4_000_000
#: Documents of one flush that make a task count a shingle for the hot ones.
HOT_IN_FLUSH = 4
#: Documents from which a shingle is hot; hot ones are at most so many (the
#: bound of documents rises where needed), 16 bytes each.
HOT_DOCUMENTS = 1_000_000
HOT_SHINGLES = 1_000_000

# Odd multipliers for the words of a shingle.
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if 0x09 <= b <= 0x0D else b for b in range(256))
_LOW_48 = np.uint64((1 << 48) - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[0]
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None) -> np.ndarray:
    """Distinct shingle hashes of a text, ascending.  Words are runs without
    ASCII white space, A-Z lower-cased; a text of fewer than five words is one
    shingle, one without words none."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    k = min(SHINGLE, len(words))
    m = len(words) - k + 1
    x = np.full(m, k, dtype=np.uint64)
    for i in range(k):
        x += h[i : i + m] * _ODD[i]
    return np.unique(mixed(x))


def most_missing(n: np.ndarray) -> np.ndarray:
    """Shingles that a partner of a set of n may lack: n - ceil(0.8 n)."""
    return n + (-4 * n) // 5


def _bucket(x: np.ndarray, n: int) -> np.ndarray:
    if n <= 1 << 16:
        return ((x >> np.uint64(48)) * np.uint64(n) >> np.uint64(16)).astype(np.uint16)
    return ((x >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.uint32)


def _home(nodes: np.ndarray, n: int) -> np.ndarray:
    return _bucket(mixed(nodes.astype(np.uint64) * _ODD[1]), n)


# Rows of packed arrays.  node, size: documents whose home is this bucket;
# owner, count: documents and how many of the following shingles are theirs;
# low, high: the shingles' lower 48 bits (the bucket they come from stands for
# the upper ones); df: in how many documents each is, source: the bucket they
# come from (both null until they are counted).  Hot shingles come from a bucket
# behind the last one, as their places in the list of hot ones.
_PACKED = "bucket int, source int, node binary, size binary, owner binary, count binary, low binary, high binary, df binary"
_BINARY = ("node", "size", "owner", "count", "low", "high", "df")
_SCHEMA = pa.schema([("bucket", pa.int32()), ("source", pa.int32()), *((c, pa.binary()) for c in _BINARY)])


def _packed(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)]


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and length of the runs of equal entries of a sorted array."""
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, dtype=np.int64)
    return first, np.diff(first, append=len(values))


def _slices(values: np.ndarray, wanted: np.ndarray) -> list[slice]:
    """Where each of the wanted entries is in a sorted array."""
    begin, end = np.searchsorted(values, wanted), np.searchsorted(values, wanted, side="right")
    return [slice(a, b) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]


def _by_owner(owner: np.ndarray, tokens: np.ndarray) -> list[bytes]:
    """owner, count, low and high of shingles that are sorted by owner."""
    first, count = _runs(owner)
    columns = (owner[first], count.astype("<u4"), tokens.astype("<u4"), (tokens >> np.uint64(32)).astype("<u2"))
    return [c.tobytes() for c in columns]


def _flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Documents (their nodes and sets) with about FLUSH_SHINGLES shingles."""
    nodes, sets, held = [], [], 0
    for batch in small_batches(batches, "text", 4 << 20):
        for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist(), strict=True):
            nodes.append(node)
            sets.append(shingles(text))
            held += len(sets[-1])
        if held >= FLUSH_SHINGLES:
            yield nodes, sets
            nodes, sets, held = [], [], 0
    if nodes:
        yield nodes, sets


def _often(least: int):
    """Of every flush the number of its shingles (token null) and the shingles
    that at least so many of its documents have, with that number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _flushes(batches):
            tokens = np.sort(np.concatenate(sets))
            first, n = _runs(tokens)
            often = n >= least
            found = tokens[first[often]].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *found.tolist()], pa.int64()), pa.array([len(tokens), *n[often].tolist()], pa.int64())], ["token", "n"]
            )

    return run


def hot_shingles(rows: DataFrame, in_flush: int, documents: int, shingles_at_most: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of all shingles of rows (node, text), summed over documents; the
    hot ones, ascending, and in how many documents they are at least.  Found
    are all that average ``in_flush`` documents a flush or more; as the counts
    add up to no more than that number, at most ``shingles_at_most`` are hot."""
    counts = written(rows.mapInArrow(_often(in_flush), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")), "often")
    total = counts.filter("token is null").agg(F.sum("n")).first()[0] or 0
    least = max(documents, -(-total // shingles_at_most))
    hot = counts.filter(F.col("token").isNotNull() & (F.col("n") >= least)).toArrow()
    token, n = (hot.column(c).to_numpy() for c in ("token", "n"))
    token, n = token.astype(np.int64).view(np.uint64), np.minimum(n, 2**31 - 1).astype("<i4")
    order = np.argsort(token)
    return total, token[order], n[order]


def _pack(parts: int, hot):
    """Shingles by their bucket; ``hot`` is the broadcast (tokens, counts) of
    the hot ones, which go to their documents' homes."""

    def sent(nodes: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        hot_tokens, hot_df = hot.value
        ids, sizes = np.array(nodes, dtype=np.int64), np.array([len(s) for s in sets], dtype=np.int64)
        tokens = np.concatenate(sets)
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        home = _home(ids, parts)
        rows = []
        if len(hot_tokens):
            place = np.minimum(np.searchsorted(hot_tokens, tokens), len(hot_tokens) - 1)
            is_hot = hot_tokens[place] == tokens
            place, owner = place[is_hot], doc[is_hot]
            order = np.argsort(home[owner], kind="stable")
            place, owner = place[order], owner[order]
            there = np.unique(home[owner])
            for b, here in zip(there.tolist(), _slices(home[owner], there), strict=True):
                rows.append((b, parts, b"", b"", *_by_owner(ids[owner[here]], place[here].astype(np.uint64)), hot_df[place[here]].tobytes()))
            tokens, doc = tokens[~is_hot], doc[~is_hot]
        where = _bucket(tokens, parts)
        order = np.argsort(where, kind="stable")
        where, tokens, doc = where[order], tokens[order] & _LOW_48, doc[order]
        home_order = np.argsort(home, kind="stable")
        buckets = np.union1d(where, home)
        for b, here, own in zip(buckets.tolist(), _slices(where, buckets), _slices(home[home_order], buckets), strict=True):
            own = home_order[own]
            rows.append((b, None, ids[own].tobytes(), sizes[own].astype("<u4").tobytes(), *_by_owner(ids[doc[here]], tokens[here]), None))
        return pa.RecordBatch.from_arrays(_packed(rows), schema=_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, sets in _flushes(batches):
            yield sent(nodes, sets)

    return run


def _joined(table: pa.Table, column: str, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), dtype=dtype)


def _count(parts: int):
    """Of one bucket's shingles those of several documents, packed by the
    documents' homes; hot ones, which are counted and at home, go on as they
    are."""

    def run(table: pa.Table) -> pa.Table:
        release_memory()
        bucket = table.column("bucket")[0].as_py()
        counted = table.column("df").is_valid()
        hot, table = table.filter(counted), table.filter(pc.invert(counted))
        owner = np.repeat(_joined(table, "owner", "<i8"), _joined(table, "count", "<u4"))
        token = _joined(table, "high", "<u2").astype(np.uint64) << np.uint64(32) | _joined(table, "low", "<u4")
        order = np.argsort(token)
        token, owner = token[order], owner[order]
        _, df = _runs(token)
        df = np.repeat(df, df)
        shared = df > 1
        token, owner, df = token[shared], owner[shared], df[shared].astype("<i4")
        home = _home(owner, parts)
        order = np.lexsort((owner, home))
        token, owner, df = token[order], owner[order], df[order]
        home = home[order]
        nodes, sizes = (b"".join(table.column(c).to_pylist()) for c in ("node", "size"))
        rows = [(bucket, bucket, nodes, sizes, b"", b"", b"", b"", b"")]
        there = np.unique(home)
        for b, here in zip(there.tolist(), _slices(home, there), strict=True):
            rows.append((b, bucket, b"", b"", *_by_owner(owner[here], token[here]), df[here].tobytes()))
        return pa.concat_tables([pa.Table.from_arrays(_packed(rows), schema=_SCHEMA), hot.cast(_SCHEMA)])

    return run


_SETS = "node long, n long, shared long, score double, copies binary, tokens array<bigint>, dfs array<int>"


def _per_document(table: pa.Table) -> pa.Table:
    """Of every document its size and how many of its shingles others have;
    of those that can have a partner also the shared shingles from rare to
    frequent, and a digest of the set where it has no shingle of its own."""
    release_memory()
    node, size = _joined(table, "node", "<i8"), _joined(table, "size", "<u4").astype(np.int64)
    order = np.argsort(node)
    node, size = node[order], size[order]
    owner, df = np.repeat(_joined(table, "owner", "<i8"), _joined(table, "count", "<u4")), _joined(table, "df", "<i4")
    source = np.repeat(table.column("source").to_numpy().astype(np.uint64), [len(x) // 4 for x in table.column("df").to_pylist()])
    token = source << np.uint64(48) | _joined(table, "high", "<u2").astype(np.uint64) << np.uint64(32) | _joined(table, "low", "<u4")
    order = np.lexsort((token, df, owner))
    owner, token, df = owner[order], token[order], df[order]
    begin, end = np.searchsorted(owner, node), np.searchsorted(owner, node, side="right")
    shared = end - begin
    keep = (size > 0) & (size - shared <= most_missing(size))
    lengths = np.where(keep, shared, 0)
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    wanted = keep[np.searchsorted(node, owner)] if len(owner) else np.zeros(0, dtype=bool)
    token, df = token[wanted], df[wanted]
    copies, score = [], []
    for i in range(len(node)):
        a, b = offsets[i], offsets[i + 1]
        own = token[a:b]
        copies.append(hashlib.blake2b(np.sort(own).tobytes(), digest_size=16).digest() if keep[i] and shared[i] == size[i] else None)
        score.append(float(np.log2(df[a:b]).sum()) / size[i] if b > a else 0.0)
    return pa.Table.from_arrays(
        [
            pa.array(node),
            pa.array(size),
            pa.array(shared.astype(np.int64)),
            pa.array(score, pa.float64()),
            pa.array(copies, pa.binary()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(token.view(np.int64))),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(df)),
        ],
        names=["node", "n", "shared", "score", "copies", "tokens", "dfs"],
    )


def _pairs_within(groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (left < right) of all pairs of equal entries of a sorted array."""
    place = np.arange(len(groups))
    later = np.searchsorted(groups, groups, side="right") - place - 1
    left = np.repeat(place, later)
    return left, left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(later) - later, later)


def prefix_signatures(n: int, tokens: np.ndarray, dfs: np.ndarray) -> np.ndarray:
    """Signatures of a set of n shingles whose shared ones are ``tokens`` (from
    rare to frequent): any two sets that link have one in common."""
    out = []
    needed = int(most_missing(np.int64(n))) + 1 - (n - len(tokens))
    for size_class in range((-(-4 * n // 5)).bit_length(), n.bit_length() + 1):
        groups = max(1, (1 << size_class) // 2 // GROUP_SHINGLES)
        rare = dfs < FREQUENT
        group = (mixed(tokens) % np.uint64(groups)).astype(np.int64)
        # a group's first frequent shingle only extends the prefix
        n_rare = int(rare.sum())
        first = np.zeros(len(tokens), dtype=bool)
        first[n_rare + np.unique(group[n_rare:], return_index=True)[1]] = True
        reach = np.cumsum(~first)
        stop = int(np.searchsorted(reach, needed)) + 1
        prefix, g = tokens[:stop], group[:stop]
        salt = np.uint64(size_class)
        single = prefix[: min(stop, n_rare)]
        out.append(mixed(single * _ODD[2] + salt))
        frequent, g = prefix[n_rare:], g[n_rare:]
        order = np.lexsort((frequent, g))
        frequent = frequent[order]
        left, right = _pairs_within(g[order])
        out.append(mixed(mixed(frequent[left] * _ODD[3] + salt) + frequent[right] * _ODD[4]))
    return np.concatenate(out)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, tokens, dfs = batch.column("n").to_pylist(), batch.column("tokens"), batch.column("dfs")
        found = [prefix_signatures(n[i], tokens[i].values.to_numpy().view(np.uint64), dfs[i].values.to_numpy()) for i in range(batch.num_rows)]
        at = np.repeat(np.arange(batch.num_rows), [len(f) for f in found])
        flat = np.concatenate(found).view(np.int64) if found else np.zeros(0, dtype=np.int64)
        node, score = batch.column("node").to_numpy(), batch.column("score").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(node[at]), pa.array(score[at])], ["signature", "node", "score"])
    release_memory()


def _can_link(a: str, b: str):
    """Whether the sizes and shared shingles of two sets allow a link."""
    return 180 * F.least(f"{a}.shared", f"{b}.shared") >= 80 * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def _block_links(table: pa.Table) -> pa.Table:
    """Links between documents of different components in one pair of blocks."""
    node, n, shared, root = (table.column(c).to_numpy() for c in ("node", "n", "shared", "root"))
    side = table.column("block").to_numpy()
    low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    sets = [np.sort(t.values.to_numpy()) for t in table.column("tokens")]
    left, right = np.flatnonzero(side == low), np.flatnonzero(side == high)
    found = []
    for i in left.tolist():
        ok = (root[right] != root[i]) & (180 * np.minimum(shared[right], shared[i]) >= 80 * (n[right] + n[i]))
        if low == high:
            ok &= node[right] > node[i]
        for j in right[ok].tolist():
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * common >= 80 * (n[i] + n[j] - common):
                found.append((int(node[i]), int(node[j])))
    return pa.table({"u": pa.array([a for a, _ in found], pa.int64()), "v": pa.array([b for _, b in found], pa.int64())})


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of the edges (u, v); root is the smallest node
    that can be reached.  Every round hooks each node to its smallest
    neighbour, follows the hooks to their ends and contracts the edges; the
    rounds' tables are written, so that joins on hot roots can be split."""
    edges = written(edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    roots = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooks = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("root"))
        hooks = written(hooks.select(F.col("u").alias("node"), "root"), "hooks")
        while True:
            onward = hooks.select(F.col("node").alias("root"), F.col("root").alias("further"))
            jumped = written(hooks.join(onward, "root").select("node", F.col("further").alias("root"), (F.col("further") != F.col("root")).alias("moved")), "hooks")
            hooks = jumped.select("node", "root")
            if jumped.filter("moved").isEmpty():
                break
        if roots is None:
            roots = hooks
        else:
            onward = hooks.select(F.col("node").alias("root"), F.col("root").alias("further"))
            roots = written(roots.join(onward, "root", "left").select("node", F.coalesce("further", "root").alias("root")), "roots")
        to = hooks.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        ends = hooks.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        edges = edges.join(to, "u").join(ends, "v").filter("ru <> rv").select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v"))
        edges = written(edges.distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")) if roots is None else roots


def _components_of(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For rows (node, text) with unique nodes: (node, n) of all, and (node,
    root) of those that have a partner or an equal set."""
    spark = rows.sparkSession
    total, *hot = hot_shingles(rows, HOT_IN_FLUSH, HOT_DOCUMENTS, HOT_SHINGLES)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_SHINGLES))
    packed = rows.mapInArrow(_pack(parts, spark.sparkContext.broadcast(hot)), _PACKED)
    shared = packed.groupBy("bucket").applyInArrow(_count(parts), _PACKED)
    sets = written(shared.groupBy("bucket").applyInArrow(_per_document, _SETS), "sets")
    able = sets.filter(F.size("tokens") > 0)
    # equal sets: the smallest node stands for all
    copies = able.filter(F.col("copies").isNotNull()).select("node", "copies")
    first = written(copies.groupBy("copies").agg(F.min("node").alias("root"), F.count(F.lit(1)).alias("m")).filter("m > 1").drop("m"), "copies")
    copies = written(copies.join(first, "copies").filter("node <> root").select("node", "root"), "copies")
    able = written(able.join(copies.select("node"), "node", "left_anti").drop("copies"), "able")

    signatures = written(able.select("node", "n", "score", "tokens", "dfs").mapInArrow(_signatures, "signature long, node long, score double"), "signatures")
    best = F.max(F.struct("score", (-F.col("node")).alias("minus"))).alias("best")
    leaders = signatures.groupBy("signature").agg(best, F.count(F.lit(1)).alias("m")).filter("m > 1")
    leaders = written(leaders.select("signature", (-F.col("best.minus")).alias("leader")), "leaders")
    pairs = written(signatures.join(leaders, "signature").select("node", "leader").filter("node <> leader").distinct(), "pairs")
    facts = able.select("node", "n", "shared", "tokens")
    x = pairs.join(facts, "node").select("leader", F.struct("node", "n", "shared", "tokens").alias("x"))
    y = facts.select(F.col("node").alias("leader"), F.struct("n", "shared", "tokens").alias("y"))
    both = x.join(y, "leader").filter(_can_link("x", "y"))
    common = F.size(F.array_intersect("x.tokens", "y.tokens"))
    links = both.select(F.col("x.node").alias("u"), F.col("leader").alias("v"), common.alias("c"), (F.col("x.n") + F.col("y.n")).alias("s"))
    links = written(links.filter("100 * c >= 80 * (s - c)").select("u", "v"), "links")
    roots = components(links)

    # documents of one leader that are still apart
    members = pairs.unionByName(pairs.select(F.col("leader").alias("node"), "leader").distinct())
    members = members.join(roots, "node", "left").select("leader", "node", F.coalesce("root", "node").alias("root"))
    members = written(members, "members")
    apart = members.groupBy("leader").agg(F.count(F.lit(1)).alias("m"), F.min("root").alias("a"), F.max("root").alias("b"))
    apart = written(apart.filter("a <> b and m > 2").select("leader", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")), "apart")
    blocks = members.join(apart, "leader").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = blocks.select("leader", "node", "root", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    inside = blocks.join(facts, "node").groupBy("leader", "low", "high").applyInArrow(_block_links, "u long, v long")
    more = written(inside, "links")
    if not more.isEmpty():
        roots = components(links.unionByName(more))
    # copies follow the set that stands for them
    copies = copies.join(roots.select(F.col("node").alias("root"), F.col("root").alias("further")), "root", "left")
    own = first.select(F.col("root").alias("node")).join(roots, "node", "left_anti").select("node", F.col("node").alias("root"))
    roots = roots.unionByName(copies.select("node", F.coalesce("further", "root").alias("root"))).unionByName(own)
    return sets.select("node", "n"), roots


def similarity_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach,
    itself included) of every document.

    Documents without words link with nothing.  Rows with the same id are
    documents of their own (each gets its row), and so are rows without one;
    the component of rows without any id is null.  A very long text is one set,
    which one task holds at a time.  Other columns are ignored; an empty table
    gives an empty table.
    """
    ids = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    if _plain_ids(ids, kind):
        sizes, roots = _components_of(ids.select(F.col("doc_id").cast("long").alias("node"), "text"))
        joined = sizes.join(roots, "node", "left")
        return joined.select(F.col("node").cast(kind).alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("root", "node").cast(kind).alias("component_id"))
    rows = _numbered(ids)
    sizes, roots = _components_of(rows.select("node", "text"))
    joined = rows.select("node", "doc_id").join(sizes, "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = written(joined.groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    return joined.join(least, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _plain_ids(rows: DataFrame, kind: str) -> bool:
    """Whether doc_id can name the rows: a number, never null, never repeated."""
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        return False
    return rows.groupBy("doc_id").count().filter("count > 1 or doc_id is null").isEmpty()


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with a number of their own, written so that it stays."""
    return written(rows.withColumn("node", F.monotonically_increasing_id()), "numbered")


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The documents without those that reach a smaller doc_id by links (of
    rows with the same id: a smaller row): one of each group stays, with all
    its columns.  Documents without words (null and empty texts) link with
    nothing and stay; an empty table gives an empty table."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    if _plain_ids(docs.select("doc_id"), kind):
        _, roots = _components_of(docs.select(F.col("doc_id").cast("long").alias("node"), "text"))
        dropped = written(roots.filter("node <> root").select(F.col("node").cast(kind).alias("doc_id")), "dropped")
        return docs.join(dropped, "doc_id", "left_anti").select([F.col(f"`{c}`") for c in docs.columns])
    rows = written(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("node")), "numbered")
    ordered = rows.select("node", F.col("row.text").alias("text"))
    _, roots = _components_of(ordered)
    dropped = written(roots.filter("node <> root").select("node"), "dropped")
    return rows.join(dropped, "node", "left_anti").select("row.*")
