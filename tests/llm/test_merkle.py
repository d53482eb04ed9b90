import hashlib

from pyspark.sql import functions as F

from dimweave.llm import merkle as M
from dimweave.llm.queries import QUERIES

from .conftest import SF


def tree_by_definition(text):
    """Root, sections of paragraphs of leaf digests; piece by piece."""

    def digest(parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    sections, section_digests, paragraphs, open_ = [], [], [], []
    lines = text.split("\n")
    for number, line in enumerate(lines):
        pieces, i = [], 0
        while i < len(line):
            j = i
            while j < len(line) and j - i < 96 and line[j] not in ".!?":
                j += 1
            while j < len(line) and line[j] in ".!?":
                j += 1
            pieces.append(digest([line[i:j]]))
            i = j
        paragraphs.append(pieces)
        open_.append(digest(pieces))
        if int(open_[-1], 16) % 8 == 0 or number == len(lines) - 1:
            section_digests.append(digest(open_))
            sections.append(paragraphs)
            paragraphs, open_ = [], []
    return digest(section_digests), sections


def written_by_definition(tree):
    root, sections = tree
    return "/".join([root, *(";".join("".join(leaf[:6] for leaf in p) for p in s) for s in sections)])


def likeness_by_definition(a, b):
    if a[0] == b[0]:
        return 1.0
    ours, theirs = ([leaf[:6] for s in tree[1] for p in s for leaf in p] for tree in (a, b))
    total, shared = len(ours) + len(theirs), 0
    for leaf in ours:
        if leaf in theirs:
            theirs.remove(leaf)
            shared += 1
    return 2 * shared / total if shared else 0.0


def by_definition(docs):
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("hash")).collect()
    rows = sorted(rows, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.hash, r.text or ""))
    out = []
    for i, (doc_id, text, _) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)].text or ""
        cut = len(text) // 2
        edited = text[: len(text) - cut] + following[:cut]
        a, b, c = (tree_by_definition(t) for t in (text, edited, following))
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out.append((doc_id, len(text), digest, written_by_definition(a), written_by_definition(b), likeness_by_definition(a, b), likeness_by_definition(a, c)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_definition(spark, documents):
    got = rows_of(QUERIES["op9_merkle"](spark, SF))
    assert got == by_definition(documents)


def test_task_borders(spark, documents):
    """Without coalescing every task has a border."""
    some = documents.filter("doc_id < 40").repartition(3)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows_of(M.edited_fingerprints(some))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == by_definition(some)


def test_one_id_of_most_rows(spark):
    """Rows of one id are spread over the tasks and still follow each other."""
    rows = [(7, f"Text {i}. Says {i % 5}!\nAnd {i}.") for i in range(300)] + [(i, f"Other {i}.") for i in range(40)] + [(None, "No id."), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows_of(M.edited_fingerprints(docs))
        hashed = docs.withColumn("hash", F.xxhash64("text")).repartitionByRange(F.col("doc_id").desc_nulls_last(), "hash")
        sizes = [r["count"] for r in hashed.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == by_definition(docs)
    assert len(sizes) > 2 and max(sizes) < 200


def test_odd_tables(spark, odd, nothing, repeated):
    assert rows_of(M.edited_fingerprints(odd)) == by_definition(odd)
    assert M.edited_fingerprints(nothing).count() == 0
    assert rows_of(M.edited_fingerprints(repeated)) == by_definition(repeated)
    single = M.edited_fingerprints(spark.createDataFrame([(5, "a. b. c")], "doc_id long, text string")).first()
    assert single.near_next == 1.0 and single.n_chars == 7


def test_trees_locate_edits():
    text = "\n".join(f"Paragraph {i} says this. And that!" for i in range(60))
    lines = text.split("\n")
    lines[7] = "Paragraph 7 says something else."
    lines[41] += " More."
    a, b = str(M.Tree(text)), str(M.Tree("\n".join(lines)))
    assert M.differing_paragraphs(a, a) == [] and M.likeness(a, a) == 1.0
    assert M.differing_paragraphs(b, a) == [7, 41]
    assert 0.9 < M.likeness(a, b) < 1
    assert M.Tree("x\ny").root != M.Tree("xy").root != M.Tree("x\n\ny").root
