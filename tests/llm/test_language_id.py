import zlib

import numpy as np

from dimweave.llm import language_id as L
from dimweave.llm.queries import QUERIES

from .conftest import SF, SF_CHECK


def bundle_by_definition(text, vectors):
    """Letter by letter: permute, bind and bundle."""
    symbols = [0]
    for ch in text:
        s = int(L.symbol_table()[ord(ch)])
        if s or symbols[-1]:
            symbols.append(s)
    if symbols[-1]:
        symbols.append(0)
    letters = np.random.default_rng(L.SEED).integers(0, 2, (L.N_SYMBOLS, L.DIMENSIONS), dtype=np.int8) * 2 - 1
    total = np.zeros(L.DIMENSIONS)
    for a, b, c in zip(symbols, symbols[1:], symbols[2:], strict=False):
        total += np.roll(letters[a], 2).astype(int) * np.roll(letters[b], 1) * letters[c]
    return total


def test_bundles_follow_the_definition():
    vectors = L.GramVectors()
    for text in ("The cat, the hat!", "  Été 1 2 deux", "a", "你好"):
        assert np.allclose(vectors.bundle(*L.gram_counts(text)), bundle_by_definition(text, vectors))


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op3_language_id"](spark, SF_CHECK).collect()}
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()
    assert len(got) == len(docs)
    hits = []
    for r in docs:
        x = got[r.doc_id]
        assert x.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= x.score <= 1
        if x.held_out:
            hits.append(x.lang_pred == r.lang)
    assert np.mean(hits) > 0.97


def test_labels_of_held_out_documents_are_not_learned(spark, documents):
    from pyspark.sql import functions as F

    wrong = documents.withColumn("lang", F.when(L.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    a = {r.doc_id: (r.lang_pred, r.score) for r in L.identify_languages(documents).collect()}
    b = {r.doc_id: (r.lang_pred, r.score) for r in L.identify_languages(wrong).collect()}
    assert a == b


def test_odd_tables(spark, documents, odd, nothing, repeated):
    from pyspark.sql import functions as F

    both = documents.select("doc_id", "text", "lang").unionByName(odd.select((F.col("doc_id") + 10**6).alias("doc_id"), "text", "lang"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.identify_languages(both).collect()}
    for i in (0, 1, 2, 3, 10, 11):  # without any letter
        assert got[10**6 + i] == ("und", 0.0)
    assert got[10**6 + 14] == got[10**6 + 15]
    assert L.identify_languages(nothing).count() == 0
    unlabelled = L.identify_languages(repeated.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)] * repeated.count()


def test_filter_keeps_recognised_documents_whole(spark, documents, odd):
    kept = L.keep_identified(documents)
    assert kept.schema == documents.schema
    assert sorted(kept.collect()) == sorted(documents.collect())
    # nothing to learn from: only documents without a letter go
    assert {r.doc_id for r in L.keep_identified(odd).collect()} == {4, 5, 6, 7, 8, 9, 12, 13, 14, 15}


def test_filter_rejects_unlearned_languages_and_random_letters(spark, documents):
    import random

    rnd = random.Random(5)

    def letters(n, alphabet):
        return "".join(rnd.choice(alphabet) for _ in range(n))

    clean = documents.collect()
    foreign = [
        "今天天气很好，我们一起去公园散步，然后在湖边喝茶聊天，晚上回家做饭吃。" * 5,
        letters(3000, [chr(c) for c in range(0x4E00, 0x5A00)]),
        "Сегодня хорошая погода, и мы пошли гулять в парк, а потом пили чай у озера и говорили о книгах.",
        letters(100, "abcdefghijklmnopqrstuvwxyz"),
        letters(400, "abcdefghijklmnopqrstuvwxyz    "),
        letters(5000, "abcdefghijklmnopqrstuvwxyz    "),
        "def f(x):\n    for k, v in self.items():\n        if not isinstance(v, dict): raise ValueError(k)\n        yield from zip(x, range(len(v)))\n    return np.zeros((n, m), dtype=np.float32)",
    ]
    by_lang = {r.lang: r.text for r in clean}
    short = [" ".join(t.split()[:n]) for t in by_lang.values() for n in (1, 2, 4, 8, 16, 40)]
    short += ["Yes.", "Hello", "Thank you very much.", f"{by_lang['en'][:800]} {by_lang['de'][:800]}"]
    rows = [(f"f{i}-{k}", t, None) for k in range(3) for i, t in enumerate(foreign)] + [(f"c{i}", t, None) for i, t in enumerate(short)]
    both = documents.select(documents.doc_id.cast("string").alias("doc_id"), "text", "lang")
    both = both.unionByName(spark.createDataFrame(rows, "doc_id string, text string, lang string"))
    kept = {r.doc_id for r in L.keep_identified(both).collect()}
    assert kept == {str(r.doc_id) for r in clean} | {f"c{i}" for i in range(len(short))}
