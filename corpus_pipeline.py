"""Corpus pipeline: the documents of a training corpus, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the
columns of documents; the last adds the token ids.  ``run`` writes each
stage's rows to the shared checkpoint folder and reads them again for the next
one, so a lost executor costs no earlier stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dimweave.llm.common import ship_package, table, written
from dimweave.llm.decontaminate import without_contaminated
from dimweave.llm.language_id import keep_identified
from dimweave.llm.ngram_join import one_of_each_group
from dimweave.llm.pseudonyms import KEY_SETTING, TEST_KEY, pseudonymize
from dimweave.llm.sql_bpe import encode_documents


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be recognised."""
    ship_package(spark)
    return keep_identified(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of every group that links by a
    similarity of 0.8 of the sets of 5-word shingles."""
    ship_package(spark)
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages cover less than a twentieth."""
    ship_package(spark)
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by keyed pseudonyms."""
    return pseudonymize(docs, spark.conf.get(KEY_SETTING, TEST_KEY))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the token ids of their texts; the text is what the
    ids decode to."""
    ship_package(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("pii", pii),
    ("bpe", bpe),
]

#: SQL can't express the learned language profiles; the stages are tested
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, one after the other."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
