"""Registered queries of the package: each applies one operator, with its
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.llm import oracles
from dimweave.llm.common import ship_package, table
from dimweave.llm.decontaminate import contamination
from dimweave.llm.id_frames import id_checksums, read_token_ids, write_token_ids
from dimweave.llm.language_id import identify_languages
from dimweave.llm.lexical_search import lexical_search
from dimweave.llm.merkle import edited_fingerprints
from dimweave.llm.ngram_join import similarity_components
from dimweave.llm.packing import pack_documents, piece_checksums
from dimweave.llm.periodic_runs import periodic_runs, run_report, with_planted_runs
from dimweave.llm.pseudonyms import KEY_SETTING, TEST_KEY, pseudonym_report
from dimweave.llm.quality_cnn import quality_scores
from dimweave.llm.sql_bpe import bpe_round_trip
from dimweave.llm.token_counts import token_counts
from dimweave.llm.warc import read_archives, write_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap


@register("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under word_bpe_49k.json."""
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


@register("op8_id_frames")
def op8_id_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written as seekable frames in doc_id order and read back."""
    docs = table(spark, sf_dir, "documents")
    manifest = write_token_ids(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return id_checksums(read_token_ids(manifest, docs.schema["doc_id"].dataType.simpleString()))


@register("op10_sql_bpe")
def op10_sql_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document and the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@register("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return identify_languages(table(spark, sf_dir, "documents"))


@register("op7_decontaminate", oracles.DECONTAMINATE)
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op9_merkle", oracles.MERKLE)
def op9_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle fingerprints of every document and of its edited text."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))


@register("op6_warc", oracles.WARC)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back; a response's length and
    digest are those of its decoded payload (the reader has compared it with
    the header), a revisit's are in its headers."""
    path = write_archives(table(spark, sf_dir, "pages"))
    records = read_archives(spark, path)
    n_bytes = F.coalesce(F.octet_length("payload").cast("long"), F.col("payload_bytes"))
    return records.select("page_id", n_bytes.alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


@register("op5_quality_cnn")
def op5_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by the byte-level network."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


@register("op4_pseudonyms")
def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with personal data replaced by keyed pseudonyms."""
    return pseudonym_report(table(spark, sf_dir, "documents"), spark.conf.get(KEY_SETTING, TEST_KEY))


@register("op1_ngram_join", oracles.NGRAM_JOIN)
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with similar sets of 5-word shingles."""
    return similarity_components(table(spark, sf_dir, "documents"))


@register("op11_best_position", oracles.LEXICAL_SEARCH)
def op11_best_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


@register("op12_concat_cut")
def op12_concat_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids in sequences of 2048."""
    docs = table(spark, sf_dir, "documents")
    return piece_checksums(pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, window=2048))


@register("op13_periodic_runs", oracles.PERIODIC_RUNS)
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, with the contract's planted
    repetitions, and the text without them."""
    return run_report(periodic_runs(with_planted_runs(table(spark, sf_dir, "documents"))))
