import subprocess
import sys

import corpus_pipeline
import public_tokenizers
import tiktoken

from dimweave.llm import sql_bpe
from dimweave.llm.language_id import identify_languages

from .conftest import SF
from .test_decontaminate import by_definition as contaminated_by_definition
from .test_ngram_join import by_definition as groups_by_definition


def test_stages_equal_brute_force(spark, documents):
    benchmark = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r.doc_id: r for r in documents.collect()}
    for r in identify_languages(documents).collect():
        if r.lang_pred == "und" or r.score == 0:
            del kept[r.doc_id]
    groups = groups_by_definition([(d, r.text) for d, r in kept.items()])
    kept = {d: kept[d] for d, _, c in groups if d == c}
    texts = list(kept.items())
    found = contaminated_by_definition([r.text for _, r in texts], benchmark)
    kept = {d: r for (d, r), (n, hit, _) in zip(texts, found, strict=True) if not (hit and 20 * hit >= n)}
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(kept)
    ranks = sql_bpe.parse_ranks(open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in got:
        assert list(r.token_ids) == library.encode_ordinary(r.text)
        assert (r.lang, r.source) == (kept[r.doc_id].lang, kept[r.doc_id].source)


def test_stages_take_odd_and_empty_documents(spark, odd, nothing):
    for docs in (odd, nothing):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns
            assert out.count() <= docs.count()


def test_every_operator_is_registered():
    from __spark_entry__ import queries

    names = list(queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
    assert "pipeline" in names


def test_entry_without_the_subpackage(tmp_dir):
    """The entry module imports, and registers the other queries, where the
    subpackage and the pipeline are missing."""
    import os
    import shutil

    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_dir)
    shutil.copytree(f"{root}/dimweave", f"{tmp_dir}/dimweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 60 and 'pipeline' not in q, q; e.oracle_sql()"
    env = {**os.environ, "PYTHONPATH": tmp_dir}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, env=env, check=True)
