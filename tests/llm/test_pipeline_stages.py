"""The registered queries against their SQL, and the pipeline against its operators."""

import pytest

import corpus_pipeline
from galecast.llm import registry
from oracle_check import SF_ROOT, compare, connect

SF = f"{SF_ROOT}/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(registry.QUERIES[name](spark, SF), connect(SF), registry.ORACLE[name]) == ""


def test_all_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES) == list(range(1, 14))


def test_stages_keep_columns_and_do_their_work(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        if name == "token_output":
            assert after.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and after.count() == docs.count()
            break
        assert after.columns == docs.columns
        if name != "mixing":
            assert after.exceptAll(docs).count() == 0 and after.count() < docs.count()
        docs = after.cache()
    assert corpus_pipeline.run(spark, SF).exceptAll(after).count() == 0


def test_the_pipeline_on_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
