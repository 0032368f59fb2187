"""The stages one after another, and the registered queries."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.compare import connect, difference
from tillflow.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_pack_what_is_left(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns and docs.count() > 0
        if name == "language":
            assert docs.count() == before
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).cache()
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_pipeline_on_nothing(spark, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        assert docs.count() == 0


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    assert difference(entry.queries()[name](spark, SF), connect(SF), entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["op6_secrets", "pipeline"])
def test_registered_queries_run(spark, name):
    assert entry.queries()[name](spark, SF).count() >= 0
