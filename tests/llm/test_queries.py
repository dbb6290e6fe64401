"""The registered queries over the smallest test tables, those with a twin against it."""

from __future__ import annotations

import pytest

from __spark_entry__ import oracle_sql, queries
from haulmart.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import SF_DIR, needs_tables

pytestmark = needs_tables


def test_registry():
    assert {k.split("_")[0] for k in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert {*QUERIES, "pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_its_twin(spark, key):
    from compare import compare, duck

    text, equal = compare(spark, duck(SF_DIR), SF_DIR, key, QUERIES[key], ORACLE[key])
    assert equal, text


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "n-gram Jaccard join", "best-fit packing",
    ]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns, name
    placed = corpus_pipeline.run(spark, SF_DIR)
    ends = placed.selectExpr("sequence_id", "offset + length AS e", "length").groupBy("sequence_id")
    assert ends.agg({"e": "max", "length": "sum"}).where("`max(e)` != `sum(length)` OR `max(e)` > 2048").count() == 0
    kept = placed.select("doc_id").distinct()
    assert 0 < kept.count() < docs.count() and kept.join(docs, "doc_id").count() == kept.count()
