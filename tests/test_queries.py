"""Every query against its SQL on the smallest tables."""

import pytest
from comparing import plain

from scrollwork import registry


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(name, spark, small, duck):
    got = registry.QUERIES[name](spark, small).toPandas()
    if name not in registry.ORACLES:
        assert len(got) > 0
        return
    want = duck.sql(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


@pytest.mark.parametrize("name", ["chunks_paged", "chunks_pageless", "heading_paths", "topic_map", "run_summary_by_key", "stage_status"])
def test_result_does_not_depend_on_partitions(name, spark, small):
    want = plain(registry.QUERIES[name](spark, small).toPandas())
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert plain(registry.QUERIES[name](spark, small).toPandas()) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns[:2] == ["doc_id", "chunk_no"]
