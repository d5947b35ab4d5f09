"""Rows dealt out over tasks by their number."""

from pyspark.sql import functions as F

from prumo import shared
from prumo.plans import records


def test_spread(spark, monkeypatch):
    monkeypatch.setattr(shared, "ROWS_A_TASK", 100)
    rows = spark.range(1000)
    assert shared.spread(rows, "id").rdd.getNumPartitions() == 4
    assert shared.spread(rows, "id", rows=1001).rdd.getNumPartitions() == 11


def test_more_rows_are_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(shared, "ROWS_A_TASK", 500)
    found = records.integrity_suite(spark, "/root/testdata/sf0.001").filter("check_name = 'shipped_before_order'")
    assert found.select(F.spark_partition_id().alias("p")).distinct().count() > 4
