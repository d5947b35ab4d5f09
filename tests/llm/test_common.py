from types import SimpleNamespace

import pytest

from prumo.llm import common


def session(master, folder=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: folder or default), sparkContext=SimpleNamespace(master=master, applicationId="test-app"))


def test_scratch_must_be_shared_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.scratch_dir(session("yarn"))
    with pytest.raises(ValueError):
        common.scratch_dir(session("local-cluster[2,1,1024]"))
    assert common.scratch_dir(session("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    assert common.scratch_dir(session("local[4]")) == common.scratch_dir(session("local[4]"))


def test_buckets_follow_the_bytes(spark, monkeypatch):
    docs = spark.createDataFrame([("x" * 1000,), (None,), ("",)], "text string")
    assert common.text_buckets(docs) == common.text_buckets(docs.limit(0)) == common.buckets(spark)
    monkeypatch.setattr(common, "BUCKET_TEXT", 10)
    assert common.text_buckets(docs) == 100


def test_bucketed_tables_are_read_once_and_leave_no_entry(spark):
    df = spark.createDataFrame([(i, str(i)) for i in range(50)], "k long, v string")
    held = common.bucketed(df, "k", "test")
    other = df.filter("k < 10").groupBy("k").count()
    plan = held.join(other.hint("shuffle_hash"), "k")
    assert plan.count() == 10 and sorted(r.k for r in held.collect()) == list(range(50))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("prumo_")]
    common.discard(held)
