"""Files, archives, logs, reports and schemas on small inputs."""

import datetime as dt
import io
import zipfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from prumo.functions import extraction, text
from prumo.operators import lookup, writes
from prumo.sources import files
from prumo.streaming import control


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def archive(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


def test_archives_of_json(spark):
    held = [(1, archive(a='{"r":[{"x":1},{"x":2}]}', b='{"r":null}', c="nojson", d='{"r":[{"x":3}], "y":"caf\xe9"}'.encode("latin-1"))), (2, b"junk"), (3, None)]
    got = files.archive_rows(spark.createDataFrame(held, "k int, c binary"), ["k"], "c", "r", "x int")
    assert rows(got) == [(1, "a", 1), (1, "a", 2), (1, "d", 3)]


def test_dimension_and_days(spark, tmp_path):
    (tmp_path / "d.csv").write_text('code,name\n1,"Água, Boa"\nx,Luz\n', encoding="utf-8")
    assert rows(files.dimension(spark, str(tmp_path / "d.csv"), "code int, name string")) == [(1, "Água, Boa"), (None, "Luz")]
    entries = spark.createDataFrame([(i, dt.date(2026, 1, i)) for i in (1, 2, 3)], "v int, at date")
    for _ in range(2):
        writes.append_log(entries, str(tmp_path / "log"), F.col("at"))
    got = files.between_days(spark, str(tmp_path / "log"), "2026-01-02", "2026-01-03")
    assert sorted(r.v for r in got.collect()) == [2, 2, 3, 3]
    assert "PartitionFilters: [isnotnull(day" in got._jdf.queryExecution().executedPlan().toString()


def test_report(spark, tmp_path):
    df = spark.createDataFrame([(1, "a|b"), (2, None)], "k int, t string")
    writes.write_report(df, str(tmp_path / "r"), ["k", "t"])
    assert rows(spark.read.csv(str(tmp_path / "r"), header=True)) == [("1", "a|b"), ("2", None)]
    assert [r.line for r in writes.markdown_rows(df, ["k", "t"]).orderBy("k").collect()] == ["| 1 | a\\|b |", "| 2 |  |"]


def test_transition_logs_changes_only(spark):
    df = spark.createDataFrame([(1, "new"), (2, "done"), (3, None)], "k int, s string")
    after, log = writes.transition(df, "k", "s", {"done": F.col("k") < 4}, F.lit(0))
    assert rows(after) == [(1, "done"), (2, "done"), (3, "done")] and rows(log.drop("at")) == [(1, "new", "done"), (3, None, "done")]


def test_keys_that_look_alike_get_their_own_ids(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, ""), ("", None), (None, None)], "x string, y string")
    got = writes.get_or_create(df, spark.createDataFrame([], "x string, y string, id string"), ["x", "y"], "id")
    assert len({r.id for r in got.collect()}) == 5


def test_json_schema():
    kind = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("when", T.DateType()), T.StructField("rows", T.ArrayType(T.StructType([T.StructField("role", T.StringType())])))])
    got = extraction.json_schema(kind)
    assert got["properties"]["n"] == {"type": ["integer", "null"]} and got["properties"]["when"]["format"] == "date"
    assert got["properties"]["rows"]["items"]["required"] == ["role"] and got["required"] == ["n", "when", "rows"]


def test_spacing_across_slices(spark):
    at = lambda *hms: dt.datetime(2026, 1, 1, *hms)
    e = spark.createDataFrame([(1, "k", at(0, 59, 50)), (2, "k", at(1, 0, 5)), (3, "k", at(5, 0, 0)), (4, "k", at(5, 0, 30)), (5, "j", at(1, 0, 6)), (6, None, at(0, 0, 0))], "id int, k string, ts timestamp")
    got = control.spacing_violations(e, "k", ["ts", "id"], "ts", 60, hours=1)
    assert rows(got.select("id", "gap_seconds")) == [(2, 15), (4, 30)]
    used = control.capped(e.filter("k = 'k'"), "k", ["ts", "id"], 3, "ts")
    assert rows(used.select("id", "used", "within_cap")) == [(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, False)]


def test_batches_cover_all_rows_once(spark):
    keys = [0, 1, 5, 999, 1000, 1001, 7_000_000, 7_000_001, 2_000_000_000, 2_000_000_001, 2_000_000_002]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = [rows(lookup.batch_of_day(df, "k", 4, day)) for day in range(4)]
    assert got[0] == got[3] and sorted(k for g in got[:3] for (k,) in g) == keys and [len(g) for g in got[:3]] == [4, 4, 3]


def test_pairs_of_odd_columns(spark):
    df = spark.createDataFrame([(1, None, 5), (2, dt.date(2026, 1, 2), 1)], "k int, d date, v int").withColumn("k", F.lit(1))
    assert rows(lookup.pick_by_date(df, ["k"], "d", [F.col("v")], ["v"], True)) == [(1, 1)]
    assert rows(lookup.pick_by_date(df.filter("d is null"), ["k"], "d", [F.col("v")], ["v"], False)) == [(1, 5)]


def test_folds_reach_latin_extended(spark):
    df = spark.createDataFrame([("ŁÓDŹ Ů ő ğ ş İ",)], "t string")
    assert rows(df.select(text.fold_keep(F.col("t")), text.fold_ascii(F.col("t")))) == [("łodz u o g s i", "odz u o g s i")]
