"""Stored tables: batches that come twice, partitions that aren't touched; counted writes, archives by day, sets as bitmaps."""

import glob
import io
import os
import random
import zipfile

from pyspark.sql import functions as F

from prumo.operators import bitmaps
from prumo.sources import files
from prumo.streaming import stored

SCHEMA = "k long, a string, b int, t int"


def part_files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/bucket=*/*.parquet")}


def test_batches_that_come_twice(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.randint(0, 40), rng.choice([None, "x", "y"]), rng.choice([None, 1, 2]), t) for t in range(300)]
    table = stored.StoredTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], 8)
    assert table.read().count() == 0
    merge = stored.fill_nulls(["k"], ["a", "b"], ["t"])
    for part in (rows[:100], rows[100:200], rows[100:200], rows[200:], rows[200:]):
        table.upsert(spark.createDataFrame(part, SCHEMA), merge)
    table.upsert(spark.createDataFrame([], SCHEMA), merge)
    want = {}
    for k, a, b, t in rows:
        old = want.setdefault(k, (a, b, t))
        want[k] = (a if old[0] is None else old[0], b if old[1] is None else old[1], old[2])
    assert {r.k: (r.a, r.b, r.t) for r in table.read().collect()} == want


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    table = stored.StoredTable(spark, path, "k long, v int, t int", ["k"], 8)
    merge = stored.latest(["k"], ["t"])
    table.upsert(spark.createDataFrame([(k, k, 0) for k in range(60)], "k long, v int, t int"), merge)
    before = part_files(path)
    touched = table.read().filter("k = 7").first().bucket
    table.upsert(spark.createDataFrame([(7, 99, 5), (7, 98, 4)], "k long, v int, t int"), merge)
    after = part_files(path)
    assert {f for f in before if after.get(f) != before[f]} == {f for f in before if f"bucket={touched}/" in f}
    got = {r.k: r.v for r in table.read().collect()}
    assert got == {k: 99 if k == 7 else k for k in range(60)}


def test_stream_and_restart(spark, tmp_path):
    src, mark = str(tmp_path / "src"), str(tmp_path / "mark")
    table = stored.StoredTable(spark, str(tmp_path / "t"), "k long, v int, t int", ["k"], 4)
    for rows in ([(1, 1, 1), (2, 2, 1)], [(1, 5, 0), (3, 3, 1)], [(2, 9, 3)]):
        spark.createDataFrame(rows, "k long, v int, t int").write.mode("append").parquet(src)
        table.follow(spark.readStream.schema("k long, v int, t int").parquet(src), stored.latest(["k"], ["t"]), mark)
    assert {r.k: r.v for r in table.read().collect()} == {1: 1, 2: 9, 3: 3}


def test_counted_writes(spark, tmp_path):
    path, log = str(tmp_path / "rows"), str(tmp_path / "log")
    for run, n in (("a", 5), ("a", 7), ("b", 3)):
        got = stored.write_counted(spark.range(n), path, {"rows": F.count("*"), "most": F.max("id")}, log, run, F.lit("2026-01-01"))
        assert got == {"rows": n, "most": n - 1}
    assert sorted((r.run, r.metric, r.value) for r in spark.read.parquet(log).collect()) == [("a", "most", 6.0), ("a", "rows", 7.0), ("b", "most", 2.0), ("b", "rows", 3.0)]
    stored.write_counted(spark.range(0), path, {"most": F.max("id")}, log, "c", F.lit("2026-01-01"))
    assert [r.value for r in spark.read.parquet(log).filter("run = 'c'").collect()] == [None]


def test_unwanted_days_are_not_opened(spark, tmp_path):
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr("a.json", '{"rows": [{"x": 1}, {"x": 2}]}')
        z.writestr("b.json", '{"rows": null}')
        z.writestr("c.txt", "no json")
    path = str(tmp_path / "archives")
    rows = [("2026-01-01", packed.getvalue()), ("2026-01-02", b"no archive"), ("2026-01-02", None), ("2026-01-03", packed.getvalue())]
    spark.createDataFrame(rows, "day string, content binary").withColumn("day", F.to_date("day")).write.partitionBy("day").parquet(path)
    for broken in glob.glob(f"{path}/day=2026-01-03/*.parquet"):
        with open(broken, "wb") as f:
            f.write(b"broken")
    wanted = files.between_days(spark, path, "2026-01-01", "2026-01-02")
    got = files.archive_rows(wanted, ["day"], "content", "rows", "x int").collect()
    assert sorted((str(r.day), r.entry, r.x) for r in got) == [("2026-01-01", "a.json", 1), ("2026-01-01", "a.json", 2)]


def test_sets_merge(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.randint(0, 3), rng.choice([None, rng.randint(0, 200_000)])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, day int, id int")
    daily = bitmaps.id_sets(df, ["g", "day"], "id")
    merged = {r.g: r.n for r in bitmaps.sizes(bitmaps.merged(daily, ["g"]), ["g"], "n").collect()}
    at_once = {r.g: r.n for r in bitmaps.sizes(bitmaps.id_sets(df, ["g"], "id"), ["g"], "n").collect()}
    want = {g: len({i for h, _, i in rows if h == g and i is not None}) for g in "ab"}
    assert merged == at_once == want
    both = bitmaps.gross_and_distinct(bitmaps.id_sets(df, ["g"], "id"), []).first()
    sets = [{i for h, _, i in rows if h == g and i is not None} for g in "ab"]
    assert (both.gross, both["distinct"], both.overlap) == (len(sets[0]) + len(sets[1]), len(sets[0] | sets[1]), len(sets[0] & sets[1]))
