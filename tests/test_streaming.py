import datetime as dt

from prumo.streaming import incremental

SCHEMA = "id long, ts timestamp, v int"


def test_rows_come_once(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    at = dt.datetime(2024, 1, 1)
    put = lambda ids: spark.createDataFrame([(i, at, i) for i in ids], SCHEMA).write.mode("append").parquet(src)
    run = lambda: incremental.run_available(incremental.read_new(spark, src, SCHEMA, "ts", ["id"], "1 hour"), mark, incremental.parquet_batches(out))
    put([1, 2, 2])
    run()
    put([2, 3])
    run()
    run()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_windowed_counts(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 0, m), 0) for m in (1, 2, 11)], SCHEMA).write.parquet(src)
    stream = incremental.windowed_counts(spark.readStream.schema(SCHEMA).parquet(src), "ts", ["id"], "10 minutes", "5 minutes")
    query = stream.writeStream.format("memory").queryName("counts").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(r.n for r in spark.sql("select n from counts").collect()) == [1, 2]
