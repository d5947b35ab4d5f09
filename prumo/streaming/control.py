"""State over event logs in batch form: budgets, spacing, failure runs, quotas, high-water marks, page differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _slices(df: DataFrame, key: str, ts: str, hours: int) -> DataFrame:
    """df with _slice: the row's stretch of `hours` hours, so that a window over (key, slice) splits a key of any size; rows without a
    time come first."""
    return df.withColumn("_slice", F.coalesce(F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (3_600_000_000 * hours)), F.lit(-(1 << 62))))


def rolling_sum(df: DataFrame, key: str, ts: str, value: str, interval: str, out: str, hours: int = 24) -> DataFrame:
    """Sum of value over the interval that ends at each row, per key. A key's rows are split into slices of `hours` hours (or of the interval, if
    that is longer); the rows of a slice's last interval also stand in the next slice, where they only count, so no window sees more
    than two slices and a key of any size is shared by many tasks."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    length = F.greatest(F.lit(3_600_000_000 * hours), F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00Z' + interval {interval})"))
    cut = df.withColumn("_slice", F.floor(micros / length)).withColumn("_carried", F.lit(False))
    reach = F.col(ts).cast("timestamp") + F.expr(f"interval {interval}")
    late = cut.filter(F.unix_micros(reach) >= (F.col("_slice") + 1) * length).withColumn("_slice", F.col("_slice") + 1).withColumn("_carried", F.lit(True))
    summed = cut.unionByName(late).withColumn(out, F.expr(f"sum({value}) over (partition by {key}, _slice order by {ts} range between interval {interval} preceding and current row)"))
    return summed.filter("not _carried").drop("_slice", "_carried")


def spacing_violations(df: DataFrame, key: str, order: list[str], ts: str, least_seconds: int, hours: int = 24) -> DataFrame:
    """Rows that come sooner than least_seconds after the row before, per key, with the gap in whole seconds. Rows are ordered
    within slices of `hours` hours; the first of a slice is held against the last time of the slice before it that has rows,
    from a small table of one row for each key and slice."""
    cut = _slices(df, key, ts, hours)
    own = F.lag(ts).over(W.partitionBy(key, "_slice").orderBy(*order))
    ends = cut.groupBy(key, "_slice").agg(F.max(ts).alias("_end"))
    ends = ends.select(key, "_slice", F.lag("_end").over(W.partitionBy(key).orderBy("_slice")).alias("_last"))
    before = F.coalesce(F.col("_own"), F.col("_last"))
    gap = F.floor((F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(before.cast("timestamp"))) / 1_000_000)
    return cut.withColumn("_own", own).join(ends, [key, "_slice"]).withColumn("gap_seconds", gap).filter(F.col("gap_seconds") < least_seconds).drop("_slice", "_own", "_last")


def _numbered(df: DataFrame, key: str, order: list[str], ts: str, counted: Column, out: str, hours: int) -> DataFrame:
    """df with how many rows up to and with each one are counted, per key: counts within slices, and those of earlier slices from a table of one
    row for each key and slice."""
    cut = _slices(df, key, ts, hours).withColumn("_one", counted.cast("long"))
    own = F.sum("_one").over(W.partitionBy(key, "_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    sums = cut.groupBy(key, "_slice").agg(F.sum("_one").alias("_n"))
    earlier = F.coalesce(F.sum("_n").over(W.partitionBy(key).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    before = sums.select(F.col(key).alias("_k"), F.col("_slice").alias("_s"), earlier.alias("_before"))
    joined = cut.withColumn("_own", own).join(before, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_slice") == F.col("_s")))
    return joined.withColumn(out, F.col("_own") + F.col("_before")).drop("_slice", "_one", "_own", "_before", "_k", "_s")


def runs(df: DataFrame, key: str, order: list[str], flag: Column, least: int, ts: str, hours: int = 24) -> DataFrame:
    """Runs of at least `least` consecutive flagged rows per key: first and last time, length. Rows of a run have equally many rows without
    the flag before them, which are counted slice by slice; a run may reach over slices."""
    marked = _numbered(df.withColumn("_f", flag), key, order, ts, ~F.col("_f"), "_island", hours)
    return marked.filter("_f").groupBy(key, "_island").agg(F.min(ts).alias("started"), F.max(ts).alias("ended"), F.count("*").alias("run_length")).filter(F.col("run_length") >= least).drop("_island")


def local_day(ts: Column, zone: str) -> Column:
    """Calendar day of a UTC time in a zone."""
    return F.to_date(F.from_utc_timestamp(ts.cast("timestamp"), zone))


def capped(df: DataFrame, key: str, order: list[str], cap: int, ts: str, hours: int = 1) -> DataFrame:
    """Running number of each row in its quota period, and whether it is within the cap. Rows are numbered within slices of
    `hours` hours; the rows of earlier slices come from a table of one row for each period and slice."""
    cut = _slices(df, key, ts, hours)
    own = F.row_number().over(W.partitionBy(key, "_slice").orderBy(*order))
    counts = cut.groupBy(key, "_slice").agg(F.count("*").alias("_n"))
    earlier = F.coalesce(F.sum("_n").over(W.partitionBy(key).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(key, "_slice", earlier.alias("_before"))
    n = F.col("_own") + F.col("_before")
    return cut.withColumn("_own", own).join(counts, [key, "_slice"]).withColumn("used", n).withColumn("within_cap", n <= cap).drop("_slice", "_own", "_before")


def reread(df: DataFrame, id_column: str, seen: DataFrame, margin: int) -> DataFrame:
    """Rows from the highest seen id minus margin on that haven't been seen: a high-water mark with a margin for late rows."""
    mark = seen.agg(F.max(id_column).alias("_mark"))
    fresh = df.join(F.broadcast(mark), F.col(id_column) >= F.col("_mark") - margin).drop("_mark")
    return fresh.join(seen.select(id_column), id_column, "left_anti")


def least_used(df: DataFrame, day: Column, kind: str, priority: list[str]) -> DataFrame:
    """Per day the kind with fewest rows, ties by priority; kinds without rows count as 0."""
    kinds = F.explode(F.array(*(F.struct(F.lit(i).alias("rank"), F.lit(k).alias("kind")) for i, k in enumerate(priority))))
    days = df.select(day.alias("day")).distinct().select("day", kinds.alias("k")).select("day", "k.rank", "k.kind")
    used = df.groupBy(day.alias("day"), F.col(kind).alias("kind")).agg(F.count("*").alias("n"))
    every = days.join(used, ["day", "kind"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return every.groupBy("day").agg(F.min_by("kind", F.struct("n", "rank")).alias("kind"), F.min("n").alias("n"))


def sentence_rows(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per distinct sentence (split after . ! ? or at line breaks, trimmed, not empty)."""
    parts = F.split(F.regexp_replace(F.col(text), r"([.!?])\s+", "$1\n"), "\n")
    return df.select(*keys, F.explode(F.array_distinct(F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s != ""))).alias("sentence"))


def new_sentences(df: DataFrame, key: str, turn: str, text: str) -> DataFrame:
    """Sentences of each turn that no earlier turn of the key had: the state is the set of sentences so far, so the turn
    where a sentence is new is the smallest that has it."""
    rows = sentence_rows(df, [key, turn], text)
    return rows.groupBy(key, "sentence").agg(F.min(turn).alias(turn)).groupBy(key, turn).agg(F.count("*").alias("n_new"))


def late(df: DataFrame, ts: str, mark: Column, margin: str) -> DataFrame:
    """df without rows older than a watermark minus a margin."""
    return df.filter(F.col(ts) >= mark - F.expr(f"interval {margin}"))


def first_reads(new: DataFrame, key: str, turn: str, alerts: Column) -> DataFrame:
    """New sentences that may alert: all from a key's second read on, but of its first read only those that meet `alerts`,
    since on a first read everything is new. new: key, turn, sentence, each sentence at the turn where it is new."""
    first = new.groupBy(key).agg(F.min(turn).alias("_first"))
    return new.join(first, key).filter((F.col(turn) > F.col("_first")) | alerts).drop("_first")


def estimates(df: DataFrame, key: str, order: list[str], value: str, least: float, last: int = 8, ts: str = "ts", hours: int = 24, rows: int = 4096) -> DataFrame:
    """What each call is taken to cost beforehand: the larger of `least` and the largest of the key's `last` calls before. Calls are numbered slice
    by slice; a window takes `rows` of them and the `last` before."""
    calls = _numbered(df, key, order, ts, F.lit(True), "_nth", hours).withColumn("_part", F.floor((F.col("_nth") - 1) / rows)).withColumn("_carried", F.lit(False))
    tail = calls.filter(F.pmod(F.col("_nth") - 1, F.lit(rows)) >= rows - last).withColumn("_part", F.col("_part") + 1).withColumn("_carried", F.lit(True))
    before = F.max(value).over(W.partitionBy(key, "_part").orderBy("_nth").rowsBetween(-last, -1))
    priced = calls.unionByName(tail).withColumn("estimate", F.greatest(F.coalesce(before, F.lit(least)), F.lit(least)))
    return priced.filter("not _carried").drop("_nth", "_part", "_carried")


def quarantine(runs_: DataFrame, key: str, seconds: int) -> DataFrame:
    """From when to when a key is out after each run of failures (see runs): `seconds` from the run's last failure on."""
    return runs_.select(key, F.col("ended").alias("since"), (F.col("ended") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))).alias("until"))


def dispatch(used: DataFrame, day: str, kind: str, count: str, priority: list[str], caps: dict[str, int], out: DataFrame | None = None) -> DataFrame:
    """Per day the least used kind under its cap and not in `out` (day, kind); ties by priority; null if none is left."""
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col(kind))
    cap = F.create_map(*(F.lit(x) for kv in caps.items() for x in kv))
    open_ = F.col(count) < F.coalesce(cap[F.col(kind)], F.lit((1 << 63) - 1))
    rows = used.filter(rank > 0)
    if out is not None:
        rows = rows.join(out.select(day, kind, F.lit(True).alias("_out")).distinct(), [day, kind], "left")
        open_ = open_ & F.col("_out").isNull()
    return rows.groupBy(day).agg(F.min_by(kind, F.when(open_, F.struct(F.col(count), rank))).alias(kind))


def canary(df: DataFrame, batch: str, order: str, known: Column, every: int) -> DataFrame:
    """Per batch of `every` items whether its canary (the item whose answer is known) came back: batches after one that failed
    aren't to be trusted. Columns: batch, alive, trusted."""
    numbered = df.withColumn(batch, F.floor(F.col(order) / every))
    per = numbered.groupBy(batch).agg(F.coalesce(F.bool_or(known), F.lit(False)).alias("alive"))
    failed = per.filter(~F.col("alive")).agg(F.min(batch).alias("_bad"))
    return per.join(F.broadcast(failed)).withColumn("trusted", F.col("_bad").isNull() | (F.col(batch) < F.col("_bad"))).drop("_bad")
