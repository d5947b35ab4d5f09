"""Sinks as DataFrame steps: what a table holds after an update, without ever losing a known value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prumo.operators.lookup import pick_per_key


def set_columns(df: DataFrame, where: Column, values: dict[str, Column], allowed: set[str], only_null: bool = False) -> DataFrame:
    """Set allow-listed columns in the rows that meet `where` (only where null, if only_null). A column that isn't allowed
    raises ValueError; no values leave df as it is."""
    unknown = sorted(set(values) - allowed)
    if unknown:
        raise ValueError(f"columns that may not be set: {', '.join(unknown)}")
    return df.withColumns({c: F.when(where & (F.col(c).isNull() if only_null else F.lit(True)), v).otherwise(F.col(c)) for c, v in values.items()}) if values else df


def fill_null(df: DataFrame, values: DataFrame, keys: list[str], column: str) -> DataFrame:
    """df with the nulls of `column` taken from `values` (one row per key), known values kept."""
    new = values.select(*keys, F.col(column).alias("_new"))
    return df.join(new, keys, "left").withColumn(column, F.coalesce(F.col(column), F.col("_new"))).drop("_new")


def get_or_create(df: DataFrame, known: DataFrame, keys: list[str], id_column: str) -> DataFrame:
    """Distinct keys of df with the id of `known`, or a new one from the hash of the keys as JSON, so that reruns agree and
    null, empty and joined keys differ."""
    fresh = F.substring(F.sha2(F.to_json(F.struct(*(F.col(k).cast("string").alias(k) for k in keys)), {"ignoreNullFields": "false"}), 256), 1, 16)
    d, k = df.select(*keys).distinct().alias("d"), known.select(*keys, id_column).alias("k")
    cond = [F.col(f"d.{c}").eqNullSafe(F.col(f"k.{c}")) for c in keys]
    made = d.join(k, cond, "left").select(*(F.col(f"d.{c}").alias(c) for c in keys), F.col(f"k.{id_column}").alias("_id"))
    return made.select(*keys, F.coalesce("_id", fresh).alias(id_column), F.col("_id").isNull().alias("created"))


def claim(df: DataFrame, keys: list[str], order: list[Column], row_id: str) -> DataFrame:
    """row_id and whether the row owns its key: the first to insert does, before any side effect. The owners come from a
    grouped minimum, so no key's rows meet in one task."""
    owners = pick_per_key(df, keys, order, [row_id]).select(F.col(row_id).alias("_owner"))
    return df.select(row_id).join(owners, F.col(row_id) == F.col("_owner"), "left").select(row_id, F.col("_owner").isNotNull().alias("owned"))


def priority_insert(df: DataFrame, keys: list[str], kind: str, ranks: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """Insert-or-ignore in which better kinds come first whatever their arrival; kinds not ranked come last."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, ranks)), F.col(kind)), F.lit(0))
    return pick_per_key(df, keys, [F.when(rank > 0, rank).otherwise(len(ranks) + 1), *order], columns)


def transition(df: DataFrame, key: str, state: str, to: dict[str, Column], at: Column) -> tuple[DataFrame, DataFrame]:
    """df with each row's state set to the first name in `to` whose condition holds, and the log of real changes: key, before,
    after, at. Rows that no condition meets keep their state; a row that has the state already logs nothing."""
    after = F.col(state)
    for name, where in reversed(to.items()):
        after = F.when(where, F.lit(name)).otherwise(after)
    both = df.withColumn("_after", after)
    log = both.filter(~F.col("_after").eqNullSafe(F.col(state))).select(key, F.col(state).alias("before"), F.col("_after").alias("after"), at.alias("at"))
    return both.withColumn(state, F.col("_after")).drop("_after"), log


def append_log(entries: DataFrame, path: str, day: Column, run: str | None = None) -> None:
    """Appends entries to an audit log of Parquet folders by day; what other runs wrote is never rewritten. With a run id, entries lie in
    folders of their run, and a run that is repeated puts its own in the place of what it wrote before, so a retry doubles nothing."""
    if run is None:
        entries.withColumn("day", day).write.mode("append").partitionBy("day").parquet(path)
        return
    own = entries.withColumn("day", day).withColumn("run", F.lit(run))
    own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "day").parquet(path)


def markdown_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each row as a line of a Markdown table; bars in values are escaped, nulls are empty."""
    cells = [F.coalesce(F.replace(F.col(c).cast("string"), F.lit("|"), F.lit("\\|")), F.lit("")) for c in columns]
    return df.select(*columns, F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def write_report(df: DataFrame, path: str, columns: list[str]) -> None:
    """A CSV report with a header."""
    df.select(*columns).write.mode("overwrite").csv(path, header=True)


def isolated(df: DataFrame, problem: Column) -> tuple[DataFrame, DataFrame]:
    """Good rows, and failed ones with their error text: one bad item doesn't end the lot. problem: an error text or null."""
    judged = df.withColumn("error", problem)
    return judged.filter("error is null").drop("error"), judged.filter("error is not null")
