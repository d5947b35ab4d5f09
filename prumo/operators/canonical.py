"""Canonical records: repeated sightings folded into one row that never loses a known value."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_known(df: DataFrame, keys: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """Per key and column the first value in order that isn't null: what a sequence of coalesce(existing, new) leaves."""
    by = F.struct(*order)
    known = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), by)).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*known, F.count("*").alias("sightings"))


def upsert_dimension(old: DataFrame, new: DataFrame, keys: list[str], overwrite: list[str], fill: list[str]) -> DataFrame:
    """Full outer join: `overwrite` columns take the new value where the new row exists, `fill` columns take it where it
    isn't null, and keep the old one otherwise."""
    o, n = old.alias("o"), new.withColumn("_new", F.lit(True)).alias("n")
    cond = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]
    out = [F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) for k in keys]
    out += [F.when(F.col("n._new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in overwrite]
    out += [F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in fill]
    return o.join(n, cond, "full_outer").select(*out)


def counters(df: DataFrame, keys: list[str], failed: Column) -> DataFrame:
    """Calls and errors per key."""
    return df.groupBy(*keys).agg(F.count("*").alias("calls"), F.coalesce(F.sum(failed.cast("long")), F.lit(0)).alias("errors"))


class Upserted(NamedTuple):
    """records: all canonical rows after the upsert. results: per incoming row its record, whether that row created it, and
    the evidence it added (null if that was there). evidence: the rows to add to the evidence table."""

    records: DataFrame
    results: DataFrame
    evidence: DataFrame


def upsert_records(
    known: DataFrame,
    seen: DataFrame,
    new: DataFrame,
    *,
    row: str,
    order: list[Column],
    keys: list[str],
    number: str,
    folded: dict[str, Column],
    fixed: list[str],
    optional: list[str],
    problem: str,
    overwrite: str,
    evidence: list[str],
) -> Upserted:
    """Sightings folded into canonical records, as if they came one by one in `order`.

    A sighting belongs to a record with equal `keys`, equal `number` and equal `folded` columns (the smallest id of several);
    without a number (null or empty) it always makes a record of its own. A record takes the first known value of each
    optional column and never loses one. `problem` takes what the last sighting with `overwrite` says, null included. `fixed`,
    the keys and the folded columns stay as they were first. Evidence (its key columns) is added once, by the first sighting
    that has it. known: id, keys, number, folded and fixed columns, optional, problem. seen: the evidence key columns.
    All steps are grouped minima and joins on the record's key, so no group is sorted or gathered.
    """
    texts = list(folded)
    by, flat = F.struct(*order), [*keys, number, *texts, *fixed]
    numbered = F.col(number).isNotNull() & (F.col(number) != "")

    def keyed(df: DataFrame, alone: Column) -> DataFrame:
        parts = [*(F.col(k).cast("string") for k in keys), F.col(number), *folded.values()]
        whole = F.to_json(F.struct(*(p.alias(f"k{i}") for i, p in enumerate(parts))), {"ignoreNullFields": "false"})
        return df.withColumn("_key", F.when(numbered, whole).otherwise(F.concat(F.lit("row "), alone.cast("string"))))

    lead = keyed(known.filter(numbered), F.col("id")).groupBy("_key").agg(F.min("id").alias("id"))
    rows = keyed(new, F.col(row)).withColumn("_by", by)
    first = {c: F.min_by(c, "_by").alias(c) for c in flat}
    values = {c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_by"))).alias(c) for c in optional}
    said = F.max_by(F.struct(F.col(problem)), F.when(F.col(overwrite), F.col("_by"))).alias("_said")
    group = rows.groupBy("_key").agg(*first.values(), *values.values(), said, F.min_by(problem, "_by").alias("_first"), F.min_by(row, "_by").alias("_maker"))
    met = group.join(lead, "_key", "left")
    made = F.substring(F.sha2("_key", 256), 1, 16)
    ids = met.select("_key", "_maker", F.coalesce(F.col("id"), made).alias("id"), F.col("id").isNull().alias("_new"))
    fresh = met.filter("id is null").select(made.alias("id"), *flat, *optional, F.when(F.col("_said").isNotNull(), F.col(f"_said.{problem}")).otherwise(F.col("_first")).alias(problem))
    changes = met.filter("id is not null").select("id", "_said", *(F.col(c).alias(f"_{c}") for c in optional))
    merged = known.join(changes, "id", "left").select(
        "id", *flat, *(F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) for c in optional), F.when(F.col("_said").isNotNull(), F.col(f"_said.{problem}")).otherwise(F.col(problem)).alias(problem)
    )
    conflict = seen.select(*evidence).distinct().withColumn("_there", F.lit(True))
    owner = rows.groupBy(*evidence).agg(F.min_by(row, "_by").alias("_owner")).join(conflict, evidence, "left").filter("_there is null").select(F.col("_owner"))
    results = rows.join(ids, "_key").join(owner, F.col(row) == F.col("_owner"), "left")
    evidence_id = F.when(F.col("_owner").isNotNull(), F.substring(F.sha2(F.to_json(F.struct(*evidence)), 256), 1, 16))
    results = results.select(row, "id", (F.col("_new") & (F.col(row) == F.col("_maker"))).alias("created"), evidence_id.alias("evidence_id"), *evidence)
    return Upserted(merged.unionByName(fresh), results.select(row, "id", "created", "evidence_id"), results.filter("evidence_id is not null").select("evidence_id", "id", *evidence))
