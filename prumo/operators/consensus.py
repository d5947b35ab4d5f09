"""Agreement within groups: majority, divergence, histograms, integrity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tally(df: DataFrame, keys: list[str], decision: str) -> DataFrame:
    """Per group its size, its most frequent decision (null if several tie) and the text histogram.

    Counts per (group, decision) come first, so a group of any size reaches the second step as a few rows.
    """
    counts = df.groupBy(*keys, decision).agg(F.count("*").alias("_n"))
    entries = F.collect_list(F.struct(F.col("_n").alias("n"), F.col(decision).alias("d")))
    per = counts.groupBy(*keys).agg(F.sum("_n").alias("group_size"), F.max("_n").alias("_top"), entries.alias("_e"))
    best = F.filter("_e", lambda e: e["n"] == F.col("_top"))
    ordered = F.array_sort("_e", lambda a, b: F.when(a["n"] > b["n"], -1).when(a["n"] < b["n"], 1).when(a["d"] < b["d"], -1).when(a["d"] > b["d"], 1).otherwise(0))
    text = F.array_join(F.transform(ordered, lambda e: F.concat(e["n"].cast("string"), F.lit(" "), F.coalesce(e["d"].cast("string"), F.lit("?")))), ", ")
    return per.select(*keys, "group_size", F.when(F.size(best) == 1, best[0]["d"]).alias("mode"), text.alias("histogram"))


def divergent(df: DataFrame, keys: list[str], decision: str, least: int = 3) -> DataFrame:
    """Rows that differ from the one most frequent decision of a group of at least `least` rows."""
    groups = tally(df, keys, decision).filter((F.col("group_size") >= least) & F.col("mode").isNotNull())
    return df.join(groups, keys).filter(F.col(decision) != F.col("mode"))


def verdict_for_all(df: DataFrame, keys: list[str], order: list[Column], verdict: Column, out: str, least: int = 2) -> DataFrame:
    """df with what is decided on each group's first row by order (its representative), for groups of at least `least` rows; rows of smaller
    groups are left out. One decision a group, however expensive, is applied to all its members."""
    by = F.struct(*order)
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), by).alias("_r"), F.count("*").alias("_n")).filter(F.col("_n") >= least)
    decided = first.select("_r.*")
    decided = decided.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), verdict.alias(out))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return df.join(decided, same).drop(*(f"_k{i}" for i in range(len(keys))))


def tiered_key(*tiers: tuple[str, Column]) -> Column:
    """A struct (tier, key) of the first tier whose value isn't null or empty; the last tier always applies."""
    out = F.struct(F.lit(tiers[-1][0]).alias("tier"), tiers[-1][1].cast("string").alias("key"))
    for name, value in reversed(tiers[:-1]):
        text = value.cast("string")
        out = F.when(text.isNotNull() & (text != ""), F.struct(F.lit(name).alias("tier"), text.alias("key"))).otherwise(out)
    return out


def checks(violations: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """One table of violations, labelled by check."""
    parts = [df.select(F.lit(name).alias("check_name"), *columns) for name, df in violations.items()]
    return reduce(DataFrame.unionByName, parts)
