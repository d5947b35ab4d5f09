"""Mixing sources to target weights by systematic sampling; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from prumo.llm.common import WORD, materialize

#: Rows of one source and size class are dealt to this many groups, so that no group holds a large share of the rows.
SALTS = 64
OWN = ("_null", "_key", "_class", "_salt", "_hash", "_before", "_rate", "_offset", "_pos")


def words(text: Column) -> Column:
    """Number of words; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _uniform(x: Column) -> Column:
    """An integer in [0, 2**32) from the md5 of a string."""
    return F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("long")


def _size_class(size: Column) -> Column:
    """Sizes that share their bit length and three leading bits share a class."""
    bits = F.length(F.bin(size)).cast("int")
    return F.when(size < 16, size).otherwise(bits.cast("long") * 16 + F.expr("shiftright(size, length(bin(size)) - 4)"))


def targets(sized: DataFrame, weights=(5, 2, 1), cap: int = 3) -> DataFrame:
    """Per source: source, source_size, target.

    Sources by code point, null last, take the weights in turn. Each gets weight * level words, but cap times its own
    size at most, and the level makes the sum that of all sizes. With sources ordered by cap * size / weight those at
    their cap come first, so the level follows from running sums over the sources (one row each).
    """
    src = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    src = src.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("long")).withColumn("_cap", cap * F.col("source_size"))
    order = W.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    src = src.select(
        "source",
        "source_size",
        "_w",
        "_cap",
        F.row_number().over(order).alias("_nr"),
        ((F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0)))).alias("_level"),
    )
    free = F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_nr"))
    level = F.min_by("_level", free).over(everything)
    return src.select("source", "source_size", F.coalesce(F.least(F.col("_cap").cast("double"), F.col("_w") * level), F.col("_cap").cast("double")).alias("target"))


def plan(sized: DataFrame, weights=(5, 2, 1), cap: int = 3, seed: int = 0, salts: int = SALTS, ties: tuple[str, ...] = ()) -> DataFrame:
    """Rows of `sized` (doc_id, source, size and any others) with source_size, target, copies and taken.

    Systematic sampling: within a source, documents stand from long to short (by size class, then salt, then hash),
    each is expected target / source_size times, and a document is emitted once for each integer that the running sum
    of expected copies plus the source's one offset passes. As neighbours have like sizes, the words taken stay within
    about one long document of the target. The running sum is a count of rows before, times the rate; counts come from
    a small table per (source, class, salt), and only rows inside such a group are ranked together, so a source with a
    third of all rows is spread over many tasks.
    Nulls: a null source is a source of its own; a null doc_id or text (size 0) is a row like others. Repeated rows are
    sampled one by one. An empty table gives an empty result. Reruns agree, as all choices are hashes; rows with equal (or
    null) doc_id and equal size stand in the order of the columns `ties`.
    """
    rows = (
        sized.withColumn("_null", F.col("source").isNull())
        .withColumn("_key", F.coalesce("source", F.lit("")))
        .withColumn("_class", _size_class(F.col("size")))
        .withColumn("_hash", _uniform(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
        .withColumn("_salt", F.col("_hash") % salts)
    )
    keys = ["_null", "_key", "_class", "_salt"]
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    running = W.partitionBy("_null", "_key").orderBy(F.desc("_class"), "_salt").rowsBetween(W.unboundedPreceding, -1)
    per_source = targets(sized, weights, cap).select(
        F.col("source").isNull().alias("_null"),
        F.coalesce("source", F.lit("")).alias("_key"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("_rate"),
        (_uniform(F.concat(F.lit(f"{seed}/"), F.coalesce("source", F.lit("null")))) / float(1 << 32)).alias("_offset"),
    )
    groups = counts.withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0))).join(per_source, ["_null", "_key"]).drop("_n")
    rank = F.row_number().over(W.partitionBy(*keys).orderBy("_hash", "doc_id", "size", *ties))
    passed = lambda k: F.floor(F.col("_rate") * k + F.col("_offset"))
    return (
        rows.join(groups, keys)
        .withColumn("_pos", F.col("_before") + rank)
        .withColumn("copies", passed(F.col("_pos")) - passed(F.col("_pos") - 1))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop(*OWN)
    )


def mix(docs: DataFrame, weights=(5, 2, 1), cap: int = 3, seed: int = 0) -> DataFrame:
    """The mixed corpus: rows of `docs`, each as many times as the plan says, with the columns of `docs`. Null texts have size 0
    and are sampled like others, as are null sources and ids and repeated rows; a very long text counts as one document of
    its size. An empty table gives no rows."""
    out = docs.columns
    tie = F.xxhash64(*(F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind))
    kept = docs.select(F.struct(*(F.col(f"`{c}`") for c in out)).alias("_row"), "doc_id", "source", words(F.col("text")).alias("size"), tie.alias("_tie"))
    planned = plan(kept, weights, cap, seed, ties=("_tie",))
    repeated = planned.filter("copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"))
    return repeated.select(*(F.col(f"_row.`{c}`").alias(c) for c in out))


def digest(docs: DataFrame) -> DataFrame:
    sized = materialize(docs.select("doc_id", "source", words(F.col("text")).alias("size")), "sizes")
    return plan(sized).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
weighted AS (
  SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w, 3 * source_size AS cap FROM src),
levels AS (
  SELECT *, row_number() OVER o AS nr,
         ((sum(source_size) OVER ())::BIGINT - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)::DOUBLE
         / ((sum(w) OVER ())::BIGINT - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)::DOUBLE AS lev
  FROM weighted WINDOW o AS (ORDER BY cap::DOUBLE / w, source NULLS LAST)),
chosen AS (SELECT arg_min(lev, nr) AS lev FROM levels WHERE lev * w <= cap),
targets AS (
  SELECT source, source_size, coalesce(least(cap::DOUBLE, w * (SELECT lev FROM chosen)), cap::DOUBLE) AS target FROM levels),
classed AS (
  SELECT *, CASE WHEN size < 16 THEN size ELSE len(bin(size)) * 16 + (size >> (len(bin(size)) - 4)) END AS class, h % 64 AS salt FROM rows),
placed AS (
  SELECT c.doc_id, c.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('0/' || coalesce(c.source, 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS shift,
         row_number() OVER (PARTITION BY c.source ORDER BY class DESC, salt, h, c.doc_id) AS pos
  FROM classed c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       ((floor(rate * pos + shift) - floor(rate * (pos - 1) + shift))::BIGINT * size)::BIGINT AS taken FROM placed
"""
