"""Line dedup: lines found in many documents stay in one document only."""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prumo.llm.common import SPACES, materialize

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _hashes(text: bytes, least: int) -> list[bytes | None]:
    """128-bit hash of each line's key: the line without white space at its ends, with A-Z as a-z; None for a key of
    fewer than `least` code points."""
    out: list[bytes | None] = []
    for line in text.translate(_LOWER).split(b"\n"):
        key = line.strip(SPACES)
        n = len(key)
        if n >= least and (n >= 4 * least or len(key.decode()) >= least):
            out.append(xxhash.xxh3_128_digest(key))
        else:
            out.append(None)
    return out


def _count(least: int):
    def run(batches):
        for batch in batches:
            count: dict[bytes, int] = {}
            largest: dict[bytes, int] = {}
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if doc is not None:
                    for h in set(_hashes(text or b"", least)) - {None}:
                        count[h] = count.get(h, 0) + 1
                        largest[h] = max(doc, largest.get(h, doc))
            yield pa.RecordBatch.from_pydict({"hash": pa.array(count.keys(), pa.binary()), "n": pa.array(count.values(), pa.int64()), "keeper": pa.array(largest.values(), pa.int64())})

    return run


def _where(least: int):
    def run(batches):
        for batch in batches:
            docs, found = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if doc is not None:
                    own = set(_hashes(text or b"", least)) - {None}
                    docs += [doc] * len(own)
                    found += own
            yield pa.RecordBatch.from_pydict({"hash": pa.array(found, pa.binary()), "doc_id": pa.array(docs, pa.int64())})

    return run


def _drop(least: int):
    def run(batches):
        for batch in batches:
            out = []
            for doc, text, drops in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                lines = (text or b"").split(b"\n")
                if drops:
                    gone = set(drops)
                    kept = [line for line, h in zip(lines, _hashes(text or b"", least), strict=True) if h not in gone]
                else:
                    kept = lines
                out.append((doc, b"\n".join(kept).decode(), len(lines), len(lines) - len(kept)))
            cols = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())], ["doc_id", "kept_text", "n_lines", "n_dropped"])

    return run


def dedup_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """doc_id, kept_text, n_lines, n_dropped for every row of docs (doc_id, text and any others).

    Lines are exploded inside tasks to 128-bit hashes of their keys, counted per batch and then by Spark, so that a line
    of every document arrives once for each batch. Hashes of at least least_docs documents are joined back to the
    documents that hold them; there the lines go, except in the largest doc_id, and the rest keep their places.
    Null or empty text: one empty line, kept. A very long text is split by the task that reads it. A null doc_id counts for
    nothing and its text stays whole. Rows that repeat a doc_id are one document: a line counts once for them, and the keeper
    keeps it in all its rows; such rows are found first and counted as distinct (line, document) pairs. Ties do not arise, as
    doc_id decides. An empty table gives no rows.
    """
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    several = materialize(table.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows > 1").select("doc_id"), "several")
    once, again = (table, None) if several.isEmpty() else (table.join(several, "doc_id", "left_anti"), table.join(several, "doc_id", "left_semi"))
    counts = once.mapInArrow(_count(least_chars), "hash binary, n long, keeper long")
    if again is not None:
        counts = counts.union(again.mapInArrow(_where(least_chars), "hash binary, doc_id long").distinct().select("hash", F.lit(1).cast("long"), "doc_id"))
    hot = counts.groupBy("hash").agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper")).filter(F.col("n") >= least_docs)
    hot = materialize(hot, "lines")  # on its own, so that Spark can split the join below at a line that very many have
    held = table.mapInArrow(_where(least_chars), "hash binary, doc_id long")
    drops = held.join(hot, "hash").filter("doc_id < keeper").groupBy("doc_id").agg(F.collect_set("hash").alias("drops"))
    return table.join(drops.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", "drops").mapInArrow(_drop(least_chars), "doc_id long, kept_text string, n_lines long, n_dropped long")


def digest(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH split AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT row, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM split),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
hot AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT d.*, h.k IS NOT NULL AND d.doc_id <> h.keeper AS gone FROM keyed d LEFT JOIN hot h ON d.k = h.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY row, doc_id
"""
