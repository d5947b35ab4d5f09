"""Exact dedup by composable polynomial fingerprints and chunkwise comparison."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prumo.llm.common import SPACES, frugal, materialize

#: Fingerprints are polynomials over 2-byte digits modulo this prime, at four fixed points.
PRIME = (1 << 31) - 1
POINTS = (1_103_515_245, 1_299_709_457, 742_938_285, 950_706_376)
#: Bytes hashed on their own; a power of two. Longer texts combine the hashes of their chunks.
CHUNK = 1 << 16
#: Texts of more bytes are cut into chunks that many tasks hash side by side.
HUGE = 4 << 20
_POWERS: np.ndarray | None = None


def _powers() -> np.ndarray:
    """POINTS ** (descending exponents): column i belongs to the digit with i digits after it, from the right."""
    global _POWERS
    if _POWERS is None:
        out = np.ones((len(POINTS), CHUNK // 2), np.uint64)
        for r, x in enumerate(POINTS):
            width = 1
            while width < CHUNK // 2:
                out[r, width : 2 * width] = out[r, :width] * np.uint64(pow(x, width, PRIME)) % np.uint64(PRIME)
                width *= 2
        _POWERS = out[:, ::-1].copy()
    return _POWERS


def chunk_hash(data: bytes) -> tuple[int, ...]:
    """Hash of at most CHUNK bytes; an odd last byte gets a zero beside it (lengths are compared as well)."""
    digits = np.frombuffer(data + b"\0" * (len(data) % 2), np.uint16).astype(np.uint64)
    if not len(digits):
        return (0,) * len(POINTS)
    table = _powers()[:, CHUNK // 2 - len(digits) :]
    return tuple(int(v) for v in (digits * table).sum(axis=1) % np.uint64(PRIME))  # each product < 2**47, 2**15 of them


def combine(left: tuple[int, ...], right: tuple[int, ...], right_bytes: int) -> tuple[int, ...]:
    """Hash of a text from those of its two parts, the left one of even length: left * point**digits(right) + right."""
    n = (right_bytes + 1) // 2
    return tuple((a * pow(x, n, PRIME) + b) % PRIME for a, b, x in zip(left, right, POINTS, strict=True))


def fingerprint(data: bytes) -> tuple[int, ...]:
    total: tuple[int, ...] = (0,) * len(POINTS)
    for k in range(0, len(data), CHUNK):
        part = data[k : k + CHUNK]
        total = combine(total, chunk_hash(part), len(part)) if k else chunk_hash(part)
    return total


def _hash_chunks(batches):
    for batch in batches:
        data = batch.column("data").to_pylist()
        prints = [np.array(chunk_hash(d), "<u4").tobytes() for d in data]
        sizes = pa.array([len(d) for d in data], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("text_sha256"), batch.column("part"), sizes, pa.array(prints, pa.binary())], ["text_sha256", "part", "bytes", "print"])


def _combine_chunks(points: int):
    """The key of each text from its chunks' hashes, 24 bytes each, in order."""

    def run(batches):
        for batch in batches:
            keys = []
            for parts in batch.column("parts").to_pylist():
                total, size = (0,) * len(POINTS), 0
                for p in sorted(parts, key=lambda p: p["part"]):
                    own = tuple(np.frombuffer(p["print"], "<u4").tolist())
                    total = combine(total, own, p["bytes"]) if size else own
                    size += p["bytes"]
                keys.append(b"".join(v.to_bytes(4, "big") for v in total[:points]) + str(size).encode())
            yield pa.RecordBatch.from_arrays([batch.column("text_sha256"), pa.array(keys, pa.binary())], ["text_sha256", "key"])

    return frugal(run)


def _measure_huge(table: DataFrame, points: int) -> DataFrame:
    """What _measure gives, for texts of any length: the JVM cuts the normalised text into chunks, tasks all over hash them, and
    the hashes of each distinct text, a few bytes for each chunk, are combined by length-shifted arithmetic."""
    body = F.translate(F.coalesce("text", F.lit("")), SPACES.decode(), "").cast("binary")
    rows = table.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"), F.sha2(body, 256).alias("text_sha256"), body.alias("body"))
    places = F.sequence(F.lit(0), F.greatest(F.ceil(F.length("body") / CHUNK), F.lit(1)).cast("int") - 1)
    cut = F.transform(places, lambda i: F.struct(i.alias("part"), F.substring(F.col("body"), i * CHUNK + 1, F.lit(CHUNK)).alias("data")))
    chunks = rows.select("text_sha256", F.explode(cut).alias("c")).select("text_sha256", "c.part", "c.data").repartition("text_sha256", "part")
    hashed = chunks.mapInArrow(frugal(_hash_chunks), "text_sha256 string, part int, bytes long, print binary").dropDuplicates(["text_sha256", "part"])
    keys = hashed.groupBy("text_sha256").agg(F.collect_list(F.struct("part", "bytes", "print")).alias("parts")).mapInArrow(_combine_chunks(points), "text_sha256 string, key binary")
    return rows.drop("body").join(keys, "text_sha256").select("doc_id", "chars", "key", "text_sha256")


def normalise(text: bytes) -> bytes:
    """UTF-8 without any byte of the six white-space characters; null is passed as empty."""
    return text.translate(None, SPACES)


def _bytes(col: pa.Array) -> list[bytes]:
    return pc.fill_null(col.cast(pa.binary()), b"").to_pylist()


def _measure(points: int):
    def run(batches):
        for batch in batches:
            keys, shas = [], []
            for raw in _bytes(batch.column(1)):
                data = normalise(raw)
                keys.append(_key(data, points))
                shas.append(hashlib.sha256(data).hexdigest())
            chars = pc.fill_null(pc.utf8_length(batch.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), chars, pa.array(keys, pa.binary()), pa.array(shas, pa.string())], ["doc_id", "chars", "key", "text_sha256"])

    return frugal(run)


def _key(data: bytes, points: int) -> bytes:
    """What texts of a group share: fingerprint and length."""
    return b"".join(v.to_bytes(4, "big") for v in fingerprint(data)[:points]) + str(len(data)).encode()


def _chunks(points: int):
    """Normalised texts as rows of at most CHUNK bytes; only of rows whose text is the one that the key stands for."""

    def run(batches):
        for batch in batches:
            ids, parts, data = [], [], []
            for k, (raw, key) in enumerate(zip(_bytes(batch.column("text")), batch.column("key").to_pylist(), strict=True)):
                text = normalise(raw)
                if _key(text, points) == key:
                    for c in range(0, len(text), CHUNK):
                        ids.append(k)
                        parts.append(c // CHUNK)
                        data.append(text[c : c + CHUNK])
            took = [batch.column(c).take(pa.array(ids, pa.int64())) for c in ("doc_id", "key", "group", "leader")]
            yield pa.RecordBatch.from_arrays([*took, pa.array(parts, pa.int64()), pa.array(data, pa.binary())], ["doc_id", "key", "group", "leader", "part", "data"])

    return frugal(run)


def dedup(docs: DataFrame, points: int = len(POINTS), huge: int = HUGE) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, chars for every row of docs (doc_id, text and any others).

    Texts of equal length and fingerprint form a group. Every member but the smallest doc_id (the leader) is compared
    with the leader chunk by chunk: chunk rows meet in a join on (leader, key, part), so no text is gathered whole and a group
    with a third of all rows is a skewed join that Spark splits (spark.sql.adaptive.skewJoin, on by default). Rows that differ
    (a fingerprint collision) form a group again without the others, round by round, until all agree. Of equal texts, the one
    with most code points stays, then the smallest doc_id. Null text counts as empty; all empty texts are equal. A very long
    text (over `huge` bytes) is cut into chunks that are hashed by many tasks and combined, and compared in chunks. Rows with a null doc_id are groups of their own with null keep_id, kept. Rows that
    repeat a doc_id are each judged by their own text, so that one doc_id may be in several groups; those that repeat the text
    as well are all kept or all dropped (texts of one doc_id with one fingerprint are taken as equal, 2**-124). An empty
    table gives no rows. points: how many of the fingerprint's values to use (fewer only in tests).
    """
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    large = F.coalesce(F.octet_length("text") > huge, F.lit(False))
    small = table.filter(~large).mapInArrow(_measure(points), "doc_id long, chars long, key binary, text_sha256 string")
    facts = materialize(small.union(_measure_huge(table.filter(large), points)), "prints")
    known = facts.filter("doc_id is not null")
    settled = None
    left = known.select("doc_id", "key")
    while True:
        leaders = left.groupBy("key").agg(F.min("doc_id").alias("leader"), F.count("*").alias("n")).filter("n > 1").drop("n")
        grouped = left.join(leaders, "key", "left").select("doc_id", "key", F.coalesce("leader", "doc_id").alias("leader"), F.col("leader").isNotNull().alias("shared"))
        shared = grouped.filter("shared")
        # The chunks of members and of leaders, from one pass over the texts.
        texts = table.join(shared.select("doc_id", "key", F.col("leader").alias("group"), (F.col("doc_id") == F.col("leader")).alias("leader")).dropDuplicates(["doc_id", "key"]).hint("shuffle_hash"), "doc_id")
        rows = texts.mapInArrow(_chunks(points), "doc_id long, key binary, group long, leader boolean, part long, data binary")
        first = rows.filter("leader").select("group", "key", "part", F.col("data").alias("own")).dropDuplicates(["group", "key", "part"])
        odd = rows.filter("not leader").join(first, ["group", "key", "part"]).filter("data <> own").select("doc_id", "key").distinct()
        judged = materialize(grouped.join(odd.withColumn("odd", F.lit(True)), ["doc_id", "key"], "left").select("doc_id", "key", "leader", F.coalesce("odd", F.lit(False)).alias("odd")), "judged")
        fine = judged.filter("not odd").select("doc_id", "key", "leader")
        settled = fine if settled is None else settled.union(fine)
        left = judged.filter("odd").select("doc_id", "key")
        if left.isEmpty():
            break
    settled = settled.dropDuplicates(["doc_id", "key"])
    members = materialize(known.join(settled, ["doc_id", "key"]), "members")
    sizes = members.groupBy("leader", "key").agg(F.min_by("doc_id", F.struct(-F.col("chars"), F.col("doc_id"))).alias("keep_id"), F.count("*").alias("group_size"))
    sizes = materialize(sizes, "kept")  # on its own, so that Spark can split the join below at a very large group
    out = members.join(sizes, ["leader", "key"]).select("doc_id", "keep_id", "group_size", (F.col("doc_id") == F.col("keep_id")).alias("kept"), "text_sha256", "chars")
    alone = facts.filter("doc_id is null").select("doc_id", F.lit(None).cast("long").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256", "chars")
    return out.union(alone)


def digest(docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g
"""
