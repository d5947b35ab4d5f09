"""Shared pieces: scratch tables and vectorised word hashing over Arrow text."""

from __future__ import annotations

import atexit
import ctypes
import functools
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words: space and \t \n \v \f \r.
SPACES = b" \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

U64 = np.uint64
_SCRATCH: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a temporary folder serves if all
    runs on this machine (tests, benches); on a cluster its files would be lost to other executors, so that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _SCRATCH:
            _SCRATCH[app] = tempfile.mkdtemp(prefix="prumo-")
            atexit.register(shutil.rmtree, _SCRATCH[app], ignore_errors=True)
        base = _SCRATCH[app]
    return base.rstrip("/")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df once to the shared folder and read it back, which cuts its lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/prumo-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, tag: str) -> DataFrame:
    """As materialize, dealt out by key into as many buckets as the session has shuffle partitions, so that joins on key
    move the other side only, however many follow. The table is in the catalog only until it has been read back."""
    spark = df.sparkSession
    n, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"prumo_{tag}_{uuid.uuid4().hex}"
    df.repartition(n, key).write.bucketBy(n, key).option("path", f"{scratch_dir(spark)}/{name.replace('_', '-', 1)}").saveAsTable(name, format="parquet")
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # a table with a path of its own: the files stay
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a materialised table that nothing reads any more."""
    spark = df.sparkSession
    base = scratch_dir(spark)
    for file in df.inputFiles()[:1]:
        folder = file.rsplit("/", 1)[0]
        if "/prumo-" in folder and base.split(":", 1)[-1].strip("/") in folder:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """run for mapInArrow, giving freed memory back to the system when a task ends: Spark's Python workers live on, and what
    one stage's workers hold counts against the executors of the next."""

    @functools.wraps(run)
    def inner(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim_heap = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
            if trim_heap:
                trim_heap(0)

    return inner


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have: name, with underscores before it if need be."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: Bytes of text whose words or windows one hash bucket takes on average; a bucket is worked on as a whole by one task.
BUCKET_TEXT = 16 << 20


def buckets(spark: SparkSession) -> int:
    """Number of buckets that keeps all tasks of the session busy."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_buckets(table: DataFrame) -> int:
    """Number of hash buckets for what the texts of a table ask: by their bytes, which one cheap pass adds up, so that a bucket's
    size doesn't depend on the session's settings; and as many as keep all tasks busy."""
    total = table.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    return max(buckets(table.sparkSession), -(-total // BUCKET_TEXT))


def mix64(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


_P = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
#: What stays of eight bytes read at a place, by the bytes that still belong to the word.
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_STEP, _SIZE, _SEED = (U64(x) for x in (0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


class Spans(NamedTuple):
    """Hashes of byte spans, and their blocks of eight bytes: span i has blocks[first[i]:first[i + 1]]."""

    hashes: np.ndarray
    blocks: np.ndarray
    first: np.ndarray


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> Spans:
    """64-bit hashes of the spans buf[starts:ends], none of them empty.

    A span's blocks of eight bytes, the last one filled up with zeros, are mixed with their place each and added up; the sum
    is mixed with the length. Mixing is not linear, so unlike polynomials modulo 2**64 no family of texts is known to
    collide (Thue-Morse words among them), and spans of up to eight bytes and equal length never do. Of n distinct longer
    spans about n**2 / 2**65 pairs are taken for one. seed: another hash of the same spans, independent of the first.
    """
    size = ends - starts
    count = (size + 7) >> 3
    first = np.cumsum(count) - count
    place = np.arange(int(count.sum()), dtype=np.int64) - np.repeat(first, count)
    at = np.repeat(starts, count) + 8 * place
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(buf) + 1,), "<u8", buffer=padded, strides=(1,))
    blocks = eight[at] & _MASK[np.minimum(np.repeat(ends, count) - at, 8)]
    with np.errstate(over="ignore"):
        mixed = mix64(blocks + (place + 1).astype(U64) * _STEP + U64(seed) * _SEED)
        sums = np.add.reduceat(mixed, first) if len(first) else mixed
        return Spans(mix64(sums + size.astype(U64) * _SIZE), blocks, np.append(first, len(blocks)))


class Words(NamedTuple):
    """Words of several texts. Text d has words offsets[d]:offsets[d + 1]; word w is buf[starts[w]:ends[w]]."""

    hashes: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    buf: np.ndarray


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string array; null counts as empty."""
    col = pc.fill_null(col, "").cast(pa.large_string())
    bounds = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, bounds - bounds[0]


def hash_words(col: pa.Array, lower: bool, seed: int = 0) -> Words:
    """Split texts at ASCII white space and give each word a 64-bit hash (see hash_spans), with A-Z as a-z if lower."""
    buf, bounds = text_buffer(col)
    n = len(buf)
    if not n:
        empty = np.zeros(0, np.int64)
        return Words(np.zeros(0, U64), np.zeros(len(bounds), np.int64), empty, empty, buf)
    word = ~_IS_SPACE[buf]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = bounds[(bounds > 0) & (bounds < n)]
    first[inner] |= word[inner]
    last[inner - 1] |= word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = hash_spans(_LOWER[buf] if lower else buf, starts, ends, seed).hashes
    return Words(hashes, np.searchsorted(starts, bounds), starts, ends, buf)


_EDGE = np.array([33 <= c < 127 and not chr(c).isalnum() for c in range(256)])  # ASCII punctuation


def trim(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words without ASCII punctuation at their ends: flags of those that aren't empty then, and of these the starts, the
    ends and the hashes with A-Z as a-z."""
    buf, starts, ends = words.buf, words.starts.copy(), words.ends.copy()
    for edge, step in ((starts, 1), (ends, -1)):
        left = np.arange(len(starts))
        while len(left):
            left = left[(starts[left] < ends[left]) & _EDGE[buf[np.minimum(edge[left] - (step < 0), len(buf) - 1)]]]
            edge[left] += step
    full = starts < ends
    starts, ends = starts[full], ends[full]
    return full, starts, ends, hash_spans(_LOWER[buf], starts, ends).hashes


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on; one entry for each position that has k words.

    A polynomial over word hashes modulo 2**64. Sequences that collide whatever the base (Thue-Morse words) have 1,024
    terms at least, so k is 512 at most.
    """
    if k > 512:
        raise ValueError("windows of more than 512 words")
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    done, width, power = 0, 1, _P
    block = hashes  # block[i]: hash of the `width` words from i on, unmixed
    need, shift = k, U64(1)
    while True:  # binary composition: hash(a + b) = hash(a) + P**len(a) * hash(b)
        if need & 1:
            out += shift * block[done : done + n]
            done += width
            shift = U64((int(shift) * power) % (1 << 64))
        need >>= 1
        if not need:
            break
        block = block[:-width] + U64(power) * block[width:]
        width, power = 2 * width, (power * power) % (1 << 64)
    return mix64(out + U64(k))


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about `most` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(size) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def pack(batch: pa.RecordBatch) -> bytes:
    """A batch as compressed bytes, so that a chunk of rows travels as one small value."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_all().combine_chunks().to_batches()[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Regroup rows into batches of about `most` bytes of text, across the borders of the incoming batches."""
    held: list[pa.RecordBatch] = []
    size = 0
    for whole in batches:
        for part in slices(whole, column, most):
            own = pc.sum(pc.binary_length(part.column(column))).as_py() or 0
            if held and size + own > most:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            held.append(part)
            size += own
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def ask(values: np.ndarray, n_buckets: int) -> list[tuple[int, np.ndarray]]:
    """Ascending distinct hashes, cut into hash-range buckets."""
    home = ((values >> U64(32)) * U64(n_buckets)) >> U64(32)
    cuts = np.r_[np.flatnonzero(np.r_[True, home[1:] != home[:-1]]), len(home)] if len(values) else np.zeros(1, np.int64)
    return [(int(home[a]), values[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
