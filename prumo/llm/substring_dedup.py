"""Substring dedup: words covered by a repeated window of words go, found level by level with doubled lengths."""

from __future__ import annotations

from itertools import compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prumo.llm.common import U64, Words, ask, bucketed, chunks, frugal, hash_words, materialize, pack, text_buckets, unpack, windows

#: Bytes of text in a chunk.
CHUNK = 2 << 20
#: Lengths that are counted, each twice the one before; the last is the length asked for.
LEVELS = 3
_CHUNKS = "chunk long, body binary"
_STATE = "chunk long, open binary, alive binary"


class Level(NamedTuple):
    """Windows of a chunk at one length: documents that are open, their words, the starts of full windows that are alive,
    for each start the number of its window's key among the distinct keys, these in ascending order (a column for each hash),
    and flags of keys at several places."""

    open: np.ndarray
    words: Words
    starts: np.ndarray
    which: np.ndarray
    keys: list[np.ndarray]
    several: np.ndarray


def _starts(offsets: np.ndarray, length: int) -> np.ndarray:
    """Positions from which a document has `length` words."""
    ends = np.repeat(offsets[1:], np.diff(offsets))
    return np.flatnonzero(np.arange(len(ends)) + length <= ends)


def _anchors(every: np.ndarray, span: int) -> np.ndarray:
    """For each position, the place of the least of `span` values from there on (the first of equals)."""
    least, place, width = every, np.arange(len(every)), 1
    while width < span:
        step = min(width, span - width)
        later = least[step:] < least[:-step]
        least, place = np.where(later, least[step:], least[:-step]), np.where(later, place[step:], place[:-step])
        width += step
    return place


def _distinct(keys: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct rows of some columns in ascending order, the number of each row among them, and how often each occurs."""
    order = np.lexsort(keys[::-1])
    sorted_ = [k[order] for k in keys]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in sorted_:
        new[1:] |= k[1:] != k[:-1]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return [k[first] for k in sorted_], which, np.diff(np.append(first, len(order)))


def _level(part: pa.RecordBatch, row: dict, length: int, base: int, first: bool) -> Level:
    """The windows of `base` words that speak for the full windows still alive; the first level has all full windows."""
    own = np.ones(part.num_rows, bool)
    if not first:
        own = np.unpackbits(np.frombuffer(row["open"] or b"", np.uint8), count=part.num_rows).astype(bool) if row["open"] else ~own
        part = part.filter(pa.array(own))
    words = hash_words(part.column("text"), lower=False)
    starts = _starts(words.offsets, length) if first else np.flatnonzero(np.unpackbits(np.frombuffer(row["alive"] or b"", np.uint8), count=len(words.hashes)))
    if not len(starts):
        return Level(own, words, starts, starts, [np.zeros(0, U64)] * (1 + (base == length)), np.zeros(0, bool))
    every = windows(words.hashes, base)
    anchor = _anchors(every, length - base + 1)[starts]
    places = np.unique(anchor)
    keys = [every[places]]
    if base == length:
        keys.append(windows(hash_words(part.column("text"), lower=False, seed=1).hashes, base)[places])
    values, which, count = _distinct(keys)
    return Level(own, words, starts, which[np.searchsorted(places, anchor)], values, count > 1)


def _answer(answers: list[dict] | None) -> np.ndarray:
    """Flags for the distinct keys that a chunk asked about, in ascending order."""
    parts = [np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=a["n"]).astype(bool) for a in sorted(answers or [], key=lambda a: a["bucket"])]
    return np.concatenate(parts) if parts else np.zeros(0, bool)


def _asks(n_buckets: int, length: int, base: int, first: bool):
    """Each chunk's distinct keys. Up to the last level two may be taken for one, as the last decides, so that five bytes
    beside the bucket do; the last sends both of its hashes."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys = _level(unpack(row["body"]), row, length, base, first).keys
                asked, at, blobs = ask(keys[0], n_buckets), 0, []
                for _, v in asked:
                    if len(keys) == 1:
                        blobs.append((v & U64(0xFFFFFFFF)).astype(np.uint32).tobytes() + (v >> U64(32)).astype(np.uint8).tobytes())
                    else:
                        blobs.append(v.tobytes() + keys[1][at : at + len(v)].tobytes())
                    at += len(v)
                yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in asked], pa.int32()), pa.array([row["chunk"]] * len(asked), pa.int64()), pa.array([len(v) for _, v in asked], pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "chunk", "n", "blob"])

    return frugal(run)


def _repeated(table: pa.Table) -> pa.Table:
    """For each chunk's keys of this bucket, whether another chunk has them too."""
    counts, blobs = table.column("n").to_pylist(), table.column("blob").to_pylist()
    if len(blobs[0]) == 16 * counts[0]:
        keys = [np.concatenate([np.frombuffer(b, np.uint64, n, 8 * n * k) for b, n in zip(blobs, counts, strict=True)]) for k in (0, 1)]
    else:
        keys = [np.concatenate([np.frombuffer(b, np.uint32, n).astype(U64) | np.frombuffer(b, np.uint8, n, 4 * n).astype(U64) << U64(32) for b, n in zip(blobs, counts, strict=True)])]
    _, which, count = _distinct(keys)
    flags = np.split(count[which] > 1, np.cumsum(counts)[:-1])
    return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "n": table.column("n"), "bits": pa.array([np.packbits(f).tobytes() for f in flags], pa.binary())})


def _first(most: int):
    def run(batches):
        task, k = TaskContext.get().partitionId(), 0
        for part in chunks(batches, "text", most):
            yield pa.RecordBatch.from_arrays([pa.array([(task << 32) + k]), pa.array([pack(part)], pa.binary())], ["chunk", "body"])
            k += 1

    return frugal(run)


def _extend(length: int, base: int, first: bool):
    """For chunks with surviving windows: flags of the documents that have some, and of the starts among their words."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                part = unpack(row["body"])
                now = _level(part, row, length, base, first)
                flags = np.zeros(len(now.words.hashes), bool)
                flags[now.starts] = (_answer(row["answers"]) | now.several)[now.which]
                if not flags.any():
                    continue
                sums, offsets = np.r_[0, np.cumsum(flags)], now.words.offsets
                some = sums[offsets[1:]] > sums[offsets[:-1]]
                own = np.zeros(part.num_rows, bool)
                own[np.flatnonzero(now.open)[some]] = True
                alive = flags[np.repeat(some, np.diff(offsets))]
                yield pa.RecordBatch.from_arrays([pa.array([row["chunk"]]), pa.array([np.packbits(own).tobytes()], pa.binary()), pa.array([np.packbits(alive).tobytes()], pa.binary())], ["chunk", "open", "alive"])

    return frugal(run)


def _remove(length: int, first: bool):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                part = unpack(row["body"])
                now = _level(part, row, length, length, first)
                hit = now.starts[(_answer(row["answers"]) | now.several)[now.which]]
                edge = np.zeros(len(now.words.hashes) + 1, np.int64)
                np.add.at(edge, hit, 1)
                np.add.at(edge, hit + length, -1)
                stays = np.cumsum(edge[:-1]) == 0
                at = np.cumsum(now.open) - 1  # of an open document among the open ones
                kept, total, removed = [], [], []
                for d, (text, open_) in enumerate(zip(part.column("text").to_pylist(), now.open.tolist(), strict=True)):
                    own = (text or "").encode().split()
                    total.append(len(own))
                    if open_:
                        own = list(compress(own, stays[now.words.offsets[at[d]] : now.words.offsets[at[d] + 1]].tolist()))
                    removed.append(total[-1] - len(own))
                    kept.append(b" ".join(own).decode())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    return frugal(run)


def dedup_substrings(docs: DataFrame, length: int = 35, chunk_bytes: int = CHUNK, levels: int = LEVELS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text for every row of docs (doc_id, text and any others): every word covered by a
    window of `length` words that also starts anywhere else goes; the others are joined by one space.

    Level-wise doubling over `levels` lengths, of which the last is `length` and each is twice the one before (9, 18, 35).
    A level counts, for every full window still alive, the shorter window of the level's length with the least hash of those
    inside it: two equal full windows have their least window at the same place, so a full window repeats only if that one
    does. Full windows whose short window is repeated survive and are extended to the next level; documents without a
    survivor are done. The last level counts full windows by 128 bits (two independent hashes), so that of n windows about
    n**2 / 2**129 pairs are taken for equal: under 1e-14 for 10**12 windows.
    Each level is one exchange. A chunk (rows with about chunk_bytes of text, packed, written once and bucketed by its
    number) sends its distinct hashes to hash-range buckets and gets back one bit for each: does another chunk have it? Very
    frequent windows thus arrive once from each chunk, and no key gathers rows. Between levels only flags are written.
    Texts are split at ASCII white space. Null or empty text: no words, nothing removed, empty kept_text. A very long text
    is a chunk of its own. A null doc_id and rows that repeat a doc_id are rows like others, and their windows count; equal
    texts thus remove each other. An empty table gives no rows.
    """
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_buckets = text_buckets(table)
    held = bucketed(table.mapInArrow(_first(chunk_bytes), _CHUNKS), "chunk", "chunks")
    state = None
    for k in reversed(range(levels)):
        base, first = -(-length // 2**k), state is None
        asking = held if first else held.join(state.hint("shuffle_hash"), "chunk")
        asks = asking.mapInArrow(_asks(n_buckets, length, base, first), "bucket int, chunk long, n int, blob binary")
        replies = asks.groupBy("bucket").applyInArrow(_repeated, "chunk long, bucket int, n int, bits binary")
        answers = replies.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "n", "bits")).alias("answers"))
        if k:
            state = materialize(asking.join(answers.hint("shuffle_hash"), "chunk").mapInArrow(_extend(length, base, first), _STATE), "alive")
    every = held if first else held.join(state.hint("shuffle_hash"), "chunk", "left")
    return every.join(answers.hint("shuffle_hash"), "chunk", "left").mapInArrow(_remove(length, first), "doc_id long, n_words long, n_removed long, kept_text string")


def digest(docs: DataFrame) -> DataFrame:
    return dedup_substrings(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(ws) - 33)) AS s FROM w),
win AS (SELECT t.doc_id, s, md5(array_to_string(ws[s:s + 34], ' ')) AS h FROM starts t JOIN w ON t.doc_id = w.doc_id),
rep AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
hit AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM win WHERE h IN (SELECT h FROM rep)),
pos AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM w),
kept AS (SELECT a.doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY a.p) AS body FROM pos a LEFT JOIN hit b ON a.doc_id = b.doc_id AND a.p = b.p WHERE b.p IS NULL GROUP BY a.doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""
