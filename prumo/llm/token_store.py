"""Token-ID output: documents as byte-level BPE ids in wavelet-matrix shards, and reading them back."""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from prumo.llm.common import _IS_SPACE, U64, chunks, frugal, hash_spans, scratch_dir, slices, text_buffer

#: Bytes of text in a shard, about; a longer document is a shard of its own.
SHARD = 4 << 20
END = 2

_ALNUM = np.array([chr(c).isalnum() and c < 128 for c in range(256)])
_SUSPECT = np.array([c in (0xC2, 0xE1, 0xE2, 0xE3, 0x3C) for c in range(256)])  # first bytes of Unicode white space and "<|"
_PUNCTUATION = np.array([33 <= c < 127 and not chr(c).isalnum() for c in range(256)])


class Pool:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self.data, self.n = np.zeros(1 << 12, kind), 0

    def add(self, values: np.ndarray) -> None:
        end = self.n + len(values)
        if end > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.zeros(max(end, 3 * len(self.data) // 2) - self.n, self.data.dtype)])
        self.data[self.n : end] = values
        self.n = end


class Pieces:
    """Ids of pieces, found by their hashes and compared by their bytes; about 45 bytes a piece."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.hashes, self.row = np.zeros(0, U64), np.zeros(0, np.int32)  # in ascending order of hashes
        self.size, self.first, self.blocks = Pool(np.int32), Pool(np.int32), Pool(np.uint64)  # bytes, and where their blocks lie
        self.at, self.count, self.ids = Pool(np.int32), Pool(np.int32), Pool(np.int32)

    def find(self, hashes: np.ndarray, size: np.ndarray, first: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of pieces (-1: not held), and flags of those whose hash is held for other bytes."""
        if not len(self.hashes):
            return np.full(len(hashes), -1), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        number = np.where(self.hashes[at] == hashes, self.row[at], -1).astype(np.int64)
        held = np.flatnonzero(number >= 0)
        row = number[held]
        wrong = np.zeros(len(hashes), bool)
        wrong[held] = self.size.data[row] != size[held]
        wrong[_unlike(held[~wrong[held]], size, (first, blocks), (number, self.first.data, self.blocks.data))] = True
        return number, wrong

    def add(self, hashes: np.ndarray, size: np.ndarray, first: np.ndarray, blocks: np.ndarray, count: np.ndarray, ids: np.ndarray) -> None:
        rows = self.size.n + np.arange(len(hashes))
        n = (size + 7) >> 3
        own = np.cumsum(n) - n
        self.first.add(self.blocks.n + own)
        self.blocks.add(blocks[np.repeat(first - own, n) + np.arange(int(n.sum()))])
        self.size.add(size)
        self.at.add(self.ids.n + np.cumsum(count) - count)
        self.count.add(count)
        self.ids.add(ids)
        order = np.argsort(hashes)
        place = np.searchsorted(self.hashes, hashes[order])
        self.hashes, self.row = np.insert(self.hashes, place, hashes[order]), np.insert(self.row, place, rows[order])


def _unlike(which: np.ndarray, size: np.ndarray, mine: tuple, other: tuple) -> np.ndarray:
    """Of the pieces `which`, of equal size and hash to their counterparts, those of over 8 bytes whose bytes differ (shorter
    ones of equal size and hash are equal). mine: first block of each piece, blocks; other: counterpart of each piece, first
    block of each counterpart, blocks."""
    (first, blocks), (speaks, firsts, others) = mine, other
    long = which[size[which] > 8]
    n = (size[long] + 7) >> 3
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    differ = blocks[np.repeat(first[long], n) + inside] != others[np.repeat(firsts[speaks[long]], n) + inside]
    return np.repeat(long, n)[differ]


class Encoder:
    """Encodes many texts with a byte-level BPE tokenizer, each distinct piece once.

    The tokenizer's pattern always starts a new piece at a space before a character that isn't white space, at ASCII
    punctuation after a letter or digit, and at and after a line break that stands alone; merges never cross pieces. So
    texts are cut there, and a piece's ids don't depend on its neighbours. Texts with Unicode white space or with "<|"
    (special tokens) are left to the tokenizer whole.
    Equal pieces are found by their hashes and then compared byte by byte with the one that speaks for them; a text with a
    piece that differs is left to the tokenizer whole. pieces: those known so far, emptied when there are more than MOST.
    """

    MOST = 1_000_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        model = self.tokenizer.model
        if hasattr(model, "_resize_cache"):  # it only sees pieces that it hasn't seen, so its own cache never helps
            model._resize_cache(0)
            self.tokenizer.model = model
        self.pieces = Pieces()
        vocab = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, number in vocab.items():
            self.width[number] = len(token)  # one character a byte

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)

    def _learn(self, buf: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order of the pieces buf[starts:starts + size], and in it how many ids each has, and these. Pieces that start with
        a space are encoded as one text and told apart by their bytes."""
        spaced = buf[starts] == 0x20
        order = np.r_[np.flatnonzero(spaced), np.flatnonzero(~spaced)]
        sizes, parts, n = np.zeros(len(starts), np.int64), [], int(spaced.sum())
        if n:
            own = size[order[:n]]
            cuts = np.cumsum(own)
            joint = buf[np.repeat(starts[order[:n]] - (cuts - own), own) + np.arange(int(cuts[-1]))].tobytes().decode()
            ids = np.array(self.tokenizer.encode_batch_fast([joint], add_special_tokens=False)[0].ids, np.int32)
            ends = np.cumsum(self.width[ids])
            places = np.searchsorted(ends, cuts)
            if places[-1] >= len(ends) or (ends[places] != cuts).any():
                raise ValueError("the tokenizer doesn't start pieces at spaces")
            sizes[:n] = np.diff(places, prepend=-1)
            parts.append(ids)
        texts = [buf[a : a + k].tobytes().decode() for a, k in zip(starts[order[n:]].tolist(), size[order[n:]].tolist(), strict=True)]
        rest = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes[n:] = [len(r) for r in rest]
        parts.append(np.array([i for r in rest for i in r], np.int32))
        return order, sizes, np.concatenate(parts)

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (each followed by END), and how many each text has. Null counts as empty."""
        buf, bounds = text_buffer(col)
        n = len(buf)
        odd = np.zeros(len(col), bool)
        if n:
            at = np.flatnonzero(_SUSPECT[buf[:-1]])
            a, b, c = buf[at], buf[at + 1], buf[np.minimum(at + 2, n - 1)]
            hit = (a == 0x3C) & (b == 0x7C) | (a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & (b == 0x9A) | (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c >= 0xA8)) | (a == 0xE2) & (b == 0x81) | (a == 0xE3) & (b == 0x80) & (c == 0x80)
            odd[np.searchsorted(bounds, at[hit], "right") - 1] = True
        filled = bounds[1:] > bounds[:-1]
        first = np.zeros(n, bool)
        if n:
            space = _IS_SPACE[buf]
            first[:-1] = (buf[:-1] == 0x20) & ~space[1:]
            first[bounds[1:][filled] - 1] = False  # a space at the end of a text; the next text's first byte may follow it
            letter = _ALNUM[buf]
            letter[1:] |= (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] != 0x97) & (buf[1:] != 0xB7)
            first[1:] |= _PUNCTUATION[buf[1:]] & letter[:-1] | (buf[1:] == 0x0A) & ~space[:-1]
            first[2:] |= ~space[2:] & (buf[1:-1] == 0x0A) & ~space[:-2]
            first[bounds[:-1][filled]] = True
        starts = np.flatnonzero(first)
        ends = np.r_[starts[1:], n] if len(starts) else starts
        hashes, blocks, first = hash_spans(buf, starts, ends)
        size = ends - starts
        which, keys = pd.factorize(hashes)  # a hash table, where np.unique sorts
        index = np.zeros(len(keys), np.int64)
        index[which] = np.arange(len(which))  # any occurrence
        speaks = index[which]
        wrong = size != size[speaks]
        wrong[_unlike(np.flatnonzero(~wrong & (speaks != np.arange(len(speaks)))), size, (first, blocks), (speaks, first, blocks))] = True
        held = self.pieces
        if len(held.hashes) > self.MOST:
            held.clear()
        number, other = held.find(keys, size[index], first[index], blocks)
        wrong |= other[which]
        odd[np.searchsorted(bounds, starts[wrong], "right") - 1] = True
        new = index[number < 0]
        if len(new):
            order, count, learnt = self._learn(buf, starts[new], size[new])
            new_numbers = np.empty(len(new), np.int64)
            new_numbers[order] = held.size.n + np.arange(len(new))
            number[number < 0] = new_numbers
            held.add(hashes[new][order], size[new][order], first[new][order], blocks, count, learnt)
        number = number[which]
        place = np.searchsorted(starts, bounds)  # pieces before each text
        number = np.insert(number, place[1:], -1)  # -1: the end of a text
        size = np.where(number >= 0, held.count.data[number], 1).astype(np.int64)
        before = np.cumsum(size) - size
        ids = held.ids.data[np.repeat(np.where(number >= 0, held.at.data[number], 0) - before, size) + np.arange(int(size.sum()))]
        stop = np.flatnonzero(number < 0)
        ids[before[stop]] = END
        edges = np.r_[0, before[stop] + 1]
        if odd.any():
            parts = [np.append(self._whole(t), END) if bad else p for t, bad, p in zip(col.to_pylist(), odd.tolist(), np.split(ids, edges[1:-1]), strict=True)]
            return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return ids, np.diff(edges)


#: By tokenizer file: the encoder that the tasks of a worker share.
_ENCODERS: dict[str, Encoder] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _shards(path: str | None, most: int):
    def run(batches):
        from prumo.llm.wavelet import write_shard

        file = path or default_tokenizer()
        if file not in _ENCODERS:
            _ENCODERS[file] = Encoder(file)
        enc, task, k = _ENCODERS[file], TaskContext.get().partitionId(), 0
        for part in chunks(batches, "text", most):
            parts, lengths = zip(*(enc.encode(s.column("text")) for s in slices(part, "text", 2 << 20)), strict=True)
            docs, ids, lengths = part.column("doc_id").to_pylist(), np.concatenate(parts), np.concatenate(lengths)
            yield pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), pa.array([k], pa.int32()), pa.array([len(docs)], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([write_shard(docs, lengths, ids)], pa.binary())], ["part", "shard", "n_docs", "n_ids", "payload"])
            k += 1

    return frugal(run)


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, shard_bytes: int = SHARD) -> None:
    """Encode every text of docs (doc_id, text and any others) and write the shards in ascending doc_id order.

    Documents are range-partitioned and sorted by doc_id (null first; rows that repeat a doc_id by text); each task cuts
    its range into shards of about shard_bytes of text. A shard is one self-contained compressed file image, held as the
    binary column `payload` of a Parquet table, because Spark's own writers commit such files once, on any file system,
    whatever executors are lost. Columns part and shard give the order. tokenizer: a file that every executor can open;
    by default that of the installed public_tokenizers. An empty table writes no shard.
    """
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    table.mapInArrow(_shards(tokenizer, shard_bytes), "part int, shard int, n_docs long, n_ids long, payload binary").write.parquet(path)


def _read(batches):
    from prumo.llm.wavelet import read_shard

    for batch in batches:
        for before, payload in zip(batch.column("before").to_pylist(), batch.column("payload"), strict=True):
            docs, matrix = read_shard(payload.as_py())
            ids = matrix.decode().astype("<u4")
            edges = np.r_[0, np.cumsum(docs["length"].astype(np.int64))]
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(docs["doc_id"], pa.int64(), mask=docs["null"].astype(bool)), pa.array(edges[:-1] + before, pa.int64()), pa.array(np.diff(edges), pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the shards at path, from decoding them.

    Starts need the ids before each shard: sums per part (as many as range partitions) are accumulated over the parts,
    and those of a part's shards within the part, so no task sees all shards.
    """
    shards = spark.read.parquet(path)
    inside = W.partitionBy("part").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    across = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("_n")).select("part", F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_parts"))
    starts = shards.select("part", "shard", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("_own")).join(parts, "part").select("part", "shard", (F.col("_parts") + F.col("_own")).alias("before"))
    return shards.join(starts.hint("shuffle_hash"), ["part", "shard"]).select("before", "payload").mapInArrow(frugal(_read), "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Writes docs as shards into the shared folder and returns what reading them back gives. Null texts are encoded as empty
    ones (the end id only), a very long text is a shard of its own; for other cases see write_tokens."""
    spark = docs.sparkSession
    path = f"{scratch_dir(spark)}/prumo-tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, tokenizer)
    return read_tokens(spark, path)


def digest(docs: DataFrame) -> DataFrame:
    return tokens(docs)
