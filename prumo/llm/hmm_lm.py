"""Language-model scoring by a hidden Markov model with word emissions."""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prumo.llm.common import U64, ask, buckets, chunks, frugal, hash_words, materialize, slices, text_buckets

STATES = 8
#: Classes that words fall into by their hash, and that share emissions while the states are trained; the last round parts them.
CLASSES = 1 << 15
#: Baum-Welch rounds over all training texts with shared emissions, at most; they end when a round raises the log-likelihood
#: of the training texts by less than SETTLED of it.
ROUNDS = 3
SETTLED = 5e-4
#: The starting point comes from this many training texts at most (first by md5(doc_id)) of at most SAMPLE_BYTES each.
SAMPLE_DOCS = 600
SAMPLE_BYTES = 1 << 16
#: Tokens that Baum-Welch takes as one sequence; longer texts are cut into several. Scores are of whole texts.
SEGMENT = 128
#: Bytes of text in a chunk, about.
CHUNK = 16 << 20
#: Stands for the end of a text.
END = U64(0x9D39247E33776D41)
#: Sequences that are worked on together.
BATCH = 1024
_LONG = 1024
#: Tokens of a chunk that an E-step takes at once, about.
PIECE = 1 << 18


class Chain(NamedTuple):
    start: np.ndarray  # (K,)
    step: np.ndarray  # (K, K)


def tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes (A-Z as a-z) with END after each text, and the texts' offsets."""
    words = hash_words(batch.column("text"), lower=True)
    offsets = words.offsets + np.arange(len(words.offsets))
    return np.insert(words.hashes, words.offsets[1:], END), offsets


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def _batches(sizes: np.ndarray):
    order = np.argsort(-sizes, kind="stable")
    for a in range(0, len(order), BATCH):
        yield order[a : a + BATCH]


def expect(codes: np.ndarray, offsets: np.ndarray, emit: np.ndarray, chain: Chain) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One E-step: expected emissions (codes, K), transitions (K, K) and starts (K,) by scaled forward-backward."""
    return expect_all(codes, offsets, emit, chain)[:3]


def expect_all(codes: np.ndarray, offsets: np.ndarray, emit: np.ndarray, chain: Chain) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """As expect, with the natural logarithm of the sequences' likelihood."""
    k = emit.shape[1]
    cuts = [np.arange(a, b, SEGMENT) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    if not cuts:
        return np.zeros((len(emit), k)), np.zeros((k, k)), np.zeros(k), 0.0
    begins = np.concatenate(cuts)
    first = np.zeros(len(codes) + 1, bool)
    first[offsets[:-1]] = True
    ends = np.minimum(begins + SEGMENT, np.repeat(offsets[1:], [len(c) for c in cuts]))
    sizes = ends - begins
    middle = np.linalg.matrix_power(chain.step.T, 64)[:, 0]  # how states lie within a text
    post = np.empty((len(codes), k), np.float32)
    moves, starts, likelihood = np.zeros((k, k)), np.zeros(k), 0.0
    for own in _batches(sizes):
        begin, size = begins[own], sizes[own]
        active = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")  # sequences longer than t
        fronts, scales, emissions = [], [], []
        for t in range(int(size[0])):
            n = int(active[t])
            b = emit[codes[begin[:n] + t]]
            a = (fronts[-1][:n] @ chain.step if t else np.where(first[begin][:, None], chain.start, middle)) * b
            s = a.sum(axis=1, keepdims=True)
            fronts.append(a / s)
            scales.append(s)
            emissions.append(b)
        likelihood += float(np.log(np.concatenate(scales)).sum(dtype=float))
        back = np.ones((len(own), k), emit.dtype)
        for t in range(int(size[0]) - 1, -1, -1):
            n = int(active[t])
            if t + 1 < len(fronts):
                m = int(active[t + 1])
                ahead = emissions[t + 1] * back[:m] / scales[t + 1]
                moves += fronts[t][:m].T @ ahead
                back[:m] = ahead @ chain.step.T
            p = fronts[t] * back[:n]
            p /= p.sum(axis=1, keepdims=True)
            post[begin[:n] + t] = p
        starts += p[first[begin]].sum(axis=0)
    out = np.stack([np.bincount(codes, weights=post[:, j], minlength=len(emit)) for j in range(k)], axis=1)
    return out, moves * chain.step, starts, likelihood


def log10_likelihood(codes: np.ndarray, offsets: np.ndarray, emit: np.ndarray, chain: Chain) -> np.ndarray:
    """log10 of each text's probability by the scaled forward recursion, exact for whole texts of any length.

    Long texts are cut into segments whose K x K transfer matrices are computed side by side and then multiplied in order.
    """
    sizes = np.diff(offsets)
    out = np.zeros(len(sizes))
    short = np.flatnonzero(sizes <= _LONG)
    for own in _batches(sizes[short]):
        own = short[own]
        begin, size = offsets[own], sizes[own]
        active = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")
        total, a = np.zeros(len(own)), None
        for t in range(int(size[0])):
            n = int(active[t])
            a = (a[:n] @ chain.step if t else chain.start) * emit[codes[begin[:n] + t]]
            s = a.sum(axis=1)
            total[:n] += np.log10(s)
            a /= s[:, None]
        out[own] = total
    k = len(chain.start)
    for doc in np.flatnonzero(sizes > _LONG).tolist():
        begin, n = int(offsets[doc]), int(sizes[doc])
        a = chain.start * emit[codes[begin]]
        s = a.sum()
        total, a = np.log10(s), a / s
        width = max(64, int(np.sqrt(n)))
        rows = codes[begin + 1 : begin + n]
        full = len(rows) // width
        grid = rows[: full * width].reshape(full, width)
        m, logs = np.broadcast_to(np.eye(k), (full, k, k)).copy(), np.zeros(full)
        for t in range(width):
            m = (m.reshape(-1, k) @ chain.step).reshape(full, k, k) * emit[grid[:, t]][:, None, :]
            s = m.sum(axis=(1, 2))
            logs += np.log10(s)
            m /= s[:, None, None]
        for i in range(full):
            a = a @ m[i]
            s = a.sum()
            total, a = total + np.log10(s) + logs[i], a / s
        for c in rows[full * width :].tolist():
            a = (a @ chain.step) * emit[c]
            s = a.sum()
            total, a = total + np.log10(s), a / s
        out[doc] = total
    return out


def emissions(shares: np.ndarray, counts: np.ndarray, per_state: np.ndarray, total: float, kinds: float) -> np.ndarray:
    """(words, K) probabilities. State k gives a word (n_k(w) / r_k + 1/2) / (N + (V + 1) / 2), where n_k(w) of the word's
    count fall to the state and r_k is the state's share of all tokens: the add-half estimate within the state. Over the V
    known words and one unknown they sum to 1, and states that are all alike give the base model."""
    r = np.maximum(per_state / max(total, 1.0), 1e-12)
    return (counts[:, None] * shares / r + 0.5) / (total + 0.5 * (kinds + 1))


def _normal(x: np.ndarray, add: float) -> np.ndarray:
    x = x + add
    return x / x.sum(axis=-1, keepdims=True)


class Tied(NamedTuple):
    """Expected counts of (class, state), and the chain."""

    counts: np.ndarray
    chain: Chain


def word_class(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> U64(40)).astype(np.int64) % CLASSES


def tied_emissions(model: Tied) -> np.ndarray:
    """(CLASSES, K) probabilities of classes: those of emissions() with a class as a word."""
    total = model.counts.sum(axis=1)
    return emissions(model.counts / np.maximum(total, 1e-9)[:, None], total, model.counts.sum(axis=0), total.sum(), float((total > 0).sum())).astype(np.float32)


def seed_states(docs: pa.Table, states: int = STATES, rounds: int = 10) -> Tied:
    """A start: Baum-Welch on a bounded sample, from a clustering of its texts (a mixture of class distributions)."""
    flat = Tied(np.ones((CLASSES, states)), Chain(np.full(states, 1 / states), np.full((states, states), 1 / states)))
    parts = [tokens(s) for b in docs.to_batches() for s in slices(b, "text")]
    if not parts:
        return flat
    shift = np.cumsum([0, *(len(h) for h, _ in parts)])
    offsets = np.concatenate([[0], *(o[1:] + s for (_, o), s in zip(parts, shift, strict=False))]).astype(np.int64)
    kinds, codes = np.unique(word_class(np.concatenate([h for h, _ in parts])), return_inverse=True)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    total = np.bincount(codes).astype(float)
    rng = np.random.default_rng(11)
    mine = _normal(rng.random((len(offsets) - 1, states)) ** 4, 1e-3)
    add = lambda: np.stack([np.bincount(codes, weights=mine[doc, j], minlength=len(kinds)) for j in range(states)], axis=1)
    for _ in range(40):
        logs = np.log(_normal(add().T, 0.05)).T
        fit = np.stack([np.bincount(doc, weights=logs[codes, j], minlength=len(mine)) for j in range(states)], axis=1) + np.log(mine.mean(axis=0) + 1e-6)
        mine = np.exp(0.05 * (fit - fit.max(axis=1, keepdims=True)))
        mine /= mine.sum(axis=1, keepdims=True)
    per, chain = add(), Chain(np.full(states, 1 / states), 0.9 * np.eye(states) + 0.1 / states)
    for _ in range(rounds):
        emit = emissions(per / total[:, None], total, per.sum(axis=0), float(len(codes)), float(len(kinds)))
        per, moves, starts = expect(codes, offsets, emit, chain)
        chain = Chain(_normal(starts, 0.5), _normal(moves, 0.5))
    counts = np.tile(1e-3 * per.sum(axis=0) / per.sum(), (CLASSES, 1))  # classes that the sample lacks take no side
    counts[kinds] += per
    return Tied(counts, chain)


def _learners(batch: pa.RecordBatch) -> pa.RecordBatch:
    return batch.filter(pa.array([not is_held_out(d) for d in batch.column("doc_id").to_pylist()], pa.bool_()))


def _round(model):
    """Adds up a task's expected counts: a row for each class, -1 - j for the moves from state j, then the starts, and the
    log-likelihood with the number of tokens."""

    def run(batches):
        emit, chain = model.value
        k = emit.shape[1]
        counts, moves, starts, likelihood, n = np.zeros((CLASSES, k)), np.zeros((k, k)), np.zeros(k), 0.0, 0
        for whole in batches:
            for batch in slices(whole, "text"):
                own = _learners(batch)
                if own.num_rows:
                    hashes, offsets = tokens(own)
                    c, m, s, one = expect_all(word_class(hashes), offsets, emit, chain)
                    counts += c
                    moves += m
                    starts += s
                    likelihood, n = likelihood + one, n + len(hashes)
        some = np.flatnonzero(counts.sum(axis=1))
        last = np.zeros(k)
        last[0] = likelihood
        last[-1] += n
        rows = np.concatenate([counts[some], moves, starts[None], last[None]])
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[some, -1 - np.arange(k + 2)], pa.int32()), *(pa.array(rows[:, j]) for j in range(k))], ["class", *(f"s{j}" for j in range(k))])

    return frugal(run)


def train(table: DataFrame, states: int = STATES, rounds: int = ROUNDS, sample_docs: int = SAMPLE_DOCS) -> tuple[Tied, list[float]]:
    """Baum-Welch over all training texts of table (doc_id, text) with emissions shared by classes of words; and the training
    texts' mean log-likelihood of a token under the model before each round.

    A round broadcasts the model (CLASSES x states numbers and the chain, a fixed size), and each task returns expected
    counts, which Spark adds up by class; the driver gets one row for each class. Tasks read several input partitions each,
    so that what they return is small beside what they read.
    """
    spark = table.sparkSession
    learn = ~F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    able = table.filter(learn & F.col("doc_id").isNotNull() & (F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_BYTES))
    chosen = able.select("doc_id").distinct().orderBy(F.md5(F.col("doc_id").cast("string"))).limit(sample_docs)
    sample = able.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).orderBy("doc_id")
    model, history = seed_states(sample.toArrow(), states), []
    grouped = table.coalesce(max(4 * spark.sparkContext.defaultParallelism, buckets(spark) // 8))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((tied_emissions(model), model.chain))
        sums = grouped.mapInArrow(_round(shared), "class int, " + ", ".join(f"s{j} double" for j in range(states)))
        got = sums.groupBy("class").agg(*(F.sum(f"s{j}").alias(f"s{j}") for j in range(states))).toArrow()
        at = got.column("class").to_numpy()
        rows = np.stack([got.column(f"s{j}").to_numpy() for j in range(states)], axis=1)
        extra = np.zeros((states + 2, states))
        extra[-1 - at[at < 0]] = rows[at < 0]
        likelihood, n = extra[-1][0], extra[-1][-1]
        shared.unpersist()
        if not n:
            break
        counts = np.zeros((CLASSES, states))
        counts[at[at >= 0]] = rows[at >= 0]
        model = Tied(counts, Chain(_normal(extra[states], 0.5), _normal(extra[:states], 0.5)))
        history.append(likelihood / n)
        if len(history) > 1 and history[-1] - history[-2] < SETTLED * abs(history[-2]):
            break
    return model, history


def _zip(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unzip(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def _encode(batches):
    """Chunks: documents, token codes, and the distinct words that the codes number, in ascending order."""
    task, number = TaskContext.get().partitionId(), 0
    for part in chunks(batches, "text", CHUNK):
        pieces = [tokens(s) for s in slices(part, "text")]
        shift = np.cumsum([0, *(len(h) for h, _ in pieces)])
        offsets = np.concatenate([[0], *(o[1:] + s for (_, o), s in zip(pieces, shift, strict=False))]).astype(np.int64)
        hashes = np.concatenate([h for h, _ in pieces])
        del pieces
        words, codes = np.unique(hashes, return_inverse=True)
        del hashes
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([(task << 32) + number]),
                pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([offsets.tolist()], pa.list_(pa.int64())),
                pa.array([_zip(codes.astype(np.uint32).tobytes())], pa.binary()),
                pa.array([words.tobytes()], pa.binary()),
            ],
            ["chunk", "docs", "offsets", "codes", "words"],
        )
        number += 1


def _planes(share: np.ndarray) -> bytes:
    """16-bit floats (three digits of every share down to 6e-8), upper bytes first, since those compress."""
    raw = share.astype(np.float16).view(np.uint8).reshape(-1, 2)
    return raw[:, 1].tobytes() + raw[:, 0].tobytes()


def _shares(raw: bytes, n: int, n_states: int) -> np.ndarray:
    both = np.frombuffer(raw, np.uint8, 2 * n * n_states).reshape(2, -1)
    return np.stack([both[1], both[0]], axis=1).reshape(-1).view(np.float16).reshape(n, n_states)


def _asks(model, n_buckets: int):
    """What each chunk asks the buckets of its words: their totals. It sends its own counts of them in training texts, and
    how these share among the states; the moves and starts go with the first."""

    def run(batches):
        emit_of, chain = model.value
        k = emit_of.shape[1]
        for batch in batches:
            for row in batch.to_pylist():
                words = np.frombuffer(row["words"], np.uint64)
                codes, offsets = np.frombuffer(_unzip(row["codes"]), np.uint32), np.array(row["offsets"])
                emit = emit_of[word_class(words)]
                learn = np.flatnonzero([not is_held_out(d) for d in row["docs"]])
                counts, per_word, moves, starts = np.zeros(len(words), np.int64), np.zeros((len(words), k)), np.zeros((k, k)), np.zeros(k)
                sizes = np.diff(offsets)[learn]
                for own in np.split(learn, np.flatnonzero(np.diff(np.cumsum(sizes) // PIECE)) + 1):
                    if len(own):
                        part = np.concatenate([codes[offsets[d] : offsets[d + 1]] for d in own.tolist()]).astype(np.int64)
                        kinds, part = np.unique(part, return_inverse=True)
                        c, m, s = expect(part, np.r_[0, np.cumsum(np.diff(offsets)[own])], emit[kinds], chain)
                        counts[kinds] += np.bincount(part, minlength=len(kinds))
                        per_word[kinds] += c
                        moves += m
                        starts += s
                share = per_word / np.maximum(counts, 1)[:, None]
                at, out = 0, []
                for bucket, values in ask(words, n_buckets):
                    n = len(values)
                    out.append((bucket, n, values.tobytes() + _zip(counts[at : at + n].tobytes() + _planes(share[at : at + n])), None if at else np.r_[moves.ravel(), starts].tolist()))
                    at += n
                buckets_, sizes_, blobs, extra = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([row["chunk"]] * len(out), pa.int64()), pa.array(buckets_, pa.int32()), pa.array(sizes_, pa.int32()), pa.array(blobs, pa.binary()), pa.array(extra, pa.list_(pa.float64()))], ["chunk", "bucket", "n", "blob", "moves"])

    return frugal(run)


def _answers(n_states: int):
    """Adds up the counts of each word of a bucket; answers every chunk, and row chunk = -1 has the bucket's totals."""

    def run(table: pa.Table) -> pa.Table:
        sizes, blobs = table.column("n").to_pylist(), table.column("blob").to_pylist()
        _, which = np.unique(np.concatenate([np.frombuffer(b, np.uint64, n) for b, n in zip(blobs, sizes, strict=True)]), return_inverse=True)
        n_words = int(which.max()) + 1
        total, per, at = np.zeros(n_words, np.int64), np.zeros((n_words, n_states)), 0
        for b, n in zip(blobs, sizes, strict=True):  # a chunk's words are distinct
            raw, own = _unzip(b[8 * n :]), which[at : at + n]
            count = np.frombuffer(raw, np.int64, n)
            total[own] += count
            per[own] += _shares(raw[8 * n :], n, n_states) * count[:, None].astype(float)
            at += n
        share = (per / np.maximum(per.sum(axis=1), 1e-30)[:, None]).astype(np.float16)
        held = share.astype(float)
        exact = held * (total / np.maximum(held.sum(axis=1), 1e-30))[:, None]  # what the shares say, as chunks will read them
        moves = [m for m in table.column("moves").to_pylist() if m is not None]
        sums = np.r_[total.sum(), (total > 0).sum(), exact.sum(axis=0), np.sum(moves, axis=0) if moves else np.zeros(n_states * (n_states + 1))]
        replies = [_zip(total[w].tobytes() + _planes(share[w])) for w in np.split(which, np.cumsum(sizes)[:-1])]
        bucket = table.column("bucket").to_pylist()
        return pa.table({"chunk": pa.array([*table.column("chunk").to_pylist(), -1], pa.int64()), "bucket": pa.array([*bucket, bucket[0]], pa.int32()), "n": pa.array([*sizes, 0], pa.int32()), "blob": pa.array([*replies, None], pa.binary()), "sums": pa.array([*[None] * len(sizes), sums.tolist()], pa.list_(pa.float64()))})

    return run


def _score(chain: Chain, total: float, kinds: float, per_state: np.ndarray):
    n_states = len(chain.start)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                parts = sorted(row["answers"], key=lambda a: a["bucket"])
                raw = [_unzip(a["blob"]) for a in parts]
                count = np.concatenate([np.frombuffer(b, np.int64, a["n"]) for a, b in zip(parts, raw, strict=True)]).astype(float)
                share = np.concatenate([_shares(b[8 * a["n"] :], a["n"], n_states) for a, b in zip(parts, raw, strict=True)]).astype(float)
                del parts, raw
                share /= np.maximum(share.sum(axis=1), 1e-30)[:, None]
                emit, base = emissions(share, count, per_state, total, kinds), np.log10((count + 0.5) / (total + 0.5 * (kinds + 1)))
                codes = np.frombuffer(_unzip(row["codes"]), np.uint32).astype(np.int64)
                offsets, docs = np.array(row["offsets"]), row["docs"]
                adds = lambda v: np.add.reduceat(v[codes], offsets[:-1])  # noqa: E731  every text has a token
                full = log10_likelihood(codes, offsets, emit, chain)
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array([is_held_out(d) for d in docs]), pa.array(np.diff(offsets)), pa.array(adds((count > 0).astype(np.int64))), pa.array(np.full(len(docs), int(total))), pa.array(adds(base)), pa.array(full)], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return frugal(run)


def score(docs: DataFrame, states: int = STATES, sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs (doc_id, text, others).

    Baum-Welch, each round over all training texts with the counts aggregated across partitions: see train() for the first
    rounds, in which words share emissions by classes. In the last round every word gets emissions of its own: each chunk of
    texts computes expected counts of (word, state), transitions and starts; words meet in hash-range buckets, which add the
    counts up (64-bit) and answer each chunk for its own words. Chunks meet the answers in a join and score whole texts by
    the scaled forward recursion under the new model. No task, nor the driver, holds the vocabulary.
    Words are told apart by 64-bit hashes: of n distinct words about n**2 / 2**65 pairs count as one word.
    Null text counts as empty: one end token. A very long text is a chunk of its own and scored whole. A null doc_id is
    learnt from. Repeated rows count each time. Without training texts all words are unknown and both scores are 0. An empty
    table gives no rows.
    """
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model, _ = train(table, states, rounds, sample_docs)
    n_buckets = text_buckets(table)
    held = materialize(table.mapInArrow(frugal(_encode), "chunk long, docs array<long>, offsets array<long>, codes binary, words binary"), "chunks")
    shared = docs.sparkSession.sparkContext.broadcast((tied_emissions(model), model.chain))
    asks = held.mapInArrow(_asks(shared, n_buckets), "chunk long, bucket int, n int, blob binary, moves array<double>")
    answers = materialize(asks.groupBy("bucket").applyInArrow(_answers(states), "chunk long, bucket int, n int, blob binary, sums array<double>"), "answers")
    sums = _added(answers.filter("chunk = -1"), "sums", 2 + states + states * (states + 1))
    moves = sums[2 + states :]
    chain = Chain(_normal(moves[states * states :], 0.5), _normal(moves[: states * states].reshape(states, states), 0.5))
    mine = answers.filter("chunk >= 0").groupBy("chunk").agg(F.collect_list(F.struct("bucket", "n", "blob")).alias("answers"))
    return held.select("chunk", "docs", "offsets", "codes").join(mine, "chunk").mapInArrow(_score(chain, sums[0], sums[1], sums[2 : 2 + states]), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _added(table: DataFrame, column: str, size: int) -> np.ndarray:
    """Element-wise sum of an array column."""
    out = np.zeros(size)
    for row in table.select(F.posexplode(column)).groupBy("pos").agg(F.sum("col").alias("v")).collect():
        out[row.pos] = row.v
    return out


def digest(docs: DataFrame) -> DataFrame:
    return score(docs)
