"""Quality classifier: a factorisation machine over hashed words, structure statistics and text-length metadata."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prumo.llm.common import U64, fresh, frugal, hash_words, slices, text_buffer

#: Hash buckets for words.
WORD_BUCKETS = 1 << 15
#: Rank of the interactions.
RANK = 4
#: Labelled rows the model is fitted on at most, taken in the order of md5(doc_id).
SAMPLE_ROWS = 6000
#: Upper bounds of the bins of each statistic; a statistic is given as its value and as its bin.
BINS = {
    "symbols": (0.01, 0.03, 0.06, 0.1, 0.15, 0.25),
    "capitals": (0.02, 0.05, 0.1, 0.2, 0.4, 0.7),
    "bars": (0.001, 0.005, 0.01, 0.02, 0.04, 0.1),
    "digits": (0.001, 0.01, 0.03, 0.1, 0.2, 0.4),
    "repeats": (0.005, 0.02, 0.05, 0.1, 0.25, 0.5),
    "distinct": (0.1, 0.2, 0.35, 0.5, 0.7, 0.9),
    "breaks": (0.002, 0.005, 0.01, 0.02, 0.05, 0.1),
    "word_length": (0.15, 0.25, 0.3, 0.35, 0.45, 0.7),
    "characters": (0.25, 0.35, 0.45, 0.5, 0.6, 0.75),
}
_STATS = list(BINS)
_BIN_OF = {name: WORD_BUCKETS + len(_STATS) + 8 * k for k, name in enumerate(_STATS)}
SIZE = WORD_BUCKETS + 9 * len(_STATS)


class Model(NamedTuple):
    bias: float
    linear: np.ndarray  # (SIZE,)
    factors: np.ndarray  # (SIZE, RANK)


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, np.int32)
    out[list(chars.encode())] = 1
    return out


_CAPITAL = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _CAPITAL + _table("abcdefghijklmnopqrstuvwxyz")
_LETTER[0xC3:0xE0] = 1  # lead bytes of two-byte letters
_SYMBOL = _table("!\"#$%&'()*+-/:;<=>?@[\\]^_`{|}~")
_DIGIT, _BAR, _BREAK = _table("0123456789"), _table("|"), _table("\n")


def features(text: pa.Array, chars: pa.Array | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) triples in row order. Null text counts as empty; a null length as the text's own."""
    words = hash_words(text, lower=True)
    n_docs = len(text)
    rows = np.repeat(np.arange(n_docs), np.diff(words.offsets))
    bucket = (words.hashes % U64(WORD_BUCKETS)).astype(np.int64)
    keys, count = np.unique(rows * WORD_BUCKETS + bucket, return_counts=True)
    row, feature = keys // WORD_BUCKETS, keys % WORD_BUCKETS
    norm = np.sqrt(np.bincount(row, weights=count.astype(float) ** 2, minlength=n_docs))
    value = count / norm[row]

    buf, bounds = text_buffer(text)

    def share(table: np.ndarray, of: np.ndarray) -> np.ndarray:
        return total(table[buf]) / np.maximum(of, 1)

    def total(flags: np.ndarray) -> np.ndarray:
        sums = np.r_[0, np.cumsum(flags, dtype=np.int64)]
        return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(float)

    n_bytes, n_words = np.diff(bounds).astype(float), np.diff(words.offsets).astype(float)
    letters = total(_LETTER[buf])
    high = np.zeros(len(buf), bool)  # capital letters of Latin-1 and two-byte letters
    high[1:] = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E)
    again = np.zeros(len(rows), bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (rows[1:] == rows[:-1])
    own = pc.utf8_length(text).cast(pa.int64())
    length = pc.fill_null(own if chars is None else pc.coalesce(chars.cast(pa.int64()), own), 0).to_numpy(zero_copy_only=False)
    stats = {
        "symbols": share(_SYMBOL, n_bytes),
        "capitals": (total(_CAPITAL[buf]) + total(high)) / np.maximum(letters, 1),
        "bars": share(_BAR, n_bytes),
        "digits": share(_DIGIT, n_bytes),
        "repeats": np.bincount(rows, weights=again, minlength=n_docs) / np.maximum(n_words, 1),
        "distinct": np.bincount(row, minlength=n_docs) / np.maximum(n_words, 1),
        "breaks": share(_BREAK, n_bytes),
        "word_length": np.minimum(n_bytes / np.maximum(n_words, 1) / 20, 2),
        "characters": np.log1p(np.maximum(length, 0)) / 16,
    }
    docs = np.arange(n_docs)
    all_rows, all_features, all_values = [row], [feature], [value]
    for k, (name, v) in enumerate(stats.items()):
        all_rows += [docs, docs]
        all_features += [np.full(n_docs, WORD_BUCKETS + k), _BIN_OF[name] + np.searchsorted(BINS[name], v, "right")]
        all_values += [v, np.ones(n_docs)]
    r = np.concatenate(all_rows)
    order = np.argsort(r, kind="stable")
    return r[order], np.concatenate(all_features)[order], np.concatenate(all_values)[order]


def _scores(model: Model, row: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Raw scores and per-row factor sums: half of (sum of v x)**2 - sum of (v x)**2 is the sum over pairs, in linear time."""
    each = model.factors[feature] * value[:, None]
    sums = np.stack([np.bincount(row, weights=each[:, f], minlength=n) for f in range(RANK)], axis=1)
    squares = np.bincount(row, weights=(each * each).sum(axis=1), minlength=n)
    return model.bias + np.bincount(row, weights=model.linear[feature] * value, minlength=n) + 0.5 * ((sums * sums).sum(axis=1) - squares), sums


def fit(row: np.ndarray, feature: np.ndarray, value: np.ndarray, label: np.ndarray, steps: int = 300, batch: int = 200, rate: float = 0.08, decay: float = 1e-5, seed: int = 3) -> Model:
    """Logistic loss by AdaGrad over mini-batches: ten passes, or more until there were about `steps`. Rows are in order of `row`."""
    rng = np.random.default_rng(seed)
    n = len(label)
    prior = (label.sum() + 1) / (n + 2)
    model = Model(float(np.log(prior / (1 - prior))), np.zeros(SIZE), rng.normal(0, 0.02, (SIZE, RANK)))
    bias, seen_w, seen_v, seen_b = model.bias, np.full(SIZE, 1e-2), np.full((SIZE, RANK), 1e-2), 1e-2
    cuts = np.searchsorted(row, np.arange(n + 1))
    for _ in range(min(400, max(10, -(-steps * batch // n))) if 0 < label.sum() < n else 0):
        order = rng.permutation(n)
        for a in range(0, n, batch):
            own = order[a : a + batch]
            at = np.concatenate([np.arange(cuts[i], cuts[i + 1]) for i in own])
            r = np.repeat(np.arange(len(own)), cuts[own + 1] - cuts[own])
            f, x = feature[at], value[at]
            raw, sums = _scores(Model(bias, model.linear, model.factors), r, f, x, len(own))
            loss = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - label[own]) / len(own)
            used, which = np.unique(f, return_inverse=True)
            push = loss[r] * x
            grad_w = np.bincount(which, weights=push) + decay * model.linear[used]
            per = push[:, None] * (sums[r] - model.factors[f] * x[:, None])
            grad_v = np.stack([np.bincount(which, weights=per[:, k]) for k in range(RANK)], axis=1) + decay * model.factors[used]
            seen_w[used] += grad_w**2
            seen_v[used] += grad_v**2
            seen_b += loss.sum() ** 2
            model.linear[used] -= rate * grad_w / np.sqrt(seen_w[used])
            model.factors[used] -= rate * grad_v / np.sqrt(seen_v[used])
            bias -= rate * loss.sum() / np.sqrt(seen_b)
    return Model(float(bias), model.linear, model.factors)


def held_out(doc_id) -> F.Column:
    """Rows that are never learnt from: crc32(doc_id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _columns(docs: DataFrame) -> DataFrame:
    chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", chars.alias("n_chars"))


def _featurise(batches):
    for whole in batches:
        for batch in slices(whole, "text"):
            row, feature, value = features(batch.column("text"), batch.column("n_chars"))
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
            pick = lambda v, kind: pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(v, kind))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pick(feature, pa.int32()), pick(value, pa.float64())], ["label", "feature", "value"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits the model on sample_rows labelled documents at most, none of them held out. Inputs of a score are the text and
    its length only. Rows with a null doc_id or label are left out; of labels that repeat a doc_id the smallest counts, of
    texts the one with the least hash, so that reruns agree."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).dropna().filter(~held_out(F.col("doc_id")))
    sample = known.groupBy("doc_id").agg(F.min("label").alias("label")).orderBy(F.md5(F.col("doc_id").cast("string"))).limit(sample_rows)
    found = _columns(docs).join(F.broadcast(sample), "doc_id")
    rows = found.groupBy("doc_id", "label").agg(F.min_by(F.struct("text", "n_chars"), F.struct(F.xxhash64("text"), "n_chars")).alias("_t")).select("doc_id", "label", "_t.text", "_t.n_chars").orderBy("doc_id")
    got = rows.mapInArrow(frugal(_featurise), "label int, feature array<int>, value array<double>").toArrow().combine_chunks()
    if not got.num_rows:
        return Model(0.0, np.zeros(SIZE), np.zeros((SIZE, RANK)))
    lists = got.column("feature").combine_chunks()
    row = np.repeat(np.arange(got.num_rows), pc.list_value_length(lists).to_numpy())
    return fit(row, lists.flatten().to_numpy(), got.column("value").combine_chunks().flatten().to_numpy(), got.column("label").to_numpy().astype(float))


def score(docs: DataFrame, model: Model, name: str = "_score") -> DataFrame:
    """docs with one more column: the probability that the label is 1. Every whole text is scored; null counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.linear, model.factors))
    chars = "n_chars" in docs.columns

    def run(batches):
        own = Model(*shared.value)
        for whole in batches:
            for batch in slices(whole, "text"):
                raw, _ = _scores(own, *features(batch.column("text"), batch.column("n_chars") if chars else None), batch.num_rows)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(raw, -500, 500))))], [*batch.schema.names, name])

    return docs.mapInArrow(frugal(run), T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs (doc_id, text, n_chars if there, and any others).

    Null and empty texts are scored by the intercept and their statistics. A null doc_id is scored and never held out.
    Repeated rows are each scored alike. Without usable labels every score is 0.5. An empty table gives no rows.
    """
    out = score(_columns(docs), train(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of docs that score `least` or more, with all their columns. Null and empty texts are scored by the intercept and
    their statistics, a null doc_id and repeated rows like any others. Without usable labels every row scores 0.5 and stays. An
    empty table gives no rows."""
    own = fresh(docs, "_score")
    return score(docs, train(docs, labels), own).filter(F.col(own) >= least).drop(own)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return classify(docs, labels)
