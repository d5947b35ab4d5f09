"""Benchmark decontamination by template windows with typed slots."""

from __future__ import annotations

import string
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prumo.llm.common import _P, U64, fresh, frugal, hash_words, materialize, mix64, slices, trim, windows

#: Template tokens of a window; a shorter item is one window, if it has SHORTEST tokens.
WINDOW = 13
SHORTEST = 5
#: Template windows with a smaller part of plain words say too little about re-parameterised copies; such passages are
#: sought word for word instead, and so are whole items of SHORTEST words or, if they have a slot, SHORTEST_RAW words.
LEAST_PLAIN = 0.6
SHORTEST_RAW = 3
#: Benchmark windows that are compared in one pass over the documents; more take several passes.
PASS_WINDOWS = 1 << 20

#: Words that are units after a number.
UNITS = (
    "mm cm m km in inch inches ft feet yd yards mi mile miles mg g kg gram grams kilograms t ton tons oz lb lbs pounds "
    "ml l liter liters litre litres s sec seconds min minutes h hour hours day days week weeks month months year years "
    "percent usd eur brl gbp dollars euros cents reais w kw v hz khz mhz ghz kb mb gb tb c f k pa kpa bar"
).split()

_DIGIT = np.array([48 <= c < 58 for c in range(256)])
_CAPITAL = np.array([65 <= c < 91 for c in range(256)])
_STOP = np.array([chr(c) in ".!?:" for c in range(256)])
NUM, UNIT, NAME = (U64(x) for x in (0x6E756D6265720001, 0x756E697400000001, 0x6E616D6500000001))


class Template(NamedTuple):
    """Tokens of several texts: text d has offsets[d]:offsets[d + 1]. Token t is buf[starts[t]:ends[t]]; slot: not a plain word.
    Text d has the words word_offsets[d]:word_offsets[d + 1]; word w has the hash words[w] and lies in token home[w]. capital:
    the token is a capitalised word, whether a name slot or plain."""

    codes: np.ndarray
    slot: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    buf: np.ndarray
    words: np.ndarray
    word_offsets: np.ndarray
    home: np.ndarray
    capital: np.ndarray


_UNIT_HASHES: list[np.ndarray] = []


def template(col: pa.Array) -> Template:
    """Words without punctuation at their ends, A-Z as a-z. A word with a digit becomes a number slot, a unit word after a
    number a unit slot, a capitalised word that doesn't open a text or sentence and isn't all capitals a name slot; equal
    slots side by side are one. Words of punctuation only vanish."""
    if not _UNIT_HASHES:
        _UNIT_HASHES.append(np.zeros(0, U64))
        _UNIT_HASHES[0] = np.sort(template(pa.array(["x " + " x ".join(UNITS)])).codes[1::2])
    words = hash_words(col, lower=True)
    buf, starts, ends = words.buf, words.starts, words.ends
    n = len(buf)
    doc = np.repeat(np.arange(len(words.offsets) - 1), np.diff(words.offsets))
    if not len(starts):
        none = np.zeros(0, bool)
        return Template(words.hashes, none, words.offsets, starts, ends, buf, words.hashes, words.offsets, starts, none)
    opens = np.ones(len(starts), bool)  # the word opens a text or a sentence; line breaks move when a text is wrapped anew
    opens[1:] = (doc[1:] != doc[:-1]) | _STOP[buf[words.ends[:-1] - 1]]
    full, starts, ends, codes = trim(words)
    doc, opens = doc[full], opens[full]
    digits = np.r_[0, np.cumsum(_DIGIT[buf])]
    number = digits[ends] > digits[starts]

    def capital(at: np.ndarray) -> np.ndarray:
        return _CAPITAL[buf[at]] | (buf[at] == 0xC3) & (buf[np.minimum(at + 1, n - 1)] >= 0x80) & (buf[np.minimum(at + 1, n - 1)] <= 0x9E)

    second = np.minimum(starts + np.where(buf[starts] >= 0xC0, 2, 1), n - 1)
    upper = ~number & capital(starts) & (second < ends) & ~capital(second)
    name = ~opens & upper
    unit = np.zeros(len(codes), bool)
    unit[1:] = number[:-1] & (doc[1:] == doc[:-1]) & np.isin(codes[1:], _UNIT_HASHES[0])
    plain = codes
    codes = np.where(number, NUM, np.where(unit, UNIT, np.where(name, NAME, codes)))
    slot = number | unit | name
    again = np.zeros(len(codes), bool)
    again[1:] = slot[1:] & (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
    stay = np.flatnonzero(~again)
    last = np.r_[stay[1:], len(codes)] - 1 if len(stay) else stay
    places = np.arange(len(words.offsets))
    return Template(codes[stay], slot[stay], np.searchsorted(doc[stay], places), starts[stay], ends[last], buf, plain, np.searchsorted(doc, places), np.cumsum(~again) - 1, upper[stay])


def _window_rows(t: Template, length: int):
    """(position, hash) of windows with plain words enough; positions count in all tokens."""
    hashes = windows(t.codes, length) ^ U64(length)
    end = np.repeat(t.offsets[1:], np.diff(t.offsets))[: len(hashes)]
    slots = np.r_[0, np.cumsum(t.slot)]
    at = np.arange(len(hashes))
    fine = (at + length <= end) & (slots[at + length] - slots[at] <= (1 - LEAST_PLAIN) * length)
    return at[fine], hashes[fine]


#: Ways to read the first token of a window, apart from that of its text: another word before it would make it plain or a
#: name, or leave the first word of a longer name on its own, plain or a name.
AS_PLAIN, AS_NAME, SPLIT_PLAIN, SPLIT_NAME = range(1, 5)


def _other_rows(t: Template, length: int):
    """(position, way, hash) of windows whose first token is read another way; the same hash as if the text read so."""
    n_words = np.bincount(t.home, minlength=len(t.codes))
    first = np.searchsorted(t.home, np.arange(len(t.codes)))
    end = np.repeat(t.offsets[1:], np.diff(t.offsets))
    slots = np.r_[0, np.cumsum(t.slot)]
    power = np.multiply.accumulate(np.r_[U64(1), np.full(length - 1, U64(_P))])
    name, out = t.codes == NAME, []
    for way, own in ((AS_PLAIN, (name | (t.codes == UNIT)) & (n_words == 1)), (AS_NAME, t.capital & ~t.slot), (SPLIT_PLAIN, name & (n_words > 1)), (SPLIT_NAME, name & (n_words > 1))):
        split = way >= SPLIT_PLAIN
        at = np.flatnonzero(own)
        at = at[at + length - split <= end[at]]
        if not len(at) or length < 2:
            continue
        rest = at + 1 - split  # the tokens that stay as they are
        count = slots[rest + length - 1] - slots[rest] + (way in (AS_NAME, SPLIT_NAME))
        fine = count <= (1 - LEAST_PLAIN) * length
        at, rest = at[fine], rest[fine]
        hashes = np.full(len(at), NAME) if way in (AS_NAME, SPLIT_NAME) else t.words[first[at]]
        for k in range(1, length):
            hashes = hashes + power[k] * t.codes[rest + k - 1]
        out.append((at, np.full(len(at), way), mix64(hashes + U64(length)) ^ U64(length)))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64)]


def _raw_rows(t: Template, length: int):
    """(position, hash) of all windows of words as they are, A-Z as a-z; positions count in all words."""
    hashes = windows(t.words, length) ^ U64(length)
    end = np.repeat(t.word_offsets[1:], np.diff(t.word_offsets))[: len(hashes)]
    fine = np.flatnonzero(np.arange(len(hashes)) + length <= end)
    return fine, hashes[fine]


def _value(t: Template, raw: bytes, i: int) -> str:
    return b" ".join(raw[t.starts[i] : t.ends[i]].split()).decode()


def _slots(t: Template, raw: bytes, at: int, length: int, way: int = 0) -> list[tuple[str, int]]:
    """The slots of a window, each with its token, or -1 where the first token is read another way."""
    if not way:
        return [(_value(t, raw, i), i) for i in range(at, at + length) if t.slot[i]]
    if way < SPLIT_PLAIN:
        own = [_value(t, raw, at)] if way == AS_NAME else []
        at, length = at + 1, length - 1
    else:
        one, more = _value(t, raw, at).split(" ", 1)
        own = [*([one.strip(string.punctuation)] if way == SPLIT_NAME else []), more.lstrip(string.punctuation + " ")]
        at, length = at + 1, length - 2
    return [*((v, -1) for v in own), *_slots(t, raw, at, length)]


#: length: of a template window, or less than 0 for one of words as they are. other: the first token is read another way.
#: edge: for each slot, whether its value may go on before (-1) or after (1) the item in a document.
_HIT = "id long, pos long, length int, other boolean, hash long, slots array<string>, edge array<int>"


def _batch(ids, pos, length, other, hashes, slots) -> pa.RecordBatch:
    values, edge = [[v for v, _ in s] for s in slots], [[e for _, e in s] for s in slots]
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(pos, pa.int64()), pa.array(length, pa.int32()), pa.array(other, pa.bool_()), pa.array(hashes, pa.int64()), pa.array(values, pa.list_(pa.string())), pa.array(edge, pa.list_(pa.int32()))], ["id", "pos", "length", "other", "hash", "slots", "edge"])


def _windows(t: Template, length: int):
    """(position, way, hash) of a length's windows of all kinds."""
    if length < 0:
        at, hashes = _raw_rows(t, -length)
        return at, np.zeros(len(at), np.int64), hashes
    at, hashes = _window_rows(t, length)
    other, way, others = _other_rows(t, length)
    return np.r_[at, other], np.r_[np.zeros(len(at), np.int64), way], np.r_[hashes, others]


def _item_windows(window: int):
    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                t = template(batch.column("text"))
                raw, ids, out = t.buf.tobytes(), batch.column("id").to_pylist(), []
                n_tokens, n_words = np.diff(t.offsets), np.diff(t.word_offsets)
                valued = np.diff(np.r_[0, np.cumsum(t.slot)][t.offsets]) > 0
                served = np.zeros(len(t.codes), bool)  # a template window begins here
                for n in {min(window, int(n)) for n in n_tokens if n >= SHORTEST}:
                    at, way, hashes = _windows(t, n)
                    doc = np.searchsorted(t.offsets, at, "right") - 1
                    mine = np.minimum(n_tokens[doc], window) == n
                    served[at[mine & (way == 0)]] = True
                    for i, w, h, d in zip(at[mine].tolist(), way[mine].tolist(), hashes[mine].astype(np.int64).tolist(), doc[mine].tolist(), strict=True):
                        a, b = int(t.offsets[d]), int(t.offsets[d + 1])
                        left = {a, a + 1} if t.capital[a] and t.codes[a + 1] == NAME else {a}
                        slots = [(v, -1 if k in left else int(k == b - 1)) for v, k in _slots(t, raw, i, n, w)]
                        out.append((ids[d], i - a - (w >= SPLIT_PLAIN), n, w > 0, h, slots))
                for n in {min(window, int(n)) for n in n_words if n >= SHORTEST_RAW}:
                    at, _, hashes = _windows(t, -n)
                    doc = np.searchsorted(t.word_offsets, at, "right") - 1
                    mine = (np.minimum(n_words[doc], window) == n) & ((n_words[doc] >= SHORTEST) | valued[doc]) & ((n_words[doc] <= window) | ~served[t.home[at]])
                    out += [(ids[d], i - int(t.word_offsets[d]), -n, False, h, []) for i, h, d in zip(at[mine].tolist(), hashes[mine].astype(np.int64).tolist(), doc[mine].tolist(), strict=True)]
                yield _batch(*(zip(*out, strict=True) if out else [[]] * 6))

    return run


def _find(wanted):
    def run(batches):
        sought = wanted.value
        for whole in batches:
            for batch in slices(whole, "text"):
                t = template(batch.column("text"))
                raw, ids, out = t.buf.tobytes(), batch.column("id").to_pylist(), []
                for n, known in sought.items():
                    pos, way, hashes = _windows(t, n)
                    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                    hit = known[at] == hashes
                    offsets = t.word_offsets if n < 0 else t.offsets
                    doc = np.searchsorted(offsets, pos[hit], "right") - 1
                    for d, p, w, h in zip(doc.tolist(), pos[hit].tolist(), way[hit].tolist(), hashes[hit].astype(np.int64).tolist(), strict=True):
                        slots = [] if n < 0 else [(v, 0) for v, _ in _slots(t, raw, p, n, w)]
                        out.append((ids[d], p - int(offsets[d]) - (w >= SPLIT_PLAIN), n, w > 0, h, slots))
                yield _batch(*(zip(*out, strict=True) if out else [[]] * 6))

    return run


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, pass_windows: int = PASS_WINDOWS) -> DataFrame:
    """doc_id, item_id, windows, n_windows, consistent, verbatim: aligned runs of equal windows of a document and an item.

    Template windows find copies with other values. Where an item's passage has too many slots for one, and for every item
    of a window or less, windows of words as they are find verbatim copies whatever stands around them. The first token of
    a template window is read both as its text has it and as it would be after other words.
    Windows of the benchmark are held against all documents in passes of at most about pass_windows hashes, so what is
    broadcast is bounded however long the benchmark is; hits then meet benchmark windows in a join on the hash. A run is
    all windows of one kind of a document and an item with the same distance between their places; one run has the windows
    as their texts have them, another also those with a first token read otherwise. Its slots are consistent when item
    values and document values map one to one; verbatim when they are equal, too. Where a slot at an item's edge has
    more or fewer words in the document, since like slots may stand beside it there, the value is the item's if the document's
    begins or ends with it, and is left out of this otherwise. A very long text is one document like others; windows of it are
    found slice by slice of rows, never across rows.
    """
    spark = docs.sparkSession
    known = items.select(F.col("item_id").cast("long").alias("id"), "text").filter("id is not null").mapInArrow(frugal(_item_windows(window)), _HIT)
    known = materialize(known, "benchmark")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").filter("id is not null")
    passes = max(1, -(-known.count() // pass_windows))
    hits = None
    for k in range(passes):
        part = known.filter(F.pmod(F.xxhash64("hash"), F.lit(passes)) == k).select("length", "hash").distinct().toArrow()
        sought = {n: np.sort(part.filter(pc.equal(part["length"], n))["hash"].to_numpy().view(np.uint64)) for n in set(part["length"].to_pylist())}
        found = texts.mapInArrow(frugal(_find(spark.sparkContext.broadcast(sought))), _HIT)
        hits = found if hits is None else hits.union(found)
    left = hits.select(F.col("id").alias("doc_id"), F.col("pos").alias("at"), "length", "hash", F.col("slots").alias("own"), F.col("other").alias("too"))
    right = known.select(F.col("id").alias("item_id"), "pos", "length", "hash", "slots", "edge", "other")
    met = left.join(right, ["length", "hash"]).filter(F.size("own") == F.size("slots")).withColumn("shift", F.col("at") - F.col("pos"))
    kinds = F.when(F.col("length") < 0, F.array(F.lit(0))).when(F.col("other") | F.col("too"), F.array(F.lit(2))).otherwise(F.array(F.lit(1), F.lit(2)))
    met = met.withColumn("windows", F.explode(kinds))
    pair = F.explode_outer(F.arrays_zip("slots", "own", "edge"))
    run = ["doc_id", "item_id", "shift", "windows"]
    values = met.select(*run, "pos", pair.alias("p")).select(*run, "pos", F.col("p.slots").alias("a"), F.col("p.own").alias("b"), F.col("p.edge").alias("edge"))
    cut = F.coalesce((F.col("edge") != 0) & (F.size(F.split("a", " ")) != F.size(F.split("b", " "))), F.lit(False))
    same = F.when(~cut, F.col("a").eqNullSafe(F.col("b"))).when(F.col("edge") < 0, F.endswith("b", F.concat(F.lit(" "), "a"))).otherwise(F.startswith("b", F.concat("a", F.lit(" "))))
    values = values.select(*run, "pos", F.when(~cut | same, F.col("a")).alias("a"), F.when(~cut, F.col("b")).when(same, F.col("a")).alias("b"), same.alias("same"))
    pairs = values.groupBy(*run, "a", "b").agg(F.collect_set("pos").alias("places"), F.bool_and("same").alias("same"))
    runs = pairs.groupBy(*run).agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("n_windows"),
        F.count("a").alias("n"),
        F.count_distinct("a").alias("n_a"),
        F.count_distinct("b").alias("n_b"),
        F.bool_and("same").alias("verbatim"),
    )
    return runs.select("doc_id", "item_id", "windows", "n_windows", ((F.col("n") == F.col("n_a")) & (F.col("n") == F.col("n_b"))).alias("consistent"), "verbatim")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, pass_windows: int = PASS_WINDOWS) -> DataFrame:
    """doc_id, contaminated, kind, n_items, n_windows for every row of docs (doc_id, text and any others).

    A document is contaminated if it holds a template window of an item (item_id, text) with consistent slots, or word for
    word a whole item of at most `window` words or a window of words that has too many slots for a template. kind:
    'verbatim' if some run keeps all values, else 'reparameterised'; null for clean documents. n_items: items found;
    n_windows: windows in runs, by item those of the kind that has most. Null or empty texts and rows with a null doc_id are
    clean; items with a null id, plain ones of fewer than SHORTEST words and any of fewer than SHORTEST_RAW are left out; equal items each count. Rows that repeat a
    doc_id share what is found in any of them. An empty table gives no rows, an empty benchmark leaves all clean.
    """
    found = matches(docs, items, window, pass_windows).filter("consistent").groupBy("doc_id", "item_id", "windows").agg(F.sum("n_windows").alias("n"), F.bool_or("verbatim").alias("v"))
    found = found.groupBy("doc_id", "item_id").agg(F.max("n").alias("n"), F.bool_or("v").alias("v"))
    found = found.groupBy("doc_id").agg(F.count("item_id").alias("n_items"), F.sum("n").cast("long").alias("n_windows"), F.bool_or("v").alias("_v"))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(found, "doc_id", "left")
    kind = F.when(F.col("_v"), "verbatim").when(~F.col("_v"), "reparameterised")
    return out.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), kind.alias("kind"), F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("n_windows", F.lit(0)).alias("n_windows"))


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs that hold no window of an item, with all their columns. Null and empty texts and rows with a null doc_id
    stay; rows that repeat a doc_id go if any of them holds a window. An empty table gives no rows, an empty benchmark keeps all."""
    own = fresh(docs, "_found")
    found = matches(docs, items).filter("consistent").select(F.col("doc_id").alias(own)).distinct()
    return docs.join(found, F.col("doc_id") == F.col(own), "left_anti")


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    return decontaminate(docs, items)
