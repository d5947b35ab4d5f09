"""Periodic runs: stretches of words that repeat themselves, found by the linear tandem-repeat method of Gusfield and Stoye."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prumo.llm.common import WORD, frugal, hash_words, slices


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i the numbers first[i], first[i] + 1, ... (count[i] of them), all in one array; and which i each belongs to."""
    of = np.repeat(np.arange(len(count)), count)
    return first[of] + np.arange(len(of)) - (np.cumsum(count) - count)[of], of


class SuffixOrder:
    """The suffixes of several sequences (one symbol at least) in order, as a virtual suffix tree.

    A suffix's order is that of its symbols; those of different sequences share nothing, and the end of a sequence comes before
    any symbol. names[l][i] is the same for two places exactly if the 2**l symbols from them on are the same and lie
    inside the sequence (it is the first slot of their class), which compares any two substrings in one step. A node of the tree
    is an interval of slots whose suffixes share that many symbols, and its suffix link leads to the interval of the place
    after. Only places whose class has others are sorted on, so the work is that of the repeats.
    """

    def __init__(self, codes: np.ndarray, offsets: np.ndarray):
        self.n = n = len(codes)
        sequence = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        self.end = offsets[1:][sequence]
        numbers, found = pd.factorize(codes)
        key = sequence * (len(found) + 1) + numbers
        self.slots = np.argsort(key)
        self.names: list[np.ndarray] = []
        opens = self._name(np.arange(n), key[self.slots])
        begins = np.flatnonzero(opens)
        self.first_end = np.repeat(np.append(begins[1:], n), np.diff(np.append(begins, n)))  # end of a slot's one-symbol class
        open_slots, width = np.arange(n), 1
        while True:
            alone = opens & np.append(opens[1:], True)
            open_slots = open_slots[~alone]
            if not len(open_slots):
                break
            names, places = self.names[-1], self.slots[open_slots]
            after = places + width
            second = np.where(after < self.end[places], names[np.minimum(after, n)], -1)
            key = names[places].astype(np.int64) * (n + 1) + second + 1
            by = np.argsort(key)
            self.slots[open_slots] = places[by]
            opens = self._name(open_slots, key[by])
            width *= 2
        self.slot = np.empty(n, np.int64)
        self.slot[self.slots] = np.arange(n)

    def _name(self, slots: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The next level of names: as the last, but for these slots, whose classes the keys tell apart; where classes begin."""
        names = self.names[-1].copy() if self.names else np.full(self.n + 1, -1, np.int32)
        opens = np.ones(len(slots), bool)
        opens[1:] = keys[1:] != keys[:-1]
        names[self.slots[slots]] = slots[opens][np.cumsum(opens) - 1]
        self.names.append(names)
        return opens

    def same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the substrings of these lengths (1 at least, inside their sequences) from a and b on are equal."""
        key_a, key_b = self.identity(a, length), self.identity(b, length)
        return (key_a[0] == key_b[0]) & (key_a[1] == key_b[1])

    def identity(self, a: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two numbers that, with the length, say which substring it is."""
        level = np.frexp(length.astype(np.float64))[1] - 1
        first, last = np.empty(len(a), np.int64), np.empty(len(a), np.int64)
        tail = a + length - (1 << level)
        level = np.minimum(level, len(self.names) - 1)  # beyond the last level each place is its own class
        for x in np.unique(level).tolist():
            at = level == x
            first[at], last[at] = self.names[x][a[at]], self.names[x][tail[at]]
        return first, last

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest substring that is both at a and at b (other places than a)."""
        return self._extension(a, b, 1)

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest substring that ends both at a and at b, these included."""
        return self._extension(a, b, -1)

    def _extension(self, a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
        out = np.zeros(len(a), np.int64)
        left, top = np.arange(len(a)), np.full(len(a), -1)
        for level, names in enumerate(self.names):  # how many bits the length has; most have none
            left = left[self._equal(names, a[left], b[left], 1 << level, way)]
            top[left] = level
            if not len(left):
                break
        left = np.flatnonzero(top >= 0)
        out[left] = 1 << top[left]
        for level in range(int(top.max(initial=0)) - 1, -1, -1):
            ask = left[top[left] > level]
            step = way * out[ask]
            out[ask] += np.where(self._equal(self.names[level], a[ask] + step, b[ask] + step, 1 << level, way), 1 << level, 0)
        return out

    def _equal(self, names: np.ndarray, a: np.ndarray, b: np.ndarray, size: int, way: int) -> np.ndarray:
        if way < 0:
            a, b = a - (size - 1), b - (size - 1)
        inside = (a >= 0) & (b >= 0) & (a < self.n) & (b < self.n)
        return inside & (names[np.where(inside, a, -1)] == names[np.where(inside, b, -1)])

    def interval(self, a: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The node of each substring: the first slot of its suffixes and the one after the last."""
        mid = self.slot[a]
        low, high = self.names[0][a].astype(np.int64), self.first_end[mid]
        edges = []
        for x, y, falls in ((low, mid, True), (mid, high - 1, False)):  # binary search on both sides
            x, y = x.copy(), y.copy()
            while True:
                open_ = np.flatnonzero(x < y)
                if not len(open_):
                    break
                ask = (x[open_] + y[open_] + (not falls)) // 2
                place = self.slots[ask]
                fits = place + length[open_] <= self.end[place]
                fits[fits] = self.same(place[fits], a[open_][fits], length[open_][fits])
                if falls:
                    y[open_] = np.where(fits, ask, y[open_])
                    x[open_] = np.where(fits, x[open_], ask + 1)
                else:
                    x[open_] = np.where(fits, ask, x[open_])
                    y[open_] = np.where(fits, y[open_], ask - 1)
            edges.append(x)
        return edges[0], edges[1] + 1

    def child(self, low: np.ndarray, high: np.ndarray, depth: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Of the suffixes in slots low to high, which share `depth` symbols, a place of one that goes on with the symbol at
        place `symbol`; -1 if none does."""
        want = self.names[0][symbol]
        x, y = low.copy(), high.copy()
        while True:
            open_ = np.flatnonzero(x < y)
            if not len(open_):
                break
            ask = (x[open_] + y[open_]) // 2
            less = self._symbol(self.slots[ask], depth[open_]) < want[open_]
            x[open_] = np.where(less, ask + 1, x[open_])
            y[open_] = np.where(less, y[open_], ask)
        found = x < high
        place = self.slots[np.where(found, x, 0)]
        return np.where(found & (self._symbol(place, depth) == want), place, -1)

    def _symbol(self, place: np.ndarray, depth: np.ndarray) -> np.ndarray:
        at = place + depth
        return np.where(at < self.end[place], self.names[0][np.minimum(at, self.n)], -1)


def lz_blocks(order: SuffixOrder) -> np.ndarray:
    """Starts of the Lempel-Ziv blocks of all sequences: a block is the longest substring from its start on that begins
    earlier in the sequence as well (it may overlap itself), or one symbol if there is none."""
    n = order.n
    shared = np.flatnonzero(order.first_end - order.names[0][order.slots] > 1)
    longest = np.ones(n, np.int64)
    for way in (-1, 1):  # the nearest slots before and after that have an earlier place
        near = np.full(n, -1)
        first, last = order.names[0][order.slots[shared]], order.first_end[shared] - 1
        beside = shared + way
        near[shared] = np.where((beside >= first) & (beside <= last), beside, -1)
        ask = shared
        while len(ask):
            ask = ask[near[ask] >= 0]
            ask = ask[order.slots[near[ask]] > order.slots[ask]]
            near[ask] = near[near[ask]]
        has = shared[near[shared] >= 0]
        place = order.slots[has]
        longest[place] = np.maximum(longest[place], order.ahead(order.slots[near[has]], place))
    jump, starts, at = (np.arange(n) + longest).tolist(), [], 0
    while at < n:
        starts.append(at)
        at = jump[at]
    return np.array(starts, np.int64)


def _leftmost(order: SuffixOrder) -> tuple[np.ndarray, np.ndarray]:
    """Starts and half lengths of squares that cover the leftmost occurrences of all: those whose centre lies in a block and
    which reach over its end, and those whose first half begins before a block and ends in it."""
    h = lz_blocks(order)
    size = np.diff(h, append=order.n)
    stop = order.end[h]
    next_size = np.where(h + size < stop, np.r_[size[1:], 0], 0)
    out = []
    k, b = _spread(np.ones(len(h), np.int64), size)
    end = (h + size)[b]
    q = end - k
    hit = (end < stop[b]) & (order.names[0][np.minimum(end, order.n)] == order.names[0][q])
    k, q, end = k[hit], q[hit], end[hit]
    right, left = order.ahead(end, q), order.behind(end - 1, q - 1)
    good = right + left >= k
    out.append((np.maximum(q - left, q - k + 1)[good], k[good]))
    k, b = _spread(np.ones(len(h), np.int64), size + next_size)
    begin = h[b]
    q = begin + k
    hit = (q < stop[b]) & (begin > 0)
    k, b, begin, q = k[hit], b[hit], begin[hit], q[hit]
    hit = (order.names[0][begin] == order.names[0][q]) & (order.names[0][begin - 1] == order.names[0][q - 1])
    k, b, begin, q = k[hit], b[hit], begin[hit], q[hit]
    right, left = order.ahead(begin, q), order.behind(begin - 1, q - 1)
    start = np.maximum(begin - left, begin - k + 1)
    good = (right + left >= k) & (start + k <= (h + size)[b])
    out.append((start[good], k[good]))
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


def _primitive(order: SuffixOrder, start: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Whether squares have no smaller period: none that divides k by a prime."""
    good = np.ones(len(k), bool)
    if not len(k):
        return good
    top = int(k.max())
    least = np.arange(top + 1)  # smallest prime factor
    for p in range(2, int(top**0.5) + 1):
        if least[p] == p:
            multiples = least[p * p :: p]
            multiples[multiples == np.arange(p * p, top + 1, p)] = p
    rest = k.copy()
    while True:
        open_ = np.flatnonzero(good & (rest > 1))
        if not len(open_):
            return good
        prime = least[rest[open_]]
        period = k[open_] // prime
        good[open_] = ~order.same(start[open_], start[open_] + period, 2 * k[open_] - period)
        rest[open_] //= prime


def _distinct(order: SuffixOrder, start: np.ndarray, k: np.ndarray, known: pd.Index | None) -> tuple[np.ndarray, np.ndarray, pd.Index]:
    """Squares whose substrings are neither known nor equal to an earlier one, and what is known with them."""
    keys = pd.MultiIndex.from_arrays([k, *order.identity(start, 2 * k)])
    new = ~keys.duplicated()
    if known is not None:
        new &= ~keys.isin(known)
    keys = keys[new]
    return start[new], k[new], keys if known is None else known.append(keys)


def _vocabulary(order: SuffixOrder, start: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All distinct squares, one place of each, from those that cover the leftmost ones.

    A square turned by one symbol is a square if the sequence has it at all: its first symbol goes behind. That is the step along
    a suffix link to the node of what follows the first symbol, and from there down to the child of that symbol. Where the
    text itself goes on with that symbol the next place is the turned square, so such steps are taken as one stretch; where
    it doesn't, the node is sought, and the walk goes on wherever its child occurs, until what it meets is known.
    """
    known = None
    starts, halves = [], []
    while len(start):
        start, k, known = _distinct(order, start, k, known)
        starts.append(start)
        halves.append(k)
        steps = order.ahead(start, start + k) - k + 1
        by = np.lexsort((start, k))  # stretches of one half length that meet are one
        start, k, steps = start[by], k[by], steps[by]
        stop = start + steps
        opens = np.r_[True, (k[1:] != k[:-1]) | (start[1:] >= stop[:-1])] if len(k) else np.zeros(0, bool)
        start, k, steps = start[opens], k[opens], steps[opens]  # squares of one stretch all reach to its end
        places, of = _spread(start, steps)
        first, half, known = _distinct(order, places, k[of], known)
        starts.append(first)
        halves.append(half)
        last = start + steps - 1
        low, high = order.interval(last + 1, 2 * k - 1)
        several = high - low > 1
        last, k, low, high = last[several], k[several], low[several], high[several]
        start = order.child(low, high, 2 * k - 1, last)
        start, k = start[start >= 0], k[start >= 0]
    return np.concatenate([*starts, np.zeros(0, np.int64)]), np.concatenate([*halves, np.zeros(0, np.int64)])


def runs(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All maximal runs of two periods at least in the sequences codes[offsets[i]:offsets[i + 1]]: places, lengths and smallest
    periods, by place, then period."""
    if not len(codes):
        return (np.zeros(0, np.int64),) * 3
    order = SuffixOrder(codes, offsets)
    start, k = _leftmost(order)
    good = _primitive(order, start, k)
    start, k = _vocabulary(order, start[good], k[good])
    low, high = order.interval(start, 2 * k)  # where each square occurs
    slots, of = _spread(low, high - low)
    places, k = order.slots[slots], k[of]
    by = np.lexsort((places, k))
    places, k = places[by], k[by]
    opens = np.r_[True, (k[1:] != k[:-1]) | (places[1:] > places[:-1] + 1)] if len(k) else np.zeros(0, bool)
    at = np.flatnonzero(opens)
    last = np.append(at[1:], len(k))[: len(at)] - 1
    begin, period = places[at], k[at]
    length = places[last] + 2 * period - begin
    by = np.lexsort((period, begin))
    return begin[by], length[by], period[by]


def _find(least_length: int, least_exponent: int):
    fields = [pa.field(c, pa.int64()) for c in ("start", "length", "period")]

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                text = batch.column("text")
                words = hash_words(text, lower=False)
                begin, length, period = runs(words.hashes, words.offsets)
                wanted = length >= np.maximum(least_length, least_exponent * period)
                begin, length, period = begin[wanted], length[wanted], period[wanted]
                gone = np.zeros(len(words.hashes) + 1, np.int64)
                np.add.at(gone, begin + period, 1)
                np.add.at(gone, begin + length, -1)
                stays = np.cumsum(gone)[:-1] == 0
                bounds = np.searchsorted(begin, words.offsets)
                row = np.searchsorted(words.offsets, begin, "right") - 1
                found = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays([pa.array(x) for x in (begin - words.offsets[row], length, period)], fields=fields))
                dropped = np.diff(np.append(0, np.cumsum(~stays))[words.offsets])
                kept = []
                for data, a, z, less in zip(text.cast(pa.binary()).to_pylist(), words.offsets[:-1].tolist(), words.offsets[1:].tolist(), dropped.tolist(), strict=True):
                    own = (data or b"").split()  # at white space of ASCII, as hash_words does
                    kept.append(b" ".join(compress(own, stays[a:z].tolist()) if less else own))
                n = pa.array(np.diff(words.offsets))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), n, found, pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return frugal(run)


def periodic_runs(docs: DataFrame, least_length: int = 6, least_exponent: int = 4) -> DataFrame:
    """doc_id, n_words, runs, collapsed for every row of docs (doc_id, text and any others).

    runs: array of (start, length, period) by start, then period: all stretches of words with that smallest period that no
    neighbouring word extends and that have at least least_length words and least_exponent (2 or more) periods; numbered from
    0. collapsed: the words without those that lie in a run behind its first period, joined by one space.

    There is no shuffle: a task takes about a megabyte of texts at a time, orders the suffixes of all of them at once, and
    needs some 100 bytes a word and as much again for each doubling of the longest repeat. A text of any length is one
    sequence and never cut. Words count as equal if their 64-bit hashes are (see common.hash_spans: of n distinct words of over
    8 bytes in one text, about n**2 / 2**65 pairs are taken for one). Null or empty text: no words, no runs, empty collapsed.
    Rows with a null or repeated doc_id stand for themselves; an empty table gives no rows.
    """
    if least_exponent < 2:
        raise ValueError("a run has two periods at least")
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return table.mapInArrow(_find(least_length, least_exponent), "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def plant(docs: DataFrame) -> DataFrame:
    """doc_id, text: a tenth of the texts, by the CRC-32 of doc_id, go on periodically from some word on."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    parts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).alias("g"))
    parts = parts.withColumn("n", F.nullif(F.size("w"), F.lit(0)).cast("long"))
    parts = parts.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    turn = F.slice("w", F.col("a").cast("int") + 1, F.col("p").cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    planted = F.slice(F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")), F.flatten(F.array_repeat(turn, times))), F.lit(1), F.col("n").cast("int"))
    return parts.select("doc_id", F.when(F.col("n") > 0, F.concat_ws(" ", planted)).otherwise(F.col("text")).alias("text"))


def digest(docs: DataFrame) -> DataFrame:
    found = periodic_runs(plant(docs))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    length, start, period = best["length"], -best["start"], -best["period"]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
