"""Token counts of every prefix of a text by dynamic programming, so that budgets are answered without encoding again."""

from __future__ import annotations

import functools
from os.path import commonprefix

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prumo.llm.common import frugal, hash_spans, slices, text_buffer
from prumo.llm.token_store import Pieces, _unlike

#: How the library writes a space.
BLANK = "▁"


class PrefixCounter:
    """Counts the tokens of all prefixes of texts as a BPE model of the sentencepiece library gives them.

    The library puts a space before a text, takes its characters for symbols and joins the neighbouring pair of the best score
    again and again, the leftmost of equal ones. Its encoding of a text is the one row of tokens in which any two neighbours,
    encoded together, stay as they are. So a prefix ends with the one token that is at peace with the last token of the prefix
    before it, and has one token more than that; that is what `_solve` fills in from left to right. Characters without a piece
    are never joined and count a token for each byte.

    Tokens never reach over a pair of characters that no piece contains side by side (nothing but a space is followed by a space
    in a piece), so texts are cut there into units, and each distinct unit is solved once; a prefix has the tokens of the units
    before it and of its part of the last one. Units are found by their hashes and compared by their bytes. What is solved
    is held against the library's own number for the whole unit; a unit that differs has each prefix encoded by the library.
    pieces: counts of the units known so far, emptied when there are more than MOST.
    """

    MOST = 1_000_000

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        p = self.library
        self.ids: dict[str, int] = {}
        self.score: list[float] = []
        self.names: list[str] = []
        for i in range(p.vocab_size()):
            name = p.id_to_piece(i)
            self.names.append(name)
            self.score.append(p.get_score(i))
            if not (p.is_unknown(i) or p.is_control(i) or p.is_unused(i) or p.is_byte(i)):
                self.ids[name] = i
        self.tails = {name[k:] for name in self.ids for k in range(len(name))}
        self.joined = np.ones((256, 256), bool)  # bytes that may stand side by side in a token; all that aren't ASCII may
        self.joined[:128, :128] = False
        for name in self.ids:
            own = np.frombuffer(name.replace(BLANK, " ").encode(), np.uint8)
            self.joined[own[:-1], own[1:]] = True
        self.solid = {i: self._encode(name) == [i] for name, i in self.ids.items()}
        self.peace: dict[tuple[int, int], bool] = {}
        self.pieces = Pieces()

    def _encode(self, text: str) -> list[int]:
        """Ids of a text of known characters, by joining pairs."""
        parts = list(text)
        ids, score = self.ids, self.score
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or score[i] > best):
                    best, at = score[i], k
            if at < 0:
                return [ids.get(x, -1) for x in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _at_peace(self, a: int, b: int) -> bool:
        both = self.names[a] + self.names[b]
        known = self.peace[a, b] = both not in self.ids and self._encode(both) == [a, b]
        return known

    def _solve(self, unit: str, last: list[int], count: list[int]) -> bool:
        """Fills in, from what is filled in on, the last token (-1: no piece) and the number of tokens of the unit's first 0, 1,
        2, ... characters (spaces as BLANK). Whether that went well."""
        ids, tails, peace = self.ids, self.tails, self.peace
        for end in range(len(last), len(unit) + 1):
            found, start = [], end - 1
            while start >= 0 and (part := unit[start:end]) in tails:
                own = ids.get(part)
                if own is not None:
                    found.append((start, own))
                start -= 1
            for start, own in reversed(found):
                before = last[start]
                if self.solid[own]:
                    if before < 0:
                        break
                    known = peace.get((before, own))
                    if known if known is not None else self._at_peace(before, own):
                        break
            else:
                if unit[end - 1] in ids:
                    return False
                start, own = end - 1, -1  # no piece: one token a byte, joined with nothing
            last.append(own)
            count.append(count[start] + (1 if own >= 0 else len(unit[start].encode())))
        return True

    def _learn(self, units: list[str]) -> list[list[int]]:
        """Prefix counts of units, each total checked by the library. In alphabetical order, so that what a unit shares with the
        one before it is solved once."""
        out: list[list[int]] = [[]] * len(units)
        totals = [len(x) - 2 for x in self.library.encode([f"\n{u}" for u in units], num_threads=1)]  # a line break is joined with nothing
        last, count, earlier = [-1], [0], ""
        for k in sorted(range(len(units)), key=units.__getitem__):
            unit = units[k].replace(" ", BLANK)
            shared = min(len(commonprefix((earlier, unit))), len(last) - 1) + 1
            last, count, earlier = last[:shared], count[:shared], unit
            if self._solve(unit, last, count) and count[-1] == totals[k]:
                out[k] = count[1:]
            else:
                out[k] = [len(x) - 2 for x in self.library.encode([f"\n{unit[:i]}" for i in range(1, len(unit) + 1)], num_threads=1)]
        return out

    def counts(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the first 0, 1, ... code points of each text, all in one array, and where each text's begin in it. Null
        counts as empty."""
        texts = pc.replace_substring(pc.fill_null(col, "").cast(pa.large_string()), BLANK, " ")
        raw, bounds = text_buffer(texts)
        n = len(bounds) - 1
        buf = np.insert(raw, bounds[:-1], 0x20)  # a text's first symbol
        bounds = bounds + np.arange(n + 1)
        first = np.zeros(len(buf), bool)
        first[1:] = ~self.joined[buf[:-1], buf[1:]]
        first[1:] |= (buf[1:] == 0x20) & (buf[:-1] != 0x20)
        first[bounds[:-1]] = True
        starts = np.flatnonzero(first)
        if not n:
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        size = np.diff(starts, append=len(buf))
        hashes, blocks, block = hash_spans(buf, starts, starts + size)
        which, keys = pd.factorize(hashes)
        index = np.zeros(len(keys), np.int64)
        index[which] = np.arange(len(which))
        speaks = index[which]
        wrong = size != size[speaks]
        wrong[_unlike(np.flatnonzero(~wrong & (speaks != np.arange(len(speaks)))), size, (block, blocks), (speaks, block, blocks))] = True
        held = self.pieces
        if len(held.hashes) > self.MOST:
            held.clear()
        number, other = held.find(keys, size[index], block[index], blocks)
        wrong |= other[which]
        new = np.flatnonzero(number < 0)
        if len(new):
            at = index[new]
            solved = self._learn([buf[a : a + k].tobytes().decode() for a, k in zip(starts[at].tolist(), size[at].tolist(), strict=True)])
            number[new] = held.size.n + np.arange(len(new))
            many = np.array([len(s) for s in solved])
            held.add(keys[new], size[at], block[at], blocks, many, np.fromiter((x for s in solved for x in s), np.int32, int(many.sum())))
        number = number[which]
        at, many = held.at.data[number].astype(np.int64), held.count.data[number].astype(np.int64)
        total = held.ids.data[at + many - 1].astype(np.int64)
        of = np.searchsorted(bounds, starts, "right") - 1  # each unit's text
        before = np.cumsum(total) - total
        before -= before[np.searchsorted(starts, bounds[:-1])][of]  # tokens of the text's earlier units
        place = np.cumsum(many) - many
        out = held.ids.data[np.repeat(at - place, many) + np.arange(int(many.sum()))] + np.repeat(before, many).astype(np.int32)
        offsets = np.r_[place[np.searchsorted(starts, bounds[:-1])], len(out)]
        out[offsets[:-1]] = 0  # in the place of the first symbol: the empty prefix
        if wrong.any():  # two units of one hash: these texts by the library, prefix by prefix
            parts = np.split(out, offsets[1:-1])
            for row in np.unique(of[wrong]).tolist():
                text = texts[row].as_py()
                parts[row] = np.array([len(self.library.encode(text[:i])) for i in range(len(text) + 1)], np.int32)
            return np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        return out, offsets


@functools.cache
def counter(path: str) -> PrefixCounter:
    """One for each worker and model."""
    return PrefixCounter(path)


def _count(path: str):
    def run(batches):
        count = counter(path)
        for whole in batches:
            for batch in slices(whole, "text"):
                col = batch.column("text")
                values, offsets = count.counts(col)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
                size = pc.fill_null(pc.binary_length(col), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, lists], ["doc_id", "n_bytes", "counts"])

    return frugal(run)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def prefix_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, counts for every row of docs (doc_id, text and any others). counts[k] is the number of tokens of the
    text's first k code points, k from 0 to all of them, by the sentencepiece BPE model at path: exact, no sampling.

    There is no shuffle; a task takes about a megabyte of texts at a time, so it holds some 5 MB of counts, or 4 bytes a code
    point of a longer text. Null or empty text: counts = [0], n_bytes = 0. Null doc_ids, repeated doc_ids and extra columns
    don't matter: each row stands for itself. An empty table gives no rows.
    """
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return table.mapInArrow(_count(path or model_path()), "doc_id long, n_bytes long, counts array<int>")


def tokens_of(counts: Column, prefix: Column | None = None) -> Column:
    """Tokens of the first `prefix` code points, or of the whole text."""
    return (F.element_at(counts, -1) if prefix is None else F.get(counts, prefix)).cast("long")


def longest_prefix(counts: Column, budget: int) -> Column:
    """Code points of the longest prefix of at most `budget` tokens. Counts can fall when a letter more completes a piece, so
    the last place that fits is sought, not the first that doesn't."""
    fits = F.array_position(F.transform(F.reverse(counts), lambda c: c <= budget), True)
    return F.size(counts) - fits


def truncate(docs: DataFrame, budget: int, path: str | None = None) -> DataFrame:
    """docs with text cut to its longest prefix of at most `budget` tokens (null stays null), and n_tokens of what is left. doc_id
    must be a key; rows with a null doc_id are left out."""
    cut = longest_prefix(F.col("counts"), budget)
    ends = prefix_counts(docs, path).filter("doc_id is not null").select(F.col("doc_id").alias("_doc"), cut.alias("_cut"), tokens_of(F.col("counts"), cut).alias("n_tokens"))
    kept = docs.drop("n_tokens").join(ends, F.col("doc_id") == F.col("_doc"))
    return kept.withColumn("text", F.expr("substring(text, 1, _cut)")).drop("_doc", "_cut")


def digest(docs: DataFrame, limit: int = 4096) -> DataFrame:
    n = tokens_of(F.col("counts"))
    return prefix_counts(docs).select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))
