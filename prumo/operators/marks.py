"""Marks: where names and patterns stand in texts, as rows; and what stands near what, by joins on stretches of the text."""

from __future__ import annotations

import re
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from prumo.functions import text as texts
from prumo.shared import kept

#: Bytes of names that one automaton holds; more names meet the texts in a join instead.
MOST_BYTES = 8 << 20


class _Folds(dict):
    """Lower case without accents, a character for each character, worked out as characters come."""

    def __missing__(self, code: int) -> str:
        base = unicodedata.normalize("NFD", chr(code).lower())
        self[code] = base[0] if base and not unicodedata.combining(base[0]) else " "
        return self[code]


_FOLDS = _Folds()


def fold(text: str) -> str:
    if not text.isascii():
        for c in set(text):
            if not c.isascii() and (own := _FOLDS[ord(c)]) != c:
                text = text.replace(c, own)
    return text.lower()


def flat(text: str) -> str:
    """White space as single spaces, none at the ends."""
    return " ".join(text.split())


#: By its first stem: the automaton of a list of stems.
_STEMS: dict[tuple, object] = {}
#: By the number of a list of names: its automaton, one list for each worker.
_BUILT: dict[str, object] = {}


def _automaton(number: str, terms: list[tuple[int, str, str]]):
    """Finds terms in a text; each has the (id, kind) that share it."""
    if number not in _BUILT or not number:
        import ahocorasick

        built, owners = ahocorasick.Automaton(), {}
        for id_, kind, term in terms:
            owners.setdefault(term, []).append((id_, kind))
        for term, own in owners.items():
            built.add_word(term, (len(term), own))
        built.make_automaton()
        _BUILT.clear()
        _BUILT[number] = built
    return _BUILT[number]


_MARK = "kind string, id long, at int, until int, said string, before string, upper int, letters int"
_MARK_TYPES = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32()]
_BEFORE = re.compile(r"([^\W\d_]+) $")


def _mark(kind: str, id_: int, at: int, until: int, text: str, start: int = 0) -> tuple:
    """A name's mark; text begins at character `start`."""
    before = _BEFORE.search(text[max(0, at - start - 40) : at - start])
    around = text[max(0, at - start - 200) : until - start + 200]
    return kind, id_, at, until, text[at - start : until - start], before and before[1], sum(map(str.isupper, around)), sum(map(str.isalpha, around))


def _stands(low: str, at: int, until: int) -> bool:
    """Whether low[at:until] is no part of a longer word."""
    return not (at and _letter(low[at - 1]) or until < len(low) and _letter(low[until]))


def _names(finder, whole: bool, low: str, text: str) -> Iterator[tuple]:
    for end, (size, own) in finder.iter(low) if len(finder) else ():
        at, until = end + 1 - size, end + 1
        if whole and not _stands(low, at, until):
            continue
        for id_, kind in own:
            yield _mark(kind, id_, at, until, text)


def _letter(c: str) -> bool:
    return "a" <= c <= "z" or "0" <= c <= "9"


def marks(df: DataFrame, key: str, text: str, patterns: dict[str, str], names: DataFrame | None = None, whole: bool = True, around: dict[str, tuple[int, int]] | None = None, stems: dict[str, list[str]] | None = None) -> DataFrame:
    """key (the column of that name, whatever it is called), kind, id, at, until, said, before, upper, letters: a row for each place of a pattern or name, places being characters of the text
    with white space as single spaces.

    patterns: kind -> regular expression for the text in lower case without accents. stems: kind -> pieces of words, all sought in one pass,
    whatever stands around. names: (id, kind, term), terms found
    in the same way, as whole words unless `whole` is False; with names, texts that hold none have no marks at all. said: the folded
    match, or for kinds in `around` the original text so many characters before and behind its start. Names have the word before them,
    and how many letters within 200 characters are capitals.

    Names go to the workers as one automaton if they have at most MOST_BYTES (checked). More of them, as whole words, meet the places of
    their first two words in a join; names that may lie in longer words are met by their first characters, and each text is searched
    for those that it met.
    """
    kind = df.schema[key].dataType.simpleString()
    rules = [(k, re.compile(rx)) for k, rx in patterns.items()]
    cuts = around or {}
    parts = [(x, (k, len(x))) for k, own in (stems or {}).items() for x in own]

    def pieces():
        if parts[0] not in _STEMS:
            import ahocorasick

            built, owners = ahocorasick.Automaton(), {}
            for x, owner in parts:
                owners.setdefault(x, []).append(owner)
            for x, own in owners.items():
                built.add_word(x, own)
            built.make_automaton()
            _STEMS.clear()
            _STEMS[parts[0]] = built
        return _STEMS[parts[0]]

    def scan(own, finder, text: str) -> Iterator[tuple]:
        text = flat(text or "")
        low = fold(text)
        if finder is not None:
            found = list(_names(finder, whole, low, text))
            if not found:
                return
            yield from ((own, *m) for m in found)
        yield from others(own, text, low)

    def others(own, text: str, low: str) -> Iterator[tuple]:
        for end, kinds in pieces().iter(low) if stems else ():
            for k, size in kinds:
                yield own, k, None, end + 1 - size, end + 1, low[end + 1 - size : end + 1], None, None, None
        for k, rule in rules:
            for m in rule.finditer(low):
                said = text[max(0, m.start() - cuts[k][0]) : m.start() + cuts[k][1]].strip() if k in cuts else m[0]
                yield own, k, None, m.start(), m.end(), said, None, None, None

    def rows(batch: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [[]] * 9
        kinds = [batch.schema.field(0).type, *_MARK_TYPES]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "kind", "id", "at", "until", "said", "before", "upper", "letters"])

    schema = f"key {kind}, {_MARK}"
    if names is None:

        def plain(batches):
            for batch in batches:
                yield rows(batch, [m for own, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for m in scan(own, None, t)])

        return df.select(key, text).mapInArrow(plain, schema)
    known = names.select(F.col("id").cast("long").alias("id"), "kind", "term").filter("term is not null and trim(term) <> ''")
    size = known.agg(F.sum(F.octet_length("term") + 24)).first()[0] or 0
    if size <= MOST_BYTES:
        held = known.toArrow()
        terms = df.sparkSession.sparkContext.broadcast([(i, k, fold(flat(t))) for i, k, t in zip(*(held.column(c).to_pylist() for c in ("id", "kind", "term")), strict=True)])
        number = uuid.uuid4().hex

        def search(batches):
            finder = _automaton(number, terms.value)
            for batch in batches:
                yield rows(batch, [m for own, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for m in scan(own, finder, t)])

        return df.select(key, text).mapInArrow(search, schema)

    def search_own(batches):
        for batch in batches:
            yield rows(batch, [m for r in batch.to_pylist() for m in scan(r["_key"], _automaton("", [(x["id"], x["kind"], fold(flat(x["term"]))) for x in r["_terms"]]), r["_text"])])

    if whole:
        return _of_heads(df, key, text, known, others, kind)
    own = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    met = _meet(own, "_key", "_text", known).groupBy("_key").agg(F.collect_list(F.struct("id", "kind", "term")).alias("_terms"))
    return own.join(met, "_key").mapInArrow(search_own, schema)


#: Bits of one block of the filter of heads, as Spark's bitmap aggregates have them, and bits of the filter at most (32 MB; more heads
#: let more places through, which the join then drops).
_BLOCK, _MOST_BITS = 1 << 15, 1 << 28
_WORD = re.compile("[a-z0-9]+")


def _bits(head: str, size: int) -> tuple[int, int]:
    """The two bits of a head in a filter of 2 ** size bits."""
    n = zlib.crc32(head.encode())
    return n & ((1 << size) - 1), (n * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - size)


def bloom(heads: DataFrame, n: int) -> tuple[int, bytes]:
    """A Bloom filter of the first column of heads, of which about n differ: of 2 ** size bits, and its bytes. See _bits."""
    size = min(max(64 * n, _BLOCK).bit_length(), _MOST_BITS.bit_length() - 1)

    def set_bits(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b for head in batch.column(0).to_pylist() for b in _bits(head, size)], pa.int64())], ["bit"])

    blocks = heads.mapInArrow(set_bits, "bit long").groupBy(F.floor(F.col("bit") / _BLOCK).alias("block")).agg(F.bitmap_construct_agg(F.col("bit") % _BLOCK).alias("bits"))
    filled = bytearray((1 << size) // 8)
    for block, bits in blocks.toLocalIterator():
        filled[block * _BLOCK // 8 : (block + 1) * _BLOCK // 8] = bits
    return size, bytes(filled)


def _headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, kind, term (folded), head (its first two words, or its one), skip (characters before them); terms without a word have none."""
    for batch in batches:
        out = []
        for id_, kind, term in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            low = fold(flat(term))
            if words := list(islice(_WORD.finditer(low), 2)):
                out.append((id_, kind, low, " ".join(w[0] for w in words), words[0].start()))
        columns = list(zip(*out, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32()), strict=True)], ["id", "kind", "term", "head", "skip"])


def _of_heads(df: DataFrame, key: str, text: str, known: DataFrame, others, key_type: str) -> DataFrame:
    """Marks of texts with any of many names, sought as whole words (see marks).

    A Bloom filter of the names' heads (first two words, or the one) goes to the workers. One pass over the texts finds the places
    where a head may stand and writes each with the text around it, besides the other marks of such texts; places then meet the
    names by their head, and each pair is compared. So texts are neither dealt out nor read again, only places are.
    """
    spark = df.sparkSession
    names = kept(known.select("id", "kind", "term").mapInArrow(_headed, "id long, kind string, term string, head string, skip int"), "names")
    n, longest, skip, single = names.agg(F.approx_count_distinct("head"), F.max(F.length("term")), F.max("skip"), F.bool_or(~F.contains("head", F.lit(" ")))).first()
    size, filled = bloom(names.select("head"), n or 1)
    held = spark.sparkContext.broadcast(filled)
    low_bits, shift, left, right = (1 << size) - 1, 32 - size, 201 + (skip or 0), 201 + (longest or 0)

    def heads(low: str, filter_: bytes) -> Iterator[tuple[int, str]]:
        """Places where heads may stand."""
        crc, last, at = zlib.crc32, "", 0
        for word in _WORD.finditer(low):
            own = word[0]
            for head in ((f"{last} {own}",) if not single else (f"{last} {own}", own)) if last else (own,) if single else ():
                n = crc(head.encode())
                b, c = n & low_bits, (n * 0x9E3779B1 & 0xFFFFFFFF) >> shift
                if filter_[b >> 3] >> (b & 7) & 1 and filter_[c >> 3] >> (c & 7) & 1:
                    yield (word.start() if head is own else at), head
            last, at = own, word.start()

    def places(batches):
        filter_, number = held.value, TaskContext.get().partitionId() << 33
        for batch in batches:
            found = []
            for own, said in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                number += 1
                said = flat(said or "")
                low = fold(said)
                some = [(number, own, None, None, at, None, head, None, None, None, said[max(0, at - left) : at + right]) for at, head in heads(low, filter_)]
                if some:
                    found += some
                    found += [(number, *m, None) for m in others(own, said, low)]
            columns = list(zip(*found, strict=True)) or [[]] * 11
            kinds = [pa.int64(), batch.schema.field(0).type, *_MARK_TYPES, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["number", "key", "kind", "id", "at", "until", "said", "before", "upper", "letters", "near"])

    def compare(batches):
        for batch in batches:
            found = []
            for number, own, at, near, id_, kind, term, gone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                low, start = fold(near), max(0, at - left)
                begin = at - gone - start
                if begin >= 0 and low.startswith(term, begin) and _stands(low, begin, begin + len(term)):
                    found.append((number, own, *_mark(kind, id_, at - gone, at - gone + len(term), near, start)))
            columns = list(zip(*found, strict=True)) or [[]] * 10
            kinds = [pa.int64(), batch.schema.field(1).type, *_MARK_TYPES]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["number", "key", "kind", "id", "at", "until", "said", "before", "upper", "letters"])

    seen = kept(df.select(key, text).mapInArrow(places, f"number long, key {key_type}, {_MARK}, near string"), "places")
    met = seen.filter("kind is null").select("number", "key", "at", F.col("said").alias("head"), "near").join(names, "head")
    own = kept(met.select("number", "key", "at", "near", "id", "kind", "term", "skip").mapInArrow(compare, f"number long, key {key_type}, {_MARK}"), "names-found")
    beside_them = seen.filter("kind is not null").drop("near").join(own.select("number").distinct(), "number", "left_semi")
    return own.unionByName(beside_them).drop("number")


def _meet(df: DataFrame, key: str, text: str, names: DataFrame) -> DataFrame:
    """key, id, kind, term: names that may lie in longer words and begin with the same three characters (or fewer) as some place of the text."""
    folded = df.select(key, texts.fold_keep(F.col(text)).alias("_low"))
    places = F.sequence(F.lit(1), F.greatest(F.length("_low"), F.lit(1)))
    cuts = [F.transform(places, lambda i: F.substring(F.col("_low"), i, F.lit(n))) for n in (1, 2, 3)]  # noqa: B023
    return folded.select(key, F.explode(F.array_distinct(F.concat(*cuts))).alias("_g")).join(names.withColumn("_g", F.substring(texts.fold_keep(F.col("term")), 1, 3)), "_g").drop("_g")


def beside(anchors: DataFrame, others: DataFrame, reach: int, facts: dict[str, Column]) -> DataFrame:
    """anchors (key, at, until and any others) with facts: aggregates over the marks of `others` (as kind, id, said, m_at, m_until) that begin
    within about `reach` characters of the anchor. Facts say the exact distances.

    Texts are cut into stretches of `reach` characters; an anchor stands for the few stretches that it reaches, a mark for its
    own, so a long text with many of both is many small groups.
    """
    columns = anchors.columns
    stretches = F.sequence(F.floor((F.col("at") - reach) / reach), F.floor((F.col("until") + reach) / reach))
    there = others.select(F.col("key").alias("_key"), F.col("kind").alias("m_kind"), F.col("id").alias("m_id"), F.col("said").alias("m_said"), F.col("at").alias("m_at"), F.col("until").alias("m_until"), F.floor(F.col("at") / reach).alias("_own"))
    met = anchors.withColumn("_stretch", F.explode(stretches)).join(there, (F.col("key") == F.col("_key")) & (F.col("_stretch") == F.col("_own")), "left")
    return met.groupBy(*columns).agg(*(f.alias(n) for n, f in facts.items()))


def any_mark(kind: str, begins: Column | None = None, ends: Column | None = None) -> Column:
    """Fact: whether a mark of a kind begins at or after `begins` and ends at or before `ends`."""
    hit = F.col("m_kind") == kind
    if begins is not None:
        hit &= F.col("m_at") >= begins
    if ends is not None:
        hit &= F.col("m_until") <= ends
    return F.coalesce(F.bool_or(hit), F.lit(False))


def coalesced(df: DataFrame, keys: list[str], lo: str, hi: str, n: str) -> DataFrame:
    """keys, lo, hi, n: intervals of each key that overlap or touch as one, with how many went into it: a sweep in the order of
    their begins against the farthest end so far."""
    order = W.partitionBy(*keys).orderBy(lo, hi)
    reached = F.max(hi).over(order.rowsBetween(W.unboundedPreceding, -1))
    swept = df.select(*keys, lo, hi, (reached.isNull() | (F.col(lo) > reached)).cast("int").alias("_fresh")).withColumn("_run", F.sum("_fresh").over(order))
    return swept.groupBy(*keys, "_run").agg(F.min(lo).alias(lo), F.max(hi).alias(hi), F.count("*").alias(n)).drop("_run")
