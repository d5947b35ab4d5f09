"""Free text to entities, and texts to watch-lists, by joins on word n-grams instead of pairwise containment."""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from prumo.functions import text as texts
from prumo.operators.marks import bloom, marks
from prumo.shared import kept


#: White space as \s has it in Spark's expressions, and first words that a worker remembers.
_SPACES, _REMEMBERED = "\t\n\x0b\f\r", 1 << 18


class _Begins(dict):
    """Whether a term may begin with a word, worked out as words come."""

    def __init__(self, may):
        self.may = may

    def __missing__(self, word: str) -> bool:
        if len(self) >= _REMEMBERED:
            self.clear()
        self[word] = own = self.may(word)
        return own


def _terms_in(text: str, begins: _Begins, lengths: list[int]) -> dict[str, int]:
    """Runs of words that may be terms, each with the number (from 1) of its first word where it first stands."""
    for c in _SPACES:
        text = text.replace(c, " ")
    words, found = [w for w in text.split(" ") if w], {}
    for i in [i for i, w in enumerate(words) if begins[w]]:
        for n in lengths:
            if i + n <= len(words) and (gram := " ".join(words[i : i + n])) not in found and begins.may(gram):
                found[gram] = i + 1
    return found


def known_grams(df: DataFrame, keys: list[str], text: Column, terms: DataFrame, lengths: list[int]) -> DataFrame:
    """keys, place (from 1), gram: the runs of n words, for n in lengths, that may be one of terms (its only column), where each first
    stands in its text. Few others get through, which a join with the terms drops.

    A Bloom filter of the terms and their first words goes to the workers (see marks: 32 MB at most). One pass over the texts looks
    each word up; only where a term may begin runs are put together, so neither all runs of a text nor the text leave the task.
    """
    (term,) = terms.columns
    known = terms.filter(F.col(term).isNotNull()).distinct()
    both = known.select(F.explode(F.array(F.col(term), F.substring_index(term, " ", 1))).alias("term"))
    size, filled = bloom(both, 2 * known.count())
    held, low_bits, shift = df.sparkSession.sparkContext.broadcast(filled), (1 << size) - 1, 32 - size

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_, crc = held.value, zlib.crc32

        def may(said: str) -> bool:
            n = crc(said.encode())
            b, c = n & low_bits, (n * 0x9E3779B1 & 0xFFFFFFFF) >> shift
            return bool(filter_[b >> 3] >> (b & 7) & 1 and filter_[c >> 3] >> (c & 7) & 1)

        begins = _Begins(may)
        for batch in batches:
            rows, places, grams = [], [], []
            for i, said in enumerate(batch.column(len(keys))):
                for gram, place in _terms_in(said.as_py() or "", begins, lengths).items():
                    rows.append(i)
                    places.append(place)
                    grams.append(gram)
            own = [batch.column(k).take(pa.array(rows, pa.int64())) for k in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*own, pa.array(places, pa.int32()), pa.array(grams, pa.string())], [*keys, "place", "gram"])

    schema = StructType([*(df.schema[k] for k in keys), StructField("place", IntegerType()), StructField("gram", StringType())])
    return df.select(*keys, text.alias("_text")).mapInArrow(search, schema)


def longest_name(df: DataFrame, key: str, text: Column, names: DataFrame, name: str, lengths: list[int]) -> DataFrame:
    """The longest name each text holds as whole words, the first of equally long ones; texts without a name are left out."""
    known = kept(names.select(name).distinct(), "names")
    hits = known_grams(df, [key], text, known, lengths).join(known, F.col("gram") == F.col(name))
    return hits.groupBy(key).agg(F.min_by(F.struct(name, "place"), F.struct(-F.length(name), F.col("place"), F.col(name))).alias("_v")).select(key, f"_v.{name}", "_v.place")


def watchlist(df: DataFrame, key: str, text: Column, watch: DataFrame, watch_key: str, name: str, topic: str, name_words: int, topic_words: int) -> DataFrame:
    """(text, entry) pairs where the text holds the entry's name or topic; the name wins. Kind and first place."""
    terms = watch.select(watch_key, F.explode(F.array(F.struct(F.lit(0).alias("rank"), F.lit("name").alias("kind"), F.col(name).alias("term")), F.struct(F.lit(1).alias("rank"), F.lit("topic").alias("kind"), F.col(topic).alias("term")))).alias("_t")).select(watch_key, "_t.*")
    terms = kept(terms, "terms")
    grams = known_grams(df, [key], text, terms.select("term"), sorted({name_words, topic_words}))
    hits = grams.join(terms, F.col("gram") == F.col("term"))
    return hits.groupBy(key, watch_key).agg(F.min_by(F.struct("kind", "place"), F.struct("rank", "place")).alias("_v")).select(key, watch_key, "_v.kind", "_v.place")


def code_then_name(left: DataFrame, right: DataFrame, code: str, name: str, value: str) -> DataFrame:
    """left with value from the row of equal code, else from the row of equal name; a code that is there wins even if its
    value is null. right has one row per code; of equal names the smallest code counts."""
    by_code = right.select(F.col(code).alias("_c"), F.col(value).alias("_v1"))
    by_name = right.groupBy(F.col(name).alias("_n")).agg(F.min_by(value, code).alias("_v2"))
    joined = left.join(by_code, F.col(code) == F.col("_c"), "left").join(by_name, F.col(name) == F.col("_n"), "left")
    return joined.withColumn(value, F.when(F.col("_c").isNotNull(), F.col("_v1")).otherwise(F.col("_v2"))).drop("_c", "_v1", "_n", "_v2")


def by_folded_name(left: DataFrame, right: DataFrame, name: str, within: list[str], code: str) -> DataFrame:
    """left with the code of the row in right whose name is equal without accents and case, within equal other columns; the
    smallest code of several. One equi join on the folded name."""
    known = right.withColumn("_n", texts.fold_ascii(F.col(name))).groupBy("_n", *within).agg(F.min(code).alias(code))
    return left.withColumn("_n", texts.fold_ascii(F.col(name))).join(known, ["_n", *within], "left").drop("_n")


#: Particles before a state's name, and institutions whose place name isn't where they are.
_OF = ("do", "da", "dos", "das", "de")
_INSTITUTIONS = ("fundacao", "instituto", "associacao", "consorcio", "faculdade", "universidade", "cooperativa")


def place_in_title(df: DataFrame, key: str, title: str, link: str, places: DataFrame, code: str, name: str, state: str) -> DataFrame:
    """key, code: the place that a title names; titles without one are left out.

    A name counts where it first stands in the folded title, at the start of a word (its end may lie in a longer word), with
    at least six letters, unless the words before it make it a state or an institution, or 'do', 'da' ... follows. The longest
    name wins, then the smallest code. A title with other marks of states only ('- XX', any two capitals), or a link under
    another state's government, rejects it. All names are sought in one pass over the titles (see marks); only hits go on.
    """
    folded = df.select(F.col(key).alias("key"), F.col(title).alias("_title"), F.col(link).alias("_link"), F.regexp_replace(texts.fold_ascii(F.col(title)), r"\s+", " ").alias("_t"))
    names = places.select(F.col(code).cast("long").alias("id"), F.upper(state).alias("_state"), F.regexp_replace(texts.fold_ascii(F.col(name)), r"\s+", " ").alias("term"))
    names = names.filter(F.length(F.replace("term", F.lit(" "), F.lit(""))) >= 6)
    hits = marks(folded, "key", "_t", {}, names.withColumn("kind", F.lit("place")), whole=False)
    hits = hits.groupBy("key", "id").agg(F.min("at").alias("_at")).join(names, "id").join(folded, "key")
    before, behind = F.expr("left(_t, _at)"), F.expr("substring(_t, _at + 1 + length(term))")
    last = F.regexp_extract(F.trim(before), r"([a-z]+)$", 1)
    a_state = before.contains("estado") & last.isin(*_OF)
    hits = hits.filter(~before.rlike("[a-z]$") & ~a_state & ~last.isin(*_INSTITUTIONS) & ~behind.rlike(r"^\s+d[oa]s?\s+\w"))
    best = hits.groupBy("key").agg(F.min_by(F.struct("id", "_state", "_title", "_link"), F.struct(-F.length("term"), F.col("id"))).alias("_v")).select("key", "_v.*")
    states = F.regexp_extract_all("_title", F.lit(r"-\s*([A-Z]{2})\b"), F.lit(1))
    host = texts.state_of_host(F.col("_link"))
    fine = ((F.size(states) == 0) | F.array_contains(states, F.col("_state"))) & (host.isNull() | (host == F.col("_state")))
    return best.filter(fine).select(F.col("key").alias(key), F.col("id").cast(places.schema[code].dataType).alias(code))


def towns_of(df: DataFrame, key: str, state: str, entity: str, entries: DataFrame, entry: str, city: str) -> DataFrame:
    """key, entry: entries (entry, state, city) of the row's state whose town the row's entity names, as whole words."""
    named = entries.select(F.col(entry).cast("long").alias("id"), F.lit("town").alias("kind"), F.col(city).alias("term"))
    hits = marks(df, key, entity, {}, named).select("key", F.col("id").alias("_id")).distinct()
    there = hits.join(df.select(F.col(key).alias("key"), F.col(state).alias("_state")), "key")
    own = entries.select(F.col(entry).alias("_entry"), F.col(state).alias("_own"))
    return there.join(own, (F.col("_id") == F.col("_entry")) & (F.col("_state") == F.col("_own"))).select(F.col("key").alias(key), F.col("_entry").alias(entry))


def contest_keys(text: Column) -> Column:
    """Numbers such as 001/2023 or 1/23 in a text as 'number/two digits of the year'."""
    rx = F.lit(r"(?<!\d)(\d+)\s*/\s*(?:20)?(\d{2})(?!\d)")
    numbers, years = F.regexp_extract_all(text, rx, F.lit(1)), F.regexp_extract_all(text, rx, F.lit(2))
    return F.zip_with(numbers, years, lambda n, y: F.concat(F.regexp_replace(n, "^0+(?=.)", ""), F.lit("/"), y))


def target_contest(df: DataFrame, key: str, state: str, entity: str, text: str, targets: DataFrame, target: str, city: str, number: str, role: str) -> DataFrame:
    """key, target: the contest that a publication is about. Of the contests of the towns that its entity names, one whose number it
    cites comes first (a number of no such form counts if its own words are in the text); else, if it speaks of physicians, one
    without a number with a word of five letters or more of its role in the text, where medical examinations and the like don't
    count. The smallest target of several."""
    folded = texts.fold_keep(F.col(text))
    pubs = df.select(key, contest_keys(F.col(text)).alias("_cited"), folded.alias("_low"), F.regexp_replace(folded, r"(?:exame|laudo|atestado) medico|junta medica|perito medico|medico[- ]veterin", " ").alias("_clean"))
    known = targets.select(target, texts.fold_keep(F.col(number)).alias("_number"), contest_keys(F.col(number)).alias("_numbers"), F.filter(F.split(texts.fold_keep(F.col(role)), " "), lambda w: F.length(w) >= 5).alias("_words"))
    met = towns_of(df, key, state, entity, targets, target, city).join(known, target).join(pubs, key)
    numbered = F.coalesce(F.col("_number"), F.lit("")) != ""
    cites = numbered & F.when(F.size("_numbers") > 0, F.arrays_overlap("_cited", "_numbers")).otherwise(F.contains("_low", F.col("_number")))
    named = ~numbered & F.col("_low").contains("medic") & (F.col("_words").isNull() | (F.size("_words") == 0) | F.exists("_words", lambda w: F.col("_clean").contains(w)))
    ranked = met.withColumn("_rank", F.when(cites, 0).when(named, 1)).filter("_rank is not null")
    return ranked.groupBy(key).agg(F.min_by(target, F.struct("_rank", target)).alias(target))


def fill_by_role(page: DataFrame, notice: DataFrame, role: str, columns: list[str]) -> DataFrame:
    """page with nulls of `columns` taken from the notice's row of the equal folded role (the first of several by role); rows
    that only the notice has are not added."""
    key = F.col("_k")
    firsts = notice.withColumn("_k", texts.fold_keep(F.col(role))).groupBy("_k").agg(F.min_by(F.struct(*columns), F.col(role)).alias("_v"))
    joined = page.withColumn("_k", texts.fold_keep(F.col(role))).join(firsts, "_k", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_v.{c}")) for c in columns}).drop(key, "_v")


def entry_of(df: DataFrame, key: str, entries: str, field: str, wanted: str) -> DataFrame:
    """key, entry: of an array of structs the first whose field equals the row's wanted text without accents and case; null
    where none does. A row stays a row, whatever its key."""
    bare = lambda c: F.trim(F.regexp_replace(F.lower(F.regexp_replace(F.translate(c, *_ACCENTS), r"\p{Mn}+", "")), r"(?U)\s+", " "))
    own = F.filter(entries, lambda e: bare(e[field]) == bare(F.col(wanted)))
    return df.select(key, F.get(own, F.lit(0)).alias("entry"))


#: Letters with accents and without, for comparing inside arrays, where texts can't leave the JVM.
_ACCENTS = "".join(chr(c) for c in range(0xC0, 0x250) if len(unicodedata.normalize("NFD", chr(c))) > 1), "".join(unicodedata.normalize("NFD", chr(c))[0] for c in range(0xC0, 0x250) if len(unicodedata.normalize("NFD", chr(c))) > 1)
