"""Phrases in texts by a positional inverted index: postings of words, and joins on shifted positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prumo.shared import kept, spread


def plain_words(text: Column) -> Column:
    """Words between ASCII white space, in lower case."""
    return F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def postings(df: DataFrame, key: str, words: Column) -> DataFrame:
    """word, key, place: where each word of each text stands (from 0). Written once (partitioned or bucketed by word), it serves any
    number of searches."""
    return df.select(key, F.posexplode(words).alias("place", "word")).select("word", key, "place")


def occurrences(index: DataFrame, key: str, phrases: DataFrame, phrase: str, words: Column) -> DataFrame:
    """phrase, key, start of every place where the words of a phrase (a key of phrases) follow each other.

    Of each phrase the word with the fewest postings is looked up, so frequent words bring nothing along; its places, shifted to
    where the phrase would begin, are candidates. Each other word must stand at its own shift: an equi join on text, place and
    word, however many words a phrase has. Phrases without words are nowhere; equal phrases are found each by itself.

    The phrases' words and their rarest ones are written first, so that Spark knows their size and broadcasts them where they are few:
    then only postings of words that some phrase has are dealt out, and once.
    """
    terms = kept(phrases.select(phrase, F.size(words).alias("_n"), F.posexplode(words).alias("_at", "word")), "terms")
    index = index.join(terms.select("word").distinct(), "word", "left_semi")
    counts = index.groupBy("word").agg(F.count("*").alias("_count"))
    ranked = terms.join(counts, "word", "left")  # a word without postings has no count and makes the phrase absent
    rarest = ranked.groupBy(phrase).agg(F.min(F.struct(F.coalesce("_count", F.lit(0)).alias("count"), "_at", "word")).alias("_r"), F.max("_n").alias("_n"))
    rarest = kept(rarest.filter("_r.count > 0").select(phrase, "_n", F.col("_r._at").alias("_shift"), F.col("_r.word").alias("word")), "rarest")
    candidates = index.join(rarest, "word").select(phrase, key, (F.col("place") - F.col("_shift")).alias("start"), "_n", "_shift").filter("start >= 0")
    asked = candidates.join(terms.select(phrase, "_at", "word"), phrase).filter("_at <> _shift").select(phrase, key, "start", (F.col("start") + F.col("_at")).alias("place"), "word")
    asked = spread(asked, key, "place", "word")  # these rows take few bytes and would be sorted in very few tasks
    met = asked.join(index, [key, "place", "word"], "left_semi").groupBy(phrase, key, "start").agg(F.count("*").alias("_met"))
    both = candidates.join(met, [phrase, key, "start"], "left")
    return both.filter(F.coalesce("_met", F.lit(0)) == F.col("_n") - 1).select(phrase, key, "start")


def unique_text(index: DataFrame, key: str, phrases: DataFrame, phrase: str, words: Column) -> DataFrame:
    """phrase, key, texts: the one text that has the phrase, however often, and how many have it; key is null where none or several do, since
    a guess may be the wrong page."""
    found = occurrences(index, key, phrases, phrase, words).select(phrase, key).distinct().groupBy(phrase).agg(F.count("*").alias("texts"), F.min(key).alias("_one"))
    out = phrases.select(phrase).join(found, phrase, "left")
    return out.select(phrase, F.when(F.col("texts") == 1, F.col("_one")).alias(key), F.coalesce("texts", F.lit(0)).cast("long").alias("texts"))


#: Sets with more phrases are compared, not counted by their subsets (which are 2 to the power of this at most).
MOST_SUBSETS = 5


def sharing(own: DataFrame, key: str, phrase: str, out: str) -> DataFrame:
    """key, out: how many keys share a phrase with each key, itself included. own: phrase and key, each pair once.

    Keys with equal sets of phrases are one class with a number, so pairs of keys are never made. How many keys meet a set is the
    sum over its subsets of those that hold the whole subset, those of even size taken off: what a class adds grows with its
    own size alone. Classes with more than MOST_SUBSETS phrases meet the others, and these them, in a join of classes.
    """
    sets = own.groupBy(key).agg(F.array_sort(F.collect_set(phrase)).alias("_set"))
    classes = sets.groupBy("_set").agg(F.count("*").alias("_n"))
    few, many = classes.filter(F.size("_set") <= MOST_SUBSETS), classes.filter(F.size("_set") > MOST_SUBSETS)
    none = F.array().cast("array<array<string>>")
    grown = lambda all, x: F.concat(all, F.array(F.array(x)), F.transform(all, lambda s: F.array_append(s, x)))
    parts = few.select("_set", "_n", F.explode(F.aggregate("_set", none, grown)).alias("_part"))
    held = parts.groupBy("_part").agg(F.sum("_n").alias("_held"))
    signed = F.when(F.size("_part") % 2 == 1, F.col("_held")).otherwise(-F.col("_held"))
    counted = parts.join(held, "_part").groupBy("_set").agg(F.sum(signed).alias("_met"))
    by_phrase = lambda of: of.select("_set", "_n", F.explode("_set").alias("_p"))
    other = lambda of: by_phrase(of).select(F.col("_set").alias("_other"), F.col("_n").alias("_more"), "_p")
    joined = by_phrase(many).join(other(classes), "_p").unionByName(by_phrase(few).join(other(many), "_p"))
    compared = joined.select("_set", "_other", "_more").distinct().groupBy("_set").agg(F.sum("_more").alias("_met"))
    met = counted.unionByName(compared).groupBy("_set").agg(F.sum("_met").alias(out))
    return sets.join(met, "_set").select(key, out)
