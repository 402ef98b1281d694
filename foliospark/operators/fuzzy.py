"""Correction of words by a dictionary.

Distinct words are joined with the terms through their deletes: forms with up to two letters left out, which two words
within two edits share. The join is an equi-join whichever side is larger; the edit distance is computed for what it
finds only. The dictionary is broadcast by Spark where its size allows.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import lower

#: Patterns of codes, dates, numbers, addresses and amounts (fixed values); a mail sign counts at the start only.
CODES = (
    r"[0-9]{2,}$", r"[A-Z]{2,}[0-9]+$", r"[0-9]+[A-Z]{2,}$", r"[A-Z0-9]{2,}-[A-Z0-9]{2,}$", r"[0-9]{1,2}[/-][0-9]{1,2}[/-][0-9]{2,4}$", r"\([0-9]{3}\)\s?[0-9]{3}-[0-9]{4}$", r"[0-9]{3}-[0-9]{2}-[0-9]{4}$",
    r"[0-9]{5}(-[0-9]{4})?$", r"[A-Z]{1,2}[0-9]{1,2}[A-Z]?\s?[0-9][A-Z]{2}$", r"@", r"https?://", r"\$[0-9,]+\.?[0-9]*$", r"#[0-9]+$",
)
LEAST_LENGTH, LEAST_SIMILARITY, MOST_EDITS = 4, 0.8, 2


def load_dictionary(default: DataFrame, custom: DataFrame | None = None, extra: tuple[str, ...] = (), fallback: tuple[str, ...] = (), least: int = 1000) -> DataFrame:
    """term: the lower-case terms of at least two letters of a default table, those of a custom one, extra words, and, where
    all that is too few, the fallback words. Distinct; null and blank terms go."""
    spark = default.sparkSession
    clean = lambda df, n: df.select(F.lower(F.trim(F.col(df.columns[0]))).alias("term")).filter(F.length("term") >= n)
    out = clean(default, 2)
    if custom is not None:
        out = out.unionByName(clean(custom, 1))
    if extra:
        out = out.unionByName(spark.createDataFrame([(w,) for w in extra], "term string"))
    out = out.distinct()
    if fallback and out.limit(least).count() < least:
        out = out.unionByName(spark.createDataFrame([(w,) for w in fallback], "term string")).distinct()
    return out


def is_code(w: Column) -> Column:
    """Letters and digits both, or one of the patterns; in any case of letters."""
    mixed = w.rlike(r"\p{L}") & w.rlike(r"\p{N}")
    return mixed | w.rlike("(?i)^(?:" + "|".join(CODES) + ")")


def skipped(w: Column) -> Column:
    """Words that are not looked up: short, codes, capitals up to five letters, and those with other signs than letters,
    apostrophes and hyphens."""
    plain = F.regexp_replace(w, r"['-]", "")
    capitals = (F.upper(w) == w) & (F.lower(w) != w) & (F.length(w) <= 5)
    return (F.length(w) < LEAST_LENGTH) | is_code(w) | capitals | ~plain.rlike(r"^\p{L}+$")


def case_pattern(model: Column, word: Column) -> Column:
    """The word in the case of the model: upper, title, else lower."""
    upper = (F.upper(model) == model) & (F.lower(model) != model)
    title = F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, F.lit(2), F.length(word))))
    like_title = F.substring(model, 1, 1).rlike(r"^\p{Lu}") & (F.lower(F.substring(model, F.lit(2), F.length(model))) == F.substring(model, F.lit(2), F.length(model)))
    return F.when(upper, F.upper(word)).when(like_title, title).otherwise(F.lower(word))


def deletes(w: Column) -> Column:
    """The word, its forms without one letter, and, from eight letters on (shorter ones allow one edit), without two."""
    one = lambda x: F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.length(x))))
    first = one(w)
    two = F.when(F.length(w) >= 8, F.flatten(F.transform(first, one))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(w), first, two))


def similarity(distance: Column, a: Column, b: Column) -> Column:
    return 1 - distance / F.greatest(F.length(a), F.length(b))


def swaps(w: Column) -> Column:
    """The forms of a word with two neighbours swapped."""
    at = F.filter(F.sequence(F.lit(0), F.length(w)), lambda i: (i >= 1) & (i < F.length(w)))
    return F.transform(at, lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.lit(1)), F.substring(w, i, F.lit(1)), F.substring(w, i + 2, F.length(w))))


def edits(a: Column, b: Column) -> Column:
    """Edit distance up to two in which a swap of neighbours is one edit, null beyond. Swaps are tried only where the plain
    distance leaves room for them: from two letters (one swap) to four (two swaps)."""
    plain = F.levenshtein(a, b, 2 * MOST_EDITS)
    once = F.array_min(F.transform(swaps(a), lambda s: F.levenshtein(s, b))) + 1
    twice = F.exists(swaps(a), lambda s: F.exists(swaps(s), lambda t: t == b))
    swapped = F.when(plain.isin(2, 3), F.least(plain, once)).when((plain == 4) & twice, 2)
    return F.when(plain.isin(0, 1), plain).when(swapped <= MOST_EDITS, swapped)


def near_terms(words: DataFrame, terms: DataFrame) -> DataFrame:
    """word, term, distance, similarity of each word (lower case) and term within two edits (a swap of neighbours is one)
    and alike by .8 or more."""
    probe = words.select("word", F.explode(deletes(F.col("word"))).alias("d"))
    index = terms.select("term", F.explode(deletes(F.col("term"))).alias("d"))
    found = probe.join(index, "d").select("word", "term").distinct().withColumn("distance", edits(F.col("word"), F.col("term"))).filter("distance is not null")
    return found.withColumn("similarity", similarity(F.col("distance"), F.col("word"), F.col("term"))).filter(F.col("similarity") >= LEAST_SIMILARITY)


def best_terms(words: DataFrame, terms: DataFrame) -> DataFrame:
    """word, term, distance: the nearest term of each word, the first in letter order on ties."""
    order = Window.partitionBy("word").orderBy("distance", "term")
    return near_terms(words, terms).withColumn("rn", F.row_number().over(order)).filter("rn = 1").select("word", "term", "distance")


def suggestions(words: DataFrame, terms: DataFrame, most: int = 5) -> DataFrame:
    """word, rank, term, score: the best terms of each word; a word without any suggests itself with score 1."""
    order = Window.partitionBy("word").orderBy(F.col("similarity").desc(), "term")
    found = near_terms(words, terms).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most).select("word", "rank", "term", F.col("similarity").alias("score"))
    return found.unionByName(words.join(found, "word", "left_anti").select("word", F.lit(1).alias("rank"), F.col("word").alias("term"), F.lit(1.0).alias("score")))


def ratio_matches(words: DataFrame, terms: DataFrame, least: float = 0.8) -> DataFrame:
    """word, term, ratio by the share of matching letters (2 x common subsequence over both lengths), of terms up to two
    letters longer or shorter; for words of four letters and more without a match by edits. They are joined by length and a
    pair of neighbouring letters: at .8 or more so few letters are left over that one pair at least stands in both."""
    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x: str, y: str) -> float:
            row = [0] * (len(y) + 1)
            for c in x:
                left = 0
                for j, d in enumerate(y, 1):
                    up = row[j]
                    row[j] = left + 1 if c == d else max(up, row[j - 1])
                    left = up
            return 2 * row[-1] / (len(x) + len(y)) if x or y else 1.0

        return pd.Series([one(x, y) for x, y in zip(a, b)])

    grams = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substring(c, i, F.lit(2))))
    probe = words.filter(F.length("word") >= LEAST_LENGTH).select("word", F.explode(grams(F.col("word"))).alias("g"), F.sequence(F.length("word") - 2, F.length("word") + 2).alias("ns")).select("word", "g", F.explode("ns").alias("n"))
    index = terms.filter(F.length("term") >= 2).select("term", F.length("term").alias("n"), F.explode(grams(F.col("term"))).alias("g"))
    pairs = probe.join(index, ["g", "n"]).select("word", "term").distinct().withColumn("ratio", ratio("word", "term")).filter(F.col("ratio") >= least)
    return pairs.withColumn("rn", F.row_number().over(Window.partitionBy("word").orderBy(F.col("ratio").desc(), "term"))).filter("rn = 1").select("word", "term", "ratio")


def corrected(texts: DataFrame, ident: str, text: str, terms: DataFrame) -> DataFrame:
    """ident, corrected, n_changed: texts with each doubtful word replaced by its nearest term in its own case; all between
    the words is kept. Words are looked up once each, however often they stand."""
    parts = texts.select(ident, F.posexplode(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(r"(?U)(\w+|\W+)"), F.lit(1))).alias("pos", "part"))
    doubtful = parts.filter(~skipped(F.col("part"))).select(lower(F.col("part")).alias("word")).distinct().join(terms.select(F.col("term").alias("word")), "word", "left_anti")
    best = best_terms(doubtful, terms)
    fixed = parts.withColumn("word", F.when(~skipped(F.col("part")), lower(F.col("part")))).join(best, "word", "left").withColumn("out", F.when(F.col("term").isNotNull(), case_pattern(F.col("part"), F.col("term"))).otherwise(F.col("part")))
    lists = fixed.groupBy(ident).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "out"))), lambda x: x["out"]), "").alias("corrected"), F.count("term").alias("n_changed"))
    return texts.select(ident).join(lists, ident, "left").select(ident, F.coalesce("corrected", F.lit("")).alias("corrected"), F.coalesce("n_changed", F.lit(0)).alias("n_changed"))


def guarded(before: Column, after: Column) -> Column:
    """A model's correction if its length is in half to one and a half times and it is alike enough, else the text as it
    was. The likeness is that of Ratcliff and Obershelp, in one Arrow pass over rows whose lengths agree."""
    size = F.length(after) / (F.length(before) + 1)
    fits = (size >= 0.5) & (size <= 1.5)

    @F.pandas_udf("double")
    def likeness(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() if x is not None and y is not None else 0.0 for x, y in zip(a, b)])

    return F.when(F.coalesce(fits & (likeness(before, F.when(fits, after)) >= 0.4), F.lit(False)), after).otherwise(before)
