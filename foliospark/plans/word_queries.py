"""Queries of words against the dictionary and of language decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import language as L
from ..functions.text import correct_text, fix_spacing, lower
from ..operators import fuzzy as Z
from ..sources.tables import table
from .base import BLOCKS, NW, PAGES, W_, blocks, pages
from .text_queries import chain, spacing


def tokens(spark: SparkSession, folder: str) -> DataFrame:
    return blocks(spark, folder).select(F.explode(F.regexp_extract_all(F.coalesce("content", F.lit("")), F.lit(r"(?U)(\w+)"), F.lit(1))).alias("token")).distinct()


TOKENS = f"(SELECT DISTINCT unnest(regexp_extract_all(coalesce(content, ''), '{W_}+')) AS token FROM {BLOCKS} b)"


def terms(spark: SparkSession, folder: str) -> DataFrame:
    return Z.load_dictionary(table(spark, folder, "dictionary", "term"))


TERMS = "(SELECT DISTINCT lower(trim(term)) AS term FROM dictionary WHERE length(trim(term)) >= 2)"


def token_codes(spark: SparkSession, folder: str) -> DataFrame:
    t = F.col("token")
    return tokens(spark, folder).select("token", Z.is_code(t).alias("code"), Z.skipped(t).alias("skip"), Z.case_pattern(t, F.lit("wOrd")).alias("cased"))


def dictionary_antijoin(spark: SparkSession, folder: str) -> DataFrame:
    """Words to look up: not skipped, not in the dictionary."""
    words = tokens(spark, folder).filter(~Z.skipped(F.col("token"))).select(lower(F.col("token")).alias("word")).distinct()
    return words.join(terms(spark, folder).withColumnRenamed("term", "word"), "word", "left_anti")


def fuzzy_match(spark: SparkSession, folder: str) -> DataFrame:
    return Z.best_terms(dictionary_antijoin(spark, folder), terms(spark, folder))


def fuzzy_suggestions(spark: SparkSession, folder: str) -> DataFrame:
    return Z.suggestions(dictionary_antijoin(spark, folder), terms(spark, folder)).select("word", "rank", "term", F.round("score", 6).alias("score"))


def fuzzy_ratio(spark: SparkSession, folder: str) -> DataFrame:
    words = dictionary_antijoin(spark, folder)
    return Z.ratio_matches(words.join(Z.best_terms(words, terms(spark, folder)), "word", "left_anti"), terms(spark, folder))


def fuzzy_correct(spark: SparkSession, folder: str) -> DataFrame:
    return Z.corrected(blocks(spark, folder).select("elem_id", "content"), "elem_id", "content", terms(spark, folder))


def guarded_corrections(spark: SparkSession, folder: str) -> DataFrame:
    """The chain's correction of each element where it passes the guardrails."""
    c = F.col("content")
    return blocks(spark, folder).filter("content is not null").select("elem_id", Z.guarded(c, correct_text(c, aggressive=True)).alias("text"))


def language_postprocess(spark: SparkSession, folder: str) -> DataFrame:
    """Texts of pages in languages with a word list get the whole chain, others only their spacing."""
    lang = L.tesseract_code(F.col("language"))
    rows = blocks(spark, folder).filter("content is not null").join(pages(spark, folder).select("file", "page", "language"), ["file", "page"])
    return rows.select("elem_id", F.when(lang.isin(*L.POSTPROCESSED), correct_text(F.col("content"))).otherwise(fix_spacing(F.col("content"))).alias("text"))


def language_english_ratio(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col("content")
    return blocks(spark, folder).select("elem_id", L.english_indicators(c).alias("indicators"), L.english_words(c)["hits"].alias("hits"), L.english_words(c)["total"].alias("total"))


def page_texts(spark: SparkSession, folder: str) -> DataFrame:
    text = blocks(spark, folder).filter("content is not null").groupBy("file", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_idx", "elem_id", "content"))), lambda x: x["content"]), "\n").alias("text"))
    return pages(spark, folder).select("file", "page", "language", "language_confidence").join(text, ["file", "page"], "left")


def language_decision(spark: SparkSession, folder: str) -> DataFrame:
    """Language of each page from its text and a detector's answer (here the label the page came with)."""
    d = L.decision(F.col("text"), F.lower(F.substring("language", 1, 2)), F.col("language_confidence"))
    return page_texts(spark, folder).select("file", "page", d["lang_iso"].alias("lang_iso"), d["lang_tess"].alias("lang_tess"), F.round(d["confidence"], 4).alias("confidence"), d["fallback"].alias("fallback"))


def language_document_window(spark: SparkSession, folder: str) -> DataFrame:
    """The language of a file's first page for all its pages; without one, both packs."""
    return L.carried(language_decision(spark, folder).select("file", "page", "lang_tess"))


CODE = "((regexp_matches(t, '\\p{L}') AND regexp_matches(t, '\\p{N}')) OR regexp_matches(t, '(?i)^(?:" + "|".join(Z.CODES) + ")'))"
SKIP = f"(length(t) < 4 OR {CODE} OR (upper(t) = t AND lower(t) <> t AND length(t) <= 5) OR NOT regexp_matches(regexp_replace(t, '[''-]', '', 'g'), '^\\p{{L}}+$'))"
LT = "lower(translate(t, 'İ', 'i'))"
#: Letters beyond ASCII as single ASCII signs, for an edit distance that counts bytes.
ONE = lambda c: f"translate({c}, 'àâçéèêëîïôùûüäößáíñóúğışìòæœÿãõ', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ01234')"
WORDS = f"(SELECT DISTINCT {LT} AS word FROM (SELECT token AS t FROM {TOKENS} k) z WHERE NOT {SKIP} AND {LT} NOT IN (SELECT term FROM {TERMS} d))"
LEV = f"damerau_levenshtein({ONE('word')}, {ONE('term')})"
NEAR = f"(SELECT word, term, {LEV} AS distance, 1 - {LEV} / greatest(length(word), length(term)) AS sim FROM {WORDS} w JOIN {TERMS} d ON abs(length(word) - length(term)) <= 2 AND {LEV} <= 2 WHERE 1 - {LEV} / greatest(length(word), length(term)) >= 0.8)"
BEST = f"(SELECT word, term, distance FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY distance, term) AS rn FROM {NEAR} n) z WHERE rn = 1)"
CASED = lambda t, w: f"CASE WHEN upper({t}) = {t} AND lower({t}) <> {t} THEN upper({w}) WHEN regexp_matches({t}[1:1], '\\p{{Lu}}') AND lower({t}[2:]) = {t}[2:] THEN upper({w}[1:1]) || lower({w}[2:]) ELSE lower({w}) END"
LANG = "CASE lower(language[1:2]) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in L.TESSERACT.items()) + " ELSE 'eng' END"
IND = " + ".join(f"CASE WHEN regexp_matches(lower(translate(coalesce(text, ''), 'İ', 'i')), '{p}') THEN 1 ELSE 0 END" for p in L.SQL_INDICATORS)
ALL = f"list_filter(string_split_regex(lower(translate(coalesce(text, ''), 'İ', 'i')), '{NW}+'), lambda w: regexp_full_match(w, '[a-z]{{2,}}'))"
HITS = f"len(list_filter({ALL}, lambda w: w IN ({', '.join(repr(w) for w in L.COMMON)})))"
PAGE_TEXT = f"(SELECT p.file, p.page, language, language_confidence, text FROM {PAGES} p LEFT JOIN (SELECT file, page, string_agg(content, chr(10) ORDER BY block_idx, elem_id, content) AS text FROM {BLOCKS} b WHERE content IS NOT NULL GROUP BY ALL) t USING (file, page))"
DECIDED = f"""(SELECT file, page, CASE WHEN short OR sure THEN 'en' WHEN forced = 'eng' THEN 'en' WHEN total > 5 AND hits / total > 0.25 THEN 'en' ELSE det END AS lang_iso, CASE WHEN short OR sure OR forced = 'eng' OR (total > 5 AND hits / total > 0.25) THEN 'eng' ELSE forced END AS lang_tess,
  CASE WHEN short THEN 0.0 WHEN sure THEN 0.95 ELSE coalesce(language_confidence, 0.0) END AS confidence, short OR (NOT sure AND (det IS NULL OR forced <> CASE WHEN total > 5 AND hits / total > 0.25 THEN 'eng' ELSE forced END)) AS fallback
  FROM (SELECT *, length(coalesce(trim(text), '')) < 30 AS short, {IND} >= 2 AND total > 0 AND hits / greatest(total, 1) >= 0.15 AS sure, CASE WHEN det = 'tr' THEN 'tur' ELSE 'eng' END AS forced
  FROM (SELECT *, lower(language[1:2]) AS det, {HITS} AS hits, len({ALL}) AS total FROM {PAGE_TEXT} x) y) z)"""
SQL = {
    "token_codes": f"SELECT t AS token, {CODE} AS code, {SKIP} AS skip, {CASED('t', chr(39) + 'wOrd' + chr(39))} AS cased FROM (SELECT token AS t FROM {TOKENS} k) z",
    "dictionary_antijoin": f"SELECT word FROM {WORDS} w",
    "fuzzy_match": f"SELECT word, term, distance::int AS distance FROM {BEST} b",
    "fuzzy_suggestions": f"""SELECT word, rank::int AS rank, term, round(sim, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY sim DESC, term) AS rank FROM {NEAR} n) z WHERE rank <= 5
      UNION ALL SELECT word, 1, word, 1.0 FROM {WORDS} w WHERE word NOT IN (SELECT word FROM {NEAR} n)""",
    "fuzzy_correct": f"""WITH p AS (SELECT elem_id, unnest(x) AS t, generate_subscripts(x, 1) AS pos FROM (SELECT elem_id, regexp_extract_all(coalesce(content, ''), '{W_}+|{NW}+') AS x FROM {BLOCKS} b) y), best AS (SELECT * FROM {BEST} n)
      SELECT b.elem_id, coalesce(corrected, '') AS corrected, coalesce(n, 0) AS n_changed FROM {BLOCKS} b LEFT JOIN (SELECT elem_id, string_agg(CASE WHEN term IS NOT NULL THEN {CASED('t', 'term')} ELSE t END, '' ORDER BY pos) AS corrected, count(term) AS n
      FROM (SELECT p.*, best.term FROM p LEFT JOIN best ON NOT {SKIP} AND lower(translate(p.t, 'İ', 'i')) = best.word) z GROUP BY elem_id) c USING (elem_id)""",
    "language_postprocess": f"SELECT elem_id, CASE WHEN {LANG} IN ({', '.join(repr(x) for x in L.POSTPROCESSED)}) THEN {chain('content')} ELSE {spacing('content')} END AS text FROM {BLOCKS} b JOIN {PAGES} p USING (file, page) WHERE content IS NOT NULL",
    "language_english_ratio": f"SELECT elem_id, {IND} AS indicators, {HITS} AS hits, len({ALL}) AS total FROM (SELECT elem_id, content AS text FROM {BLOCKS} b) z",
    "language_decision": f"SELECT file, page, lang_iso, lang_tess, round(confidence, 4) AS confidence, fallback FROM {DECIDED} d",
    "language_document_window": f"SELECT file, page, coalesce(first_value(lang_tess) OVER (PARTITION BY file ORDER BY page), 'eng+tur') AS lang_tess FROM {DECIDED} d",
}
QUERIES = {f.__name__: f for f in (token_codes, dictionary_antijoin, fuzzy_match, fuzzy_suggestions, fuzzy_ratio, fuzzy_correct, guarded_corrections, language_postprocess, language_english_ratio, language_decision, language_document_window)}
