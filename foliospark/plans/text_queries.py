"""Queries of the text functions over all page elements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .base import BLOCKS, NW, NWS, W_, WS, blocks


def text_normalize(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col("content")
    return blocks(spark, folder).select("elem_id", T.normalize_basic(c).alias("basic"), T.clean_filename(c).alias("file_name"), T.normalize_quotes(c).alias("quotes"))


def text_nfkc(spark: SparkSession, folder: str) -> DataFrame:
    return blocks(spark, folder).select("elem_id", T.normalize_full(F.col("content")).alias("full"))


def text_corrections(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col("content")
    return blocks(spark, folder).filter("content is not null").select("elem_id", T.fix_spacing(c).alias("spacing"), T.substitute_chars(c).alias("chars"), T.remove_artifacts(c).alias("artifacts"), T.fix_numbers(c).alias("numbers"))


def text_word_corrections(spark: SparkSession, folder: str) -> DataFrame:
    return blocks(spark, folder).filter("content is not null").select("elem_id", T.correct_words(F.col("content")).alias("words"))


def text_correction_chain(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col("content")
    out = blocks(spark, folder).filter("content is not null").select("elem_id", "content", T.correct_text(c).alias("corrected"))
    return out.select("elem_id", "corrected", T.correction_stats(c, F.col("corrected")).alias("s")).select("elem_id", "corrected", "s.original_length", "s.corrected_length", "s.words_changed", F.concat_ws(" ", "s.added").alias("added"), F.concat_ws(" ", "s.removed").alias("removed"))


def text_quality_score(spark: SparkSession, folder: str) -> DataFrame:
    c, conf = F.col("content"), F.col("ocr_conf")
    return blocks(spark, folder).select("elem_id", F.round(T.quality_score(c, conf), 3).alias("quality"), T.likely_handwritten(c, conf).alias("handwritten"), T.valid_output(c).alias("valid"))


def text_bigram_similarity(spark: SparkSession, folder: str) -> DataFrame:
    """Each element against the next one of its page."""
    w = Window.partitionBy("file", "page").orderBy("block_idx", "elem_id")
    pairs = blocks(spark, folder).select("elem_id", "content", F.lead("content").over(w).alias("after"), F.lead("elem_id").over(w).alias("next_id")).filter("next_id is not null")
    s = T.similarity(F.col("content"), F.col("after"))
    return pairs.select("elem_id", "next_id", F.round(s, 3).alias("similarity"), (s >= 0.7).alias("similar"))


def document_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Mean text quality, share of doubtful blocks and quality flag of every file."""
    b = blocks(spark, folder).filter("elem_type = 'TextBlock'").withColumn("q", T.quality_score(F.col("content"), F.col("ocr_conf")))
    low = F.avg((F.coalesce("ocr_conf", F.lit(100.0)) < 50).cast("double"))
    return b.groupBy("file").agg(F.count("*").alias("n_blocks"), F.countDistinct("page").alias("n_pages"), F.round(F.avg("q"), 3).alias("mean_quality"), F.round(low, 4).alias("low_share"), F.when(low > 0.3, "LOW_OCR_CONFIDENCE").alias("flag"))


def basic(c: str) -> str:
    return f"regexp_replace(regexp_replace(coalesce({c}, ''), '{WS}+', ' ', 'g'), '^ | $', '', 'g')"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def spacing(c: str) -> str:
    out = f"regexp_replace({c}, ' {{2,}}', ' ', 'g')"
    out = f"regexp_replace({out}, '{WS}+([.,;:!?)])', '\\1', 'g')"
    out = f"regexp_replace({out}, '([.,;:!?])([A-Za-z])', '\\1 \\2', 'g')"
    out = f"regexp_replace({out}, '-{WS}*\\n{WS}*', '', 'g')"
    return strip(f"regexp_replace({out}, '\\n+', ' ', 'g')")


def chars(c: str) -> str:
    for a, b in (("1", "l"), ("0", "o"), ("\\|", "l")):
        c = f"regexp_replace({c}, '({W_}){a}({W_})', '\\1{b}\\2', 'g')"
    return c


def artifacts(c: str) -> str:
    c = f"regexp_replace({c}, '[─│┌┐└┘├┤┬┴┼═-╬]', '', 'g')"
    c = f"regexp_replace({c}, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]', '', 'g')"
    c = f"regexp_replace({c}, '{WS}+[^\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Nl}}\\p{{Pc}}\\t-\\r \\x{{85}}\\x{{A0}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{3000}}]{WS}+', ' ', 'g')"
    for p in ("\\.", ",", ";", ":", "!", "\\?"):
        c = f"regexp_replace({c}, '{p}{{2,}}', '{p[-1]}', 'g')"
    return c


def quotes(c: str) -> str:
    return f"translate({c}, '«»‹›‘’“”', '\"\"''''''''\"\"')"


def numbers(c: str) -> str:
    c = f"regexp_replace({c}, '(\\p{{Nd}}){WS}+(\\p{{Nd}})', '\\1\\2', 'g')"
    c = f"regexp_replace({c}, '([0-9])O([0-9])', '\\10\\2', 'g')"
    return f"regexp_replace({c}, '(\\p{{Nd}})O([,.]|{WS}|$)', '\\10\\2', 'g')"


def split_words(c: str) -> str:
    return f"list_filter(string_split_regex(coalesce({c}, ''), '{WS}+'), lambda w: w <> '')"


def word_corrections(c: str) -> str:
    table = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in T.CORRECTIONS.items()) + "}"
    core = f"regexp_extract(w, '^({NW}*)(.*?)({NW}*)$', 2, 's')"
    right = f"{table}[lower(translate({core}, 'İ', 'i'))]"
    cased = f"CASE WHEN upper({core}) = {core} AND lower({core}) <> {core} THEN upper({right}) WHEN regexp_matches({core}, '^\\p{{Lu}}') THEN upper({right}[1:1]) || {right}[2:] ELSE {right} END"
    around = lambda i: f"regexp_extract(w, '^({NW}*)(.*?)({NW}*)$', {i}, 's')"
    return f"array_to_string(list_transform({split_words(c)}, lambda w: CASE WHEN {right} IS NOT NULL THEN {around(1)} || ({cased}) || {around(3)} ELSE w END), ' ')"


def chain(c: str) -> str:
    return spacing(word_corrections(numbers(spacing(quotes(artifacts(f"coalesce({c}, '')"))))))


def quality(c: str, conf: str) -> str:
    w = split_words(c)
    return f"""CASE WHEN coalesce({strip(c)} = '', true) THEN 0.0 ELSE least(100.0, coalesce({conf}, 0.0) * 0.4
      + (1 - len(list_filter({w}, lambda x: length(x) = 1)) / len({w})) * 20
      + len(list_filter({w}, lambda x: length(x) >= 2 AND regexp_matches(x, '\\p{{L}}'))) / len({w}) * 20
      + CASE WHEN length({c}) > 10 THEN greatest(0.0, 1 - length(regexp_replace({c}, '[\\p{{L}}\\p{{N}} .,;:!?''"-]', '', 'g')) / length({c}) * 5) * 10 ELSE 0 END
      + (length({c}) - length(regexp_replace({c}, '[\\p{{L}}\\p{{N}}]|{WS}', '', 'g'))) / length({c}) * 10) END"""


def handwritten(c: str, conf: str) -> str:
    w = split_words(c)
    return f"""coalesce({strip(c)} <> '' AND (length(replace({c}, ' ', '')) / len({w}) < 2.5 AND coalesce({conf}, 0.0) < 70
      OR len({w}) > 2 AND len(list_filter({w}, lambda x: length(x) = 1)) / len({w}) > 0.35
      OR regexp_matches({c}, '(^|{NW})[li1I]{WS}+[li1I]{WS}+[li1I]($|{NW})')), false)"""


def valid(c: str) -> str:
    t = strip(c)
    loops = " OR ".join(f"({k} < least(6, length(t) // 2) AND (length(t) - length(replace(t, t[1:{k}], ''))) / {k} > length(t) / {k} * 0.6)" for k in range(2, 6))
    return f"""coalesce((SELECT t <> '' AND NOT (length(t) > 5 AND ({loops}))
      AND NOT (length(t) > 3 AND length(regexp_replace(t, '[^\\p{{L}}\\p{{N}}]', '', 'g')) / length(t) < 0.3)
      AND NOT (regexp_matches(t, '^(?:[.,:;!?]+$|[-_=+]+$|[A-Z]{{15,}}$)') OR (length(t) >= 5 AND t[1:5] = repeat(t[1:1], 5) AND t[1:1] <> chr(10))) FROM (SELECT {t} AS t)), false)"""


def grams(t: str) -> str:
    return f"CASE WHEN length({t}) < 2 THEN [] ELSE list_distinct(list_transform(range(1, length({t})), lambda i: {t}[i:i + 1])) END"


def both_grams() -> str:
    plain = lambda c: f"lower(translate(replace(coalesce({c}, ''), ' ', ''), 'İ', 'i'))"
    return f"""SELECT *, len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))) AS share FROM (SELECT elem_id, next_id, a, b, {grams("s")} AS x, {grams("t")} AS y
      FROM (SELECT elem_id, next_id, content AS a, after AS b, {plain("content")} AS s, {plain("after")} AS t
      FROM (SELECT elem_id, content, lead(content) OVER w AS after, lead(elem_id) OVER w AS next_id FROM {BLOCKS} e WINDOW w AS (PARTITION BY file, page ORDER BY block_idx, elem_id)) p WHERE next_id IS NOT NULL) u) v"""


LOW = lambda c: f"lower(translate({c}, 'İ', 'i'))"
SIM = f"CASE WHEN coalesce(a, '') = '' OR coalesce(b, '') = '' THEN 0.0 WHEN len(x) = 0 OR len(y) = 0 THEN CASE WHEN lower(translate({strip('a')}, 'İ', 'i')) = lower(translate({strip('b')}, 'İ', 'i')) THEN 1.0 ELSE 0.0 END ELSE share END"
ADDED = f"list_filter(list_distinct({split_words(LOW('corrected'))}), lambda v: NOT list_contains({split_words(LOW('content'))}, v))"
REMOVED = f"list_filter(list_distinct({split_words(LOW('content'))}), lambda v: NOT list_contains({split_words(LOW('corrected'))}, v))"
SQL = {
    "text_normalize": f"SELECT elem_id, {basic('content')} AS basic, regexp_replace(translate(content, '<>:\"/\\|?*', '_________'), '^[. ]+|[. ]+$', '', 'g') AS file_name, {quotes('content')} AS quotes FROM {BLOCKS} b",
    "text_corrections": f"SELECT elem_id, {spacing('content')} AS spacing, {chars('content')} AS chars, {artifacts('content')} AS artifacts, {numbers('content')} AS numbers FROM {BLOCKS} b WHERE content IS NOT NULL",
    "text_word_corrections": f"SELECT elem_id, {word_corrections('content')} AS words FROM {BLOCKS} b WHERE content IS NOT NULL",
    "text_correction_chain": f"""SELECT elem_id, corrected, length(content) AS original_length, length(corrected) AS corrected_length, len({ADDED}) + len({REMOVED}) AS words_changed,
      array_to_string(list_sort({ADDED})[1:10], ' ') AS added, array_to_string(list_sort({REMOVED})[1:10], ' ') AS removed
      FROM (SELECT elem_id, content, {chain('content')} AS corrected FROM {BLOCKS} b WHERE content IS NOT NULL) c""",
    "text_quality_score": f"SELECT elem_id, round({quality('content', 'ocr_conf')}, 3) AS quality, {handwritten('content', 'ocr_conf')} AS handwritten, {valid('content')} AS valid FROM {BLOCKS} b",
    "text_bigram_similarity": f"SELECT elem_id, next_id, round({SIM}, 3) AS similarity, {SIM} >= 0.7 AS similar FROM ({both_grams()}) g",
    "document_quality": f"""SELECT file, count(*) AS n_blocks, count(DISTINCT page) AS n_pages, round(avg(q), 3) AS mean_quality, round(avg(low), 4) AS low_share, CASE WHEN avg(low) > 0.3 THEN 'LOW_OCR_CONFIDENCE' END AS flag
      FROM (SELECT file, page, {quality('content', 'ocr_conf')} AS q, CASE WHEN coalesce(ocr_conf, 100.0) < 50 THEN 1.0 ELSE 0.0 END AS low FROM {BLOCKS} b WHERE elem_type = 'TextBlock') z GROUP BY file""",
}
QUERIES = {f.__name__: f for f in (document_quality, text_normalize, text_nfkc, text_corrections, text_word_corrections, text_correction_chain, text_quality_score, text_bigram_similarity)}
