"""Queries of form fields: labels, matching by place, normalization, hybrids, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fields as L
from ..operators import fields as O
from .base import BLOCKS, FIELDS, NW, WS, blocks, fields

KEYS = ["file", "page"]


def field_labels(spark: SparkSession, folder: str) -> DataFrame:
    return blocks(spark, folder).select("elem_id", L.label_key(F.col("content")).alias("key")).filter("key is not null")


def label_value_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return O.candidates(blocks(spark, folder), KEYS).select(*KEYS, "label_idx", "key", "value_idx", F.round("distance", 4).alias("distance"), "direction").distinct()


def fields_by_location(spark: SparkSession, folder: str) -> DataFrame:
    return O.fields_by_location(blocks(spark, folder), KEYS)


def fields_hybrid(spark: SparkSession, folder: str) -> DataFrame:
    """Rule and model fields of form_fields: the rule's value where both have the key of a page."""
    rows = fields(spark, folder).filter("value is not null and value != ''")
    w = Window.partitionBy(*KEYS, "field_key", "extraction_method").orderBy("field_id")
    rows = rows.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select(*KEYS, "field_key", "field_id", "value", "extraction_method")
    return O.hybrid(rows.filter("extraction_method = 'rule_based'"), rows.filter("extraction_method = 'llm'"), [*KEYS, "field_key"])


def normalize_dates(spark: SparkSession, folder: str) -> DataFrame:
    return fields(spark, folder).filter("field_key = 'date'").select("field_id", L.iso_date(F.coalesce("raw_value", "value")).alias("iso"))


def normalize_phones(spark: SparkSession, folder: str) -> DataFrame:
    return fields(spark, folder).filter("field_key in ('fax', 'phone')").select("field_id", L.e164(F.coalesce("raw_value", "value")).alias("number"))


def value_verification(spark: SparkSession, folder: str) -> DataFrame:
    """Whether each field's value stands in the raw value it was read from, and in another field of the page."""
    rows = fields(spark, folder).filter("value is not null and value != ''")
    after = F.lead("value").over(Window.partitionBy(*KEYS).orderBy("field_id"))
    rows = rows.withColumn("other", after)
    return rows.select("field_id", L.value_in_source(F.col("value"), F.coalesce("raw_value", F.lit(""))).alias("in_raw"), L.value_in_source(F.col("value"), F.coalesce("other", F.lit(""))).alias("in_next"))


def key_value_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The lines `key: value` of a page's fields written one under the other, read back."""
    w = Window.partitionBy(*KEYS).orderBy("field_id")
    text = fields(spark, folder).select(*KEYS, "field_id", F.concat(F.initcap("field_key"), F.lit(": "), F.coalesce("value", F.lit(""))).alias("line")).withColumn("n", F.row_number().over(w))
    pages = text.groupBy(*KEYS).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), "\n").alias("t"))
    return pages.select(*KEYS, F.posexplode(L.key_values(F.col("t"))).alias("pos", "kv")).select(*KEYS, "pos", "kv.key", "kv.value")


def page_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """The text that a model is given of each page."""
    rows = blocks(spark, folder).filter("elem_type = 'TextBlock'").withColumn("n", F.row_number().over(Window.partitionBy(*KEYS).orderBy("block_idx", "elem_id"))).filter("n <= 50")
    lists = rows.groupBy(*KEYS).agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "content"))), lambda x: x["content"]).alias("c"))
    return lists.select(*KEYS, L.page_summary(F.col("c")).alias("summary"))


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


LOWC = "lower(translate(content, 'İ', 'i'))"
SQL_LABELS = {"fax": f"fax(?:{WS}*(?:no|number))?", "phone": f"phone(?:{WS}*(?:no|number))?", "date": "(?:date|tarih)", "to": "(?:to|recipient|alıcı)", "from": "(?:from|gönderen)", "subject": "(?:subject|konu)", "pages": f"(?:no\\.?{WS}*of{WS}*pages|pages|sayfa)"}
LABEL = "CASE " + " ".join(f"WHEN regexp_matches({LOWC}, '(?s)^(?:.{{0,8}}{NW})?{p}(?:{NW}|$)') THEN '{k}'" for k, p in SQL_LABELS.items()) + " END"
T = strip("coalesce(raw_value, value, '')")
NUM = "^([0-9]{1,2})([/-])([0-9]{1,2})([/-])([0-9]{4}|[0-9]{2})$"
NAMED = "^([A-Za-z]{3}) +([0-9]{1,2}),? +([0-9]{4})$"
MONTH = f"list_position([{', '.join(repr(m) for m in L.MONTHS)}], lower(regexp_extract(t, '{NAMED}', 1)))"
YEAR = f"regexp_extract(t, '{NUM}', 5)"
MADE = f"""CASE WHEN regexp_matches(t, '{NUM}') AND regexp_extract(t, '{NUM}', 2) = regexp_extract(t, '{NUM}', 4) THEN concat_ws('-', CASE WHEN length({YEAR}) = 4 THEN {YEAR} WHEN try_cast({YEAR} AS int) >= 69 THEN '19' || {YEAR} ELSE '20' || {YEAR} END, lpad(regexp_extract(t, '{NUM}', 1), 2, '0'), lpad(regexp_extract(t, '{NUM}', 3), 2, '0'))
  WHEN regexp_matches(t, '{NAMED}') THEN concat_ws('-', regexp_extract(t, '{NAMED}', 3), lpad(cast({MONTH} AS varchar), 2, '0'), lpad(regexp_extract(t, '{NAMED}', 2), 2, '0')) END"""


def in_source(v: str, s: str) -> str:
    """Dialect of value_in_source over named columns v, s with w, the words of v."""
    return f"""coalesce(CASE WHEN length({v}) < 4 THEN list_contains(list_filter(string_split_regex({s}, '{WS}+'), lambda x: x <> ''), {v})
      ELSE contains({s}, {v}) OR (instr({s}, w[1]) > 0 AND instr({s}[instr({s}, w[1]):], w[-1]) > 0 AND instr({s}, w[1]) + instr({s}[instr({s}, w[1]):], w[-1]) - 1 + length(w[-1]) - instr({s}, w[1]) <= length({v}) + 20) END, false)"""


SQL = {
    "field_labels": f"SELECT elem_id, key FROM (SELECT elem_id, {LABEL} AS key FROM {BLOCKS} b) z WHERE key IS NOT NULL",
    "label_value_candidates": f"""WITH r AS (SELECT file, page, block_idx, x1, y1, x2, y2, {LABEL} AS key FROM {BLOCKS} b WHERE content <> '' AND x1 IS NOT NULL),
      d AS (SELECT l.file, l.page, l.block_idx AS label_idx, l.key, v.block_idx AS value_idx,
        CASE WHEN v.x1 > l.x1 AND v.y1 - (v.y2 - v.y1) * 0.5 < (l.y1 + l.y2) / 2 AND (l.y1 + l.y2) / 2 < v.y2 + (v.y2 - v.y1) * 0.5 AND v.x1 - l.x2 >= 0 AND v.x1 - l.x2 < 350 THEN v.x1 - l.x2 END AS rt,
        CASE WHEN v.y1 > l.y2 AND v.x1 < l.x2 + (l.x2 - l.x1) * 0.3 AND v.x2 > l.x1 - (l.x2 - l.x1) * 0.3 AND v.y1 - l.y2 < 100 THEN v.y1 - l.y2 END AS bl,
        CASE WHEN v.x1 > l.x1 AND v.y1 - l.y2 >= 0 AND v.y1 - l.y2 < 50 AND sqrt(pow(greatest(0, v.x1 - l.x2), 2) + pow(v.y1 - l.y2, 2)) < 200 THEN sqrt(pow(greatest(0, v.x1 - l.x2), 2) + pow(v.y1 - l.y2, 2)) END AS rb
        FROM r l JOIN r v ON l.file = v.file AND l.page = v.page AND l.key IS NOT NULL AND v.key IS NULL)
      SELECT DISTINCT file, page, label_idx, key, value_idx, round(least(rt, bl, rb), 4) AS distance, CASE WHEN rt = least(rt, bl, rb) THEN 'right' WHEN bl = least(rt, bl, rb) THEN 'below' ELSE 'right_below' END AS direction FROM d WHERE least(rt, bl, rb) IS NOT NULL""",
    "fields_hybrid": f"""WITH r AS (SELECT file, page, field_key, field_id, value, extraction_method FROM (SELECT * EXCLUDE (rn), row_number() OVER (PARTITION BY file, page, field_key, extraction_method ORDER BY field_id) AS k FROM {FIELDS} f WHERE value <> '') z WHERE k = 1)
      SELECT * FROM r WHERE extraction_method = 'rule_based' UNION ALL SELECT * FROM r m WHERE extraction_method = 'llm' AND NOT EXISTS (SELECT 1 FROM r WHERE extraction_method = 'rule_based' AND r.file = m.file AND r.page = m.page AND r.field_key = m.field_key)""",
    "normalize_dates": f"SELECT field_id, CASE WHEN try_cast({MADE} AS date) IS NOT NULL THEN {MADE} ELSE t END AS iso FROM (SELECT field_id, {T} AS t FROM {FIELDS} f WHERE field_key = 'date') z",
    "normalize_phones": f"""SELECT field_id, CASE WHEN k = '' THEN t WHEN k[1:1] = '+' THEN k WHEN length(k) = 10 THEN '+1' || k ELSE '+' || k END AS number
      FROM (SELECT field_id, t, regexp_replace(t, '[^0-9+]', '', 'g') AS k FROM (SELECT field_id, coalesce(raw_value, value) AS t FROM {FIELDS} f WHERE field_key IN ('fax', 'phone')) y) z""",
    "value_verification": f"""SELECT field_id, {in_source('v', 'a')} AS in_raw, {in_source('v', 'b')} AS in_next FROM (SELECT *, list_filter(string_split_regex(v, '{WS}+'), lambda x: x <> '') AS w FROM (SELECT field_id, lower({strip('value')}) AS v, lower(coalesce(raw_value, '')) AS a,
      lower(coalesce(lead(value) OVER (PARTITION BY file, page ORDER BY field_id), '')) AS b FROM {FIELDS} f WHERE value <> '') y) z""",
    "key_value_lines": f"""SELECT file, page, pos, key, value FROM (SELECT file, page, field_key AS key, v AS value, row_number() OVER (PARTITION BY file, page ORDER BY field_id) - 1 AS pos
      FROM (SELECT file, page, field_id, field_key, {strip("value")} AS v FROM {FIELDS} f) y WHERE lower(v) NOT IN ({', '.join(repr(x) for x in L.NOTHING)})) z""",
    "page_summaries": f"""SELECT file, page, coalesce(string_agg('[Block ' || (n - 1) || '] ' || content, chr(10) ORDER BY n) FILTER ({strip("coalesce(content, '')")} <> ''), '')[1:3500] AS summary
      FROM (SELECT *, row_number() OVER (PARTITION BY file, page ORDER BY block_idx, elem_id) AS n FROM {BLOCKS} b WHERE elem_type = 'TextBlock') z WHERE n <= 50 GROUP BY file, page""",
}
QUERIES = {f.__name__: f for f in (field_labels, label_value_candidates, fields_by_location, fields_hybrid, normalize_dates, normalize_phones, value_verification, key_value_lines, page_summaries)}
