"""Queries of grouping, boxes and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import cells as C
from ..functions.geometry import Box
from ..functions.text import words as split_words
from ..operators import boxes as B
from ..operators import grouping as G
from ..operators import tables as T
from ..sources.tables import table
from .base import BLOCKS, BOXES, LINES, WS, blocks, boxes, lines
from .layout_queries import SIZED, sized

KEYS = ["file", "page"]
TABLE = ["file", "page", "table_no"]


def words(spark: SparkSession, folder: str) -> DataFrame:
    """Recognised words derived from the elements: eight to a line, with jitter, gaps and confidences."""
    b = blocks(spark, folder).filter("elem_type = 'TextBlock' and x1 is not null").select("elem_id", "x1", "y1", F.posexplode(split_words(F.col("content"))).alias("word_idx", "text"))
    i, p = F.col("elem_id"), F.col("word_idx")
    return b.select(
        "elem_id", "word_idx", (F.col("x1").cast("int") + (p % 8) * 120 + F.when(p % 8 == 5, 90).otherwise(0)).cast("int").alias("left"), (F.col("y1").cast("int") + F.floor(p / 8) * 24 + (i + p) % 3).cast("int").alias("top"), (F.length("text") * 12).cast("int").alias("width"), F.lit(20).alias("height"),
        ((i * 7 + p * 13) % 101).cast("double").alias("conf"), "text",
    )


WORDS = f"""(SELECT elem_id, p AS word_idx, cast(trunc(x1) AS int) + (p % 8) * 120 + CASE WHEN p % 8 = 5 THEN 90 ELSE 0 END AS left_, cast(trunc(y1) AS int) + (p // 8) * 24 + (elem_id + p) % 3 AS top_, length(t) * 12 AS width_, 20 AS height_, cast((elem_id * 7 + p * 13) % 101 AS double) AS conf, t AS text
  FROM (SELECT elem_id, x1, y1, unnest(w) AS t, generate_subscripts(w, 1) - 1 AS p FROM (SELECT elem_id, x1, y1, list_filter(string_split_regex(coalesce(content, ''), '{WS}+'), lambda x: x <> '') AS w FROM {BLOCKS} b WHERE elem_type = 'TextBlock' AND x1 IS NOT NULL) y) z)"""


def word_blocks(spark: SparkSession, folder: str) -> DataFrame:
    b = G.word_blocks(words(spark, folder), ["elem_id"])
    return b.select("elem_id", "grp", "x1", "y1", "x2", "y2", "content", F.round("conf", 4).alias("conf"))


def word_confidence(spark: SparkSession, folder: str) -> DataFrame:
    """Text and mean confidence of the words that an engine did not refuse."""
    w = words(spark, folder).withColumn("conf", F.when(F.col("conf") < 5, -1.0).otherwise(F.col("conf"))).filter("text is not null and conf != -1")
    lists = F.array_sort(F.collect_list(F.struct("word_idx", "text")))
    return w.groupBy("elem_id").agg(F.array_join(F.transform(lists, lambda x: x["text"]), " ").alias("text"), F.round(F.avg("conf"), 4).alias("conf"), F.count("*").alias("n"))


def gap_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return G.cluster_centres(boxes(spark, folder), KEYS, (F.col("x1") + F.col("x2")) / 2, 40.0).select(*KEYS, "grp", F.round("centre", 4).alias("centre"), "n")


def line_counts(spark: SparkSession, folder: str) -> DataFrame:
    b = Box.of()
    rows = boxes(spark, folder)
    return G.distinct_lines(rows, KEYS, b.cx, 30.0).withColumnRenamed("n_lines", "n_cols").join(G.distinct_lines(rows, KEYS, b.cy, 20.0).withColumnRenamed("n_lines", "n_rows"), KEYS)


def dbscan_1d(spark: SparkSession, folder: str) -> DataFrame:
    b = Box.of()
    return G.dbscan_1d(G.dbscan_1d(boxes(spark, folder), KEYS, b.cx, 30.0, ["box_idx"], "col"), KEYS, b.cy, 25.0, ["box_idx"], "row").select(*KEYS, "box_idx", "col", "row")


def line_merge(spark: SparkSession, folder: str) -> DataFrame:
    return G.merged_lines(lines(spark, folder), KEYS).drop("grp")


def row_groups(spark: SparkSession, folder: str) -> DataFrame:
    return G.row_groups(blocks(spark, folder).filter("x1 is not null").dropDuplicates([*KEYS, "block_idx"]), KEYS).select(*KEYS, "block_idx", "row", "col")


def nms(spark: SparkSession, folder: str) -> DataFrame:
    return B.suppressed(boxes(spark, folder), [*KEYS, "class"], "box_idx", "confidence")


def merge_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    rows = boxes(spark, folder).select(*KEYS, F.col("box_idx").alias("block_idx"), F.col("class").alias("content"), "x1", "y1", "x2", "y2")
    return B.merged_overlaps(rows, KEYS)


def cells(spark: SparkSession, folder: str) -> DataFrame:
    return T.boundary_cells(G.merged_lines(lines(spark, folder), KEYS), KEYS)


def cells_from_lines(spark: SparkSession, folder: str) -> DataFrame:
    return cells(spark, folder)


def ruled_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Pages that pass the gate of ruled tables: two rules each way, four cells, two rows and columns."""
    rules = G.merged_lines(lines(spark, folder), KEYS).groupBy(*KEYS).agg(F.sum((F.col("axis") == "h").cast("int")).alias("n_h"), F.sum((F.col("axis") == "v").cast("int")).alias("n_v"))
    made = cells(spark, folder).groupBy(*KEYS).agg(F.count("*").alias("n_cells"), F.countDistinct("row").alias("n_rows"), F.countDistinct("col").alias("n_cols"))
    return rules.join(made, KEYS).filter("n_h >= 2 and n_v >= 2 and n_cells >= 4 and n_rows >= 2 and n_cols >= 2")


def index_cells(spark: SparkSession, folder: str) -> DataFrame:
    rows = boxes(spark, folder)
    return T.indexed(rows, KEYS, 60.0).select(*KEYS, "box_idx", "row", "col")


def grid_pivot(spark: SparkSession, folder: str) -> DataFrame:
    """Boxes as a grid of texts: for each row the texts of all its columns, '' where there is none, up to the last that the
    row fills."""
    rows = T.indexed(boxes(spark, folder), KEYS, 60.0).withColumn("text", F.concat("class", F.col("box_idx").cast("string")))
    g = T.grid_text(rows, KEYS, "box_idx")
    cells = g.groupBy(*KEYS, "row").agg(F.map_from_entries(F.collect_list(F.struct("col", "text"))).alias("m"), F.max("col").alias("last"))
    texts = F.transform(F.sequence(F.lit(0), F.col("last")), lambda c: F.coalesce(F.element_at("m", c.cast("int")), F.lit("")))
    return cells.select(*KEYS, "row", (F.col("last") + 1).cast("int").alias("n_cols"), F.array_join(texts, " | ").alias("texts"))


def table_validate(spark: SparkSession, folder: str) -> DataFrame:
    grid = cells(spark, folder).withColumn("cell_idx", F.col("row") * 100 + F.col("col"))
    texts = boxes(spark, folder).select(*KEYS, "box_idx", (F.col("x1") / 4 + 100).alias("x1"), (F.col("y1") + 100).alias("y1"), (F.col("x1") / 4 + 150).alias("x2"), (F.col("y1") + 130).alias("y2"))
    pages = texts.select(*KEYS).distinct().withColumn("w", F.lit(2550.0)).withColumn("h", F.lit(3300.0))
    return T.valid_tables(grid, texts, pages, KEYS, "box_idx", "cell_idx")


def row_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of the exported tables; where the second is missing, the first spans both."""
    first = Window.partitionBy(*TABLE, "row_idx").orderBy("row_id")
    r = table(spark, folder, "borderless_rows").withColumn("rn", F.row_number().over(first)).filter("rn = 1")
    cell = lambda i: F.struct(F.lit(i).alias("col"), (F.when(F.col("c1").isNull(), 2).otherwise(1) if i == 0 else F.lit(1)).alias("col_span"), F.col(f"c{i}").alias("text"))
    every = F.filter(F.array(*[cell(i) for i in range(7)]), lambda x: ~((x["col"] == 1) & F.col("c1").isNull()))
    return r.select(*TABLE, F.dense_rank().over(Window.partitionBy(*TABLE).orderBy("row_idx")).alias("k"), F.inline(every)).select(*TABLE, (F.col("k") - 1).alias("row"), "col", F.lit(1).alias("row_span"), "col_span", "text")


def export_markdown(spark: SparkSession, folder: str) -> DataFrame:
    return T.to_markdown(row_cells(spark, folder), TABLE)


def export_html(spark: SparkSession, folder: str) -> DataFrame:
    return T.to_html(row_cells(spark, folder), TABLE)


def export_csv(spark: SparkSession, folder: str) -> DataFrame:
    return T.to_csv(row_cells(spark, folder), TABLE)


def export_csv_flat(spark: SparkSession, folder: str) -> DataFrame:
    return T.to_csv(row_cells(spark, folder), TABLE, flat=True)


def export_references(spark: SparkSession, folder: str) -> DataFrame:
    return T.with_references(row_cells(spark, folder), TABLE)


def merged_cells(spark: SparkSession, folder: str) -> DataFrame:
    rules = G.merged_lines(lines(spark, folder), KEYS)
    axis = lambda a, n: F.array_sort(F.collect_set(F.when(F.col("axis") == a, F.col("p").cast("double")))).alias(n)
    grid = rules.groupBy(*KEYS).agg(axis("h", "ys"), axis("v", "xs"))
    short = lines(spark, folder).withColumn("b", F.when(F.col("axis") == "h", F.col("a") + 350).otherwise(F.col("b")))
    return T.merged_cells(grid, short, KEYS)


def cell_content(spark: SparkSession, folder: str) -> DataFrame:
    """What each cell of the exported tables is: content, a label, a disclaimer."""
    t = F.col("text")
    return row_cells(spark, folder).filter("text is not null").select(*TABLE, "row", "col", C.is_table_content(t).alias("content"), C.is_label_only(t).alias("label"), C.is_disclaimer(t).alias("disclaimer"))


def table_content_score(spark: SparkSession, folder: str) -> DataFrame:
    lists = row_cells(spark, folder).groupBy(*TABLE).agg(F.collect_list(F.coalesce("text", F.lit(""))).alias("t"))
    return lists.select(*TABLE, F.round(C.content_score(F.col("t")), 4).alias("score"))


def borderless_grid(spark: SparkSession, folder: str) -> DataFrame:
    return T.borderless_grids(sized(spark, folder).filter("x1 is not null and elem_type = 'TextBlock'").dropDuplicates([*KEYS, "block_idx"]), KEYS)


def borderless_tables(spark: SparkSession, folder: str) -> DataFrame:
    return T.borderless_tables(sized(spark, folder).filter("x1 is not null and elem_type = 'TextBlock'").dropDuplicates([*KEYS, "block_idx"]), KEYS)


def chained(source: str, part: str, order: str, value: str, test: str) -> str:
    """SQL of gap groups: g counts the rows so far whose gap to the one before meets the test."""
    return f"(SELECT *, cast(sum(CASE WHEN {test} THEN 1 ELSE 0 END) OVER (PARTITION BY {part} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS int) AS g FROM (SELECT *, {value} - lag({value}) OVER (PARTITION BY {part} ORDER BY {order}) AS gap FROM {source}) q)"


CX, CY = "(x1 + x2) / 2", "(y1 + y2) / 2"
MERGED = f"(SELECT file, page, axis, cast(trunc(median(p)) AS int) AS p, min(a) AS a, max(b) AS b, count(*) AS n FROM {chained(LINES + ' l', 'file, page, axis', 'p, a, b', 'p', 'gap > 5')} z GROUP BY file, page, axis, g)"
SPANS = lambda axis: f"(SELECT file, page, lo, hi, rn - 1 AS k FROM (SELECT file, page, lo, lead(lo) OVER w AS hi, row_number() OVER w AS rn FROM (SELECT DISTINCT file, page, cast(p AS double) AS lo FROM {MERGED} m WHERE axis = '{axis}') d WINDOW w AS (PARTITION BY file, page ORDER BY lo)) e WHERE hi - lo >= 14)"
CELLS = f"(SELECT h.file, h.page, h.k AS row, v.k AS col, v.lo AS x1, h.lo AS y1, v.hi AS x2, h.hi AS y2 FROM {SPANS('h')} h JOIN {SPANS('v')} v USING (file, page))"
CENTRES = lambda v: f"(SELECT file, page, list(c ORDER BY c) AS cs FROM (SELECT file, page, g, avg(v) AS c FROM {chained(f'(SELECT file, page, {v} AS v FROM {BOXES} b)', 'file, page', 'v', 'v', 'gap > 60')} z GROUP BY ALL) y GROUP BY ALL)"
NEAREST = lambda cs, v: f"list_position(list_transform({cs}, lambda c: abs(c - {v})), list_min(list_transform({cs}, lambda c: abs(c - {v})))) - 1"
INDEXED = f"(SELECT b.*, {NEAREST('y.cs', '(b.y1 + b.y2) / 2')} AS row, {NEAREST('x.cs', '(b.x1 + b.x2) / 2')} AS col FROM {BOXES} b JOIN {CENTRES(CX)} x USING (file, page) JOIN {CENTRES(CY)} y USING (file, page))"
NLINES = lambda v, gap: f"(SELECT file, page, 1 + coalesce(sum(CASE WHEN v - l > {gap} THEN 1 ELSE 0 END), 0) AS n FROM (SELECT *, lag(v) OVER (PARTITION BY file, page ORDER BY v) AS l FROM (SELECT DISTINCT file, page, {v} AS v FROM {BOXES} b) d) e GROUP BY ALL)"


def dbscan(source: str, ties: str, v: str, eps: int, name: str) -> str:
    g = chained(source, "file, page", f"{v}, {ties}", v, f"gap > {eps}")
    return f"(SELECT * EXCLUDE (g, gap, n_, f_), CASE WHEN f_ IS NULL THEN -1 ELSE dense_rank() OVER (PARTITION BY file, page ORDER BY f_ NULLS LAST) - 1 END AS {name} FROM (SELECT *, CASE WHEN n_ >= 2 THEN min({ties}) OVER (PARTITION BY file, page, g) END AS f_ FROM (SELECT *, count(*) OVER (PARTITION BY file, page, g) AS n_ FROM {g} a) b) c)"


ONE_ROW = "(SELECT *, dense_rank() OVER (PARTITION BY file, page, table_no ORDER BY row_idx) - 1 AS row FROM (SELECT *, row_number() OVER (PARTITION BY file, page, table_no, row_idx ORDER BY row_id) AS rn FROM borderless_rows) z WHERE rn = 1)"
ROW_CELLS = "(" + " UNION ALL ".join(f"SELECT file, page, table_no, row, {i} AS col, {'CASE WHEN c1 IS NULL THEN 2 ELSE 1 END' if i == 0 else '1'} AS col_span, c{i} AS text FROM {ONE_ROW} r{' WHERE c1 IS NOT NULL' if i == 1 else ''}" for i in range(7)) + ")"
QUOTED = "CASE WHEN regexp_matches(coalesce(text, ''), '[\",\\r\\n]') THEN '\"' || replace(coalesce(text, ''), '\"', '\"\"') || '\"' ELSE coalesce(text, '') END"


def export(cell: str, between: str, before: str = "", after: str = "") -> str:
    """Rows of a table as lines: cells (of every place, c1 standing covered where it is missing)."""
    return f"SELECT file, page, table_no, row, '{before}' || string_agg({cell}, '{between}' ORDER BY col) || '{after}' AS line FROM (SELECT *, false AS covered FROM {ROW_CELLS} c UNION ALL SELECT file, page, table_no, row, 1, 1, c0, true FROM {ONE_ROW} r WHERE c1 IS NULL) p GROUP BY ALL"


BAR = "CASE WHEN covered THEN '↑' WHEN col_span > 1 THEN replace(coalesce(text, ''), '|', '\\|') || ' [↔2×↕1]' ELSE replace(coalesce(text, ''), '|', '\\|') END"
TD = "CASE WHEN NOT covered THEN '<td' || CASE WHEN col_span > 1 THEN ' colspan=\"2\"' ELSE '' END || '>' || coalesce(text, '') || '</td>' END"
S = "regexp_replace(coalesce(text, ''), '^%s+|%s+$', '', 'g')" % (WS, WS)
IS_LABEL = f"(coalesce(text, '') = '' OR {S}[-1:] = ':' OR lower({S}) IN ({', '.join(repr(x) for x in C.FORM_LABELS)}))"
IS_DISCLAIMER = f"regexp_matches(lower(coalesce(text, '')), '{'|'.join(C.DISCLAIMERS)}')"
GARBAGE = """(length(w) > 3 AND ((regexp_matches(upper(w), 'II|UU|AA|IUI') AND upper(w) NOT IN ('HAWAII', 'SKIING', 'RADII')) OR (regexp_matches(lower(w), '[^\\P{L}aeiou]{4,}') AND NOT regexp_matches(lower(w), 'str|thr|sch|chr|spr|ngth')) OR (length(w) > 4 AND NOT regexp_matches(lower(w), '[aeiou]'))
  OR (upper(w) = w AND lower(w) <> w AND length(w) > 5 AND (length(regexp_replace(lower(w), '[^aeiou]', '', 'g')) / length(w) < 0.2 OR length(regexp_replace(lower(w), '[^aeiou]', '', 'g')) / length(w) > 0.6))))"""
LETTERS = f"list_filter(list_transform(string_split_regex({S}, '{WS}+'), lambda w: regexp_replace(w, '[^\\p{{L}}]', '', 'g')), lambda w: length(w) >= 2)"
BAD = f"len(list_filter({LETTERS}, lambda w: {GARBAGE}))"
IS_CONTENT = f"""CASE WHEN length({S}) < 2 OR length(regexp_replace({S}, '[^\\p{{L}}\\p{{N}}\\t-\\r \\x{{85}}\\x{{A0}}]', '', 'g')) / greatest(length({S}), 1) < 0.5 THEN false WHEN regexp_matches({S}, '{C.DATA}') THEN true
  WHEN len({LETTERS}) > 0 AND ({BAD} / len({LETTERS}) >= 0.5 OR ({BAD} >= 1 AND len({LETTERS}) <= 3)) THEN false
  ELSE regexp_matches({S}, '[A-Z][a-z]+|(^|[^\\p{{L}}\\p{{M}}\\p{{Nd}}_])[A-Z]{{2,4}}($|[^\\p{{L}}\\p{{M}}\\p{{Nd}}_])|[0-9]') OR len(list_filter({LETTERS}, lambda w: length(w) >= 3 AND regexp_matches(lower(w), '[aeiou]') AND NOT {GARBAGE})) > 0 END"""
SCORE = f"CASE WHEN count(*) = 0 THEN 0.0 WHEN bool_or(said AND disc) THEN 0.1 WHEN count(*) FILTER (said AND lab) > count(*) FILTER (said AND NOT lab AND con) THEN 0.2 ELSE count(*) FILTER (said AND NOT lab AND con) / count(*) END"
JUDGED = lambda src: f"(SELECT *, length({S}) >= 2 AS said, {IS_DISCLAIMER} AS disc, {IS_LABEL} AS lab, {IS_CONTENT} AS con FROM {src} j)"
BODY = f"(SELECT file, page, block_idx, x1, y1, x2, y2, coalesce(content, '') AS text FROM {SIZED} s WHERE x1 IS NOT NULL AND elem_type = 'TextBlock' AND {CY} > h * 0.08 AND {CY} < h * 0.85 AND NOT regexp_matches(lower(coalesce(content, '')), '{'|'.join(C.DISCLAIMERS)}'))"
SQL = {
    "word_blocks": f"""SELECT elem_id, g AS grp, min(left_)::double AS x1, min(top_)::double AS y1, max(left_ + width_)::double AS x2, max(top_ + height_)::double AS y2, string_agg(text, ' ' ORDER BY top_, left_, word_idx) AS content, round(avg(conf), 4) AS conf
      FROM (SELECT *, cast(sum(CASE WHEN dn > 20 OR (abs(dn) < 20 AND ac > 100) THEN 1 ELSE 0 END) OVER (PARTITION BY elem_id ORDER BY top_, left_, word_idx ROWS UNBOUNDED PRECEDING) AS int) AS g
      FROM (SELECT *, top_ - lag(top_) OVER w AS dn, left_ - coalesce(lag(left_ + width_) OVER w, 0) AS ac FROM {WORDS} x WHERE conf > 30 WINDOW w AS (PARTITION BY elem_id ORDER BY top_, left_, word_idx)) y) z GROUP BY elem_id, g""",
    "word_confidence": f"SELECT elem_id, string_agg(text, ' ' ORDER BY word_idx) AS text, round(avg(conf), 4) AS conf, count(*) AS n FROM {WORDS} x WHERE conf >= 5 GROUP BY elem_id",
    "gap_clusters": f"SELECT file, page, g AS grp, round(avg(v), 4) AS centre, count(*) AS n FROM {chained(f'(SELECT file, page, {CX} AS v FROM {BOXES} b)', 'file, page', 'v', 'v', 'gap > 40')} z GROUP BY ALL",
    "line_counts": f"SELECT file, page, x.n::bigint AS n_cols, y.n::bigint AS n_rows FROM {NLINES(CX, 30)} x JOIN {NLINES(CY, 20)} y USING (file, page)",
    "dbscan_1d": f"SELECT file, page, box_idx, col, row FROM {dbscan(dbscan(BOXES + ' b', 'box_idx', CX, 30, 'col') + ' d', 'box_idx', CY, 25, 'row')} e",
    "line_merge": f"SELECT file, page, axis, p, a, b, n FROM {MERGED} m",
    "row_groups": f"""SELECT file, page, block_idx, g AS row, row_number() OVER (PARTITION BY file, page, g ORDER BY x1, block_idx) - 1 AS col
      FROM {chained(f'(SELECT DISTINCT ON (file, page, block_idx) * FROM {BLOCKS} b WHERE x1 IS NOT NULL)', 'file, page', 'y1, x1, block_idx', CY, 'abs(gap) >= 20')} z""",
    "cells_from_lines": f"SELECT * FROM {CELLS} c",
    "ruled_tables": f"""SELECT file, page, n_h::bigint AS n_h, n_v::bigint AS n_v, n_cells, n_rows, n_cols FROM (SELECT file, page, sum(CASE WHEN axis = 'h' THEN 1 ELSE 0 END) AS n_h, sum(CASE WHEN axis = 'v' THEN 1 ELSE 0 END) AS n_v FROM {MERGED} m GROUP BY ALL) r
      JOIN (SELECT file, page, count(*) AS n_cells, count(DISTINCT row) AS n_rows, count(DISTINCT col) AS n_cols FROM {CELLS} c GROUP BY ALL) c USING (file, page) WHERE n_h >= 2 AND n_v >= 2 AND n_cells >= 4 AND n_rows >= 2 AND n_cols >= 2""",
    "index_cells": f"SELECT file, page, box_idx, row, col FROM {INDEXED} i",
    "grid_pivot": f"""WITH g AS (SELECT file, page, row, col, string_agg(class || box_idx, ' | ' ORDER BY box_idx) AS t FROM {INDEXED} i GROUP BY ALL), l AS (SELECT file, page, row, max(col) AS last FROM g GROUP BY ALL),
      c AS (SELECT file, page, row, last, unnest(range(0, last + 1)) AS col FROM l)
      SELECT file, page, row, (last + 1)::int AS n_cols, string_agg(coalesce(t, ''), ' | ' ORDER BY col) AS texts FROM c LEFT JOIN g USING (file, page, row, col) GROUP BY file, page, row, last""",
    "table_validate": f"""WITH c AS (SELECT *, row * 100 + col AS cell_idx FROM {CELLS} z), t AS (SELECT file, page, box_idx, x1 / 4 + 100 AS x1, y1 + 100 AS y1, x1 / 4 + 150 AS x2, y1 + 130 AS y2 FROM {BOXES} b),
      f AS (SELECT file, page, count(DISTINCT cell_idx) AS n FROM (SELECT t.file, t.page, t.box_idx, min(cell_idx) AS cell_idx FROM t JOIN c ON t.file = c.file AND t.page = c.page AND greatest(0, least(t.x2, c.x2) - greatest(t.x1, c.x1)) * greatest(0, least(t.y2, c.y2) - greatest(t.y1, c.y1)) / 1500.0e0 > 0.8 GROUP BY ALL) q GROUP BY ALL),
      k AS (SELECT file, page, 1 + coalesce(sum(CASE WHEN v - l > 30 THEN 1 ELSE 0 END), 0) AS n_cols FROM (SELECT *, lag(v) OVER (PARTITION BY file, page ORDER BY v) AS l FROM (SELECT DISTINCT file, page, (x1 + x2) / 2 AS v FROM c) d) e GROUP BY ALL),
      g AS (SELECT file, page, count(*) AS n_cells, (max(x2) - min(x1)) * (max(y2) - min(y1)) AS area FROM c GROUP BY ALL)
      SELECT file, page, n_cells, n_cols::bigint AS n_cols, round(coalesce(f.n, 0) / n_cells, 4) AS share, n_cells >= 4 AND n_cols >= 2 AND NOT (area / (2550.0 * 3300.0) > 0.65 AND n_cols < 3) AND coalesce(f.n, 0) / n_cells >= 0.2 AS valid FROM g JOIN k USING (file, page) LEFT JOIN f USING (file, page)""",
    "export_markdown": f"SELECT file, page, table_no, string_agg(CASE WHEN row = 0 THEN line || chr(10) || '| --- | --- | --- | --- | --- | --- | --- |' ELSE line END, chr(10) ORDER BY row) AS markdown FROM ({export(BAR, ' | ', '| ', ' |')}) l GROUP BY file, page, table_no",
    "export_html": f"SELECT file, page, table_no, '<table>' || chr(10) || string_agg(line, chr(10) ORDER BY row) || chr(10) || '</table>' AS html FROM ({export(TD, '', '<tr>', '</tr>')}) l GROUP BY file, page, table_no",
    "export_csv": f"SELECT file, page, table_no, string_agg(line, chr(13) || chr(10) ORDER BY row) || chr(13) || chr(10) AS csv FROM ({export(f'CASE WHEN covered THEN {chr(39) * 2} ELSE {QUOTED} END', ',')}) l GROUP BY file, page, table_no",
    "export_csv_flat": f"SELECT file, page, table_no, string_agg(line, chr(13) || chr(10) ORDER BY row) || chr(13) || chr(10) AS csv FROM ({export(QUOTED, ',')}) l GROUP BY file, page, table_no",
    "export_references": f"SELECT file, page, table_no, row, col, coalesce(text, '') AS text FROM {ROW_CELLS} c UNION ALL SELECT file, page, table_no, row, 1, '[→' || row || ',0]' FROM {ONE_ROW} r WHERE c1 IS NULL",
    "cell_content": f"SELECT file, page, table_no, row, col, {IS_CONTENT} AS content, {IS_LABEL} AS label, {IS_DISCLAIMER} AS disclaimer FROM {ROW_CELLS} c WHERE text IS NOT NULL",
    "table_content_score": f"SELECT file, page, table_no, round({SCORE}, 4) AS score FROM {JUDGED(ROW_CELLS)} z GROUP BY file, page, table_no",
    "borderless_grid": f"""SELECT file, page, n_rows, n_cols, round(occ, 4) AS occupancy, round(score, 4) AS score FROM (SELECT file, page, count(*) AS nb, max(row) + 1 AS n_rows, max(col) + 1 AS n_cols, count(DISTINCT (row, col)) FILTER (row >= 0 AND col >= 0) / greatest(1, (max(row) + 1) * (max(col) + 1)) AS occ, any_value(sc) AS score
      FROM {dbscan(dbscan(BODY + ' b', 'block_idx', CX, 30, 'col') + ' d', 'block_idx', CY, 25, 'row')} e LEFT JOIN (SELECT file, page, {SCORE} AS sc FROM (SELECT * FROM {JUDGED(dbscan(dbscan(BODY + ' b', 'block_idx', CX, 30, 'col') + ' d', 'block_idx', CY, 25, 'row'))} k WHERE row >= 0 AND col >= 0) z GROUP BY file, page) s USING (file, page) GROUP BY file, page) f
      WHERE nb >= 4 AND n_rows >= 2 AND n_cols >= 2 AND occ >= 0.4 AND score >= 0.3""",
}
QUERIES = {
    f.__name__: f
    for f in (
        word_blocks, word_confidence, gap_clusters, line_counts, dbscan_1d, line_merge, row_groups, nms, merge_overlaps, cells_from_lines, ruled_tables, index_cells, grid_pivot, table_validate,
        export_markdown, export_html, export_csv, export_csv_flat, export_references, merged_cells, cell_content, table_content_score, borderless_grid, borderless_tables,
    )
}
