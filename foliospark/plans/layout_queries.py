"""Queries of geometry, noise filters, reading order, captions and flags over pages and their elements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import spatial
from .base import BLOCKS, BOXES, PAGES, WS, blocks, boxes, pages

KEYS = ["file", "page"]


def sized(spark: SparkSession, folder: str) -> DataFrame:
    p = pages(spark, folder).select(*KEYS, F.col("page_width").cast("double").alias("w"), F.col("page_height").cast("double").alias("h"), "sr_scale_factor")
    return blocks(spark, folder).join(p, KEYS)


SIZED = f"(SELECT b.*, cast(p.page_width AS double) AS w, cast(p.page_height AS double) AS h, p.sr_scale_factor FROM {BLOCKS} b JOIN {PAGES} p USING (file, page))"


def geometry_scalars(spark: SparkSession, folder: str) -> DataFrame:
    b, w, h = G.Box.of(), F.col("w"), F.col("h")
    clipped, grown, orig = G.clip(b, w, h), G.expand(b, 5.0), G.unscale(b, F.col("sr_scale_factor"))
    return sized(spark, folder).filter("x1 is not null").select(
        "elem_id", b.cx.alias("cx"), b.cy.alias("cy"), *clipped.columns("clip_"), *grown.columns("grown_"), *[F.round(c, 4).alias(f"orig_{n}") for c, n in zip((orig.x1, orig.y1, orig.x2, orig.y2), ("x1", "y1", "x2", "y2"))],
        G.segmentation_mode(b).alias("psm"), G.has_area(clipped).alias("kept"), G.plausible_figure(b, w, h).alias("plausible_figure"), G.likely_false_figure(b, w, h).alias("false_figure"),
    )


def page_line_parameters(spark: SparkSession, folder: str) -> DataFrame:
    w, h = F.col("page_width"), F.col("page_height")
    return pages(spark, folder).select(*KEYS, *G.line_parameters(w, h), F.round(G.scale_factor(w * 2, h * 2, w, h), 4).alias("scale"))


def polygon_boxes(spark: SparkSession, folder: str) -> DataFrame:
    """Corners of every box as a polygon, and its envelope."""
    pt = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    rows = blocks(spark, folder).filter("x1 is not null").withColumn("points", F.array(pt("x2", "y1"), pt("x1", "y1"), pt("x2", "y2"), pt("x1", "y2")))
    return rows.select("elem_id", *G.polygon_box(F.col("points")).columns())


def iou_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of boxes of a page that overlap, with their overlap over union and whether one holds the other."""
    rows = boxes(spark, folder)
    a, b = G.Box.of("a_"), G.Box.of("b_")
    pairs = spatial.near_pairs(rows, rows, KEYS).filter("a_box_idx < b_box_idx").withColumn("iou", G.iou(a, b)).filter("iou > 0")
    return pairs.select(*KEYS, F.col("a_box_idx").alias("a"), F.col("b_box_idx").alias("b"), F.round("iou", 6).alias("iou"), G.contains(a, b).alias("a_holds_b"), G.contains(b, a, 10.0).alias("b_holds_a"), G.overlaps(a, b, 0.5).alias("half"))


def envelope(spark: SparkSession, folder: str) -> DataFrame:
    return boxes(spark, folder).groupBy(*KEYS, "class").agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"), F.count("*").alias("n"))


def noise_filter(spark: SparkSession, folder: str) -> DataFrame:
    b = G.Box.of()
    args = (b, F.col("content"), F.col("ocr_conf"), F.col("w"), F.col("h"))
    return sized(spark, folder).select("elem_id", G.noise_artifact(*args).alias("noise"), G.noise_artifact(*args, empty_is_noise=True).alias("viewer_noise"), F.coalesce((b.width >= 10) & (b.height >= 5), F.lit(False)).alias("large_enough"))


def clean_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks left by the noise and size filters, counted by page."""
    rows = sized(spark, folder).filter(~G.noise_artifact(G.Box.of(), F.col("content"), F.col("ocr_conf"), F.col("w"), F.col("h"))).filter("x2 - x1 >= 10 and y2 - y1 >= 5")
    return rows.groupBy(*KEYS).agg(F.count("*").alias("n_blocks"), F.sum(F.length("content")).alias("n_chars"))


def reading_order(spark: SparkSession, folder: str) -> DataFrame:
    """Position of every block on its page by bands of 80 pixels, then across."""
    b = G.Box.of()
    rows = blocks(spark, folder).filter("x1 is not null").withColumn("band", F.floor(b.cy / 80).cast("int"))
    w = Window.partitionBy(*KEYS).orderBy("band", b.cx, "block_idx", "elem_id")
    by_line = Window.partitionBy(*KEYS).orderBy("y1", "x1", "block_idx", "elem_id")
    return rows.select(*KEYS, "elem_id", "band", (F.row_number().over(w) - 1).alias("reading_pos"), (F.row_number().over(by_line) - 1).alias("line_pos"), F.concat(F.lit("textblock_"), F.row_number().over(Window.partitionBy(*KEYS).orderBy("block_idx", "elem_id")).cast("string")).alias("block_name"))


def quality_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Flags of every page: many blocks of low confidence, a noisy image. The ratio is shown half to even."""
    b = blocks(spark, folder).filter("elem_type = 'TextBlock'").groupBy(*KEYS).agg(F.avg((F.coalesce("ocr_conf", F.lit(100.0)) < 50).cast("double")).alias("low"))
    p = pages(spark, folder).filter("error is null").join(b, KEYS, "left")
    low = F.coalesce("low", F.lit(0.0))
    flag = lambda kind, severity, message, ratio: F.struct(F.lit(kind).alias("type"), F.lit(severity).alias("severity"), message.alias("message"), ratio.alias("ratio"))
    flags = F.array(
        F.when(low > 0.3, flag("LOW_OCR_CONFIDENCE", "warning", F.concat(F.bround(low * 100).cast("int").cast("string"), F.lit("% of blocks have low confidence")), F.round(low, 4))),
        F.when(F.col("laplacian_variance") > 1500, flag("NOISY_IMAGE", "info", F.lit("the image is noisy"), F.lit(None).cast("double"))),
    )
    return p.select(*KEYS, F.explode(F.filter(flags, lambda x: x.isNotNull())).alias("f")).select(*KEYS, "f.*")


def caption_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """Each figure with its caption and the figures left by the rule on text inside them."""
    b = blocks(spark, folder)
    figures = b.filter("elem_type = 'Figure' and x1 is not null").select("elem_id", *KEYS, "x1", "y1", "x2", "y2")
    texts = b.filter("elem_type = 'TextBlock' and x1 is not null").select("elem_id", *KEYS, "block_idx", "content", "x1", "y1", "x2", "y2")
    named = spatial.captions(figures, texts, KEYS, "elem_id", "elem_id")
    return named.select("elem_id", "caption", "caption_id")


def figure_text_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """For each figure or table box: texts more than half inside, the share of it they cover, and whether it is refused."""
    rows = boxes(spark, folder)
    a, b = G.Box.of("a_"), G.Box.of("b_")
    pairs = spatial.near_pairs(rows.filter("class = 'R'"), rows.filter("class != 'R'"), KEYS)
    inside = (b.area > 0) & (G.overlap_area(a, b) / b.area > 0.5)
    sums = pairs.groupBy(*KEYS, F.col("a_box_idx").alias("box_idx")).agg(F.sum(inside.cast("int")).alias("n_inside"), F.round(F.sum(F.when(inside, b.area).otherwise(0.0)) / F.first(a.area), 6).alias("cover"))
    return rows.filter("class = 'R'").join(sums, [*KEYS, "box_idx"], "left").select(*KEYS, "box_idx", F.coalesce("n_inside", F.lit(0)).alias("n_inside"), F.coalesce("cover", F.lit(0.0)).alias("cover")).withColumn("refused", (F.col("n_inside") > 5) | ((F.col("cover") > 0.15) & (F.col("n_inside") > 3)))


def viewer_annotations(spark: SparkSession, folder: str, low: float = 40.0, most_labels: int = 30) -> DataFrame:
    """What a viewer would draw: boxes with colour and short label, at most 30 labels a page, no noise."""
    b = G.Box.of()
    rows = sized(spark, folder).filter("x1 is not null").filter(~G.noise_artifact(b, F.col("content"), F.col("ocr_conf"), F.col("w"), F.col("h"), empty_is_noise=True) | (F.col("elem_type") != "TextBlock"))
    rows = rows.filter(~((F.col("elem_type") == "Figure") & G.likely_false_figure(b, F.col("w"), F.col("h"))))
    label = F.when(F.col("elem_type") == "TextBlock", "T").when(F.col("elem_type") == "Table", "Tbl").when(F.col("elem_type") == "Figure", "Fig").otherwise(F.substring("elem_type", 1, 3))
    color = F.when(F.col("elem_type") == "Table", "green").when(F.col("elem_type") == "Figure", "blue").when(F.coalesce("ocr_conf", F.lit(50.0)) < low, "red").otherwise("gray")
    pos = F.row_number().over(Window.partitionBy(*KEYS).orderBy("block_idx", "elem_id"))
    return rows.select(*KEYS, "elem_id", "x1", "y1", "x2", "y2", color.alias("color"), F.when(pos <= most_labels, label).alias("label"))


def viewer_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Counts by status for the run's log: pages, failed pages, elements by type."""
    p = pages(spark, folder).groupBy(F.when(F.col("error").isNull(), "page").otherwise("failed page").alias("what")).agg(F.count("*").alias("n"))
    return p.unionByName(blocks(spark, folder).groupBy(F.col("elem_type").alias("what")).agg(F.count("*").alias("n")))


TEXT = f"regexp_replace(coalesce(content, ''), '^{WS}+|{WS}+$', '', 'g')"
COVER = "((x2 - x1) * (y2 - y1) / (w * h))"
EDGE = "(x1 < w * 0.05 OR x2 > w * (1 - 0.05) OR y1 < h * 0.05 OR y2 > h * (1 - 0.05))"
ASPECT = "(CASE WHEN y2 - y1 > 0 THEN (x2 - x1) / (y2 - y1) ELSE 0.0 END)"
CONF = "coalesce(ocr_conf, 50.0)"
NOISE = f"""(({COVER} < 0.002 AND {EDGE} AND {CONF} < 30) OR length({TEXT}) = 1 OR (length({TEXT}) > 0 AND length(regexp_replace({TEXT}, '[^\\p{{L}}\\p{{N}}]', '', 'g')) / greatest(length({TEXT}), 1) < 0.3)
  OR ({EDGE} AND (({ASPECT} > 20 AND y2 - y1 < 20) OR ({ASPECT} < 0.05 AND x2 - x1 < 20))) OR (y2 > h * (1 - 0.05) AND {CONF} < 25 AND {COVER} < 0.01) OR (x2 - x1 > w * 0.8 AND y1 > h * 0.95))"""
FALSE_FIGURE = f"coalesce({COVER} > 0.25 OR ({COVER} > 0.15 AND (y1 + y2) / 2 > h * 0.4), false)"
INTER = "(greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0) * greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0))"
IOU = f"({INTER} / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - {INTER}))"
SQL = {
    "geometry_scalars": f"""SELECT elem_id, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy, greatest(0.0, least(x1, w)) AS clip_x1, greatest(0.0, least(y1, h)) AS clip_y1, greatest(0.0, least(x2, w)) AS clip_x2, greatest(0.0, least(y2, h)) AS clip_y2,
      x1 - 5 AS grown_x1, y1 - 5 AS grown_y1, x2 + 5 AS grown_x2, y2 + 5 AS grown_y2, round(x1 / coalesce(sr_scale_factor, 1), 4) AS orig_x1, round(y1 / coalesce(sr_scale_factor, 1), 4) AS orig_y1, round(x2 / coalesce(sr_scale_factor, 1), 4) AS orig_x2, round(y2 / coalesce(sr_scale_factor, 1), 4) AS orig_y2,
      CASE WHEN greatest(x2 - x1, 1.0) / greatest(y2 - y1, 1.0) > 5 THEN 7 WHEN greatest(x2 - x1, 1.0) * greatest(y2 - y1, 1.0) < 8000 THEN 13 ELSE 6 END AS psm,
      greatest(0.0, least(x2, w)) > greatest(0.0, least(x1, w)) AND greatest(0.0, least(y2, h)) > greatest(0.0, least(y1, h)) AS kept,
      coalesce(CASE WHEN x1 >= 0 AND y1 >= 0 AND x2 <= w AND y2 <= h AND x2 > x1 AND y2 > y1 THEN {COVER} >= 0.01 AND {COVER} <= 0.40 AND NOT ((y1 + y2) / 2 > h * 0.6 AND {COVER} > 0.20)
        AND (x2 - x1) / (y2 - y1) >= 0.1 AND (y2 - y1) / (x2 - x1) >= 0.1 AND NOT (x2 - x1 > w * 0.9 AND y2 - y1 < h * 0.15) END, false) AS plausible_figure, {FALSE_FIGURE} AS false_figure
      FROM {SIZED} s WHERE x1 IS NOT NULL""",
    "page_line_parameters": f"SELECT file, page, greatest(40, cast(trunc(least(page_width, page_height) * 0.05) AS int)) AS min_length, greatest(80, cast(trunc(page_width * 0.10) AS int)) AS kernel_width, greatest(5, cast(trunc(least(page_width, page_height) * 0.01) AS int)) AS max_gap, CASE WHEN page_width IS NOT NULL AND page_height IS NOT NULL THEN 2.0 END AS scale FROM {PAGES} p",
    "polygon_boxes": f"SELECT elem_id, least(x1, x2) AS x1, least(y1, y2) AS y1, greatest(x1, x2) AS x2, greatest(y1, y2) AS y2 FROM {BLOCKS} b WHERE x1 IS NOT NULL",
    "iou_pairs": f"""SELECT a.file, a.page, a.box_idx AS a, b.box_idx AS b, round({IOU}, 6) AS iou, b.x1 >= a.x1 AND b.y1 >= a.y1 AND b.x2 <= a.x2 AND b.y2 <= a.y2 AS a_holds_b, a.x1 >= b.x1 - 10 AND a.y1 >= b.y1 - 10 AND a.x2 <= b.x2 + 10 AND a.y2 <= b.y2 + 10 AS b_holds_a, {IOU} > 0.5 AS half
      FROM {BOXES} a JOIN {BOXES} b ON a.file = b.file AND a.page = b.page AND a.box_idx < b.box_idx WHERE {INTER} > 0""",
    "envelope": f"SELECT file, page, class, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2, count(*) AS n FROM {BOXES} b GROUP BY ALL",
    "noise_filter": f"SELECT elem_id, coalesce(x1 IS NOT NULL AND {NOISE}, false) AS noise, coalesce(x1 IS NOT NULL AND ({NOISE} OR length({TEXT}) = 0), false) AS viewer_noise, coalesce(x2 - x1 >= 10 AND y2 - y1 >= 5, false) AS large_enough FROM {SIZED} s",
    "clean_blocks": f"SELECT file, page, count(*) AS n_blocks, cast(sum(length(content)) AS bigint) AS n_chars FROM {SIZED} s WHERE NOT coalesce(x1 IS NOT NULL AND {NOISE}, false) AND x2 - x1 >= 10 AND y2 - y1 >= 5 GROUP BY ALL",
    "reading_order": f"""SELECT file, page, elem_id, cast(floor((y1 + y2) / 2 / 80) AS int) AS band, row_number() OVER (PARTITION BY file, page ORDER BY floor((y1 + y2) / 2 / 80), (x1 + x2) / 2, block_idx, elem_id) - 1 AS reading_pos,
      row_number() OVER (PARTITION BY file, page ORDER BY y1, x1, block_idx, elem_id) - 1 AS line_pos, 'textblock_' || row_number() OVER (PARTITION BY file, page ORDER BY block_idx, elem_id) AS block_name FROM {BLOCKS} b WHERE x1 IS NOT NULL""",
    "quality_flags": f"""WITH z AS (SELECT p.file, p.page, laplacian_variance, coalesce(low, 0.0) AS low FROM {PAGES} p LEFT JOIN (SELECT file, page, avg(CASE WHEN coalesce(ocr_conf, 100.0) < 50 THEN 1.0 ELSE 0.0 END) AS low FROM {BLOCKS} b WHERE elem_type = 'TextBlock' GROUP BY ALL) b USING (file, page) WHERE error IS NULL)
      SELECT file, page, 'LOW_OCR_CONFIDENCE' AS type, 'warning' AS severity, cast(round_even(low * 100, 0) AS int) || '% of blocks have low confidence' AS message, round(low, 4) AS ratio FROM z WHERE low > 0.3
      UNION ALL SELECT file, page, 'NOISY_IMAGE', 'info', 'the image is noisy', NULL FROM z WHERE laplacian_variance > 1500""",
    "caption_nearest": f"""WITH f AS (SELECT * FROM {BLOCKS} b WHERE elem_type = 'Figure' AND x1 IS NOT NULL), t AS (SELECT * FROM {BLOCKS} b WHERE elem_type = 'TextBlock' AND x1 IS NOT NULL),
      c AS (SELECT f.elem_id, t.elem_id AS caption_id, t.content, CASE WHEN t.y1 >= f.y2 AND t.y1 - f.y2 < 140 THEN 0 WHEN t.y2 <= f.y1 AND f.y1 - t.y2 < 140 THEN 1 END AS side, CASE WHEN t.y1 >= f.y2 THEN t.y1 - f.y2 ELSE f.y1 - t.y2 END AS gap
        FROM f JOIN t ON f.file = t.file AND f.page = t.page AND least(f.x2, t.x2) - greatest(f.x1, t.x1) > 20)
      SELECT f.elem_id, coalesce(c.content, '') AS caption, c.caption_id FROM f LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY elem_id ORDER BY side, gap, caption_id) AS rn FROM c WHERE side IS NOT NULL) c ON f.elem_id = c.elem_id AND rn = 1""",
    "figure_text_overlap": f"""WITH bx AS (SELECT * FROM {BOXES} z), s AS (SELECT a.file, a.page, a.box_idx, sum(CASE WHEN b.box_idx IS NOT NULL AND {INTER} / ((b.x2 - b.x1) * (b.y2 - b.y1)) > 0.5 THEN 1 ELSE 0 END) AS n_inside,
        sum(CASE WHEN b.box_idx IS NOT NULL AND {INTER} / ((b.x2 - b.x1) * (b.y2 - b.y1)) > 0.5 THEN (b.x2 - b.x1) * (b.y2 - b.y1) ELSE 0 END) / any_value((a.x2 - a.x1) * (a.y2 - a.y1)) AS cover
        FROM bx a LEFT JOIN bx b ON a.file = b.file AND a.page = b.page AND b.class <> 'R' WHERE a.class = 'R' GROUP BY ALL)
      SELECT file, page, box_idx, cast(n_inside AS bigint) AS n_inside, round(cover, 6) AS cover, n_inside > 5 OR (round(cover, 6) > 0.15 AND n_inside > 3) AS refused FROM s""",
    "viewer_annotations": f"""SELECT file, page, elem_id, x1, y1, x2, y2, CASE WHEN elem_type = 'Table' THEN 'green' WHEN elem_type = 'Figure' THEN 'blue' WHEN {CONF} < 40 THEN 'red' ELSE 'gray' END AS color,
      CASE WHEN row_number() OVER (PARTITION BY file, page ORDER BY block_idx, elem_id) <= 30 THEN CASE elem_type WHEN 'TextBlock' THEN 'T' WHEN 'Table' THEN 'Tbl' WHEN 'Figure' THEN 'Fig' ELSE elem_type[1:3] END END AS label
      FROM {SIZED} s WHERE x1 IS NOT NULL AND (NOT coalesce({NOISE} OR length({TEXT}) = 0, false) OR elem_type <> 'TextBlock') AND NOT (elem_type = 'Figure' AND {FALSE_FIGURE})""",
    "viewer_fields": f"SELECT CASE WHEN error IS NULL THEN 'page' ELSE 'failed page' END AS what, count(*) AS n FROM {PAGES} p GROUP BY ALL UNION ALL SELECT elem_type, count(*) FROM {BLOCKS} b GROUP BY ALL",
}
QUERIES = {f.__name__: f for f in (geometry_scalars, page_line_parameters, polygon_boxes, iou_pairs, envelope, noise_filter, clean_blocks, reading_order, quality_flags, caption_nearest, figure_text_overlap, viewer_annotations, viewer_fields)}
