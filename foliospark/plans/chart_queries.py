"""Queries of chart data, colours, figure kinds and feature statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import charts as C
from ..functions import stats as S
from ..sources.tables import table
from .base import BLOCKS, BOXES, blocks, boxes

KEYS = ["file", "page"]
W, H = 900.0, 600.0


def charted(spark: SparkSession, folder: str) -> DataFrame:
    return boxes(spark, folder).withColumn("chart_w", F.lit(W)).withColumn("chart_h", F.lit(H))


def bar_values(spark: SparkSession, folder: str) -> DataFrame:
    return C.bars(charted(spark, folder), KEYS, "box_idx").select(*KEYS, "box_idx", "orientation", "relative_value", "pos")


def bar_axis(spark: SparkSession, folder: str) -> DataFrame:
    return C.axis_bounds(C.bars(charted(spark, folder), KEYS, "box_idx"), KEYS, "relative_value").select(*KEYS, "low", "high", F.round("span", 6).alias("span"))


def line_samples(spark: SparkSession, folder: str) -> DataFrame:
    return C.line_samples(charted(spark, folder), KEYS, "box_idx")


def pie_shares(spark: SparkSession, folder: str) -> DataFrame:
    s = boxes(spark, folder).select(*KEYS, F.concat("class", F.col("box_idx").cast("string")).alias("color"), (F.col("confidence") * 10).cast("int").alias("pixels"))
    return C.pie_shares(s, KEYS, "color", "pixels")


def scatter_points(spark: SparkSession, folder: str) -> DataFrame:
    return C.scatter_points(charted(spark, folder), KEYS, "box_idx")


def color_names(spark: SparkSession, folder: str) -> DataFrame:
    li = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    b, g, r = (F.col("l_partkey") * 7 % 256).cast("int"), (F.col("l_suppkey") * 11 % 256).cast("int"), (F.col("l_orderkey") * 13 % 256).cast("int")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", C.color_name(b, g, r).alias("color"))


def figure_kinds(spark: SparkSession, folder: str) -> DataFrame:
    i = F.col("elem_id")
    return blocks(spark, folder).select("elem_id", C.figure_kind(F.col("content")).alias("kind"), C.figure_kind_by_shape(i % 9, i % 7, (i % 50) / 100).alias("by_shape"))


def moments(spark: SparkSession, folder: str) -> DataFrame:
    li = table(spark, folder, "lineitem", "l_returnflag", "l_linestatus", "l_extendedprice")
    cols = S.moments(F.col("l_extendedprice"))
    wide = li.groupBy("l_returnflag", "l_linestatus").agg(*cols)
    return wide.select("l_returnflag", "l_linestatus", F.round("mean", 3).alias("mean"), F.round(F.log10("variance"), 6).alias("log_variance"), F.round("std", 3).alias("std"), F.round("skewness", 5).alias("skewness"), F.round("kurtosis", 5).alias("kurtosis"))


def vector_values(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings", "vec_id", "embedding").select("vec_id", F.posexplode("embedding").alias("pos", "v")).withColumn("v", F.col("v").cast("double"))


def histogram_entropy(spark: SparkSession, folder: str) -> DataFrame:
    h = S.histogram(vector_values(spark, folder), ["vec_id"], F.col("v"), -4.0, 4.0)
    return S.entropy(h, ["vec_id"]).select("vec_id", F.round("entropy", 5).alias("entropy"), "n_peaks")


def profile_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Stretches and peaks of the vectors read as projection profiles."""
    p = vector_values(spark, folder).withColumn("v", F.abs("v"))
    runs = S.profile_runs(p, ["vec_id"], "pos", "v", 0.10, 2, 1).groupBy("vec_id").agg(F.count("*").alias("n_runs"), F.min("start").alias("first"), F.max("end").alias("last"))
    return runs.join(S.peak_spacing(p, ["vec_id"], "pos", "v"), "vec_id").select("vec_id", "n_runs", "first", "last", "n_peaks", F.round("irregularity", 5).alias("irregularity"))


BW, BH = "(x2 - x1)", "(y2 - y1)"
BARS = f"""(SELECT *, row_number() OVER (PARTITION BY file, page ORDER BY CASE WHEN orientation = 'vertical' THEN x1 ELSE y1 END, box_idx) - 1 AS pos, round(CASE WHEN orientation = 'vertical' THEN {BH} / 600.0e0 ELSE {BW} / 900.0e0 END, 4) AS relative_value
  FROM (SELECT *, CASE WHEN sum(CASE WHEN {BH} > {BW} THEN 1 ELSE 0 END) OVER (PARTITION BY file, page) >= sum(CASE WHEN {BW} > {BH} THEN 1 ELSE 0 END) OVER (PARTITION BY file, page) THEN 'vertical' ELSE 'horizontal' END AS orientation FROM {BOXES} b) z
  WHERE CASE WHEN orientation = 'vertical' THEN {BH} > {BW} AND {BH} > 20 ELSE {BW} > {BH} AND {BW} > 20 END AND {BW} * {BH} > 100)"""
P = "(SELECT vec_id, unnest(embedding)::double AS v, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)"
HIST = f"(SELECT vec_id, least(31, cast(floor((v + 4) / 0.25e0) AS int)) AS bin, count(*) AS n FROM {P} p WHERE v >= -4 AND v <= 4 GROUP BY ALL)"
ABS = f"(SELECT vec_id, pos, abs(v) AS v, abs(v) > max(abs(v)) OVER (PARTITION BY vec_id) * 0.10 AS on_ FROM {P} p)"
COLOR = "CASE WHEN r > 200 AND g < 100 AND b < 100 THEN 'red' WHEN r < 100 AND g > 200 AND b < 100 THEN 'green' WHEN r < 100 AND g < 100 AND b > 200 THEN 'blue' WHEN r > 200 AND g > 200 AND b < 100 THEN 'yellow' WHEN r > 200 AND g < 100 AND b > 200 THEN 'magenta' WHEN r < 100 AND g > 200 AND b > 200 THEN 'cyan' WHEN r > 200 AND g > 150 AND b < 100 THEN 'orange' WHEN r > 150 AND g > 150 AND b > 150 THEN 'gray' WHEN r < 50 AND g < 50 AND b < 50 THEN 'black' ELSE 'rgb(' || r || ',' || g || ',' || b || ')' END"
SQL = {
    "bar_values": f"SELECT file, page, box_idx, orientation, relative_value, pos FROM {BARS} b",
    "bar_axis": f"SELECT file, page, min(relative_value) AS low, max(relative_value) AS high, round(max(relative_value) - min(relative_value), 6) AS span FROM {BARS} b GROUP BY ALL",
    "line_samples": f"""SELECT file, page, line_index, k, x, y, round(x / 900.0e0, 4) AS relative_x, round(1 - y / 600.0e0, 4) AS relative_value FROM (SELECT file, page, line_index, k, cast(trunc(x1 + k / 9.0e0 * (x2 - x1)) AS int) AS x, cast(trunc(y1 + k / 9.0e0 * (y2 - y1)) AS int) AS y
      FROM (SELECT *, row_number() OVER (PARTITION BY file, page ORDER BY box_idx) - 1 AS line_index FROM {BOXES} b WHERE abs(degrees(atan2(y2 - y1, x2 - x1))) > 5 AND abs(degrees(atan2(y2 - y1, x2 - x1))) < 85) l, (SELECT unnest(range(10)) AS k) n WHERE line_index < 5) z""",
    "pie_shares": f"""SELECT file, page, color, percentage, round(percentage * 3.6e0, 2) AS angle, pos FROM (SELECT file, page, color, round(pixels / sum(pixels) OVER (PARTITION BY file, page) * 100, 2) AS percentage, row_number() OVER (PARTITION BY file, page ORDER BY pixels DESC, color) - 1 AS pos
      FROM (SELECT file, page, class || box_idx AS color, cast(confidence * 10 AS int) AS pixels FROM {BOXES} b) s WHERE pixels > 100) z""",
    "scatter_points": f"SELECT file, page, box_idx, round((x1 + x2) / 2 / 900.0e0, 4) AS x, round(1 - (y1 + y2) / 2 / 600.0e0, 4) AS y, row_number() OVER (PARTITION BY file, page ORDER BY (x1 + x2) / 2, box_idx) - 1 AS pos FROM {BOXES} b",
    "color_names": f"SELECT l_orderkey, l_linenumber, l_partkey, {COLOR} AS color FROM (SELECT *, l_partkey * 7 % 256 AS b, l_suppkey * 11 % 256 AS g, l_orderkey * 13 % 256 AS r FROM lineitem) z",
    "figure_kinds": "SELECT elem_id, CASE " + " ".join(f"WHEN regexp_matches(lower(coalesce(content, '')), '{'|'.join(k)}') THEN '{n}'" for n, k in C.KINDS.items()) + f" ELSE 'figure' END AS kind, CASE WHEN elem_id % 9 > 3 AND elem_id % 7 > 3 THEN 'chart' WHEN elem_id % 9 > 5 THEN 'table' WHEN (elem_id % 50) / 100 > 0.3 THEN 'photograph' ELSE 'figure' END AS by_shape FROM {BLOCKS} b",
    "moments": """SELECT l_returnflag, l_linestatus, round(m, 3) AS mean, round(log10(v), 6) AS log_variance, round(sqrt(v), 3) AS std, round(avg(pow((x - m) / sqrt(v), 3)), 5) AS skewness, round(avg(pow((x - m) / sqrt(v), 4)) - 3, 5) AS kurtosis
      FROM (SELECT l_returnflag, l_linestatus, l_extendedprice AS x, avg(l_extendedprice) OVER w AS m, var_pop(l_extendedprice) OVER w AS v FROM lineitem WINDOW w AS (PARTITION BY l_returnflag, l_linestatus)) z GROUP BY l_returnflag, l_linestatus, m, v""",
    "histogram_entropy": f"""SELECT vec_id, round(-sum(n / t * log2(n / t)), 5) AS entropy, sum(CASE WHEN n > b AND n > a AND bin > 0 THEN 1 ELSE 0 END)::bigint AS n_peaks FROM (SELECT *, sum(n) OVER (PARTITION BY vec_id) AS t, CASE WHEN lag(bin) OVER w = bin - 1 THEN lag(n) OVER w ELSE 0 END AS b, CASE WHEN lead(bin) OVER w = bin + 1 THEN lead(n) OVER w ELSE 0 END AS a
      FROM {HIST} h WINDOW w AS (PARTITION BY vec_id ORDER BY bin)) z GROUP BY vec_id""",
    "profile_lines": f"""WITH r AS (SELECT vec_id, min(pos) AS a, max(pos) + 1 AS b FROM (SELECT *, sum(CASE WHEN on_ THEN 0 ELSE 1 END) OVER (PARTITION BY vec_id ORDER BY pos) AS g FROM {ABS} p) q WHERE on_ GROUP BY vec_id, g),
      k AS (SELECT vec_id, pos - lag(pos) OVER (PARTITION BY vec_id ORDER BY pos) AS d FROM (SELECT *, v > lag(v) OVER w AND v > lead(v) OVER w AND v >= max(v) OVER (PARTITION BY vec_id) * 0.3 AS pk FROM {ABS} p WINDOW w AS (PARTITION BY vec_id ORDER BY pos)) q WHERE pk)
      SELECT vec_id, n_runs, first, last, coalesce(n_peaks, 0) AS n_peaks, round(coalesce(irr, 0.0), 5) AS irregularity FROM (SELECT vec_id, count(*) AS n_runs, min(greatest(0, a - 1))::int AS first, max(least(64, b + 1))::int AS last FROM r WHERE b - a > 2 OR b > 63 GROUP BY vec_id) x
      LEFT JOIN (SELECT vec_id, count(*) AS n_peaks, CASE WHEN count(d) >= 2 THEN stddev_pop(d) / avg(d) END AS irr FROM k GROUP BY vec_id) y USING (vec_id)""",
}
QUERIES = {f.__name__: f for f in (bar_values, bar_axis, line_samples, pie_shares, scatter_points, color_names, figure_kinds, moments, histogram_entropy, profile_lines)}
