"""Tables the queries start from, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import table

#: White space and word characters as the product patterns mean them, for engines whose \s and \w are ASCII only.
WS = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NWS = r"[^\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
W_ = r"[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]"
NW = r"[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]"


def percent(conf):
    """A confidence on the 0 to 100 scale; values up to 1 are on the 0 to 1 scale."""
    return F.when(conf <= 1.0, conf * 100).otherwise(conf)


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The latest delivery of every element, with flat box and confidence on one scale."""
    latest = Window.partitionBy("elem_id").orderBy(F.col("ingested_at").desc_nulls_last(), F.col("block_idx"))
    e = table(spark, folder, "elements").withColumn("rn", F.row_number().over(latest)).filter("rn = 1")
    return e.select("elem_id", "file", "page", "block_idx", "elem_type", "content", *[F.col(f"bounding_box.{s}").alias(s) for s in ("x1", "y1", "x2", "y2")], percent(F.col("ocr_conf")).alias("ocr_conf"), "detection_source")


BLOCKS = """(SELECT elem_id, file, page, block_idx, elem_type, content, bounding_box.x1 AS x1, bounding_box.y1 AS y1, bounding_box.x2 AS x2, bounding_box.y2 AS y2,
  CASE WHEN ocr_conf <= 1.0 THEN ocr_conf * 100 ELSE ocr_conf END AS ocr_conf, detection_source
  FROM (SELECT *, row_number() OVER (PARTITION BY elem_id ORDER BY ingested_at DESC NULLS LAST, block_idx) AS rn FROM elements) z WHERE rn = 1)"""


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """The latest delivery of every page's metadata."""
    latest = Window.partitionBy("file", "page").orderBy(F.col("processed_at").desc_nulls_last(), F.col("language"))
    return table(spark, folder, "page_meta").withColumn("rn", F.row_number().over(latest)).filter("rn = 1").drop("rn")


PAGES = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file, page ORDER BY processed_at DESC NULLS LAST, language) AS rn FROM page_meta) z WHERE rn = 1)"""


def fields(spark: SparkSession, folder: str) -> DataFrame:
    """The latest delivery of every form field."""
    latest = Window.partitionBy("field_id").orderBy(F.col("ingested_at").desc_nulls_last(), F.col("value"))
    return table(spark, folder, "form_fields").withColumn("rn", F.row_number().over(latest)).filter("rn = 1").drop("rn")


FIELDS = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY field_id ORDER BY ingested_at DESC NULLS LAST, value) AS rn FROM form_fields) z WHERE rn = 1)"""


def boxes(spark: SparkSession, folder: str) -> DataFrame:
    """Detected boxes derived from lineitem: one page per order, one class per return flag."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    z = table(spark, folder, "lineitem").withColumn("box_idx", F.row_number().over(order) - 1).withColumn("bx", (F.col("l_partkey") * 17) % 400).withColumn("by", (F.col("l_suppkey") * 29) % 300)
    d = lambda c: F.col(c).cast("double") if isinstance(c, str) else c.cast("double")
    return z.select(
        F.concat(F.lit("ord_"), F.col("l_orderkey").cast("string")).alias("file"), F.lit(1).alias("page"), F.col("box_idx").cast("int").alias("box_idx"), F.col("l_returnflag").alias("class"),
        d("bx").alias("x1"), d("by").alias("y1"), d(F.col("bx") + 60 + F.col("l_quantity") * 8).alias("x2"), d(F.col("by") + 40 + F.col("l_linenumber") * 20).alias("y2"),
        d((F.col("l_partkey") * 31 + F.col("l_suppkey") * 7) % 101).alias("confidence"),
    )


BOXES = """(SELECT concat('ord_', cast(l_orderkey AS varchar)) AS file, 1 AS page, cast(box_idx AS int) AS box_idx, l_returnflag AS class, cast(x1 AS double) AS x1, cast(y1 AS double) AS y1,
  cast(x1 + 60 + l_quantity * 8 AS double) AS x2, cast(y1 + 40 + l_linenumber * 20 AS double) AS y2, cast((l_partkey * 31 + l_suppkey * 7) % 101 AS double) AS confidence
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS box_idx, (l_partkey * 17) % 400 AS x1, (l_suppkey * 29) % 300 AS y1 FROM lineitem) z)"""


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Ruled segments derived from lineitem: axis, position on the cross axis, extent."""
    li = table(spark, folder, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    seg = lambda axis, p, a, b: F.struct(F.lit(axis).alias("axis"), p.cast("double").alias("p"), a.cast("double").alias("a"), b.cast("double").alias("b"))
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    both = F.array(seg("h", 100 + F.col("l_linenumber") * 60 + part % 4, 100 + supp % 5, 1500 - part % 300), seg("v", 100 + (supp % 4) * 300 + part % 4, F.lit(100), 600 - supp % 90))
    return li.select(F.concat(F.lit("ord_"), F.col("l_orderkey").cast("string")).alias("file"), F.lit(1).alias("page"), F.inline(both))


LINES = """(SELECT concat('ord_', cast(l_orderkey AS varchar)) AS file, 1 AS page, axis, cast(p AS double) AS p, cast(a AS double) AS a, cast(b AS double) AS b FROM (
  SELECT l_orderkey, 'h' AS axis, 100 + l_linenumber * 60 + (l_partkey % 4) AS p, 100 + (l_suppkey % 5) AS a, 1500 - (l_partkey % 300) AS b FROM lineitem
  UNION ALL SELECT l_orderkey, 'v', 100 + (l_suppkey % 4) * 300 + (l_partkey % 4), 100, 600 - (l_suppkey % 90) FROM lineitem) z)"""


def metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Image quality metrics derived from orders."""
    o = table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    d = lambda c: c.cast("double")
    return o.select(
        F.concat(F.lit("ord_"), key.cast("string")).alias("file"), F.lit(1).alias("page"), (F.col("o_totalprice") / 200).alias("laplacian_variance"), d(cust % 256).alias("brightness"), d(key % 100).alias("contrast"),
        (d(cust * 7 % 200) / 10).alias("noise_estimate"), (d(key % 41 - 20) / 10).alias("skew_angle"), (d(cust % 50) / 100).alias("text_density"), d(key % 60).alias("local_contrast_uniformity"),
        (800 + key % 1800).cast("int").alias("width"), (1000 + cust % 1500).cast("int").alias("height"),
    )


METRICS = """(SELECT concat('ord_', cast(o_orderkey AS varchar)) AS file, 1 AS page, o_totalprice / 200 AS laplacian_variance, cast(o_custkey % 256 AS double) AS brightness, cast(o_orderkey % 100 AS double) AS contrast,
  (o_custkey * 7 % 200) / 10.0e0 AS noise_estimate, ((o_orderkey % 41) - 20) / 10.0e0 AS skew_angle, (o_custkey % 50) / 100.0e0 AS text_density, cast(o_orderkey % 60 AS double) AS local_contrast_uniformity,
  cast(800 + (o_orderkey % 1800) AS int) AS width, cast(1000 + (o_custkey % 1500) AS int) AS height FROM orders)"""
