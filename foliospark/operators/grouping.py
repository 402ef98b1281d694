"""Grouping by gaps along one axis, and what is built on it: clusters, words into blocks, lines into rules, rows.

All are one partition by page, one sort, and a running sum of "a gap begins here"; no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gap_groups(df: DataFrame, keys: list[str], value: Column, tolerance: float, ties: list[str], name: str = "grp", strict: bool = False) -> DataFrame:
    """df with the number of its group along `value`: a row begins a group where it lies more than the tolerance
    (strict: at least the tolerance) beyond the row before it."""
    order = Window.partitionBy(*keys).orderBy(value, *ties)
    gap = value - F.lag(value).over(order)
    begins = F.when(gap >= tolerance if strict else gap > tolerance, 1).otherwise(0)
    return df.withColumn("_b", begins).withColumn(name, F.sum("_b").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_b")


def cluster_centres(df: DataFrame, keys: list[str], value: Column, tolerance: float = 10.0) -> DataFrame:
    """keys, grp, centre, n: groups of values no further than the tolerance from the one before, with their mean."""
    rows = df.select(*keys, value.alias("v")).filter("v is not null")
    return gap_groups(rows, keys, F.col("v"), tolerance, []).groupBy(*keys, "grp").agg(F.avg("v").alias("centre"), F.count("*").alias("n"))


def distinct_lines(df: DataFrame, keys: list[str], value: Column, gap: float) -> DataFrame:
    """keys, n_lines: one more than the gaps beyond `gap` between distinct values."""
    rows = df.select(*keys, value.alias("v")).filter("v is not null").distinct()
    order = Window.partitionBy(*keys).orderBy("v")
    return rows.withColumn("g", (F.col("v") - F.lag("v").over(order) > gap).cast("int")).groupBy(*keys).agg((F.lit(1) + F.coalesce(F.sum("g"), F.lit(0))).alias("n_lines"))


def dbscan_1d(df: DataFrame, keys: list[str], value: Column, eps: float, ties: list[str], name: str, least: int = 2) -> DataFrame:
    """df with cluster labels of density clustering on one axis: gaps up to eps chain, groups smaller than `least` are
    noise (-1). Labels count from 0 in the order in which the clusters' first rows (by `ties`) come."""
    g = gap_groups(df, keys, value, eps, ties, "_g")
    group = Window.partitionBy(*keys, "_g")
    g = g.withColumn("_n", F.count("*").over(group)).withColumn("_first", F.when(F.col("_n") >= least, F.min(F.struct(*ties)).over(group)))
    label = F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.col("_first").asc_nulls_last())) - 1
    return g.withColumn(name, F.when(F.col("_first").isNull(), -1).otherwise(label)).drop("_g", "_n", "_first")


def word_groups(words: DataFrame, keys: list[str]) -> DataFrame:
    """words with the block they belong to: a block begins where a word lies more than 20 pixels below the one before,
    or, if less than 20 off (exactly 20 is neither), more than 100 to its right. Unsure (confidence up to 30) and blank
    words are left out."""
    rows = words.filter((F.col("conf") > 30) & F.col("text").isNotNull() & (F.regexp_replace("text", r"(?U)\s", "") != ""))
    order = Window.partitionBy(*keys).orderBy("top", "left", "word_idx")
    down = F.col("top") - F.lag("top").over(order)
    across = F.col("left") - F.coalesce(F.lag(F.col("left") + F.col("width")).over(order), F.lit(0))
    begins = F.when((down > 20) | ((F.abs(down) < 20) & (across > 100)), 1).otherwise(0)
    return rows.withColumn("_b", begins).withColumn("grp", F.sum("_b").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_b")


def word_blocks(words: DataFrame, keys: list[str]) -> DataFrame:
    """A block per group of words: its envelope, its words in reading order, their mean confidence."""
    ordered = F.array_sort(F.collect_list(F.struct("top", "left", "word_idx", "text")))
    return word_groups(words, keys).groupBy(*keys, "grp").agg(
        F.min("left").cast("double").alias("x1"), F.min("top").cast("double").alias("y1"), F.max(F.col("left") + F.col("width")).cast("double").alias("x2"), F.max(F.col("top") + F.col("height")).cast("double").alias("y2"),
        F.array_join(F.transform(ordered, lambda x: x["text"]), " ").alias("content"), F.avg("conf").alias("conf"),
    )


def merged_lines(lines: DataFrame, keys: list[str], tolerance: float = 5.0) -> DataFrame:
    """Segments of one axis whose positions chain within the tolerance become one rule: the whole part of the median
    position, the widest extent."""
    g = gap_groups(lines, [*keys, "axis"], F.col("p"), tolerance, ["a", "b"])
    return g.groupBy(*keys, "axis", "grp").agg(F.median("p").cast("int").alias("p"), F.min("a").alias("a"), F.max("b").alias("b"), F.count("*").alias("n"))


def row_groups(blocks: DataFrame, keys: list[str], near: float = 20.0) -> DataFrame:
    """blocks with row and place in it: in the order of their upper left corners, a row goes on while centres lie less than
    `near` apart, either way."""
    order = Window.partitionBy(*keys).orderBy("y1", "x1", "block_idx")
    cy = (F.col("y1") + F.col("y2")) / 2
    begins = F.when(F.abs(cy - F.lag(cy).over(order)) >= near, 1).otherwise(0)
    g = blocks.withColumn("_b", begins).withColumn("row", F.sum("_b").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_b")
    return g.withColumn("col", F.row_number().over(Window.partitionBy(*keys, "row").orderBy("x1", "block_idx")) - 1)
