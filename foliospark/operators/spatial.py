"""Joins by place on a page.

Boxes meet in cells of a grid: a box stands in every cell it touches, pairs are joined on page and cell, and a pair is
kept in one cell only, that of the upper left corner of its overlap. So a page with very many boxes is spread over its
cells, and no pair of boxes apart is ever formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import Box

CELL = 512.0


def gridded(df: DataFrame, keys: list[str], grow: float = 0.0, cell: float = CELL) -> DataFrame:
    """df with a row for each cell (gx, gy) that its box, grown by so many pixels, touches. Rows without a whole box go."""
    at = lambda c: F.floor(c / cell).cast("int")
    across = F.sequence(at(F.col("x1") - grow), at(F.greatest("x1", "x2") + grow))
    down = F.sequence(at(F.col("y1") - grow), at(F.greatest("y1", "y2") + grow))
    whole = df.filter("x1 is not null and y1 is not null and x2 is not null and y2 is not null")
    return whole.withColumn("gx", F.explode(across)).withColumn("gy", F.explode(down))


def prefixed(df: DataFrame, prefix: str, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(c) if c in keys else F.col(c).alias(prefix + c) for c in df.columns])


def near_pairs(a: DataFrame, b: DataFrame, keys: list[str], reach: float = 0.0, cell: float = CELL) -> DataFrame:
    """All pairs of rows of a (columns a_...) and b (b_...) with equal keys whose boxes, those of a grown by `reach`,
    touch. Every pair comes once."""
    left = prefixed(gridded(a, keys, reach, cell), "a_", keys)
    right = prefixed(gridded(b, keys, 0.0, cell), "b_", keys)
    on = [left[k] == right[k] for k in keys] + [F.col("a_gx") == F.col("b_gx"), F.col("a_gy") == F.col("b_gy")]
    corner_x = F.floor(F.greatest(F.col("a_x1") - reach, F.col("b_x1")) / cell).cast("int")
    corner_y = F.floor(F.greatest(F.col("a_y1") - reach, F.col("b_y1")) / cell).cast("int")
    touch = (F.col("b_x1") <= F.greatest("a_x1", "a_x2") + reach) & (F.greatest("b_x1", "b_x2") >= F.col("a_x1") - reach) & (F.col("b_y1") <= F.greatest("a_y1", "a_y2") + reach) & (F.greatest("b_y1", "b_y2") >= F.col("a_y1") - reach)
    joined = left.join(right, on).filter(touch & (F.col("a_gx") == corner_x) & (F.col("a_gy") == corner_y))
    keep = [left[k] for k in keys] + [F.col(c) for c in joined.columns if c.startswith(("a_", "b_")) and c not in ("a_gx", "a_gy", "b_gx", "b_gy")]
    return joined.select(*keep)


def box_of(prefix: str) -> Box:
    return Box.of(prefix)


def nearest_caption_rank(fig: Box, text: Box, tolerance: float = 140.0) -> tuple[Column, Column]:
    """(0 below or 1 above, gap) of a caption candidate, nulls where it is none."""
    across = F.least(fig.x2, text.x2) - F.greatest(fig.x1, text.x1) > 20
    below, above = text.y1 - fig.y2, fig.y1 - text.y2
    is_below = across & (below >= 0) & (below < tolerance)
    is_above = across & (above >= 0) & (above < tolerance)
    return F.when(is_below, 0).when(is_above, 1), F.when(is_below, below).when(is_above, above)


def captions(figures: DataFrame, texts: DataFrame, keys: list[str], fig_id: str, text_id: str, tolerance: float = 140.0) -> DataFrame:
    """Each figure with its caption: the nearest text below, else above, that overlaps it by more than 20 pixels across;
    '' where there is none. Of equal gaps the smaller text_id."""
    pairs = near_pairs(figures, texts, keys, tolerance)
    side, gap = nearest_caption_rank(Box.of("a_"), Box.of("b_"), tolerance)
    ranked = pairs.withColumn("side", side).withColumn("gap", gap).filter("side is not null")
    best = ranked.groupBy(F.col(f"a_{fig_id}").alias(fig_id)).agg(F.min(F.struct("side", "gap", F.col(f"b_{text_id}").alias("text_id"), F.col("b_content").alias("text"))).alias("m"))
    return figures.join(best, fig_id, "left").withColumn("caption", F.coalesce("m.text", F.lit(""))).withColumn("caption_id", F.col("m.text_id")).drop("m")
