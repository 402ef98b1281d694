"""Geometry on columns. A box is four columns or a struct x1, y1, x2, y2; null sides give null."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Box:
    x1: Column
    y1: Column
    x2: Column
    y2: Column

    @staticmethod
    def of(prefix: str = "") -> "Box":
        return Box(*[F.col(prefix + s) for s in ("x1", "y1", "x2", "y2")])

    @staticmethod
    def struct(c: Column) -> "Box":
        return Box(c["x1"], c["y1"], c["x2"], c["y2"])

    @property
    def width(self) -> Column:
        return self.x2 - self.x1

    @property
    def height(self) -> Column:
        return self.y2 - self.y1

    @property
    def area(self) -> Column:
        return self.width * self.height

    @property
    def cx(self) -> Column:
        return (self.x1 + self.x2) / 2

    @property
    def cy(self) -> Column:
        return (self.y1 + self.y2) / 2

    def columns(self, prefix: str = "") -> list[Column]:
        return [c.alias(prefix + n) for c, n in zip((self.x1, self.y1, self.x2, self.y2), ("x1", "y1", "x2", "y2"))]


def read_box(c: Column) -> Box:
    """A box given as a map with x1 or left, y1 or top, x2 or right, y2 or bottom."""
    side = lambda *names: F.coalesce(*[F.try_element_at(c, F.lit(n)) for n in names])
    return Box(side("x1", "left"), side("y1", "top"), side("x2", "right"), side("y2", "bottom"))


def polygon_box(points: Column) -> Box:
    """The envelope of an array of points with x and y."""
    side = lambda f, s: f(F.transform(points, lambda p: p[s]))
    return Box(side(F.array_min, "x"), side(F.array_min, "y"), side(F.array_max, "x"), side(F.array_max, "y"))


def overlap_area(a: Box, b: Box) -> Column:
    w = F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1)
    h = F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1)
    return F.when((w > 0) & (h > 0), w * h).otherwise(F.lit(0.0))


def iou(a: Box, b: Box) -> Column:
    """Overlap over union; 0 without overlap or without area."""
    inter = overlap_area(a, b)
    union = a.area + b.area - inter
    return F.when((inter > 0) & (union > 0), inter / union).otherwise(F.lit(0.0))


def contains(outer: Box, inner: Box, margin: float = 0) -> Column:
    return (inner.x1 >= outer.x1 - margin) & (inner.y1 >= outer.y1 - margin) & (inner.x2 <= outer.x2 + margin) & (inner.y2 <= outer.y2 + margin)


def overlaps(a: Box, b: Box, threshold: float = 0.0) -> Column:
    return iou(a, b) > threshold


def expand(b: Box, margin: float) -> Box:
    return Box(b.x1 - margin, b.y1 - margin, b.x2 + margin, b.y2 + margin)


def clip(b: Box, width: Column, height: Column) -> Box:
    """Every side into the page."""
    into = lambda v, most: F.greatest(F.lit(0.0), F.least(v, most))
    return Box(into(b.x1, width), into(b.y1, height), into(b.x2, width), into(b.y2, height))


def has_area(b: Box) -> Column:
    return (b.x2 > b.x1) & (b.y2 > b.y1)


def unscale(b: Box, factor: Column) -> Box:
    """Back from a scaled page; a null factor counts as 1."""
    f = F.coalesce(factor, F.lit(1.0))
    return Box(b.x1 / f, b.y1 / f, b.x2 / f, b.y2 / f)


def scale_factor(new_w: Column, new_h: Column, old_w: Column, old_h: Column) -> Column:
    return (new_w / old_w + new_h / old_h) / 2


def segmentation_mode(b: Box) -> Column:
    """7 (one line) for wide boxes, 13 (raw line) for small ones, else 6 (a block)."""
    w, h = F.greatest(b.width, F.lit(1.0)), F.greatest(b.height, F.lit(1.0))
    return F.when(w / h > 5, 7).when(w * h < 8000, 13).otherwise(6)


def line_parameters(width: Column, height: Column) -> list[Column]:
    """Shortest line, largest gap and least cell of a page, from its size."""
    least = F.least(width, height)
    return [F.greatest(F.lit(40), (least * 0.05).cast("int")).alias("min_length"), F.greatest(F.lit(80), (width * 0.10).cast("int")).alias("kernel_width"), F.greatest(F.lit(5), (least * 0.01).cast("int")).alias("max_gap")]


def plausible_figure(b: Box, width: Column, height: Column) -> Column:
    """A box within the page that covers 1 to 40 percent, not much of the lower part, and is no line or margin."""
    cover = b.area / (width * height)
    inside = (b.x1 >= 0) & (b.y1 >= 0) & (b.x2 <= width) & (b.y2 <= height) & has_area(b)
    sized = (cover >= 0.01) & (cover <= 0.40) & ~((b.cy > height * 0.6) & (cover > 0.20))
    shaped = (b.width / b.height >= 0.1) & (b.height / b.width >= 0.1) & ~((b.width > width * 0.9) & (b.height < height * 0.15))
    return F.coalesce(F.when(inside, sized & shaped), F.lit(False))


def likely_false_figure(b: Box, width: Column, height: Column) -> Column:
    cover = b.area / (width * height)
    return F.coalesce((cover > 0.25) | ((cover > 0.15) & (b.cy > height * 0.4)), F.lit(False))


def noise_artifact(b: Box, content: Column, conf: Column, width: Column, height: Column, edge: float = 0.05, empty_is_noise: bool = False) -> Column:
    """Whether a block is likely noise: faint specks at the edge, single or mostly odd characters, thin boxes at the edge,
    faint boxes at the bottom, full-width boxes at the very bottom. A block without a box is kept; a null confidence
    counts 50; confidences are on the 0 to 100 scale. empty_is_noise: blank contents are noise as well."""
    text = F.regexp_replace(F.coalesce(content, F.lit("")), r"(?U)^\s+|\s+$", "")
    conf = F.coalesce(conf, F.lit(50.0))
    at_bottom = b.y2 > height * (1 - edge)
    at_edge = (b.x1 < width * edge) | (b.x2 > width * (1 - edge)) | (b.y1 < height * edge) | at_bottom
    size = F.when(width * height > 0, b.area / (width * height)).otherwise(0.0)
    aspect = F.when(b.height > 0, b.width / b.height).otherwise(0.0)
    letters = F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]", ""))
    noise = (
        ((size < 0.002) & at_edge & (conf < 30))
        | (F.length(text) == 1)
        | ((F.length(text) > 0) & (letters / F.greatest(F.length(text), F.lit(1)) < 0.3))
        | (at_edge & (((aspect > 20) & (b.height < 20)) | ((aspect < 0.05) & (b.width < 20))))
        | (at_bottom & (conf < 25) & (size < 0.01))
        | ((b.width > width * 0.8) & (b.y1 > height * 0.95))
    )
    if empty_is_noise:
        noise = noise | (F.length(text) == 0)
    return F.coalesce(b.x1.isNotNull() & noise, F.lit(False))
