"""Chart data, colours and figure kinds on columns and tables; shapes come from a detector."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .geometry import Box

#: Words in a classifier's label and the kind of figure they mean, in the order in which they are tried (fixed values).
KINDS = {
    "bar_chart": ("bar chart", "column chart", "bar graph", "histogram", "vertical bar", "horizontal bar", "barplot"), "line_chart": ("line graph", "line chart", "time series", "trend line", "line plot", "curve", "timeline"),
    "pie_chart": ("pie chart", "pie graph", "donut chart", "circular chart", "percentage chart"), "scatter_plot": ("scatter plot", "scatter chart", "scatterplot", "point cloud", "dot plot", "bubble chart"),
    "map": ("map", "atlas", "globe", "cartography", "geographic", "topographic", "world map", "street map", "satellite"), "photo": ("photo", "photograph", "picture", "image", "snapshot", "digital camera", "camera", "portrait", "landscape photo"),
    "flowchart": ("flowchart", "flow chart", "workflow", "process diagram", "decision tree", "organizational chart", "org chart", "hierarchy", "sequence diagram", "block diagram"),
    "network_diagram": ("network", "graph network", "node", "connection", "circuit", "wiring", "topology"), "blueprint": ("blueprint", "architecture", "floor plan", "schematic", "technical drawing", "engineering drawing", "cad"),
    "plot": ("plot", "graph", "function", "mathematical", "equation", "coordinate", "axis", "cartesian"), "table_image": ("table", "spreadsheet", "grid", "matrix", "data table"), "diagram": ("diagram", "illustration", "schematic", "chart", "infographic", "visualization"),
    "scientific_viz": ("microscope", "telescope", "x-ray", "mri", "scan", "spectrogram", "oscilloscope", "waveform", "spectrum"),
}


def figure_kind(label: Column) -> Column:
    low = F.lower(F.coalesce(label, F.lit("")))
    out = F.lit("figure")
    for kind, keys in reversed(KINDS.items()):
        out = F.when(low.rlike("|".join(keys)), kind).otherwise(out)
    return out


def figure_kind_by_shape(h_lines: Column, v_lines: Column, color_share: Column) -> Column:
    """Without a classifier: both kinds of lines a chart, many horizontal ones a table, many colours a photograph."""
    return F.when((h_lines > 3) & (v_lines > 3), "chart").when(h_lines > 5, "table").when(color_share > 0.3, "photograph").otherwise("figure")


def color_name(b: Column, g: Column, r: Column) -> Column:
    """Name of a colour by bounds tried in this order; grey comes before white, which it hides."""
    rgb = F.concat(F.lit("rgb("), r.cast("string"), F.lit(","), g.cast("string"), F.lit(","), b.cast("string"), F.lit(")"))
    hi, lo = (lambda c: c > 200), (lambda c: c < 100)
    return (
        F.when(hi(r) & lo(g) & lo(b), "red").when(lo(r) & hi(g) & lo(b), "green").when(lo(r) & lo(g) & hi(b), "blue").when(hi(r) & hi(g) & lo(b), "yellow").when(hi(r) & lo(g) & hi(b), "magenta").when(lo(r) & hi(g) & hi(b), "cyan")
        .when(hi(r) & (g > 150) & lo(b), "orange").when((r > 150) & (g > 150) & (b > 150), "gray").when((r < 50) & (g < 50) & (b < 50), "black").otherwise(rgb)
    )


def bars(shapes: DataFrame, keys: list[str], ident: str) -> DataFrame:
    """Bars of a chart (sides; chart_w, chart_h) large and long enough for the chart's orientation, which most shapes set:
    their place and their length relative to the chart."""
    b = Box.of()
    upright = Window.partitionBy(*keys)
    vertical = F.sum((b.height > b.width).cast("int")).over(upright) >= F.sum((b.width > b.height).cast("int")).over(upright)
    s = shapes.withColumn("orientation", F.when(vertical, "vertical").otherwise("horizontal"))
    tall = F.col("orientation") == "vertical"
    fits = F.when(tall, (b.height > b.width) & (b.height > 20)).otherwise((b.width > b.height) & (b.width > 20))
    s = s.filter(fits & (b.area > 100)).withColumn("relative_value", F.round(F.when(tall, b.height / F.col("chart_h")).otherwise(b.width / F.col("chart_w")), 4))
    order = Window.partitionBy(*keys).orderBy(F.when(tall, b.x1).otherwise(b.y1), ident)
    return s.withColumn("pos", F.row_number().over(order) - 1)


def axis_bounds(values: DataFrame, keys: list[str], value: str) -> DataFrame:
    return values.groupBy(*keys).agg(F.min(value).alias("low"), F.max(value).alias("high"), (F.max(value) - F.min(value)).alias("span"))


def line_samples(segments: DataFrame, keys: list[str], ident: str, most: int = 5, samples: int = 10) -> DataFrame:
    """Points along the first slanted segments (sides as ends; chart_w, chart_h): whole x and y, relative place and value."""
    angle = F.abs(F.degrees(F.atan2(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1"))))
    s = segments.filter((angle > 5) & (angle < 85)).withColumn("line_index", F.row_number().over(Window.partitionBy(*keys).orderBy(ident)) - 1).filter(F.col("line_index") < most)
    t = F.col("k") / (samples - 1)
    s = s.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(samples - 1)))).withColumn("x", (F.col("x1") + t * (F.col("x2") - F.col("x1"))).cast("int")).withColumn("y", (F.col("y1") + t * (F.col("y2") - F.col("y1"))).cast("int"))
    return s.select(*keys, "line_index", "k", "x", "y", F.round(F.col("x") / F.col("chart_w"), 4).alias("relative_x"), F.round(1 - F.col("y") / F.col("chart_h"), 4).alias("relative_value"))


def pie_shares(slices: DataFrame, keys: list[str], label: str, pixels: str, least: int = 100) -> DataFrame:
    """Slices of more than `least` pixels with their percentage (two places) and angle, the largest first."""
    s = slices.filter(F.col(pixels) > least)
    share = F.round(F.col(pixels) / F.sum(pixels).over(Window.partitionBy(*keys)) * 100, 2)
    order = Window.partitionBy(*keys).orderBy(F.col(pixels).desc(), label)
    return s.withColumn("percentage", share).withColumn("angle", F.round(F.col("percentage") * 3.6, 2)).withColumn("pos", F.row_number().over(order) - 1).select(*keys, label, "percentage", "angle", "pos")


def scatter_points(blobs: DataFrame, keys: list[str], ident: str) -> DataFrame:
    """Centres of blobs (sides; chart_w, chart_h) relative to the chart, y upwards, from left to right."""
    b = Box.of()
    order = Window.partitionBy(*keys).orderBy(b.cx, ident)
    return blobs.select(*keys, ident, F.round(b.cx / F.col("chart_w"), 4).alias("x"), F.round(1 - b.cy / F.col("chart_h"), 4).alias("y"), (F.row_number().over(order) - 1).alias("pos"))
