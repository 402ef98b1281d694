"""Tables: cells from ruled lines, grids, merged cells, borderless tables, exports."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cells as C
from ..functions.geometry import Box, overlap_area
from ..functions.text import normalize_basic
from .grouping import cluster_centres, dbscan_1d, distinct_lines, row_groups
from .spatial import near_pairs


def boundary_cells(rules: DataFrame, keys: list[str], least: float = 14.0) -> DataFrame:
    """keys, row, col, sides: a cell between each two neighbouring horizontal and each two neighbouring vertical rules
    (axis, p) that is large enough. Rows and columns count the boundaries. A page's grid is one group: it is made by one
    join of the page's few rows with its few columns."""
    def spans(axis: str, lo: str, hi: str, idx: str) -> DataFrame:
        p = rules.filter(F.col("axis") == axis).select(*keys, F.col("p").cast("double").alias(lo)).distinct()
        w = Window.partitionBy(*keys).orderBy(lo)
        return p.withColumn(hi, F.lead(lo).over(w)).withColumn(idx, F.row_number().over(w) - 1).filter(F.col(hi) - F.col(lo) >= least)

    return spans("h", "y1", "y2", "row").join(spans("v", "x1", "x2", "col"), keys).select(*keys, "row", "col", "x1", "y1", "x2", "y2")


def line_axes(lines: DataFrame, most: float = 3.0) -> DataFrame:
    """Lines (x1, y1, x2, y2) that are horizontal (axis h, p their height) or else vertical (axis v, p their place across), up
    to `most` pixels; others go."""
    flat, upright = F.abs(F.col("y2") - F.col("y1")) <= most, F.abs(F.col("x2") - F.col("x1")) <= most
    axis = F.when(flat, "h").when(upright, "v")
    p = F.when(flat, (F.col("y1") + F.col("y2")) / 2).otherwise((F.col("x1") + F.col("x2")) / 2)
    return lines.withColumn("axis", axis).withColumn("p", p).filter("axis is not null")


def nearest(values: Column, v: Column) -> Column:
    """Place (from 0) of the nearest of an ordered array of values, the first on ties."""
    gaps = F.transform(values, lambda c: F.abs(c - v))
    return (F.array_position(gaps, F.array_min(gaps)) - 1).cast("int")


def nearest_within(values: Column, v: Column, tolerance: float = 10.0) -> Column:
    """Place of the first value within the tolerance, -1 without one."""
    return (F.array_position(F.transform(values, lambda c: F.abs(c - v) <= tolerance), F.lit(True)) - 1).cast("int")


def indexed(cells: DataFrame, keys: list[str], tolerance: float = 10.0) -> DataFrame:
    """cells (with sides) with the row and column of the nearest cluster of centres."""
    cx, cy = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    axis = lambda v, name: cluster_centres(cells, keys, v, tolerance).groupBy(*keys).agg(F.array_sort(F.collect_list("centre")).alias(name))
    return cells.join(axis(cx, "_xs"), keys).join(axis(cy, "_ys"), keys).withColumn("row", nearest(F.col("_ys"), cy)).withColumn("col", nearest(F.col("_xs"), cx)).drop("_xs", "_ys")


def grid_text(cells: DataFrame, keys: list[str], order: str) -> DataFrame:
    """keys, row, col, text: the texts of a grid place in the given order, joined by ' | '."""
    lists = cells.groupBy(*keys, "row", "col").agg(F.array_sort(F.collect_list(F.struct(order, normalize_basic(F.col("text")).alias("t")))).alias("c"))
    return lists.select(*keys, "row", "col", F.array_join(F.transform("c", lambda x: x["t"]), " | ").alias("text"))


def cell_of_text(texts: DataFrame, cells: DataFrame, keys: list[str], text_id: str, cell_id: str, share: float = 0.8) -> DataFrame:
    """text_id, cell_id: the first cell that holds more than the share of a text's area."""
    pairs = near_pairs(texts, cells, keys)
    a, b = Box.of("a_"), Box.of("b_")
    return pairs.filter((a.area > 0) & (overlap_area(a, b) / a.area > share)).groupBy(*keys, F.col(f"a_{text_id}").alias(text_id)).agg(F.min(f"b_{cell_id}").alias(cell_id))


def valid_tables(cells: DataFrame, texts: DataFrame, pages: DataFrame, keys: list[str], text_id: str, cell_id: str, occupied: float = 0.2) -> DataFrame:
    """keys, occupied share and verdict of each grid: at least 4 cells and 2 columns, enough cells with a text, and no grid
    of under 3 columns over more than 65 percent of the page (pages: keys, w, h)."""
    env = cells.groupBy(*keys).agg(F.count("*").alias("n_cells"), ((F.max("x2") - F.min("x1")) * (F.max("y2") - F.min("y1"))).alias("area"))
    cols = distinct_lines(cells, keys, (F.col("x1") + F.col("x2")) / 2, 30.0).withColumnRenamed("n_lines", "n_cols")
    filled = cell_of_text(texts, cells, keys, text_id, cell_id).groupBy(*keys).agg(F.countDistinct(cell_id).alias("n_filled"))
    out = env.join(cols, keys).join(pages, keys).join(filled, keys, "left").withColumn("share", F.coalesce("n_filled", F.lit(0)) / F.col("n_cells"))
    wide = (F.col("area") / (F.col("w") * F.col("h")) > 0.65) & (F.col("n_cols") < 3)
    return out.select(*keys, "n_cells", "n_cols", F.round("share", 4).alias("share"), ((F.col("n_cells") >= 4) & (F.col("n_cols") >= 2) & ~wide & (F.col("share") >= occupied)).alias("valid"))


def body_blocks(blocks: DataFrame, strict: bool = False) -> DataFrame:
    """Blocks (with page height h) whose centre lies between 8 and 85 percent of the page and that are no disclaimer."""
    cy = (F.col("y1") + F.col("y2")) / 2
    inside = (cy > F.col("h") * 0.08) & (cy < F.col("h") * 0.85) if strict else (cy >= F.col("h") * 0.08) & (cy <= F.col("h") * 0.85)
    return blocks.filter(inside & ~C.is_disclaimer(F.col("content")))


def borderless_grids(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Pages (blocks with w, h) whose blocks form a grid by density clustering of their centres: rows, columns, share of
    places filled, content score. At least 4 blocks, 2 rows, 2 columns, 40 percent filled, a score of .3."""
    body = body_blocks(blocks, strict=True)
    body = dbscan_1d(body, keys, (F.col("x1") + F.col("x2")) / 2, 30.0, ["block_idx"], "col")
    body = dbscan_1d(body, keys, (F.col("y1") + F.col("y2")) / 2, 25.0, ["block_idx"], "row")
    placed = (F.col("row") >= 0) & (F.col("col") >= 0)
    g = body.groupBy(*keys).agg(
        F.count("*").alias("n_blocks"), (F.max("row") + 1).alias("n_rows"), (F.max("col") + 1).alias("n_cols"), F.countDistinct(F.when(placed, F.struct("row", "col"))).alias("n_filled"),
        C.content_score(F.collect_list(F.when(placed, F.coalesce("content", F.lit(""))))).alias("score"),
    )
    g = g.withColumn("occupancy", F.col("n_filled") / F.greatest(F.lit(1), F.col("n_rows") * F.col("n_cols")))
    return g.filter("n_blocks >= 4 and n_rows >= 2 and n_cols >= 2 and occupancy >= 0.4 and score >= 0.3").select(*keys, "n_rows", "n_cols", F.round("occupancy", 4).alias("occupancy"), F.round("score", 4).alias("score"))


def borderless_tables(blocks: DataFrame, keys: list[str], least_cols: int = 2, least_rows: int = 2) -> DataFrame:
    """The best run of aligned rows of a page (blocks with w, h): keys, block_idx, row, col. A run goes on while more than
    half of the columns lie within 50 pixels of those of the row before; it must say enough, and not cover the page. The
    next row depends on the last accepted one, so a page's rows are folded in Python."""
    scored = row_groups(body_blocks(blocks), keys).select(*keys, "block_idx", "row", "col", "content", "x1", "y1", "x2", "y2", "w", "h")
    text = F.coalesce("content", F.lit(""))
    said = F.length(F.regexp_replace(text, r"(?U)^\s+|\s+$", "")) >= 2
    scored = scored.withColumn("kind", F.when(~said, 0).when(C.is_disclaimer(text), 1).when(C.is_label_only(text), 2).when(C.is_table_content(text), 3).otherwise(0)).drop("content")
    schema = ", ".join([*(f"`{k}` {blocks.schema[k].dataType.simpleString()}" for k in keys), "block_idx int", "row int", "col int"])

    def score(kinds: list[int]) -> float:
        if not kinds:
            return 0.0
        if 1 in kinds:
            return 0.1
        return 0.2 if kinds.count(2) > kinds.count(3) else kinds.count(3) / len(kinds)

    def best(page: list[dict]) -> list[tuple[int, int, int]]:
        if len(page) < least_cols * least_rows:
            return []
        rows: list[list[dict]] = []
        for b in page:  # in the order of rows and columns
            if rows and rows[-1][0]["row"] == b["row"]:
                rows[-1].append(b)
            else:
                rows.append([b])
        mid = lambda b: (b["x1"] + b["x2"]) / 2
        top, found = 0.0, []
        for i, first in enumerate(rows):
            if len(first) < least_cols:
                continue
            run, last = list(first), first
            for nxt in rows[i + 1 :]:
                if len(nxt) < least_cols:
                    break
                n = min(len(last), len(nxt))
                if sum(abs(mid(a) - mid(b)) < 50 for a, b in zip(last, nxt)) / n <= 0.5:
                    break
                run.extend(nxt)
                last = nxt
            value = score([b["kind"] for b in run])
            distinct = len({(b["x1"], b["y1"], b["x2"], b["y2"]) for b in run})
            if value >= 0.3 and len(run) > top and distinct / len(first) >= least_rows and len(run) * value > top:
                top, found = len(run) * value, run
        if not found:
            return []
        area = (max(b["x2"] for b in found) - min(b["x1"] for b in found)) * (max(b["y2"] for b in found) - min(b["y1"] for b in found))
        cover = area / (page[0]["w"] * page[0]["h"])
        centres = sorted({mid(b) for b in found})
        n_cols = 1 + sum(b - a > 30 for a, b in zip(centres, centres[1:]))
        if cover > 0.70 or (cover > 0.65 and n_cols < 3):
            return []
        return [(b["block_idx"], b["row"], b["col"]) for b in found]

    def run_all(it):
        for pdf in it:
            out = [(*r[:-1], *m) for r in pdf.itertuples(index=False, name=None) for m in best(list(r[-1]))]
            yield pd.DataFrame(out, columns=[*keys, "block_idx", "row", "col"])

    lists = scored.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("row", "col", "block_idx", "kind", "x1", "y1", "x2", "y2", "w", "h"))).alias("c"))
    return lists.mapInPandas(run_all, schema)


def merged_cells(grid: DataFrame, lines: DataFrame, keys: list[str], tolerance: float = 10.0) -> DataFrame:
    """Cells of a table with their spans: keys, row, col, row_span, col_span. grid has per table the ordered arrays ys, xs;
    lines (axis, p, a, b) divide cells where they lie on a boundary and pass the middle of a cell. From the first free cell
    on, a span grows down its first column and across its first row as long as nothing divides; if something divides cells
    within, the cell stays alone. The scan depends on what is taken, so a table is folded in Python."""
    at = F.struct("axis", "p", "a", "b")
    both = grid.join(lines.groupBy(*keys).agg(F.collect_list(at).alias("ls")), keys, "left").select(*keys, "ys", "xs", "ls")
    schema = ", ".join([*(f"`{k}` {grid.schema[k].dataType.simpleString()}" for k in keys), "row int", "col int", "row_span int", "col_span int"])

    def scan(it):
        for pdf in it:
            out = []
            for r in pdf.itertuples(index=False):
                ys, xs, ls = list(r.ys), list(r.xs), list(r.ls) if r.ls is not None else []
                n, m = len(ys) - 1, len(xs) - 1
                if n < 1 or m < 1:
                    continue
                by: dict[tuple[str, int], list[tuple[float, float]]] = {}
                for s in ls:
                    axis = ys if s["axis"] == "h" else xs
                    k = next((i for i, v in enumerate(axis) if abs(v - s["p"]) <= tolerance), -1)
                    by.setdefault((s["axis"], k), []).append((s["a"], s["b"]))
                mid_x, mid_y = [(xs[i] + xs[i + 1]) / 2 for i in range(m)], [(ys[i] + ys[i + 1]) / 2 for i in range(n)]
                across = lambda i, c: any(a <= mid_x[c] <= b for a, b in by.get(("h", i), ()))  # noqa: B023, E731
                down = lambda i, k: any(a <= mid_y[k] <= b for a, b in by.get(("v", i), ()))  # noqa: B023, E731
                taken = set()
                for row in range(n):
                    for col in range(m):
                        if (row, col) in taken:
                            continue
                        rs, cs = 1, 1
                        while row + rs < n and (row + rs, col) not in taken and not across(row + rs, col):
                            rs += 1
                        while col + cs < m and (row, col + cs) not in taken and not down(col + cs, row):
                            cs += 1
                        inner = any(across(i, c) for i in range(row + 1, row + rs) for c in range(col, col + cs)) or any(down(i, k) for i in range(col + 1, col + cs) for k in range(row, row + rs))
                        if inner or any((i, c) in taken for i in range(row, row + rs) for c in range(col, col + cs)):
                            rs = cs = 1
                        taken.update((i, c) for i in range(row, row + rs) for c in range(col, col + cs))
                        out.append((*(getattr(r, k) for k in keys), row, col, rs, cs))
            yield pd.DataFrame(out, columns=[*keys, "row", "col", "row_span", "col_span"])

    return both.mapInPandas(scan, schema)


# ---- exports: a table is rows keys, row, col, row_span, col_span, text; every export is one text per table -----------


def places(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Every place of the tables' grids with the cell that starts there (text) or covers it (covered)."""
    spans = cells.withColumn("r", F.explode(F.sequence(F.col("row"), F.col("row") + F.col("row_span") - 1))).withColumn("c", F.explode(F.sequence(F.col("col"), F.col("col") + F.col("col_span") - 1)))
    sizes = cells.groupBy(*keys).agg((F.max(F.col("row") + F.col("row_span")) - 1).alias("mr"), (F.max(F.col("col") + F.col("col_span")) - 1).alias("mc"))
    grid = sizes.withColumn("r", F.explode(F.sequence(F.lit(0), F.col("mr")))).withColumn("c", F.explode(F.sequence(F.lit(0), F.col("mc")))).drop("mr", "mc")
    return grid.join(spans, [*keys, "r", "c"], "left").withColumn("covered", F.coalesce((F.col("r") != F.col("row")) | (F.col("c") != F.col("col")), F.lit(False)))


def by_rows(cells: DataFrame, keys: list[str], text: Column, between: str, wrap, rule=None, end: str = "\n") -> DataFrame:
    rows = places(cells, keys).groupBy(*keys, "r").agg(F.array_sort(F.collect_list(F.struct("c", text.alias("t")))).alias("ts"))
    line = wrap(F.array_join(F.filter(F.transform("ts", lambda x: x["t"]), lambda t: t.isNotNull()), between))
    if rule is not None:
        line = F.when(F.col("r") == 0, F.concat(line, F.lit(end), rule(F.size("ts")))).otherwise(line)
    lines = rows.select(*keys, "r", line.alias("line")).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("r", "line"))).alias("ls"))
    return lines.select(*keys, F.array_join(F.transform("ls", lambda x: x["line"]), end).alias("out"))


def to_markdown(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Bars escaped, an arrow up in covered places, [↔c×↕r] after a merged cell, a rule after the first row."""
    t = F.replace(F.coalesce("text", F.lit("")), F.lit("|"), F.lit("\\|"))
    merged = (F.col("row_span") > 1) | (F.col("col_span") > 1)
    shown = F.when(F.col("covered"), "↑").when(merged, F.concat(t, F.lit(" [↔"), F.col("col_span").cast("string"), F.lit("×↕"), F.col("row_span").cast("string"), F.lit("]"))).otherwise(t)
    bars = lambda c: F.concat(F.lit("| "), c, F.lit(" |"))
    return by_rows(cells, keys, shown, " | ", bars, lambda n: bars(F.array_join(F.array_repeat(F.lit("---"), n), " | "))).withColumnRenamed("out", "markdown")


def to_html(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Rows and cells with their spans; covered places have no cell; texts as they are."""
    span = lambda name, c: F.when(F.col(c) > 1, F.concat(F.lit(f' {name}="'), F.col(c).cast("string"), F.lit('"'))).otherwise("")
    cell = F.when(~F.col("covered"), F.concat(F.lit("<td"), F.coalesce(span("rowspan", "row_span"), F.lit("")), F.coalesce(span("colspan", "col_span"), F.lit("")), F.lit(">"), F.coalesce("text", F.lit("")), F.lit("</td>")))
    out = by_rows(cells, keys, cell, "", lambda c: F.concat(F.lit("<tr>"), c, F.lit("</tr>")))
    return out.select(*keys, F.concat(F.lit("<table>\n"), F.col("out"), F.lit("\n</table>")).alias("html"))


def csv_cell(text: Column) -> Column:
    """Quoted only where it must be, quotes doubled."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(t)


def to_csv(cells: DataFrame, keys: list[str], flat: bool = False) -> DataFrame:
    """One text per table with CRLF line ends; covered places are empty, or, flat, repeat the cell that covers them."""
    text = csv_cell(F.col("text")) if flat else F.when(F.col("covered"), "").otherwise(csv_cell(F.col("text")))
    out = by_rows(cells, keys, text, ",", lambda c: c, end="\r\n")
    return out.select(*keys, F.concat(F.col("out"), F.lit("\r\n")).alias("csv"))


def with_references(cells: DataFrame, keys: list[str]) -> DataFrame:
    """keys, row, col, text of every place; covered ones refer to their cell as [→r,c]."""
    ref = F.concat(F.lit("[→"), F.col("row").cast("string"), F.lit(","), F.col("col").cast("string"), F.lit("]"))
    return places(cells, keys).select(*keys, F.col("r").alias("row"), F.col("c").alias("col"), F.when(F.col("covered"), ref).otherwise(F.coalesce("text", F.lit(""))).alias("text"))
