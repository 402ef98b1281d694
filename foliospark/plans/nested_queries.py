"""Queries of problem 2: nested page records as linked flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import nested
from ..sources.tables import table

PAGE_RECORD = nested.Shape(
    aliases={"boundingBox": "bounding_box", "bbox": "bounding_box"},
    listed=frozenset({"documents", "pages", "elements", "cells", "rows"}),
    carry={"pages": ("page",), "elements": ("type",), "rows": ()},
    boxes=frozenset({"bounding_box", "label_bbox", "value_bbox"}),
)


def page_tables(spark: SparkSession, folder: str) -> DataFrame:
    """All flat tables of page_records (see operators.nested). Every payload is read twice: for the graph, of which one row
    per distinct edge of the schema comes to the driver, and for the rows, of the latest deliveries."""
    records = table(spark, folder, "page_records", "rec_id", "payload", "received_at")
    graph = [tuple(r) for r in nested.schema_graph(records, "payload", PAGE_RECORD).collect()]
    return nested.shred(nested.latest(records, "rec_id", "payload", "received_at"), "rec_id", "payload", PAGE_RECORD, nested.inline(graph))


def p2_schema(spark: SparkSession, folder: str) -> DataFrame:
    """The schema graph: parent, child, repeated, and whether the child has a table of its own."""
    graph = nested.schema_graph(table(spark, folder, "page_records", "payload"), "payload", PAGE_RECORD)
    made = nested.inline([tuple(r) for r in graph.collect()])
    return graph.withColumn("own_table", F.col("child").isin(sorted(made)))


def p2_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every table per kind of parent, with the number of distinct records and of rows without a parent."""
    rows = page_tables(spark, folder)
    return rows.groupBy("tbl", "parent_tbl").agg(F.count("*").alias("n_rows"), F.max("pos").alias("max_pos"), F.sum(F.when(F.col("parent_id").isNull() & (F.col("tbl") != nested.ROOT), 1).otherwise(0)).alias("orphans"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """rec_id, page, elem_pos, cell_pos of each element (cell_pos -1) and cell whose own box is complete and has area.

    A page's number is its `page`, else its key among the pages, else its place (from 1). Cells count in reading order:
    by row and column where all cells of the table tell theirs as they stand, else as they stand."""
    rows = page_tables(spark, folder).filter(F.col("tbl").isin("elements", "cells"))
    side = lambda s: F.expr(f"try_cast(vals['bounding_box_{s}'] as double)")
    is_element = F.col("tbl") == "elements"
    number = F.coalesce(F.expr("try_cast(carried['pages.page'] as int)"), F.expr("try_cast(carried['pages.key'] as int)"), F.expr("try_cast(carried['pages.pos'] as int)") + 1)
    row_pos = F.expr("try_cast(carried['rows.pos'] as int)")
    place = F.struct(F.coalesce(F.expr("try_cast(vals['row'] as int)"), row_pos, F.lit(0)).alias("r"), F.coalesce(F.expr("try_cast(vals['col'] as int)"), F.lit(0)).alias("c"), F.coalesce(row_pos, F.lit(0)).alias("row_pos"), "pos", F.col("ok"))
    flat = rows.select(
        "rec_id", "tbl", number.alias("page"), F.when(is_element, F.col("pos")).otherwise(F.expr("try_cast(carried['elements.pos'] as int)")).alias("elem_pos"), "vals", "carried", "pos",
        F.coalesce((side("right") > side("left")) & (side("bottom") > side("top")), F.lit(False)).alias("ok"),
    )
    # one group holds the cells of one table
    by_element = flat.groupBy("rec_id", "page", "elem_pos").agg(F.max(F.when(is_element, F.col("ok"))).alias("own"), F.array_sort(F.collect_list(F.when(~is_element, place))).alias("cells"))
    cells = F.transform("cells", lambda x, i: F.when(x["ok"], i))
    return by_element.select("rec_id", "page", "elem_pos", F.explode(F.array_compact(F.concat(F.array(F.when(F.col("own"), -1)), cells))).alias("cell_pos"))


def p2_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The pages of the records as a flat table, linked to what is above them."""
    return nested.typed(page_tables(spark, folder), "rec_id", "pages")


def p2_elements(spark: SparkSession, folder: str) -> DataFrame:
    """The elements as a flat table, linked to their pages."""
    return nested.typed(page_tables(spark, folder), "rec_id", "elements")


def p2_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The table cells as a flat table, linked to their elements or rows."""
    return nested.typed(page_tables(spark, folder), "rec_id", "cells")


QUERIES = {"p2_found": p2_found, "p2_schema": p2_schema, "p2_tables": p2_tables, "p2_pages": p2_pages, "p2_elements": p2_elements, "p2_cells": p2_cells}
SQL: dict[str, str] = {}
