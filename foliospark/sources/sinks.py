"""Writers of documents and tables. Spark makes the folders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON text a line: a whole document, or a page with its document's head; empty parts are left out."""
    documents.write.mode("overwrite").json(path)


def corpus_json(documents: DataFrame) -> DataFrame:
    """All documents as one JSON text {"documents": [...]}, for corpora that fit one row; others use write_documents."""
    by_file = lambda a, b: F.when(a["file"] < b["file"], -1).when(a["file"] > b["file"], 1).otherwise(0)
    return documents.agg(F.to_json(F.struct(F.array_sort(F.collect_list(F.struct("file", "document_type", "total_pages", "pages")), by_file).alias("documents"))).alias("json"))


def write_tables(cells: DataFrame, path: str, columns: int) -> None:
    """Tables (file, page, row, col, text) as CSV files without header, a folder per file and page; places are columns."""
    wide = cells.groupBy("file", "page", "row").pivot("col", list(range(columns))).agg(F.first("text"))
    named = wide.select("file", "page", "row", *[F.coalesce(F.col(str(c)), F.lit("")).alias(f"c{c}") for c in range(columns)])
    named.repartition("file", "page").sortWithinPartitions("file", "page", "row").drop("row").write.mode("overwrite").partitionBy("file", "page").option("escape", '"').csv(path)
