"""Queries of the training-text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..sources.tables import table
from . import language, mix, names, pii, scan, spam, tokenize


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id and the ids of byte_bpe_50k of every document; null and empty texts have an empty list."""
    return tokenize.encode_corpus(table(spark, folder, "documents", "doc_id", "text"))


def scanned(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    elements = table(spark, folder, "elements", "elem_id", "file", "page", "block_idx", "content", "bounding_box", "ingested_at")
    return scan.page_texts(elements, table(spark, folder, "borderless_rows", "row_id", "file", "page", "c6")), table(spark, folder, "page_meta", "file", "page", "page_width", "page_height")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Words divided at line ends, misread words, running heads and page numbers, with their right form."""
    texts, pages = scanned(spark, folder)
    return scan.found_cases(texts, scan.fit(texts, pages)).distinct()


def p1_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    """Every text of elements and remarks repaired into continuous paragraphs; what holds only furniture is empty."""
    texts, pages = scanned(spark, folder)
    return scan.repaired(texts, scan.fit(texts, pages)).select("src", "row_id", "repaired").distinct()


def personal_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, tuple]:
    """The elements and form fields with a text, and what the corpus tells of words and names."""
    elements = table(spark, folder, "elements", "elem_id", "content").filter("content is not null and content != ''")
    fields = table(spark, folder, "form_fields", "field_id", "value", "field_key").filter("value is not null and value != ''")
    return elements, fields, pii.known_of(table(spark, folder, "dictionary", "term"), elements.select(F.col("content").alias("text")), fields)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """src, row_id, kind and start of every case of personal data."""
    elements, fields, known = personal_tables(spark, folder)
    found = pii.personal_data(elements, known, "elem_id", "content").select(F.lit("elements").alias("src"), "*")
    found = found.unionByName(pii.personal_data(fields, known, "field_id", "value", "field_key").select(F.lit("form_fields").alias("src"), "*"))
    return found.select("src", "row_id", "kind", "start_pos").distinct()


def p3_redacted(spark: SparkSession, folder: str) -> DataFrame:
    """src, row_id and the text of all elements and form fields with typed placeholders in place of personal data."""
    elements, fields, known = personal_tables(spark, folder)
    texts = pii.redact(elements, known, ("elem_id",), "content").select(F.lit("elements").alias("src"), F.col("elem_id").alias("row_id"), "redacted")
    values = pii.redact(fields, known, ("field_id",), "value", "field_key").select(F.lit("form_fields").alias("src"), F.col("field_id").alias("row_id"), "redacted")
    return texts.unionByName(values).distinct()


def p4_entities(spark: SparkSession, folder: str) -> DataFrame:
    """field_id and entity of every sender or recipient that names somebody."""
    fields = table(spark, folder, "form_fields", "field_id", "field_key", "value", "ingested_at").filter(F.col("field_key").isin("to", "from"))
    return names.entities(fields)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each pair of fields that name the same person or organisation."""
    return names.same_entity_pairs(session.written(p4_entities(spark, folder), "name-entities")).distinct()


def p5_languages(spark: SparkSession, folder: str) -> DataFrame:
    """Language and confidence of every page and every prose segment."""
    model = language.fit(table(spark, folder, "documents", "doc_id", "lang", "text"))
    return language.languages(table(spark, folder, "elements"), table(spark, folder, "page_meta"), model)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pages whose label names no language or another one, and segments in another language than their page."""
    rows = p5_languages(spark, folder)
    page_case = (F.col("block_idx") == -1) & (F.col("labelled").isNull() | (F.col("labelled") != F.col("main")))
    segment_case = (F.col("block_idx") >= 0) & (F.col("lang") != F.col("main"))
    return rows.filter(page_case | segment_case).select("file", "page", "block_idx", "seg_no", "lang").distinct()


def mixture(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, folder, "documents", "doc_id", "source", "lang", "text")
    return mix.mixed(docs, table(spark, folder, "mix_targets", "source", "target_share", "max_repeats"))


def p7_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The chosen documents with their tokens and repetitions."""
    return mixture(spark, folder)[0]


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Target, reachable and actual share of tokens of every source with a target."""
    return mixture(spark, folder)[1]


def p8_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Score and smoothed probability of every page with words or links."""
    return spam.spam_pages(table(spark, folder, "documents", "doc_id", "origin", "text")).drop("origin")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id of every page that is more likely spam than not by its smoothed score."""
    return p8_pages(spark, folder).filter(F.col("p") > 0.5).select("doc_id").distinct()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": p1_found,
        "p1_paragraphs": p1_paragraphs,
        "p3_found": p3_found,
        "p3_redacted": p3_redacted,
        "p4_found": p4_found,
        "p4_entities": p4_entities,
        "p5_found": p5_found,
        "p5_languages": p5_languages,
        "p6_ids": p6_ids,
        "p7_mix": p7_mix,
        "p7_shares": p7_shares,
        "p8_found": p8_found,
        "p8_pages": p8_pages,
    }


def oracle_sql() -> dict[str, str]:
    return {}
