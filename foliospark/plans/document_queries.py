"""Documents put together from their parts, and pixel metrics of derived images."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import images as I
from ..functions import quality as Q
from ..functions.geometry import Box, unscale
from ..sources.tables import table
from .base import BLOCKS, FIELDS, PAGES, blocks, fields, pages
from .layout_queries import quality_flags

KEYS = ["file", "page"]


def document_pages(spark: SparkSession, folder: str) -> DataFrame:
    """file, document_type, total_pages and `pages`, a page of a nested document (sources.files.DOCUMENT, a row a page):
    elements in order with boxes on the original page, fields, flags; failed pages keep their error. Every part is
    aggregated by page before it is joined, and no file is gathered in one row."""
    p = pages(spark, folder)
    o = unscale(Box.of(), F.col("sr_scale_factor"))
    box = F.when(F.col("x1").isNotNull(), F.struct(o.x1.alias("x1"), o.y1.alias("y1"), o.x2.alias("x2"), o.y2.alias("y2")))
    element = F.struct("block_idx", "elem_id", F.concat(F.lower("elem_type"), F.lit("_"), (F.col("block_idx") + 1).cast("string")).alias("id"), F.col("elem_type").alias("type"), box.alias("bounding_box"), "content", F.struct("ocr_conf", "detection_source").alias("meta"))
    drop = lambda x: x.dropFields("block_idx", "elem_id")
    e = blocks(spark, folder).join(p.select(*KEYS, "sr_scale_factor"), KEYS).groupBy(*KEYS).agg(F.transform(F.array_sort(F.collect_list(element)), drop).alias("elements"))
    f = fields(spark, folder).filter("value is not null").groupBy(*KEYS, "field_key").agg(F.min_by("value", "field_id").alias("value")).groupBy(*KEYS).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field_key", "value")))).alias("fields"))
    q = quality_flags(spark, folder).groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("type", "severity", "message", F.col("ratio").alias("affected_ratio")))).alias("quality_flags"))
    whole = p.join(e, KEYS, "left").join(f, KEYS, "left").join(q, KEYS, "left")
    page = F.struct("page", "page_width", "page_height", "error", F.coalesce("elements", F.array().cast(e.schema["elements"].dataType)).alias("elements"), "fields", "quality_flags")
    files = p.groupBy("file").agg(F.max("document_type").alias("document_type"), F.count("*").cast("int").alias("total_pages"))
    return whole.select("file", F.array(page).alias("pages")).join(files, "file").select("file", "document_type", "total_pages", "pages")


def page_document(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the parts of each nested document."""
    of = F.col("pages")[0]
    counts = F.sum(F.size(of["elements"])), F.sum(F.when(of["fields"].isNull(), 0).otherwise(F.size(of["fields"]))), F.sum(of["error"].isNotNull().cast("int"))
    return document_pages(spark, folder).groupBy("file", "document_type", "total_pages").agg(*(c.cast("int").alias(n) for c, n in zip(counts, ("n_elements", "n_fields", "n_failed"))))


def document_json(spark: SparkSession, folder: str) -> DataFrame:
    """Every page of a document as one JSON text with its document's head."""
    return document_pages(spark, folder).select("file", F.col("pages")[0]["page"].alias("page"), F.to_json(F.struct("file", "document_type", "total_pages", "pages")).alias("json"))


def vector_images(spark: SparkSession, folder: str) -> DataFrame:
    """Grey images of 64 by 64 pixels derived from the vectors: each value a square."""

    def run(batches):
        for b in batches:
            data = []
            for v in b.column(1).to_pylist():
                a = np.clip(np.array(v[:64], float) * 40 + 128, 0, 255).astype(np.uint8).reshape(8, 8)
                data.append(np.kron(a, np.ones((8, 8), np.uint8)).tobytes())
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([64] * n, pa.int32()), pa.array([64] * n, pa.int32()), pa.array([1] * n, pa.int32()), pa.array(data, pa.binary())], names=["vec_id", "height", "width", "nChannels", "data"])

    flat = table(spark, folder, "embeddings", "vec_id", "embedding").mapInArrow(run, "vec_id bigint, height int, width int, nChannels int, data binary")
    return flat.select("vec_id", F.struct("height", "width", "nChannels", "data").alias("image"))


def image_quality(spark: SparkSession, folder: str) -> DataFrame:
    m = vector_images(spark, folder).select("vec_id", I.image_metrics(F.col("image")).alias("m")).select("vec_id", "m.*")
    return m.select("vec_id", F.round("brightness", 3).alias("brightness"), F.round("contrast", 3).alias("contrast"), F.round("noise_estimate", 4).alias("noise_estimate"), Q.preset().alias("preset"))


def image_handwriting(spark: SparkSession, folder: str) -> DataFrame:
    f = vector_images(spark, folder).select("vec_id", I.image_handwriting(F.col("image")).alias("f")).select("vec_id", "f.*").withColumn("stroke_width_var_ratio", F.lit(None).cast("double"))
    return f.select("vec_id", F.round(Q.handwriting_score(F.col), 4).alias("score"), *Q.handwriting_class(Q.handwriting_score(F.col))[:1])


SQL = {
    "page_document": f"""SELECT file, max(document_type) AS document_type, count(*)::int AS total_pages, sum(coalesce(ne, 0))::int AS n_elements, sum(coalesce(nf, 0))::int AS n_fields, sum(CASE WHEN error IS NULL THEN 0 ELSE 1 END)::int AS n_failed
      FROM {PAGES} p LEFT JOIN (SELECT file, page, count(*) AS ne FROM {BLOCKS} b GROUP BY ALL) e USING (file, page) LEFT JOIN (SELECT file, page, count(DISTINCT field_key) AS nf FROM {FIELDS} f WHERE value IS NOT NULL GROUP BY ALL) f USING (file, page) GROUP BY file""",
}
QUERIES = {f.__name__: f for f in (page_document, document_json, image_quality, image_handwriting)}
