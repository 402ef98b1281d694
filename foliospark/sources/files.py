"""Input files, decoded images, dictionaries, documents written before; and where engines plug in for PDF pages."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: File types of inputs, in lower and upper case only (fixed values).
TYPES = ("png", "jpg", "jpeg", "bmp", "tiff", "pdf")
GLOB = "*.{" + ",".join(t for x in TYPES for t in (x, x.upper())) + "}"
#: Where systems keep word lists (fixed values).
WORD_LISTS = ("/usr/share/dict/words", "/usr/share/dict/american-english", "/usr/dict/words")
BOX = T.StructType([T.StructField(s, T.DoubleType()) for s in ("x1", "y1", "x2", "y2")])
ELEMENT = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("type", T.StringType()), T.StructField("bounding_box", BOX), T.StructField("content", T.StringType()),
    T.StructField("meta", T.StructType([T.StructField("ocr_conf", T.DoubleType()), T.StructField("detection_source", T.StringType())])),
])
FLAG = T.StructType([T.StructField("type", T.StringType()), T.StructField("severity", T.StringType()), T.StructField("message", T.StringType()), T.StructField("affected_ratio", T.DoubleType())])
PAGE = T.StructType([
    T.StructField("page", T.IntegerType()), T.StructField("page_width", T.IntegerType()), T.StructField("page_height", T.IntegerType()), T.StructField("error", T.StringType()),
    T.StructField("elements", T.ArrayType(ELEMENT)), T.StructField("fields", T.MapType(T.StringType(), T.StringType())), T.StructField("quality_flags", T.ArrayType(FLAG)),
])
DOCUMENT = T.StructType([T.StructField("file", T.StringType()), T.StructField("document_type", T.StringType()), T.StructField("total_pages", T.IntegerType()), T.StructField("pages", T.ArrayType(PAGE))])


def input_files(spark: SparkSession, folder: str, content: bool = False) -> DataFrame:
    """path, file, is_pdf, length (and content) of the inputs of a folder, not of those below it. Without content the
    bytes are not read."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", GLOB).option("recursiveFileLookup", "false").load(folder)
    cols = ["path", F.element_at(F.split("path", "/"), -1).alias("file"), F.lower("path").endswith(".pdf").alias("is_pdf"), "length", *(["content"] if content else [])]
    return df.select(*cols)


def images(spark: SparkSession, folder: str, invalid: bool = False) -> DataFrame:
    """origin and the decoded image (height, width, nChannels, data as BGR rows); files that do not decode are left out, or
    with invalid kept with a null image."""
    df = spark.read.format("image").option("dropInvalid", str(not invalid).lower()).load(folder)
    return df.select("image.origin", F.when(F.col("image.height") > 0, F.col("image")).alias("image"))


def split_inputs(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    return files.filter("is_pdf"), files.filter("not is_pdf")


def dictionary_path(bundled: str | None = None) -> str | None:
    """The first word list there is: the bundled one, then those of the system."""
    return next((p for p in (bundled, *WORD_LISTS) if p and os.path.exists(p)), None)


def word_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("term")).filter("term != ''").distinct()


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents as sinks.write_documents writes them."""
    return spark.read.schema(DOCUMENT).json(path)
