"""Streams over what arrives: new input files, elements delivered again, counts by window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import GLOB

BINARY_FILE = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()), T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def new_files(spark: SparkSession, folder: str) -> DataFrame:
    """Input files of a folder as they arrive."""
    return spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", GLOB).load(folder)


def first_deliveries(rows: DataFrame, ident: str, time: str, late: str = "10 days") -> DataFrame:
    """The first delivery of each record; another one within the lateness is dropped. Rows without a time go through as
    they are, as no watermark can close them."""
    timed = rows.filter(F.col(time).isNotNull()).withWatermark(time, late).dropDuplicatesWithinWatermark([ident])
    return timed.unionByName(rows.filter(F.col(time).isNull()))


def windowed(rows: DataFrame, time: str, keys: list[str], size: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Rows counted by window and keys; windows close when the watermark passes them."""
    w = F.window(time, size, slide) if slide else F.window(time, size)
    return rows.withWatermark(time, late).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def sessions(rows: DataFrame, time: str, keys: list[str], gap: str, late: str = "10 minutes") -> DataFrame:
    """Rows counted by session: a gap ends it."""
    return rows.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")
