"""Command line: runs queries over a folder of tables, or the page pipeline over a folder of images and PDF files, and
writes the results as Parquet (documents as JSON).

    spark-submit foliospark/job.py --tables DIR --output DIR [--query NAME ...] [--partitions N]
    spark-submit foliospark/job.py --inputs DIR --output DIR [--words FILE] [--engines MODULE]

--engines names a module with a function fill(registry) that fills the slots.
"""

from __future__ import annotations

import argparse
import importlib
import sys
from pathlib import Path

from pyspark.sql import SparkSession


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--tables", default=None)
    p.add_argument("--inputs", default=None, help="images and PDF files")
    p.add_argument("--words", default=None, help="word list; without it the first one of the system")
    p.add_argument("--engines", default=None, help="module that fills the slots")
    p.add_argument("--output", required=True)
    p.add_argument("--query", nargs="*", default=None, help="names; all of them without this")
    p.add_argument("--partitions", type=int, default=None, help="spark.sql.shuffle.partitions")
    args = p.parse_args(argv)
    if (args.tables is None) == (args.inputs is None):
        p.error("give either --tables or --inputs")
    return args


def documents(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    """The pipeline from files to documents."""
    from foliospark.plans import pipeline
    from foliospark.session import forget
    from foliospark.slots import Registry
    from foliospark.sources import files, sinks

    slots = Registry()
    if args.engines:
        importlib.import_module(args.engines).fill(slots)
    words = args.words or files.dictionary_path()
    terms = files.word_list(spark, words) if words else spark.createDataFrame([], "term string")
    out = pipeline.process(spark, args.inputs, slots, terms)
    sinks.write_documents(out.pop("documents"), f"{args.output}/documents")
    for name, df in out.items():
        df.write.mode("overwrite").parquet(f"{args.output}/{name}")
    forget(spark)
    return ["documents", *out]


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> list[str]:
    args = arguments(argv)
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from foliospark import catalog
    from foliospark.session import forget, importable

    spark = spark or SparkSession.builder.appName("foliospark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.partitions:
        spark.conf.set("spark.sql.shuffle.partitions", args.partitions)
    if args.inputs:
        return documents(spark, args)
    queries = catalog.queries()
    try:  # the training-text operators are an optional subpackage
        queries |= importlib.import_module("foliospark.llm").queries()
    except ImportError:
        pass
    names = args.query or list(queries)
    if unknown := [n for n in names if n not in queries]:
        raise SystemExit(f"no query {', '.join(unknown)}")
    for name in names:
        importable(queries[name])(spark, args.tables).write.mode("overwrite").parquet(f"{args.output}/{name}")
        forget(spark)
    return names


if __name__ == "__main__":
    main()
