"""Session and shared-folder helpers."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "foliospark") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def importable(query):
    """The query, made to run wherever the session was started from: Python workers find this package by the path that
    the driver has it from."""

    @functools.wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        env = spark.sparkContext.environment
        paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in paths:
            env["PYTHONPATH"] = os.pathsep.join([root, *paths])
        return query(spark, folder)

    return run


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir. Only in local mode, where there is one machine, a
    temporary folder is set where that is unset; elsewhere it must be set."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master or ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="foliospark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: Tables written by this driver that have not been removed.
WRITTEN: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back: lineage ends at files that outlive any
    executor, and the plan above it is made from known sizes. `forget` removes the tables when results are read."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession) -> int:
    """Removes the tables that `written` made; call it when the results that are made from them have been read."""
    n = 0
    while WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(WRITTEN.pop())
        n += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


def hash_sample(df: DataFrame, key: str, rows: int, condition: str = "true", total: int | None = None) -> DataFrame:
    """At most so many rows of df that meet the condition, chosen by a hash of the key. The share that goes into the last
    choice is set from the number of all rows (total, where it is known), so that tasks send the driver no more in all than
    about that many."""
    total = df.count() if total is None else total
    share = min(1.0, 1.5 * rows / max(1, total))
    h = F.pmod(F.xxhash64(key, F.lit(7)), F.lit(1 << 30))
    return df.filter(condition).withColumn("_h", h).filter(F.col("_h") < int(share * (1 << 30))).orderBy("_h", key).limit(rows).drop("_h")
