"""Statistics of features: moments, histograms, entropy, runs and peaks of profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def moments(value: Column) -> list[Column]:
    """Population moments; skewness needs 3 values, excess kurtosis 4, else (or without spread) they are 0."""
    n, sd = F.count(value), F.stddev_pop(value)
    some = lambda f, least: F.when((n >= least) & (sd > 0), f(value)).otherwise(0.0)
    return [F.avg(value).alias("mean"), F.var_pop(value).alias("variance"), sd.alias("std"), some(F.skewness, 3).alias("skewness"), some(F.kurtosis, 4).alias("kurtosis")]


def histogram(df: DataFrame, keys: list[str], value: Column, low: float, high: float, bins: int = 32) -> DataFrame:
    """keys, bin, n: values counted in equal bins; the top value is in the last bin, values beyond are not counted."""
    v = df.select(*keys, value.alias("v")).filter((F.col("v") >= low) & (F.col("v") <= high))
    bin_ = F.least(F.lit(bins - 1), F.floor((F.col("v") - low) / ((high - low) / bins)).cast("int"))
    return v.groupBy(*keys, bin_.alias("bin")).agg(F.count("*").alias("n"))


def entropy(counts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, entropy (base 2) of histogram counts, and the number of inner peaks (bins above both neighbours)."""
    p = F.col("n") / F.sum("n").over(Window.partitionBy(*keys))
    order = Window.partitionBy(*keys).orderBy("bin")
    before = F.when(F.lag("bin").over(order) == F.col("bin") - 1, F.lag("n").over(order)).otherwise(0)
    after = F.when(F.lead("bin").over(order) == F.col("bin") + 1, F.lead("n").over(order)).otherwise(0)
    peak = (F.col("n") > before) & (F.col("n") > after) & (F.col("bin") > 0)
    rows = counts.withColumn("p", p).withColumn("peak", peak)
    return rows.groupBy(*keys).agg((-F.sum(F.col("p") * F.log2("p"))).alias("entropy"), F.sum(F.col("peak").cast("int")).alias("n_peaks"))


def profile_runs(profile: DataFrame, keys: list[str], pos: str, value: str, share: float = 0.10, least: int = 5, pad: int = 3) -> DataFrame:
    """keys, start, end of the stretches of a profile above a share of its maximum that are longer than `least` (one that
    reaches the end is kept at any length), padded within the profile."""
    whole = Window.partitionBy(*keys)
    rows = profile.withColumn("_on", F.col(value) > F.max(value).over(whole) * share).withColumn("_last", F.max(pos).over(whole))
    order = whole.orderBy(pos)
    g = F.sum((~F.col("_on")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    runs = rows.withColumn("_g", g).filter("_on").groupBy(*keys, "_g").agg(F.min(pos).alias("a"), (F.max(pos) + 1).alias("b"), F.first("_last").alias("_last"))
    kept = runs.filter((F.col("b") - F.col("a") > least) | (F.col("b") > F.col("_last")))
    return kept.select(*keys, F.greatest(F.lit(0), F.col("a") - pad).alias("start"), F.least(F.col("_last") + 1, F.col("b") + pad).alias("end"))


def peak_spacing(profile: DataFrame, keys: list[str], pos: str, value: str, share: float = 0.3) -> DataFrame:
    """keys, n_peaks, irregularity: standard deviation over mean of the distances between peaks of at least a share of the
    maximum; 0 with fewer than three peaks."""
    whole = Window.partitionBy(*keys)
    order = whole.orderBy(pos)
    peak = (F.col(value) > F.lag(value).over(order)) & (F.col(value) > F.lead(value).over(order)) & (F.col(value) >= F.max(value).over(whole) * share)
    peaks = profile.withColumn("_p", peak).filter("_p")
    gaps = peaks.withColumn("_d", F.col(pos) - F.lag(pos).over(order))
    out = gaps.groupBy(*keys).agg(F.count("*").alias("n_peaks"), F.coalesce(F.when(F.count("_d") >= 2, F.stddev_pop("_d") / F.avg("_d")), F.lit(0.0)).alias("irregularity"))
    return profile.select(*keys).distinct().join(out, keys, "left").select(*keys, F.coalesce("n_peaks", F.lit(0)).alias("n_peaks"), F.coalesce("irregularity", F.lit(0.0)).alias("irregularity"))
