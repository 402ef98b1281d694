"""Matching of field labels with values on a page, and the union of fields from rules and from a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import distance, e164, iso_date, label_key
from ..functions.geometry import Box
from .spatial import near_pairs

#: What makes a value of each key comparable (dates to ISO, numbers to digits with a plus).
NORMALIZERS = {"date": iso_date, "fax": e164, "phone": e164}


def normalized(key: Column, value: Column) -> Column:
    out = value
    for k, f in NORMALIZERS.items():
        out = F.when(key == k, f(value)).otherwise(out)
    return out


def candidates(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Label and value blocks of a page in reach of each other: label_idx, key, value_idx, distance, direction.
    A label is never a value, empty contents are neither."""
    rows = blocks.filter("content is not null and content != '' and x1 is not null").select(*keys, "block_idx", "content", "x1", "y1", "x2", "y2").withColumn("key", label_key(F.col("content")))
    pairs = near_pairs(rows.filter("key is not null").drop("content"), rows.filter("key is null").drop("key"), keys, 350.0)
    d, direction = distance(Box.of("a_"), Box.of("b_"))
    return pairs.select(*keys, F.col("a_block_idx").alias("label_idx"), F.col("a_key").alias("key"), F.col("b_block_idx").alias("value_idx"), F.col("b_content").alias("value"), d.alias("distance"), direction.alias("direction")).filter("distance is not null")


def resolve(found: DataFrame, keys: list[str]) -> DataFrame:
    """One value per key and page: labels in the order of blocks, each taking the nearest value not yet taken (of equal
    distances the earlier block); a key once filled takes no other label. What is folded are the candidates of one page,
    which only labels with values in reach have."""
    c = F.struct("label_idx", "distance", "value_idx", "key", "value", "direction")
    lists = found.groupBy(*keys).agg(F.array_sort(F.collect_list(c)).alias("c"))
    kind = found.select(c.alias("c")).schema["c"].dataType.simpleString()
    start = F.array().cast(f"array<{kind}>")

    def take(acc: Column, x: Column) -> Column:
        known = F.exists(acc, lambda a: (a["key"] == x["key"]) | (a["value_idx"] == x["value_idx"]))
        return F.when(known, acc).otherwise(F.array_append(acc, x))

    return lists.select(*keys, F.explode(F.aggregate("c", start, take)).alias("f")).select(*keys, "f.key", "f.label_idx", "f.value_idx", "f.direction", "f.value", normalized(F.col("f.key"), F.col("f.value")).alias("normalized"))


def fields_by_location(blocks: DataFrame, keys: list[str]) -> DataFrame:
    return resolve(candidates(blocks, keys), keys)


def hybrid(rule: DataFrame, model: DataFrame, keys: list[str]) -> DataFrame:
    """Fields by rule, and those of the model whose key the rules left open."""
    return rule.unionByName(model.join(rule, keys, "left_anti"))
