"""Suppression and merging of overlapping boxes on a page."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import Box, iou

SIDES = ("x1", "y1", "x2", "y2")


def suppressed(boxes: DataFrame, keys: list[str], ident: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Boxes kept per keys (page and class): by falling score, a box goes if it overlaps a kept one by the threshold or
    more. Of equal scores the smaller ident comes first. One group is the boxes of one class on one page."""
    c = F.struct((-F.col(score)).alias("s"), F.col(ident).alias("id"), *SIDES)
    kind = boxes.select(c.alias("c")).schema["c"].dataType.simpleString()
    lists = boxes.groupBy(*keys).agg(F.array_sort(F.collect_list(c)).alias("c"))

    def keep(acc: Column, x: Column) -> Column:
        hit = F.exists(acc, lambda k: iou(Box.struct(k), Box.struct(x)) >= threshold)
        return F.when(hit, acc).otherwise(F.array_append(acc, x))

    kept = lists.select(*keys, F.explode(F.aggregate("c", F.array().cast(f"array<{kind}>"), keep)).alias("b"))
    return kept.select(*keys, F.col("b.id").alias(ident), (-F.col("b.s")).alias(score), *[F.col(f"b.{s}").alias(s) for s in SIDES])


def merged_overlaps(blocks: DataFrame, keys: list[str], threshold: float = 0.3) -> DataFrame:
    """Blocks (block_idx, content, sides) of a page merged in one pass: each block not yet taken grows by the later ones
    that overlap the grown box by more than the threshold; contents are joined, empty ones skipped. Each merge depends on
    the ones before, so a page is folded in Python; a page is one group."""
    schema = ", ".join([*(f"`{k}` {blocks.schema[k].dataType.simpleString()}" for k in keys), "block_idx int", "content string", *(f"{s} double" for s in SIDES), "n_merged int"])

    def over(a: list[float], b: list[float]) -> float:
        w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
        if w <= 0 or h <= 0:
            return 0.0
        area = lambda r: (r[2] - r[0]) * (r[3] - r[1])
        union = area(a) + area(b) - w * h
        return w * h / union if union > 0 else 0.0

    def fold(rest: list[tuple]) -> list[tuple]:
        taken, out = [False] * len(rest), []
        for i, (idx, text, *box) in enumerate(rest):
            if taken[i]:
                continue
            texts, n = [text], 1
            for j in range(i + 1, len(rest)):
                if not taken[j] and over(box, rest[j][2:]) > threshold:
                    taken[j], n = True, n + 1
                    other = rest[j][2:]
                    box = [min(box[0], other[0]), min(box[1], other[1]), max(box[2], other[2]), max(box[3], other[3])]
                    texts.append(rest[j][1])
            out.append((idx, " ".join(t for t in texts if t), *box, n))
        return out

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = [(*r[:-1], *m) for r in pdf.itertuples(index=False, name=None) for m in fold([(x["block_idx"], x["content"], *(x[s] for s in SIDES)) for x in r[-1]])]
            yield pd.DataFrame(rows, columns=[*keys, "block_idx", "content", *SIDES, "n_merged"])

    whole = blocks.filter(" and ".join(f"{s} is not null" for s in SIDES))
    lists = whole.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("block_idx", *SIDES, "content"))).alias("c"))
    return lists.mapInPandas(run, schema)
