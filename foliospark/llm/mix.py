"""Problem 7: mixing sources to target shares of tokens.

Documents fall into cells of source, language and topic. Iterative proportional fitting rakes the tokens of the cells
until sources have their target shares and languages and topics those of the corpus (or given ones), while no cell takes
more than its tokens times the repetitions its source allows. A cell's fitted tokens over its own are the expected
repetitions of its documents: the whole part is certain, the rest a probability. Documents are drawn by a hash of their
id against a threshold per cell; it starts from that probability and is calibrated on the cell's tokens by hash bucket,
so that the drawn tokens come as near to the fitted ones as a bucket allows.

Defined cases: a null source, or one without target, takes no part; a source with a target but no tokens gets none and
the other targets are scaled up to one; documents without tokens are drawn no time; an empty corpus gives an empty mix.
The cells that come to the driver are bounded by the rows of the target table times languages, topics and BUCKETS.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .language import LANGS, label_language
from .tokenize import token_counts

ROUNDS, BUCKETS, SEED = 200, 256, 11
TOPICS = ("links", "lists", "contents", "glossary", "letters", "notes")


def topic(text: str) -> Column:
    """The topic of a document by its form: links, lists with amounts, contents pages, glossaries, letters, notes."""
    c = F.col(text)
    lines = F.greatest(F.lit(1), F.size(F.split(c, "\n")))
    count = lambda p: F.regexp_count(c, F.lit(p))
    return (
        F.when(count(r"https?://|hxxps?://|www\.|href=") * 2 >= lines, "links")
        .when(count(r"(?m)\.{4,} *\d+ *$") * 2 >= lines, "contents")
        .when((lines > 2) & (count(r"(?m)\d[\d.,]* *$") * 2 >= lines), "lists")
        .when((lines > 2) & (count(r"(?m)^[^:\n]{3,40}: ") * 2 >= lines), "glossary")
        .when(F.length(c) >= 400, "letters")
        .otherwise("notes")
    )


@dataclass
class Cells:
    sources: list[str]
    shares: np.ndarray  # of sources, scaled to one over those with tokens
    repeats: np.ndarray
    tokens: np.ndarray  # source x language x topic


def fit(cells: Cells, language_shares: np.ndarray | None = None, topic_shares: np.ndarray | None = None, total: float | None = None) -> np.ndarray:
    """Fitted tokens by cell. total: tokens of the mix; without it as many as the caps allow."""
    caps = cells.tokens * cells.repeats[:, None, None]
    room = caps.sum((1, 2))
    with np.errstate(divide="ignore", invalid="ignore"):
        most = np.where(cells.shares > 0, room / cells.shares, np.inf).min() if (cells.shares > 0).any() else 0.0
    size = most if total is None else min(total, most)
    of = lambda axis: cells.tokens.sum(axis) / max(1, cells.tokens.sum())
    goals = ((of((0, 2)) if language_shares is None else language_shares) * size, (of((0, 1)) if topic_shares is None else topic_shares) * size)
    x = cells.tokens.astype(float)
    for _ in range(ROUNDS):
        for axis, goal in ((1, goals[0]), (2, goals[1]), (0, cells.shares * size)):
            other = tuple(a for a in range(3) if a != axis)
            shape = tuple(-1 if a == axis else 1 for a in range(3))
            for _ in range(8 if axis == 0 else 1):  # what the caps cut off goes to the source's other cells
                have = x.sum(other)
                x = np.minimum(caps, x * np.divide(goal, have, out=np.zeros_like(have), where=have > 0).reshape(shape))
    return x


def counted(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, source, lang, topic and tokens of the documents."""
    picked = docs.select("doc_id", "source", F.coalesce(label_language(F.col("lang")), F.lit("other")).alias("lang"), F.coalesce(topic("text"), F.lit("notes")).alias("topic"), "text")
    return token_counts(picked, "text", ("doc_id", "source", "lang", "topic"), path)


def mixed(docs: DataFrame, targets: DataFrame, total: float | None = None, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The chosen documents (doc_id, source, lang, topic, n_tokens, repeats) and, per source, the shares reached."""
    spark = docs.sparkSession
    sized = written(counted(docs, path), "mix-tokens")
    wanted = {r.source: (float(r.target_share or 0), int(r.max_repeats or 0)) for r in targets.collect() if r.source is not None}
    bucket = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(BUCKETS)).cast("int")
    taking = sized.join(F.broadcast(targets.filter("source is not null").select("source").distinct()), "source", "left_semi").filter("n_tokens > 0").withColumn("bucket", bucket)
    rows = taking.groupBy("source", "lang", "topic", "bucket").agg(F.sum("n_tokens").alias("t")).collect()
    sources, langs = sorted(wanted), [*LANGS, "other"]
    by_bucket = np.zeros((len(sources), len(langs), len(TOPICS), BUCKETS))
    for r in rows:
        by_bucket[sources.index(r.source), langs.index(r.lang), TOPICS.index(r.topic), r.bucket] = r.t
    tokens = by_bucket.sum(3)
    shares = np.array([wanted[s][0] for s in sources]) * (tokens.sum((1, 2)) > 0)
    shares = shares / shares.sum() if shares.sum() else shares
    repeats = np.array([wanted[s][1] for s in sources], float)
    fitted = fit(Cells(sources, shares, repeats, tokens), total=total)
    plan, carry = [], np.zeros(len(sources))
    for s, l, t in zip(*np.nonzero(tokens)):
        times = min(fitted[s, l, t] / tokens[s, l, t], repeats[s])
        whole = int(np.floor(times + 1e-9))
        rest = fitted[s, l, t] - whole * tokens[s, l, t] + carry[s]
        ends = np.concatenate([[0], by_bucket[s, l, t].cumsum()])
        cut = int(np.abs(ends - rest).argmin()) if whole < repeats[s] else 0
        carry[s] = rest - ends[cut]  # what a bucket's grain leaves goes on to the source's next cell
        plan.append((sources[s], langs[l], TOPICS[t], whole, cut))
    schema = "source string, lang string, topic string, whole int, cut int"
    chosen = (
        taking.join(F.broadcast(spark.createDataFrame(plan, schema)), ["source", "lang", "topic"])
        .withColumn("repeats", F.col("whole") + (F.col("bucket") < F.col("cut")).cast("int"))
        .filter("repeats > 0")
        .select("doc_id", "source", "lang", "topic", "n_tokens", "repeats")
    )
    per = chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("documents"), F.max("repeats").alias("most_repeats"))
    goal = spark.createDataFrame([(s, wanted[s][0], float(shares[i]), wanted[s][1]) for i, s in enumerate(sources)], "source string, target_share double, reachable_share double, max_repeats int")
    sums = per.agg(F.sum("tokens").alias("all_tokens"))
    report = goal.join(per, "source", "left").crossJoin(F.broadcast(sums)).select(
        "source", "target_share", F.round("reachable_share", 6).alias("reachable_share"), "max_repeats", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"),
        F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), F.round(F.coalesce("tokens", F.lit(0)) / F.greatest(F.coalesce("all_tokens", F.lit(1)), F.lit(1)), 6).alias("actual_share"),
    )
    return chosen, report
