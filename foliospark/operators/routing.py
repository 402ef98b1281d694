"""Choice among the readings of several recognition engines.

Readings are rows (keys, engine, text, confidence), or columns <engine>_text and <engine>_conf made of them by `wide`.
Engines that cost much are called only for rows that a rule sends there: split by `needs`, call, and union back, as a
CASE around a Python function does not keep it from being called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank, likely_handwritten, quality_score

#: Confidence that engines without one of their own are given (fixed values).
PADDLE_CONF, TROCR_CONF, VLM_CONF = 75.0, 85.0, 70.0
ENGINES = ("tesseract", "paddle", "surya", "trocr")


def wide(readings: DataFrame, keys: list[str]) -> DataFrame:
    """A row per region with the text and confidence of each engine, null where it gave none."""
    of = lambda e, c: F.max(F.when(F.col("engine") == e, F.col(c))).alias(f"{e}_{'conf' if c == 'confidence' else c}")
    return readings.groupBy(*keys).agg(*[of(e, c) for e in ENGINES for c in ("text", "confidence")])


def reading(text: Column, conf: Column) -> Column:
    return F.struct(F.coalesce(text, F.lit("")).alias("text"), F.coalesce(conf, F.lit(0.0)).alias("conf"))


def engine(name: str, conf: float | None = None) -> tuple[Column, Column, Column]:
    """Text, confidence and quality of an engine's reading."""
    t = F.col(f"{name}_text")
    c = F.lit(conf) if conf is not None else F.col(f"{name}_conf")
    return t, c, quality_score(t, c)


def ensemble(readings: DataFrame, keys: list[str]) -> DataFrame:
    """Per region the reading of the highest quality times weight; of equal ones the first engine in the usual order;
    blank readings take no part."""
    order = F.array_position(F.array(*[F.lit(e) for e in ENGINES]), F.col("engine"))
    weight = F.when(F.col("engine") == "tesseract", F.when(F.col("confidence") > 70, 0.4).otherwise(0.2)).when(F.col("engine") == "paddle", 0.35).when(F.col("engine") == "surya", 0.4)
    rows = readings.filter(~blank(F.col("text"))).withColumn("weight", weight).filter("weight is not null")
    conf = F.when(F.col("engine") == "paddle", PADDLE_CONF).otherwise(F.col("confidence"))
    rows = rows.withColumn("confidence", conf).withColumn("score", quality_score(F.col("text"), F.col("confidence")) * F.col("weight"))
    best = Window.partitionBy(*keys).orderBy(F.col("score").desc(), order)
    return rows.withColumn("rn", F.row_number().over(best)).filter("rn = 1").select(*keys, "engine", "text", "confidence", "score")


def recognise(is_handwritten: Column) -> Column:
    """Handwriting: TrOCR, Paddle, Tesseract, whichever says something first. Print: Paddle if good, else the better of
    Paddle and Tesseract, which must lead by 15 unless Paddle is poor."""
    tt, tc, tq = engine("tesseract")
    pt, _, pq = engine("paddle", PADDLE_CONF)
    rt = F.col("trocr_text")
    tess, paddle = reading(tt, tc), reading(pt, F.lit(PADDLE_CONF))
    written = F.when(~blank(rt), reading(rt, F.lit(TROCR_CONF))).when(~blank(pt), paddle).otherwise(tess)
    printed = F.when(blank(pt), tess).when(pq >= 65, paddle).when(pq >= 30, F.when(tq > pq + 15, tess).otherwise(paddle)).otherwise(F.when(tq > pq, tess).otherwise(paddle))
    return F.when(is_handwritten, written).otherwise(printed)


def smart(compat: bool = False) -> Column:
    """Tesseract if very good; Surya if Tesseract is poor and it leads by 10; Paddle likewise where still doubtful; TrOCR
    where still bad; blank if all is below 20. compat: a reading of TrOCR keeps the quality of the one before."""
    tt, tc, tq = engine("tesseract")
    st, sc, sq = engine("surya")
    pt, _, pq = engine("paddle", PADDLE_CONF)
    rt, _, rq = engine("trocr", TROCR_CONF)
    pick = lambda t, c, q: F.struct(F.coalesce(t, F.lit("")).alias("text"), F.coalesce(c, F.lit(0.0)).alias("conf"), q.alias("q"))
    first = pick(tt, tc, tq)

    def surya(b: Column) -> Column:
        return F.when((b["q"] < 60) & ~blank(st) & (sq > b["q"] + 10), pick(st, sc, sq)).otherwise(b)

    def paddle(b: Column) -> Column:
        doubtful = (b["conf"] < 60) | (b["q"] < 50) | likely_handwritten(b["text"], b["conf"])
        return F.when(doubtful & ~blank(pt) & (pq > b["q"] + 10), pick(pt, F.lit(PADDLE_CONF), pq)).otherwise(b)

    def trocr(b: Column) -> Column:
        bad = (b["q"] < 45) | likely_handwritten(b["text"], b["conf"])
        return F.when(bad & ~blank(rt) & (rq > b["q"]), pick(rt, F.lit(TROCR_CONF), b["q"] if compat else rq)).otherwise(b)

    def last(b: Column) -> Column:
        return F.when(b["q"] < 20, reading(F.lit(""), F.lit(0.0))).otherwise(F.struct(b["text"].alias("text"), b["conf"].alias("conf")))

    chain = F.array(first)
    for step in (surya, paddle, trocr):
        chain = F.transform(chain, step)
    return F.when(tq > 80, reading(tt, tc)).otherwise(F.element_at(F.transform(chain, last), 1))


def routed(is_handwritten: Column, is_printed: Column, is_complex: Column) -> Column:
    """By the kind of text: handwriting as in `recognise`; print by Surya on complex pages if sure, Tesseract if good,
    Paddle if that is better; else as in `smart`."""
    tt, tc, tq = engine("tesseract")
    st, sc, _ = engine("surya")
    pt, _, pq = engine("paddle", PADDLE_CONF)
    tess = reading(tt, tc)
    printed = F.when(is_complex & ~blank(st) & (sc > 60), reading(st, sc)).when(tq > 60, tess).when((tq < 50) & ~blank(pt) & (pq > tq), reading(pt, F.lit(PADDLE_CONF))).otherwise(tess)
    return F.when(is_handwritten, recognise(F.lit(True))).when(is_printed, printed).otherwise(smart())


def retry(attempts: DataFrame, keys: list[str], enough: float = 50.0) -> DataFrame:
    """attempts (keys, strategy_no, strategy, text, confidence): per region the first that is sure enough, else the surest
    (of equal ones the first)."""
    sure = F.col("confidence") >= enough
    order = Window.partitionBy(*keys).orderBy(F.when(sure, 0).otherwise(1), F.when(sure, F.col("strategy_no")), F.col("confidence").desc(), F.col("strategy_no"))
    return attempts.withColumn("rn", F.row_number().over(order)).filter("rn = 1").drop("rn")


def needs(rows: DataFrame, condition: Column, call) -> DataFrame:
    """rows with `call` (a function of a DataFrame, as costly as it likes) applied only where the condition holds."""
    hit = F.coalesce(condition, F.lit(False))
    return call(rows.filter(hit)).unionByName(rows.filter(~hit), allowMissingColumns=True)
