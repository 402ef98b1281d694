"""Queries of image quality rules, handwriting scores, language decisions and routing among engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import quality as Q
from ..operators import routing as R
from .base import BLOCKS, METRICS, blocks, metrics
from .text_queries import handwritten as sql_handwritten
from .text_queries import quality as sql_quality
from .text_queries import strip as sql_strip


def sr_decision(spark: SparkSession, folder: str) -> DataFrame:
    return metrics(spark, folder).select("file", Q.preset().alias("preset"), Q.preset_denoising().alias("preset_denoising"), F.round(Q.preset_clip_limit(), 2).alias("preset_clip"), Q.wants_super_resolution().alias("super_resolution"), Q.complex_layout(F.lit(5)).alias("complex"), Q.complex_layout().alias("complex_blind"))


def preprocess_params(spark: SparkSession, folder: str) -> DataFrame:
    return metrics(spark, folder).select("file", *Q.parameters())


FEATURES = {
    "stroke_variation_ratio": ("width % 10 > 2", "contrast / 100"), "stroke_width_var_ratio": ("true", "text_density * 2"), "baseline_regularity": ("width % 7 > 0", "noise_estimate / 20"), "component_area_variance": ("height % 3 > 0", "brightness / 100"),
    "area_variance": ("true", "laplacian_variance * 3"), "avg_component_area": ("true", "contrast / 2"), "num_components": ("true", "local_contrast_uniformity / 5"), "aspect_ratio_var": ("true", "contrast / 150"),
    "h_projection_var": ("true", "laplacian_variance * 30"), "lbp_complexity": ("true", "noise_estimate / 2"), "gradient_std": ("true", "brightness"), "gradient_mean": ("true", "contrast * 2"), "histogram_entropy": ("height % 5 > 0", "brightness / 40"),
}


def handwriting_score(spark: SparkSession, folder: str) -> DataFrame:
    """Over features derived from the metrics, some of them absent."""
    rows = metrics(spark, folder).select("file", *[F.expr(f"case when {ok} then {v} end").cast("double").alias(n) for n, (ok, v) in FEATURES.items()])
    scored = rows.select("file", Q.handwriting_score(F.col).alias("s"))
    return scored.select("file", F.round(F.col("s") + 1e-9, 3).alias("score"), Q.handwriting_class(F.col("s"))[0], F.round(Q.handwriting_class(F.col("s"))[1] + 1e-9, 3).alias("type_confidence"))


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Readings of four engines derived from the elements: as they are, with digits for letters, cut, with capital vowels."""
    b = blocks(spark, folder).filter("elem_type = 'TextBlock'").select("elem_id", F.coalesce("content", F.lit("")).alias("c"), F.coalesce("ocr_conf", F.lit(0.0)).alias("conf"))
    s = lambda e, t, k: F.struct(F.lit(e).alias("engine"), t.alias("text"), k.cast("double").alias("confidence"))
    c, conf, i = F.col("c"), F.col("conf"), F.col("elem_id")
    four = F.array(s("tesseract", c, conf), s("paddle", F.when(i % 7 == 0, "").otherwise(F.translate(c, "oe", "0#")), F.lit(75.0)), s("surya", F.substring(c, F.lit(1), F.greatest(F.lit(1), (F.length(c) / 2).cast("int"))), (i * 13) % 101), s("trocr", F.when(i % 5 == 0, " ").otherwise(F.translate(c, "aeiou", "AEIOU")), F.lit(85.0)))
    return b.select("elem_id", F.inline(four))


def ocr_ensemble(spark: SparkSession, folder: str) -> DataFrame:
    return R.ensemble(readings(spark, folder).filter("engine != 'trocr'"), ["elem_id"]).select("elem_id", "engine", "confidence")


def ocr_route(spark: SparkSession, folder: str) -> DataFrame:
    """The live route, the smart one and the one by kind of text, of every region."""
    w = R.wide(readings(spark, folder), ["elem_id"])
    i = F.col("elem_id")
    pick = lambda c, n: (c["conf"].alias(f"{n}_conf"), F.length(c["text"]).alias(f"{n}_length"))
    out = w.select("elem_id", R.recognise(i % 4 == 0).alias("a"), R.smart().alias("b"), R.routed(i % 4 == 0, i % 4 == 1, i % 3 == 0).alias("c"))
    return out.select("elem_id", *pick(F.col("a"), "live"), *pick(F.col("b"), "smart"), *pick(F.col("c"), "routed"))


def ocr_retry(spark: SparkSession, folder: str) -> DataFrame:
    b = blocks(spark, folder).filter("elem_type = 'TextBlock'").select("elem_id", F.coalesce("ocr_conf", F.lit(0.0)).alias("conf"))
    names = ("original", "contrast", "sharpen", "clean", "scale")
    tries = F.array(*[F.struct(F.lit(k).alias("strategy_no"), F.lit(n).alias("strategy"), F.lit("").alias("text"), ((F.col("conf") * 7 + F.col("elem_id") * (11 + 6 * k)) % 83).alias("confidence")) for k, n in enumerate(names)])
    return R.retry(b.select("elem_id", F.inline(tries)), ["elem_id"]).select("elem_id", "strategy", F.round("confidence", 4).alias("confidence"))


def llm_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks that a language model would be asked to correct, per confidence band; only they would reach the engine."""
    b = blocks(spark, folder).filter((F.col("ocr_conf") > 30) & (F.col("ocr_conf") < 85) & (F.length("content") > 5))
    return b.groupBy(F.floor(F.col("ocr_conf") / 10).cast("int").alias("band")).agg(F.count("*").alias("n"))


def hw(n: str) -> str:
    ok, v = FEATURES[n]
    return f"CASE WHEN {ok} THEN {v} END AS {n}"


PRESET = "CASE WHEN laplacian_variance > 1500 THEN 'noisy' WHEN laplacian_variance > 800 THEN 'normal' WHEN laplacian_variance > 200 THEN 'clean' ELSE 'blurry' END"
BASE = f"CASE {PRESET} WHEN 'noisy' THEN 1.5 WHEN 'normal' THEN 2.0 WHEN 'clean' THEN 2.5 ELSE 3.0 END"
SR = f"({PRESET} <> 'clean' AND NOT (width > 2000 OR height > 2000) AND (laplacian_variance < 80 OR noise_estimate > 8 OR (laplacian_variance < 120 AND noise_estimate > 5.6)))"
up = lambda part, v, full: f"{part} * least(({v}) / {full}, 1.0)"
HW = [
    ("stroke_variation_ratio IS NOT NULL", f"CASE WHEN stroke_variation_ratio > 0.4 THEN {up(0.3, 'stroke_variation_ratio', 0.8)} WHEN stroke_variation_ratio < 0.2 THEN -0.2 ELSE 0 END", 0.3),
    ("stroke_variation_ratio IS NULL AND stroke_width_var_ratio IS NOT NULL", f"CASE WHEN stroke_width_var_ratio > 0.5 THEN {up(0.3, 'stroke_width_var_ratio', 0.8)} ELSE -0.15 END", 0.3),
    ("baseline_regularity IS NOT NULL", f"CASE WHEN baseline_regularity > 0.3 THEN {up(0.25, 'baseline_regularity', 1.0)} WHEN baseline_regularity < 0.1 THEN -0.15 ELSE 0 END", 0.25),
    ("component_area_variance IS NOT NULL", f"CASE WHEN component_area_variance > 0.8 THEN {up(0.25, 'component_area_variance', 2.0)} WHEN component_area_variance < 0.3 THEN -0.15 ELSE 0 END", 0.25),
    ("component_area_variance IS NULL AND num_components > 3", f"CASE WHEN avg_component_area > 0 AND area_variance / (avg_component_area * avg_component_area) > 0.5 THEN {up(0.2, 'area_variance / (avg_component_area * avg_component_area)', 2.0)} ELSE 0 END", 0.2),
    ("aspect_ratio_var IS NOT NULL", f"CASE WHEN aspect_ratio_var > 0.3 THEN {up(0.15, 'aspect_ratio_var', 1.0)} ELSE 0 END", 0.15),
    ("h_projection_var IS NOT NULL", f"CASE WHEN h_projection_var > 10000 THEN {up(0.15, 'h_projection_var', 50000.0)} ELSE 0 END", 0.15),
    ("lbp_complexity IS NOT NULL", f"CASE WHEN lbp_complexity > 6 THEN {up(0.1, 'lbp_complexity - 6', 4.0)} ELSE 0 END", 0.1),
    ("gradient_std IS NOT NULL", f"CASE WHEN gradient_mean > 0 AND gradient_std / gradient_mean > 0.8 THEN {up(0.1, 'gradient_std / gradient_mean', 1.5)} ELSE 0 END", 0.1),
    ("histogram_entropy IS NOT NULL", f"CASE WHEN histogram_entropy > 3.5 THEN {up(0.05, 'histogram_entropy - 3.5', 2.0)} ELSE 0 END", 0.05),
]
HW_SCORE = "greatest(0.0, least(1.0, (" + " + ".join(f"CASE WHEN {a} THEN {p} ELSE 0 END" for a, p, _ in HW) + ") / (" + " + ".join(f"CASE WHEN {a} THEN {w} ELSE 0 END" for a, _, w in HW) + ")))"
TB = f"(SELECT elem_id, coalesce(content, '') AS c, coalesce(ocr_conf, 0.0) AS conf FROM {BLOCKS} b WHERE elem_type = 'TextBlock')"
WIDE = f"""(SELECT elem_id, c AS tt, conf AS tc, CASE WHEN elem_id % 7 = 0 THEN '' ELSE translate(c, 'oe', '0#') END AS pt, c[1:greatest(1, cast(floor(length(c) / 2) AS int))] AS st, cast((elem_id * 13) % 101 AS double) AS sc, CASE WHEN elem_id % 5 = 0 THEN ' ' ELSE translate(c, 'aeiou', 'AEIOU') END AS rt FROM {TB} x)"""
QUAL = f"""(SELECT *, {sql_quality('tt', 'tc')} AS tq, {sql_quality('pt', '75.0')} AS pq, {sql_quality('st', 'sc')} AS sq, {sql_quality('rt', '85.0')} AS rq,
  {sql_strip('pt')} = '' AS pb, {sql_strip('st')} = '' AS sb, {sql_strip('rt')} = '' AS rb FROM {WIDE} w)"""
R_ = lambda t, c: f"{{'t': {t}, 'c': cast({c} AS double)}}"
WRITTEN = f"CASE WHEN NOT rb THEN {R_('rt', 85)} WHEN NOT pb THEN {R_('pt', 75)} ELSE {R_('tt', 'tc')} END"
LIVE = f"CASE WHEN elem_id % 4 = 0 THEN {WRITTEN} WHEN pb THEN {R_('tt', 'tc')} WHEN pq >= 65 THEN {R_('pt', 75)} WHEN pq >= 30 THEN CASE WHEN tq > pq + 15 THEN {R_('tt', 'tc')} ELSE {R_('pt', 75)} END WHEN tq > pq THEN {R_('tt', 'tc')} ELSE {R_('pt', 75)} END"
STEPS = f"""(SELECT *, CASE WHEN b2.q < 20 THEN {R_("''", 0)} ELSE {R_('b2.t', 'b2.c')} END AS sm FROM (SELECT *, CASE WHEN (b1.q < 45 OR {sql_handwritten('b1.t', 'b1.c')}) AND NOT rb AND rq > b1.q THEN {{'t': rt, 'c': 85.0::double, 'q': rq}} ELSE b1 END AS b2
  FROM (SELECT *, CASE WHEN (b0.c < 60 OR b0.q < 50 OR {sql_handwritten('b0.t', 'b0.c')}) AND NOT pb AND pq > b0.q + 10 THEN {{'t': pt, 'c': 75.0::double, 'q': pq}} ELSE b0 END AS b1
  FROM (SELECT *, CASE WHEN tq < 60 AND NOT sb AND sq > tq + 10 THEN {{'t': st, 'c': sc, 'q': sq}} ELSE {{'t': tt, 'c': tc, 'q': tq}} END AS b0 FROM {QUAL} q) s0) s1) s2)"""
SMART = f"CASE WHEN tq > 80 THEN {R_('tt', 'tc')} ELSE sm END"
ROUTED = f"CASE WHEN elem_id % 4 = 0 THEN {WRITTEN} WHEN elem_id % 4 = 1 THEN CASE WHEN elem_id % 3 = 0 AND NOT sb AND sc > 60 THEN {R_('st', 'sc')} WHEN tq > 60 THEN {R_('tt', 'tc')} WHEN tq < 50 AND NOT pb AND pq > tq THEN {R_('pt', 75)} ELSE {R_('tt', 'tc')} END ELSE {SMART} END"
SQL = {
    "sr_decision": f"""SELECT file, {PRESET} AS preset, CASE WHEN {PRESET} = 'clean' THEN 3 ELSE 5 END AS preset_denoising, round(CASE WHEN brightness < 100 THEN least({BASE} + 1.0, 4.0) WHEN brightness > 200 THEN greatest({BASE} - 0.5, 1.0) ELSE {BASE} END, 2)::double AS preset_clip,
      {SR} AS super_resolution, text_density > 0.15 OR local_contrast_uniformity > 40 AS complex, true AS complex_blind FROM {METRICS} m""",
    "preprocess_params": f"""SELECT file, CASE WHEN noise_estimate > 15 THEN least(10, cast(floor(noise_estimate / 2) AS int)) WHEN noise_estimate < 5 THEN 0 ELSE 5 END AS denoising_h, (CASE WHEN brightness > 220 OR brightness < 50 THEN 2.5 WHEN contrast < 40 THEN 3.0 ELSE 2.0 END)::double AS clip_limit,
      CASE WHEN text_density > 0.3 THEN 4 ELSE 8 END AS grid, laplacian_variance < 100 AS sharpen, abs(skew_angle) > 0.5 AS deskew, brightness > 220 OR brightness < 50 OR contrast < 40 AS enhance, CASE WHEN laplacian_variance < 100 THEN 'sauvola' ELSE 'adaptive' END AS binarization, {SR} AS super_resolution FROM {METRICS} m""",
    "handwriting_score": f"SELECT file, round(s + 1e-9, 3) AS score, CASE WHEN s > 0.55 THEN 'handwritten' ELSE 'printed' END AS text_type, round(CASE WHEN s > 0.55 THEN s ELSE 1 - s END + 1e-9, 3) AS type_confidence FROM (SELECT file, {HW_SCORE} AS s FROM (SELECT file, {', '.join(hw(n) for n in FEATURES)} FROM {METRICS} m) f) z",
    "ocr_ensemble": f"""WITH r AS (SELECT elem_id, 'tesseract' AS engine, 1 AS o, tt AS t, tc AS confidence, tq * CASE WHEN tc > 70 THEN 0.4 ELSE 0.2 END AS score FROM {QUAL} q UNION ALL SELECT elem_id, 'paddle', 2, pt, 75.0, pq * 0.35 FROM {QUAL} q UNION ALL SELECT elem_id, 'surya', 3, st, sc, sq * 0.4 FROM {QUAL} q)
      SELECT elem_id, engine, confidence FROM (SELECT *, row_number() OVER (PARTITION BY elem_id ORDER BY score DESC, o) AS rn FROM r WHERE {sql_strip('t')} <> '') z WHERE rn = 1""",
    "ocr_route": f"SELECT elem_id, a.c AS live_conf, length(a.t) AS live_length, b.c AS smart_conf, length(b.t) AS smart_length, d.c AS routed_conf, length(d.t) AS routed_length FROM (SELECT elem_id, {LIVE} AS a, {SMART} AS b, {ROUTED} AS d FROM {STEPS} s) z",
    "ocr_retry": f"""WITH t AS (SELECT elem_id, k, ['original', 'contrast', 'sharpen', 'clean', 'scale'][k + 1] AS strategy, (conf * 7 + elem_id * (11 + 6 * k)) % 83 AS confidence FROM {TB} x, (SELECT unnest(range(5)) AS k) n)
      SELECT elem_id, strategy, round(confidence, 4) AS confidence FROM (SELECT *, row_number() OVER (PARTITION BY elem_id ORDER BY CASE WHEN confidence >= 50 THEN 0 ELSE 1 END, CASE WHEN confidence >= 50 THEN k END, confidence DESC, k) AS rn FROM t) z WHERE rn = 1""",
    "llm_gate": f"SELECT cast(floor(ocr_conf / 10) AS int) AS band, count(*) AS n FROM {BLOCKS} b WHERE ocr_conf > 30 AND ocr_conf < 85 AND length(content) > 5 GROUP BY ALL",
}
QUERIES = {f.__name__: f for f in (sr_decision, preprocess_params, handwriting_score, ocr_ensemble, ocr_route, ocr_retry, llm_gate)}
