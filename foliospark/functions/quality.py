"""Rules on image metrics and handwriting features, as columns. A missing metric counts as its documented default."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Values that stand in for missing metrics (fixed values).
DEFAULTS = {"laplacian_variance": 1000.0, "brightness": 128.0, "contrast": 50.0, "noise_estimate": 5.0, "skew_angle": 0.0, "text_density": 0.1, "local_contrast_uniformity": 30.0}


def metric(name: str, default: float | None = None) -> Column:
    return F.coalesce(F.col(name), F.lit(DEFAULTS[name] if default is None else default))


def preset() -> Column:
    lap = metric("laplacian_variance")
    return F.when(lap > 1500, "noisy").when(lap > 800, "normal").when(lap > 200, "clean").otherwise("blurry")


def preset_denoising() -> Column:
    return F.when(preset() == "clean", 3).otherwise(5)


def preset_clip_limit() -> Column:
    """Of the preset, raised on dark and lowered on bright pages."""
    base = F.when(preset() == "noisy", 1.5).when(preset() == "normal", 2.0).when(preset() == "clean", 2.5).otherwise(3.0)
    light = metric("brightness")
    return F.when(light < 100, F.least(base + 1.0, F.lit(4.0))).when(light > 200, F.greatest(base - 0.5, F.lit(1.0))).otherwise(base)


def wants_super_resolution(blur: float = 80.0, noise: float = 8.0, largest: int = 2000) -> Column:
    """Blurry or noisy pages that are neither clean nor large."""
    lap, n = metric("laplacian_variance"), metric("noise_estimate", 0.0)
    large = (F.coalesce(F.col("width"), F.lit(0)) > largest) | (F.coalesce(F.col("height"), F.lit(0)) > largest)
    return ~(preset() == "clean") & ~large & ((lap < blur) | (n > noise) | ((lap < blur * 1.5) & (n > noise * 0.7)))


def parameters() -> list[Column]:
    """The eight settings of preprocessing."""
    n, lap, contrast, light = metric("noise_estimate"), metric("laplacian_variance"), metric("contrast"), metric("brightness")
    odd_light = (light > 220) | (light < 50)
    return [
        F.when(n > 15, F.least(F.lit(10), (n / 2).cast("int"))).when(n < 5, 0).otherwise(5).alias("denoising_h"), F.when(odd_light, 2.5).when(contrast < 40, 3.0).otherwise(2.0).alias("clip_limit"),
        F.when(metric("text_density") > 0.3, 4).otherwise(8).alias("grid"), (lap < 100).alias("sharpen"), (F.abs(metric("skew_angle")) > 0.5).alias("deskew"), (odd_light | (contrast < 40)).alias("enhance"),
        F.when(lap < 100, "sauvola").otherwise("adaptive").alias("binarization"), wants_super_resolution().alias("super_resolution"),
    ]


def complex_layout(n_blocks: Column | None = None) -> Column:
    few = (n_blocks if n_blocks is not None else F.lit(0)) < 3
    return (metric("text_density") > 0.15) | few | (metric("local_contrast_uniformity") > 40)


def handwriting_score(f) -> Column:
    """0 printed to 1 handwritten from features (f gives the column of a feature, null where absent): each rule adds its
    part to the score and its weight to the weights; their ratio, held to 0 to 1."""
    zero = F.lit(0.0)
    up = lambda part, v, full: F.lit(part) * F.least(v / full, F.lit(1.0))
    rules: list[tuple[Column, Column, float]] = []  # (applies, part, weight)
    svr, old = f("stroke_variation_ratio"), f("stroke_width_var_ratio")
    rules.append((svr.isNotNull(), F.when(svr > 0.4, up(0.3, svr, 0.8)).when(svr < 0.2, -0.2).otherwise(zero), 0.3))
    rules.append((svr.isNull() & old.isNotNull(), F.when(old > 0.5, up(0.3, old, 0.8)).otherwise(-0.15), 0.3))
    base = f("baseline_regularity")
    rules.append((base.isNotNull(), F.when(base > 0.3, up(0.25, base, 1.0)).when(base < 0.1, -0.15).otherwise(zero), 0.25))
    cav, area, mean, n = f("component_area_variance"), f("area_variance"), f("avg_component_area"), f("num_components")
    rules.append((cav.isNotNull(), F.when(cav > 0.8, up(0.25, cav, 2.0)).when(cav < 0.3, -0.15).otherwise(zero), 0.25))
    ratio = F.when(F.coalesce(mean, zero) > 0, area / (mean * mean))
    rules.append((cav.isNull() & area.isNotNull() & (F.coalesce(n, zero) > 3), F.when(ratio > 0.5, up(0.2, ratio, 2.0)).otherwise(zero), 0.2))
    shape, rows, lbp, entropy = f("aspect_ratio_var"), f("h_projection_var"), f("lbp_complexity"), f("histogram_entropy")
    rules.append((shape.isNotNull(), F.when(shape > 0.3, up(0.15, shape, 1.0)).otherwise(zero), 0.15))
    rules.append((rows.isNotNull(), F.when(rows > 10000, up(0.15, rows, 50000.0)).otherwise(zero), 0.15))
    rules.append((lbp.isNotNull(), F.when(lbp > 6, up(0.1, lbp - 6, 4.0)).otherwise(zero), 0.1))
    sd, gm = f("gradient_std"), f("gradient_mean")
    cv = F.when(gm > 0, sd / gm)
    rules.append((sd.isNotNull() & gm.isNotNull(), F.when(cv > 0.8, up(0.1, cv, 1.5)).otherwise(zero), 0.1))
    rules.append((entropy.isNotNull(), F.when(entropy > 3.5, up(0.05, entropy - 3.5, 2.0)).otherwise(zero), 0.05))
    score = sum((F.when(a, F.coalesce(p, zero)).otherwise(zero) for a, p, _ in rules), zero)
    weights = sum((F.when(a, F.lit(w)).otherwise(zero) for a, _, w in rules), zero)
    return F.greatest(zero, F.least(F.lit(1.0), F.when(weights > 0, score / weights).otherwise(score)))


def handwriting_class(score: Column) -> list[Column]:
    written = score > 0.55
    return [F.when(written, "handwritten").otherwise("printed").alias("text_type"), F.when(written, score).otherwise(1 - score).alias("type_confidence")]
