"""Pixel operations in numpy, and Arrow functions over Spark image structs.

Images are uint8 arrays of rows; colour ones are BGR. They replace no imaging library bit for bit: they give the metrics,
features and filters that the rules of functions.quality and the engines' slots need.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = "laplacian_variance double, brightness double, contrast double, noise_estimate double, skew_angle double, text_density double, local_contrast_uniformity double, width int, height int"
FEATURES = "lbp_complexity double, num_components double, avg_component_area double, area_variance double, component_area_variance double, aspect_ratio_var double, h_projection_var double, stroke_variation_ratio double, baseline_regularity double, gradient_mean double, gradient_std double, histogram_entropy double"


def decode(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return a[:, :, 0] if channels == 1 else a[:, :, :3]


def gray(img: np.ndarray) -> np.ndarray:
    if img.ndim == 2:
        return img
    return np.rint(img[:, :, 0] * 0.114 + img[:, :, 1] * 0.587 + img[:, :, 2] * 0.299).astype(np.uint8)


def windows(g: np.ndarray, size: int = 3) -> np.ndarray:
    pad = size // 2
    return np.lib.stride_tricks.sliding_window_view(np.pad(g, pad, mode="edge"), (size, size))


def laplacian(g: np.ndarray) -> np.ndarray:
    p = np.pad(g.astype(float), 1, mode="reflect") if min(g.shape) > 1 else np.pad(g.astype(float), 1, mode="edge")
    return p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]


def median(g: np.ndarray, size: int = 5) -> np.ndarray:
    return np.median(windows(g, size), axis=(2, 3)).astype(np.uint8)


def box_mean(g: np.ndarray, size: int) -> np.ndarray:
    pad = size // 2
    c = np.pad(np.pad(g.astype(float), pad, mode="edge").cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    h, w = g.shape
    return (c[size : size + h, size : size + w] - c[:h, size : size + w] - c[size : size + h, :w] + c[:h, :w]) / size**2


def otsu(g: np.ndarray) -> int:
    """The threshold of the widest variance between the two classes."""
    n = np.bincount(g.ravel(), minlength=256).astype(float)
    w = n.cumsum()
    m = (n * np.arange(256)).cumsum()
    total, mean = w[-1], m[-1]
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (mean * w / total - m) ** 2 / (w * (total - w))
    return int(np.nan_to_num(between, nan=-1, posinf=-1).argmax())


def ink(g: np.ndarray) -> np.ndarray:
    """Dark pixels by Otsu's threshold."""
    return g <= otsu(g)


def skew_angle(g: np.ndarray, most: float = 5.0, step: float = 0.5) -> float:
    """The shear, in degrees, under which rows of ink are sharpest."""
    dark = ink(g)
    ys, xs = np.nonzero(dark)
    if len(ys) < 10:
        return 0.0
    best, found = -1.0, 0.0
    for a in np.arange(-most, most + step / 2, step):
        rows = np.bincount(np.rint(ys - xs * np.tan(np.radians(a)) + g.shape[1]).astype(int))
        score = float((np.diff(rows.astype(float)) ** 2).sum())
        if score > best + 1e-9 or (abs(score - best) <= 1e-9 and abs(a) < abs(found)):
            best, found = score, float(a)
    return found


def metrics(img: np.ndarray) -> dict[str, float]:
    g = gray(img)
    local = np.sqrt(np.maximum(box_mean(g.astype(float) ** 2, 50) - box_mean(g, 50) ** 2, 0))
    return {
        "laplacian_variance": float(laplacian(g).var()), "brightness": float(g.mean()), "contrast": float(g.std()), "noise_estimate": float(np.abs(g.astype(float) - median(g)).mean()), "skew_angle": skew_angle(g),
        "text_density": float(ink(g).mean()) if g.min() < g.max() else 0.0, "local_contrast_uniformity": float(local.std()), "width": g.shape[1], "height": g.shape[0],
    }


def components(mask: np.ndarray) -> tuple[np.ndarray, int]:
    """Labels (from 1) of the 4-connected parts of a mask, and their number."""
    labels = np.zeros(mask.shape, np.int32)
    parent = [0]

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for y in range(mask.shape[0]):
        for x in np.flatnonzero(mask[y]):
            up, left = (labels[y - 1, x] if y else 0), (labels[y, x - 1] if x else 0)
            if not up and not left:
                parent.append(len(parent))
                labels[y, x] = len(parent) - 1
            else:
                labels[y, x] = up or left
                if up and left:
                    a, b = root(up), root(left)
                    parent[max(a, b)] = min(a, b)
    roots = np.array([root(i) for i in range(len(parent))])
    kept = np.unique(roots[1:]) if len(parent) > 1 else np.zeros(0, int)
    number = np.zeros(len(parent), np.int32)
    number[kept] = np.arange(1, len(kept) + 1)
    return number[roots[labels]] * (labels > 0), len(kept)


def handwriting_features(img: np.ndarray) -> dict[str, float] | None:
    """Texture, components, strokes and statistics; None for images under 10 pixels."""
    g = gray(img)
    if min(g.shape) < 10:
        return None
    f = g.astype(float)
    near = windows(g)
    bits = sum(((near[:, :, dy, dx] >= g).astype(int) << k) for k, (dy, dx) in enumerate(((0, 0), (0, 1), (0, 2), (1, 2), (2, 2), (2, 1), (2, 0), (1, 0))))
    share = np.bincount(bits.ravel(), minlength=256) / bits.size
    dark = ink(g) if g.min() < g.max() else np.zeros(g.shape, bool)
    labels, n = components(dark)
    areas = np.bincount(labels.ravel(), minlength=n + 1)[1:].astype(float)
    ratios = []
    for i in range(1, n + 1):
        ys, xs = np.nonzero(labels == i)
        ratios.append((np.ptp(xs) + 1) / (np.ptp(ys) + 1))
    rows = dark.sum(1).astype(float)
    runs = [len(r) for line in dark for r in np.split(line, np.flatnonzero(np.diff(line.astype(int))) + 1) if len(r) and r[0]]
    feet = [np.flatnonzero(c).max() for c in dark.T if c.any()]
    gy, gx = np.gradient(f)
    grad = np.hypot(gx, gy)
    hist = np.histogram(g, 32, (0, 256))[0] / g.size
    ent = lambda p: float(-(p[p > 0] * np.log2(p[p > 0])).sum())
    ratio = lambda v: float(np.std(v) / np.mean(v)) if len(v) and np.mean(v) > 0 else 0.0
    return {
        "lbp_complexity": ent(share), "num_components": float(n), "avg_component_area": float(areas.mean()) if n else 0.0, "area_variance": float(areas.var()) if n else 0.0, "component_area_variance": ratio(areas),
        "aspect_ratio_var": float(np.var(ratios)) if ratios else 0.0, "h_projection_var": float(rows.var()), "stroke_variation_ratio": ratio(runs), "baseline_regularity": ratio(feet),
        "gradient_mean": float(grad.mean()), "gradient_std": float(grad.std()), "histogram_entropy": ent(hist),
    }


# ---- filters: recognition tries them one after another -----------------------------------------------------------------


def equalize(g: np.ndarray, clip: float = 2.0, grid: int = 8) -> np.ndarray:
    """Histogram equalisation of tiles with clipped counts."""
    out = np.empty_like(g)
    th, tw = max(1, -(-g.shape[0] // grid)), max(1, -(-g.shape[1] // grid))
    for y in range(0, g.shape[0], th):
        for x in range(0, g.shape[1], tw):
            tile = g[y : y + th, x : x + tw]
            n = np.bincount(tile.ravel(), minlength=256).astype(float)
            top = clip * tile.size / 256
            n = np.minimum(n, top) + np.maximum(n - top, 0).sum() / 256
            out[y : y + th, x : x + tw] = np.rint(n.cumsum() / n.sum() * 255).astype(np.uint8)[tile]
    return out


def sharpen(g: np.ndarray, amount: float = 0.5) -> np.ndarray:
    return np.clip(g + amount * (g.astype(float) - box_mean(g, 5)), 0, 255).astype(np.uint8)


def close_gaps(g: np.ndarray) -> np.ndarray:
    """Dark strokes closed over one pixel."""
    return windows(windows(g).min((2, 3))).max((2, 3))


def scale2(g: np.ndarray) -> np.ndarray:
    """Twice the size, linear between pixels."""
    def along(a: np.ndarray) -> np.ndarray:
        nxt = np.concatenate([a[1:], a[-1:]])
        out = np.empty((2 * len(a), *a.shape[1:]))
        out[0::2], out[1::2] = a, (a + nxt) / 2
        return out

    return np.rint(along(along(g.astype(float)).T).T).astype(np.uint8)


def adaptive_threshold(g: np.ndarray, size: int = 35, c: float = 11) -> np.ndarray:
    return np.where(g > box_mean(g, size) - c, 255, 0).astype(np.uint8)


def shear_rows(g: np.ndarray, angle: float) -> np.ndarray:
    """Deskewed by moving columns, white where nothing was."""
    out = np.full_like(g, 255)
    for x in range(g.shape[1]):
        d = int(round(x * np.tan(np.radians(angle))))
        src = g[max(0, d) : g.shape[0] + min(0, d), x]
        out[max(0, -d) : max(0, -d) + len(src), x] = src
    return out


def rules_of(mask: np.ndarray, least: int) -> list[tuple[str, int, int, int]]:
    """(axis, position, start, end) of straight runs of ink of at least so many pixels."""
    found = []
    for axis, m in (("h", mask), ("v", mask.T)):
        for p, line in enumerate(m):
            edges = np.flatnonzero(np.diff(np.concatenate([[0], line.astype(int), [0]])))
            found += [(axis, p, int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2]) if b - a >= least]
    return found


def without_rules(g: np.ndarray, least: int = 40) -> np.ndarray:
    out = g.copy()
    for axis, p, a, b in rules_of(ink(g), least):
        if axis == "h":
            out[p, a : b + 1] = 255
        else:
            out[a : b + 1, p] = 255
    return out


def ordered_corners(points: np.ndarray) -> np.ndarray:
    """Four points as upper left, upper right, lower right, lower left."""
    s, d = points.sum(1), points[:, 1] - points[:, 0]
    return points[[s.argmin(), d.argmin(), s.argmax(), d.argmax()]].astype(float)


def four_point_transform(g: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The quadrilateral of four points as an upright rectangle, nearest pixels."""
    q = ordered_corners(points)
    w = int(round(max(np.linalg.norm(q[1] - q[0]), np.linalg.norm(q[2] - q[3])))) + 1
    h = int(round(max(np.linalg.norm(q[3] - q[0]), np.linalg.norm(q[2] - q[1])))) + 1
    r = np.array([[0, 0], [w - 1, 0], [w - 1, h - 1], [0, h - 1]], float)
    rows = []
    for (x, y), (u, v) in zip(r, q):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
    m = np.append(np.linalg.solve(np.array(rows), q.ravel()), 1).reshape(3, 3)
    yy, xx = np.mgrid[0:h, 0:w]
    p = m @ np.stack([xx.ravel(), yy.ravel(), np.ones(h * w)])
    sx, sy = np.rint(p[0] / p[2]).astype(int).clip(0, g.shape[1] - 1), np.rint(p[1] / p[2]).astype(int).clip(0, g.shape[0] - 1)
    return g[sy, sx].reshape(h, w)


def document_corners(g: np.ndarray) -> np.ndarray:
    """Corners of the light page on a darker ground."""
    ys, xs = np.nonzero(g > otsu(g))
    pts = np.stack([xs, ys], 1)
    return ordered_corners(pts)


#: Filters that recognition is tried again with, in order.
STRATEGIES = {"original": lambda g: g, "contrast": equalize, "sharpen": sharpen, "clean": close_gaps, "scale": scale2}


def over_images(f, schema: str):
    """A column function of an image struct (height, width, nChannels, data) that gives f's values as a struct; null where
    the image is missing or f gives None."""
    names = [p.strip().split(" ")[0] for p in schema.split(",")]

    @F.pandas_udf(schema)
    def run(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series) -> pd.DataFrame:
        rows = []
        for h, w, c, d in zip(height, width, channels, data):
            got = f(decode(int(h), int(w), int(c), bytes(d))) if d is not None and h and w else None
            rows.append([got[n] for n in names] if got else [None] * len(names))
        return pd.DataFrame(rows, columns=names)

    return lambda image: run(image["height"], image["width"], image["nChannels"], image["data"])


def image_metrics(image: Column) -> Column:
    return over_images(metrics, METRICS)(image)


def image_handwriting(image: Column) -> Column:
    return over_images(handwriting_features, FEATURES)(image)


def flatness(img: np.ndarray) -> dict[str, float]:
    """Mean and spread of the grey values: an empty part of a page is light and even."""
    g = gray(img)
    return {"mean": float(g.mean()), "std": float(g.std())}


def image_flatness(image: Column) -> Column:
    return over_images(flatness, "mean double, std double")(image)


def cropped(pages: DataFrame, keys: list[str]) -> DataFrame:
    """keys, w, h and the fields of each of a page's `boxes` (block_idx, type, confidence, sides) with `image`, the part of
    the page's image that the box holds."""
    kinds = ", ".join(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{kinds}, w double, h double, block_idx int, type string, confidence double, x1 double, y1 double, x2 double, y2 double, image struct<height:int,width:int,nChannels:int,data:binary>"

    def run(it):
        for pdf in it:
            for row in pdf.itertuples(index=False):
                i = row.image
                a = np.frombuffer(i["data"], np.uint8).reshape(i["height"], i["width"], i["nChannels"])
                out = []
                for b in row.boxes:
                    x1, y1, x2, y2 = (int(np.floor(b["x1"])), int(np.floor(b["y1"])), int(np.ceil(b["x2"])), int(np.ceil(b["y2"])))
                    part = np.ascontiguousarray(a[max(0, y1) : y2, max(0, x1) : x2])
                    image = {"height": part.shape[0], "width": part.shape[1], "nChannels": part.shape[2], "data": part.tobytes()}
                    out.append([*(getattr(row, k) for k in keys), row.w, row.h, b["block_idx"], b["type"], b["confidence"], b["x1"], b["y1"], b["x2"], b["y2"], image])
                if out:
                    yield pd.DataFrame(out, columns=[*keys, "w", "h", "block_idx", "type", "confidence", "x1", "y1", "x2", "y2", "image"])

    return pages.select(*keys, "image", "w", "h", "boxes").mapInPandas(run, schema)
