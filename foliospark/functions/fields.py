"""Form fields: labels, places of values, dates, phones, key and value lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import Box
from .text import strip, sub, words

#: Patterns of field labels, in the order in which they are tried (fixed values).
LABELS = {
    "fax": r"\bfax(?:\s*(?:no|number))?\b",
    "phone": r"\bphone(?:\s*(?:no|number))?\b",
    "date": r"\b(?:date|tarih)\b",
    "to": r"\b(?:to|recipient|alıcı)\b",
    "from": r"\b(?:from|gönderen)\b",
    "subject": r"\b(?:subject|konu)\b",
    "pages": r"\b(?:no\.?\s*of\s*pages|pages|sayfa)\b",
}
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
#: Values that a model gives for nothing (fixed values).
NOTHING = ("", "none", "null", "n/a", "na", "not found", "not specified", "unknown")
#: Two-digit years from this on are of the last century.
PIVOT = 69


def label_key(text: Column) -> Column:
    """The key of the first label pattern that begins in the first ten characters; null where none does."""
    low = F.lower(F.translate(text, "İ", "i"))
    out = F.lit(None).cast("string")
    for key, pattern in reversed(LABELS.items()):
        out = F.when(low.rlike(rf"(?Us)^.{{0,9}}?{pattern}"), F.lit(key)).otherwise(out)
    return out


def distance(label: Box, value: Box) -> tuple[Column, Column]:
    """(distance, direction) of a value from its label: right within 350 pixels, below within 100, right below within
    200; of equal distances in this order. Nulls where the value is in no such place."""
    half = value.height * 0.5
    label_cy = label.cy
    gap = value.x1 - label.x2
    right = F.when((value.x1 > label.x1) & (value.y1 - half < label_cy) & (label_cy < value.y2 + half) & (gap >= 0) & (gap < 350), gap)
    drop = value.y1 - label.y2
    side = label.width * 0.3
    below = F.when((drop > 0) & (value.x1 < label.x2 + side) & (value.x2 > label.x1 - side) & (drop < 100), drop)
    dx = F.greatest(F.lit(0.0), gap)
    slant = F.sqrt(dx * dx + drop * drop)
    diagonal = F.when((value.x1 > label.x1) & (drop >= 0) & (drop < 50) & (slant < 200), slant)
    best = F.least(right, below, diagonal)
    return best, F.when(right == best, "right").when(below == best, "below").when(diagonal == best, "right_below")


def iso_date(text: Column) -> Column:
    """The date of `month/day/year`, `month-day-year` (two or four digits) or `Mon day, year` as YYYY-MM-DD; another text
    stripped; null gives ''."""
    t = strip(F.coalesce(text, F.lit("")))
    numeric = r"^(\d{1,2})([/-])(\d{1,2})\2(\d{4}|\d{2})$"
    named = r"^([A-Za-z]{3}) +(\d{1,2}),? +(\d{4})$"
    pad = lambda c: F.lpad(c, 2, "0")
    year = F.regexp_extract(t, numeric, 4)
    century = F.when(F.length(year) == 4, year).otherwise(F.concat(F.when(year.try_cast("int") >= PIVOT, "19").otherwise("20"), year))
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.regexp_extract(t, named, 1))).cast("string")
    made = F.when(t.rlike(numeric), F.concat_ws("-", century, pad(F.regexp_extract(t, numeric, 1)), pad(F.regexp_extract(t, numeric, 3)))).when(t.rlike(named), F.concat_ws("-", F.regexp_extract(t, named, 3), pad(month), pad(F.regexp_extract(t, named, 2))))
    return F.coalesce(F.when(made.try_cast("date").isNotNull(), made), t)


def e164(text: Column) -> Column:
    """Digits with a plus: as it is after a plus, North American for 10 digits and for 11 that begin with 1, else a plus
    before the digits; a text without digits as it is."""
    kept = sub(text, r"[^0-9+]", "")
    n = F.length(kept)
    return F.when(kept == "", text).when(kept.startswith("+"), kept).when(n == 10, F.concat(F.lit("+1"), kept)).otherwise(F.concat(F.lit("+"), kept))


def value_in_source(value: Column, source: Column) -> Column:
    """Whether a value stands in a text: a short one as a word, another as a part, or from its first to its last word
    within 20 characters more than it has."""
    v, s = F.lower(strip(value)), F.lower(source)
    w = words(v)
    start = F.position(F.try_element_at(w, F.lit(1)), s)
    last = F.try_element_at(w, F.lit(-1))
    end = F.position(last, s, start)
    near = (start > 0) & (end > 0) & (end + F.length(last) - start <= F.length(v) + 20)
    return F.coalesce(F.when(F.length(v) < 4, F.array_contains(words(s), v)).otherwise(F.contains(s, v) | near), F.lit(False))


def key_values(text: Column, keys: tuple[str, ...] = tuple(LABELS)) -> Column:
    """Array of (key, value) of the lines `key: value` whose key is known and whose value says something."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    pairs = F.transform(F.filter(lines, lambda x: F.contains(x, F.lit(":"))), lambda x: F.struct(F.lower(strip(F.substring_index(x, ":", 1))).alias("key"), strip(F.substring(x, F.position(F.lit(":"), x) + 1, F.length(x))).alias("value")))
    return F.filter(pairs, lambda p: p["key"].isin(*keys) & ~F.lower(p["value"]).isin(*NOTHING))


def page_summary(blocks: Column, most: int = 50, size: int = 3500) -> Column:
    """`[Block i] text` of the first blocks (an ordered array of contents), blank ones counted but left out, cut to size."""
    numbered = F.transform(F.slice(blocks, 1, most), lambda x, i: F.when(strip(F.coalesce(x, F.lit(""))) != "", F.concat(F.lit("[Block "), i.cast("string"), F.lit("] "), x)))
    return F.substring(F.array_join(F.filter(numbered, lambda x: x.isNotNull()), "\n"), 1, size)
