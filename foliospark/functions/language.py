"""Language decisions of pages from their text and a detector's answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import lower

#: Recognition packs by language code; codes without one are read as English (fixed values).
TESSERACT = {"en": "eng", "tr": "tur", "de": "deu", "fr": "fra", "es": "spa", "it": "ita", "pt": "por"}
#: Languages whose texts get the whole correction chain (fixed values).
POSTPROCESSED = ("eng", "fra", "deu", "spa", "por", "ita")
#: Signs of English forms and letters (fixed values).
INDICATORS = (
    r"\b(?:to|from|date|subject|re|cc|fax|phone|page)\s*:", r"\b(?:mr|mrs|ms|dr|inc|corp|llc|ltd)\b\.?", r"\b(?:please|thank|regards|sincerely|dear)\b", r"\b(?:total|amount|number|name|address)\b", r"\$\d+",
    r"\(\d{3}\)\s*\d{3}[-.]?\d{4}",
)
#: The same for engines whose \b knows ASCII only.
_B, _E = r"(?:^|[^\p{L}\p{M}\p{Nd}_])", r"(?:$|[^\p{L}\p{M}\p{Nd}_])"
SQL_INDICATORS = tuple(p.replace(r"\b(", _B + "(", 1).replace(r")\b", ")" + _E).replace(r"\.?", "") if p.startswith(r"\b") else p for p in INDICATORS)
#: Common English words (fixed values).
COMMON = (
    "the", "and", "for", "are", "but", "not", "you", "all", "can", "her", "was", "one", "our", "out", "has", "his", "how", "its", "from", "have", "this", "will", "your", "each", "make", "like", "date", "name", "page", "time",
    "year", "form", "type", "number", "to", "of", "in", "is", "it", "at", "by", "on", "be", "as", "or", "please", "company", "address", "phone", "fax", "total", "value",
)


def tesseract_code(language: Column) -> Column:
    out = F.lit("eng")
    for k, v in TESSERACT.items():
        out = F.when(F.lower(F.substring(language, 1, 2)) == k, v).otherwise(out)
    return out


def packs_available(code: Column, available: tuple[str, ...] = ("eng", "osd")) -> Column:
    """Whether all packs of a code like eng+tur are there."""
    return F.forall(F.split(code, r"\+"), lambda x: x.isin(*available))


def english_indicators(text: Column) -> Column:
    low = lower(F.coalesce(text, F.lit("")))
    return sum((low.rlike("(?U)" + p).cast("int") for p in INDICATORS), F.lit(0))


def english_words(text: Column) -> Column:
    """Struct of the number of common English words and of all words of two or more plain letters."""
    words = F.filter(F.split(lower(F.coalesce(text, F.lit(""))), r"(?U)\W+"), lambda w: w.rlike("^[a-z]{2,}$"))
    return F.struct(F.size(F.filter(words, lambda w: w.isin(*COMMON))).alias("hits"), F.size(words).alias("total"))


def decision(text: Column, detected: Column, confidence: Column, available: tuple[str, ...] = ("eng", "tur", "osd")) -> Column:
    """Struct lang_iso, lang_tess, confidence, fallback. Short texts are English; so are texts with two signs of English
    and enough of its words; a detector's answer counts only for Turkish, and not against many English words."""
    words = english_words(text)
    hits, total = words["hits"], words["total"]
    short = F.length(F.coalesce(F.trim(text), F.lit(""))) < 30
    sure = (english_indicators(text) >= 2) & (total > 0) & (hits / F.greatest(total, F.lit(1)) >= 0.15)
    forced = F.when(detected == "tr", "tur").otherwise("eng")
    forced = F.when(packs_available(forced, available), forced).otherwise("eng")
    many = (total > 5) & (hits / F.greatest(total, F.lit(1)) > 0.25)
    english = short | sure | (forced == "eng") | many
    fallback = short | (~sure & (detected.isNull() | (forced != F.when(many, "eng").otherwise(forced))))
    return F.struct(
        F.when(english, "en").otherwise(detected).alias("lang_iso"), F.when(english, "eng").otherwise(forced).alias("lang_tess"), F.when(short, 0.0).when(sure, 0.95).otherwise(F.coalesce(confidence, F.lit(0.0))).alias("confidence"),
        F.coalesce(fallback, F.lit(True)).alias("fallback"),
    )


def carried(pages: DataFrame) -> DataFrame:
    """Every page of a file with the language of its first page; without one, English and Turkish."""
    first = pages.groupBy("file").agg(F.min_by(F.struct("lang_tess"), "page").alias("first"))
    return pages.select("file", "page").join(first, "file", "left").select("file", "page", F.coalesce("first.lang_tess", F.lit("eng+tur")).alias("lang_tess"))
