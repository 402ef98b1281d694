"""Text functions on columns.

All patterns are Unicode-aware (`(?U)`). Null texts give the value the function's docstring names, else null.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that recognition often gets wrong (fixed values).
CORRECTIONS = {
    "teh": "the", "adn": "and", "hte": "the", "fo": "of", "ot": "to", "nad": "and", "tme": "the", "rnessage": "message", "tirne": "time", "nurnber": "number", "cornpany": "company",
    "frorn": "from", "narne": "name", "sarne": "same", "corne": "come", "horne": "home", "sorne": "some",
}


def sub(c: Column, pattern: str, to: str) -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(to))


def strip(c: Column) -> Column:
    """White space of any kind taken off both ends."""
    return sub(c, r"(?U)^\s+|\s+$", "")


def lower(c: Column) -> Column:
    """Lower case; a dotted capital I becomes one letter, as engines differ there."""
    return F.lower(F.translate(c, "İ", "i"))


def words(c: Column) -> Column:
    """Pieces between white space, in order; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"(?U)\s+"), lambda w: w != "")


def count_of(c: Column, pattern: str) -> Column:
    """Characters of a text that match a one-character pattern."""
    return F.length(c) - F.length(sub(c, pattern, ""))


def normalize_basic(c: Column) -> Column:
    """White space collapsed to single spaces, ends stripped; null gives ''."""
    return strip(sub(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def normalize_full(c: Column) -> Column:
    """`normalize_basic`, then NFKC (not in SQL, so one Arrow pass), then quotes, dashes, ellipsis and hard spaces."""

    @F.pandas_udf("string")
    def nfkc(s: pd.Series) -> pd.Series:
        return s.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")

    out = F.translate(nfkc(normalize_basic(c)), "‘’“”–— ", "''\"\"-- ")
    return F.replace(out, F.lit("…"), F.lit("..."))


def clean_filename(c: Column) -> Column:
    """Characters that file systems refuse become '_', dots and spaces go from the ends."""
    return sub(F.translate(c, '<>:"/\\|?*', "_________"), r"^[. ]+|[. ]+$", "")


def fix_spacing(c: Column) -> Column:
    """Runs of spaces, spaces before and missing spaces after punctuation, words divided at line ends, line ends."""
    for pattern, to in ((r" {2,}", " "), (r"(?U)\s+([.,;:!?)])", "$1"), (r"([.,;:!?])([A-Za-z])", "$1 $2"), (r"(?U)-\s*\n\s*", ""), (r"\n+", " ")):
        c = sub(c, pattern, to)
    return strip(c)


def substitute_chars(c: Column) -> Column:
    """1, 0 and | between word characters become l, o and l, one pass each."""
    for pattern, to in ((r"(?U)(\w)1(\w)", "$1l$2"), (r"(?U)(\w)0(\w)", "$1o$2"), (r"(?U)(\w)\|(\w)", "$1l$2")):
        c = sub(c, pattern, to)
    return c


def case_like(model: Column, word: Column) -> Column:
    """`word` in the letter case of `model`: all upper, first upper, else as it is."""
    upper = (F.upper(model) == model) & (F.lower(model) != model)
    title = F.substring(model, 1, 1).rlike(r"^\p{Lu}")
    return F.when(upper, F.upper(word)).when(title, F.concat(F.upper(F.substring(word, 1, 1)), F.substring(word, F.lit(2), F.length(word)))).otherwise(word)


def correct_words(c: Column, corrections: dict[str, str] = CORRECTIONS) -> Column:
    """Known wrong words replaced, punctuation around them and their letter case kept; words joined by one space."""
    table = F.create_map(*[F.lit(x) for pair in corrections.items() for x in pair])

    def fixed(w: Column) -> Column:
        part = lambda i: F.regexp_extract(w, r"(?Us)^([^\w]*)(.*?)([^\w]*)$", i)
        core = part(2)
        right = F.try_element_at(table, lower(core))
        return F.when(right.isNotNull(), F.concat(part(1), case_like(core, right), part(3))).otherwise(w)

    return F.array_join(F.transform(words(c), fixed), " ")


def remove_artifacts(c: Column) -> Column:
    """Box-drawing signs and control characters go, single symbols between spaces become a space, repeated punctuation
    becomes one."""
    for pattern, to in ((r"[─│┌┐└┘├┤┬┴┼═-╬]", ""), (r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", ""), (r"(?U)\s+[^\w\s]\s+", " "), (r"([.,;:!?])\1+", "$1")):
        c = sub(c, pattern, to)
    return c


def normalize_quotes(c: Column, compat: bool = False) -> Column:
    """Curly and angled quotes become straight ones. compat: only the angled ones."""
    c = F.translate(c, "«»‹›", "\"\"''")
    return c if compat else F.translate(c, "‘’“”", "''\"\"")


def fix_numbers(c: Column) -> Column:
    """Spaces between digits go (one pass), the letter O among digits becomes 0."""
    for pattern, to in ((r"(?U)(\d)\s+(\d)", "$1$2"), (r"(\d)O(\d)", "$10$2"), (r"(?U)(\d)O([,.\s]|$)", "$10$2")):
        c = sub(c, pattern, to)
    return c


def correct_text(c: Column, aggressive: bool = False) -> Column:
    """The whole chain: artifacts, quotes, spacing, numbers, (characters,) words, spacing. Null and '' give ''."""
    out = fix_numbers(fix_spacing(normalize_quotes(remove_artifacts(F.coalesce(c, F.lit(""))))))
    if aggressive:
        out = substitute_chars(out)
    return fix_spacing(correct_words(out))


def correction_stats(before: Column, after: Column) -> Column:
    """Struct of lengths, number of words changed, and the first ten words added and removed, in letter order."""
    old, new = F.array_distinct(words(lower(before))), F.array_distinct(words(lower(after)))
    added, removed = F.array_except(new, old), F.array_except(old, new)
    return F.struct(
        F.coalesce(F.length(before), F.lit(0)).alias("original_length"), F.coalesce(F.length(after), F.lit(0)).alias("corrected_length"), (F.size(added) + F.size(removed)).alias("words_changed"),
        F.slice(F.array_sort(added), 1, 10).alias("added"), F.slice(F.array_sort(removed), 1, 10).alias("removed"),
    )


def blank(c: Column) -> Column:
    return F.coalesce(strip(c) == "", F.lit(True))


def quality_score(text: Column, conf: Column) -> Column:
    """0 to 100 from the confidence and the make-up of the words; blank texts have 0, a null confidence counts 0."""
    w = words(text)
    n = F.size(w)
    share = lambda test: F.size(F.filter(w, test)) / F.nullif(n, F.lit(0))
    size = F.length(text)
    special = count_of(text, r"[^\p{L}\p{N} .,;:!?'\"-]") / size
    known = (size - F.length(sub(text, r"(?U)[\p{L}\p{N}\s]", ""))) / size
    score = (
        F.coalesce(conf, F.lit(0.0)) * 0.4
        + (1 - share(lambda x: F.length(x) == 1)) * 20
        + share(lambda x: (F.length(x) >= 2) & x.rlike(r"\p{L}")) * 20
        + F.when(size > 10, F.greatest(F.lit(0.0), 1 - special * 5) * 10).otherwise(0.0)
        + known * 10
    )
    return F.when(blank(text), 0.0).otherwise(F.least(F.lit(100.0), score))


def likely_handwritten(text: Column, conf: Column) -> Column:
    """Whether words are so short, or so many of one character, that the text was probably written by hand."""
    w = words(text)
    n = F.nullif(F.size(w), F.lit(0))
    mean = F.length(F.replace(text, F.lit(" "), F.lit(""))) / n
    single = F.size(F.filter(w, lambda x: F.length(x) == 1)) / n
    found = ((mean < 2.5) & (F.coalesce(conf, F.lit(0.0)) < 70)) | ((n > 2) & (single > 0.35)) | text.rlike(r"(?U)\b[li1I]\s+[li1I]\s+[li1I]\b")
    return F.coalesce(~blank(text) & found, F.lit(False))


def valid_output(text: Column) -> Column:
    """False for blank texts, texts that mostly repeat how they begin, texts of few letters and digits, and garbage."""
    t = strip(text)
    n = F.length(t)

    def repeats(k: Column) -> Column:
        times = (n - F.length(F.replace(t, F.substring(t, F.lit(1), k), F.lit("")))) / k
        return times > n / k * 0.6

    looped = (n > 5) & F.exists(F.filter(F.array(*[F.lit(k) for k in range(2, 6)]), lambda k: k < F.least(F.lit(6), F.floor(n / 2))), repeats)
    sparse = (n > 3) & (count_of(t, r"[\p{L}\p{N}]") / n < 0.3)
    garbage = t.rlike(r"^(?:[.,:;!?]+$|[-_=+]+$|(.)\1{4,}|[A-Z]{15,}$)")
    return F.coalesce(~blank(text) & ~looped & ~sparse & ~garbage, F.lit(False))


def bound(c: Column, f) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.element_at(F.transform(F.array(c), f), 1)


def bigrams(c: Column) -> Column:
    none = F.array().cast("array<string>")
    pairs = lambda t: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(t) - 1)), lambda i: F.substring(t, i, F.lit(2))))
    return bound(lower(F.replace(c, F.lit(" "), F.lit(""))), lambda t: F.when(F.length(t) < 2, none).otherwise(pairs(t)))


def similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of the sets of letter pairs; texts without pairs are like each other if equal but for case."""
    x, y = bigrams(a), bigrams(b)
    both = F.size(F.array_union(x, y))
    none = (F.size(x) == 0) | (F.size(y) == 0)
    return F.when(F.coalesce(a, F.lit("")).eqNullSafe(F.lit("")) | F.coalesce(b, F.lit("")).eqNullSafe(F.lit("")), 0.0).when(none, (lower(strip(a)) == lower(strip(b))).cast("double")).otherwise(F.size(F.array_intersect(x, y)) / both)


def texts_similar(a: Column, b: Column, threshold: float = 0.7) -> Column:
    return similarity(a, b) >= threshold
