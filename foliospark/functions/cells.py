"""Texts of table cells: garbage, labels, disclaimers, and whether a text is a table's content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import count_of, strip, words

#: Phrases of disclaimers at the foot of faxes (fixed values).
DISCLAIMERS = (
    "please call", "support center", "confidential", "privileged", "attorney", "if you received this", "intended recipient", "not receive all", "prohibited", "thank you", "fax number", "copyright",
    "all rights reserved", "page 1 of", "page _ of",
)
#: Words that are only labels of form fields (fixed values).
FORM_LABELS = (
    "date", "name", "from", "to", "subject", "re", "cc", "phone", "fax", "email", "address", "city", "state", "zip", "total", "amount", "quantity", "price", "description", "year", "month", "day", "time", "signature",
)
#: Amounts, dates, phone numbers, percentages, numbers of three digits: content without doubt (fixed values).
DATA = r"\$[0-9,]+\.?[0-9]*|[0-9]{1,2}[/\-][0-9]{1,2}[/\-][0-9]{2,4}|\([0-9]{3}\)\s*[0-9]{3}[-.]?[0-9]{4}|[0-9]+%|[0-9]{3,}"


def is_disclaimer(text: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    return low.rlike("|".join(DISCLAIMERS))


def is_label_only(text: Column) -> Column:
    """Blank, ending with a colon, or one of the label words."""
    t = strip(F.coalesce(text, F.lit("")))
    return (F.coalesce(text, F.lit("")) == "") | t.endswith(":") | F.lower(t).isin(*FORM_LABELS)


def is_garbage_word(w: Column) -> Column:
    """Odd double vowels, four consonants in a row outside common clusters, long words without vowels or, in capitals, with
    too few or too many. y counts as a consonant; words up to three letters are fine."""
    up, low = F.upper(w), F.lower(w)
    n = F.length(w)
    vowels = count_of(low, r"[aeiou]") / F.greatest(n, F.lit(1))
    doubles = up.rlike("II|UU|AA|IUI") & ~up.isin("HAWAII", "SKIING", "RADII")
    cluster = low.rlike(r"[^\P{L}aeiou]{4,}") & ~low.rlike("str|thr|sch|chr|spr|ngth")
    shouted = (up == w) & (low != w) & (n > 5) & ((vowels < 0.2) | (vowels > 0.6))
    return (n > 3) & (doubles | cluster | ((n > 4) & ~low.rlike("[aeiou]")) | shouted)


def is_table_content(text: Column) -> Column:
    """Whether a text may stand in a table: long enough, not too odd, then data without doubt, else words that are not
    mostly garbage, with a name, an abbreviation, a digit or a word with vowels."""
    t = strip(F.coalesce(text, F.lit("")))
    usual = count_of(t, r"[\p{L}\p{N}\s]") / F.greatest(F.length(t), F.lit(1))
    letters = F.filter(F.transform(words(t), lambda w: F.regexp_replace(w, r"[^\p{L}]", "")), lambda w: F.length(w) >= 2)
    total, bad = F.size(letters), F.size(F.filter(letters, is_garbage_word))
    rotten = (total > 0) & ((bad / F.greatest(total, F.lit(1)) >= 0.5) | ((bad >= 1) & (total <= 3)))
    good = t.rlike(r"[A-Z][a-z]+|(?U)\b[A-Z]{2,4}\b|[0-9]") | F.exists(letters, lambda w: (F.length(w) >= 3) & F.lower(w).rlike("[aeiou]") & ~is_garbage_word(w))
    return F.when((F.length(t) < 2) | (usual < 0.5), False).when(t.rlike(DATA), True).when(rotten, False).otherwise(good)


def content_score(texts: Column) -> Column:
    """Of an array of cell texts: .1 with a disclaimer, .2 if more labels than content, else the share of content among
    all; 0 without cells."""
    said = F.filter(texts, lambda t: F.length(strip(F.coalesce(t, F.lit("")))) >= 2)
    labels = F.size(F.filter(said, is_label_only))
    valid = F.size(F.filter(said, lambda t: ~is_label_only(t) & is_table_content(t)))
    return F.when(F.size(texts) <= 0, 0.0).when(F.exists(said, is_disclaimer), 0.1).when(labels > valid, 0.2).otherwise(valid / F.greatest(F.size(texts), F.lit(1)))
