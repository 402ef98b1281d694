"""What the corpus itself says about names: given names, trades, short forms and abbreviations, learned from typed names.

A given name is a word that stands first (or behind a comma) beside many different words and seldom last; a trade is a
word before a legal form that follows many different words, or one that abbreviates it beside the same company's word; a
short form stands in quotes between a given name and a surname. All counts are over all values; what comes to the driver
has a share of them whose inverse bounds its number.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

#: Least number of different partners of a given name or trade, and least share of all pairs; a given name stands first at
#: least so many times as often as last.
LEAST_PARTNERS, LEAST_SHARE, FIRST = 3, 2e-5, 3
#: A learned form with one letter wrong is one of another with so many times as many partners.
RARER = 8
#: Legal forms (fixed values).
LEGAL = frozenset("inc incorporated co company corp corporation ltd limited gmbh bros brothers plc llc llp sa sas sarl srl spa ag kg ohg the and sons group as aş ltda sl".split())
#: Short forms of given names (fixed values; a few common ones, the corpus adds its own).
SHORT_FORMS = {
    "alexander": "alex sandy sasha", "anthony": "tony", "benjamin": "ben", "charles": "charlie chuck", "christopher": "chris", "daniel": "dan", "deborah": "debbie", "edward": "ed eddie ned ted", "elizabeth": "beth betty eliza liz", "francesca": "checca",
    "francisco": "paco pancho", "frederick": "fred freddie freddy", "friederike": "rike", "giuseppe": "beppe pino", "gregory": "greg", "guadalupe": "lupe", "harriet": "hattie", "james": "jim jimmy", "johannes": "hannes hans", "john": "jack johnny", "jose": "pepe",
    "joseph": "joe", "josephine": "jo josie", "katherine": "kate kathy kitty", "leonard": "len lenny", "lorenzo": "renzo", "margaret": "maggie meg peggy", "matthew": "matt", "michael": "mick mike", "nathaniel": "nate", "nicholas": "nick",
    "patricia": "pat trish", "philippa": "pippa", "richard": "dick rick", "robert": "bob rob", "samuel": "sam", "sebastian": "basti", "susannah": "sue susie", "theodore": "ted theo", "thomas": "tom", "victoria": "vicky", "william": "bill will",
}
#: Trades with common abbreviations (fixed values; the corpus adds its own).
TRADES = {
    "chemicals": "chem", "construction": "constr", "consulting": "", "distribution": "dist distrib", "electric": "elec", "electronics": "", "engineering": "eng engrg", "foods": "fds", "holdings": "", "industries": "ind", "insurance": "ins insur", "laboratories": "lab labs",
    "logistics": "", "manufacturing": "mfg", "motors": "", "packaging": "pkg", "pharmaceuticals": "pharma", "plumbing": "", "printing": "prtg", "services": "svcs", "solutions": "", "systems": "", "textiles": "", "trading": "", "transport": "",
}
WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
TITLE = re.compile(r"^\s*(?:(?:attn|att|c/o|cc|to|from|z\.? ?hd\.?)\b[.:]?\s*)?(?:(?:mr|mrs|ms|miss|dr|prof|sr|sra|mme|mlle|m|herr|frau|sig|sig\.ra|dott|bay|bayan)\b\.?\s+)*", re.IGNORECASE)
QUOTED = re.compile(r"([^\W\d_]+)\s+[\"“”«»]([^\W\d_]{2,15})[\"“”«»]")
BRACKETS = re.compile(r"\([^()]*\)|[\"“”«»][^\"“”«»]*[\"“”«»]")
DOTTED_LEGAL = re.compile(r"\bg\.?\s?m\.?\s?b\.?\s?h\b\.?", re.IGNORECASE)


def folded(w: str) -> str:
    """Lower case without accents; dotted and dotless i alike."""
    w = w.replace("İ", "i").replace("ı", "i").lower()
    return w if w.isascii() else "".join(c for c in unicodedata.normalize("NFD", w) if not unicodedata.combining(c))


def pairs_of(value: str) -> list[tuple[str, str, str]]:
    """(role, word, partner) in a typed name: f and l, a word that is first or last of two; t, a trade with its company's
    word; q, a given name with its short form in quotes."""
    out = [("q", folded(m[1]), folded(m[2])) for m in QUOTED.finditer(value)]
    text = DOTTED_LEGAL.sub("gmbh", BRACKETS.sub(" ", TITLE.sub("", value)))
    words = [folded(w) for w in WORD.findall(text)]
    long = [w for w in words if len(w) > 1]
    own = [w for w in long if w not in LEGAL]
    if len(own) != 2:
        return out
    a, b = own
    if len(own) < len(long):
        return [*out, ("t", b, a)]
    if re.match(r"^\s*[^\s,]+\s*,", text):
        a, b = b, a
    return [*out, ("f", a, b), ("l", b, a)]


@dataclass
class Lore:
    """Given names with their canonical form (short forms and rare misspellings lead to it), trades with theirs, and the
    words that are short forms."""

    given: dict[str, str] = field(default_factory=dict)
    trades: dict[str, str] = field(default_factory=dict)
    short: frozenset[str] = frozenset()


def one_off(a: str, b: str) -> bool:
    """Whether two words differ by one letter put in, left out or changed, or by two neighbours swapped."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or a[i + 2 :] == b[i + 2 :] and a[i : i + 2] == b[i : i + 2][::-1]
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


def canonical(forms: dict[str, int]) -> dict[str, str]:
    """Each form, or the one with one letter wrong that has RARER times its partners. Looked up by forms with one letter
    left out, so no two forms apart are compared."""
    by: dict[str, list[str]] = {}
    cut = lambda w: {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}
    for w in forms:
        if len(w) >= 4:
            for c in cut(w):
                by.setdefault(c, []).append(w)
    out = {}
    for w, n in forms.items():
        near = {x for c in cut(w) for x in by.get(c, ()) if forms[x] >= RARER * n and one_off(w, x)} if len(w) >= 4 else ()
        out[w] = max(near, key=lambda x: (forms[x], x), default=w)
    return out


def shortens(short: str, word: str) -> bool:
    """Whether the letters of a shorter word come in the same order in a longer one that begins alike."""
    rest = iter(word)
    return len(short) < len(word) and short[0] == word[0] and all(c in rest for c in short)


def learn(values: DataFrame) -> Lore:
    """The lore of a column `value` of typed names (null allowed); without values only what is listed here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [r for v in b.column(0).to_pylist() for r in pairs_of(v)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], names=["role", "word", "partner"])

    pairs = written(values.filter("value is not null").select("value").distinct().mapInArrow(run, "role string, word string, partner string").groupBy("role", "word", "partner").agg(F.count("*").alias("n")), "name-pairs")
    total = pairs.filter("role = 'f'").count()
    least = max(LEAST_PARTNERS, int(total * LEAST_SHARE))
    known = {r.word: r.n for r in pairs.filter("role = 't'").groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least).collect()} | dict.fromkeys(TRADES, 10**9)
    spark = values.sparkSession
    told = spark.createDataFrame([(w,) for w in sorted(known)], "trade string")
    of = lambda role: F.count(F.when(F.col("role") == role, 1))
    people = pairs.filter("role in ('f', 'l')").join(F.broadcast(told), F.col("partner") == F.col("trade"), "left_anti")
    counted = people.groupBy("word").agg(of("f").alias("f"), of("l").alias("l")).filter((F.col("f") >= least) & (F.col("f") >= FIRST * F.col("l")))
    given = {r.word: r.f for r in counted.collect() if r.word not in known}
    trades = canonical(known)
    # abbreviations: forms beside the same company's word
    beside = pairs.filter("role in ('t', 'l')").select("word", "partner").distinct()
    full = beside.join(F.broadcast(told), F.col("word") == F.col("trade")).select("trade", "partner")
    short = beside.filter(F.length("word") >= 2).join(full, "partner").filter((F.length("word") < F.length("trade")) & (F.substring("word", 1, 1) == F.substring("trade", 1, 1)))
    for r in short.groupBy("word", "trade").agg(F.count("*").alias("n")).filter(F.col("n") >= 2).orderBy("n", "word", "trade").collect():
        if shortens(r.word, r.trade) and r.word not in given and r.word not in TRADES:
            trades[r.word] = trades.get(r.trade, r.trade)
    for t, aa in TRADES.items():
        for a in aa.split():
            trades.setdefault(a, t)
    trades = {w: trades.get(t, t) for w, t in trades.items()}
    names = canonical(given)
    nicks = {s: n for n, ss in SHORT_FORMS.items() for s in ss.split()}
    quoted = pairs.filter("role = 'q'").groupBy("partner").agg(F.max(F.struct("n", "word")).alias("m"), F.sum("n").alias("s")).filter(F.col("s") * (1 / LEAST_SHARE) >= total)
    nicks |= {r.partner: r.m.word for r in quoted.orderBy("partner").collect() if r.m.word in names}
    for s, n in nicks.items():
        names[s] = names.get(n, n)
    for n in SHORT_FORMS:
        names.setdefault(n, n)
    return Lore({w: names.get(n, n) for w, n in names.items()}, trades, frozenset(nicks))
