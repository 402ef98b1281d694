"""Problem 4: variant spellings of the names of persons and organisations.

Each typed name is read into parts by what the corpus says of names (`lore`): a person's given name (short forms, initials
and one or two wrong letters allowed) and surname, in any order; an organisation's own name and its trade (abbreviations
and wrong letters allowed), without legal form. A given name that the corpus does not know keeps its own letters. Names of
one kind with the same given name or trade are then joined on their remaining part by a pigeonhole segment join, names
with an initial or without a trade with all of that initial, and unknown given names with those beside the same surname: a
text is cut into k+1 segments, of which one survives k errors unchanged but for a shift or a letter swapped across its
end; so the segments stand in an inverted index by length and number, each name looks its shifted substrings up there, and
a banded edit distance verifies what is found. A spelling follows its nearest, more frequent neighbour to the spelling that
has none; names with only an initial follow the nearest, then most frequent person of that initial.

Defined cases: null, empty and filler values, departments, rooms and roles name nobody and have no link; equal values
are one spelling, however many fields have them; a field delivered again counts once, its latest delivery stands; of
neighbours at equal distance the more frequent, then the first in letter order is followed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .lore import LEGAL, Lore, folded, learn

#: Words of departments, rooms and roles, which name nobody (fixed values).
NOBODY = frozenset("file copy all branches dept department claims desk records office accounts payable room rm intake reception mailroom purchasing billing manager archive".split())
#: Ends of words that are trades rather than surnames when they stand last and nothing speaks for a person.
TRADE_END = re.compile(r"(?:[a-z]ing|tion|tions|ics|ments|works|ware|tech|soft|mart|systems)$")
MOST_ERRORS = 2
#: Members of an entity that one task pairs with as many others.
CHUNK = 2000
WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
PREFIX = re.compile(r"^\s*(?:(?:attn|att|c/o|to|from|z\.? ?hd\.?)\b[.:]?\s*)?(?:(?:mr|mrs|ms|dr|prof|sr|sra|mme|herr|frau|sig|dott|bay|bayan)\b\.?\s+)*", re.IGNORECASE)
TAIL = re.compile(r"\s*(?:\([^()]*\)|[,\-–]\s*(?:rm|room|dept|claims|records|accounts|intake|desk|office|file)\b.*)\s*$", re.IGNORECASE)
QUOTED = re.compile(r"[\"“”«»][^\"“”«»]*[\"“”«»]")
GMBH = re.compile(r"g\.?\s?m\.?\s?b\.?\s?h\b\.?", re.IGNORECASE)
SURNAME_FIRST = re.compile(r"^\s*[^\W\d_][^\s,]*\s*,")


def errors(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours, most + 1 where it is more, in a band around the diagonal."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = [], list(range(len(b) + 1))
    for i in range(1, len(a) + 1):
        now = [i] + [most + 1] * len(b)
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            now[j] = min(last[j] + 1, now[j - 1] + 1, last[j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                now[j] = min(now[j], before[j - 2] + 1)
        if min(now) > most:
            return most + 1
        before, last = last, now
    return min(last[-1], most + 1)


def plain(word: str) -> str:
    """Folded, with digits that stand for letters read as those."""
    w = folded(word)
    if any(c.isdigit() for c in w) and not w.isdigit():
        w = w.replace("0", "o").replace("1", "l").replace("3", "e").replace("5", "s")
    return w


class Near(dict):
    """Memo of the closest known form of a word within one error, or more where `most` allows, in words of at least four
    letters. Forms are found by their segments, as in segment_join."""

    def __init__(self, forms: dict[str, str], most=lambda w: 1):
        super().__init__()
        self.forms, self.most = forms, most
        self.index: dict[tuple[int, int, str], list[str]] = {}
        for f in forms:
            if len(f) >= 5:
                for i, (a, b) in enumerate(self.cuts(len(f))):
                    self.index.setdefault((len(f), i, f[a:b]), []).append(f)

    @staticmethod
    def cuts(n: int) -> list[tuple[int, int]]:
        return [(n * i // 3, n * (i + 1) // 3) for i in range(3)]

    def __missing__(self, w: str) -> str | None:
        if len(self) > 100_000:
            self.clear()
        got = self.forms.get(w)
        if got is None and len(w) >= 4:
            most, hits = self.most(w), set()
            for n in range(max(5, len(w) - most), len(w) + most + 1):
                for i, (a, b) in enumerate(self.cuts(n)):
                    for shift in range(max(-a, -most), most + 1):
                        hits.update(self.index.get((n, i, w[a + shift : b + shift]), ()))
            best = min(((d, f) for f in hits if (d := errors(w, f, most)) <= most), default=None)
            got = self.forms[best[1]] if best else None
        self[w] = got
        return got


class Reader:
    """Reads typed names by the lore of names."""

    def __init__(self, lore: Lore | None = None):
        self.lore = lore or Lore()
        self.given = Near(self.lore.given, lambda w: 2 if len(w) >= 7 else 1)
        self.trade = Near(self.lore.trades, lambda w: 2 if len(w) >= 8 else 1)
        self.legal = Near({x: x for x in LEGAL})

    def read(self, value: str | None) -> tuple[str, str, str, str, bool] | None:
        """(kind, given name or trade, initial, remaining part, whether the given name is known), None where the value names
        nobody."""
        if not value:
            return None
        text = PREFIX.sub("", QUOTED.sub(" ", value))
        text = GMBH.sub("gmbh", text)
        while (m := TAIL.search(text)) and m.start() > 3:
            text = text[: m.start()]
        words = [plain(w) for w in WORD.findall(text)]
        words = [w for w in words if not w.isdigit()]
        if not words or all(w in NOBODY or len(w) == 1 for w in words):
            return None
        long = [w for w in words if len(w) > 1]
        initials = [w for w in words if len(w) == 1]
        legal = [w for w in long if w in LEGAL or self.legal[w] and len(w) >= 6]
        trades = [(w, t) for w in long if w not in legal and w not in self.lore.given and (t := self.trade[w])]
        own = [w for w in long if w not in legal and w not in [x for x, _ in trades]]
        known = [w for w in own if w in self.lore.given]
        if not trades and not known and len(own) >= 2 and (m := TRADE_END.search(own[-1])) and len(own[-1]) >= 6 and not initials and not SURNAME_FIRST.match(text):
            trades, own = [(own[-1], own[-1])], own[:-1]
        if (legal and [w for w in legal if w not in ("the", "and", "as", "sa", "ag", "sl")]) or trades and (own or len(trades) > 1) and not known:
            own = [w for w in own if w not in NOBODY] or [w for w, _ in trades[:1]]
            return ("org", trades[0][1] if trades else "", "", "".join(own), True) if own else None
        exact = [w for w in long if w in self.lore.given]
        given = exact[:1] or [w for w in long if self.given[w]][:1]
        if given and len(long) >= 2:
            rest = list(long)
            rest.remove(given[0])
            canon = self.given[given[0]]
            return "person", canon, canon[0], "".join(w for w in rest if w not in NOBODY) or rest[0], True
        if initials and long and len(long) == 1:
            return "person", "", initials[0], "".join(w for w in long if w not in NOBODY) or long[0], True
        if len(long) >= 2 and not NOBODY.intersection(long):
            first, rest = (long[-1], long[:-1]) if SURNAME_FIRST.match(text) else (long[0], long[1:])
            return "person", first, first[0], "".join(rest), False
        if initials and long:
            return "person", "", initials[0], "".join(w for w in long if w not in NOBODY) or long[0], True
        return None


def spellings(values: DataFrame, lore: Lore) -> DataFrame:
    """Adds kind, part (given name or trade), initial, core and known to distinct values (value, n); values that name nobody
    are left out."""
    shared = values.sparkSession.sparkContext.broadcast(lore)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(shared.value).read
        for b in batches:
            at, rows = [], []
            for i, v in enumerate(b.column(0).to_pylist()):
                if (r := read(v)) is not None:
                    at.append(i)
                    rows.append(r)
            cols = [pa.array([r[k] for r in rows], pa.string() if k < 4 else pa.bool_()) for k in range(5)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), b.column(1).take(pa.array(at, pa.int64())), *cols], names=["value", "n", "kind", "part", "initial", "core", "known"])

    return values.select("value", "n").mapInArrow(run, "value string, n bigint, kind string, part string, initial string, core string, known boolean")


def cut(length: Column, i: int | Column, pieces: int) -> tuple[Column, Column]:
    """Start (from 0) and size of segment i of a name of that length cut into so many pieces."""
    start = F.floor(length * i / pieces).cast("int")
    return start, F.floor(length * (i + 1) / pieces).cast("int") - start


def segment_join(names: DataFrame, block: str, text: str, most: int = MOST_ERRORS, probes: Column | None = None) -> DataFrame:
    """Pairs a, b (rows of `names` as structs) of one block with different names whose texts have an edit distance, with
    swaps of neighbours, up to `most` (1 where one has under 7 letters). Every pair is found once each way, but a is only of
    rows that meet `probes`. Pairs come partitioned by a's name.

    An edit spoils one segment, but a swap across a cut spoils both beside it. The left one of those then stands in the
    other text with the letter after it in place of its last, so that form is looked up too: each edit takes away one
    segment at most, and one of k+1 is left. Texts of fewer letters than segments, whose limit is one error, are joined by
    their forms with one letter left out, among themselves and with texts of one letter more. A key that many names share
    is a skewed partition of a sort-merge join, which adaptive execution splits."""
    pieces = most + 1
    n = F.length(text)
    # a number given keeps tasks as many as that, though each name grows to dozens of rows
    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = names.filter(n >= 1).withColumn("row", F.struct(*names.columns)).repartition(tasks, "name", text)
    key = lambda length, i, s: F.concat_ws("\x1f", F.col(block), length.cast("string"), i.cast("string"), s)
    fewer = F.array(F.col(text), *[F.concat(F.col(text).substr(1, i), F.col(text).substr(i + 2, pieces)) for i in range(pieces)])
    none = F.filter(fewer, lambda x: F.lit(False))
    forms = F.transform(F.when(n <= pieces, fewer).otherwise(none), lambda x: key(F.lit(-1), F.lit(-1), x))
    own = F.when(n >= pieces, F.array(*[key(n, F.lit(i), F.col(text).substr(cut(n, i, pieces)[0] + 1, cut(n, i, pieces)[1])) for i in range(pieces)])).otherwise(none)
    index = base.select(F.col("row").alias("b"), F.explode(F.array_distinct(F.concat(forms, own))).alias("k"))
    ways = [(d, i, s, w) for w in (False, True) for d in range(-most, most + 1) for i in range(pieces - w) for s in range(-most, most + 1)]
    way = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.lit(i).alias("i"), F.lit(s).alias("s"), F.lit(w).alias("w")) for d, i, s, w in ways])).alias("way")
    asked = base.filter(probes) if probes is not None else base
    length = n + F.col("way.d")
    begin, size = cut(length, F.col("way.i"), pieces)
    rows = asked.select("row", block, text, way).select("*", length.alias("len"), (begin + F.col("way.s")).alias("at"), size.alias("size")).filter((F.col("len") >= pieces) & (F.col("at") >= 0))
    part = F.when(F.col("way.w"), F.concat(F.col(text).substr(F.col("at") + 1, F.col("size") - 1), F.col(text).substr(F.col("at") + F.col("size") + 1, F.lit(1)))).otherwise(F.col(text).substr(F.col("at") + 1, F.col("size")))
    probe = rows.withColumn("part", part).filter(F.length("part") > 0).select(F.col("row").alias("a"), key(F.col("len"), F.col("way.i"), F.col("part")).alias("k"))
    probe = probe.unionByName(asked.filter(n <= pieces).select(F.col("row").alias("a"), F.explode(forms).alias("k")))
    shorter = F.least(F.length(f"a.{text}"), F.length(f"b.{text}"))
    found = probe.join(index, "k").filter("a.name != b.name").withColumn("far", F.levenshtein(f"a.{text}", f"b.{text}", 2 * most)).filter((F.col("far") >= 0) & (F.col("far") <= F.when(shorter < 7, 2).otherwise(2 * most)))  # a swap counts two there
    once = found.select("a", "b", F.col("a.name").alias("an"), F.col("b.name").alias("bn")).repartition(tasks, "an").dropDuplicates(["an", "bn"]).drop("an", "bn")
    return once.withColumn("errors", banded(most)(F.col(f"a.{text}"), F.col(f"b.{text}"))).filter(F.col("errors") <= F.when(shorter < 7, 1).otherwise(most))


def banded(most: int):
    @F.pandas_udf("int")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([errors(x, y, most) for x, y in zip(a, b)], dtype="int32")

    return run


def rooted(links: DataFrame) -> DataFrame:
    """name, root: the end of each linked name's way along `links` (name, parent). Parents are strictly more frequent, earlier
    or of a fuller kind, so ways end; every round, cut off by a written table, halves what is left of them."""
    at = written(links.select("name", F.col("parent").alias("root")), "name-roots")
    while True:
        up = at.select(F.col("name").alias("root"), F.col("root").alias("next"))
        step = written(at.join(up, "root", "left").select("name", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "name-roots")
        at = step.select("name", "root")
        if step.filter("moved").isEmpty():
            return at


def linked(names: DataFrame) -> DataFrame:
    """name, parent for the names (name, kind, part, initial, core, known, n) that follow another."""
    person = F.col("kind") == "person"
    whole = F.col("part") != ""
    initial = F.concat_ws("||", "kind", F.when(person, F.col("initial")).otherwise(""))
    # role: w whole, s short, u whole with its given name as text; those that are only looked up have capitals
    places = F.array_compact(
        F.array(
            F.when(whole, F.struct(F.lit("w").alias("role"), F.concat_ws("|", "kind", "part").alias("block"), F.col("core").alias("text"))),
            F.struct(F.when(whole, "W").otherwise("s").alias("role"), initial.alias("block"), F.col("core").alias("text")),
            F.when(whole & person, F.struct(F.when(F.col("known"), "U").otherwise("u").alias("role"), F.concat_ws("?", "kind", "core").alias("block"), F.col("part").alias("text"))),
        )
    )
    rows = names.select("name", "n", F.explode(places).alias("p")).select("name", "n", "p.*")
    pairs = segment_join(rows, "block", "text", probes=F.col("role").isin("w", "s", "u"))
    given = F.lower("a.role") == "u"  # unknown given names of four letters and more, with one error at most
    fits = ~given | (F.col("errors") <= 1) & (F.length("a.text") >= 4)
    above = (F.col("b.n") > F.col("a.n")) | ((F.col("b.n") == F.col("a.n")) & (F.col("b.name") < F.col("a.name")))
    fuller = (F.col("a.role") == "s") & (F.col("b.role") == "W")
    known = given & (F.col("b.role") == "U")  # a given name that the corpus knows
    order = F.struct((~fuller).alias("less"), "errors", (-F.col("b.n")).alias("n"), F.col("b.name").alias("name"))
    return pairs.filter(fits & (fuller | known | (F.col("b.role") == F.col("a.role")) & above)).groupBy(F.col("a.name").alias("name")).agg(F.min(order).alias("m")).select("name", F.col("m.name").alias("parent"))


def entities(fields: DataFrame, lore: Lore | None = None) -> DataFrame:
    """field_id, entity, for fields (field_id, value, ingested_at) that name somebody; the lore is learned from their values
    where none is given."""
    latest = Window.partitionBy("field_id").orderBy(F.col("ingested_at").desc_nulls_last(), F.col("value"))
    rows = written(fields.filter("value is not null").withColumn("d", F.row_number().over(latest)).filter("d = 1").select("field_id", "value"), "name-fields")
    lore = learn(rows) if lore is None else lore
    read = written(spellings(rows.groupBy("value").agg(F.count("*").alias("n")), lore).withColumn("name", F.concat_ws("|", "kind", "part", "initial", "core")), "name-spellings")
    names = read.groupBy("name", "kind", "part", "initial", "core", "known").agg(F.sum("n").alias("n"))
    roots = rooted(linked(names))
    return rows.join(read.select("value", "name"), "value").join(roots, "name", "left").select("field_id", F.coalesce("root", "name").alias("entity"))


def same_entity_pairs(members: DataFrame) -> DataFrame:
    """field_id_a < field_id_b of each two fields of one entity. The members of a large entity are cut into chunks by a hash,
    and each two chunks meet in a task of their own, so that no task has more than CHUNK times CHUNK pairs or so."""
    chunks = members.groupBy("entity").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    mine = F.pmod(F.xxhash64("field_id"), F.col("chunks")).cast("int")
    rows = members.join(chunks, "entity").select("entity", "field_id", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    keyed = rows.select(F.col("entity"), F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "field_id")
    a, b = (keyed.select("entity", "i", "j", F.col("mine").alias(f"mine_{x}"), F.col("field_id").alias(f"field_id_{x}")) for x in "ab")
    met = a.join(b, ["entity", "i", "j"]).filter((F.col("field_id_a") < F.col("field_id_b")) & ((F.col("i") == F.col("j")) | (F.col("mine_a") != F.col("mine_b"))))
    return met.select("field_id_a", "field_id_b")
