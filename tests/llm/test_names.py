from __future__ import annotations

import random

import pytest

from foliospark.llm import names as N
from foliospark.llm.lore import Lore

LORE = Lore({"elizabeth": "elizabeth", "beth": "elizabeth", "robert": "robert", "bob": "robert", "lorenzo": "lorenzo"}, {"manufacturing": "manufacturing", "manuf": "manufacturing", "mfg": "manufacturing", "plumbing": "plumbing"}, frozenset({"beth", "bob"}))


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("Elizabeth M. Brilmaigeodund", ("person", "elizabeth", "e", "brilmaigeodund")), ("Brilmaigeodund, Beth", ("person", "elizabeth", "e", "brilmaigeodund")), ("R Drumbeofatund", ("person", "", "r", "drumbeofatund")), ("Attn: Robert \"Bob\" Drumbeofatund", ("person", "robert", "r", "drumbeofatund")),
        ("Manuf. Milmaigeoneon Brothers", ("org", "manufacturing", "", "milmaigeoneon")), ("The Milmaigeoneon Mfg G.m.b.H.", ("org", "manufacturing", "", "milmaigeoneon")), ("Lorenzo  Menkopainell, Claims", ("person", "lorenzo", "l", "menkopainell")), ("Claims desk", None), ("Dept 5", None), ("-", None), ("", None), (None, None), ("All branches", None),
    ],
)
def test_reading(value, want):
    got = N.Reader(LORE).read(value)
    assert got == (want and (*want, True))


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("Brandon Whitfield", ("person", "brandon", "b", "whitfield", False)), ("Whitfield, Bruno", ("person", "bruno", "b", "whitfield", False)), ("Acme Plumbing", ("org", "plumbing", "", "acme", True)), ("Acme Roofing", ("org", "roofing", "", "acme", True)), ("Robert Fleming", ("person", "robert", "r", "fleming", True)), ("Fleming, Brandon", ("person", "brandon", "b", "fleming", False)), ("Kestrel Roofing Ltd", ("org", "roofing", "", "kestrel", True)), ("Kestrel Ltd", ("org", "", "", "kestrel", True)),
    ],
)
def test_reading_of_no_list(value, want):
    assert N.Reader(LORE).read(value) == want


def test_near_forms_against_all_forms():
    rng = random.Random(8)
    forms = {"".join(rng.choice("abcde") for _ in range(rng.randint(5, 9))): "" for _ in range(200)}
    forms = {f: f for f in forms}
    near = N.Near(forms, lambda w: 2 if len(w) >= 7 else 1)
    for f in rng.sample(sorted(forms), 80):
        w = list(f)
        i = rng.randrange(len(w))
        w[i : i + 1] = [[], ["x"], [w[i], "x"]][rng.randrange(3)]
        w = "".join(w)
        most = 2 if len(w) >= 7 else 1
        want = min(((d, g) for g in forms if (d := plain_distance(w, g)) <= most), default=None)
        assert near[w] == (want and want[1])


def plain_distance(a, b):
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if not i or not j:
                d[i][j] = i + j
                continue
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_banded_distance():
    rng = random.Random(4)
    for _ in range(2000):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 8))) for _ in range(2))
        for most in (1, 2, 3):
            assert N.errors(a, b, most) == min(plain_distance(a, b), most + 1)


def test_segment_join_finds_all_near_pairs(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(6, 12))) for _ in range(40)]
    texts = set(base)
    for b in base:  # one or two letters changed, left out or added
        for _ in range(3):
            t = list(b)
            for _ in range(rng.randint(1, 2)):
                i, k = rng.randrange(len(t)), rng.randrange(3)
                t[i : i + (k != 1)] = [] if k == 0 else [rng.choice("abcdefgh")]
            texts.add("".join(t))
    df = spark.createDataFrame([(t, "k", t) for t in texts], "name string, block string, core string")
    got = {(r.a.core, r.b.core) for r in N.segment_join(df, "block", "core").collect()}

    def levenshtein(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i] + [0] * len(b) if not (old := row) else (lambda o: [i] + [0] * len(b))(old)
            for j, y in enumerate(b, 1):
                row[j] = min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y))
        return row[-1]

    for a in texts:
        for b in texts:
            most = 1 if min(len(a), len(b)) < 7 else 2
            if a != b and levenshtein(a, b) <= most:
                assert (a, b) in got, (a, b)
            if (a, b) in got:
                assert plain_distance(a, b) <= most


def test_entities(spark):
    rows = [
        (1, "Robert Drumbeofatund", "x"), (2, "Drumbeofatund, Bob", "x"), (3, "R. Drumbeofatund", "x"), (4, "Robert Drumbeofatnud", "x"), (5, "Yolanda Drumbeofatund", "x"), (6, "Milmaigeoneon Foods Ltd", "x"), (7, "Milmaigeoneon Fds", "x"), (8, "Milmaigeoneon Printing Ltd", "x"),
        (9, None, "x"), (10, "", "x"), (11, "File copy", "x"), (1, "Robert Drumbeofatund", "x"), (12, "Robert Drumbeofatund", "x"),
    ]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "field_id bigint, value string, part string").withColumn("ingested_at", F.lit(None).cast("timestamp"))
    got = sorted(tuple(r) for r in N.same_entity_pairs(N.entities(df)).distinct().collect())
    same = [1, 2, 3, 4, 12]
    assert got == sorted([(a, b) for a in same for b in same if a < b] + [(6, 7)])
    assert N.entities(df.limit(0)).count() == 0


def test_entities_do_not_depend_on_how_often_rows_occur(spark):
    from pyspark.sql import functions as F

    names = [("Robert Drumbeofatund", 5), ("Robert Drumbeofatnud", 3), ("Robert Drumbeofatumd", 2), ("Milmaigeoneon Foods Ltd", 4), ("Milmaigeonecn Foods Ltd", 3), ("Yolanda Drumbeofatund", 3)]

    def groups(times):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(v for v, n in names for _ in range(n * times))], "field_id bigint, value string").withColumn("ingested_at", F.lit(None).cast("timestamp"))
        by = N.entities(df).join(df, "field_id").groupBy("entity").agg(F.collect_set("value").alias("v")).collect()
        return {frozenset(r.v) for r in by}

    want = {frozenset(v for v, _ in names[:3]), frozenset(v for v, _ in names[3:5]), frozenset(v for v, _ in names[5:])}
    assert groups(10) == want


def test_segment_join_finds_swaps_across_cuts(spark):
    rng = random.Random(6)
    texts = {"milmaigeoneon", "milamigeonxon"}
    for _ in range(60):  # a swap and another edit, or two swaps
        t = list(b := "".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(3, 14))))
        for k in (0, rng.randrange(4)):
            i = rng.randrange(len(t) - 1)
            t[i : i + 2] = [[t[i + 1], t[i]], [t[i]], [t[i], "x", t[i + 1]], ["x", t[i + 1]]][k]
        texts |= {b, "".join(t)}
    texts = {x for x in texts if len(x) >= 3}
    df = spark.createDataFrame([(x, "k", x) for x in texts], "name string, block string, core string")
    got = {(r.a.core, r.b.core) for r in N.segment_join(df, "block", "core").collect()}
    assert ("milmaigeoneon", "milamigeonxon") in got
    assert got == {(a, b) for a in texts for b in texts if a != b and plain_distance(a, b) <= (1 if min(len(a), len(b)) < 7 else 2)}


def test_segment_join_of_short_names(spark):
    texts = ["ng", "ngo", "gn", "li", "lim", "wu", "a", "ab", "wuxy"]
    df = spark.createDataFrame([(x, "k", x) for x in texts], "name string, block string, core string")
    got = {(r.a.core, r.b.core) for r in N.segment_join(df, "block", "core").collect()}
    assert got == {(a, b) for a in texts for b in texts if a != b and plain_distance(a, b) <= 1} and ("ng", "ngo") in got


def groups_of(spark, values):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(list(enumerate(values)), "field_id bigint, value string").withColumn("ingested_at", F.lit(None).cast("timestamp"))
    return {frozenset(r.v) for r in N.entities(df).join(df, "field_id").groupBy("entity").agg(F.collect_set("value").alias("v")).collect()}


def test_people_with_unknown_given_names_stay_apart(spark):
    values = ["Brandon Whitfield"] * 3 + ["Brandn Whitfield", "Brandon Whitfeild", "Barbara Whitfield", "Whitfield, Bruno", "Acme Plumbing", "Acme Plumbing Ltd"]
    assert groups_of(spark, values) == {frozenset(["Brandon Whitfield", "Brandn Whitfield", "Brandon Whitfeild"]), frozenset(["Barbara Whitfield"]), frozenset(["Whitfield, Bruno"]), frozenset(["Acme Plumbing", "Acme Plumbing Ltd"])}


def test_pairs_of_a_large_entity_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(N, "CHUNK", 7)
    rows = [(i, "big") for i in range(50)] + [(100, "two"), (101, "two"), (200, "one"), (300, None)]
    got = [tuple(r) for r in N.same_entity_pairs(spark.createDataFrame(rows, "field_id bigint, entity string")).collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a in range(50) for b in range(a + 1, 50)} | {(100, 101)}
