"""Operators against brute force, on edges, and their plans."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from foliospark.operators import boxes as B
from foliospark.operators import fields as FO
from foliospark.operators import fuzzy as Z
from foliospark.operators import grouping as G
from foliospark.operators import nested as N
from foliospark.operators import routing as R
from foliospark.operators import spatial as S
from foliospark.operators import tables as T
from foliospark.plans.nested_queries import PAGE_RECORD

K = ["file", "page"]


def boxes_of(rng, n, pages=3):
    out = []
    for i in range(n):
        x, y = rng.randint(0, 1500), rng.randint(0, 1500)
        out.append((f"f{rng.randint(1, pages)}", 1, i, float(x), float(y), float(x + rng.randint(1, 600)), float(y + rng.randint(1, 600)), float(rng.randint(0, 20))))
    return out


BOXES = "file string, page int, idx int, x1 double, y1 double, x2 double, y2 double, score double"


def iou(a, b):
    w, h = min(a[5], b[5]) - max(a[3], b[3]), min(a[6], b[6]) - max(a[4], b[4])
    if w <= 0 or h <= 0:
        return 0.0
    area = lambda r: (r[5] - r[3]) * (r[6] - r[4])
    return w * h / (area(a) + area(b) - w * h)


def test_near_pairs_finds_every_pair_once(spark):
    rows = boxes_of(random.Random(1), 120)
    df = spark.createDataFrame(rows, BOXES)
    for reach in (0.0, 200.0):
        got = sorted((r.a_idx, r.b_idx) for r in S.near_pairs(df, df, K, reach).collect())
        want = sorted((a[2], b[2]) for a in rows for b in rows if a[0] == b[0] and b[3] <= a[5] + reach and b[5] >= a[3] - reach and b[4] <= a[6] + reach and b[6] >= a[4] - reach)
        assert got == want


def test_near_pairs_plan(spark):
    df = spark.createDataFrame(boxes_of(random.Random(1), 5), BOXES)
    plan = S.near_pairs(df, df, K)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_suppression(spark):
    rows = boxes_of(random.Random(2), 150)
    got = sorted(r.idx for r in B.suppressed(spark.createDataFrame(rows, BOXES), K, "idx", "score").collect())
    want = []
    for f in {r[0] for r in rows}:
        kept = []
        for r in sorted((r for r in rows if r[0] == f), key=lambda r: (-r[7], r[2])):
            if all(iou(r, k) < 0.5 for k in kept):
                kept.append(r)
        want += [k[2] for k in kept]
    assert got == sorted(want)


def test_merging(spark):
    rows = [("a", 1, 0, "x", 0.0, 0.0, 10.0, 10.0), ("a", 1, 1, "", 1.0, 0.0, 11.0, 10.0), ("a", 1, 2, None, 100.0, 0.0, 110.0, 10.0), ("a", 1, 3, "y", 2.0, 0.0, 12.0, 10.0), ("b", 1, 0, "z", None, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "file string, page int, block_idx int, content string, x1 double, y1 double, x2 double, y2 double")
    got = sorted(tuple(r) for r in B.merged_overlaps(df, K).collect())
    assert got == [("a", 1, 0, "x y", 0.0, 0.0, 12.0, 10.0, 3), ("a", 1, 2, "", 100.0, 0.0, 110.0, 10.0, 1)]
    assert B.merged_overlaps(df.limit(0), K).count() == 0


def test_gap_chains(spark):
    df = spark.createDataFrame([("a", v) for v in (10.0, 12.0, 50.0, 52.0, 100.0)], "file string, v double")
    assert sorted(r.centre for r in G.cluster_centres(df, ["file"], F.col("v"), 10.0).collect()) == [11.0, 51.0, 100.0]
    edge = spark.createDataFrame([("a", v) for v in (0.0, 10.0, 20.5)], "file string, v double")
    assert sorted(r.centre for r in G.cluster_centres(edge, ["file"], F.col("v"), 10.0).collect()) == [5.0, 20.5]
    assert G.cluster_centres(df.limit(0), ["file"], F.col("v")).count() == 0


def test_dbscan_labels(spark):
    rng = random.Random(3)
    vals = [(i, float(rng.randint(0, 600))) for i in range(60)]
    got = {r.i: r.c for r in G.dbscan_1d(spark.createDataFrame([("f", i, v) for i, v in vals], "file string, i int, v double"), ["file"], F.col("v"), 12.0, ["i"], "c").collect()}
    core = {i: sum(abs(v - w) <= 12 for _, w in vals) >= 2 for i, v in vals}
    label, want = -1, {}
    for i, v in vals:  # density clustering point by point
        if i in want or not core[i]:
            continue
        label += 1
        todo = [(i, v)]
        while todo:
            j, w = todo.pop()
            if j not in want:
                want[j] = label
                todo += [(k, u) for k, u in vals if abs(u - w) <= 12 and k not in want]
    assert got == {i: want.get(i, -1) for i, _ in vals}


def test_word_blocks(spark):
    w = [("a", 0, 10, 0, 50, 10, 90.0, "one"), ("a", 1, 70, 0, 50, 10, 90.0, "two"), ("a", 2, 221, 0, 50, 10, 90.0, "far"), ("a", 3, 10, 20, 50, 10, 90.0, "twenty"), ("a", 4, 10, 41, 50, 10, 90.0, "below"), ("a", 5, 99, 41, 9, 9, 30.0, "unsure"), ("a", 6, 99, 41, 9, 9, 99.0, " ")]
    df = spark.createDataFrame(w, "file string, word_idx int, left int, top int, width int, height int, conf double, text string")
    assert [r.content for r in G.word_blocks(df, ["file"]).orderBy("grp").collect()] == ["one two", "far twenty", "below"]


def test_fields_by_location_against_brute_force(spark, data):
    from foliospark.plans.base import blocks

    rows = blocks(spark, data)
    found = FO.candidates(rows, K)
    got = {(r.file, r.page, r.key): (r.label_idx, r.value_idx, r.direction) for r in FO.resolve(found, K).collect()}
    by_page = {}
    for r in found.collect():
        by_page.setdefault((r.file, r.page), []).append(r)
    want = {}
    for (f, p), cs in by_page.items():
        used, done = set(), set()
        for label in sorted({(c.label_idx, c.key) for c in cs}):
            if label[1] in done:
                continue
            free = [c for c in cs if c.label_idx == label[0] and c.value_idx not in used]
            if free:
                best = min(free, key=lambda c: (c.distance, c.value_idx))
                want[f, p, label[1]] = (label[0], best.value_idx, best.direction)
                used.add(best.value_idx)
                done.add(label[1])
    assert got == want and want


def test_retry_and_ensemble(spark):
    tries = spark.createDataFrame([(1, 0, "a", "x", 40.0), (1, 1, "b", "y", 50.0), (1, 2, "c", "z", 90.0), (2, 0, "a", "x", 10.0), (2, 1, "b", "y", 10.0)], "r int, strategy_no int, strategy string, text string, confidence double")
    assert sorted((x.r, x.strategy) for x in R.retry(tries, ["r"]).collect()) == [(1, "b"), (2, "a")]
    reads = spark.createDataFrame([(1, "tesseract", "word one", 80.0), (1, "surya", "word one", 80.0), (2, "paddle", " ", None), (3, "surya", "abc", 50.0)], "r int, engine string, text string, confidence double")
    assert sorted((x.r, x.engine) for x in R.ensemble(reads, ["r"]).collect()) == [(1, "tesseract"), (3, "surya")]


def test_costly_engines_see_only_their_rows(spark):
    seen = spark.sparkContext.accumulator(0)

    def call(df):
        def run(it):
            for pdf in it:
                seen.add(len(pdf))
                yield pdf

        return df.mapInPandas(run, df.schema)

    df = spark.range(100)
    assert R.needs(df, F.col("id") < 5, call).count() == 100 and seen.value == 5


def test_fuzzy(spark):
    terms = spark.createDataFrame([("signature",), ("message",), ("time",), ("messages",)], "term string")
    words = spark.createDataFrame([("signatuer",), ("mesage",), ("tmie",), ("xxxxxx",)], "word string")
    assert {r.word: r.term for r in Z.best_terms(words, terms).collect()} == {"mesage": "message", "signatuer": "signature"}  # a swap is one edit
    texts = spark.createDataFrame([(1, "The MESAGE, (Mesage) ok\n"), (2, None), (3, "")], "id int, t string")
    got = {r.id: (r.corrected, r.n_changed) for r in Z.corrected(texts, "id", "t", terms).collect()}
    assert got == {1: ("The MESSAGE, (Message) ok\n", 2), 2: ("", 0), 3: ("", 0)}
    s = {(r.word, r.rank): r.term for r in Z.suggestions(words, terms).collect()}
    assert s["xxxxxx", 1] == "xxxxxx" and s["mesage", 1] == "message"
    g = spark.createDataFrame([("hello world", "hello word"), ("hello world", "x"), ("abcdefgh", "zyxwvuts"), (None, "x")], "a string, b string")
    assert [r[0] for r in g.select(Z.guarded(F.col("a"), F.col("b"))).collect()] == ["hello word", "hello world", "abcdefgh", None]


def test_merged_cells(spark):
    grid = spark.createDataFrame([("t", [0.0, 10.0, 20.0], [0.0, 10.0, 20.0])], "file string, ys array<double>, xs array<double>")
    lines = spark.createDataFrame([("t", "h", 10.0, 10.0, 20.0), ("t", "v", 10.0, 0.0, 20.0)], "file string, axis string, p double, a double, b double")
    got = sorted(tuple(r)[1:] for r in T.merged_cells(grid, lines, ["file"], 3.0).collect())
    assert got == [(0, 0, 2, 1), (0, 1, 1, 1), (1, 1, 1, 1)]


def test_exports(spark):
    cells = spark.createDataFrame([("t", 0, 0, 1, 2, 'a|"b"'), ("t", 1, 0, 1, 1, None), ("t", 1, 1, 1, 1, "c,d")], "file string, row int, col int, row_span int, col_span int, text string")
    assert T.to_markdown(cells, ["file"]).first().markdown == '| a\\|"b" [↔2×↕1] | ↑ |\n| --- | --- |\n|  | c,d |'
    assert T.to_html(cells, ["file"]).first().html == '<table>\n<tr><td colspan="2">a|"b"</td></tr>\n<tr><td></td><td>c,d</td></tr>\n</table>'
    assert T.to_csv(cells, ["file"]).first().csv == '"a|""b""",\r\n,"c,d"\r\n'
    assert T.to_csv(cells, ["file"], flat=True).first().csv == '"a|""b""","a|""b"""\r\n,"c,d"\r\n'
    assert T.to_csv(cells.limit(0), ["file"]).count() == 0


# ---- nested records ------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ([1, 2, 3, 4], [1, 2, 3, 4]), ([[1, 2], [3, 4]], [1, 2, 3, 4]), ("1, 2,3,4", [1, 2, 3, 4]), (["1", "2", "3", "4"], [1, 2, 3, 4]), ({"x1": 1, "y1": 2, "x2": 3, "y2": 4}, [1, 2, 3, 4]), ({"left": 1, "top": 2, "right": 3, "bottom": 4}, [1, 2, 3, 4]),
        ({"points": [[1, 2], [3, 2], [3, 4], [1, 4]]}, [1, 2, 3, 4]), ([1, 2, 3], None), ({}, None), ("", None), (None, None), ([], None), ({"x1": 1, "y1": 2}, None), ([1, 2, 3, None], None), ([True, 1, 2, 3], None), ("a,b,c,d", None), ([1, 2, 3, float("nan")], None),
    ],
)
def test_boxes_in_any_notation(value, want):
    assert N.box(value) == want


def brute(payload):
    """Valid boxes of a page record, walked by hand."""
    try:
        v = json.loads(payload)
    except (TypeError, ValueError):
        return []
    out = []
    as_json = lambda x: json.loads(x) if isinstance(x, str) else x
    good = lambda e: (b := next((N.box(e[k]) for k in ("bounding_box", "boundingBox", "bbox") if k in e), None)) and b[2] > b[0] and b[3] > b[1]
    for d in v.get("documents", [v]):
        pages = as_json(d["pages"])
        if isinstance(pages, dict):
            pages = [{**as_json(p), "page": k} for k, p in pages.items()] if all(k.isdigit() for k in pages) else [pages]
        for p in map(as_json, pages):
            els = as_json(p.get("elements", (p.get("layout") or {}).get("elements"))) or []
            for i, e in enumerate(els):
                if good(e):
                    out.append((int(p["page"]), i, -1))
                cells = e.get("cells") or [c for r in e.get("rows") or [] for c in r["cells"]]
                out += [(int(p["page"]), i, k) for k, c in enumerate(cells) if good(c)]
    return out


def test_p2_against_brute_force(spark):
    from foliospark.plans.nested_queries import p2_found

    folder = "/root/testdata/sf0.01"
    got = sorted(tuple(r) for r in p2_found(spark, folder).collect())
    want = sorted({(r.rec_id, *x) for r in spark.read.parquet(f"{folder}/page_records.parquet").collect() for x in brute(r.payload)})
    assert got == want and len(got) > 1000


def test_inlining():
    graph = [("record", "a", True), ("a", "b", False), ("b", "c", False), ("x", "c", False), ("a", "r", False), ("r", "r", False), ("a", "x", False)]
    assert N.inline(graph) == {"record", "a", "c", "r"}


def test_nested_edges(spark):
    rows = [(1, None), (2, ""), (3, "[1]"), (4, "{"), (5, '{"pages": []}'), (6, '{"pages": [{"page": 1, "elements": [null, 3, {"bbox": [0, 0, 1, 1]}]}]}'), (6, '{"pages": [{"page": 1, "elements": [null, 3, {"bbox": [0, 0, 1, 1]}]}]}')]
    df = spark.createDataFrame(rows, "rec_id bigint, payload string")
    graph = [tuple(r) for r in N.schema_graph(df, "payload", PAGE_RECORD).collect()]
    got = N.shred(df, "rec_id", "payload", PAGE_RECORD, N.inline(graph)).filter("tbl = 'elements'").select("rec_id", "pos", F.col("vals")["bounding_box_right"].alias("right")).distinct().collect()
    assert [tuple(r) for r in got] == [(6, 2, "1.0")]
    assert N.shred(df.limit(0), "rec_id", "payload", PAGE_RECORD, {"record"}).count() == 0


def test_nested_latest_and_typed(spark):
    page = lambda n, t: json.dumps({"pages": [{"page": n, "note": t, "elements": [{"type": "Table", "ok": True, "bbox": [0, 0, 2, 1], "node_id": "7", "cells": [{"row": 0, "text": "a", "bbox": [0, 0, 1, 1]}]}, 5]}]})
    rows = [(1, page(1, "old"), 1), (1, page(2, "new"), 5), (1, page(2, "new")[:-4], 9), (1, None, 12), (2, None, 1), (3, "{", 1), (4, page(3, "4"), None)]
    df = spark.createDataFrame(rows, "rec_id bigint, payload string, received_at int").withColumn("tbl", F.lit("clash"))
    kept = N.latest(df, "rec_id", "payload", "received_at")
    assert sorted((r.rec_id, (r.payload or "")[:12]) for r in kept.collect()) == [(1, '{"pages": [{'), (3, "{"), (4, '{"pages": [{')]
    shredded = N.shred(kept, "rec_id", "payload", PAGE_RECORD, N.inline([tuple(r) for r in N.schema_graph(df, "payload", PAGE_RECORD).collect()]))
    pages, elements, cells = (N.typed(shredded, "rec_id", t) for t in ("pages", "elements", "cells"))
    assert sorted((r.rec_id, r.page, r.note, r.elements_values) for r in pages.collect()) == [(1, 2.0, "new", "[5]"), (4, 3.0, "4", "[5]")]
    assert dict(elements.dtypes)["ok"] == "boolean" and dict(elements.dtypes)["bounding_box_right"] == "double" and "node_id_value" in elements.columns
    up = elements.alias("e").join(pages.alias("p"), (F.col("e.rec_id") == F.col("p.rec_id")) & (F.col("e.parent_id") == F.col("p.node_id")))
    down = cells.alias("c").join(elements.alias("e"), (F.col("c.rec_id") == F.col("e.rec_id")) & (F.col("c.parent_id") == F.col("e.node_id")))
    assert up.count() == 2 and down.count() == 2
    assert N.typed(shredded.limit(0), "rec_id", "pages").count() == 0


def test_swaps_are_one_edit(spark):
    words = ["recieve", "certificaet", "cretificaet", "departmnet", "signature", "letter", "lettre", "certificates", "xxxxxxxx"]
    terms = ["receive", "certificate", "department", "signature", "letter"]
    got = {(r.word, r.term): r.distance for r in Z.near_terms(spark.createDataFrame([(w,) for w in words], "word string"), spark.createDataFrame([(t,) for t in terms], "term string")).collect()}
    assert got == {("recieve", "receive"): 1, ("certificaet", "certificate"): 1, ("cretificaet", "certificate"): 2, ("departmnet", "department"): 1, ("signature", "signature"): 0, ("letter", "letter"): 0, ("lettre", "letter"): 1, ("certificates", "certificate"): 1}


def test_ratio_matches_against_all_pairs(spark):
    rng = random.Random(3)
    terms = {"".join(rng.choice("abcde") for _ in range(rng.randint(4, 11))) for _ in range(60)}
    words = {"".join(c for c in t if rng.random() > 0.12) + rng.choice(["", "x"]) for t in terms}
    words = {w for w in words if len(w) >= 4}

    def ratio(x, y):
        row = [0] * (len(y) + 1)
        for c in x:
            left = 0
            for j, d in enumerate(y, 1):
                up = row[j]
                row[j] = left + 1 if c == d else max(up, row[j - 1])
                left = up
        return 2 * row[-1] / (len(x) + len(y))

    want = {}
    for w in words:
        best = max(((ratio(w, t), t) for t in terms if abs(len(w) - len(t)) <= 2), key=lambda x: (x[0], [-ord(c) for c in x[1]]), default=(0, ""))
        if best[0] >= 0.8:
            want[w] = round(best[0], 9)
    got = {r.word: round(r.ratio, 9) for r in Z.ratio_matches(spark.createDataFrame([(w,) for w in words], "word string"), spark.createDataFrame([(t,) for t in terms], "term string")).collect()}
    assert got == want and len(got) > 20
