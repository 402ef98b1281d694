"""Hand-made cases of the column functions, edges first."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.functions import cells as C
from foliospark.functions import fields as L
from foliospark.functions import geometry as G
from foliospark.functions import images as I
from foliospark.functions import language as LA
from foliospark.functions import text as T
from foliospark.operators import fuzzy as Z


def one(spark, values, f, schema="t string"):
    rows = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in rows.select(f(F.col("t"))).collect()]


def test_text(spark):
    assert one(spark, ["  a \t b\n", None, "", " "], T.normalize_basic) == ["a b", "", "", ""]
    assert one(spark, ["a ,b", "hello  world .Next", "inter-\nnational", None], T.fix_spacing) == ["a, b", "hello world. Next", "international", None]
    assert one(spark, ["he11o", "w0rd", "te|l"], T.substitute_chars) == ["hel1o", "word", "tell"]
    assert one(spark, ["1 234", "2O24", "1 2 3", "5O,"], T.fix_numbers) == ["1234", "2024", "12 3", "50,"]
    assert one(spark, ["Teh cornpany, (adn) ADN"], T.correct_words) == ["The company, (and) AND"]
    assert one(spark, ["a ~ b!!! ─", "x\x00y"], T.remove_artifacts) == ["a b! ", "xy"]
    assert one(spark, ["“a” ‘b’ «c»"], T.normalize_quotes) == ['"a" \'b\' "c"']
    assert one(spark, ["“a” «c»"], lambda c: T.normalize_quotes(c, compat=True)) == ['“a” "c"']
    assert one(spark, ["ﬁle… x"], T.normalize_full) == ["file... x"]
    assert one(spark, ["a<b>:c. ", None], T.clean_filename) == ["a_b__c", None]
    assert one(spark, [None, ""], T.correct_text) == ["", ""]


def test_quality(spark):
    score = lambda c: F.round(T.quality_score(c, F.lit(50.0)), 3)
    assert one(spark, [None, " ", "ab cd"], score) == [0.0, 0.0, 20 + 20 + 20 + 10.0]
    assert one(spark, [None, "a b c d", "l i l", "long words here"], lambda c: T.likely_handwritten(c, F.lit(90.0))) == [False, True, True, False]
    assert one(spark, [None, "", "......", "ababababab", "aaaaaX", "ABCDEFGHIJKLMNOPQ", "fine text", "--==--"], T.valid_output) == [False, False, False, False, False, False, True, False]


def test_similarity(spark):
    rows = spark.createDataFrame([("hello", "hello"), ("hello", "help"), ("a", "A"), (None, "x"), ("", "")], "a string, b string")
    got = [round(r[0], 4) for r in rows.select(T.similarity(F.col("a"), F.col("b"))).collect()]
    assert got == [1.0, 0.4, 1.0, 0.0, 0.0]


def test_geometry(spark):
    boxes = spark.createDataFrame([(0.0, 0.0, 10.0, 10.0, 5.0, 0.0, 15.0, 10.0), (0.0, 0.0, 1.0, 1.0, 1.0, 0.0, 2.0, 1.0), (0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)], "ax1 double, ay1 double, ax2 double, ay2 double, bx1 double, by1 double, bx2 double, by2 double")
    a, b = G.Box.of("a"), G.Box.of("b")
    assert [round(r[0], 4) for r in boxes.select(G.iou(a, b)).collect()] == [0.3333, 0.0, 0.0]
    row = boxes.select(a.cx, a.cy).first()
    assert (row[0], row[1]) == (5.0, 5.0)
    named = spark.createDataFrame([({"left": 1.0, "top": 2.0, "x2": 3.0, "bottom": 4.0},)], "m map<string,double>")
    assert tuple(named.select(*G.read_box(F.col("m")).columns()).first()) == (1.0, 2.0, 3.0, 4.0)


def test_noise(spark):
    rows = spark.createDataFrame(
        [(None, None, None, None, "x", 10.0), (500.0, 500.0, 600.0, 520.0, "x", 90.0), (500.0, 500.0, 600.0, 520.0, "", 90.0), (0.0, 0.0, 5.0, 5.0, "word", 29.9), (0.0, 0.0, 5.0, 5.0, "word", 30.0), (500.0, 500.0, 600.0, 520.0, "..a", None)],
        "x1 double, y1 double, x2 double, y2 double, c string, k double",
    )
    n = lambda **k: [r[0] for r in rows.select(G.noise_artifact(G.Box.of(), F.col("c"), F.col("k"), F.lit(1000.0), F.lit(1000.0), **k)).collect()]
    assert n() == [False, True, False, True, False, False]
    assert n(empty_is_noise=True)[2] is True


def test_dates_and_phones(spark):
    dates = ["1/5/75", "01/05/2024", "Jan 5, 2024", "Jan 5 2024", "13/45/99", "1-5-68", "1-5/68", "2024-01-05", " x ", None]
    assert one(spark, dates, L.iso_date) == ["1975-01-05", "2024-01-05", "2024-01-05", "2024-01-05", "13/45/99", "2068-01-05", "1-5/68", "2024-01-05", "x", ""]
    phones = ["(555) 010-1234", "1 555 010 1234", "5550101", "+49 30 1", "none", None]
    assert one(spark, phones, L.e164) == ["+15550101234", "+15550101234", "+5550101", "+49301", "none", None]


def test_labels(spark):
    assert one(spark, ["Fax No: 1", "Date / Datum", "123456789date", "12345678 date", "1234567890 date", "telephone", None, "To"], L.label_key) == ["fax", "date", None, "date", None, None, None, "to"]


def test_key_values(spark):
    rows = spark.createDataFrame([("Date: 1/2\nto:  A: B\nx: 1\nfrom: N/A\nnothing",), (None,)], "t string")
    got = [[tuple(x) for x in r[0]] for r in rows.select(L.key_values(F.col("t"))).collect()]
    assert got == [[("date", "1/2"), ("to", "A: B")], []]
    assert one(spark, [["a", " ", "b"]], L.page_summary, "t array<string>") == ["[Block 0] a\n[Block 2] b"]


def test_cells(spark):
    assert one(spark, ["$5", "x", "Name", "IIUU xkcdf", "12%", "qwrtp", "Smith", None], C.is_table_content) == [True, False, True, False, True, False, True, False]
    assert one(spark, ["Total:", "total", "", None, "Smith"], C.is_label_only) == [True, True, True, True, False]
    assert one(spark, ["Please call us", "ok"], C.is_disclaimer) == [True, False]
    assert one(spark, [[], ["$5", "", "Smith"], ["please call", "$5"], ["Date:", "Name:", "$5"]], C.content_score, "t array<string>") == [0.0, pytest.approx(2 / 3), 0.1, 0.2]


def test_codes(spark):
    words = ["AB12", "2024", "01/05/2024", "(555) 010-1234", "12345-6789", "a@b", "@b", "$1,200.50", "#12", "http://x", "word"]
    assert one(spark, words, Z.is_code) == [True, True, True, True, True, False, True, True, True, True, False]
    assert one(spark, ["abc", "ABCDE", "ABCDEF", "don't", "wörd", "a_bcd"], Z.skipped) == [True, True, False, False, False, True]
    assert one(spark, ["ABC", "Abc", "aBc"], lambda c: Z.case_pattern(c, F.lit("wOrd"))) == ["WORD", "Word", "word"]


def test_language(spark):
    assert one(spark, ["eng", "eng+tur", "eng+osd"], LA.packs_available) == [True, False, True]
    got = one(spark, ["short", "Date: 1 please number the company of the page to be fine", None], lambda c: LA.decision(c, F.lit("tr"), F.lit(0.7))["lang_iso"])
    assert got == ["en", "en", "en"]


def test_images():
    rng = np.random.default_rng(1)
    flat = np.full((40, 60), 200, np.uint8)
    m = I.metrics(flat)
    assert m["brightness"] == 200 and m["contrast"] == 0 and m["laplacian_variance"] == 0 and m["text_density"] == 0
    noisy = rng.integers(0, 256, (40, 60)).astype(np.uint8)
    assert I.metrics(noisy)["laplacian_variance"] > 1500
    text = flat.copy()
    for y in range(5, 35, 8):
        text[y : y + 2, 5:55] = 0
    assert I.metrics(text)["skew_angle"] == 0 and 0.1 < I.metrics(text)["text_density"] < 0.3
    assert len([r for r in I.rules_of(I.ink(text), 40) if r[0] == "h"]) == 8
    assert (I.without_rules(text) == 200).sum() + (I.without_rules(text) == 255).sum() == text.size
    assert I.components(I.ink(text))[1] == 4
    assert I.scale2(text).shape == (80, 120) and set(I.STRATEGIES) == {"original", "contrast", "sharpen", "clean", "scale"}
    assert I.handwriting_features(flat[:5]) is None and I.handwriting_features(text)["num_components"] == 4
    sq = np.zeros((50, 50), np.uint8)
    sq[10:31, 5:46] = 255
    assert I.four_point_transform(sq, I.document_corners(sq)).min() == 255
    assert I.decode(1, 2, 3, bytes(range(6)))[0, 1].tolist() == [3, 4, 5]
