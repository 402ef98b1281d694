from __future__ import annotations

import pytest

from foliospark.llm import pii as P
from foliospark.llm.lore import Lore, learn

LORE = Lore({n: n for n in "chiara dolores ayse lorenzo".split()}, {"foods": "foods"})
FIND = P.Finder(frozenset("the and is claimant gave passport as proof of identity lives at please call order invoice on at by signed with".split()), LORE).find


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Mail a.b+c@postbox.test now", [("email", 5)]), ("write to ann [at] inbox [dot] example [dot] org", [("email", 9)]), ("x ann (at) postbox.test", [("email", 2)]), ("ann_b@\npostbox.test", [("email", 0)]), ("18 @ 6.06", []), ("@ desk 4", []),
        ("Tel. 555 O18 6108", [("phone", 5)]), ("Fax (555) 010-1234 ext. 9", [("phone", 4)]), ("+49 (0)30 23125-970", [("phone", 0)]), ("Order No. 441-39-9116", []), ("Invoice 61690674", []), ("Ref. 0777 827 638", []), ("12/25/2005", []), ("lot number 7726-2201", []),
        ("gave 972-95-9708 as proof", [("id_number", 5)]), ("DNI 00542286-I", [("id_number", 4)]), ("QQ 07 15 64 Z", [("id_number", 0)]), ("SSN 900093139", [("id_number", 4)]), ("40-19-118", []),
        ("Flat 6, 228 Old Ferry Court, Brellham", [("address", 0)]), ("140 rue des Tilleuls\n99583 Saint-Auvre", [("address", 0)]), ("Postfach 188, 00710 Brunnstadt", [("address", 0)]), ("C/ Molino Viejo, 148, 2.º B", [("address", 0)]), ("Via fax 8/9", []), ("Im März 2024 kam", []), ("Box 026, shelf 3", []),
        ("The claimant, Chiara Lashreretell, gave", [("name", 14)]), ("TILVODURIN Dolores - x", [("name", 0)]), ("Prof. Ayşe Nilraipouwell", [("name", 6)]), ("Attn: R. Drumbeofatund", [("name", 6)]), ("L0renzo La1maineovock", [("name", 0)]), ("Kangaroo Foods Ltd.", []), ("Claims desk", []),
        ("２３ x@y.com", [("email", 3)]), ("", []), (" ", []),
    ],
)
def test_cases(text, want):
    assert [(k, a) for k, a, _ in FIND(text)] == want


def test_spans_map_back_to_the_source():
    text = "é mail ann [at] inbox [dot] example or b (at) c.test, Tel. 555 O18 6108"
    got = FIND(text)
    assert [text[a:b] for _, a, b in got] == ["ann [at] inbox [dot] example", "b (at) c.test", "555 O18 6108"]
    assert P.redacted(text, got) == "é mail [EMAIL] or [EMAIL], Tel. [PHONE]"


def test_rewriting_keeps_positions():
    m = P.Mapped("ab [at] cd [at] e")
    m.rewrite(P.AT, "@")
    assert m.text == "ab@cd@e" and [m.source(i) for i in (0, 3, 6)] == [0, 8, 16]
    m.rewrite(P.re.compile("cd"), "XYZ")
    assert m.text == "ab@XYZ@e" and [m.source(i) for i in (0, 3, 7)] == [0, 8, 16]


def test_fields():
    assert [(k, a) for k, a, _ in FIND("+5550142", "fax")] == [("phone", 0)]
    assert FIND("see above", "fax") == [] and FIND("n/a", "phone") == []
    assert [k for k, _, _ in FIND("Zzz Bralkomutell", "to")] == ["name"]


def test_table(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, "x@y.test", "a"), (3, "x@y.test", "a"), (4, "z " * 50000 + "x@y.test", "a")], "elem_id bigint, content string, kind string")
    got = sorted((r.row_id, r.kind, r.start_pos) for r in P.personal_data(df, (frozenset(), Lore()), "elem_id", "content").collect())
    assert got == [(3, "email", 0), (3, "email", 0), (4, "email", 100000)]
    assert P.personal_data(df.limit(0), (frozenset(), Lore()), "elem_id", "content").count() == 0
    red = {r.elem_id: r.redacted for r in P.redact(df.filter("elem_id < 4"), (frozenset(), Lore()), ("elem_id",), "content").collect()}
    assert red == {1: None, 2: "", 3: "[EMAIL]"}


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("please call Brandon Whitfield on the invoice", ["Brandon Whitfield"]), ("signed by Svetlana Petrova and Hiroshi Tanaka at the office", ["Svetlana Petrova", "Hiroshi Tanaka"]), ("Kevin J. O'Donnell gave his passport as proof", ["Kevin J. O'Donnell"]),
        ("the order by Kestrel Foods is lost", []), ("the order by Brandon Whitfield Ltd is lost", []), ("it lives at 102C Mill Pond Road, Dunsley Cross and is old", []), ("Northmoor Bulk Archive", []), ("Please Call", []),
    ],
)
def test_names_of_no_list(text, want):
    assert [text[a:b] for k, a, b in FIND(text) if k == "name"] == want


@pytest.mark.parametrize(
    ("text", "phone"),
    [
        ("020 7946 0958", True), ("030 123456", True), ("01632 960 983", True), ("0555 010 01 01", True), ("01 23 45 67 89", True), ("000 5550498", True), ("212-555-0142", True), ("1 212 555 0142", True), ("912 345 678", True), ("347 1234567", True), ("(555) 018-5509", True), ("+44 20 7946 0958", True), ("0049 30 2312597", True), ("555-0142", True),
        ("1234 5678", False), ("12/25/2005", False), ("100 200 300", False), ("5 165,97", False), ("12345678", False),
    ],
)
def test_phone_plans(text, phone):
    assert [k for k, _, _ in FIND(f"see {text} there")] == (["phone"] if phone else [])


def test_spelled_digits_of_any_case_and_language():
    for words in ("FIVE FIVE FIVE ZERO ONE EIGHT FIVE FIVE ZERO NINE", "five five five zero one eight five five zero nine", "cinq cinq cinq zéro un huit cinq cinq zéro neuf", "fünf fünf fünf null eins acht fünf fünf null neun", "cinco cinco cinco cero uno ocho cinco cinco cero nueve", "beş beş beş sıfır bir sekiz beş beş sıfır dokuz"):
        assert FIND(f"call {words} today") == [("phone", 5, 5 + len(words))], words


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("12 rue de la Paix, 75002 Paris", "[ADDRESS]"), ("lives at 22 Rowan Lane, Velmouth QX1 8ZZ. Then", "lives at [ADDRESS]. Then"), ("at Değirmen Cad. No:169 Kat 2, 99395 Yenibağ. Then", "at [ADDRESS]. Then"), ("Postfach 188, 00710 Brunnstadt", "[ADDRESS]"),
        ("P.O. Box 207, Dunsley Cross\nTel. 555 018 5509", "[ADDRESS]\nTel. [PHONE]"), ("5 Old Ferry Court, Chiara Lashreretell gave", "[ADDRESS], [NAME] gave"),
    ],
)
def test_whole_addresses_are_redacted(text, want):
    assert P.redacted(text, FIND(text)) == want


def test_lore_is_learned_from_typed_names(spark):
    surnames = ["Whitfield", "Okafor", "Tanaka", "Petrova", "Lindqvist", "Moreau"]
    values = [f"{g} {s}" for g in ("Brandon", "Svetlana") for s in surnames] + [f"{s}, Priya" for s in surnames] + ["Brandno Whitfield"] + [f'Svetlana "Lana" {s}' for s in surnames]
    values += [f"{c} {t} Ltd" for c in ("Acme", "Kestrel", "Borealis") for t in ("Roofing", "Rfg")] + ["File copy", "", None, "Zed"]
    lore = learn(spark.createDataFrame([(v, "clash") for v in values * 2], "value string, trade string"))
    assert {"brandon", "svetlana", "priya"} <= set(lore.given) and not {"whitfield", "acme", "file", "roofing"} & set(lore.given)
    assert lore.trades["rfg"] == lore.trades["roofing"] == "roofing" and lore.given["lana"] == "svetlana" and "lana" in lore.short
    empty = learn(spark.createDataFrame([], "value string"))
    assert "brandon" not in empty.given and empty.given["bob"] == "robert"


def test_vocabulary_is_what_texts_write_in_lower_case(spark):
    texts = spark.createDataFrame([("the archive of Whitfield sent mail to whitfield@inbox.test",)] * 5 + [(None,), ("",)], "text string")
    words = P.vocabulary(spark.createDataFrame([("ledger",), (None,)], "term string"), texts)
    assert {"ledger", "archive", "mail"} <= words and "whitfield" not in words
