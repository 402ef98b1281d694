from __future__ import annotations

import numpy as np
from foliospark.llm import spam as S

LETTER = "The supplier sent the packing list at the regional centre. We have reviewed the signed cover sheet and found it again. Please return the letter before the end of the month. "


PAGES = [
    ("cheap toner toner refill " * 30, 1), ("\n".join(f"{i}. http://shop{i}.example/p/{i} (fax online)" for i in range(20)), 1), (" ".join("#cheaptoner #tonerrefill #inkset".split() * 10), 1), ("Buy fast loan here, fast loan there, and fast loan everywhere with our fast loan cash. " * 6, 1), ("t0n3r sh0p ch3@p t0ner! " * 20, 1),
    (LETTER * 3, 0), (LETTER * 3 + "\nKeywords: packing list, packing list", 0), ("\n".join(f"{i}. Delivery note ............ {i * 3}" for i in range(20)), 0), ("\n".join(f"PT-{i}A  delivery note  bin {i}  short  {i * 7}" for i in range(20)), 0), ("\n".join(f"Company Foods, {i} Cooper Avenue, box {i}1" for i in range(20)), 0),
    ("\n".join(f"- delivery note (files.desk.example/{i}.pdf): {LETTER}" for i in range(6)), 0), (LETTER.upper(), 0),
]


def test_weak_labels_are_partial_and_mostly_right():
    labels = [(S.weak_label(S.features(t)), want) for t, want in PAGES]
    given = [(x, want) for x, want in labels if x is not None]
    assert len(given) >= len(PAGES) // 2 and sum(x != want for x, want in given) <= 1
    assert any(x is None for x, _ in labels)  # something is left to the trees


def test_no_features():
    assert S.features("") is None and S.features(" 12 !! ") is None


def test_trees_learn():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) & (x[:, 2] < 0.5)).astype(float)
    m = S.Trees.fit(x[:1500], y[:1500])
    assert ((m.predict(x[1500:]) > 0.5) == y[1500:]).mean() > 0.93
    assert (m.predict(x) == S.Trees.fit(x[:1500], y[:1500]).predict(x)).all()


def test_pages(spark):
    rows = [(i, "host", "cheap toner toner refill " * 30) for i in range(60)] + [(100 + i, None, LETTER * (2 + i % 3)) for i in range(60)] + [(300, "host", None), (301, "host", ""), (302, None, LETTER * 2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, origin string, text string")
    got = {r.doc_id: r.p for r in S.spam_pages(docs).collect()}
    assert all(got[i] > 0.5 for i in range(60)) and all(got[100 + i] < 0.5 for i in range(60)) and got[302] < 0.5 and 300 not in got and 301 not in got
    assert S.spam_pages(docs.limit(0)).count() == 0


def prose(rng) -> str:
    pick = lambda x: x[rng.integers(len(x))]
    who, what, where = "the supplier|our branch|the records desk|a clerk|the courier".split("|"), "the packing list|a signed form|the missing page|an old ledger|the revised invoice".split("|"), "at the counter|before noon|with the permit|in the archive|for the auditor".split("|")
    return " ".join(f"{pick(who).capitalize()} {pick(['returned', 'copied', 'checked', 'lost'])} {pick(what)} {pick(where)} and {pick(['called', 'wrote', 'waited'])} again." for _ in range(rng.integers(2, 9)))


def stuffed(rng) -> str:
    words = ["cheap", "toner", "refill", "shop", "ink", "deals", "sale", "laser"]
    take = [words[k] for k in rng.permutation(len(words))[: rng.integers(3, 7)]]
    return ", ".join(f"{take[rng.integers(len(take))]} {take[rng.integers(len(take))]}" for _ in range(rng.integers(15, 60)))


def test_trees_decide_pages_without_a_weak_label():
    rng = np.random.default_rng(11)
    mixed = lambda: prose(rng) + "\n" + stuffed(rng) if rng.random() < 0.3 else stuffed(rng)
    rows = [(S.features(prose(rng)), 0) for _ in range(300)] + [(S.features(mixed()), 1) for _ in range(300)]
    labelled = [(f, w) for f, _ in rows if (w := S.weak_label(f)) is not None]
    model = S.Trees.fit(np.array([f for f, _ in labelled], np.float32), np.array([w for _, w in labelled], float))
    left = [(f, y) for f, y in rows if S.weak_label(f) is None]
    assert len(left) >= 20  # without the trees these would have no answer
    right = (model.predict(np.array([f for f, _ in left], np.float32)) > 0.5) == np.array([y for _, y in left])
    assert right.mean() > 0.85


def test_hosts_move_doubtful_pages(spark):
    """One host is full of spam and one of none: a page the trees leave open follows its host, and one without a host stays."""
    rows = [(i, "bad", 0.97) for i in range(200)] + [(1000 + i, "good", 0.03) for i in range(200)] + [(5000, "bad", 0.45), (5001, "good", 0.55), (5002, None, 0.45), (5003, None, 0.55)]
    scores = spark.createDataFrame(rows, "doc_id bigint, origin string, score double")
    sample = [("bad", 0.4, 1)] * 60 + [("good", 0.6, 0)] * 60  # what unseen trees say is weaker than what hosts say
    p = {r.doc_id: r.p for r in S.smoothed(scores, sample).filter("doc_id >= 5000").collect()}
    assert p[5000] > 0.5 > p[5001] and abs(p[5002] - 0.45) < 1e-9 and abs(p[5003] - 0.55) < 1e-9
    unmoved = {r.doc_id: r.p for r in S.smoothed(scores, []).filter("doc_id >= 5000").collect()}
    assert unmoved[5000] < 0.5 < unmoved[5001]  # without the fitted weight both would be wrong
