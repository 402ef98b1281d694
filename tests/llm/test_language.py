from __future__ import annotations

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.llm import language as L

EN = "The supplier sent the packing list at the regional centre and the clerk has checked it again today."
DE = "Der Lieferant hat die Packliste im Zentrum abgegeben und der Empfang hat sie heute noch einmal geprüft."
TR = "Tedarikçi paket listesini bölge merkezinde teslim etti ve muhasebe bunu bugün yeniden kontrol etti."


@pytest.fixture(scope="module")
def model():
    return L.Scores.fit([("en", EN), ("de", DE), ("tr", TR)] * 6)


def test_labels(spark):
    df = spark.createDataFrame([(x,) for x in ("en", "en_US", "ENG", "English", "fr-FR", "und", "", None, "nl", " de ", "türkçe")], "l string")
    assert [r[0] for r in df.select(L.label_language(F.col("l"))).collect()] == ["en", "en", "en", "en", "fr", None, None, None, None, "de", "tr"]


def test_viterbi_against_all_paths():
    import itertools

    rng = np.random.default_rng(1)
    s = rng.normal(0, 8, (1, 5, 3)).astype(np.float32)
    best = max(itertools.product(range(3), repeat=5), key=lambda p: sum(s[0, t, k] for t, k in enumerate(p)) - L.SWITCH * sum(a != b for a, b in zip(p, p[1:])))
    assert L.viterbi(s, np.array([5]))[0].tolist() == list(best)


def test_segments(model):
    at, seg, lang, letters, conf = L.Labeller(model).segments([EN, None, "", "  \n\n ", f"{DE}\n\n{EN}\r\n \r\n{TR}", EN.upper(), "Tel. 555 010", "مرحبا بالعالم " * 10 + ".", EN * 300])
    assert [(a, s, L.LANGS[k]) for a, s, k in zip(at, seg, lang)] == [(0, 0, "en"), (4, 0, "de"), (4, 1, "en"), (4, 2, "tr"), (5, 0, "en"), (8, 0, "en")]
    assert all(0 < c <= 1 for c in conf) and letters[0] == sum(c.isalpha() for c in EN)


def test_wrong_labels_are_corrected():
    m = L.Scores.fit([("en", EN), ("de", DE)] * 8 + [("de", EN), ("en", DE)])
    assert L.LANGS[int(m.of("supplier").argmax())] == "en" and L.LANGS[int(m.of("lieferant").argmax())] == "de"


def test_pages(spark, model):
    t = [datetime(2024, 1, d) for d in (1, 2, 3)]
    els = [("f", 1, 0, 1, t[0], EN), ("f", 1, 0, 1, t[1], EN), ("f", 1, 1, 2, t[0], f"{EN}\n\n{DE}"), ("f", 2, 0, 3, None, DE), ("f", 3, 0, 4, t[0], TR), ("f", 4, 0, 5, t[0], None), ("f", 5, 0, 6, t[0], EN)]
    meta = [("f", 1, "German", None, t[0]), ("f", 1, "fr", None, t[1]), ("f", 2, "de_AT", None, t[0]), ("f", 3, None, "failed", t[0]), ("f", 4, "en", None, t[0]), ("f", 5, "und", None, t[0])]
    e = spark.createDataFrame(els, "file string, page int, block_idx int, elem_id bigint, ingested_at timestamp, content string").withColumn("lang", F.lit("clash"))
    p = spark.createDataFrame(meta, "file string, page int, language string, error string, processed_at timestamp")
    rows = {(r.page, r.block_idx, r.seg_no): (r.lang, r.main, r.labelled) for r in L.languages(e, p, model).collect()}
    assert rows[1, -1, -1] == ("en", "en", "fr") and rows[1, 1, 1][:2] == ("de", "en") and rows[2, -1, -1] == ("de", "de", "de") and rows[5, -1, -1] == ("en", "en", None)
    assert not any(k[0] in (3, 4) for k in rows)
    assert L.languages(e.limit(0), p, model).count() == 0


TECHNICAL = [
    ("de", "Die Wellenlänge des Lichts bestimmt die Energie der Elektronen, die aus der Metalloberfläche austreten."), ("en", "Plants absorb sunlight through chlorophyll molecules and convert carbon dioxide into sugars and oxygen."),
    ("en", "Enzymes accelerate biochemical reactions inside living cells by lowering activation energy barriers."), ("tr", "Bitkiler gün ışığını kullanarak şeker ve oksijen üretir, bunun için yaprakların yeşil rengi gerekir."),
]


def learned():
    """Scores from sentences on other things, built of a few hundred words."""
    en = "the supplier sent packing list at regional centre and clerk has checked it again today because our office will move under the old storage building before winter while some workers count every broken container through long evening shifts without heating or light".split()
    de = "der lieferant hat die packliste im zentrum abgegeben und der empfang prüft sie heute noch einmal weil unser lager bald umzieht wobei einige arbeiter alle zerbrochenen behälter während langer abendschichten ohne heizung und licht unter der treppe zählen".split()
    tr = "tedarikçi paket listesini bölge merkezinde teslim etti ve muhasebe bunu bugün yeniden kontrol etti çünkü ofisimiz yakında taşınacak bazı işçiler kırık kapları uzun akşam vardiyalarında ısıtma ve ışık olmadan sayıyor gerekir için yeşil".split()
    rng = np.random.default_rng(2)
    return L.Scores.fit([(lang, " ".join(rng.permutation(words))) for lang, words in (("en", en), ("de", de), ("tr", tr)) for _ in range(12)])


def test_prose_on_unseen_subjects_is_labelled():
    at, _, lang, _, _ = L.Labeller(learned()).segments([t for _, t in TECHNICAL] + ["xq zzkv wrtq pblf qqjx kkwz vvxq zrtp kjhq wxcv.", "Lot 12345 Box 4 Ref 99 Lot 12345 Box 4 Ref 99 Lot 1 Box 44444 Ref 777777 No 88888888"])
    assert [(i, L.LANGS[k]) for i, k in zip(at, lang)] == [(i, want) for i, (want, _) in enumerate(TECHNICAL)]


def test_ranges_narrow_candidates(monkeypatch):
    """Words that training has not seen are told by letters that one language alone writes."""
    model = L.Scores.fit([("en", EN), ("de", DE), ("tr", TR)] * 6)
    text = f"{EN}\n\nŞoför kağıdı aşağı taşıdı, çırağı ağır yığını sığdırdı."
    got = lambda: [L.LANGS[k] for k in L.Labeller(model).segments([text])[2]]
    monkeypatch.setattr(L, "LEAST_WORDS", 0.0)
    assert got() == ["en", "tr"]
    monkeypatch.setattr(L, "LETTERS", dict.fromkeys(L.LANGS, "".join(L.LETTERS.values())))
    assert got() != ["en", "tr"]


def test_other_scripts_count_for_nothing(model):
    mixed = f"{EN} Привет мир مرحبا بالعالم"
    at, _, lang, letters, _ = L.Labeller(model).segments([mixed, "Поставщик отправил упаковочный лист в региональный центр сегодня."])
    assert at.tolist() == [0] and L.LANGS[lang[0]] == "en" and letters[0] == sum(c.isalpha() for c in EN)
