from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from foliospark.llm import mix as M


def test_fit_meets_marginals_and_caps():
    rng = np.random.default_rng(2)
    tokens = rng.integers(10, 1000, (3, 7, 6)).astype(float)
    c = M.Cells(["a", "b", "c"], np.array([0.5, 0.3, 0.2]), np.array([2.0, 1.0, 3.0]), tokens)
    x = M.fit(c, total=5000.0)
    assert np.allclose(x.sum((1, 2)) / x.sum(), c.shares, atol=1e-3) and (x <= tokens * c.repeats[:, None, None] + 1e-6).all()
    assert np.allclose(x.sum((0, 2)) / x.sum(), tokens.sum((0, 2)) / tokens.sum(), atol=0.02)
    whole = M.fit(c)
    assert whole.sum() > x.sum() and (whole <= tokens * c.repeats[:, None, None] + 1e-6).all()


def test_mixture(spark):
    words = "the supplier sent the packing list at the regional centre "
    rows = [(i, s, lang, words * (1 + i % 7)) for i, (s, lang) in enumerate([("big", "en")] * 300 + [("big", "fr")] * 100 + [("small", "en")] * 60 + [("none", "en")] * 20 + [(None, None)] * 10)] + [(9000, "big", "en", None), (9001, "big", "en", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, text string").withColumn("topic", F.lit("clash"))
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.4, 3), ("absent", 0.1, 2)], "source string, target_share double, max_repeats int")
    chosen, report = M.mixed(docs, targets)
    got = {r.source: r for r in report.collect()}
    assert abs(got["big"].actual_share - 5 / 9) < 0.02 and abs(got["small"].actual_share - 4 / 9) < 0.02 and got["absent"].tokens == 0 and "none" not in got
    reps = {r.source: r.m for r in chosen.groupBy("source").agg(F.max("repeats").alias("m")).collect()}
    assert set(reps) == {"big", "small"} and reps["big"] == 1 and reps["small"] <= 3
    assert not chosen.filter("doc_id >= 9000").count() and chosen.count() == chosen.select("doc_id").distinct().count()
    empty, none = M.mixed(docs.limit(0), targets)
    assert empty.count() == 0 and none.count() == 3
