"""The pipeline over real files with engines that a test makes up, and the command line."""

from __future__ import annotations

import pandas as pd
import pytest
from test_io import png

from foliospark import job
from foliospark.plans import pipeline
from foliospark.slots import Registry


def layout():
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        box = lambda x1, y1, x2, y2, c: {"x1": x1, "y1": y1, "x2": x2, "y2": y2, "type": "text", "confidence": c}
        return pd.DataFrame({"blocks": [[box(5.0, 30.0, 45.0, 44.0, 0.9), box(60.0, 30.0, 95.0, 44.0, 0.9), box(5.0, 60.0, 8.0, 62.0, 0.9)]] * len(pdf)})

    return run


def reader():
    return lambda pdf: pd.DataFrame({"text": ["Date:" if x < 50 else "1/5/75" for x in pdf["x1"]], "confidence": [75.0] * len(pdf)})


def test_pipeline(spark, tmp_path):
    png(tmp_path / "a.png", [[(255, 255, 255) if (x // 3 + y // 7) % 4 else (0, 0, 0) for x in range(100)] for y in range(80)])
    (tmp_path / "b.pdf").write_bytes(b"%PDF")
    terms = spark.createDataFrame([("signature",)], "term string")
    slots = Registry()
    empty = pipeline.process(spark, str(tmp_path), slots, terms)
    assert {(r.file, r.error) for r in empty["pages"].collect()} == {("a.png", None), ("b.pdf", "no image")} and empty["blocks"].count() == 0
    slots.fill("layout", layout)
    slots.fill("paddle", reader)
    out = pipeline.process(spark, str(tmp_path), slots, terms)
    assert {r.pages[0].page for r in out["documents"].collect()} == {1} and out["figures"].count() == out["tables"].count() == 0
    assert sorted((r.block_idx, r.content, r.reading_pos) for r in out["blocks"].collect()) == [(0, "Date:", 0), (1, "1/5/75", 1)]
    assert [(r.key, r.normalized, r.direction) for r in out["fields"].collect()] == [("date", "1975-01-05", "right")]
    page = out["pages"].filter("file = 'a.png'").first()
    assert (page.width, page.height, page.lang_iso, page.lang_fallback) == (100, 80, "en", True)


def test_command_line(spark, data, tmp_path):
    assert job.main(["--tables", data, "--output", str(tmp_path), "--query", "envelope"], spark) == ["envelope"]
    assert spark.read.parquet(str(tmp_path / "envelope")).count() > 0
    with pytest.raises(SystemExit):
        job.main(["--tables", data, "--output", str(tmp_path), "--query", "nothing"], spark)


def test_damaged_images_keep_their_row(spark, tmp_path):
    png(tmp_path / "a.png", [[(255, 255, 255)] * 20] * 20)
    (tmp_path / "b.png").write_bytes((tmp_path / "a.png").read_bytes()[:30])
    (tmp_path / "c.TIFF").write_bytes(b"no image")
    (tmp_path / "d.jpg").write_bytes(b"")
    (tmp_path / "e.pdf").write_bytes(b"%PDF")
    (tmp_path / "f.txt").write_text("x")
    out = pipeline.process(spark, str(tmp_path), Registry(), spark.createDataFrame([("signature",)], "term string"))
    assert sorted((r.file, r.page, r.error) for r in out["pages"].collect()) == [("a.png", 1, None), *((f, 1, "no image") for f in ("b.png", "c.TIFF", "d.jpg", "e.pdf"))]


def page_image(value=255):
    """A page of 200 by 100 pixels with a dark and patterned part at the top left."""
    import numpy as np

    a = np.full((200, 100, 3), value, np.uint8)
    a[20:60, 10:60] = (np.arange(40)[:, None, None] * 6 + np.arange(50)[None, :, None] * 3) % 256
    return {"height": 200, "width": 100, "nChannels": 3, "data": a.tobytes()}


def pdf_decoder():
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pages = []
        for c in pdf["content"]:
            if b"broken" in c:
                raise ValueError("damaged")
            pages.append([page_image(), None, page_image()][: c.count(b"page")])
        return pd.DataFrame({"pages": pages})

    return run


def calls(path, name):
    return len(list(path.glob(f"{name}-*")))


def test_pdf_pages_to_documents(spark, tmp_path):
    """PDF pages are decoded, a page or file that fails keeps a row, engines see each block's own part once, only where asked."""
    import uuid

    inputs, log = tmp_path / "in", tmp_path / "log"
    inputs.mkdir(), log.mkdir()
    (inputs / "a.pdf").write_bytes(b"%PDF page page page")
    (inputs / "b.pdf").write_bytes(b"%PDF broken")
    box = lambda x1, y1, x2, y2, t, c: {"x1": x1, "y1": y1, "x2": x2, "y2": y2, "type": t, "confidence": c}
    noted = lambda name, n: [(log / f"{name}-{uuid.uuid4().hex}").write_text("") for _ in range(n)]

    def nothing():
        return lambda pdf: pd.DataFrame({"blocks": [[] for _ in range(len(pdf))]})

    def fallback():
        def run(pdf):
            noted("fallback", len(pdf))
            return pd.DataFrame({"blocks": [[box(10.0, 20.0, 60.0, 60.0, "Picture", 0.9), box(10.0, 21.0, 60.0, 61.0, "figure", 0.5), box(10.0, 64.0, 70.0, 76.0, "text", 0.8), box(10.0, 100.0, 40.0, 114.0, "text", 0.9), box(50.0, 100.0, 90.0, 114.0, "text", 0.9)]] * len(pdf)})

        return run

    def paddle():
        def run(pdf):
            noted("paddle", len(pdf))
            assert all(i["height"] <= 15 for i in pdf["image"])
            return pd.DataFrame({"text": ["Date:" if y > 90 and x < 50 else "1/5/75" if y > 90 else "The supplier sent the packing list today." for x, y in zip(pdf["x1"], pdf["y1"])], "confidence": [75.0] * len(pdf)})

        return run

    def lines():
        line = lambda x1, y1, x2, y2: {"x1": x1, "y1": y1, "x2": x2, "y2": y2}
        return lambda pdf: pd.DataFrame({"lines": [[line(5.0, 95.0, 95.0, 96.0), line(5.0, 120.0, 95.0, 120.0), line(5.0, 95.0, 5.0, 120.0), line(45.0, 95.0, 46.0, 120.0), line(95.0, 95.0, 95.0, 120.0), line(0.0, 0.0, 50.0, 50.0)]] * len(pdf)})

    slots = Registry()
    for name, f in (("pdf_pages", pdf_decoder), ("layout", nothing), ("layout_fallback", fallback), ("paddle", paddle), ("lines", lines)):
        slots.fill(name, f)
    out = pipeline.process(spark, str(inputs), slots, spark.createDataFrame([("signature",)], "term string"))
    got = {k: v.collect() for k, v in out.items()}
    assert sorted((r.file, r.page, r.error) for r in got["pages"]) == [("a.pdf", 1, None), ("a.pdf", 2, "no image"), ("a.pdf", 3, None), ("b.pdf", 1, "no image")]
    assert calls(log, "fallback") == 2 and calls(log, "paddle") == 6  # three texts a page, each once
    assert [(r.page, r.caption) for r in sorted(got["figures"], key=lambda r: r.page)] == [(1, "The supplier sent the packing list today."), (3, "The supplier sent the packing list today.")]
    assert sorted((r.page, r.row, r.col, r.text) for r in got["tables"]) == [(p, 0, c, t) for p in (1, 3) for c, t in ((0, "Date:"), (1, "1/5/75"))]
    assert sorted((r.page, r.key, r.normalized) for r in got["fields"]) == [(1, "date", "1975-01-05"), (3, "date", "1975-01-05")]
    docs = {(r.file, r.pages[0].page): (r.total_pages, r.pages[0].error, len(r.pages[0].elements), r.pages[0].fields) for r in got["documents"]}
    assert docs == {("a.pdf", 1): (3, None, 4, {"date": "1975-01-05"}), ("a.pdf", 2): (3, "no image", 0, None), ("a.pdf", 3): (3, None, 4, {"date": "1975-01-05"}), ("b.pdf", 1): (1, "no image", 0, None)}


def test_command_line_from_files(spark, tmp_path):
    inputs = tmp_path / "in"
    inputs.mkdir()
    png(inputs / "a.png", [[(255, 255, 255)] * 20] * 20)
    (tmp_path / "words").write_text("signature\n")
    assert "documents" in job.main(["--inputs", str(inputs), "--output", str(tmp_path / "out"), "--words", str(tmp_path / "words")], spark)
    from foliospark.sources import files

    assert [(r.file, r.total_pages) for r in files.documents(spark, str(tmp_path / "out" / "documents")).collect()] == [("a.png", 1)]
