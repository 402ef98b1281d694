"""Sources, sinks, slots and streams."""

from __future__ import annotations

import struct
import zlib

import pandas as pd
from pyspark.sql import functions as F

from foliospark.plans.document_queries import document_pages
from foliospark.slots import SCHEMAS, Registry
from foliospark.sources import files, sinks
from foliospark.streaming import inputs


def png(path, rgb):
    raw = b"".join(b"\0" + bytes(v for px in row for v in px) for row in rgb)
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", len(rgb[0]), len(rgb), 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_inputs(spark, tmp_path):
    png(tmp_path / "a.png", [[(255, 0, 0), (0, 0, 255)]])
    (tmp_path / "b.PDF").write_bytes(b"%PDF")
    (tmp_path / "c.txt").write_text("x")
    (tmp_path / "sub").mkdir()
    png(tmp_path / "sub" / "d.png", [[(0, 0, 0)]])
    got = files.input_files(spark, str(tmp_path))
    assert sorted((r.file, r.is_pdf) for r in got.collect()) == [("a.png", False), ("b.PDF", True)]
    assert [x.count() for x in files.split_inputs(got)] == [1, 1]
    img = files.images(spark, str(tmp_path / "a.png")).first().image
    assert (img.height, img.width, bytes(img.data)) == (1, 2, bytes([0, 0, 255, 255, 0, 0]))


def test_documents_round_trip(spark, data, tmp_path):
    docs = document_pages(spark, data).limit(5).cache()
    sinks.write_documents(docs, str(tmp_path / "docs"))
    back = files.documents(spark, str(tmp_path / "docs"))
    size = lambda df: sorted((r.file, r.pages[0].page, r.total_pages, sum(len(p.elements or []) for p in r.pages)) for r in df.collect())
    assert size(back) == size(docs)
    assert sinks.corpus_json(docs).first().json.startswith('{"documents":[{"file":')


def test_table_sink(spark, tmp_path):
    cells = spark.createDataFrame([("f", 1, 0, 0, 'a "q"'), ("f", 1, 0, 1, "b,c"), ("f", 1, 1, 1, "d")], "file string, page int, row int, col int, text string")
    sinks.write_tables(cells, str(tmp_path / "t"), 2)
    rows = spark.read.option("escape", '"').csv(str(tmp_path / "t" / "file=f" / "page=1")).collect()
    assert [tuple(r) for r in rows] == [('a "q"', "b,c"), (None, "d")] or [tuple(r) for r in rows] == [('a "q"', "b,c"), ("", "d")]


def test_word_lists(spark, tmp_path):
    (tmp_path / "w").write_text("Alpha\n beta \n\nalpha\n")
    assert files.dictionary_path(str(tmp_path / "w")) == str(tmp_path / "w")
    assert sorted(r.term for r in files.word_list(spark, str(tmp_path / "w")).collect()) == ["alpha", "beta"]


def test_slots(spark):
    reg = Registry()
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    assert not any(reg.status().values()) and set(reg.status()) == set(SCHEMAS)
    assert [r.text for r in reg.apply(df, "paddle", ["t"]).collect()] == [None, None]

    def factory():
        return lambda pdf: pd.DataFrame({"text": pdf["t"].str.upper(), "confidence": [75.0] * len(pdf)})

    reg.fill("paddle", factory)
    got = {r.id: r.p_text for r in reg.apply(df, "paddle", ["t"], when=F.col("id") == 1, prefix="p_").collect()}
    assert got == {1: "A", 2: None}


def test_streams(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00"), (1, "2024-01-02 00:00:00"), (2, "2024-01-01 00:05:00"), (3, None)]
    spark.createDataFrame(rows, "elem_id bigint, t string").withColumn("t", F.col("t").cast("timestamp")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("elem_id bigint, t timestamp").parquet(str(tmp_path / "in"))
    for name, df, mode in (("firsts", inputs.first_deliveries(stream, "elem_id", "t"), "append"), ("windows", inputs.windowed(stream, "t", [], "1 day"), "complete"), ("sess", inputs.sessions(stream, "t", ["elem_id"], "1 hour"), "complete")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
        q.processAllAvailable()
        q.stop()
    assert sorted(r.elem_id for r in spark.table("firsts").collect()) == [1, 2, 3]
    assert sum(r.n for r in spark.table("windows").collect()) == 3 and spark.table("windows").count() == 2
    assert spark.table("sess").count() == 3
    assert inputs.new_files(spark, str(tmp_path)).isStreaming
