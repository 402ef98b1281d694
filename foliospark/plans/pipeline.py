"""From image files to documents, with engines in slots.

Every step is a table keyed by file and page; what an engine is missing for stays null, and a page that fails keeps its
row with an error. The language of a file's first page is that of all its pages.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import images as I
from ..functions import language as L
from ..functions import quality as Q
from ..functions.fields import LABELS, key_values, value_in_source
from ..functions.text import correct_text, fix_spacing, quality_score
from ..operators import boxes as B
from ..operators import fields as O
from ..operators import fuzzy as Z
from ..operators import routing as R
from ..operators import spatial as S
from ..operators import tables as T
from ..session import written
from ..slots import Registry
from ..sources import files

KEYS = ["file", "page"]
#: Quality of a text below which a vision model is asked.
POOR = 30.0


def page_images(spark: SparkSession, folder: str, slots: Registry) -> DataFrame:
    """file, page, document_type, image, error of the images of a folder and, by the slot pdf_pages, of its PDF pages. An
    image file that does not decode keeps its row."""
    name = F.element_at(F.split("origin", "/"), -1)
    kind = F.lower(F.element_at(F.split(name, r"\."), -1))
    read = files.images(spark, folder, invalid=True).filter(F.col("image").isNotNull() | kind.isin(*[t for t in files.TYPES if t != "pdf"]))
    image = F.when(F.col("image").isNotNull(), F.struct("image.height", "image.width", "image.nChannels", "image.data"))
    # empty files are listed, but no source gives a row for them
    listed = spark.createDataFrame([(unquote(x).rsplit("/", 1)[-1],) for x in spark.read.format("binaryFile").option("pathGlobFilter", files.GLOB).option("recursiveFileLookup", "false").load(folder).inputFiles()], "file string").filter(~F.lower("file").endswith(".pdf"))
    one = read.select(name.alias("file"), F.lit(1).alias("page"), F.lit("image").alias("document_type"), image.alias("image"))
    lost = listed.join(one, "file", "left_anti").select("file", F.lit(1).alias("page"), F.lit("image").alias("document_type"), F.lit(None).cast(one.schema["image"].dataType).alias("image"))
    pdf = slots.apply(files.input_files(spark, folder, content=True).filter("is_pdf"), "pdf_pages", ["content"])
    many = pdf.select("file", F.posexplode_outer("pages").alias("p", "image"))
    pages = many.select("file", (F.coalesce("p", F.lit(0)) + 1).alias("page"), F.lit("pdf").alias("document_type"), F.when(F.col("image.height") > 0, F.col("image")).cast(one.schema["image"].dataType).alias("image"))
    return one.unionByName(lost).unionByName(pages).withColumn("error", F.when(F.col("image").isNull(), "no image"))


def measured(pages: DataFrame) -> DataFrame:
    """pages with their metrics, preset and the eight settings of preprocessing."""
    m = pages.withColumn("m", I.image_metrics(F.col("image")))
    return m.select(*pages.columns, "m.*").select("*", Q.preset().alias("preset"), *Q.parameters())


#: Types of regions by what detectors call them (fixed values); all others are text.
TABLES, FIGURES = ("table",), ("figure", "image", "picture", "chart", "graphic")


def regions(pages: DataFrame, slots: Registry) -> DataFrame:
    """Blocks of the layout slot on measured pages, of the fallback where it finds none: type TextBlock, Table or Figure,
    sides within the page, large enough, no noise, of overlapping ones of a type the surest. `image` is the block's part
    of the page, cut in one pass over the pages."""
    found = slots.apply(pages.filter("error is null"), "layout", ["file", "page", "image"])
    none = F.coalesce(F.size("blocks"), F.lit(0)) < 1
    found = slots.apply(found.withColumn("first", F.col("blocks")).drop("blocks"), "layout_fallback", ["file", "page", "image"], when=F.coalesce(F.size("first"), F.lit(0)) < 1).withColumn("blocks", F.when(none, F.col("first")).otherwise(F.col("blocks")))
    kept = written(found.select(*KEYS, "image", F.col("width").cast("double").alias("w"), F.col("height").cast("double").alias("h"), "blocks"), "pipeline-layout")
    flat = kept.select(*KEYS, "w", "h", F.posexplode("blocks").alias("block_idx", "b")).select(*KEYS, "w", "h", "block_idx", "b.*")
    conf = F.when(F.col("confidence") <= 1, F.col("confidence") * 100).otherwise(F.col("confidence"))
    kind = F.lower(F.coalesce("type", F.lit("")))
    kind = F.when(kind.isin(*TABLES), "Table").when(kind.isin(*FIGURES), "Figure").otherwise("TextBlock")
    flat = flat.select(*KEYS, "w", "h", "block_idx", kind.alias("type"), F.coalesce(conf, F.lit(0.0)).alias("confidence"), *G.clip(G.Box.of(), F.col("w"), F.col("h")).columns())
    b = G.Box.of()
    flat = flat.filter(G.has_area(b) & (b.width >= 10) & (b.height >= 5) & ~G.noise_artifact(b, F.lit(""), F.col("confidence"), F.col("w"), F.col("h")))
    flat = B.suppressed(flat, [*KEYS, "type"], "block_idx", "confidence")
    boxes = flat.groupBy(*KEYS).agg(F.collect_list(F.struct("block_idx", "type", "confidence", *B.SIDES)).alias("boxes"))
    return I.cropped(kept.drop("blocks").join(boxes, KEYS), KEYS)


def recognised(blocks: DataFrame, slots: Registry, handwriting: bool = True) -> DataFrame:
    """blocks with text and confidence. TrOCR is asked only about handwriting, Tesseract only where Paddle is not good, and
    a vision model only where all of these leave a text poor. Handwriting is judged on the block's own part of the page.
    The result is a written table, so every engine is asked once."""
    inputs = ["image", *B.SIDES]
    rows = blocks
    if handwriting:
        rows = rows.withColumn("_f", I.image_handwriting(F.col("image")))
        score = Q.handwriting_score(lambda n: F.lit(None).cast("double") if n == "stroke_width_var_ratio" else F.col("_f")[n])
        rows = rows.withColumn("written", F.coalesce(score > 0.55, F.lit(False))).drop("_f")
    else:
        rows = rows.withColumn("written", F.lit(False))
    read = F.col("type") != "Figure"
    rows = slots.apply(rows, "paddle", inputs, when=read, prefix="paddle_").withColumnRenamed("paddle_confidence", "paddle_conf")
    rows = slots.apply(rows, "trocr", inputs, when=read & F.col("written"), prefix="trocr_").withColumnRenamed("trocr_confidence", "trocr_conf")
    good = R.engine("paddle", R.PADDLE_CONF)[2] >= 65
    rows = slots.apply(rows, "tesseract", inputs, when=read & ~F.coalesce(good, F.lit(False)), prefix="tesseract_").withColumnRenamed("tesseract_confidence", "tesseract_conf")
    rows = rows.withColumn("_r", R.recognise(F.col("written"))).drop(*[f"{e}_{c}" for e in ("paddle", "trocr", "tesseract") for c in ("text", "conf")])
    rows = rows.withColumn("content", F.col("_r.text")).withColumn("ocr_conf", F.bround("_r.conf", 2)).drop("_r")
    poor = read & (F.coalesce(quality_score(F.col("content"), F.col("ocr_conf")), F.lit(0.0)) < POOR)
    rows = slots.apply(rows, "vision_model", inputs, when=poor, prefix="vision_")
    seen = ~F.coalesce(F.trim("vision_answer") == "", F.lit(True))
    rows = rows.withColumn("ocr_conf", F.when(seen, R.VLM_CONF).otherwise(F.col("ocr_conf"))).withColumn("content", F.when(seen, F.col("vision_answer")).otherwise(F.col("content")))
    kind = I.image_flatness(F.col("image"))
    rows = rows.withColumn("flat", F.when(F.col("type") == "Figure", kind["mean"].isNull() | (kind["mean"] > 240) & (kind["std"] < 20)))
    return written(rows.drop("image", "vision_answer"), "pipeline-blocks")


def corrected(blocks: DataFrame, terms: DataFrame, tess: DataFrame) -> DataFrame:
    """blocks with texts corrected by the rules for their page's language, then by the dictionary."""
    rows = blocks.join(tess, KEYS, "left")
    text = F.when(F.col("lang_tess").isin(*L.POSTPROCESSED), correct_text(F.col("content"))).otherwise(fix_spacing(F.coalesce("content", F.lit(""))))
    rows = rows.withColumn("content", text).withColumn("_id", F.concat_ws("|", *KEYS, "block_idx"))
    return rows.drop("content").join(Z.corrected(rows, "_id", "content", terms).select("_id", F.col("corrected").alias("content")), "_id").drop("_id")


def ordered(blocks: DataFrame) -> DataFrame:
    """blocks with their reading position and name."""
    b = G.Box.of()
    w = Window.partitionBy(*KEYS).orderBy(F.floor(b.cy / 80), b.cx, "block_idx")
    return blocks.withColumn("reading_pos", F.row_number().over(w) - 1).withColumn("name", F.concat(F.lit("textblock_"), (F.col("block_idx") + 1).cast("string")))


def figures(blocks: DataFrame) -> DataFrame:
    """Figure blocks that are plausible by place, size and pixels and are not covered by text, each with its caption."""
    b = G.Box.of()
    own = blocks.filter("type = 'Figure' and not flat").filter(G.plausible_figure(b, F.col("w"), F.col("h")) & ~G.likely_false_figure(b, F.col("w"), F.col("h")))
    ident = F.concat_ws("|", *KEYS, "block_idx")
    own = own.select(*KEYS, ident.alias("figure"), "block_idx", "confidence", *B.SIDES)
    texts = blocks.filter("type = 'TextBlock'").select(*KEYS, ident.alias("text_block"), "content", *B.SIDES)
    return S.captions(own, texts, KEYS, "figure", "text_block").select(*KEYS, "block_idx", *B.SIDES, "confidence", "caption")


def tables(pages: DataFrame, blocks: DataFrame, slots: Registry) -> DataFrame:
    """Cells of ruled tables: the lines slot gives lines, which split into horizontal and vertical ones; a cell lies between
    neighbouring ones; the texts of blocks in it, in reading order, are its text."""
    found = slots.apply(pages.filter("error is null"), "lines", ["file", "page", "image"]).select(*KEYS, F.explode("lines").alias("l"))
    lines = T.line_axes(found.select(*KEYS, "l.*"))
    cells = T.boundary_cells(lines, KEYS).withColumn("cell", F.concat_ws("|", *KEYS, "row", "col"))
    texts = blocks.filter("content is not null and content != ''").select(*KEYS, "block_idx", "content", *B.SIDES)
    inside = T.cell_of_text(texts, cells, KEYS, "block_idx", "cell")
    text = inside.join(texts.select(*KEYS, "block_idx", "content"), [*KEYS, "block_idx"]).groupBy("cell").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_idx", "content"))), lambda x: x["content"]), " ").alias("text"))
    return cells.join(text, "cell", "left").select(*KEYS, "row", "col", *B.SIDES, F.coalesce("text", F.lit("")).alias("text"))


def model_fields(blocks: DataFrame, rule: DataFrame, slots: Registry) -> DataFrame:
    """file, page, key, value that a text model gives ("key: value" lines) for pages on which the rules leave a key open;
    a value must stand in the page's text."""
    asked = blocks.groupBy(*KEYS).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_idx", "content"))), lambda x: x["content"]), "\n").alias("text"))
    told = rule.groupBy(*KEYS).agg(F.countDistinct("key").alias("told"))
    rows = slots.apply(asked.join(told, KEYS, "left"), "text_model", ["text"], when=F.coalesce("told", F.lit(0)) < len(LABELS))
    pairs = rows.select(*KEYS, "text", F.explode(key_values(F.col("answer"))).alias("kv")).select(*KEYS, "text", "kv.*")
    return pairs.filter(F.col("value").isNotNull() & value_in_source(F.col("value"), F.col("text"))).select(*KEYS, "key", "value")


def process(spark: SparkSession, folder: str, slots: Registry, terms: DataFrame) -> dict[str, DataFrame]:
    """pages, blocks, fields, model_fields, figures, tables (cells) and documents (a row a page, as sinks.write_documents
    takes them) of the inputs of a folder. Pages and recognised blocks are written tables, so nothing is decoded or
    recognised twice; a page that fails keeps its row with an error and counts among its document's pages."""
    pages = written(measured(page_images(spark, folder, slots)), "pipeline-pages")
    blocks = recognised(regions(pages, slots), slots)
    texts = blocks.groupBy(*KEYS).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_idx", "content"))), lambda x: x["content"]), "\n").alias("text"), F.round(F.avg("ocr_conf"), 2).alias("ocr_conf"))
    asked = slots.apply(pages.select(*KEYS).join(texts, KEYS, "left"), "language_detector", ["text"])
    decided = asked.withColumn("d", L.decision(F.col("text"), F.col("lang"), F.col("confidence"))).select(*KEYS, "ocr_conf", "d.lang_iso", "d.lang_tess", F.col("d.confidence").alias("lang_conf"), F.col("d.fallback").alias("lang_fallback"))
    blocks = written(ordered(corrected(blocks, terms, L.carried(decided))), "pipeline-texts")
    fields = O.fields_by_location(blocks, KEYS)
    out = {"pages": pages.drop("image").join(decided, KEYS, "left"), "blocks": blocks, "fields": fields, "model_fields": model_fields(blocks, fields, slots), "figures": figures(blocks), "tables": tables(pages, blocks, slots)}
    return out | {"documents": documents(out["pages"], blocks, fields)}


def documents(pages: DataFrame, blocks: DataFrame, fields: DataFrame) -> DataFrame:
    """file, document_type, total_pages, pages: a row for each page with its elements in reading order and its fields."""
    box = F.struct(*B.SIDES)
    element = F.struct("reading_pos", F.concat(F.lower("type"), F.lit("_"), (F.col("block_idx") + 1).cast("string")).alias("id"), "type", box.alias("bounding_box"), "content", F.struct("ocr_conf", F.lit("layout").alias("detection_source")).alias("meta"))
    e = blocks.groupBy(*KEYS).agg(F.transform(F.array_sort(F.collect_list(element)), lambda x: x.dropFields("reading_pos")).alias("elements"))
    f = fields.groupBy(*KEYS, "key").agg(F.min(F.coalesce("normalized", "value")).alias("value")).groupBy(*KEYS).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("fields"))
    whole = pages.join(e, KEYS, "left").join(f, KEYS, "left")
    page = F.struct("page", F.col("width").cast("int").alias("page_width"), F.col("height").cast("int").alias("page_height"), "error", F.coalesce("elements", F.array().cast(e.schema["elements"].dataType)).alias("elements"), "fields")
    heads = pages.groupBy("file").agg(F.max("document_type").alias("document_type"), F.count("*").cast("int").alias("total_pages"))
    return whole.select("file", F.array(page).alias("pages")).join(heads, "file").select("file", "document_type", "total_pages", "pages")
