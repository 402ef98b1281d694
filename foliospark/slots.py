"""Slots for engines that are not part of the library: detectors, recognisers, classifiers, language models.

A slot is filled with a factory, a function without arguments that gives a function from a pandas DataFrame of the input
columns to one of the output columns. The factory runs once per Python worker, at the first batch, so a model is loaded
once and only where it is used. An empty slot gives nulls: the engine is missing, which is not the same as finding nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

Engine = Callable[[pd.DataFrame], pd.DataFrame]
#: A decoded image: rows of BGR (or grey) bytes.
IMAGE = "struct<height:int,width:int,nChannels:int,data:binary>"
BLOCKS = "blocks array<struct<x1:double,y1:double,x2:double,y2:double,type:string,confidence:double>>"
#: The slots and the columns they give. pdf_pages decodes the pages of a PDF; layout_fallback is asked where layout finds
#: nothing; lines gives ruled lines of a page.
SCHEMAS = {
    "layout_fallback": BLOCKS, "lines": "lines array<struct<x1:double,y1:double,x2:double,y2:double>>",
    "layout": "blocks array<struct<x1:double,y1:double,x2:double,y2:double,type:string,confidence:double>>", "words": "words array<struct<left:int,top:int,width:int,height:int,conf:double,text:string>>",
    "tesseract": "text string, confidence double", "paddle": "text string, confidence double", "surya": "text string, confidence double", "trocr": "text string, confidence double",
    "figure_classifier": "label string", "text_model": "answer string", "vision_model": "answer string", "language_detector": "lang string, confidence double", "pdf_pages": f"pages array<{IMAGE}>", "super_resolution": "image binary, factor double",
}
_LOADED: dict[int, Engine] = {}


def worker_engine(key: int, factory: Callable[[], Engine]) -> Engine:
    if key not in _LOADED:
        _LOADED[key] = factory()
    return _LOADED[key]


@dataclass
class Registry:
    factories: dict[str, Callable[[], Engine]] = field(default_factory=dict)

    def fill(self, slot: str, factory: Callable[[], Engine]) -> None:
        if slot not in SCHEMAS:
            raise KeyError(f"no slot {slot}; there are {', '.join(SCHEMAS)}")
        self.factories[slot] = factory

    def status(self) -> dict[str, bool]:
        """Which slots are filled."""
        return {s: s in self.factories for s in SCHEMAS}

    def apply(self, df: DataFrame, slot: str, inputs: list[str], when: Column | None = None, prefix: str = "") -> DataFrame:
        """df with the slot's columns (prefixed). `when`: rows the engine is called for; the others, all where the slot is
        empty, and rows that the engine fails on, have nulls. The engine gets the input columns of a batch's rows at once,
        and where that fails one by one. df is read once whatever `when` says."""
        parts = [p.strip() for p in SCHEMAS[slot].split(", ")]
        names = [p.split(" ", 1) for p in parts]
        factory = self.factories.get(slot)
        if factory is None:
            return df.select("*", *[F.lit(None).cast(kind).alias(prefix + n) for n, kind in names])
        key = id(factory)
        out = StructType([*df.schema.fields, *(StructField(prefix + n, _parse_datatype_string(kind)) for n, kind in names)])
        flagged = df.withColumn("_asked", F.lit(True) if when is None else F.coalesce(when, F.lit(False)))

        def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            engine = worker_engine(key, factory)
            for pdf in it:
                asked = pdf.pop("_asked").to_numpy(bool)
                rows = pdf.loc[asked, inputs]
                values = {n: [None] * len(pdf) for n, _ in names}
                for at, got in answers(engine, rows, np.flatnonzero(asked)):
                    for n, _ in names:
                        for i, v in zip(at, got[n].tolist()):
                            values[n][i] = v
                for n, _ in names:
                    pdf[prefix + n] = pd.Series(values[n], index=pdf.index, dtype=object)
                yield pdf

        return flagged.mapInPandas(run, out)


def answers(engine: Engine, rows: pd.DataFrame, at: np.ndarray) -> Iterator[tuple[np.ndarray, pd.DataFrame]]:
    """What the engine says of the rows at these places; of rows it fails on nothing."""
    if not len(rows):
        return
    try:
        yield at, engine(rows)
        return
    except Exception:  # noqa: BLE001 - an engine may fail in any way
        pass
    for i in range(len(rows)):
        try:
            yield at[i : i + 1], engine(rows.iloc[i : i + 1])
        except Exception:  # noqa: BLE001
            continue
