"""Problem 2: flat, linked tables from nested records by shared inlining.

1. `schema_graph` walks all records and reduces them, per task and then overall, to the distinct edges
   (parent type, child type, repeated). Its size is that of the schema, not of the data.
2. `inline` decides per node: a node that repeats, that several parents share or that contains itself becomes a table;
   a singleton descendant of one parent is inlined into the table above it.
3. `shred` walks the records again and emits one row per table node: table, its own id, the id and table of its parent
   (the foreign key), its position under the parent, its map key, the inlined scalars, and the natural keys that its
   ancestors pass down.

Key names that differ only in spelling are one type (`aliases`); an object whose keys are all numbers is a repeated
child by those keys; a container given as a JSON string is read as what it holds.

4. `typed` makes of one table node a flat table with its keys and a typed column for each value.

Defined cases: a null payload, one that is not valid JSON, and one whose top is no object give no rows; a scalar or null
in a place of objects keeps its position and gives no row, scalars beside objects stand as JSON in `<key>_values`; of a
record delivered again the latest readable delivery stands (`latest`).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

ROOT = "record"
ROWS = "tbl string, {id} bigint, node_id int, parent_tbl string, parent_id int, pos int, map_key string, carried map<string,string>, vals map<string,string>"


@dataclass(frozen=True)
class Shape:
    """How records are read. aliases: other spellings of a key; listed: keys that hold repeated children even where
    one stands alone; carry: scalars that a table passes down to all tables below it; boxes: keys that hold a box."""

    aliases: dict[str, str] = field(default_factory=dict)
    listed: frozenset[str] = frozenset()
    carry: dict[str, tuple[str, ...]] = field(default_factory=dict)
    boxes: frozenset[str] = frozenset()


def number(v: Any) -> float | None:
    """A finite number given as such or as text."""
    if isinstance(v, bool) or not isinstance(v, (int, float, str)):
        return None
    try:
        x = float(v)
    except (ValueError, OverflowError):
        return None
    return x if x - x == 0 else None


def box(v: Any) -> list[float] | None:
    """left, top, right, bottom of a box in any of its notations: four numbers, two corners, named sides, a polygon
    (its envelope, unless its first and third corner are inverted), or text with four numbers. None where not all four are told."""
    if isinstance(v, str):
        v = v.strip().strip("[]()")
        v = [x for x in v.replace(";", ",").split(",")] if "," in v or ";" in v else v.split()
    if isinstance(v, dict):
        low = {str(k).lower(): x for k, x in v.items()}
        if isinstance(low.get("points"), list):
            pts = [(number(p[0]), number(p[1])) if isinstance(p, (list, tuple)) and len(p) == 2 else (None, None) for p in low["points"]]
            if len(pts) < 3 or any(x is None or y is None for x, y in pts):
                return None
            xs, ys = [p[0] for p in pts], [p[1] for p in pts]
            out = [min(xs), min(ys), max(xs), max(ys)]
            if len(pts) == 4 and (pts[2][0] < pts[0][0] or pts[2][1] < pts[0][1]):
                out = [pts[0][0], pts[0][1], pts[2][0], pts[2][1]]
            return out
        side = lambda *names: next((low[n] for n in names if low.get(n) is not None), None)
        x, y = side("x1", "left", "xmin", "x0", "x"), side("y1", "top", "ymin", "y0", "y")
        x2, y2 = side("x2", "right", "xmax"), side("y2", "bottom", "ymax")
        if x2 is None and number(side("width", "w")) is not None and number(x) is not None:
            x2 = number(x) + number(side("width", "w"))
        if y2 is None and number(side("height", "h")) is not None and number(y) is not None:
            y2 = number(y) + number(side("height", "h"))
        v = [x, y, x2, y2]
    if isinstance(v, list):
        if len(v) == 2 and all(isinstance(p, (list, tuple)) and len(p) == 2 for p in v):
            v = [*v[0], *v[1]]
        if len(v) == 4:
            out = [number(x) for x in v]
            return None if None in out else out
    return None


def opened(v: Any) -> Any:
    """A container given as a JSON string, opened; anything else as it is."""
    if isinstance(v, str) and v[:1] in "[{" and v:
        try:
            inner = json.loads(v)
        except ValueError:
            return v
        return inner if isinstance(inner, (dict, list)) else v
    return v


def children(key: str, v: Any, shape: Shape) -> tuple[bool, list[tuple[int, str | None, Any]]] | None:
    """Whether the value of a key repeats, and its objects with position and map key; None where it is a scalar."""
    v = opened(v)
    if isinstance(v, list):
        if not v:
            return True, []
        objects = [(i, None, o) for i, x in enumerate(v) if isinstance(o := opened(x), dict)]
        return (True, objects) if objects else (None if key not in shape.listed else (True, []))
    if isinstance(v, dict):
        if v and all(isinstance(k, str) and k.isdigit() for k in v):
            return True, [(i, k, o) for i, (k, x) in enumerate(v.items()) if isinstance(o := opened(x), dict)]
        return key in shape.listed, [(0, None, v)]
    return None


def parsed(payload: str | None) -> dict | None:
    if not payload:
        return None
    try:
        v = json.loads(payload)
    except (ValueError, RecursionError):
        return None
    return v if isinstance(v, dict) else None


def edges(record: dict, shape: Shape, out: set[tuple[str, str, bool]]) -> None:
    todo = [(ROOT, record)]
    while todo:
        parent, node = todo.pop()
        for k, v in node.items():
            k = shape.aliases.get(k, k)
            if k in shape.boxes:
                continue
            got = children(k, v, shape)
            if got is not None:
                out.add((parent, k, got[0]))
                todo.extend((k, o) for _, _, o in got[1])


def schema_graph(records: DataFrame, payload: str, shape: Shape) -> DataFrame:
    """Distinct edges (parent, child, repeated) over all records: each task sends its own distinct ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[str, str, bool]] = set()
        for b in batches:
            for text in b.column(0).to_pylist():
                if (r := parsed(text)) is not None:
                    edges(r, shape, found)
        rows = sorted(found)
        yield pa.RecordBatch.from_pydict({"parent": pa.array([r[0] for r in rows], pa.string()), "child": pa.array([r[1] for r in rows], pa.string()), "repeated": pa.array([r[2] for r in rows], pa.bool_())})

    return records.select(payload).mapInArrow(run, "parent string, child string, repeated boolean").groupBy("parent", "child").agg(F.max("repeated").alias("repeated"))


def inline(graph: list[tuple[str, str, bool]]) -> set[str]:
    """The node types that become tables: the root, and each type that repeats, that several parents share or that contains
    itself, directly or below."""
    parents: dict[str, set[str]] = {}
    below: dict[str, set[str]] = {}
    repeated = {c for _, c, many in graph if many}
    for p, c, _ in graph:
        parents.setdefault(c, set()).add(p)
        below.setdefault(p, set()).add(c)

    def reaches_itself(n: str) -> bool:
        seen, todo = set(), list(below.get(n, ()))
        while todo:
            if (x := todo.pop()) == n:
                return True
            if x not in seen:
                seen.add(x)
                todo.extend(below.get(x, ()))
        return False

    return {ROOT} | repeated | {c for c, ps in parents.items() if len(ps) > 1 or reaches_itself(c)}


def text_of(v: Any) -> str | None:
    return v if isinstance(v, str) or v is None else json.dumps(v, ensure_ascii=False)


def nodes(record: dict, shape: Shape, tables: set[str]) -> list[tuple]:
    """The table rows of one record: (table, node id, parent table, parent id, position, map key, carried, values)."""
    out: list[tuple] = []

    def fill(node: dict, prefix: str, vals: dict[str, str | None], later: list[tuple[str, int, str | None, dict]]) -> None:
        for k, v in node.items():
            k = shape.aliases.get(k, k)
            if k in shape.boxes:
                if (b := box(opened(v))) is not None:
                    vals.update(zip((f"{prefix}{k}_{s}" for s in ("left", "top", "right", "bottom")), map(repr, b)))
                continue
            got = children(k, v, shape)
            if isinstance(v, list) and got is not None and (loose := [x for x in v if x is not None and not isinstance(opened(x), dict)]):
                vals[f"{prefix}{k}_values"] = text_of(loose)
            if got is None:
                vals[prefix + k] = text_of(v)
            elif k in tables:
                later.extend((k, pos, key, o) for pos, key, o in got[1])
            else:
                for _, _, o in got[1]:
                    fill(o, f"{prefix}{k}_", vals, later)

    todo: list[tuple] = [(ROOT, None, None, 0, None, {}, record)]
    while todo:
        name, ptbl, pid, pos, key, carried, node = todo.pop()
        vals: dict[str, str | None] = {}
        later: list[tuple[str, int, str | None, dict]] = []
        fill(node, "", vals, later)
        me = len(out)
        out.append((name, me, ptbl, pid, pos, key, carried, vals))
        down = carried
        if name in shape.carry:
            down = carried | {f"{name}.pos": str(pos), f"{name}.key": key} | {f"{name}.{c}": vals.get(c) for c in shape.carry[name]}
        todo.extend((k, name, me, p, q, down, o) for k, p, q, o in reversed(later))
    return out


def shred(records: DataFrame, rec_id: str, payload: str, shape: Shape, tables: set[str]) -> DataFrame:
    """All tables in one frame, told apart by `tbl`; one narrow pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.map_(pa.string(), pa.string()), pa.map_(pa.string(), pa.string())]
        names = ["tbl", rec_id, "node_id", "parent_tbl", "parent_id", "pos", "map_key", "carried", "vals"]
        for b in batches:
            rows: list[tuple] = []
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, (rid, text) in enumerate(zip(ids, texts)):
                if (r := parsed(text)) is not None:
                    rows.extend((n[0], rid, *n[1:6], list(n[6].items()), list(n[7].items())) for n in nodes(r, shape, tables))
                if len(rows) > 20_000 or (i == len(ids) - 1 and rows):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                    rows = []

    return records.select(rec_id, payload).mapInArrow(run, ROWS.format(id=rec_id))


def latest(records: DataFrame, rec_id: str, payload: str, delivered: str) -> DataFrame:
    """Of each record its latest delivery that can be read, else its latest one that is not null."""
    tasks = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = Window.partitionBy(rec_id).orderBy(F.get_json_object(payload, "$").isNull(), F.col(delivered).desc_nulls_last(), F.col(payload))
    rows = records.filter(F.col(payload).isNotNull()).repartition(tasks, rec_id)
    return rows.withColumn("_d", F.row_number().over(order)).filter("_d = 1").drop("_d")


def typed(rows: DataFrame, rec_id: str, tbl: str) -> DataFrame:
    """One table of `shred` as a flat table: record, node_id, parent_tbl and parent_id (the foreign key to the table above),
    pos, map_key, and a column for each value: double where all its values are numbers, boolean where all are, else
    string. What comes to the driver has a row per column."""
    own = written(rows.filter(F.col("tbl") == tbl), "nested-table")
    told = own.select(F.explode("vals").alias("key", "value")).filter("value is not null").groupBy("key")
    kinds = told.agg(F.count("*").alias("n"), F.count(F.expr("try_cast(value as double)")).alias("numbers"), F.count(F.when(F.col("value").isin("true", "false"), 1)).alias("flags")).orderBy("key").collect()
    taken = {rec_id.lower(), "node_id", "parent_tbl", "parent_id", "pos", "map_key"}
    columns = []
    for r in kinds:
        name = r.key
        while name.lower() in taken:
            name += "_value"
        taken.add(name.lower())
        value = F.col("vals")[r.key]
        kind = "double" if r.numbers == r.n else "boolean" if r.flags == r.n else "string"
        columns.append((value.try_cast(kind) if kind != "string" else value).alias(name))
    return own.select(rec_id, "node_id", "parent_tbl", "parent_id", "pos", "map_key", *columns)
