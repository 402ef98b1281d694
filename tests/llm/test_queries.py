"""Every query of the subpackage runs over whole small tables and gives the columns that are asked for."""

from __future__ import annotations

import pytest

from foliospark import llm

COLUMNS = {
    "p1_found": ["src", "row_id", "kind", "fixed"], "p3_found": ["src", "row_id", "kind", "start_pos"], "p4_found": ["field_id_a", "field_id_b"], "p5_found": ["file", "page", "block_idx", "seg_no", "lang"], "p6_ids": ["doc_id", "ids"], "p8_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(llm.queries()))
def test_runs(spark, data, name):
    df = llm.queries()[name](spark, data)
    assert df.columns == COLUMNS.get(name, df.columns)
    rows = df.collect()
    if name.endswith("_found"):
        assert rows and len(rows) == len({tuple(r) for r in rows})
