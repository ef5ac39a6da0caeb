"""Every registered query on empty tables: its columns, and nothing but zero counts."""

import helpers as h
import pytest

from tripweave import model
from tripweave.plans import registry


@pytest.fixture(scope="module")
def nothing(spark):
    tables = {name: h.frame(spark, name, []) for name in model.SCHEMAS}
    return tables | {"trips_raw": tables["trips"]}


@pytest.mark.parametrize("name", sorted(registry.on_tables()))
def test_empty_tables(name, nothing, small):
    query = registry.on_tables()[name]
    df = query(nothing)
    rows = df.collect()
    if name.startswith("check_document_versions"):
        assert len(rows) == 26 and all(r.n_violations == 0 for r in rows)
    elif name.startswith(("check_", "stored_check_")) or name.endswith(("_component_count", "modified_count", "backfill_count", "_modified", "_types")):
        assert rows and all(value == 0 for row in rows for value in row if isinstance(value, int))
    elif name == "gen_options":
        assert sum(r.n_rows for r in rows if r.table_name != "stations") == 0
    elif name == "io_damaged_count":
        assert [tuple(r)[1:] for r in rows] == [(0, 0)] * 2
    elif name in ("delete_users_cascade", "stored_delete_users"):
        assert [tuple(r)[1:] for r in rows] == [(0, None, None)] * 3
    else:
        assert rows == []
    expected = query(small).schema
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in expected]
