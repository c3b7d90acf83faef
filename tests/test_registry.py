"""Every registered query with SQL against DuckDB over the same tables."""

import glob
import math
import os

import duckdb
import pytest

from strataflow.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


def rows(data, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(value(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_same_as_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    found = duck.execute(registry.ORACLE[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows([tuple(r) for r in df.collect()], df.columns) == rows(found.fetchall(), columns)


def test_all_have_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE)


def test_all_rows_take_part(spark, duck):
    """Each order is judged or part of the state, and each page with a name has a file of its own."""
    n = registry.QUERIES["insert_outcomes_all"](spark, SF).count()
    assert 0 < n == duck.execute("SELECT count(*) FROM orders").fetchone()[0] - duck.execute("SELECT count(*) FROM orders WHERE o_orderstatus = 'F'").fetchone()[0]
    assert registry.QUERIES["insert_outcomes"](spark, SF).count() == duck.execute("SELECT count(*) FROM orders").fetchone()[0]
    assert registry.QUERIES["import_plan"](spark, SF).count() > 0
    assert registry.QUERIES["key_resolution_all"](spark, SF).where("path is null").count() == 0
