"""Every query of the catalogue against its SQL, on the smallest tables."""

import math
import os

import pytest

from lotwise.plans import catalogue

SF = "/root/testdata/sf0.001"


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if v is None or isinstance(v, float) and math.isnan(v) or str(v) in ("NaT", "<NA>"):
        return None
    if isinstance(v, float):
        return str(int(v)) if v.is_integer() else f"{v:.9g}"
    return str(v)


def rows(pdf):
    columns = sorted(pdf.columns)
    return sorted((tuple(map(plain, r)) for r in pdf[columns].itertuples(index=False, name=None)), key=str)


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return con


@pytest.mark.parametrize("name", catalogue.QUERIES)
def test_query(spark, con, name):
    got = catalogue.QUERIES[name](spark, SF).toPandas()
    if name not in catalogue.SQL:
        assert len(got)
        return
    want = con.sql(catalogue.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(catalogue.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_else_imports_the_training_data_operators():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for folder, _, files in os.walk(os.path.join(root, "lotwise")):
        for f in files:
            if f.endswith(".py") and f"{os.sep}llm" not in folder:
                assert ".llm" not in open(os.path.join(folder, f)).read(), f
