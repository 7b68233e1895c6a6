"""Every query of the library runs on the smallest data, and those with SQL equal it."""

import os
from collections import Counter

import duckdb
import pandas as pd
import pytest

from quernstone.plans import catalog, reports, speech  # noqa: F401 - the others add their queries to the catalogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


def plain(value):
    if pd.isna(value):
        return None
    return round(float(value), 6) + 0.0 if isinstance(value, (int, float)) or getattr(getattr(value, "dtype", None), "kind", "") in ("i", "u", "f") else str(value)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    if name not in catalog.ORACLES:
        assert len(got) > 0
        return
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{SF}/{f}')")
    expected = con.sql(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    as_rows = lambda d: Counter(tuple(map(plain, r)) for r in d[sorted(d.columns)].astype(object).itertuples(index=False))
    assert as_rows(got) == as_rows(expected)


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
