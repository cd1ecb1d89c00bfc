"""Queries against their SQL, over whole tables."""

import os

import duckdb
import pandas as pd
import pytest

from labelweave.llm.queries import ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, run_query, sf_dir):
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        con.execute(f"create view {file[:-8]} as select * from '{sf_dir}/{file}'")
    want, got = con.execute(ORACLES[name]).df(), run_query(name)
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns

    key = lambda r: tuple(map(str, r))
    normal = lambda rs: sorted([tuple(float(v) if isinstance(v, (int, float)) else v for v in r)
                                for r in rs], key=key)
    as_rows = lambda f: [tuple(None if pd.isna(v) else v for v in r)
                         for r in f[columns].astype(object).itertuples(index=False, name=None)]
    assert normal(as_rows(got)) == normal(as_rows(want))
