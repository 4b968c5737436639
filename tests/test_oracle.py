"""Every registered query that has SQL, against DuckDB at sf0.01; the same SQL at sf0.001 for a few."""

import math

import duckdb
import pytest

from grouprank.plans.fixtures import TABLES
from grouprank.plans.oracle import oracle_sql
from grouprank.plans.queries import QUERIES

from tests.conftest import SF001, SF01

KEYS = sorted(oracle_sql())


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def c(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else f"{v:.6f}"
        return repr(v)
    return sorted(tuple(c(r[i]) for i in order) for r in rows)


def duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


@pytest.mark.parametrize("folder, key", [(SF01, k) for k in KEYS] + [(SF001, k) for k in ("eval_vectors", "lookup_input_stratified", "tfidf", "join_left")])
def test_matches_oracle(spark, folder, key):
    df = QUERIES[key](spark, folder)
    res = duck(folder).execute(oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(res.fetchall(), dcols)
