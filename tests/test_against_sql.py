"""Every query with SQL, run on the smallest tables by Spark and by DuckDB."""

import glob
import math
import os

import duckdb
import pytest

from tallyloom.plans import core

CORE = core()
#: Queries run here by default; TALLYLOOM_ALL=1 runs all of them.
QUICK = ("p4", "p6", "join_p", "join_d", "join_as", "join_r", "gr_t", "gr_s", "er_e", "cl_k", "cl_w", "cl_running", "rs_r", "ml_t", "st_t", "agg_m", "agg_s", "win_s", "set_d", "s_j", "s_b", "src_c", "sink_a", "lim_")
ALL = bool(os.environ.get("TALLYLOOM_ALL"))


def chosen(names):
    return sorted(n for n in names if ALL or n.startswith(QUICK))


def canonical(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    if isinstance(v, float):
        return f"{v:.6f}"
    if isinstance(v, list | tuple):
        return str([canonical(x) for x in v])
    return str(v)


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def compare(spark, sf, duck, query, sql):
    df = query(spark, sf)
    columns = sorted(df.columns)
    got = sorted(tuple(map(canonical, r)) for r in df.select(*columns).collect())
    result = duck.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(canonical(r[i]) for i in at) for r in result.fetchall())


@pytest.mark.parametrize("name", chosen(CORE.sql))
def test_equals_sql(spark, sf, duck, name):
    compare(spark, sf, duck, CORE.queries[name], CORE.sql[name])


@pytest.mark.parametrize("name", chosen(set(CORE.queries) - set(CORE.sql)))
def test_runs_without_sql(spark, sf, name):
    df = CORE.queries[name](spark, sf)
    assert df.columns
    df.collect()


def test_names_are_unique_and_sql_has_queries():
    assert set(CORE.sql) <= set(CORE.queries)
