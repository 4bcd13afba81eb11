import math

import pytest
from ringfold.plans import catalogue


def norm(v):
    if v is None or isinstance(v, (str, bool)):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, int):
        return float(v)
    return str(v)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_against_duckdb(spark, data, duck, name):
    df = catalogue.QUERIES[name](spark, data)
    cols = sorted(df.columns)
    got = sorted(str([norm(v) for v in r]) for r in df.select(*cols).collect())
    if name not in catalogue.ORACLES:
        assert got
        return
    want = duck.sql(catalogue.ORACLES[name])
    assert cols == sorted(want.columns)
    rows = want.project(", ".join(f'"{c}"' for c in cols)).fetchall()
    assert got == sorted(str([norm(v) for v in r]) for r in rows)


def test_filters_reach_the_scan(spark, data):
    plan = catalogue.QUERIES["key_lookup"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderkey), EqualTo(o_orderkey,7)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in plan


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 16
    assert set(e.oracle_sql()) <= set(e.queries())
