import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_names():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(__import__("riverloom.plans.registry", fromlist=["x"]).oracle_sql()))
def test_query_equals_sql(spark, name):
    """Every query with SQL gives the same rows at the smallest scale."""
    from pathlib import Path

    from riverloom.plans import registry

    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    mine = registry.queries()[name](spark, SF)
    cols = sorted(mine.columns)
    norm = lambda v: "∅" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)
    a = sorted(tuple(norm(r[c]) for c in cols) for r in mine.collect())
    res = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    rows = [dict(zip(names, r)) for r in res.fetchall()]
    b = sorted(tuple(norm(r[c].replace(tzinfo=None) if hasattr(r[c], "tzinfo") else r[c]) for c in cols) for r in rows)
    assert a == b
