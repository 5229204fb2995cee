from pathlib import Path

import duckdb
import pytest

from riverloom.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": ["chunk_id", "idioma"], "p2_found": ["chunk_id"], "p3_found": ["chunk_id", "clase"], "p4_found": ["chunk_id", "campo"], "p5_found": ["chunk_id", "clase"], "p6_found": ["chunk_id"],
    "p7_ids": ["doc_id", "ids"], "p8_found": ["doc_id", "item_id"], "p9_found": ["doc_id", "inicio", "fin"],
}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_runs_with_its_columns(spark, name):
    df = queries.queries()[name](spark, SF)
    if name in COLUMNS:
        assert df.columns == COLUMNS[name]
        assert df.count() == df.distinct().count() > 0
    else:
        assert df.count() > 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    df = queries.queries()[name](spark, SF)
    cols = sorted(df.columns)
    res = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in res.description]
    want = sorted(tuple(str(r[names.index(c)]) for c in cols) for r in res.fetchall())
    assert sorted(tuple(str(r[c]) for c in cols) for r in df.collect()) == want


def test_disjoint(spark):
    """Fragments of p2 and p5 are never cases of p1, nor those of p2 of p5."""
    q = queries.queries()
    ids = {n: {r.chunk_id for r in q[n](spark, SF).collect()} for n in ("p1_found", "p2_found", "p5_found")}
    assert not ids["p1_found"] & (ids["p2_found"] | ids["p5_found"]) and not ids["p2_found"] & ids["p5_found"]
