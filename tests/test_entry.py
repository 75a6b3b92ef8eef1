import os

import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"


def test_names_and_sql_match():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) > 80


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")
def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "reason" in df.columns


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")
@pytest.mark.parametrize("name", ["c23_window_gates", "d10_iou_match", "p5_found", "f12_value_timeline", "e8_grouped_voices"])
def test_query_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    got = entry.queries()[name](spark, SMALL).toPandas()
    if name not in entry.oracle_sql():
        assert len(got)
        return
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.sql(f"create view {f[:-8]} as select * from '{SMALL}/{f}'")
    want = con.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    for c in got.select_dtypes("number").columns:
        assert got[c].sum() == pytest.approx(want[c].sum())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")
@pytest.mark.parametrize("name", ["g1_full_order", "g2_full_locality", "d13_nearest_segment"])
def test_whole_orders_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    got = entry.queries()[name](spark, SMALL).toPandas()
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.sql(f"create view {f[:-8]} as select * from '{SMALL}/{f}'")
    want = con.sql(entry.oracle_sql()[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert sorted(map(tuple, got[cols].astype(str).values)) == sorted(map(tuple, want[cols].astype(str).values))
