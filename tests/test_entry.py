"""The driver contract of __spark_entry__.py."""

import os

import pytest

import __spark_entry__ as E


def test_queries_and_oracles_pair_up():
    qs, orc = E.queries(), E.oracle_sql()
    without_sql = {q for q in qs if q == "pipeline" or q.startswith("op")}  # only these may lack an oracle
    assert set(qs) - without_sql <= set(orc) <= set(qs)
    assert len(qs) >= 54
    assert all(callable(f) for f in qs.values()) and all(isinstance(s, str) and s.strip() for s in orc.values())


@pytest.mark.skipif(not os.path.isdir(E.SMOKE_DIR), reason="test data not present")
def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["artist_id", "artist_name", "total_revenue"]
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert [r["total_revenue"] for r in rows] == sorted((r["total_revenue"] for r in rows), reverse=True)
