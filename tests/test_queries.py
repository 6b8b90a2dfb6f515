"""Every registered query of the core against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[1]))

from compare import canon  # noqa: E402

from heddle import catalogue  # noqa: E402

Q, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(Q))
def test_query(spark, small, duck, name):
    got = Q[name](spark, small)
    if name in SQL:
        assert canon(got.toPandas()) == canon(duck.execute(SQL[name]).df())
    else:
        rows = got.toPandas()
        assert len(rows) and all(rows[c].notna().any() for c in rows.columns)


def test_sql_has_queries():
    assert set(SQL) <= set(Q)


def test_two_runs_agree(spark, small):
    a, b = (canon(Q["avg_linkage_groups"](spark, small).toPandas()) for _ in range(2))
    assert a == b


def test_widening_keeps_rows(spark, small):
    n = spark.read.parquet(f"{small}/max_transactions.parquet").count()
    w = Q["ladder_join"](spark, small)
    assert w.count() == n == w.select("row_no").distinct().count()


def test_coverage_bounds(spark, small):
    o = Q["overlap_reverse"](spark, small)
    assert o.where("supplier = partner").count() == 0
    assert o.where("mutual > coverage OR mutual > reverse_coverage").count() == 0
