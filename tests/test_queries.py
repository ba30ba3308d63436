"""Every query against its SQL, on the smallest tables."""

import pytest

from tests.compare import connect, same
from tickforge.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, con, name):
    same(QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", ["lstm_folds", "cnn_folds"])
def test_networks(spark, con, name):
    """A row for each row of the folds, neutral where no window ends (gradients and learning: test_networks.py)."""
    got = QUERIES[name](spark, SF).toPandas()
    rows = con.execute(ORACLE_SQL["fold_predictions"]).df()
    key = ["split_id", "role", "row_idx", "y"]
    counts = rows.groupby(["split_id", "role"]).size()
    assert got.groupby(["split_id", "role"]).size().equals(counts) and sorted(got.y) == sorted(rows.y) and set(key) <= set(got.columns)
    assert (got[got.row_idx < 7].p == 1).all() and got[got.row_idx >= 7].proba.notna().all() and set(got.p) <= {0, 1, 2}


def test_queries_without_sql():
    assert set(QUERIES) - set(ORACLE_SQL) == {"lstm_folds", "cnn_folds"}


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() >= 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
