"""Every registered query against its SQL check, on the smallest tables."""

import pytest

import __spark_entry__ as entry
import catalog
import check

ORACLES = entry.oracle_sql()
MODEL_RUNS = {"train", "predict", "predict_svm", "predict_forest", "save_model", "al_cycle", "al_cycle_embedding", "end_to_end"}


@pytest.fixture(scope="module")
def con(sf):
    return check.database(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, sf, name):
    assert check.compare(con, entry.queries()[name](spark, sf), ORACLES[name]) is None


def test_only_model_runs_lack_sql():
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == MODEL_RUNS


def test_flagship_query(spark):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"label", "n", "pct"}
