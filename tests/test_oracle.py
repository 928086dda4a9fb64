"""Every registered query runs, and equals its independent SQL where there is one."""

import pytest
from conftest import SMALL_DIR

import __spark_entry__ as contract
from riskweave.operators import models
from riskweave.plans import catalog, oracle
from tools.compare import connect, difference

SQL = oracle.sql()


SMALL_MODELS = {models.LOGISTIC: {"maxIter": 50}, models.FOREST: {"numTrees": 5, "maxDepth": 4}, models.BOOSTED: {"maxIter": 4, "maxDepth": 3}}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL_DIR)


@pytest.fixture(scope="module", autouse=True)
def small_models():
    """Queries train the full sizes; here a few trees do, so that every query gets its verdict in time."""
    with pytest.MonkeyPatch.context() as patch:
        for kind, change in SMALL_MODELS.items():
            patch.setitem(models.SETTINGS, kind, {**models.SETTINGS[kind], **change})
        patch.setattr(catalog, "_TRAINED", {})
        yield


def test_sql_only_for_registered_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    query = contract.queries()[name](spark, SMALL_DIR)
    rows = query.toPandas()
    assert len(rows.columns) and len(rows)
    if name in SQL:
        assert difference(rows, duck.sql(SQL[name]).df()) is None
        if name.startswith("fixed_"):
            return  # tree attributions walk numpy arrays
        # what SQL can express stays in the JVM
        plan = query._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan


def test_entry(spark):
    assert contract.entry(spark).count() == 1000
