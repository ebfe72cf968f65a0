"""Every registered query beside its SQL on the smallest test tables."""

import inspect
from pathlib import Path

import pytest

import __spark_entry__ as entry
from fabgauge.operators import explain
from fabgauge.queries import modeling
from tests.oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, tables, name):
    assert differences(spark, tables, FOLDER, name) == []


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    actions = {r.recommended_action for r in entry.entry(spark).collect()}
    assert actions == {"drop_candidate", "review", "keep"}


def test_permutation_importance_uses_the_default_repeats():
    default = inspect.signature(explain.permutation_importance).parameters["repeats"].default
    assert modeling.REPEATS == default == 10


def test_logistic_queries_fit_no_forest(spark, monkeypatch):
    def forest(*args, **kwargs):
        raise AssertionError("a forest was trained")

    monkeypatch.setattr(modeling.models, "train_forest", forest)
    for cached in (modeling._parts, modeling._fitted, modeling._run):
        cached.cache_clear()
    for name in ("train_logistic", "coefficient_importance"):
        assert entry.queries()[name](spark, FOLDER).count() > 0
