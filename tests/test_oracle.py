"""Every registered query against its SQL twin (the driver's gate), on sf0.001.

Queries without a twin must still run and keep a stable schema."""

import pytest

import __spark_entry__ as E
from conftest import SMALL
from oracle_check import compare

QUERIES = E.queries()
ORACLES = E.oracle_sql()
HEAVY = {"part_c_pipeline", "part_d_d1", "part_d_d2", "part_d_d3", "transform_protocol", "evaluate_protocol"}


def test_every_query_has_a_builder():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 100


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n in ORACLES))
def test_query_matches_sql_twin(spark, duck_small, name):
    r = compare(spark, duck_small, name, QUERIES[name], ORACLES[name], SMALL)
    assert r["ok"], r


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in ORACLES and n not in HEAVY))
def test_query_without_twin_runs(spark, name):
    df = QUERIES[name](spark, SMALL)
    rows = df.collect()
    assert len(rows) >= 0
    assert df.columns == QUERIES[name](spark, SMALL).columns


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["window_id", "y", "prediction"]
