"""Queries whose fit runs over all features return its values, and their SQL solves the same fit."""

import duckdb
import numpy as np
import pytest

from __spark_entry__ import oracle_sql, queries
from panelcast.queries.sql import RIDGE

SMOKE = "/root/testdata/sf0.001"
VALUES = {
    "a15_model_versions": "energy_consumption", "k05_compare_with_baseline": "MAPE", "k06_refit_and_forecast": "energy_consumption",
    "k08_cross_validated_search": "MAPE", "m02_batch_prediction": "energy_consumption",
}


@pytest.mark.parametrize("name", VALUES)
def test_sql_fits_all_features(name):
    assert "elimination" in oracle_sql()[name] and VALUES[name] in oracle_sql()[name]


@pytest.mark.parametrize("name", ["k05_compare_with_baseline", "k06_refit_and_forecast"])
def test_values_are_those_of_the_fit_in_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"set timezone = 'UTC'; create view events as select * from read_parquet('{SMOKE}/events.parquet')")
    want = con.execute(oracle_sql()[name]).df()
    got = queries()[name](spark, SMOKE).toPandas()
    keys = [c for c in want.columns if c in ("model", "area", "consumer_type", "datetime_utc")]
    both = got.merge(want, on=keys, suffixes=("", "_sql"))
    assert len(both) == len(got) == len(want)
    assert np.allclose(both[VALUES[name]], both[VALUES[name] + "_sql"], atol=2e-4) and both[VALUES[name]].nunique() > 1


def test_the_solver_is_ridge_regression():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(40, 5)) * [1, 5, 0.1, 2, 0], rng.normal(size=40)
    con = duckdb.connect()
    con.execute("create table design (g int, r int, x double[], y double)")
    con.executemany("insert into design values (0, ?, ?, ?)", [(i, a.tolist(), float(b)) for i, (a, b) in enumerate(zip(x, y))])
    con.execute("create table trials as select 7 as trial, 0 as g, 0.3 as penalty")
    c, a = con.execute(f"with recursive {RIDGE} select c, a from solved").fetchone()
    z = np.divide(x - x.mean(axis=0), x.std(axis=0), out=np.zeros_like(x), where=x.std(axis=0) > 0)
    beta = np.linalg.solve(z.T @ z / 40 + 0.3 / y.std() * np.eye(5), z.T @ (y - y.mean()) / 40)
    hand = np.divide(beta, x.std(axis=0), out=np.zeros(5), where=x.std(axis=0) > 0)
    assert np.allclose(c, hand, atol=1e-12) and np.isclose(a, y.mean() - x.mean(axis=0) @ hand)
