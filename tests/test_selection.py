"""Exact quantiles by distributed selection, with a small bound so that every
path is taken."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.operators import selection as S
from panelspark.operators.stats import DEFAULT_PROBS, quantile_breaks


def frame(spark, columns):
    n = max(len(v) for v in columns.values())
    rows = [tuple(v[i] if i < len(v) else None for v in columns.values()) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in columns))


def linear(values, probs=DEFAULT_PROBS):
    return np.quantile(np.array(values, dtype=float), probs).tolist()


@pytest.mark.parametrize("bound", [1, 7, 60, 100_000])
def test_quantiles_of_any_size(spark, bound):
    rnd = np.random.default_rng(bound)
    columns = {"a.b": rnd.normal(size=3000).tolist(), "ties": [5.0] * 1200 + rnd.integers(0, 9, 800).astype(float).tolist(),
               "short": [3.0, 1.0], "one": [7.5]}
    got = quantile_breaks(frame(spark, columns).repartition(5), list(columns), bound=bound).first()
    for i, v in enumerate(columns.values()):
        assert np.allclose(got[i], linear(v), rtol=1e-12), (bound, i)


def test_columns_without_values_and_empty_tables(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "x double, y double")
    got = quantile_breaks(df, ["x", "y"]).first()
    assert got.x is None and got.y == pytest.approx(linear([1.0, 2.0]))
    assert quantile_breaks(df.where("y > 5"), ["x", "y"]).first() == (None, None)


def test_no_read_out_exceeds_the_bound(spark, monkeypatch):
    sizes = []
    read = S._read_out
    monkeypatch.setattr(S, "_read_out", lambda v, ranges, found: (sizes.extend(r.rows for r in ranges), read(v, ranges, found)))
    df = spark.range(20_000).select((F.hash("id") % 5000).cast("double").alias("x"))
    got = quantile_breaks(df, ["x"], bound=40).first().x
    assert sizes and max(sizes) <= 40
    assert got == pytest.approx(linear([r.x for r in df.collect()]))


def test_two_hundred_columns_in_one_go(spark):
    rnd = np.random.default_rng(4)
    data = rnd.normal(size=(300, 200))
    cols = [f"c{i}" for i in range(200)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], ", ".join(f"{c} double" for c in cols))
    got = quantile_breaks(df, cols, probs=(0.05, 0.5), bound=50).first()
    assert np.allclose(np.array([list(g) for g in got]), np.quantile(data, [0.05, 0.5], axis=0).T)
