"""Row numbers and scans against pandas, with one key that holds a third of the rows and tiny blocks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparrowmill.operators import series as sr
from sparrowmill.operators.ordering import number_rows, position_in_key, running, running_linear

ROWS = 7


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    n = 300
    key = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 40, n))
    return pd.DataFrame({"k": key, "t": rng.permutation(n), "v": rng.integers(1, 100, n) / 10})


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data).repartition(5)


def ordered(df, data):
    return df.toPandas().sort_values(["k", "t"]).reset_index(drop=True), data.sort_values(["k", "t"]).reset_index(drop=True)


def test_number_rows(frame, data):
    got = number_rows(frame, F.desc("v"), "t").toPandas().sort_values("source_index")
    want = data.sort_values(["v", "t"], ascending=[False, True])
    assert got.source_index.tolist() == list(range(len(data)))
    assert got.t.tolist() == want.t.tolist()


def test_number_rows_of_nothing(frame):
    assert number_rows(frame.filter("k < 0"), "t").count() == 0


def test_position_in_key(frame, data):
    got, want = ordered(position_in_key(frame, ["k"], ["t"], rows=ROWS), data)
    assert got.pos.tolist() == (want.groupby("k").cumcount() + 1).tolist()


def test_running_kinds(frame, data):
    out = running(frame, ["k"], ["t"], {
        "s": ("sum", F.col("v")), "p": ("product", F.col("v") / 10), "m": ("max", F.col("v")), "b": ("max_before", F.col("v")),
    }, rows=ROWS)
    got, want = ordered(out, data)
    g = want.groupby("k").v
    np.testing.assert_allclose(got.s, g.cumsum())
    np.testing.assert_allclose(got.p, (want.v / 10).groupby(want.k).cumprod())
    np.testing.assert_allclose(got.m, g.cummax())
    before = g.cummax().groupby(want.k).shift(1)
    np.testing.assert_allclose(got.b.astype(float), before)


def test_running_without_key(frame, data):
    got = running(frame, [], ["t"], {"s": ("sum", F.col("v"))}, rows=ROWS).toPandas().sort_values("t")
    np.testing.assert_allclose(got.s, data.sort_values("t").v.cumsum())


def test_running_linear(frame, data):
    got, want = ordered(running_linear(frame, ["k"], ["t"], {"m": "v"}, 0.9, 0.1, rows=ROWS), data)
    expect, last, state = [], None, 0.0
    for k, v in zip(want.k, want.v):
        state = 0.9 * (state if k == last else 0.0) + 0.1 * v
        last = k
        expect.append(state)
    np.testing.assert_allclose(got.m, expect)


def test_lags_and_leads_across_blocks(frame, data):
    got, want = ordered(sr.lag_features(frame, ["k"], ["t"], "v", 3, rows=ROWS), data)
    g = want.groupby("k").v
    want = want.assign(x1=g.shift(3), x2=g.shift(2), x3=g.shift(1)).dropna().reset_index(drop=True)
    assert len(got) == len(want)
    np.testing.assert_allclose(got[["x1", "x2", "x3", "y"]].astype(float), want[["x1", "x2", "x3", "v"]])
    got, want = ordered(sr.horizons(frame, ["k"], ["t"], "v", (1, 5), rows=ROWS), data)
    np.testing.assert_allclose(got.ahead_5.astype(float), want.groupby("k").v.shift(-5))


def test_pool_and_correlation_across_blocks(frame, data):
    got, want = ordered(sr.sliding_pool(frame, ["k"], ["t"], "v", 4, rows=ROWS), data)
    full = want.groupby("k").v.shift(-3).notna()
    pooled = want.groupby("k").v.transform(lambda s: s[::-1].rolling(4).max()[::-1])[full]
    np.testing.assert_allclose(got.pool_max, pooled)
    got, want = ordered(sr.correlate(frame, ["k"], ["t"], "v", (1, -1), rows=ROWS), data)
    diff = (want.v - want.groupby("k").v.shift(-1)).dropna()
    np.testing.assert_allclose(got["corr"].astype(float), diff, atol=1e-12)


def test_total_variation(frame, data):
    got = sr.total_variation(frame, ["k"], ["t"], "v", rows=ROWS).toPandas().set_index("k").tv.dropna()
    want = data.sort_values(["k", "t"]).groupby("k").v.apply(lambda s: s.diff().abs().mean() * 0.5).dropna()
    np.testing.assert_allclose(got.sort_index(), want.sort_index())
