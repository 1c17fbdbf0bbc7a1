"""Moments, recurrences and metrics that have to survive large offsets, hot groups and many labels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparrowmill.functions import scalars as sc
from sparrowmill.operators import features as ft
from sparrowmill.operators import metrics as mx
from sparrowmill.operators import profile as pf
from sparrowmill.operators import user_code as uc
from sparrowmill.operators.ordering import affine_scan, running_linear


@pytest.mark.parametrize("held", [1 << 20, 1])
def test_covariances_of_groups_far_apart(spark, held):
    rng = np.random.default_rng(0)
    near, far = rng.normal(size=(300, 2)) * [3.0, 2.0], 1e8 + rng.normal(size=(400, 2)) * [3.0, 2.0]
    odd = np.vstack([[[-5e7, 5e7]], rng.normal(size=(99, 2))])
    sets = {"near": near, "far": far, "odd": odd, None: near[:50] - 1e7}
    rows = [(g, v.tolist()) for g, m in sets.items() for v in m] + [("near", None)]
    df = spark.createDataFrame(rows, "g string, v array<double>").repartition(5)
    cells = mx.co_moments(df, F.col("v"), ["g"], held).collect()
    assert len(cells) == 3 * len(sets)
    for r in cells:
        m = sets[r.g]
        want = np.cov((m - m.mean(0)).T)
        assert r.n == len(m) and r.c / (r.n - 1) == pytest.approx(want[r.i, r.j], rel=1e-6, abs=1e-6)
        assert r.mean_i == pytest.approx(m[:, r.i].mean(), rel=1e-12)


def test_gram_and_frechet_of_singular_sets(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(4, 6)), rng.normal(size=(5, 6))  # fewer vectors than components
    df = lambda m: spark.createDataFrame([(v.tolist(),) for v in m], "v array<double>").repartition(2)
    gram = {(r.i, r.j): r.g for r in mx.gram(df(a), F.col("v"), 3).collect()}
    assert all(g == pytest.approx((a.T @ a)[i, j] / 12) for (i, j), g in gram.items())
    s1, s2 = np.cov(a, rowvar=False), np.cov(b, rowvar=False)
    trace = np.sqrt(np.clip(np.linalg.eigvals(s1 @ s2).real, 0, None)).sum()
    want = ((a.mean(0) - b.mean(0)) ** 2).sum() + np.trace(s1) + np.trace(s2) - 2 * trace
    assert mx.frechet(df(a), df(b), F.col("v")) == pytest.approx(want, abs=1e-6)
    c, d = np.diag(np.cov(a, rowvar=False)), np.diag(np.cov(b, rowvar=False))
    flat = ((a.mean(0) - b.mean(0)) ** 2).sum() + ((np.sqrt(c) - np.sqrt(d)) ** 2).sum()
    assert mx.frechet_diagonal(df(a), df(b), F.col("v")).first().distance == pytest.approx(flat)


def test_fold_errors_and_solve_far_from_zero(spark):
    rng = np.random.default_rng(3)
    x, z = 1e8 + rng.normal(size=600), -1e7 + rng.normal(size=600)
    y = 5e8 + 2.0 * (x - 1e8) - 0.5 * (z + 1e7) + 0.1 * rng.normal(size=600)
    rows = [(i, i % 4, float(a), float(c), float(b)) for i, (a, c, b) in enumerate(zip(x, z, y))]
    df = spark.createDataFrame(rows + [(700, 1, None, 1.0, 1.0)], "id int, fold bigint, x double, z double, y double")
    got = mx.kfold_line_errors(df, F.col("x"), F.col("y"))
    for r in got.collect():
        out = np.arange(600) % 4 == r.fold
        slope, base = np.polyfit(x[~out] - 1e8, y[~out] - 5e8, 1)
        error = lambda m: np.sqrt((((y - 5e8) - slope * (x - 1e8) - base)[m] ** 2).mean())
        assert r.slope == pytest.approx(slope, rel=1e-6)
        assert r.train_rmse == pytest.approx(error(~out), rel=1e-6) and r.valid_rmse == pytest.approx(error(out), rel=1e-6)
    means = mx.fold_means(got).first()
    assert means.folds == 4 and means.valid_rmse == pytest.approx(np.mean([r.valid_rmse for r in got.collect()]))
    w = {r.term: r.weight for r in sc.normal_solve(df, ["x", "z"], "y").collect()}
    want = np.linalg.lstsq(np.column_stack([x - 1e8, z + 1e7, np.ones(600)]), y - 5e8, rcond=None)[0]
    assert w["x"] == pytest.approx(want[0], rel=1e-6) and w["z"] == pytest.approx(want[1], rel=1e-6)
    flat = spark.createDataFrame([(i % 2, 1.0, float(i)) for i in range(6)], "fold bigint, x double, y double")
    assert [r.slope for r in mx.kfold_line_errors(flat, F.col("x"), F.col("y")).collect()] == [None, None]


def test_affine_scan():
    rng = np.random.default_rng(1)
    a, b = rng.uniform(0, 1.2, 100), rng.normal(size=100)
    a[[0, 30, 31, 70]] = 0.0
    b[40] = np.inf
    got, state, states = affine_scan(a, b), 0.0, []
    for x, y in zip(a, b):
        state = y if x == 0 else x * state + y
        states.append(state)
    assert np.allclose(got[1], states) and np.isfinite(got[1][70:]).all()


@pytest.mark.parametrize("rows", [3, 7, 65536])
def test_recurrence_over_levels_of_blocks(spark, rows):
    """Keys longer than blocks of blocks, nulls, a null key, an infinite value that stays in its key."""
    rng = np.random.default_rng(5)
    data = [(None if i % 5 == 0 else "k" if i % 5 < 4 else "m", i, None if i % 11 == 3 else float(rng.normal())) for i in range(160)]
    data += [("a", 0, float("inf")), ("a", 1, 1.0), ("b", 0, 2.0)]
    df = spark.createDataFrame(data, "k string, t int, v double").repartition(4)
    got = {(r.k, r.t): r.s for r in running_linear(df, ["k"], ["t"], {"s": "v"}, 0.8, 0.3, rows).collect()}
    states, want = {}, {}
    for k, t, v in sorted(data, key=lambda r: r[1]):
        s = states.get(k, 0.0)
        states[k] = s if v is None else 0.3 * v if k not in states else 0.8 * s + 0.3 * v
        want[k, t] = states[k]
    assert got.keys() == want.keys()
    assert all(got[i] == pytest.approx(want[i], abs=1e-12) for i in want)


class Spread:
    """Range of a column, over a state that is not a number of rows."""

    def init(self):
        return None

    def update(self, state, rows):
        return self.merge(state, (rows["x"].min(), rows["x"].max()))

    def merge(self, one, two):
        return one or two if one is None or two is None else (min(one[0], two[0]), max(one[1], two[1]))

    def finish(self, state):
        return None if state is None else float(state[1] - state[0])


@pytest.mark.parametrize("merged", [2, 256])
def test_user_metric_merges_states(spark, merged):
    rows = [("hot", float(i)) for i in range(900)] + [(None, 1.0), (None, 4.0), ("one", 2.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(12)
    got = {r.g: r.m for r in uc.metric(df, ["g"], ["x"], Spread(), "m", merged).collect()}
    assert got == {"hot": 899.0, None: 3.0, "one": 0.0}
    assert uc.metric(df, [], ["x"], Spread(), "m", merged).first().m == 899.0


def test_many_labels_need_no_cap(spark):
    n = 5000
    df = spark.range(3 * n).select((F.col("id") % 3).cast("string").alias("r"), F.when(F.col("id") > 4, F.format_string("l%05d", F.col("id") % n)).alias("c"), "id")
    wide = pf.crosstab(df, "r", "c", 1000)
    assert wide.count() == 3 * 6
    last = {r.r: (r.header, r.c0) for r in wide.filter("page = 5").collect()}
    assert last == {"0": ("null", 2), "1": ("null", 2), "2": ("null", 1)}
    cells = F.aggregate(F.array(*[F.coalesce(f"c{i}", F.lit(0)) for i in range(1000)]), F.lit(0).cast("bigint"), lambda a, x: a + x)
    assert wide.agg(F.sum(cells)).first()[0] == 3 * n
    index = ft.dummy_index(df, ["r", "c"])
    assert index.count() == 4 + n + 1
    made = ft.sparse_dummies(df, ["r", "c"], index, "id")
    name = {(r.column, r.value): r["index"] for r in index.collect()}
    got = {r.id: r.features for r in made.filter("id in (3, 4, 77)").collect()}
    assert got == {3: sorted([name["r", "0"], name["c", None]]), 4: sorted([name["r", "1"], name["c", None]]), 77: sorted([name["r", "2"], name["c", "l00077"]])}
    assert made.count() == 3 * n and made.filter("size(features) <> 2").count() == 0
    pages = sc.vocab_pages(df, "c", 2048)
    assert {r.page: len(r.vocab) for r in pages.collect()} == {0: 2048, 1: 2048, 2: 904}


def test_crosstab_of_nothing(spark):
    df = spark.createDataFrame([], "r string, c string")
    assert pf.crosstab(df, "r", "c", 2).count() == 0
    one = spark.createDataFrame([(None, "x"), ("a", None), (None, "x")], "r string, c string")
    got = {(r.r, r.page): (r.header, r.c0, r.c1) for r in pf.crosstab(one, "r", "c", 2).collect()}
    assert got == {(None, 0): ("x,null", 2, 0), ("a", 0): ("x,null", 0, 1)}
