"""Hard negatives against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparrowmill.llm import cover_tree, hard_negatives
from sparrowmill.llm.hard_negatives import mine

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def by_hand(rows, every):
    kept = []
    for vec_id, vector, label in rows:
        if label is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            kept.append((vec_id, [int(np.floor(256 * float(np.float32(x)))) for x in vector], label))
    out = []
    for at, (anchor, a, own) in enumerate(kept):
        if anchor is None or anchor % every:
            continue
        scored = [
            (sum(x * y for x, y in zip(a, v)), vec_id, label == own)
            for n, (vec_id, v, label) in enumerate(kept) if n != at and len(v) == len(a)
        ]
        scored.sort(key=lambda r: (-r[0], r[1] is None, r[1]))
        for score, positive, _ in [s for s in scored if s[2]][:5]:
            fits = [(s, i) for s, i, same in scored if not same and 30 * score <= 100 * s <= 90 * score][:10]
            out += [(anchor, positive, n + 1, i, score, s) for n, (s, i) in enumerate(fits)]
    return out


def clustered(n, size=12, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, size))
    points = centres[rng.integers(0, 20, n)] + 0.15 * rng.normal(size=(n, size))
    points[: n // 4] *= rng.uniform(0.05, 3, size=(n // 4, 1))
    points[n // 4: n // 4 + 40] = points[0]
    return [(i, [float(x) for x in p], int(rng.integers(0, 4))) for i, p in enumerate(points)]


def show(rows):
    return sorted(map(repr, map(tuple, rows)))


@pytest.mark.parametrize("block", [50, 4096])
def test_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(hard_negatives, "SAMPLE_ROWS", 200)
    rows = clustered(900)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert show(mine(df, F.col("vec_id") % 20 == 0).collect()) == show(by_hand(rows, 20))


def test_odd_rows(spark):
    rows = clustered(120, size=3)
    rows += [
        (1000, None, 1), (1020, [1.0, 2.0, None], 1), (1040, [1.0, float("nan"), 2.0], 1), (1060, [1.0, 1.0, 1.0], None),
        (1080, [float("inf"), 1.0, 1.0], 1), (1100, [0.0, 0.0, 0.0], 1), (None, [1.0, 1.0, 1.0], 1), (1120, [], 1), (1140, [], 2), (1141, [], 1),
        (1160, [1.0], 1), (1161, [2.0], 2), (1162, [0.5], 1), (1180, [3e38, 1.0, 0.0], 1), (1200, [-1e30, 5.0, 1e30], 2), (1220, [1e7, 1e7, 1e7], 3),
    ]
    rows += [(20, rows[20][1], rows[20][2]), rows[41]]
    extra = SCHEMA + ", id string, row int, anchor string, block double, kind int, query int"
    df = spark.createDataFrame([(*r, "i", 1, "a", 1.0, 1, 1) for r in rows], extra).repartition(4)
    got = mine(df, F.col("vec_id") % 20 == 0).collect()
    limit = cover_tree.LONG
    small = lambda found: [r for r in map(tuple, found) if r[0] not in (1180, 1200) and abs(r[4]) < limit]
    assert show(small(got)) == show(small(by_hand(rows, 20)))
    assert mine(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_tree_skips_nodes_outside_the_window():
    rows = np.array([np.floor(256 * np.array(v)) for _, v, _ in clustered(4000)])
    tree = cover_tree.CoverTree(rows)
    for node, children in enumerate(tree.children):
        if children is not None:
            assert len(children) > 1
    met = []

    def allowed(active, places):
        met.append(len(active) * len(places))
        return np.ones((len(active), len(places)), bool)

    queries = rows[:50]
    exact = (queries @ rows.T).astype(np.int64)
    high = np.percentile(exact, 95, axis=1).astype(np.int64)[:, None]
    query, _, place, score = tree.search(queries, high - 2000, high, allowed, 5)
    for q in range(50):
        order = sorted((-exact[q, p], p) for p in range(4000) if high[q, 0] - 2000 <= exact[q, p] <= high[q, 0])[:5]
        assert order == [(-s, p) for s, p in zip(score[query == q], place[query == q])]
    assert sum(met) < 50 * 4000 / 2


def test_large_numbers_are_exact():
    big = np.array([[2.0 ** 40, 1.0], [2.0 ** 31, 3.0]])
    assert cover_tree.inner(big, big).tolist() == [[cover_tree.LONG, cover_tree.LONG], [cover_tree.LONG, 2 ** 62]]
    near = np.array([[2.0 ** 30, 1.0]])
    assert cover_tree.inner(near, near)[0, 0] == 2 ** 60 + 1
