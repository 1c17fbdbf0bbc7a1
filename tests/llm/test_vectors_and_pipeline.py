"""Vector search against brute force, and the stages of the pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparrowmill.llm import hamming_search
from sparrowmill.llm.components import components

SF = "/root/testdata/sf0.001"


def brute(rows, k):
    out = {}
    for q, v in rows:
        if q % 20:
            continue
        scored = sorted(((-float(np.dot(v, w)), i) for i, w in rows if i != q))[:k]
        out[q] = [i for _, i in scored]
    return out


@pytest.mark.parametrize("dims,n", [(8, 300), (3, 15)])
def test_nearest(spark, dims, n):
    rng = np.random.default_rng(dims)
    rows = [(i, (rng.normal(size=dims) * rng.uniform(0.5, 2)).astype(np.float32)) for i in range(n)]
    bad = [(1000, None), (1001, [0.0] * dims), (1002, [float("nan")] * dims), (1003, [None] * dims), (1004, [1.0]), (None, [1.0] * dims)]
    df = spark.createDataFrame([(i, [float(x) for x in v], "x") for i, v in rows] + [(i, v, "x") for i, v in bad], "vec_id bigint, embedding array<float>, score string")
    got = hamming_search.nearest(df, F.col("vec_id") % 20 == 0, k=20).collect()
    want = brute([(i, v.astype(float)) for i, v in rows], 20)
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append(r.vec_id)
    assert set(by) == set(want) and all(len(by[q]) == len(want[q]) for q in want)
    assert np.mean([len(set(by[q]) & set(want[q])) / len(want[q]) for q in want]) >= 0.9


def test_nearest_with_ties_and_repeated_vectors(spark):
    rows = [(i, [1.0, 0.5]) for i in range(50)] + [(60, [0.5, 1.0]), (60, [0.5, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = [r.vec_id for r in hamming_search.nearest(df, F.col("vec_id") == 0, k=5).orderBy("rank").collect()]
    assert got == [1, 2, 3, 4, 5]
    assert hamming_search.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_nearest_searches_each_length(spark):
    """One stray longer vector takes nothing away, and shorter ones have neighbours of their own."""
    rng = np.random.default_rng(6)
    of = {8: range(0, 60), 3: range(100, 125), 9: range(201, 202)}
    rows = [(i, [float(x) for x in rng.normal(size=d)]) for d, ids in of.items() for i in ids]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {}
    for r in hamming_search.nearest(df, F.col("vec_id") % 20 == 0, k=100).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = {}
    for ids in of.values():
        want |= brute([(i, np.array(v)) for i, v in rows if i in ids], 100)
    assert got == want and len(want) == 5


def test_substring_radii_cover_the_radius():
    rng = np.random.default_rng(1)
    for radius in (0, 3, 9, 27, 64):
        limits = hamming_search.substring_radii(radius)
        for _ in range(500):
            parts = rng.multinomial(rng.integers(0, radius + 1), [0.25] * 4)
            assert any(p <= r for p, r in zip(parts, limits))


def test_components(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (101, 101), (200, 201)]
    got = dict(map(tuple, components(spark.createDataFrame(path, "a bigint, b bigint")).collect()))
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 60")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [r.doc_id for r in docs.select("doc_id").collect()]
        made = stage(spark, docs, SF)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert made.columns == docs.columns
        made.write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
        after = [r.doc_id for r in docs.select("doc_id").collect()]
        assert set(after) <= set(before)
        if name == "exact dedup":
            assert len(after) == len({" ".join((texts[i] or "").replace("\t", " ").split(" ")) for i in before})
        if name == "encoding":
            assert sorted(after) == sorted(before)


def test_stages_decide_by_row(spark, tmp_path):
    """Null and repeated ids: a row goes or stays for its own text."""
    base = " ".join(f"tok{i}" for i in range(60))
    near = base.replace("tok30", "other")
    rows = [(5, base), (None, base), (None, base), (7, base), (7, "a text of its own"), (9, "twice the same"), (9, "twice the same"),
            (None, "only null"), (None, "only null"), (8, near), (None, near), (8, "another text"), (None, None), (3, "")]
    rows += [(None, f"more text {i}") for i in range(30)]
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, t, "s" if n % 3 else None) for n, (i, t) in enumerate(rows)], "doc_id bigint, text string, source string").repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    texts = lambda df: sorted((str(r.doc_id), r.text or "") for r in df.collect())
    firsts = {}
    for i, t in rows:
        firsts.setdefault(t or "", []).append((i is None, i or 0))
    want = sorted((str(None if none else i), t) for t, (none, i) in ((t, min(ids)) for t, ids in firsts.items()))
    once = corpus_pipeline.drop_copies(spark, docs, SF)
    assert texts(once) == want
    once.write.parquet(str(tmp_path / "once"))
    once = spark.read.parquet(str(tmp_path / "once"))
    assert texts(corpus_pipeline.drop_near_copies(spark, once, SF)) == [x for x in want if x[1] != near]
    mixed = corpus_pipeline.mix(spark, docs, SF).groupBy("doc_id", "text").count().collect()
    there = {(i, t): sum(1 for x in rows if x == (i, t)) for i, t in rows}
    assert mixed and all(r["count"] <= 3 * there[r.doc_id, r.text] for r in mixed)
