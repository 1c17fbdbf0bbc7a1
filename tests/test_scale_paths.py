"""The ways taken for large inputs, forced on small ones, and the greedy operators, against brute force."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparrowmill.functions import text as tx
from sparrowmill.operators import boxes as bx
from sparrowmill.operators import corpus as cp
from sparrowmill.operators import metrics as mx
from sparrowmill.operators import profile as pf
from sparrowmill.operators import vectors as vx
from sparrowmill.plans import load_all
from sparrowmill.session import scratch_path
from sparrowmill.sources import files as fs


load_all()


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(1)
    texts = [" ".join("the" if rng.random() < 0.4 else "w" + "abcdefghij"[rng.integers(10)] for _ in range(rng.integers(0, 30))) for _ in range(60)]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


def test_encode_and_decode_by_join_equal_map_side(docs):
    w = tx.words(F.col("text"))
    vocab = cp.build_vocab(docs, w)
    small = {r.doc_id: r.ids for r in cp.encode_rows(docs, w, vocab, "doc_id").collect()}
    large = {r.doc_id: r.ids for r in cp.encode_rows(docs, w, vocab, "doc_id", limit=0).collect()}
    assert small == large and len(small) == 60
    coded = cp.encode_rows(docs, w, vocab, "doc_id")
    text = {r.doc_id: (r.text or "").split() for r in docs.collect()}
    for limit in (0, 10**6):
        assert {r.doc_id: r.tokens for r in cp.decode_rows(coded, vocab, "doc_id", limit).collect()} == text


def test_only_distinct_tokens_of_a_block_meet_a_large_vocabulary(spark, docs):
    w = tx.words(F.col("text"))
    vocab = cp.build_vocab(docs, w)
    few = docs.coalesce(2)
    total = few.select(F.sum(F.size(w))).first()[0]
    local = cp.number_in_blocks(few.select("doc_id", w.alias("tokens")), "string", 100)
    words = local.filter("_words is not null").select("_block", F.explode("_words").alias("word"))
    blocks = local.select("_block").distinct().count()
    assert words.count() == words.distinct().count() <= 11 * blocks < total / 3 and blocks >= total // 100
    rows = local.filter("_codes is not null").groupBy("_block").agg(F.sum(F.size("_codes")).alias("n"))
    assert rows.agg(F.max("n")).first()[0] <= 100
    small = {r.doc_id: r.ids for r in cp.encode_rows(few, w, vocab, "doc_id").collect()}
    coded = cp.encode_rows(few, w, vocab, "doc_id", limit=0, block=100)
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "collect_list" not in plan
    assert {r.doc_id: r.ids for r in coded.collect()} == small
    text = {r.doc_id: (r.text or "").split() for r in docs.collect()}
    assert {r.doc_id: r.tokens for r in cp.decode_rows(coded, vocab, "doc_id", 0, block=7).collect()} == text


def test_unknown_tokens(spark, docs):
    w = tx.words(F.col("text"))
    vocab = cp.build_vocab(docs, w).filter("token <> 'the'")
    for limit in (0, 10**6):
        ids = cp.encode_rows(docs, w, vocab, "doc_id", unk=77, limit=limit).select(F.explode("ids").alias("i"))
        assert ids.filter("i = 77").count() == sum(r.text.split().count("the") for r in docs.collect())


def test_bigram_model_by_join_equals_broadcast(docs):
    w = tx.words(F.col("text"))
    bi, uni = cp.ngram_counts(docs, w, 2), cp.ngram_counts(docs, w, 1)
    a = sorted(map(tuple, cp.bigram_probabilities(bi, uni, 1.0).collect()))
    b = sorted(map(tuple, cp.bigram_probabilities(bi, uni, 1.0, limit=0).collect()))
    assert a == b and len(a) > 10


def test_word_pairs_give_words_and_bigrams(docs):
    """One reading of the texts: the counts of both, also for rows of one word and of none."""
    w = tx.words(F.col("text"))
    counts = cp.word_pairs(docs, w)
    rows = lambda df: sorted(map(tuple, df.select("gram", "n").collect()))
    assert rows(cp.words_of_pairs(counts)) == rows(cp.ngram_counts(docs, w, 1))
    assert rows(cp.bigrams_of_pairs(counts)) == rows(cp.ngram_counts(docs, w, 2))


def test_sequence_scores_of_blocks(spark, docs):
    """A bigram of a block meets the model once; rows of one key add up, whatever the blocks."""
    w = tx.words(F.col("text"))
    twice = docs.withColumn("doc_id", F.col("doc_id") % 7).coalesce(2)
    counts = cp.word_pairs(twice, w)
    model = cp.bigram_probabilities(cp.bigrams_of_pairs(counts), cp.words_of_pairs(counts), 2.0)
    p = {r.gram: r.p_smooth for r in model.collect()}
    want = {}
    for r in twice.collect():
        t = (r.text or "").split()
        want.setdefault(r.doc_id, []).extend(math.log(p[f"{a} {b}"]) for a, b in zip(t, t[1:]))
    for block in (20, 10**6):
        scored = cp.sequence_scores(twice, cp.ngram_array(w, 2), model, block=block)
        got = {r.doc_id: (r.len, round(r.score, 9)) for r in scored.collect()}
        assert got == {k: (len(v), round(sum(v) / len(v) ** 0.75, 9)) for k, v in want.items()}
    assert "FlatMapCoGroupsInArrow" in scored._jdf.queryExecution().executedPlan().toString()


def test_ranks_of_counts_need_no_sorted_items(docs):
    from sparrowmill.operators import series as sr

    counts = cp.ngram_counts(docs, tx.words(F.col("text")), 2)
    want = sr.rank_frequency(counts)
    for rows in (3, 10**5):
        got = sr.rank_counts(counts, rows)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.drop("gram").collect()))
    a, b = sr.zipf_exponent(got).first(), sr.zipf_exponent(want).first()
    assert math.isclose(a.exponent, b.exponent, rel_tol=1e-9) and a.n_items == b.n_items


def test_perplexity_by_join_equals_packed(docs):
    grouped = docs.withColumn("lang", (F.col("doc_id") % 3).cast("string"))
    w = tx.words(F.col("text"))
    a, b = ({r.lang: (r.n, round(r.perplexity, 9)) for r in cp.perplexity(grouped, w, "lang", 1.0, m).collect()} for m in (10, 1))
    assert a == b and len(a) == 3


def test_softmax_fit_beats_the_majority(spark):
    from sparrowmill.plans.registry import QUERIES

    row = QUERIES["E30_softmax_fit"](spark, "/root/testdata/sf0.001").first()
    assert row.accuracy > row.majority


def test_normal_solve(spark):
    from sparrowmill.functions.scalars import normal_solve

    rng = np.random.default_rng(3)
    x = rng.normal(size=(50, 2))
    rows = [(float(a), float(b), float(2 * a - 3.4 * b + 4.2)) for a, b in x]
    got = {r.term: r.weight for r in normal_solve(spark.createDataFrame(rows, "a double, b double, y double"), ["a", "b"], "y").collect()}
    assert got == pytest.approx({"bias": 4.2, "a": 2.0, "b": -3.4})


def make_boxes(seed, n, crowd):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x, y = rng.random(2) * 0.7
        w, h = 10 ** rng.uniform(-2.5, -0.5, 2)
        if i % 3 == 0 and crowd:  # a third of all boxes in one image, near one place
            x, y, w, h = 0.3 + rng.normal(0, 0.01), 0.3 + rng.normal(0, 0.01), 0.1, 0.12
        x, y, w, h = float(x), float(y), float(w), float(h)
        image = 0 if i % 3 == 0 else int(rng.integers(1, 4))
        rows.append((i, image, int(rng.integers(0, 2)), x, y, x + w, y + h, float(rng.integers(0, 50)) / 50))
    return rows


BOX = "box_id bigint, image int, cls int, x1 double, y1 double, x2 double, y2 double, score double"


def iou(a, b):
    w = max(min(a[5], b[5]) - max(a[3], b[3]), 0)
    h = max(min(a[6], b[6]) - max(a[4], b[4]), 0)
    inter = w * h
    return inter / ((a[5] - a[3]) * (a[6] - a[4]) + (b[5] - b[3]) * (b[6] - b[4]) - inter)


@pytest.mark.parametrize("thr", [0.1, 0.3, 0.5, 0.7, 0.9])
def test_overlap_join_finds_every_pair(spark, thr):
    rows = make_boxes(2, 240, True)
    df = spark.createDataFrame(rows, BOX)
    got = sorted((r.a_id, r.b_id) for r in bx.overlap_join(df, df, thr).collect())
    want = sorted((a[0], b[0]) for a in rows for b in rows if a[1] == b[1] and iou(a, b) > thr)
    assert got == want


def test_touching_pairs_find_every_pair(spark):
    rows = make_boxes(3, 150, True)
    df = spark.createDataFrame(rows, BOX)
    got = sorted((r.a_id, r.b_id) for r in bx.touching_pairs(df, df, per_cell=4).collect())
    want = sorted((a[0], b[0]) for a in rows for b in rows if a[1] == b[1] and iou(a, b) > 0)
    assert got == want


def test_suppression_equals_the_greedy_loop(spark):
    rows = make_boxes(4, 200, True)
    kept = {r.box_id for r in bx.suppress(spark.createDataFrame(rows, BOX), 0.4).collect()}
    want = []
    for b in sorted(rows, key=lambda r: (-r[7], r[0])):
        if all(k[1] != b[1] or k[2] != b[2] or iou(k, b) <= 0.4 for k in want):
            want.append(b)
    assert kept == {b[0] for b in want}


def assign_loop(anchors, truths, thr):
    """The pair with the largest overlap first, also if that is none, until every truth has its anchor."""
    pairs = sorted(((iou(a, b), -a[0], -b[0]) for a in anchors for b in truths if a[1] == b[1]), reverse=True)
    used_a, used_b, want = {}, set(), {}
    for v, na, nb in pairs:
        if -na not in used_a and -nb not in used_b:
            used_a[-na] = -nb
            used_b.add(-nb)
    for a in anchors:
        best = max(((v, nb) for v, na, nb in pairs if -na == a[0]), default=(0, 0))
        if a[0] in used_a:
            want[a[0]] = used_a[a[0]], "greedy"
        else:
            want[a[0]] = (-best[1], "threshold") if best[0] >= thr else (None, "background")
    return want


@pytest.mark.parametrize("rows,scale", [(1, 1.0), (2, 1.0), (256, 640.0)])
def test_assignment_with_short_lists_and_pixels(spark, rows, scale):
    """Lists that are spent and refilled, truths that overlap nothing, more truths than anchors, pixels."""
    made = [(*r[:3], *[x * scale for x in r[3:7]], r[7]) for r in make_boxes(16, 140, True)]
    far = [(500 + i, 2, 0, 2.0 * scale, 2.0 * scale, 2.1 * scale, 2.1 * scale, 0.5) for i in range(4)]
    lonely = [(600, 9, 0, 0.0, 0.0, scale, scale, 0.5), (601, 9, 0, 0.0, 0.0, scale, scale, 0.5), (602, 9, 0, 0.1, 0.1, scale, scale, 0.5)]
    anchors, truths = made[:90] + [(700, 9, 0, 0.0, 0.0, scale, 0.9 * scale, 0.5)], made[90:] + far + lonely
    got = bx.assign(spark.createDataFrame(anchors, BOX), spark.createDataFrame(truths, BOX), 0.3, rows).collect()
    assert {r.box_id: (r.truth_id, r.stage) for r in got} == assign_loop(anchors, truths, 0.3)


def test_assignment_of_the_worked_example(spark):
    box = lambda i, cls, c: (i, 0, cls, *map(float, c), 1.0)
    truths = [box(0, 0, (0.1, 0.08, 0.52, 0.92)), box(1, 1, (0.55, 0.2, 0.9, 0.88))]
    corners = [(0, 0.1, 0.2, 0.3), (0.15, 0.2, 0.4, 0.4), (0.63, 0.05, 0.88, 0.98), (0.66, 0.45, 0.8, 0.8), (0.57, 0.3, 0.92, 0.9)]
    got = bx.assign(spark.createDataFrame([box(i, 0, c) for i, c in enumerate(corners)], BOX), spark.createDataFrame(truths, BOX), 0.5)
    assert {r.box_id: r.truth_id for r in got.collect()} == {0: None, 1: 0, 2: 1, 3: None, 4: 1}


def test_a_chain_takes_a_round_per_tile_not_per_link(spark, monkeypatch):
    n = 1000
    rows = [(i, 0, 0, i * 0.4, 0.0, i * 0.4 + 1.0, 1.0, 1.0 - i / n) for i in range(n)]
    rounds = []
    real = bx.materialize
    monkeypatch.setattr(bx, "materialize", lambda df: rounds.append(df.columns) or real(df))
    kept = {r.box_id for r in bx.suppress(spark.createDataFrame(rows, BOX), 0.4, tile_boxes=250).collect()}
    assert kept == set(range(0, n, 2))  # every box overlaps the next by 0.43, the one after by 0.11
    assert sum("kept" in c for c in rounds) <= 6


def test_assignment_equals_the_greedy_loop(spark):
    rows = make_boxes(6, 160, True)
    anchors, truths = rows[:130], rows[130:]
    got = bx.assign(spark.createDataFrame(anchors, BOX), spark.createDataFrame(truths, BOX), 0.3).collect()
    assert {r.box_id: (r.truth_id, r.stage) for r in got} == assign_loop(anchors, truths, 0.3)


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_nearest_equals_brute_force(spark, metric, monkeypatch):
    for name, value in (("BLOCK_ROWS", 16), ("SCAN_ROWS", 5), ("SCAN_QUERIES", 3)):  # several blocks, chunks and runs
        monkeypatch.setattr(vx, name, value)
    rng = np.random.default_rng(8)
    base, q = rng.normal(size=(80, 5)), rng.normal(size=(7, 5))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "id bigint, v array<double>")
    qs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "query_id bigint, vec array<double>")
    got = {(r.query_id, r["rank"]): r.id for r in vx.nearest(df, qs, "id", "v", 4, metric).collect()}
    if metric == "cosine":
        d = -(q @ base.T) / np.linalg.norm(q, axis=1)[:, None] / np.linalg.norm(base, axis=1)[None]
    else:
        d = np.linalg.norm(q[:, None] - base[None], axis=2)
    want = {(i, k + 1): j for i in range(7) for k, j in enumerate(np.argsort(d[i])[:4])}
    assert got == want


def test_frechet_and_covariance(spark):
    rng = np.random.default_rng(9)
    a, b = rng.normal(size=(60, 3)), rng.normal(1, 2, size=(50, 3))
    df = lambda m: spark.createDataFrame([(v.tolist(),) for v in m], "v array<double>").repartition(3)
    cov = {(r.i, r.j): r.cov for r in mx.covariance(df(a), F.col("v")).collect()}
    want = np.cov(a, rowvar=False)
    assert all(cov[i, j] == pytest.approx(want[i, j]) for i in range(3) for j in range(i, 3))
    s1, s2 = np.cov(a, rowvar=False), np.cov(b, rowvar=False)
    trace = np.sqrt(np.linalg.eigvals(s1 @ s2).real).sum()
    d = ((a.mean(0) - b.mean(0)) ** 2).sum() + np.trace(s1) + np.trace(s2) - 2 * trace
    assert mx.frechet(df(a), df(b), F.col("v")) == pytest.approx(d)
    assert mx.frechet(df(a), df(a), F.col("v")) == pytest.approx(0, abs=1e-9)


def test_shards_keep_order_and_size(spark):
    df = spark.range(103).select((F.lit(1000) - F.col("id")).alias("k")).repartition(4)
    path = scratch_path(spark, "t-shards")
    fs.write_shards(df, path, ["k"], 25)
    back = spark.read.parquet(f"{path}/data/split=all")
    sizes = {r.shard_id: (r.n, r.lo, r.hi) for r in back.groupBy("shard_id").agg(F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).collect()}
    assert [sizes[i][0] for i in range(5)] == [25, 25, 25, 25, 3]
    assert all(sizes[i][2] < sizes[i + 1][1] for i in range(4))


def test_split_by_file_prefix_and_missing_split(spark):
    path = scratch_path(spark, "t-split")
    spark.range(5).coalesce(1).write.parquet(f"{path}/data/train-00000-of-00001.parquet")
    fs.write_split(spark.range(3), path, "val")
    assert fs.read_split(spark, path, "val").count() == 3
    with pytest.raises(FileNotFoundError):
        fs.read_split(spark, path, "dev")


def test_file_prefix_split(spark, tmp_path):
    spark.range(4).coalesce(1).write.parquet(str(tmp_path / "w"))
    part = next(p for p in os.listdir(tmp_path / "w") if p.endswith(".parquet"))
    os.makedirs(tmp_path / "d" / "data")
    (tmp_path / "d" / "data" / "train-00000-of-00001.parquet").write_bytes((tmp_path / "w" / part).read_bytes())
    got = fs.read_split(spark, str(tmp_path / "d"), "train", transform=lambda df: df.withColumn("two", F.col("id") * 2))
    assert got.count() == 4 and got.first().shard == "train-00000-of-00001.parquet" and "two" in got.columns
    inv = {r.split: r.num_shards for r in fs.shard_inventory(spark, str(tmp_path / "d")).collect()}
    assert inv == {"train": 1, "total": 1}


def test_write_guard_keeps_what_is_there(spark):
    path = scratch_path(spark, "t-guard")
    fs.write_guarded(spark.range(3), path)
    with pytest.raises(FileExistsError):
        fs.write_guarded(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3
    fs.write_guarded(spark.range(9), path, overwrite=True)
    assert spark.read.parquet(path).count() == 9


def test_pairs_cap_at_n_lines(spark):
    lines = spark.createDataFrame([(0, "a\tb"), (1, "c"), (2, "d\te"), (3, "f\tg\th"), (4, "i\tj")], "n int, value string")
    assert [r.source for r in fs.read_pairs(lines, ["n"], 3).orderBy("n").collect()] == ["a", "d"]
    assert fs.read_pairs(lines, ["n"]).count() == 3


def test_reconcile_sees_every_difference(spark):
    a = spark.createDataFrame([(1, 1, [1.0, 2.0]), (2, 2, [1.0, 2.0]), (3, 3, [0.0, 0.0])], "k int, d int, v array<double>")
    b = spark.createDataFrame([(1, 1, [1.0, 2.0 + 1e-8]), (2, 5, [1.0, 2.1]), (4, 3, [0.0, 0.0])], "k int, d int, v array<double>")
    r = pf.reconcile(a, b, "k", ["d"], ["v"]).first()
    assert (r.rows_a, r.rows_b, r.only_a, r.only_b, r.discrete_diff, r.array_diff) == (3, 3, 1, 1, 1, 1)


def test_repeated_keys_stay_rows_of_their_own(docs):
    w = tx.words(F.col("text"))
    vocab = cp.build_vocab(docs, w)
    twice = docs.union(docs).withColumn("doc_id", F.lit(1))
    made = [sorted(map(tuple, (r.ids or [] for r in cp.encode_rows(twice, w, vocab, "doc_id", limit=n).collect()))) for n in (0, 10**6)]
    assert made[0] == made[1] and len(made[0]) == 120
    coded = cp.encode_rows(twice, w, vocab, "doc_id")
    assert cp.decode_rows(coded, vocab, "doc_id", 0).count() == 120


def test_zero_vectors_take_no_part(spark):
    from sparrowmill.operators.vectors import nearest

    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 1.0])], "id bigint, v array<double>")
    queries = spark.createDataFrame([(7, [1.0, 0.1])], "query_id bigint, vec array<double>")
    assert [r.id for r in nearest(rows, queries, "id", "v", 5).orderBy("rank").collect()] == [1, 3]


def test_columns_of_unequal_length_lose_no_row(spark):
    from sparrowmill.operators.relational import hstack
    from sparrowmill.sources.manifest import assemble

    a, b = spark.range(3).toDF("a"), spark.range(1).toDF("b")
    assert hstack(a, b, ["a"], ["b"]).count() == 3 and hstack(b, a, ["b"], ["a"]).count() == 3
    assert assemble({"a": (a, ["a"]), "b": (b, ["b"])}).filter("b is null").count() == 2


def test_files_with_one_name_are_two_files(spark, tmp_path):
    from sparrowmill.sources.files import read_lines

    for d, text in (("d=1", "a\nb\n"), ("d=2", "c\nd\n")):
        (tmp_path / d).mkdir()
        (tmp_path / d / "part-0.txt").write_text(text)
    got = sorted((r.value, r.line_no) for r in read_lines(spark, str(tmp_path)).collect())
    assert got == [("a", 0), ("b", 1), ("c", 0), ("d", 1)]


def test_covariance_far_from_zero(spark):
    import numpy as np

    from sparrowmill.operators.metrics import covariance

    x = 1e8 + np.random.default_rng(0).normal(size=(2000, 2)) * [3.0, 2.0]
    df = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>")
    want = np.cov((x - 1e8).T)
    for r in covariance(df, F.col("v")).collect():
        assert abs(r["cov"] - want[r["i"], r["j"]]) < 1e-6 and abs(r["mean_i"] - x[:, r["i"]].mean()) < 1e-6


def test_grams_are_counted_in_as_many_tasks_as_the_texts_need(spark):
    from sparrowmill.operators import user_code

    texts = spark.createDataFrame([(f"w{'abcdefg'[i % 7]} same words again",) for i in range(2000)] + [(None,)], "text string")
    parts = user_code.text_parts(texts, "text", size=1000)
    assert parts == 1 + 2000 * 19 // 1000
    got = user_code.count_values(texts, "text", parts, held=300)
    assert got.rdd.getNumPartitions() == parts
    want = texts.groupBy("text").count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert user_code.count_values(texts.limit(0), "text", 3).isEmpty()
