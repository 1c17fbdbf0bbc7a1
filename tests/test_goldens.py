"""Worked examples with values known by hand."""

import math

import pytest
from pyspark.sql import functions as F

from sparrowmill.functions import arrays as ar
from sparrowmill.functions import text as tx
from sparrowmill.operators import corpus as cp
from sparrowmill.operators import features as fe
from sparrowmill.operators import metrics as mx
from sparrowmill.operators import profile as pf
from sparrowmill.operators import relational as rl
from sparrowmill.operators import series as sr


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def arr(*xs):
    return F.array(*[F.lit(float(x)) for x in xs])


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame([(2.5, 3.0), (0.0, -0.5), (2.0, 2.0), (8.0, 7.0)], "p double, y double")


def test_regression_losses(pairs):
    p, y = F.col("p"), F.col("y")
    row = pairs.agg(mx.mse(p, y), mx.mae(p, y), F.avg(mx.smooth_l1_row(p, y))).first()
    assert row[0] == pytest.approx(0.375) and row[1] == pytest.approx(0.5) and row[2] == pytest.approx(0.1875)


def test_bce_from_logits(spark):
    df = spark.createDataFrame([(2.0, 1), (-1.0, 0), (0.0, 1), (4.0, 1)], "z double, y int")
    assert df.agg(F.avg(mx.bce_logits_row(F.col("z"), F.col("y")))).first()[0] == pytest.approx(0.287872, abs=1e-6)


def test_focal_alpha_is_optional(spark):
    df = spark.createDataFrame([(0.0, 1)], "z double, y int")
    plain = df.select(mx.focal_row(F.col("z"), F.col("y"))).first()[0]
    assert plain == pytest.approx(0.25 * math.log(2), rel=1e-6)
    assert df.select(mx.focal_row(F.col("z"), F.col("y"), alpha=0.25)).first()[0] == pytest.approx(0.75 * plain)


def test_cosine_embedding(spark):
    a = arr(1, 0)
    rows = [(arr(1, 0), 1), (arr(0, 1), -1), (arr(1, 1), -1)]
    got = [one(spark, v=mx.cosine_embedding_row(a, b, F.lit(y), 0.5)).v for b, y in rows]
    assert got == pytest.approx([0, 0, 0.207107], abs=1e-6)


def test_masked_loss(spark):
    uniform = [math.log(10)] * 4
    got = [one(spark, v=mx.masked_mean(arr(*uniform), F.lit(n))).v for n in (4, 3, 0)]
    assert got == pytest.approx([2.302585, 1.726939, 0], abs=1e-6)
    assert one(spark, v=mx.masked_mean(arr(*uniform), F.lit(3), "valid")).v == pytest.approx(math.log(10))


def test_sequence_mask(spark):
    assert one(spark, v=ar.mask_after(arr(1, 2, 3), F.lit(1), 0.0)).v == [1, 0, 0]
    assert one(spark, v=ar.mask_after(arr(4, 5, 6), F.lit(2), 0.0)).v == [4, 5, 0]


def test_masked_softmax(spark):
    got = one(spark, v=ar.masked_softmax(arr(1, 1, 9), F.lit(2))).v
    assert got == pytest.approx([0.5, 0.5, 0])


def test_binary_metrics(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (0, 1)], "p int, t int")
    m = df.agg(*mx.binary_metrics(F.col("p"), F.col("t"))).first()
    assert m.accuracy == pytest.approx(2 / 3) and m.f1 == pytest.approx(2 / 3)


def test_metrics_of_an_empty_class(spark):
    df = spark.createDataFrame([(0, 0)], "p int, t int")
    assert df.agg(*mx.binary_metrics(F.col("p"), F.col("t"))).first().precision is None


def test_mean_imputation(spark):
    df = spark.createDataFrame([(1, None), (2, 2.0), (3, 4.0), (4, None)], "i int, rooms double")
    got = fe.impute_mean(df, ["rooms"]).orderBy("i").select("rooms").collect()
    assert [r[0] for r in got] == [3, 2, 4, 3]


def test_dummies_add_a_null_column_always(spark):
    df = spark.createDataFrame([("Pave",), ("Pave",)], "alley string")
    assert fe.get_dummies(df, ["alley"]).columns == ["alley_Pave", "alley_nan"]
    holed = spark.createDataFrame([("Pave",), (None,)], "alley string")
    assert sorted(map(tuple, fe.get_dummies(holed, ["alley"]).collect())) == [(0, 1), (1, 0)]


def test_category_limit(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError):
        fe.categories(df, "c", limit=10)


def test_standardize_constant_column(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (None,)], "x double")
    assert [r[0] for r in fe.standardize(df, ["x"]).collect()] == [0, 0, 0]


def test_transpose_and_norms(spark):
    chw = arr(*range(12))
    got = one(spark, v=ar.transpose(chw, (3, 2, 2), (1, 2, 0))).v
    assert got == [0, 4, 8, 1, 5, 9, 2, 6, 10, 3, 7, 11]
    assert one(spark, v=ar.norm(arr(3, 0, -4), 2)).v == pytest.approx(5)
    assert one(spark, v=ar.norm(arr(3, 0, -4), 0)).v == 2
    assert one(spark, v=ar.norm(arr(3, 0, -4), float("inf"))).v == 4


def test_text_functions(spark):
    r = one(
        spark,
        a=tx.snake_case(F.lit("  Hello,  World--Again! ")), b=tx.space_punctuation(F.lit("Go.Now !  a,b")),
        c=tx.ellipsis(F.lit("abcdef"), 3), d=tx.ellipsis(F.lit("abc"), 3), e=tx.human_size(F.lit(68_200_000_000.0)),
        f=tx.human_size(F.lit(1500.0)), g=tx.split_name(F.lit("validation-00001-of-00002.parquet")), h=tx.split_name(F.lit("part.parquet")),
        i=tx.human_size(F.lit(1.5e15)),
    )
    assert (r.a, r.b, r.c, r.d) == ("hello_world_again", "go .now !  a ,b", "abc...", "abc")
    assert (r.e, r.f, r.g, r.h, r.i) == ("68.20 GB", "1.50 KB", "val", "part", "1500.00 TB")


def test_no_break_spaces_become_spaces(spark):
    assert one(spark, v=tx.space_punctuation(F.lit("Oui\u202f!\u00a0non,"))).v == "oui ! non ,"


def test_decode_replaces_invalid_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"ab\xffc"),)], "raw binary")
    assert df.select(tx.decode_utf8(F.col("raw"))).first()[0] == "ab�c"


def test_windows_shift_targets_by_one(spark):
    coded = spark.createDataFrame([(1, list(range(30)))], "doc_id bigint, ids array<bigint>")
    rows = cp.random_windows(coded, "doc_id", 5, 2, 3).collect()
    assert len(rows) in (4, 2) and all([x + 1 for x in r.x] == r.y for r in rows)
    strips = cp.strip_windows(coded, "doc_id", 6, 2, 3).collect()
    assert strips and all([x + 1 for x in r.x] == r.y for r in strips)


def test_two_way_table(spark):
    cells = [(r, c) for r in (0, 1) for c in range(3) for _ in range(r * 3 + c)]
    got = pf.crosstab(spark.createDataFrame(cells, "r int, c int"), "r", "c", 20).orderBy("r").collect()
    assert [[r.c0, r.c1, r.c2] for r in got] == [[0, 1, 2], [3, 4, 5]]


def test_prefix_alignment(spark):
    model = spark.createDataFrame([("a",), ("b",)], "k string")
    loaded = spark.createDataFrame([("module.a",), ("module.c",), ("x",)], "k string")
    got = rl.key_report(rl.align_prefix(loaded, model, "k", "module."), model, "k").collect()
    assert sorted(map(tuple, got)) == [("b", "missing"), ("c", "unexpected"), ("x", "unexpected")]


def test_missing_split_is_an_error(spark):
    with pytest.raises(ValueError):
        rl.split_rows(spark.range(3), None, "id")


def test_build_schema_rejects_unknown_types():
    with pytest.raises(ValueError):
        pf.build_schema({"a": "complex64"})


def test_fixed_length_is_checked(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "v array<double>")
    with pytest.raises(Exception, match="must have 2 elements"):
        pf.apply_schema(df, {"v": "float32_2"}).collect()


def test_pair_encoding_cuts_the_longer_side(spark):
    ids = lambda *x: F.array(*[F.lit(i).cast("bigint") for i in x])
    r = one(spark, **cp.encode_pair(ids(10, 11, 12, 13, 14), ids(20, 21), 8, 2, 3))
    assert r.input_ids == [2, 10, 11, 12, 3, 20, 21, 3]
    assert r.token_type_ids == [0, 0, 0, 0, 0, 1, 1, 1] and r.special_tokens_mask == [1, 0, 0, 0, 1, 0, 0, 1]
    r = one(spark, **cp.encode_pair(ids(10), ids(20), 8, 2, 3))
    assert r.input_ids == [2, 10, 3, 20, 3, 0, 0, 0] and r.length == 5 and r.attention_mask == [1] * 5 + [0] * 3


def test_block_pool_counts_cells(spark):
    df = spark.createDataFrame([(0, i, float(i)) for i in range(7)], "k int, t int, v double")
    got = sr.block_pool(df, ["k"], ["t"], "v", 3, 3).orderBy("cell").collect()
    assert [(r.cell, r.pool_max) for r in got] == [(0, 2), (1, 5)]
