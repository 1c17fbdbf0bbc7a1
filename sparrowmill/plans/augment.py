"""Group M: seeded augmentation. Embeddings are read as arrays of 4 channels, 4 rows and 4 columns."""

from pyspark.sql import functions as F

from sparrowmill.functions import arrays as ar
from sparrowmill.operators import augment as op
from sparrowmill.operators.relational import gather
from sparrowmill.plans.fixtures import SCHEDULE_SQL, STEP_SQL, step_of
from sparrowmill.plans.registry import list6, normal_sql, query, rand_sql
from sparrowmill.tables import table

DIMS = (4, 4, 4)
SEED = 7
BASE = "s0 as (select vec_id, cast(embedding as double[]) as v from embeddings)"


def r_sql(tag):
    return rand_sql("vec_id", seed=f"{SEED}{tag}")


def draw_sql(tag, n):
    return f"cast(floor({r_sql(tag)} * {n}) as int)"


BRIGHT = f"list_transform(v, lambda x: x + ({r_sql('b')} - 0.5))"
_MEANS = "list_transform(range(1, 17), lambda p: (v[p] + v[p + 16] + v[p + 32] + v[p + 48]) / 4)"
SATURATE = f"list_transform(v, lambda x, i: (x - ms[(i - 1) % 16 + 1]) * ({r_sql('s')} * 2) + ms[(i - 1) % 16 + 1])"
CONTRAST = f"list_transform(v, lambda x: (x - mu) * ({r_sql('c')} + 0.5) + mu)"
TRANSLATE = (
    "list_transform(v, lambda x, i: case when ((i - 1) // 4) % 4 + tx between 0 and 3 and (i - 1) % 4 + ty between 0 and 3 "
    "then v[i + tx * 4 + ty] else 0.0 end)"
)
CUTOUT = (
    "list_transform(v, lambda x, i: case when ((i - 1) // 4) % 4 between greatest(least(ox, 3), 0) and greatest(least(ox + 1, 3), 0) "
    "and (i - 1) % 4 between greatest(least(oy, 3), 0) and greatest(least(oy + 1, 3), 0) then 0.0 else x end)"
)
SRC_SAT = f"(select vec_id, v, {_MEANS} as ms from {{src}})"
SRC_CON = "(select vec_id, v, list_sum(v) / 64 as mu from {src})"
SRC_TR = f"(select vec_id, v, {draw_sql('tx', 3)} - 1 as tx, {draw_sql('ty', 3)} - 1 as ty from {{src}})"
SRC_CUT = f"(select vec_id, v, {draw_sql('ox', 5)} - 1 as ox, {draw_sql('oy', 5)} - 1 as oy from {{src}})"


def rows(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", ar.doubles("embedding").alias("v"))


def shown(df, expr):
    return df.select("vec_id", ar.scaled6(expr).alias("v"))


def one(expr, src="s0"):
    return f"with {BASE} select vec_id, {list6(expr)} as v from {src.format(src='s0')}"


@query("M01_brightness", one(BRIGHT))
def m01(spark, sf):
    return shown(rows(spark, sf), op.brightness(F.col("v"), "vec_id", SEED))


@query("M02_contrast", one(CONTRAST, SRC_CON))
def m02(spark, sf):
    return shown(rows(spark, sf), op.contrast(F.col("v"), "vec_id", SEED))


@query("M03_saturation", one(SATURATE, SRC_SAT))
def m03(spark, sf):
    return shown(rows(spark, sf), op.saturation(F.col("v"), "vec_id", SEED, DIMS))


@query("M04_translate", one(TRANSLATE, SRC_TR))
def m04(spark, sf):
    return shown(rows(spark, sf), op.translate(F.col("v"), "vec_id", SEED, DIMS))


@query("M05_cutout", one(CUTOUT, SRC_CUT))
def m05(spark, sf):
    return shown(rows(spark, sf), op.cutout(F.col("v"), "vec_id", SEED, DIMS))


@query("M06_dropout", one(
    f"list_transform(v, lambda x, i: case when {rand_sql('vec_id', '(i - 1)', seed=f'{SEED}d')} >= 0.3 then x / 0.7::double else 0.0 end)"))
def m06(spark, sf):
    return shown(rows(spark, sf), op.dropout(F.col("v"), "vec_id", SEED, 0.3))


@query("M07_forward_noise", f"""
with {BASE}, {SCHEDULE_SQL}, t as (select *, {STEP_SQL} as t from s0), j as (select * from t join schedule using (t))
select vec_id, t, {list6(f"list_transform(v, lambda x, i: sqrt(alpha_bar) * x + sqrt(1 - alpha_bar) * {normal_sql('vec_id', '(i - 1)', seed=f'{SEED}n')})")} as v from j
""")
def m07(spark, sf):
    noisy = gather(rows(spark, sf).withColumn("t", step_of("vec_id")), op.schedule(spark))
    return noisy.select("vec_id", "t", ar.scaled6(op.add_noise(F.col("v"), F.col("alpha_bar"), "vec_id", SEED)).alias("v"))


@query("M08_policy_chain", f"""
with {BASE}, s1 as (select vec_id, {BRIGHT} as v from s0), s2 as (select vec_id, {SATURATE} as v from {SRC_SAT.format(src='s1')}),
s3 as (select vec_id, {CONTRAST} as v from {SRC_CON.format(src='s2')}), s4 as (select vec_id, {TRANSLATE} as v from {SRC_TR.format(src='s3')}),
s5 as (select vec_id, {CUTOUT} as v from {SRC_CUT.format(src='s4')}) select vec_id, {list6('v')} as v from s5
""")
def m08(spark, sf):
    return shown(op.augment(rows(spark, sf), "color,translation,cutout", "v", "vec_id", SEED, DIMS), F.col("v"))
