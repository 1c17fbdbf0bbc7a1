"""Inputs that are derived from the shared tables, and the same derivation as SQL."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparrowmill.functions import arrays as ar
from sparrowmill.functions.rand import portable_rand
from sparrowmill.plans.registry import rand_sql
from sparrowmill.tables import table

# boxes: five numbers of an embedding make corners and a score, the signs of two more the class
BOXES_SQL = """
e_ as (select vec_id, label, cast(embedding as double[]) as e from embeddings),
c_ as (select *, least(abs(e[1]) * 2, 0.6) as x1, least(abs(e[2]) * 2, 0.6) as y1 from e_),
boxes as (select vec_id as box_id, label as image, (case when e[7] > 0 then 1 else 0 end) + (case when e[8] > 0 then 1 else 0 end) as cls,
 e[6] > 0.15 as is_truth, x1, y1, least(x1 + 0.1 + abs(e[3]), 1.0) as x2, least(y1 + 0.1 + abs(e[4]), 1.0) as y2, least(abs(e[5]) * 3, 0.99) as score, e from c_)
""".strip()


def boxes(spark, sf) -> DataFrame:
    e = table(spark, sf, "embeddings").select("vec_id", "label", ar.doubles("embedding").alias("e"))
    at = lambda i: F.get("e", i)
    c = e.withColumn("x1", F.least(F.abs(at(0)) * 2, F.lit(0.6))).withColumn("y1", F.least(F.abs(at(1)) * 2, F.lit(0.6)))
    return c.select(
        F.col("vec_id").alias("box_id"), F.col("label").alias("image"),
        ((at(6) > 0).cast("int") + (at(7) > 0).cast("int")).alias("cls"), (at(5) > 0.15).alias("is_truth"), "x1", "y1",
        F.least(F.col("x1") + 0.1 + F.abs(at(2)), F.lit(1.0)).alias("x2"),
        F.least(F.col("y1") + 0.1 + F.abs(at(3)), F.lit(1.0)).alias("y2"),
        F.least(F.abs(at(4)) * 3, F.lit(0.99)).alias("score"), "e",
    )


IOU_SQL = (
    "(greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0) * greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0)) / "
    "((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - "
    "(greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0) * greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0)))"
)


def folded(vec, n: int):
    """n logits from a whole vector: logit c is the sum of the elements at positions c, c + n, ..."""
    return ar.let(vec, lambda v: F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)), lambda c: ar.total(F.filter(v, lambda x, i: i % n == c))
    ))


def folded_sql(vec: str, n: int) -> str:
    return f"list_transform(range(0, {n}), lambda c_: list_sum(list_filter({vec}, lambda x_, i_: (i_ - 1) % {n} = c_)))"


LOGITS_SQL = f"logits as (select vec_id, label, {folded_sql('cast(embedding as double[])', 10)} as z from embeddings)"


def logits(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", "label", folded(ar.doubles("embedding"), 10).alias("z"))


SCHEDULE_SQL = (
    "schedule as (select t, beta, 1 - beta as alpha, product(1 - beta) over (order by t) as alpha_bar from "
    "(select cast(range as int) as t, 0.0001::double + range * (0.02::double - 0.0001::double) / 49 as beta from range(50)))"
)
STEP_SQL = f"cast(floor({rand_sql('vec_id', seed='step')} * 50) as int)"


def step_of(key: str):
    return F.floor(portable_rand(key, seed="step") * 50).cast("int")


# price prediction: part price times quantity against the charged price
PRICE_SQL = (
    "price as (select l_orderkey, l_quantity, p_retailprice * l_quantity as p, l_extendedprice as y "
    "from lineitem join part on l_partkey = p_partkey)"
)


def price(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    pt = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    joined = li.join(pt, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        "l_orderkey", "l_quantity", (F.col("p_retailprice") * F.col("l_quantity")).alias("p"), F.col("l_extendedprice").alias("y")
    )


# class rule: long documents are predicted to be good
RULE_SQL = (
    "rule as (select d.doc_id, case when d.n_chars >= 500 then 1 else 0 end as pred, l.quality as truth, "
    "(d.n_chars - 500) / 1000.0::double as z, d.lang from documents d join labels l using (doc_id))"
)


def rule(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    both = d.join(table(spark, sf, "labels").select("doc_id", F.col("quality").alias("truth")), "doc_id")
    return both.select(
        "doc_id", (F.col("n_chars") >= 500).cast("int").alias("pred"), "truth",
        ((F.col("n_chars") - 500) / F.lit(1000.0)).alias("z"), "lang",
    )
