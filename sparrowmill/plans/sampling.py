"""Group G: order, limits, samples, splits, folds, shards, batches, sequences."""

from pyspark.sql import functions as F

from sparrowmill.functions import arrays as ar
from sparrowmill.functions import text as tx
from sparrowmill.operators import corpus as cp
from sparrowmill.operators import sampling as op
from sparrowmill.plans.corpus import UNI
from sparrowmill.plans.registry import list6, query, rand_sql
from sparrowmill.session import spread
from sparrowmill.tables import table


def docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")


@query("G01_sort", "select doc_id, quality, toxic from labels order by quality desc, toxic, doc_id")
def g01(spark, sf):
    return table(spark, sf, "labels").orderBy(F.desc("quality"), "toxic", "doc_id")


@query("G02_shuffle", f"select doc_id, lang, round({rand_sql('doc_id', seed=42)}, 9) as r from documents order by r, doc_id")
def g02(spark, sf):
    from sparrowmill.functions.rand import portable_rand

    mixed = op.shuffle(docs(spark, sf), "doc_id", 42)
    return mixed.select("doc_id", "lang", F.round(portable_rand("doc_id", seed=42), 9).alias("r"))


@query("G03_head", "select doc_id, lang, n_chars from documents order by doc_id limit 100")
def g03(spark, sf):
    return op.head(docs(spark, sf), "doc_id", 100).select("doc_id", "lang", "n_chars")


@query("G04_sample_n", f"select doc_id, source from documents order by {rand_sql('doc_id', seed=3)}, doc_id limit 100")
def g04(spark, sf):
    return op.sample_n(docs(spark, sf), "doc_id", 100, 3).select("doc_id", "source")


@query("G05_random_split", f"""
select doc_id, case when {rand_sql('doc_id', seed=5)} < 0.1 then 'test' else 'train' end as split from documents
""")
def g05(spark, sf):
    return op.random_split(docs(spark, sf), "doc_id", 0.1, 5).select("doc_id", "split")


@query("G06_kfold", """
with r as (select doc_id, row_number() over (order by doc_id) - 1 as i from documents), f as (select doc_id, i // (select count(*) // 7 from documents) as fold from r)
select doc_id, fold from f where fold < 7
""")
def g06(spark, sf):
    return op.contiguous_folds(docs(spark, sf), ["doc_id"], 7).select("doc_id", "fold")


@query("G07_shard", """
select doc_id, ntile(7) over (order by doc_id) - 1 as contiguous, (row_number() over (order by doc_id) - 1) % 7 as strided from documents
""")
def g07(spark, sf):
    return op.shards(docs(spark, sf), ["doc_id"], 7).select("doc_id", "contiguous", "strided")


@query("G08_carve", """
select doc_id, case when row_number() over (order by doc_id) <= (select count(*) // 3 from labels) then 'val' else 'test' end as split from labels
""")
def g08(spark, sf):
    return op.carve(table(spark, sf, "labels").select("doc_id"), ["doc_id"])


@query("G09_batches", """
with r as (select doc_id, row_number() over (order by doc_id) - 1 as i from documents) select doc_id, i // 48 as batch, i % 48 as slot from r
""")
def g09(spark, sf):
    return op.batches(docs(spark, sf), ["doc_id"], 48).select("doc_id", "batch", "slot")


@query("G09_batches_drop_last", """
with r as (select doc_id, row_number() over (order by doc_id) - 1 as i from documents)
select doc_id, i // 48 as batch, i % 48 as slot from r where i // 48 < (select count(*) // 48 from documents)
""")
def g09_drop(spark, sf):
    return op.batches(docs(spark, sf), ["doc_id"], 48, drop_last=True).select("doc_id", "batch", "slot")


@query("G10_choice", f"""
with n as (select row_number() over (order by c_custkey) - 1 as source_index, c_custkey, c_name from customer),
d as (select source_index || '-' || unnest([1, 2]) as draw from n), p as (select draw, cast(floor({rand_sql('draw', seed=9)} * (select count(*) from n)) as bigint) as source_index from d)
select draw, c_custkey, c_name from p join n using (source_index)
""")
def g10(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return op.sample_with_replacement(c, ["c_custkey"], F.lit(2), 9).select("draw", "c_custkey", "c_name")


@query("G11_most_common", f"with {UNI} select token as gram, n from uni order by n desc, token limit 10")
def g11(spark, sf):
    d = spread(table(spark, sf, "documents"))
    return cp.most_common(cp.ngram_counts(d, tx.words(F.col("text")), 1), 10)


_P = "from part"


@query("G12_sequences", f"""
select p_partkey, {list6('list_transform(range(0, p_size), lambda i: 0.0 + i * ((p_retailprice - 0.0) / greatest(p_size - 1, 1)))')} as linspace,
 array_to_string(range(0, p_size, 3), ',') as arange, array_to_string(list_transform(range(0, p_size), lambda j: case when j = p_size // 2 then 1 else 0 end), ',') as eye_row from part
""")
def g12(spark, sf):
    n = F.col("p_size")
    line = op.linspace(F.lit(0.0), F.col("p_retailprice"), n)
    steps = F.sequence(F.lit(0), n - 1, F.lit(3))
    eye = op.identity_row(F.floor(n / 2), n)
    return table(spark, sf, "part").select(
        "p_partkey", ar.scaled6(line).alias("linspace"), F.array_join(steps.cast("array<string>"), ",").alias("arange"),
        F.array_join(eye.cast("array<int>").cast("array<string>"), ",").alias("eye_row"),
    )
