"""Groups C and D: projections, predicates and joins."""

from pyspark.sql import functions as F

from sparrowmill.functions import arrays as ar
from sparrowmill.functions import text as tx
from sparrowmill.operators import boxes as bx
from sparrowmill.operators import corpus as cp
from sparrowmill.operators import relational as op
from sparrowmill.operators import vectors as vx
from sparrowmill.operators.augment import schedule
from sparrowmill.plans.corpus import IDS, joined_sql
from sparrowmill.plans.fixtures import BOXES_SQL, IOU_SQL, SCHEDULE_SQL, STEP_SQL, boxes, step_of
from sparrowmill.plans.registry import list6, query
from sparrowmill.session import materialize, spread
from sparrowmill.tables import table


@query("C01_select_columns", "select p_partkey, p_type, p_size, p_retailprice from part")
def c01(spark, sf):
    return op.columns_at(table(spark, sf, "part"), (0, -3, -2, -1))


@query("C02_filter_prefix", """
select doc_id, lang, n_chars from documents where (text like 'The%' or text like 'Th%' or text like 'A%') and n_chars > 200
""")
def c02(spark, sf):
    t = F.col("text")
    keep = (t.startswith("The") | t.startswith("Th") | t.startswith("A")) & (F.col("n_chars") > 200)
    return table(spark, sf, "documents").filter(keep).select("doc_id", "lang", "n_chars")


@query("C03_map_column", "select doc_id, md5('text is ' || text) as digest, 'text is ' || lang as tag from documents")
def c03(spark, sf):
    d = table(spark, sf, "documents")
    mapped = d.withColumn("text", F.concat(F.lit("text is "), "text"))
    return mapped.select("doc_id", F.md5("text").alias("digest"), F.concat(F.lit("text is "), "lang").alias("tag"))


@query("C04_take_rows", """
with d as (select doc_id, source, n_chars, row_number() over (order by n_chars, doc_id) - 1 as source_index from documents)
select * from d where source_index in (select doc_id from labels where quality = 1)
""")
def c04(spark, sf):
    idx = table(spark, sf, "labels").filter("quality = 1").select(F.col("doc_id").alias("source_index"))
    d = table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return op.take_rows(d, ["n_chars", "doc_id"], idx)


@query("C05_where", """
select l_linestatus, l_returnflag, count(*) as n, round(sum(case when l_discount > 0.05 then l_extendedprice * (1 - l_discount) else l_extendedprice end), 4) as v
from lineitem group by all
""")
def c05(spark, sf):
    price = F.col("l_extendedprice")
    v = F.when(F.col("l_discount") > 0.05, price * (1 - F.col("l_discount"))).otherwise(price)
    return table(spark, sf, "lineitem").groupBy("l_linestatus", "l_returnflag").agg(
        F.count("*").alias("n"), F.round(F.sum(v), 4).alias("v")
    )


@query("C06_nonzero", """
select vec_id, array_to_string(list_filter(list_transform(embedding, lambda x, i: case when x > 0.1 then i - 1 end), lambda p: p is not null), ',') as hits
from embeddings
""")
def c06(spark, sf):
    hits = ar.positions_where(ar.doubles("embedding"), lambda x: x > 0.1)
    return table(spark, sf, "embeddings").select("vec_id", F.array_join(hits.cast("array<string>"), ",").alias("hits"))


@query("C07_clamp", "select c_custkey, greatest(least(c_acctbal, 5000.0), 0.0) as bal from customer")
def c07(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", op.clamp(F.col("c_acctbal"), 0.0, 5000.0).alias("bal"))


@query("C08_cast", """
select cast(trunc(l_extendedprice) as bigint) as whole, cast(trunc(l_quantity) as int) as qty, cast(l_orderkey as varchar) as key_text,
 count(*) as n from lineitem group by all
""")
def c08(spark, sf):
    t = table(spark, sf, "lineitem")
    cols = [F.col("l_extendedprice").cast("bigint").alias("whole"), F.col("l_quantity").cast("int").alias("qty"),
            F.col("l_orderkey").cast("string").alias("key_text")]
    return t.groupBy(*cols).agg(F.count("*").alias("n"))


@query("C09_outer", f"""
select vec_id, {list6('flatten(list_transform(cast(embedding as double[]), lambda x: list_transform([0.5, 1.0, 2.0], lambda y: x + y)))')} as plus,
 {list6('flatten(list_transform(cast(embedding as double[]), lambda x: list_transform([0.5, 1.0, 2.0], lambda y: x * y)))')} as times from embeddings
""")
def c09(spark, sf):
    b = F.array(F.lit(0.5), F.lit(1.0), F.lit(2.0))
    e = ar.doubles("embedding")
    return table(spark, sf, "embeddings").select(
        "vec_id", ar.scaled6(ar.outer(e, b, lambda x, y: x + y)).alias("plus"),
        ar.scaled6(ar.outer(e, b, lambda x, y: x * y)).alias("times"),
    )


@query("D01_metadata_lookup", """
with m as (select p_size, arg_max(p_name, p_partkey) as p_name, max(p_partkey) as p_partkey from part group by p_size)
select m.p_name, m.p_partkey, l.l_quantity, count(*) as n from lineitem l left join m on m.p_size = cast(l.l_quantity as int) group by all
""")
def d01(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", F.col("l_quantity").cast("int").alias("p_size"))
    meta = table(spark, sf, "part").select("p_size", "p_name", "p_partkey")
    counts = li.groupBy("l_quantity", "p_size").agg(F.count("*").alias("n"))  # rows of one key meet the metadata once
    found = op.metadata_lookup(counts, meta, "p_size", ["p_partkey"])
    return found.groupBy("p_name", "p_partkey", "l_quantity").agg(F.sum("n").alias("n"))


@query("D02_by_class", "select p_partkey, p_name, p_brand from part where p_type = 'ECONOMY'")
def d02(spark, sf):
    return table(spark, sf, "part").filter(F.col("p_type") == "ECONOMY").select("p_partkey", "p_name", "p_brand")


@query("D03_split_rows", """
select doc_id, lang, n_chars from documents where doc_id in (select doc_id from labels where toxic = 0)
""")
def d03(spark, sf):
    members = table(spark, sf, "labels").filter("toxic = 0")
    return op.split_rows(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), members, "doc_id")


@query("D04_complement", "select doc_id, lang, n_chars from documents where doc_id not in (select doc_id from labels)")
def d04(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return op.complement(d, table(spark, sf, "labels"), "doc_id")


@query("D05_token_lookup", f"""
with {IDS.split(', coded as')[0]}, v2 as (select token, id from voc where freq >= 5)
select coalesce(id, 0) as id, count(*) as n, count(distinct token) as tokens, cast(sum(pos) as bigint) as pos_sum
from tok left join v2 using (token) group by all
""")
def d05(spark, sf):
    d = spread(table(spark, sf, "documents"))
    totals = materialize(cp.token_totals(d, tx.words(F.col("text"))))  # one reading of the texts, one row per token
    vocab = cp.vocab_of(totals.select("token", F.col("n").alias("freq")), 5)
    coded = cp.encode_totals(totals, vocab)
    return coded.groupBy("id").agg(
        F.sum("n").alias("n"), F.count("*").alias("tokens"), F.sum("pos_sum").alias("pos_sum")
    )


@query("D06_gather_step", f"""
with {SCHEDULE_SQL}, e as (select vec_id, {STEP_SQL} as t from embeddings)
select vec_id, t, round(beta, 12) as beta, round(alpha_bar, 10) as alpha_bar from e join schedule using (t)
""")
def d06(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", step_of("vec_id").alias("t"))
    got = op.gather(rows, schedule(spark))
    return got.select("vec_id", "t", F.round("beta", 12).alias("beta"), F.round("alpha_bar", 10).alias("alpha_bar"))


@query("D07_overlap_join", f"""
with {BOXES_SQL}, p as (select a.box_id as a_id, b.box_id as b_id, {IOU_SQL} as iou from boxes a join boxes b on a.image = b.image and a.box_id < b.box_id)
select a_id, b_id, round(iou, 9) as iou from p where iou > 0.3
""")
def d07(spark, sf):
    b = boxes(spark, sf)
    pairs = bx.overlap_join(b, b, 0.3)
    return pairs.filter("a_id < b_id").select("a_id", "b_id", F.round("iou", 9).alias("iou"))


_DOT = "list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))"
_VEC = "v as (select vec_id, label, cast(embedding as double[]) as v from embeddings)"


@query("D08_pair_similarity", f"""
with {_VEC}
select a.vec_id as a_id, b.vec_id as b_id,
 round({_DOT} / sqrt({_DOT.replace('b.v', 'a.v')} * {_DOT.replace('a.v', 'b.v')}), 8) + 0.0 as cosine,
 round(sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))), 8) as l2
from v a join v b on b.vec_id = a.vec_id + 1
""")
def d08(spark, sf):
    e = table(spark, sf, "embeddings")
    pairs = e.select(F.col("vec_id").alias("a_id"), (F.col("vec_id") + 1).alias("b_id"))
    sim = vx.pair_similarity(e, pairs, "vec_id", "embedding")
    return sim.select("a_id", "b_id", (F.round("cosine", 8) + 0.0).alias("cosine"), F.round("l2", 8).alias("l2"))


@query("D08_nearest", f"""
with {_VEC}, u as (select vec_id, label, unnest(v) as x, generate_subscripts(v, 1) as i from v),
q as (select label, list(m order by i) as v from (select label, i, avg(x) as m from u group by label, i) group by label),
d as (select b.label as query_id, a.vec_id, {_DOT} / sqrt({_DOT.replace('b.v', 'a.v')} * {_DOT.replace('a.v', 'b.v')}) as sim from v a, q b),
r as (select *, row_number() over (partition by query_id order by round(sim, 9) desc, vec_id) as rank from d)
select query_id, vec_id, round(sim, 7) as score, cast(rank as int) as rank from r where rank <= 5
""")
def d08_nearest(spark, sf):
    e = table(spark, sf, "embeddings")
    queries = vx.class_means(e, "label", "embedding")
    near = vx.nearest(e, queries, "vec_id", "embedding", k=5, metric="cosine")
    return near.select("query_id", "vec_id", F.round("score", 7).alias("score"), "rank")


@query("D09_hstack", """
with a as (select row_number() over (order by c_custkey) - 1 as source_index, c_name from customer),
b as (select row_number() over (order by c_acctbal, c_custkey) - 1 as source_index, c_acctbal from customer where c_acctbal > 0)
select source_index, c_name, c_acctbal from a full join b using (source_index)
""")
def d09(spark, sf):
    c = table(spark, sf, "customer")
    left = c.select("c_custkey", "c_name")
    right = c.filter("c_acctbal > 0").select(F.col("c_custkey").alias("k"), "c_acctbal")
    both = op.hstack(left, right, ["c_custkey"], ["c_acctbal", "k"])
    return both.select("source_index", "c_name", "c_acctbal")
