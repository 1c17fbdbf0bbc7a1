"""Group K: tabular feature preparation."""

from pyspark.sql import functions as F

from sparrowmill.functions import arrays as ar
from sparrowmill.operators import features as op
from sparrowmill.operators.metrics import linear_fit
from sparrowmill.plans.fixtures import PRICE_SQL, price
from sparrowmill.plans.registry import list6, normal_sql, query
from sparrowmill.sources import files as fs
from sparrowmill.session import scratch_path
from sparrowmill.tables import table


def parts(spark, sf):
    """part with a null size where it says 7 and a null type for one brand."""
    p = table(spark, sf, "part")
    return p.withColumn("p_size", F.nullif("p_size", F.lit(7))).withColumn(
        "p_type", F.when(F.col("p_brand") != "Brand#1", F.col("p_type"))
    )


PARTS_SQL = "pt as (select p_partkey, p_name, p_brand, case when p_brand <> 'Brand#1' then p_type end as p_type, nullif(p_size, 7) as p_size, p_retailprice from part)"


@query("K01_impute_mean", """
with l as (select l_returnflag, case when l_discount = 0 then null else l_quantity end as q from lineitem), f as (select l_returnflag, coalesce(q, (select avg(q) from l)) as q from l)
select l_returnflag, round(q, 8) as q, count(*) as n from f group by all
""")
def k01(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", F.when(F.col("l_discount") != 0, F.col("l_quantity")).alias("q"))
    return op.impute_mean(li, ["q"]).groupBy("l_returnflag", F.round("q", 8).alias("q")).agg(F.count("*").alias("n"))


@query("K02_standardize_sample", f"""
with {PARTS_SQL}, s as (select avg(p_size) as m1, stddev_samp(p_size) as s1, avg(p_retailprice) as m2, stddev_samp(p_retailprice) as s2 from pt)
select p_partkey, round(coalesce((p_size - m1) / s1, 0), 8) + 0.0 as p_size, round(coalesce((p_retailprice - m2) / s2, 0), 8) + 0.0 as p_retailprice from pt, s
""")
def k02(spark, sf):
    z = op.standardize(parts(spark, sf), ["p_size", "p_retailprice"])
    return z.select("p_partkey", *[(F.round(c, 8) + 0.0).alias(c) for c in ("p_size", "p_retailprice")])


@query("K03_standardize_population", """
with s as (select avg(l_quantity) as m, stddev_pop(l_quantity) as d, avg(l_tax) as m2, stddev_pop(l_tax) as d2 from lineitem)
select round((l_quantity - m) / d, 8) + 0.0 as l_quantity, round((l_tax - m2) / d2, 8) + 0.0 as l_tax, count(*) as n from lineitem, s group by all
""")
def k03(spark, sf):
    z = op.standardize(table(spark, sf, "lineitem").select("l_quantity", "l_tax"), ["l_quantity", "l_tax"], ddof=0)
    return z.groupBy(*[(F.round(c, 8) + 0.0).alias(c) for c in ("l_quantity", "l_tax")]).agg(F.count("*").alias("n"))


@query("K04_batch_norm", f"""
with u as (select vec_id, unnest(cast(embedding as double[])) as x, generate_subscripts(embedding, 1) as i from embeddings),
s as (select i, avg(x) as m, var_pop(x) as v from u group by i), z as (select vec_id, i, (x - m) / sqrt(v + 1e-5) * 1.5 + 0.25 as z from u join s using (i))
select vec_id, {list6('list(z order by i)')} as v from z group by vec_id
""")
def k04(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", ar.doubles("embedding").alias("v"))
    return op.batch_norm(e, "v", 1.5, 0.25, 1e-5).select("vec_id", ar.scaled6(F.col("v")).alias("v"))


_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query("K05_get_dummies", f"""
with {PARTS_SQL} select p_partkey, {', '.join(f"case when p_type = '{t}' then 1 else 0 end as p_type_{t}" for t in _TYPES)}, case when p_type is null then 1 else 0 end as p_type_nan from pt
""")
def k05(spark, sf):
    return op.get_dummies(parts(spark, sf).select("p_partkey", "p_type"), ["p_type"])


@query("K05_sparse_dummies", """
with p as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(nullif(l_partkey % 7, 0) as varchar) as a, cast(l_suppkey as varchar) as b from lineitem),
v as (select distinct 0 as c, a as v from p where a is not null union select distinct 1, b from p where b is not null union all select 0, null union all select 1, null),
f as (select c, v, row_number() over (order by c, v nulls last) - 1 as i from v)
select l_orderkey, l_linenumber, l_partkey, x.i || ',' || y.i as features, count(*) as n from p join f x on x.c = 0 and x.v is not distinct from a join f y on y.c = 1 and y.v is not distinct from b group by all
""")
def k05_sparse(spark, sf):
    li = table(spark, sf, "lineitem")
    a = F.nullif(F.col("l_partkey") % 7, F.lit(0)).cast("string")
    p = li.select("l_orderkey", "l_linenumber", "l_partkey", a.alias("a"), F.col("l_suppkey").cast("string").alias("b"))
    made = op.sparse_dummies(p, ["a", "b"], op.dummy_index(p, ["a", "b"]), "l_orderkey")
    shown = F.array_join(F.col("features").cast("array<string>"), ",").alias("features")
    return made.groupBy("l_orderkey", "l_linenumber", "l_partkey", shown).agg(F.count("*").alias("n"))


@query("K06_numeric_columns", """
select 'p_partkey' as name, count(p_partkey) as n, round(avg(p_partkey), 6) as mean from part union all
select 'p_size', count(p_size), round(avg(p_size), 6) from part union all select 'p_retailprice', count(p_retailprice), round(avg(p_retailprice), 6) from part
""")
def k06(spark, sf):
    p = table(spark, sf, "part")
    cells = [F.struct(F.lit(c).alias("name"), F.count(c).alias("n"), F.round(F.avg(c), 6).alias("mean")) for c in op.numeric_columns(p)]
    return p.agg(F.array(*cells).alias("c")).select(F.inline("c"))


@query("K07_fit_transform_union", f"""
with {PARTS_SQL}, s as (select avg(p_size) as m, stddev_samp(p_size) as d from pt)
select p_partkey, case when p_retailprice < 950 then 'train' else 'test' end as src, round(coalesce((p_size - m) / d, 0), 8) + 0.0 as p_size,
 {', '.join(f"case when p_type = '{t}' then 1 else 0 end as p_type_{t}" for t in _TYPES)}, case when p_type is null then 1 else 0 end as p_type_nan from pt, s
""")
def k07(spark, sf):
    p = parts(spark, sf).select("p_partkey", "p_size", "p_type", "p_retailprice")
    train, test = op.fit_transform_union(
        p.filter("p_retailprice < 950").drop("p_retailprice"), p.filter("p_retailprice >= 950").drop("p_retailprice"), ["p_size"], ["p_type"]
    )
    both = train.withColumn("src", F.lit("train")).unionByName(test.withColumn("src", F.lit("test")))
    return both.withColumn("p_size", F.round("p_size", 8) + 0.0)


@query("K07_union_sparse", f"""
with {PARTS_SQL}, s as (select avg(p_size) as m, stddev_samp(p_size) as d from pt),
f as (select v, row_number() over (order by v nulls last) - 1 as i from (select distinct p_type as v from pt where p_type is not null union all select null))
select p_partkey, case when p_retailprice < 950 then 'train' else 'test' end as src, round(coalesce((p_size - m) / d, 0), 8) + 0.0 as p_size, cast(f.i as varchar) as features
from pt, s, f where f.v is not distinct from pt.p_type
""")
def k07_sparse(spark, sf):
    p = parts(spark, sf).select("p_partkey", "p_size", "p_type", "p_retailprice")
    train, test, _ = op.fit_transform_union_sparse(
        p.filter("p_retailprice < 950").drop("p_retailprice"), p.filter("p_retailprice >= 950").drop("p_retailprice"), ["p_size"], ["p_type"], "p_partkey"
    )
    both = train.withColumn("src", F.lit("train")).unionByName(test.withColumn("src", F.lit("test")))
    shown = F.array_join(F.col("features").cast("array<string>"), ",").alias("features")
    return both.select("p_partkey", "src", (F.round("p_size", 8) + 0.0).alias("p_size"), shown)


@query("K08_prediction_export", f"""
with {PRICE_SQL}, f as (select regr_slope(y, p) as a, regr_intercept(y, p) as b from price) select p_partkey as id, round(p_retailprice * a + b, 4) as sale_price from part, f
""")
def k08(spark, sf):
    fit = linear_fit(price(spark, sf), F.col("p"), F.col("y"))
    out = op.predictions(table(spark, sf, "part"), "p_partkey", F.col("p_retailprice"), fit)
    named = out.select(F.col("p_partkey").alias("id"), F.round("prediction", 4).alias("sale_price"))
    path = scratch_path(spark, "submission")
    fs.write_csv(named, path)
    return fs.read_csv(spark, path, schema="id bigint, sale_price double")


@query("K09_linear_targets", f"""
select o_orderkey, round(1.25::double + (o_totalprice / 100000) * 0.75 + (o_custkey / 1000) * -1.5::double + {normal_sql('o_orderkey', seed=21)} * 0.05::double, 9) as y from orders
""")
def k09(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") / 100000).alias("a"), (F.col("o_custkey") / 1000).alias("b"))
    return op.linear_targets(o, ["a", "b"], [0.75, -1.5], 1.25, 0.05, "o_orderkey", 21).select("o_orderkey", F.round("y", 9).alias("y"))
