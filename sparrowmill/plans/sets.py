"""Group H: set operations."""

from pyspark.sql import functions as F

from sparrowmill.operators import relational as op
from sparrowmill.plans.registry import query
from sparrowmill.tables import table


@query("H01_union_rows", """
select p_partkey, p_size, p_retailprice, 'train' as src from part where p_retailprice < 950
union all select p_partkey, p_size, null, 'test' from part where p_retailprice >= 950
""")
def h01(spark, sf):
    p = table(spark, sf, "part")
    train = p.filter("p_retailprice < 950").select("p_partkey", "p_size", "p_retailprice", F.lit("train").alias("src"))
    test = p.filter("p_retailprice >= 950").select("p_partkey", "p_size", F.lit("test").alias("src"))
    return op.union_rows(train, test)


@query("H02_distinct", "select distinct p_type, p_brand from part")
def h02(spark, sf):
    return table(spark, sf, "part").select("p_type", "p_brand").distinct()


@query("H03_except", "select p_partkey as k from part except select l_partkey from lineitem where l_discount > 0.09")
def h03(spark, sf):
    keys = table(spark, sf, "lineitem").filter("l_discount > 0.09").select(F.col("l_partkey").alias("k"))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("k")).subtract(keys)


@query("H04_align_keys", """
with model as (select c_name as k from customer where c_acctbal > 0),
loaded as (select case when c_acctbal > -900 then 'module.' || c_name else c_name end as k from customer where c_mktsegment <> 'MACHINERY'),
s as (select (select avg(case when k like 'module.%' then 1.0 else 0 end) > 0.5 from loaded) as l, (select avg(case when k like 'module.%' then 1.0 else 0 end) > 0.5 from model) as m),
al as (select case when s.l and not s.m and k like 'module.%' then substr(k, 8) when s.m and not s.l then 'module.' || k else k end as k from loaded, s)
select k, 'missing' as state from model where k not in (select k from al) union all select k, 'unexpected' from al where k not in (select k from model)
""")
def h04(spark, sf):
    c = table(spark, sf, "customer")
    model = c.filter("c_acctbal > 0").select(F.col("c_name").alias("k"))
    name = F.when(F.col("c_acctbal") > -900, F.concat(F.lit("module."), "c_name")).otherwise(F.col("c_name"))
    loaded = c.filter("c_mktsegment <> 'MACHINERY'").select(name.alias("k"))
    return op.key_report(op.align_prefix(loaded, model, "k", "module."), model, "k")
