"""Group F: windows, ranks and time series."""

from pyspark.sql import functions as F

from sparrowmill.functions import arrays as ar
from sparrowmill.functions import text as tx
from sparrowmill.operators import corpus as cp
from sparrowmill.operators import series as op
from sparrowmill.operators.sampling import batches
from sparrowmill.plans.corpus import BI, UNI
from sparrowmill.plans.registry import query
from sparrowmill.session import spread
from sparrowmill.tables import table

KEY, ORDER = ["user_id"], ["ts", "event_id"]
W = "(partition by user_id order by ts, event_id)"


def events(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "ts", "value")


@query("F01_lag_features", f"""
with l as (select event_id, user_id, lag(value, 4) over {W} as x1, lag(value, 3) over {W} as x2, lag(value, 2) over {W} as x3, lag(value, 1) over {W} as x4, value as y from events)
select * from l where x1 is not null
""")
def f01(spark, sf):
    return op.lag_features(events(spark, sf), KEY, ORDER, "value", 4).select("event_id", "user_id", "x1", "x2", "x3", "x4", "y")


@query("F02_horizons", "select event_id, user_id, " + ", ".join(f"lead(value, {k}) over {W} as ahead_{k}" for k in (3, 6, 12, 24)) + " from events")
def f02(spark, sf):
    h = op.horizons(events(spark, sf), KEY, ORDER, "value", (3, 6, 12, 24))
    return h.select("event_id", "user_id", *[f"ahead_{k}" for k in (3, 6, 12, 24)])


@query("F03_forecast", f"""
with recursive r as (select user_id, value, row_number() over (partition by user_id order by ts desc, event_id desc) as k from events),
s(user_id, step, a, b, c, d) as (select user_id, 0, max(value) filter (k = 4), max(value) filter (k = 3), max(value) filter (k = 2), max(value) filter (k = 1) from r group by user_id having count(*) >= 4
 union all select user_id, step + 1, b, c, d, a * 0.1::double + b * 0.2::double + c * 0.3::double + d * 0.4::double from s where step < 8)
select user_id, step, round(d, 8) as value from s where step > 0
""")
def f03(spark, sf):
    out = op.recursive_forecast(events(spark, sf), KEY, [F.desc("ts"), F.desc("event_id")], "value", (0.1, 0.2, 0.3, 0.4), 8)
    return out.select("user_id", "step", F.round("value", 8).alias("value"))


@query("F04_time_split", """
select event_id, case when row_number() over (order by ts, event_id) <= 600 then 'train' else 'test' end as split from events
""")
def f04(spark, sf):
    return op.time_split(events(spark, sf), ORDER, 600).select("event_id", "split")


@query("F05_cumsum", """
select o_orderkey, o_custkey, round(sum(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey rows unbounded preceding), 2) as cumsum from orders
""")
def f05(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = op.cumulative(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_totalprice"))
    return c.select("o_orderkey", "o_custkey", F.round("cumsum", 2).alias("cumsum"))


_LI = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_discount"]
_LW = f"(partition by l_orderkey order by {', '.join(_LI)} rows between unbounded preceding"


@query("F06_cumprod", f"""
select l_orderkey, l_linenumber, l_partkey, round(product(1 - l_discount) over {_LW} and current row), 10) as cumprod,
 round(coalesce(product(1 - l_discount) over {_LW} and 1 preceding), 1.0), 10) as cumprod_prev from lineitem
""")
def f06(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", *_LI)
    c = op.cumulative_product(li, ["l_orderkey"], _LI, 1 - F.col("l_discount"))
    return c.select("l_orderkey", "l_linenumber", "l_partkey", F.round("cumprod", 10).alias("cumprod"),
                    F.round("cumprod_prev", 10).alias("cumprod_prev"))


@query("F07_ema", """
with d as (select user_id, date_part('day', ts) as day, avg(value) as mean, var_pop(value) as var from events group by all),
r as (select *, row_number() over (partition by user_id order by day) as k from d)
select a.user_id, cast(a.day as int) as day, round(sum(pow(0.876543211::double, a.k - b.k) * (1 - 0.876543211::double) * b.mean), 6) as moving_mean, round(sum(pow(0.876543211::double, a.k - b.k) * (1 - 0.876543211::double) * b.var), 5) as moving_var
from r a join r b on a.user_id = b.user_id and b.k <= a.k group by a.user_id, a.day
""")
def f07(spark, sf):
    d = events(spark, sf).groupBy("user_id", F.day("ts").alias("day")).agg(F.avg("value").alias("mean"), F.var_pop("value").alias("var"))
    m = op.moving_statistics(d, KEY, ["day"], ["mean", "var"], 0.876543211)
    return m.select("user_id", "day", F.round("moving_mean", 6).alias("moving_mean"), F.round("moving_var", 5).alias("moving_var"))


@query("F08_velocity", f"""
with r as (select event_id, user_id, value, row_number() over {W} as k from events)
select a.event_id, a.user_id, round(sum(pow(0.5, a.k - b.k) * 0.123456789::double * b.value), 7) as velocity from r a join r b on a.user_id = b.user_id and b.k <= a.k group by all
""")
def f08(spark, sf):
    v = op.velocity(events(spark, sf), KEY, ORDER, "value", 0.5, 0.123456789)
    return v.select("event_id", "user_id", F.round("velocity", 7).alias("velocity"))


@query("F09_argsort", """
with u as (select vec_id, unnest(embedding) as x, generate_subscripts(embedding, 1) - 1 as i from embeddings)
select vec_id, string_agg(i, ',' order by x, i) as positions from u group by vec_id
""")
def f09(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.array_join(ar.argsort(ar.doubles("embedding")).cast("array<string>"), ",").alias("positions"))


@query("F10_argmax", """
select vec_id, cast(list_position(embedding, list_max(embedding)) - 1 as int) as hi, cast(list_position(embedding, list_min(embedding)) - 1 as int) as lo from embeddings
""")
def f10(spark, sf):
    e = ar.doubles("embedding")
    return table(spark, sf, "embeddings").select("vec_id", ar.argmax(e).alias("hi"), ar.argmin(e).alias("lo"))


@query("F10_argmax_rows", """
with u as (select vec_id, unnest(embedding) as x, generate_subscripts(embedding, 1) - 1 as i from embeddings)
select cast(i as int) as i, arg_max(vec_id, (x, -vec_id)) as hi, arg_min(vec_id, (x, vec_id)) as lo from u group by i
""")
def f10_rows(spark, sf):
    u = table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "x"))
    return u.groupBy("i").agg(
        F.max_by("vec_id", F.struct("x", -F.col("vec_id"))).alias("hi"), F.min_by("vec_id", F.struct("x", "vec_id")).alias("lo")
    )


@query("F11_sliding_pool", f"""
with p as (select event_id, user_id, max(value) over (partition by user_id order by ts, event_id rows between current row and 2 following) as pool_max,
 avg(value) over (partition by user_id order by ts, event_id rows between current row and 2 following) as pool_avg, lead(event_id, 2) over {W} as full_ from events)
select event_id, user_id, pool_max, round(pool_avg, 8) as pool_avg from p where full_ is not null
""")
def f11(spark, sf):
    p = op.sliding_pool(events(spark, sf), KEY, ORDER, "value", 3)
    return p.select("event_id", "user_id", "pool_max", F.round("pool_avg", 8).alias("pool_avg"))


@query("F12_block_pool", f"""
with r as (select user_id, value, row_number() over {W} as p, count(*) over (partition by user_id) as n from events),
c as (select *, unnest(range(0, (n + 2 - 3) // 2 + 1)) as cell from r)
select user_id, cell, max(value) as pool_max, round(sum(value) / 3, 8) as pool_avg from c where p between cell * 2 and cell * 2 + 2 group by all
""")
def f12(spark, sf):
    p = op.block_pool(events(spark, sf), KEY, ORDER, "value", 3, 2, 1)
    return p.select("user_id", "cell", "pool_max", F.round("pool_avg", 8).alias("pool_avg"))


@query("F13_correlate", f"""
with c as (select event_id, value - lead(value, 1) over {W} as edge, value * 0.25 + lead(value, 1) over {W} * 0.5 + lead(value, 2) over {W} * 0.25 as smooth from events)
select event_id, round(edge, 6) + 0.0 as edge, round(smooth, 6) as smooth from c where smooth is not null
""")
def f13(spark, sf):
    e = events(spark, sf)
    edge = op.correlate(e, KEY, ORDER, "value", (1, -1)).select("event_id", (F.round("corr", 6) + 0.0).alias("edge"))
    smooth = op.correlate(e, KEY, ORDER, "value", (0.25, 0.5, 0.25)).select("event_id", F.round("corr", 6).alias("smooth"))
    return edge.join(smooth, "event_id")


@query("F14_progress", """
with b as (select (row_number() over (order by ts, event_id) - 1) // 64 as batch, value from events),
g as (select batch, count(*) as samples, sum(value) as seconds from b group by batch),
c as (select *, sum(samples) over (order by batch) as total, sum(seconds) over (order by batch) as time from g)
select batch, samples, round(samples / seconds, 9) as batch_speed, round(total / time, 9) as avg_speed from c where (batch + 1) % 10 = 0 or batch = (select max(batch) from g)
""")
def f14(spark, sf):
    b = batches(events(spark, sf), ORDER, 64).groupBy("batch").agg(F.count("*").alias("samples"), F.sum("value").alias("seconds"))
    r = op.progress_report(b, "batch", "samples", "seconds", 10)
    return r.select("batch", "samples", F.round("batch_speed", 9).alias("batch_speed"), F.round("avg_speed", 9).alias("avg_speed"))


@query("F15_latest_version", r"""
with p as (select regexp_extract(url, '^https?://([^/]+)', 1) as host, url, regexp_extract(url, '/([0-9]+)', 1) as num from pages)
select host, max(cast(num as bigint)) as version, arg_max(url, (cast(num as bigint), url)) as latest from p where num <> '' group by host
""")
def f15(spark, sf):
    p = table(spark, sf, "pages").select(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), "url")
    return op.latest_version(p, ["host"], "url", "/([0-9]+)")


@query("F16_zipf", f"""
with {UNI}, r as (select token as gram, n, row_number() over (order by n desc, token) as rank from uni) select gram, n, rank, round(ln(rank), 9) as log_rank, round(ln(n), 9) as log_n from r
""")
def f16(spark, sf):
    z = op.rank_frequency(cp.ngram_counts(spread(table(spark, sf, "documents")), tx.words(F.col("text")), 1))
    return z.select("gram", "n", "rank", F.round("log_rank", 9).alias("log_rank"), F.round("log_n", 9).alias("log_n"))


@query("F17_zipf_slope", f"""
with {BI}, tri0 as (select token || ' ' || lead(token) over (partition by doc_id order by pos) || ' ' || lead(token, 2) over (partition by doc_id order by pos) as g from tok),
c as (select 1 as k, token as g, n from uni union all select 2, w1 || ' ' || w2, n from bi union all select 3, g, count(*) from tri0 where g is not null group by g),
r as (select k, ln(n) as y, ln(row_number() over (partition by k order by n desc, g)) as x from c)
select k, round(-regr_slope(y, x), 8) as exponent, count(*) as n_items from r group by k
""")
def f17(spark, sf):
    d, w = spread(table(spark, sf, "documents")), tx.words(F.col("text"))
    pairs = cp.word_pairs(d, w)
    counts = [cp.words_of_pairs(pairs), cp.bigrams_of_pairs(pairs), cp.ngram_counts(d, w, 3)]
    parts = [op.zipf_exponent(op.rank_counts(c)).withColumn("k", F.lit(k)) for k, c in enumerate(counts, 1)]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return both.select("k", F.round("exponent", 8).alias("exponent"), "n_items")
