"""Group N: streams over the events table."""

from pyspark.sql import functions as F

from sparrowmill.plans.registry import query
from sparrowmill.session import scratch_path
from sparrowmill.streaming import reports as st
from sparrowmill.tables import table

HOUR = "yyyy-MM-dd HH:mm"


PARTS = 4


def arrivals(spark, sf, late_first=False):
    """Writes the events in time slices, one slice per step. Yields the stream after each slice.

    With late_first the oldest slice comes last, when the watermark has passed it.
    """
    e = table(spark, sf, "events")
    lo, hi = e.agg(F.min("ts"), F.max("ts")).first()
    step = (hi - lo) / PARTS
    path = scratch_path(spark, "arrivals")
    slices = [*range(1, PARTS), 0] if late_first else range(PARTS)
    for i in slices:
        part = e.filter(F.col("ts") >= F.lit(lo + i * step)) if i else e
        part = part.filter(F.col("ts") < F.lit(lo + (i + 1) * step)) if i < PARTS - 1 else part
        part.write.mode("append").parquet(path)
        yield st.event_stream(spark, path, e.schema)


def replay(spark, sf, report, **kw):
    """The report after the last slice; every slice is one run that goes on where the last one stopped."""
    home = scratch_path(spark, "stream")
    return [report(s, home) for s in arrivals(spark, sf, **kw)]


@query("N01_ingest", """
select case when event_type <> 'error' then 'good' else 'bad' end as side, case when event_type <> 'error' then '' else 'value' end as lacking, count(*) as n, round(sum(case when event_type <> 'error' then value end), 2) as total from events group by all
""")
def n01(spark, sf):
    def report(s, home):
        holed = s.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
        return st.ingest(holed, ["event_id", "user_id", "value"], home)

    good, bad = replay(spark, sf, report)[-1]
    both = good.withColumn("lacking", F.lit("")).withColumn("side", F.lit("good")).unionByName(
        bad.withColumn("lacking", F.array_join("lacking", ",")).withColumn("side", F.lit("bad"))
    )
    return both.groupBy("side", "lacking").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("N02_tumbling", """
select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') as start, count(*) as n, round(sum(value), 2) as total from events group by all
""")
def n02(spark, sf):
    def report(s, home):
        return st.collect_batches(st.tumbling_throughput(s, "1 hour", "2 hours"), "update", home)

    final = st.latest(replay(spark, sf, report)[-1], "start")
    return final.select(F.date_format("start", HOUR).alias("start"), "n", F.round("total", 2).alias("total"))


@query("N03_sliding", """
with s as (select time_bucket(interval '15 minutes', ts) - unnest([interval '0 minutes', interval '15 minutes', interval '30 minutes', interval '45 minutes']) as start, value from events)
select strftime(start, '%Y-%m-%d %H:%M') as start, round(avg(value), 8) as mean, count(*) as n from s group by start
""")
def n03(spark, sf):
    def report(s, home):
        return st.collect_batches(st.sliding_mean(s, "1 hour", "15 minutes", "2 hours"), "update", home)

    final = st.latest(replay(spark, sf, report)[-1], "start")
    return final.select(F.date_format("start", HOUR).alias("start"), F.round("mean", 8).alias("mean"), "n")


@query("N04_running_accuracy", """
select user_id, count(*) filter (event_type = 'click')::bigint as hits, count(*) as n, round(avg(case when event_type = 'click' then 1.0 else 0.0 end), 9) as accuracy from events group by user_id
""")
def n04(spark, sf):
    def report(s, home):
        return st.collect_batches(st.running_accuracy(s, "user_id", F.col("event_type") == "click"), "update", home)

    rows = replay(spark, sf, report)[-1]
    final = rows.groupBy("user_id").agg(F.max_by(F.struct("hits", "n", "accuracy"), "n").alias("r"))
    return final.select("user_id", "r.hits", "r.n", F.round("r.accuracy", 9).alias("accuracy"))


@query("N05_moving_mean", """
with r as (select user_id, value, row_number() over (partition by user_id order by ts desc, event_id desc) - 1 as back from events)
select user_id, count(*) as n, round(sum(pow(0.876543211::double, back) * (1 - 0.876543211::double) * value), 6) as moving from r group by user_id
""")
def n05(spark, sf):
    def report(s, home):
        return st.collect_batches(st.moving_mean(s, "user_id", ["ts", "event_id"], "value", 0.876543211, "2 hours"), "update", home)

    m = st.latest(replay(spark, sf, report)[-1], "user_id")
    return m.select("user_id", "n", F.round("moving", 6).alias("moving"))


@query("N06_late_rows", """
with b as (select min(ts) as lo, (max(ts) - min(ts)) / 4 as step from events)
select (select count(*) from events, b where ts >= lo + step) as kept, (select count(*) from events, b where ts < lo + step) as dropped
""")
def n06(spark, sf):
    _, both = replay(spark, sf, lambda s, home: st.late_rows(s, "1 hour", "2 hours", home), late_first=True)[-1]
    return both.withColumnRenamed("late", "dropped")
