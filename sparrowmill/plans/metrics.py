"""Group E: aggregates, losses and evaluation metrics."""

from functools import reduce

from pyspark.sql import functions as F

from sparrowmill.functions import arrays as ar
from sparrowmill.functions import text as tx
from sparrowmill.operators import corpus as cp
from sparrowmill.operators import learn as ml
from sparrowmill.operators import metrics as op
from sparrowmill.operators import series as sr
from sparrowmill.operators.ordering import running
from sparrowmill.operators.sampling import contiguous_folds
from sparrowmill.plans.corpus import MODEL, WORDS
from sparrowmill.plans.fixtures import LOGITS_SQL, PRICE_SQL, RULE_SQL, logits, price, rule
from sparrowmill.plans.registry import list6, query
from sparrowmill.session import spread
from sparrowmill.tables import TABLES, table

E = "e as (select vec_id, label, cast(embedding as double[]) as v from embeddings)"
U = E + ", u as (select vec_id, label, unnest(v) as x, generate_subscripts(v, 1) - 1 as i from e)"


def emb(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", ar.doubles("embedding").alias("v"))


def r(expr, digits, name):
    return (F.round(expr, digits) + 0.0).alias(name)


@query("E01_reduce_rows", f"with {U} select cast(i as int) as i, round(sum(x), 8) + 0.0 as total, round(avg(x), 9) + 0.0 as mean from u group by i")
def e01(spark, sf):
    u = emb(spark, sf).select(F.posexplode("v").alias("i", "x"))
    return u.groupBy("i").agg(r(F.sum("x"), 8, "total"), r(F.avg("x"), 9, "mean"))


@query("E01_reduce_columns", f"""
with {E} select vec_id, round(list_sum(v), 8) + 0.0 as total, {list6('list_transform(v, lambda x: x / list_sum(list_transform(v, lambda y: abs(y))))')} as share from e
""")
def e01_columns(spark, sf):
    size = ar.total(F.transform("v", F.abs))
    share = ar.let(size, lambda s: F.transform("v", lambda x: x / s))
    return emb(spark, sf).select("vec_id", r(ar.total(F.col("v")), 8, "total"), ar.scaled6(share).alias("share"))


@query("E02_product", "select l_orderkey, round(product(1 - l_discount), 9) as p from lineitem group by l_orderkey")
def e02(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.round(F.product(1 - F.col("l_discount")), 9).alias("p"))


@query("E03_accuracy", f"""
with {LOGITS_SQL} select label, count(*) as n, round(avg(case when list_position(z, list_max(z)) - 1 = label then 1.0 else 0.0 end), 9) as accuracy from logits group by label
""")
def e03(spark, sf):
    hit = (ar.argmax(F.col("z")) == F.col("label")).cast("double")
    return logits(spark, sf).groupBy("label").agg(F.count("*").alias("n"), r(F.avg(hit), 9, "accuracy"))


@query("E04_binary_metrics", f"""
with {RULE_SQL}, c as (select lang, count(*) as n, count(*) filter (pred = truth) as ok, count(*) filter (pred = 1 and truth = 1) as tp, count(*) filter (pred = 1 and truth = 0) as fp, count(*) filter (pred = 0 and truth = 1) as fn from rule group by lang)
select lang, round(ok / n, 9) as accuracy, round(tp / nullif(tp + fp, 0), 9) as precision, round(tp / nullif(tp + fn, 0), 9) as recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 9) as f1 from c
""")
def e04(spark, sf):
    m = rule(spark, sf).groupBy("lang").agg(*op.binary_metrics(F.col("pred"), F.col("truth")))
    return m.select("lang", *[F.round(c, 9).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@query("E05_confusion", f"with {RULE_SQL} select truth, pred, count(*) as n from rule group by all")
def e05(spark, sf):
    return rule(spark, sf).groupBy("truth", "pred").agg(F.count("*").alias("n"))


@query("E06_mse", f"with {PRICE_SQL} select round(avg(pow(p - y, 2.0)), 2) as mse from price")
def e06(spark, sf):
    return price(spark, sf).agg(F.round(op.mse(F.col("p"), F.col("y")), 2).alias("mse"))


@query("E07_mae", f"with {PRICE_SQL} select round(avg(abs(p - y)), 5) as mae from price")
def e07(spark, sf):
    return price(spark, sf).agg(F.round(op.mae(F.col("p"), F.col("y")), 5).alias("mae"))


_D = "abs(p - y) / 1000"


@query("E08_smooth_l1", f"""
with {PRICE_SQL}, d as (select {_D} as d from price) select round(avg(case when d < 1 then 0.5 * d * d else d - 0.5 end), 7) as beta_1,
 round(avg(case when d < 5 then d * d * 0.1 else d - 2.5 end), 7) as beta_5, round(avg(case when d < 4 then d * d * 0.125 else d - 2 end), 7) as sigma_half from d
""")
def e08(spark, sf):
    p = price(spark, sf).select((F.col("p") / 1000).alias("p"), (F.col("y") / 1000).alias("y"))
    a, b = F.col("p"), F.col("y")
    return p.agg(r(F.avg(op.smooth_l1_row(a, b)), 7, "beta_1"), r(F.avg(op.smooth_l1_row(a, b, 5.0)), 7, "beta_5"),
                 r(F.avg(op.smooth_l1_sigma_row(a, b, 0.5)), 7, "sigma_half"))


_BCE = "greatest(z, 0) - z * truth + ln(1 + exp(-abs(z)))"


@query("E09_bce_logits", f"with {RULE_SQL} select doc_id, round({_BCE}, 9) as loss, round(avg({_BCE}) over (), 9) as mean_loss from rule")
def e09(spark, sf):
    rows = rule(spark, sf).select("doc_id", op.bce_logits_row(F.col("z"), F.col("truth")).alias("loss"))
    mean = rows.agg(F.avg("loss")).scalar()
    return rows.select("doc_id", F.round("loss", 9).alias("loss"), F.round(mean, 9).alias("mean_loss"))


_CE = "list_max(z) + ln(list_sum(list_transform(z, lambda t: exp(t - list_max(z))))) - z[label + 1]"


@query("E10_cross_entropy", f"with {LOGITS_SQL} select vec_id, round({_CE}, 9) as loss, round(avg({_CE}) over (), 9) as mean_loss from logits")
def e10(spark, sf):
    rows = logits(spark, sf).select("vec_id", op.cross_entropy_row(F.col("z"), F.col("label")).alias("loss"))
    mean = rows.agg(F.avg("loss")).scalar()
    return rows.select("vec_id", F.round("loss", 9).alias("loss"), F.round(mean, 9).alias("mean_loss"))


@query("E11_focal", f"""
with {RULE_SQL}, p as (select lang, truth, 1 / (1 + exp(-z)) as p from rule), t as (select lang, case when truth = 1 then p else 1 - p end as pt from p)
select lang, round(sum(-pow(1 - pt, 2.0) * ln(pt + 1e-10)), 7) as loss from t group by lang
""")
def e11(spark, sf):
    return rule(spark, sf).groupBy("lang").agg(r(F.sum(op.focal_row(F.col("z"), F.col("truth"))), 7, "loss"))


def neighbours(spark, sf):
    """Each vector with the next one; y says whether their labels agree."""
    e = emb(spark, sf)
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("w"), F.col("label").alias("other"))
    return e.join(nxt, "vec_id").select("vec_id", "v", "w", (F.col("label") == F.col("other")).alias("same"))


NEXT = E + ", n as (select a.vec_id, a.v, b.v as w, a.label = b.label as same from e a join e b on b.vec_id = a.vec_id + 1)"
_DOT = "list_sum(list_transform(list_zip({a}, {b}), lambda z: z[1] * z[2]))"
_COS = f"({_DOT.format(a='v', b='w')} / sqrt({_DOT.format(a='v', b='v')} * {_DOT.format(a='w', b='w')}))"


@query("E12_cosine_embedding", f"with {NEXT}, c as (select vec_id, same, {_COS} as c from n) select vec_id, round(case when same then 1 - c else greatest(c - 0.1, 0) end, 8) + 0.0 as loss from c")
def e12(spark, sf):
    n = neighbours(spark, sf)
    y = F.when(F.col("same"), 1).otherwise(-1)
    return n.select("vec_id", r(op.cosine_embedding_row(F.col("v"), F.col("w"), y, 0.1), 8, "loss"))


@query("E13_contrastive", f"""
with {NEXT}, d as (select vec_id, same, sqrt(list_sum(list_transform(list_zip(v, w), lambda z: (z[1] - z[2] + 1e-6) * (z[1] - z[2] + 1e-6)))) as d from n)
select vec_id, round(case when same then d * d else pow(greatest(1.5 - d, 0), 2.0) end, 8) as loss from d
""")
def e13(spark, sf):
    n = neighbours(spark, sf)
    return n.select("vec_id", r(op.contrastive_row(F.col("v"), F.col("w"), F.col("same").cast("int"), 1.5), 8, "loss"))


@query("E14_log_rmse", f"with {PRICE_SQL} select round(sqrt(avg(pow(ln(greatest(p, 1)) - ln(y), 2.0))), 9) as log_rmse from price")
def e14(spark, sf):
    return price(spark, sf).agg(r(op.log_rmse(F.col("p"), F.col("y")), 9, "log_rmse"))


@query("E15_weighted_loss", f"with {PRICE_SQL} select round(avg(l_quantity * abs(p - y)), 4) as l1, round(avg(l_quantity * pow((p - y) / 1000, 2.0)), 6) as l2 from price")
def e15(spark, sf):
    w, p, y = F.col("l_quantity"), F.col("p"), F.col("y")
    return price(spark, sf).agg(r(F.avg(w * F.abs(p - y)), 4, "l1"), r(F.avg(w * F.pow((p - y) / 1000, F.lit(2.0))), 6, "l2"))


@query("E16_masked_loss", f"""
with c as (select conv_id, turn, list_transform({WORDS.format(c='text')}, lambda w: ln(1.0 + length(w))) as l from conversations), s as (select conv_id, turn, coalesce(list_sum(l), 0) as s, len(l) as n from c)
select conv_id, turn, round(s / (n + 8), 9) as padded_mean, round(s / greatest(n, 1), 9) as valid_mean from s
""")
def e16(spark, sf):
    losses = F.transform(tx.words(F.col("text")), lambda w: F.log(1.0 + F.length(w)))
    c = table(spark, sf, "conversations").select("conv_id", "turn", losses.alias("l"))
    c = c.select("conv_id", "turn", F.size("l").alias("n"), F.concat("l", F.array_repeat(F.lit(5.0), 8)).alias("l"))
    m = lambda how: op.masked_mean(F.col("l"), F.col("n"), how)
    return c.select("conv_id", "turn", r(m("padded"), 9, "padded_mean"), r(m("valid"), 9, "valid_mean"))


@query("E17_perplexity", f"""
with {MODEL} select p.lang, count(*) as n, round(exp(-sum(ln(m.p_smooth)) / count(*)), 6) as perplexity from pairs p join model m on p.w1 = m.w1 and p.w2 = m.w2 group by p.lang
""")
def e17(spark, sf):
    p = cp.perplexity(spread(table(spark, sf, "documents")), tx.words(F.col("text")), "lang", 2.0)
    return p.select("lang", "n", r("perplexity", 6, "perplexity"))


@query("E18_label_score", f"""
with {PRICE_SQL}, d as (select abs((p * 2.0 - 3) - (y * 2.0 - 3)) as d from price) select round(avg(d), 4) as ls_mean, round(stddev_pop(d), 4) as ls_std from d
""")
def e18(spark, sf):
    s = price(spark, sf).agg(*op.label_score(F.col("p"), F.col("y"), 2.0, -3.0))
    return s.select(F.round("ls_mean", 4).alias("ls_mean"), F.round("ls_std", 4).alias("ls_std"))


@query("E19_moments", f"""
with {U} select cast(a.i as bigint) as i, cast(b.i as bigint) as j, round(avg(a.x), 9) + 0.0 as mean_i, round(covar_samp(a.x, b.x), 9) + 0.0 as cov from u a join u b on a.vec_id = b.vec_id and a.i <= b.i group by all
""")
def e19(spark, sf):
    c = op.covariance(emb(spark, sf), F.col("v"))
    return c.select("i", "j", r("mean_i", 9, "mean_i"), r("cov", 9, "cov"))


@query("E20_frechet")
def e20(spark, sf):
    e = emb(spark, sf)
    d = op.frechet(e.filter("label < 5"), e.filter("label >= 5"), F.col("v"))
    return spark.createDataFrame([(round(d, 8),)], "distance double")


@query("E20_frechet_diagonal", f"""
with {U}, m as (select i, avg(x) filter (label < 5) as m1, avg(x) filter (label >= 5) as m2, stddev_samp(x) filter (label < 5) as s1, stddev_samp(x) filter (label >= 5) as s2 from u group by i)
select round(sum((m1 - m2) * (m1 - m2) + (s1 - s2) * (s1 - s2)), 8) as distance from m
""")
def e20_diagonal(spark, sf):
    e = emb(spark, sf)
    return op.frechet_diagonal(e.filter("label < 5"), e.filter("label >= 5"), F.col("v")).select(F.round("distance", 8).alias("distance"))


@query("E21_inception_score", f"""
with {LOGITS_SQL}, q as (select vec_id, list_transform(z, lambda t: exp(t - list_max(z))) as x from logits),
p as (select list_transform(x, lambda t: t / list_sum(x)) as p, (row_number() over (order by vec_id) - 1) // (select count(*) // 7 from embeddings) as split from q),
u as (select split, unnest(p) as p, generate_subscripts(p, 1) as c from p where split < 7), m as (select split, c, avg(p) as m, count(*) as n from u group by split, c),
s as (select u.split, exp(sum(u.p * ln(u.p / m.m)) / any_value(m.n)) as score from u join m using (split, c) group by u.split)
select round(avg(score), 9) as is_mean, round(stddev_pop(score), 9) as is_std from s
""")
def e21(spark, sf):
    p = logits(spark, sf).select("vec_id", ar.softmax(F.col("z")).alias("p"))
    s = op.inception_score(p, ["vec_id"], "p", 7)
    return s.select(F.round("is_mean", 9).alias("is_mean"), F.round("is_std", 9).alias("is_std"))


@query("E22_gram", f"""
with {U} select a.label, cast(a.i as bigint) as i, cast(b.i as bigint) as j, round(sum(a.x * b.x) / (64 * count(*)), 9) + 0.0 as g from u a join u b on a.vec_id = b.vec_id and a.i <= b.i group by all
""")
def e22(spark, sf):
    return op.gram(emb(spark, sf), F.col("v"), 64, by=["label"]).select("label", "i", "j", r("g", 9, "g"))


@query("E23_total_variation", """
with d as (select user_id, abs(value - lag(value) over (partition by user_id order by ts, event_id)) as d from events) select user_id, round(avg(d) * 0.5, 8) as tv from d group by user_id
""")
def e23(spark, sf):
    t = sr.total_variation(table(spark, sf, "events").select("event_id", "user_id", "ts", "value"), ["user_id"], ["ts", "event_id"], "value")
    return t.select("user_id", F.round("tv", 8).alias("tv"))


@query("E24_histogram", """
select l_returnflag, cast(least(floor((l_quantity - 1) / ((50.0::double - 1) / 10)), 9) as bigint) as bin, count(*) as n from lineitem group by all
""")
def e24(spark, sf):
    return op.histogram(table(spark, sf, "lineitem"), F.col("l_quantity"), 10, 1.0, 50.0, by=["l_returnflag"])


@query("E25_norms", f"""
with {E} select vec_id, cast(len(list_filter(v, lambda x: x <> 0)) as double) as l0, round(list_sum(list_transform(v, lambda x: abs(x))), 8) as l1, round(sqrt(list_sum(list_transform(v, lambda x: x * x))), 8) as l2,
 round(pow(list_sum(list_transform(v, lambda x: pow(abs(x), 3.0))), 1 / 3.0::double), 8) as l3, round(list_max(list_transform(v, lambda x: abs(x))), 8) as linf from e
""")
def e25(spark, sf):
    v = F.col("v")
    named = [(0, "l0"), (1, "l1"), (2, "l2"), (3, "l3"), (float("inf"), "linf")]
    return emb(spark, sf).select("vec_id", *[F.round(ar.norm(v, p), 8).alias(n) for p, n in named])


_L2 = "sqrt(list_sum(list_transform(v, lambda y: y * y)))"


@query("E26_clip_norm", f"""
with {E}, w as (select sqrt(sum(list_sum(list_transform(v, lambda y: y * y)))) as w from e)
select vec_id, {list6(f'list_transform(v, lambda x: x * least(1.0, 0.9 / {_L2}))')} as by_row, {list6('list_transform(v, lambda x: x * least(1.0, 10.0 / w))')} as by_all from e, w
""")
def e26(spark, sf):
    e = emb(spark, sf)
    whole = e.agg(F.sqrt(F.sum(ar.dot(F.col("v"), F.col("v"))))).scalar()
    return e.withColumn("_whole", whole).select(
        "vec_id", ar.scaled6(ar.clip_to_norm(F.col("v"), 0.9)).alias("by_row"),
        ar.scaled6(ar.clip_to_norm(F.col("v"), 10.0, F.col("_whole"))).alias("by_all"),
    )


@query("E27_throughput", """
with s as (select event_type, count(*) as samples, sum(octet_length(encode(props)))::bigint as bytes, sum(value) as seconds, arg_min(value, ts) as first_seconds from events group by event_type)
select event_type, samples, bytes, round(seconds, 2) as seconds, round(samples / seconds, 9) as per_second, round(bytes / (1048576.0::double * seconds), 12) as mb_per_second, first_seconds from s
""")
def e27(spark, sf):
    t = op.throughput(table(spark, sf, "events"), ["event_type"], F.lit(1), F.octet_length("props"), F.col("value"), F.col("ts"))
    return t.select("event_type", "samples", "bytes", F.round("seconds", 2).alias("seconds"), F.round("per_second", 9).alias("per_second"),
                    F.round("mb_per_second", 12).alias("mb_per_second"), "first_seconds")


@query("E28_grade", """
with s as (select user_id, sum(value) / count(*) * 30 as speed from events group by user_id) select user_id, round(speed, 6) as speed,
 case when speed > 1000 then 'excellent' when speed > 500 then 'good' when speed > 200 then 'fair' else 'slow' end as grade from s
""")
def e28(spark, sf):
    s = table(spark, sf, "events").groupBy("user_id").agg((F.sum("value") / F.count("*") * 30).alias("speed"))
    return s.select("user_id", F.round("speed", 6).alias("speed"), op.grade(F.col("speed")).alias("grade"))


@query("E29_linear_fit", "select l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) as slope, round(regr_intercept(l_extendedprice, l_quantity), 5) as intercept, count(*) as n from lineitem group by all")
def e29(spark, sf):
    f = op.linear_fit(table(spark, sf, "lineitem"), F.col("l_quantity"), F.col("l_extendedprice"), ["l_returnflag"])
    return f.select("l_returnflag", F.round("slope", 6).alias("slope"), F.round("intercept", 5).alias("intercept"), "n")


@query("E30_softmax_fit")
def e30(spark, sf):
    e = emb(spark, sf)
    model = ml.softmax_fit(e, "v", "label")
    return ml.softmax_report(model, e, "v", "label")


@query("E30_softmax_balance", "select label, count(*) as n, cast(count(*) as double) as expected from embeddings group by label")
def e30_balance(spark, sf):
    """At the best fit the probabilities of a class add up to its rows."""
    e = emb(spark, sf)
    model = ml.softmax_fit(e, "v", "label", steps=500, reg=0.05, tol=1e-10)
    return ml.softmax_balance(model, e, "v", "label").select("label", "n", r("expected", 2, "expected"))


_FOLD_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"]


_FOLDS_SQL = f"""
r as (select l_quantity as x, l_extendedprice as y, (row_number() over (order by {', '.join(_FOLD_ORDER)}) - 1) // (select count(*) // 5 from lineitem) as fold from lineitem),
k as (select * from r where fold < 5), f as (select g.fold, regr_slope(k.y, k.x) as a, regr_intercept(k.y, k.x) as b from (select distinct fold from k) g join k on k.fold <> g.fold group by g.fold),
errors as (select f.fold, any_value(a) as slope, any_value(b) as intercept, sqrt(avg(pow(y - a * x - b, 2.0)) filter (k.fold <> f.fold)) as train_rmse,
 sqrt(avg(pow(y - a * x - b, 2.0)) filter (k.fold = f.fold)) as valid_rmse from f, k group by f.fold)
"""


def _fold_errors(spark, sf):
    li = table(spark, sf, "lineitem").select(*_FOLD_ORDER)
    return op.kfold_line_errors(contiguous_folds(li, _FOLD_ORDER, 5), F.col("l_quantity"), F.col("l_extendedprice"))


@query("E31_kfold_means", f"with {_FOLDS_SQL} select count(*) as folds, round(avg(train_rmse), 4) as train_rmse, round(avg(valid_rmse), 4) as valid_rmse from errors")
def e31_means(spark, sf):
    m = op.fold_means(_fold_errors(spark, sf))
    return m.select("folds", *[F.round(c, 4).alias(c) for c in ("train_rmse", "valid_rmse")])


@query("E31_kfold_error", f"""
with {_FOLDS_SQL} select fold, round(slope, 5) as slope, round(intercept, 4) as intercept, round(train_rmse, 4) as train_rmse, round(valid_rmse, 4) as valid_rmse from errors
""")
def e31(spark, sf):
    k = _fold_errors(spark, sf)
    return k.select("fold", F.round("slope", 5).alias("slope"), *[F.round(c, 4).alias(c) for c in ("intercept", "train_rmse", "valid_rmse")])


@query("E32_counts", " union all ".join(f"select '{t}' as name, count(*) as n from {t}" for t in TABLES))
def e32(spark, sf):
    one = [table(spark, sf, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("name"), "n") for t in TABLES]
    return reduce(lambda a, b: a.unionByName(b), one)


@query("E32_split_counts", """
with s as (select case doc_id % 10 when 0 then 'test' when 1 then 'val' else 'train' end as split, doc_id from documents)
select split, count(*) as n, count(distinct doc_id) as n_distinct from s group by split union all select 'total', count(*), count(distinct doc_id) from s
""")
def e32_splits(spark, sf):
    k = F.col("doc_id") % 10
    named = table(spark, sf, "documents").withColumn("split", F.when(k == 0, "test").when(k == 1, "val").otherwise("train"))
    return op.split_counts(named, "split", "doc_id")


@query("E33_best_row", "select event_type, max(value) as best, arg_max(event_id, (value, -event_id)) as event_id from events group by event_type")
def e33(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(
        F.max("value").alias("best"), F.max_by("event_id", F.struct("value", -F.col("event_id"))).alias("event_id")
    )


@query("E33_record_so_far", """
with b as (select event_id, event_type, value, max(value) over (partition by event_type order by ts, event_id rows between unbounded preceding and current row) as best,
 max(value) over (partition by event_type order by ts, event_id rows between unbounded preceding and 1 preceding) as before from events)
select event_id, event_type, best, value > coalesce(before, value - 1) as is_record from b
""")
def e33_record(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    b = running(e, ["event_type"], ["ts", "event_id"], {"best": ("max", F.col("value")), "before": ("max_before", F.col("value"))})
    return b.select("event_id", "event_type", "best", (F.col("before").isNull() | (F.col("value") > F.col("before"))).alias("is_record"))
