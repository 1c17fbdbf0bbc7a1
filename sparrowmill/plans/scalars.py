"""Group I: scalar and array functions."""

from pyspark.sql import functions as F

from sparrowmill.functions import arrays as ar
from sparrowmill.functions import scalars as sc
from sparrowmill.functions import text as tx
from sparrowmill.plans.corpus import DOC_WORDS
from sparrowmill.plans.fixtures import LOGITS_SQL, logits
from sparrowmill.plans.registry import list6, query
from sparrowmill.tables import table

V = "cast(embedding as double[])"
E = "e as (select vec_id, label, cast(embedding as double[]) as v from embeddings)"


def docs(spark, sf):
    return table(spark, sf, "documents")


def emb(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", ar.doubles("embedding").alias("v"))


def digest(name, sql, fn):
    """A text function over every document, compared by the md5 of the whole result."""

    @query(name, f"select doc_id, md5({sql}) as digest, cast(length({sql}) as int) as len from documents")
    def run(spark, sf):
        out = fn(F.col("text"))
        return docs(spark, sf).select("doc_id", F.md5(out).alias("digest"), F.length(out).alias("len"))

    return run


digest("I01_clean", "trim(regexp_replace(lower(text), '\\s+', ' ', 'g'))", tx.clean_line)
digest("I02_letters", "regexp_replace(text, '[^A-Za-z]+', ' ', 'g')", tx.letters_only)
digest(
    "I03_space_punct",
    "regexp_replace(regexp_replace(lower(replace(replace(text, chr(160), ' '), chr(8239), ' ')), '([^ ])([,!.])', '\\1 \\2', 'g'), '([^ ])([,!.])', '\\1 \\2', 'g')",
    tx.space_punctuation,
)


@query("I04_ellipsis", """
select doc_id, case when length(text) > 30 then left(text, 30) || '...' else text end as t30, case when length(text) > 80 then left(text, 80) || '...' else text end as t80 from documents
""")
def i04(spark, sf):
    t = F.col("text")
    return docs(spark, sf).select("doc_id", tx.ellipsis(t, 30).alias("t30"), tx.ellipsis(t, 80).alias("t80"))


@query("I05_arith", """
select l_returnflag, round(sum(l_quantity + l_tax), 4) as plus, round(sum(l_quantity - l_tax), 4) as minus, round(sum(l_extendedprice * l_discount), 3) as times,
 round(sum(l_extendedprice / l_quantity), 3) as over, round(sum(pow(l_quantity, 2.0)), 4) as power, round(sum(exp(l_discount)), 4) as expo from lineitem group by all
""")
def i05(spark, sf):
    q, x, d, p = F.col("l_quantity"), F.col("l_tax"), F.col("l_discount"), F.col("l_extendedprice")
    s = lambda c, n, name: F.round(F.sum(c), n).alias(name)
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        s(q + x, 4, "plus"), s(q - x, 4, "minus"), s(p * d, 3, "times"), s(p / q, 3, "over"),
        s(F.pow(q, F.lit(2.0)), 4, "power"), s(F.exp(d), 4, "expo"),
    )


@query("I06_softmax", f"""
with {LOGITS_SQL}, x as (select vec_id, list_transform(z, lambda t: exp(t - list_max(z))) as x from logits)
select vec_id, {list6('list_transform(x, lambda t: t / list_sum(x))')} as p from x
""")
def i06(spark, sf):
    return logits(spark, sf).select("vec_id", ar.scaled6(ar.softmax(F.col("z"))).alias("p"))


@query("I07_activations", f"""
with {E} select vec_id, {list6('list_transform(v, lambda x: 1.0 / (1.0 + exp(-x)))')} as sigmoid, {list6('list_transform(v, lambda x: greatest(x, 0.0))')} as relu,
 {list6('list_transform(v, lambda x: case when x > 0 then x else x * 0.01::double end)')} as leaky from e
""")
def i07(spark, sf):
    f = lambda fn: ar.scaled6(F.transform("v", lambda x: fn(x)))
    return emb(spark, sf).select(
        "vec_id", f(ar.sigmoid).alias("sigmoid"), f(ar.relu).alias("relu"), f(ar.leaky_relu).alias("leaky")
    )


@query("I08_margins", f"""
with {E} select vec_id, {list6('list_transform(v, lambda x: 2 * abs(1.0 / (1.0 + exp(-x)) - 0.5))')} as p_margin, {list6('list_transform(v, lambda x: abs(x))')} as z_margin from e
""")
def i08(spark, sf):
    e = emb(spark, sf)
    return e.select(
        "vec_id", ar.scaled6(F.transform("v", lambda x: sc.probability_margin(ar.sigmoid(x)))).alias("p_margin"),
        ar.scaled6(F.transform("v", F.abs)).alias("z_margin"),
    )


@query("I09_poly", f"""
with d as (select distinct l_discount as x from lineitem)
select x, {list6('list_transform(range(0, 6), lambda i: pow(x, i) / factorial(cast(greatest(i - 1, 0) as int)))')} as by_gamma,
 {list6('list_transform(range(0, 6), lambda i: pow(x, i) / factorial(cast(i as int)))')} as by_factorial from d
""")
def i09(spark, sf):
    d = table(spark, sf, "lineitem").select(F.col("l_discount").alias("x")).distinct()
    return d.select(
        "x", ar.scaled6(sc.polynomial(F.col("x"), 5)).alias("by_gamma"),
        ar.scaled6(sc.polynomial(F.col("x"), 5, "factorial")).alias("by_factorial"),
    )


_FREQ = "exp(i * (-(ln(10000.0) / 7)))"


@query("I10_sinusoid", f"""
with h as (select event_id, cast(date_part('hour', ts) as double) as h from events)
select event_id, {list6(f'list_concat(list_transform(range(0, 8), lambda i: sin(h * {_FREQ})), list_transform(range(0, 8), lambda i: cos(h * {_FREQ})))')} as emb from h
""")
def i10(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.hour("ts").cast("double").alias("h"))
    return ev.select("event_id", ar.scaled6(sc.sinusoid(F.col("h"), 16)).alias("emb"))


@query("I11_layer_norm", f"""
with {E}, m as (select vec_id, v, list_sum(v) / 64 as mu from e), c as (select vec_id, list_transform(v, lambda x: x - mu) as c from m)
select vec_id, {list6('list_transform(c, lambda x: x / sqrt(list_sum(list_transform(c, lambda y: y * y)) / 64 + 1e-6))')} as v from c
""")
def i11(spark, sf):
    return emb(spark, sf).select("vec_id", ar.scaled6(ar.layer_norm(F.col("v"))).alias("v"))


@query("I12_normalize", f"""
with {E}, p as (select vec_id, list_transform(v, lambda x: floor(greatest(least(x * 300 + 128, 255), 0))) as p from e)
select vec_id, {list6('list_transform(p, lambda x: x / 127.5 - 1)')} as unit,
 {list6('list_transform(p, lambda x, i: (x / 255.0 - [0.485, 0.456, 0.406, 0.5][(i - 1) // 16 + 1]) / [0.229, 0.224, 0.225, 0.25][(i - 1) // 16 + 1])')} as channel from p
""")
def i12(spark, sf):
    px = F.transform("v", lambda x: F.floor(F.greatest(F.least(x * 300 + 128, F.lit(255.0)), F.lit(0.0))).cast("double"))
    p = emb(spark, sf).select("vec_id", px.alias("p"))
    return p.select(
        "vec_id", ar.scaled6(sc.to_unit_range(F.col("p"))).alias("unit"),
        ar.scaled6(sc.channel_normalize(F.col("p"), 16, sc.CHANNEL_MEAN + (0.5,), sc.CHANNEL_STD + (0.25,))).alias("channel"),
    )


@query("I13_dot_mv", f"""
with {E}, n as (select a.vec_id, a.v as av, b.v as bv from e a join e b on b.vec_id = a.vec_id + 1)
select vec_id, round(list_sum(list_transform(list_zip(av, bv), lambda z: z[1] * z[2])), 9) + 0.0 as dot,
 {list6('list_transform(range(0, 8), lambda r: list_sum(list_transform(range(1, 9), lambda c: av[r * 8 + c] * bv[c])))')} as mv from n
""")
def i13(spark, sf):
    e = emb(spark, sf)
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("w"))
    both = e.join(nxt, "vec_id")
    mv = sc.matrix_vector(F.col("v"), F.slice("w", 1, 8), 8, 8)
    return both.select("vec_id", (F.round(ar.dot(F.col("v"), F.col("w")), 9) + 0.0).alias("dot"), ar.scaled6(mv).alias("mv"))


@query("I13_matmul", """
with a as (select o_custkey as i, o_orderpriority as k, sum(o_totalprice) as v from orders group by all),
b as (select o_orderpriority as k, o_orderstatus as j, count(*) as v from orders group by all)
select a.i, b.j, round(sum(a.v * b.v), 2) as v from a join b using (k) group by all
""")
def i13_mm(spark, sf):
    o = table(spark, sf, "orders")
    a = o.groupBy(F.col("o_custkey").alias("i"), F.col("o_orderpriority").alias("k")).agg(F.sum("o_totalprice").alias("v"))
    b = o.groupBy(F.col("o_orderpriority").alias("k"), F.col("o_orderstatus").alias("j")).agg(F.count("*").alias("v"))
    return sc.matmul(a, b).select("i", "j", F.round("v", 2).alias("v"))


@query("I14_slice_tile", f"""
with {E} select vec_id, {list6('v[5:12]')} as part, {list6('list_concat(v, v, v)')} as tiled, {list6('list_concat(v[1:32], v[49:64])')} as joined from e
""")
def i14(spark, sf):
    return emb(spark, sf).select(
        "vec_id", ar.scaled6(F.slice("v", 5, 8)).alias("part"), ar.scaled6(F.flatten(F.array_repeat("v", 3))).alias("tiled"),
        ar.scaled6(F.concat(F.slice("v", 1, 32), F.slice("v", 49, 16))).alias("joined"),
    )


@query("I15_transpose", f"""
with {E} select vec_id, {list6('list_transform(range(0, 64), lambda p: v[(p % 4) * 16 + p // 4 + 1])')} as hwc from e
""")
def i15(spark, sf):
    return emb(spark, sf).select("vec_id", ar.scaled6(ar.transpose(F.col("v"), (4, 4, 4), (1, 2, 0))).alias("hwc"))


@query("I16_pad", f"""
select doc_id, md5(array_to_string(list_resize(w[1:100], 100, '<pad>'), ' ')) as digest from (select doc_id, {DOC_WORDS} as w from documents)
""")
def i16(spark, sf):
    return docs(spark, sf).select("doc_id", F.md5(F.array_join(ar.pad(tx.words(F.col("text")), 100, "<pad>"), " ")).alias("digest"))


@query("I17_one_hot", f"""
select vec_id, array_to_string(list_transform(range(0, 10), lambda j: case when j = label then 1 else 0 end), ',') as hot from embeddings
""")
def i17(spark, sf):
    return emb(spark, sf).select("vec_id", F.array_join(ar.one_hot(F.col("label"), 10).cast("array<string>"), ",").alias("hot"))


@query("I18_seq_mask", f"""
select doc_id, md5(array_to_string(list_transform(w, lambda x, i: case when i <= n_chars % 50 then x else '<mask>' end), ' ')) as digest
from (select doc_id, n_chars, {DOC_WORDS} as w from documents)
""")
def i18(spark, sf):
    masked = ar.mask_after(tx.words(F.col("text")), F.col("n_chars") % 50, "<mask>")
    return docs(spark, sf).select("doc_id", F.md5(F.array_join(masked, " ")).alias("digest"))


@query("I19_masked_softmax", f"""
with {LOGITS_SQL}, k as (select vec_id, label + 1 as n, z, list_max(z[1:label + 1]) as top from logits),
s as (select *, list_sum(list_transform(z[1:n], lambda t: exp(t - top))) as d from k)
select vec_id, {list6('list_transform(z, lambda t, i: case when i <= n then exp(t - top) / d else 0.0 end)')} as p from s
""")
def i19(spark, sf):
    z = logits(spark, sf)
    return z.select("vec_id", ar.scaled6(ar.masked_softmax(F.col("z"), F.col("label") + 1)).alias("p"))


@query("I20_hour_key", "select strftime(ts, '%Y%m%d%H') as hour_key, count(*) as n from events group by all")
def i20(spark, sf):
    return table(spark, sf, "events").groupBy(sc.hour_key(F.col("ts")).alias("hour_key")).agg(F.count("*").alias("n"))


@query("I21_json_get", "select event_id, cast(json_extract_string(props, '$.k') as int) as k, json_extract_string(props, '$.missing') as missing from events")
def i21(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), F.get_json_object("props", "$.missing").alias("missing")
    )


@query("I22_vocab_map", """
with v as (select lang, row_number() over (order by lang) - 1 as id from (select distinct lang from documents))
select (select string_agg(lang || '=' || id, ',' order by lang) from v) as vocab, count(*) as n_langs from v
""")
def i22(spark, sf):
    m = sc.vocab_map(docs(spark, sf), "lang")
    entries = F.array_sort(F.transform(F.map_entries("vocab"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return m.select(F.array_join(entries, ",").alias("vocab"), F.size("vocab").cast("bigint").alias("n_langs"))


@query("I22_vocab_pages", """
with v as (select p_name as v, row_number() over (order by p_name) - 1 as i from (select distinct p_name from part))
select cast(i // 7 as bigint) as page, string_agg(v || '=' || i, ',' order by v) as vocab from v group by 1
""")
def i22_pages(spark, sf):
    m = sc.vocab_pages(table(spark, sf, "part"), "p_name", 7)
    entries = F.transform(F.array_sort(F.map_entries("vocab")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return m.select("page", F.array_join(entries, ",").alias("vocab"))


@query("I23_solve", """
with s as (select regr_slope(l_extendedprice, l_quantity) as b, regr_intercept(l_extendedprice, l_quantity) as a from lineitem)
select 'bias' as term, round(a, 4) as weight from s union all select 'l_quantity', round(b, 4) from s
""")
def i23(spark, sf):
    w = sc.normal_solve(table(spark, sf, "lineitem"), ["l_quantity"], "l_extendedprice")
    return w.select("term", F.round("weight", 4).alias("weight"))


@query("I23_solve_residual", """
select count(*) as n, 0.0::double as bias, 0.0::double as l_quantity, 0.0::double as l_discount, 0.0::double as l_tax from lineitem
""")
def i23_residual(spark, sf):
    """What defines the solution: residuals add up to 0, also against each feature."""
    li = table(spark, sf, "lineitem")
    features = ["l_quantity", "l_discount", "l_tax"]
    w = {r["term"]: r["weight"] for r in sc.normal_solve(li, features, "l_extendedprice").collect()}  # one per feature
    left = F.col("l_extendedprice") - w["bias"] - sum((F.col(f) * w[f] for f in features), F.lit(0.0))
    size = F.sqrt(F.sum(left * left))
    sums = [(F.round(F.sum(left * x) / size / F.sqrt(F.sum(x * x)), 6) + 0.0).alias(n) for n, x in (("bias", F.lit(1.0)), *((f, F.col(f)) for f in features))]
    return li.agg(F.count("*").alias("n"), *sums)


@query("I23_solve_many")
def i23_many(spark, sf):
    w = sc.normal_solve(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    return w.select("term", F.round("weight", 4).alias("weight"))
