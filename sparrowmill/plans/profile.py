"""Group B: schema, profiles, reconciliation."""

from functools import reduce

from pyspark.sql import functions as F

from sparrowmill.functions import text as tx
from sparrowmill.operators import profile as op
from sparrowmill.plans.registry import query, rand_sql
from sparrowmill.tables import table

_REQUIRED = ("o_orderkey", "o_custkey", "o_comment", "o_totalprice", "o_clerk")


@query("B01_check_fields", """
select 'o_orderkey' as field, true as present, count(o_orderkey) as filled from orders union all select 'o_custkey', true, count(o_custkey) from orders
union all select 'o_comment', false, 0 from orders group by 2 union all select 'o_totalprice', true, count(o_totalprice) from orders union all select 'o_clerk', false, 0 from orders group by 2
""")
def b01(spark, sf):
    return op.check_fields(table(spark, sf, "orders"), list(_REQUIRED))


@query("B02_build_schema", """
select cast(p_partkey as int) as p_partkey, p_name, cast(p_size as int) as p_size, cast(p_retailprice as float)::double as p_retailprice,
 cast(cast(p_size as float) + cast(p_retailprice as float) as double) as xy_sum from part
""")
def b02(spark, sf):
    p = table(spark, sf, "part").withColumn("xy", F.array("p_size", "p_retailprice"))
    typed = op.apply_schema(p, {"p_partkey": "int32", "p_name": "string", "p_size": "int8", "p_retailprice": "float32", "xy": "float32_2"})
    return typed.select("p_partkey", "p_name", "p_size", F.col("p_retailprice").cast("double"), (F.col("xy")[0] + F.col("xy")[1]).cast("double").alias("xy_sum"))


@query("B03_decode_bytes", "select doc_id, md5(text) as digest, length(text) as len from documents")
def b03(spark, sf):
    raw = table(spark, sf, "documents").withColumn("raw", F.col("text").cast("binary"))
    text = tx.decode_utf8(F.col("raw"))
    return raw.select("doc_id", F.md5(text).alias("digest"), F.length(text).cast("bigint").alias("len"))


@query("B04_profile", """
with h as (select * from documents order by doc_id limit 3), s as (select 'doc_id' as field, 'bigint' as dtype, doc_id as k, doc_id::varchar as v from h
 union all select 'text', 'string', doc_id, case when length(text) > 50 then left(text, 50) || '...' else text end from h union all select 'lang', 'string', doc_id, lang from h
 union all select 'source', 'string', doc_id, source from h union all select 'n_chars', 'bigint', doc_id, n_chars::varchar from h)
select field, dtype, (select count(*) from documents) as rows, (select count(text) from documents) as filled, string_agg(v, '|' order by k) as samples from s group by field, dtype
""")
def b04(spark, sf):
    return op.profile(table(spark, sf, "documents"), "doc_id").withColumn("samples", F.array_join("samples", "|"))


@query("B04_profile_arrays", """
with h as (select * from embeddings order by vec_id limit 3), s as (select 'vec_id' as field, 'bigint' as dtype, vec_id as k, vec_id::varchar as v from h
 union all select 'label', 'int', vec_id, label::varchar from h union all select 'embedding', 'array<float>', vec_id, array_to_string(list_transform(embedding[1:5], lambda x: printf('%.2f', x::double)), ', ') || ', ...' from h)
select field, dtype, (select count(*) from embeddings) as rows, (select count(embedding) from embeddings) as filled, string_agg(v, '|' order by k) as samples from s group by field, dtype
""")
def b04_arrays(spark, sf):
    return op.profile(table(spark, sf, "embeddings"), "vec_id").withColumn("samples", F.array_join("samples", "|"))


@query("B05_format_size", """
with s as (select doc_id, n_chars * n_chars * 1000.0::double as size from documents) select doc_id, case when size >= 1e12 then printf('%.2f TB', size / 1e12) when size >= 1e9 then printf('%.2f GB', size / 1e9)
 when size >= 1e6 then printf('%.2f MB', size / 1e6) else printf('%.2f KB', size / 1e3) end as label from s
""")
def b05(spark, sf):
    size = (F.col("n_chars") * F.col("n_chars")).cast("double") * 1000.0
    return table(spark, sf, "documents").select("doc_id", tx.human_size(size).alias("label"))


@query("B06_record_view", """
with h as (select * from part order by p_partkey limit 5) select p_partkey, 'p_name' as field, p_name as value from h union all select p_partkey, 'p_brand', p_brand from h
 union all select p_partkey, 'p_type', p_type from h union all select p_partkey, 'p_size', p_size::varchar from h union all select p_partkey, 'p_retailprice', p_retailprice::varchar from h
""")
def b06(spark, sf):
    return op.record_view(table(spark, sf, "part"), "p_partkey", 5)


@query("B07_payload_kind", """
with p as (select 'page' as src, html as t from pages union all select 'event', props from events union all select 'doc', text from documents)
select src, case when t like '<!DO%' then 'html_text' when t like '{%' then 'json_text' else 'unknown' end as kind, count(*) as n from p group by all
""")
def b07(spark, sf):
    page = table(spark, sf, "pages").select(F.lit("page").alias("src"), F.col("html").cast("binary").alias("b"))
    event = table(spark, sf, "events").select(F.lit("event").alias("src"), F.col("props").cast("binary").alias("b"))
    doc = table(spark, sf, "documents").select(F.lit("doc").alias("src"), F.col("text").cast("binary").alias("b"))
    both = page.unionByName(event).unionByName(doc)
    return both.groupBy("src", op.payload_kind(F.col("b")).alias("kind")).agg(F.count("*").alias("n"))


@query("B07_payload_field", """
select 'html' as name, 'bytes' as field, count(*) as n, cast(sum(octet_length(encode(html))) as bigint) as size from pages union all
select 'page', 'struct.encoded', count(*), cast(sum(octet_length(encode(html))) as bigint) from pages union all
select 'embedding', 'array', count(embedding), cast(sum(len(embedding)) as bigint) from embeddings union all
select 'url', 'refused', count(*), null from pages
""")
def b07_field(spark, sf):
    """The payload of columns of each kind, found by their type and read from there."""
    pages, vectors = table(spark, sf, "pages"), table(spark, sf, "embeddings")
    raw = F.col("html").cast("binary")
    frames = [(pages.select(raw.alias("html")), "html"), (pages.select(F.struct("page_id", raw.alias("encoded")).alias("page")), "page"),
              (vectors, "embedding"), (pages, "url")]
    told = []
    for df, name in frames:
        try:
            field, payload = op.payload_field(df, name), op.payload(df, name)
        except ValueError:
            told.append(df.agg(F.lit(name).alias("name"), F.lit("refused").alias("field"), F.count("*").alias("n"), F.lit(None).cast("bigint").alias("size")))
            continue
        size = F.size(payload) if field == "array" else F.octet_length(payload)
        told.append(df.agg(F.lit(name).alias("name"), F.lit(field).alias("field"), F.count(payload).alias("n"), F.sum(size.cast("bigint")).alias("size")))
    return reduce(lambda a, b: a.unionByName(b), told)


@query("B08_preview", f"select doc_id, lang, source from documents order by {rand_sql('doc_id', seed=8)}, doc_id limit 12")
def b08(spark, sf):
    return op.preview(table(spark, sf, "documents"), "doc_id", 12, 8).select("doc_id", "lang", "source")


@query("B09_reconcile", """
with b as (select vec_id, case when label = 3 then 4 else label end as label, list_transform(embedding, lambda x: case when label = 5 then x + 0.01 else x + 0.0000001 end) as embedding from embeddings where label <> 9)
select count(*) as rows_a, (select count(*) from b) as rows_b, count(*) filter (b.vec_id is null) as only_a, 0::bigint as only_b,
 count(*) filter (b.label <> a.label) as discrete_diff, count(*) filter (a.label = 5) as array_diff from embeddings a left join b using (vec_id)
""")
def b09(spark, sf):
    a = table(spark, sf, "embeddings")
    moved = F.transform("embedding", lambda x: x + F.when(F.col("label") == 5, F.lit(0.01)).otherwise(F.lit(0.0000001)))
    b = a.filter("label <> 9").withColumn("embedding", moved)
    b = b.withColumn("label", F.when(F.col("label") == 3, 4).otherwise(F.col("label")))
    return op.reconcile(a, b, "vec_id", ["label"], ["embedding"])


@query("B09_same_order", """
with a as (select doc_id, row_number() over (order by doc_id) as i from documents), b as (select doc_id, row_number() over (order by n_chars, doc_id) as i from documents)
select count(*) filter (a.doc_id <> b.doc_id) as moved from a join b using (i)
""")
def b09_order(spark, sf):
    d = table(spark, sf, "documents")
    return op.same_order(d.select("doc_id"), d.select("doc_id", "n_chars"), ["doc_id"], ["n_chars", "doc_id"], "doc_id")


@query("B10_flatten", """
select event_id, cast(json_extract_string(props, '$.k') as int) as "props.k", event_type as "props.kind.name", value as "props.kind.value" from events
""")
def b10(spark, sf):
    e = table(spark, sf, "events")
    kind = F.struct(F.col("event_type").alias("name"), F.col("value"))
    parsed = F.from_json("props", "k int")
    nested = e.select("event_id", F.struct(parsed["k"].alias("k"), kind.alias("kind")).alias("props"))
    return op.flatten(nested)


@query("B11_dedupe_names", """
with r as (select p_partkey, p_name, row_number() over (partition by p_name order by p_partkey) - 1 as k from part) select p_partkey, case when k > 0 then p_name || '_' || k else p_name end as unique_name from r
""")
def b11(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    return op.dedupe_names(p, "p_name", ["p_partkey"]).select("p_partkey", "unique_name")


@query("B12_rename", "select c_custkey as id, c_name as name, c_mktsegment as segment from customer")
def b12(spark, sf):
    return op.rename(table(spark, sf, "customer"), {"c_custkey": "id", "c_name": "name", "c_mktsegment": "segment"}, ["id", "name", "segment", "phone"])


@query("B13_snake_case", """
with s as (select ' ' || p_name || ' -- ' || p_brand || '!' as t from part union all select c_name || '  (' || c_mktsegment || ')' from customer)
select t, lower(trim(regexp_replace(trim(t), '[^a-zA-Z0-9]+', '_', 'g'), '_')) as snake, count(*) as n from s group by all
""")
def b13(spark, sf):
    p = table(spark, sf, "part").select(F.concat(F.lit(" "), "p_name", F.lit(" -- "), "p_brand", F.lit("!")).alias("t"))
    c = table(spark, sf, "customer").select(F.concat("c_name", F.lit("  ("), "c_mktsegment", F.lit(")")).alias("t"))
    return p.unionByName(c).groupBy("t", tx.snake_case(F.col("t")).alias("snake")).agg(F.count("*").alias("n"))


@query("B14_label_index", """
with d as (select p_type as label, row_number() over (order by p_type) - 1 as index from (select distinct p_type from part)) select index, label, count(*) as n from part join d on p_type = label group by all
""")
def b14(spark, sf):
    p = table(spark, sf, "part")
    labels = op.label_index(p, "p_type")
    coded = p.join(labels, F.col("p_type") == F.col("label")).select("index")
    return op.decode_label(coded, "index", labels).groupBy("index", "label").agg(F.count("*").alias("n"))


_SRC = [f"src{i}" for i in range(20)]
_SORTED = sorted(_SRC)


def _page_sql(i, size=8):
    block = _SORTED[i * size:(i + 1) * size]
    cells = [f"count(*) filter (source = '{block[j]}') as c{j}" if j < len(block) else f"null::bigint as c{j}" for j in range(size)]
    return f"select lang, {i} as page, '{','.join(block)}' as header, {', '.join(cells)} from documents group by lang"


@query("B15_crosstab", " union all ".join(_page_sql(i) for i in range(3)))
def b15(spark, sf):
    return op.crosstab(table(spark, sf, "documents"), "lang", "source", 8)
