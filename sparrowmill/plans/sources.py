"""Group A: sources, sinks, manifests. What is written goes to a new path in the shared folder."""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparrowmill.functions import text as tx
from sparrowmill.operators.corpus import turn_pairs
from sparrowmill.plans.corpus import PAIRS
from sparrowmill.plans.registry import query
from sparrowmill.session import scratch_path
from sparrowmill.sources import files as fs
from sparrowmill.sources import manifest as mf
from sparrowmill.tables import TABLES, table


@query("A01_read_split", """
select doc_id, lang, n_chars, md5(text) as digest from documents where doc_id in (select doc_id from labels)
""")
def a01(spark, sf):
    d = table(spark, sf, "documents")
    held = d.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    rest = d.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti")
    root = scratch_path(spark, "split")
    fs.write_split(held, root, "train")
    fs.write_split(rest, root, "val")
    return fs.read_split(spark, root, "train").select("doc_id", "lang", "n_chars", F.md5("text").alias("digest"))


@query("A02_shard_inventory", """
with s as (select lang as split, count(distinct doc_id % 4) as num_shards, cast(sum(octet_length(encode(coalesce(text, ''))) + 1) as bigint) as total_size from documents group by lang)
select * from s union all select 'total', cast(sum(num_shards) as bigint), cast(sum(total_size) as bigint) from s
""")
def a02(spark, sf):
    root = scratch_path(spark, "inventory")
    fs.write_named_shards(table(spark, sf, "documents"), root, F.col("lang"), F.col("doc_id") % 4, text="text")
    return fs.shard_inventory(spark, root, ".txt")


_NAMES_SQL = "n as (select case doc_id % 4 when 0 then 'train' when 1 then 'validation' when 2 then 'eval' else source end || '-' || doc_id || '.parquet' as name from documents)"


_ALIASES_SQL = " ".join(f"when '{a}' then '{b}'" for a, b in tx.SPLIT_ALIASES.items())


@query("A03_normalize_split", f"""
with {_NAMES_SQL}, m as (select name, regexp_extract(name, '^({'|'.join(tx.SPLIT_PREFIXES)})-[0-9]+', 1) as p from n)
select name, case p when '' then replace(name, '.parquet', '') {_ALIASES_SQL} else p end as split from m
""")
def a03(spark, sf):
    k = F.col("doc_id") % 4
    prefix = F.when(k == 0, "train").when(k == 1, "validation").when(k == 2, "eval").otherwise(F.col("source"))
    n = table(spark, sf, "documents").select(F.concat(prefix, F.lit("-"), F.col("doc_id").cast("string"), F.lit(".parquet")).alias("name"))
    return n.select("name", tx.split_name(F.col("name")).alias("split"))


@query("A04_read_csv", """
select p_partkey, nullif(p_name, 'red bolt') as p_name, nullif(p_size, 7) as p_size, p_retailprice from part
""")
def a04(spark, sf):
    p = table(spark, sf, "part")
    src = p.select("p_partkey", F.nullif("p_name", F.lit("red bolt")).alias("p_name"), F.nullif("p_size", F.lit(7)).alias("p_size"), "p_retailprice")
    path = scratch_path(spark, "csv")
    fs.write_csv(src, path)
    back = fs.read_csv(spark, path)
    return back.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_name", "p_size", "p_retailprice")


@query("A05_csv_round_trip", "select * from part")
def a05(spark, sf):
    p = table(spark, sf, "part")
    path = scratch_path(spark, "csv")
    fs.write_csv(p, path)
    return fs.read_csv(spark, path, schema=p.schema)


@query("A06_json_round_trip", "select event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts_text from events")
def a06(spark, sf):
    e = table(spark, sf, "events")
    path = scratch_path(spark, "json")
    fs.write_json(e.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")), path)
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == "ts" else f.dataType) for f in e.schema.fields])
    return fs.read_json(spark, path, schema).withColumnRenamed("ts", "ts_text")


@query("A07_read_matrix", """
select l_quantity as a, l_extendedprice as b, l_discount as c, l_tax as d, count(*) as n from lineitem group by all
""")
def a07(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    path = scratch_path(spark, "matrix")
    li.write.option("sep", "\t").csv(path)
    m = fs.read_matrix(spark, path, 4)
    return m.groupBy(*[F.col("row")[i].alias(c) for i, c in enumerate("abcd")]).agg(F.count("*").alias("n"))


@query("A08_text_lines", """
with l as (select doc_id, string_split(text, chr(10)) as s from documents) select doc_id, cast(unnest(generate_series(0, len(s) - 1)) as int) as line_no, unnest(s) as value from l
""")
def a08(spark, sf):
    return fs.text_lines(table(spark, sf, "documents"), "doc_id", "text")


@query("A08_read_lines", """
with l as (select source, doc_id, unnest(string_split(text, chr(10))) as value, generate_subscripts(string_split(text, chr(10)), 1) as i from documents)
select line_no, md5(value) as digest, count(*) as n from (select value, row_number() over (order by doc_id, i) - 1 as line_no from l) group by all
""")
def a08_read(spark, sf):
    lines = fs.text_lines(table(spark, sf, "documents"), "doc_id", "text")
    path = scratch_path(spark, "lines")
    fs.write_lines(lines, ["doc_id", "line_no"], "value", path)
    back = fs.read_lines(spark, path)
    ordered = fs.lines_across_files(back)
    return ordered.groupBy("line_no", F.md5("value").alias("digest")).agg(F.count("*").alias("n"))


@query("A09_read_pairs", f"""
with {PAIRS}, l as (select pair_id, replace(source, chr(10), ' ') as s, replace(target, chr(10), ' ') as t from pairs)
select pair_id, md5(s) as source, md5(t) as target from l where s not like '%' || chr(9) || '%' and t not like '%' || chr(9) || '%'
""")
def a09(spark, sf):
    p = turn_pairs(table(spark, sf, "conversations"))
    flat = lambda c: F.translate(c, "\n", " ")
    lines = p.select("pair_id", F.concat_ws("\t", flat("source"), flat("target")).alias("value"))
    return fs.read_pairs(lines, ["pair_id"]).select("pair_id", F.md5("source").alias("source"), F.md5("target").alias("target"))


@query("A10_read_annotations", """
select event_id, 'data_' || user_id as name, event_type as image, value as x1, value + 1 as y1, value + 2 as x2, value + 3 as y2,
 1 - (case when event_type = 'error' then 1 else 0 end) as label from events
""")
def a10(spark, sf):
    e = table(spark, sf, "events")
    num = lambda d: F.round(F.col("value") + d, 2)
    body = F.struct(F.col("event_type").alias("image"), F.array(*[num(d) for d in range(4)]).alias("loc"),
                    (F.col("event_type") == "error").cast("int").alias("class"))
    docs = e.select("event_id", F.to_json(F.create_map(F.concat(F.lit("data_"), "user_id"), body)).alias("json"))
    return fs.read_annotations(docs, "json")


_BYTES = "(octet_length(encode(text)) + octet_length(encode(lang)) + octet_length(encode(source)) + 16)"


@query("A11_plan_shards", f"""
with s as (select count(*) as rows, greatest(avg({_BYTES}), 1.0) as avg_bytes from documents), p as (select *, cast(greatest(100, floor(482344 / avg_bytes)) as bigint) as rows_per_shard from s)
select rows, round(avg_bytes, 6) as avg_bytes, rows_per_shard, cast(ceil(rows / rows_per_shard) as bigint) as shards from p
""")
def a11(spark, sf):
    plan = fs.plan_shards(table(spark, sf, "documents"), 0.5, 0.92, 100)
    return plan.withColumn("avg_bytes", F.round("avg_bytes", 6))


@query("A11_write_shards", f"""
with s as (select greatest(100, floor(482344 / greatest(avg({_BYTES}), 1.0))) as per from documents), r as (select doc_id, text, row_number() over (order by doc_id) - 1 as i from documents)
select cast(floor(i / per) as bigint) as shard_id, count(*) as n, min(doc_id) as first_doc, max(doc_id) as last_doc, min(i) as first_index,
 md5(string_agg(md5(text), '' order by i)) as content from r, s group by 1
""")
def a11_write(spark, sf):
    d = table(spark, sf, "documents")
    per = fs.plan_shards(d, 0.5, 0.92, 100).first()["rows_per_shard"]
    path = scratch_path(spark, "shards")
    fs.write_shards(d, path, ["doc_id"], per)
    return _shards_back(spark, path)


def _shards_back(spark, path):
    """What the written shards hold: rows, ids, first index and a digest of their texts in order."""
    back = spark.read.parquet(f"{path}/data/split=all")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("source_index", F.md5("text").alias("h")))), lambda r: r["h"])
    return back.groupBy(F.col("shard_id").cast("bigint").alias("shard_id")).agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"),
        F.min("source_index").alias("first_index"), F.md5(F.array_join(texts, "")).alias("content"),
    )


@query("A11_sized_shards", f"""
with r as (select doc_id, text, {_BYTES} as size, row_number() over (order by doc_id) - 1 as i, coalesce(sum({_BYTES}) over (order by doc_id rows between unbounded preceding and 1 preceding), 0) as before from documents),
c as (select greatest(964689 - max(size), 964689 // 2) as cell from r)
select cast(before // cell as bigint) as shard_id, count(*) as n, min(doc_id) as first_doc, max(doc_id) as last_doc, min(i) as first_index,
 md5(string_agg(md5(text), '' order by i)) as content, sum(size) <= 964689 as fits from r, c group by 1
""")
def a11_sized(spark, sf):
    d = table(spark, sf, "documents")
    path = scratch_path(spark, "sized")
    fs.write_sized_shards(d, path, ["doc_id"], 1.0, 0.92)
    back = spark.read.parquet(f"{path}/data/split=all")
    size = back.groupBy(F.col("shard_id").cast("bigint").alias("shard_id")).agg((F.sum(fs.row_bytes(d)) <= 964689).alias("fits"))
    return _shards_back(spark, path).join(size, "shard_id")


@query("A12_dataset_manifest", """
select 'documents' as dataset_name, 'doc_id:bigint, text:string, lang:string, source:string, n_chars:bigint' as features, 'doc_id_ascending' as order_tag, count(*) as num_examples,
 count(distinct lang) as num_shards, (select string_agg(l, ',' order by l) from (select distinct lang as l from documents)) as shard_names, min(doc_id) as source_index_start, max(doc_id) + 1 as source_index_end_exclusive from documents
""")
def a12(spark, sf):
    d = table(spark, sf, "documents").withColumn("shard", F.col("lang"))
    m = mf.dataset_manifest(d, "documents", "doc_id", "shard")
    return m.withColumnRenamed("order", "order_tag").withColumn("shard_names", F.array_join("shard_names", ",")).drop("manifest")


@query("A12_manifest_files", """
with d as (select count(*) as n from documents)
select 'ok' as state, cast(ceil(n / 300.0) as bigint) as files, n as num_rows, n as readable from d union all select 'unlisted', 1, 1, n from d
""")
def a12_files(spark, sf):
    d = table(spark, sf, "documents")
    root = scratch_path(spark, "dataset")
    fs.write_shards(d, root, ["doc_id"], 300)
    mf.commit_manifest(spark, root, "documents")
    # a file that came later is not part of the dataset
    stray = spark.read.parquet(f"{root}/data/split=all").filter("source_index = 0").drop("shard_id")
    stray.coalesce(1).write.parquet(f"{root}/data/split=all/shard_id=999999")
    states = mf.check_dataset(spark, root).groupBy("state").agg(F.count("*").alias("files"), F.sum("num_rows").alias("num_rows"))
    return states.withColumn("readable", mf.read_dataset(spark, root).agg(F.count("*")).scalar())


@query("A13_write_guard", "select p_brand, count(*) as n, 1 as refused from part group by p_brand")
def a13(spark, sf):
    p = table(spark, sf, "part")
    path = scratch_path(spark, "guard")
    fs.write_guarded(p, path)
    try:
        fs.write_guarded(p.filter("p_size > 25"), path)
        refused = 0
    except FileExistsError:
        refused = 1
    return spark.read.parquet(path).groupBy("p_brand").agg(F.count("*").alias("n"), F.lit(refused).alias("refused"))


@query("A14_bundle_manifest", """
with r as (select source, doc_id, n_chars, coalesce(sum(n_chars) over (partition by source order by doc_id rows between unbounded preceding and 1 preceding), 0) as before from documents)
select source, doc_id, n_chars as size, cast(before // 20000 as bigint) as bundle from r
""")
def a14(spark, sf):
    d = table(spark, sf, "documents").select("source", "doc_id", "n_chars")
    return mf.bundle_manifest(d, "source", "doc_id", F.col("n_chars"), 20000).select("source", "doc_id", "size", "bundle")


@query("A14_bundle_files", """
with f as (select source as folder, doc_id % 5 as name, cast(sum(octet_length(encode(text)) + 1) as bigint) as size from documents group by all),
b as (select *, coalesce(sum(size) over (partition by folder order by name rows between unbounded preceding and 1 preceding), 0) as before from f)
select folder, cast(name as varchar) as name, size, cast(before // 16384 as bigint) as bundle from b
""")
def a14_files(spark, sf):
    root = scratch_path(spark, "bundle")
    fs.write_named_shards(table(spark, sf, "documents"), root, F.col("source"), F.col("doc_id") % 5, text="text")
    part = lambda n: F.regexp_extract("path", f"/{n}=([^/]+)/", 1).alias("folder" if n == "split" else "name")
    files = fs.file_listing(spark, root).groupBy(part("split"), part("shard")).agg(F.sum("length").alias("length"))
    return mf.bundle_manifest(files, "folder", "name", F.col("length"), 1 << 14).select("folder", "name", "size", "bundle")


@query("A15_verify_checksums", """
select doc_id, case when lang = 'fr' then 'changed' when lang = 'de' then 'unlisted' else 'ok' end as state from documents
""")
def a15(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "text")
    touched = F.when(F.col("lang") == "fr", F.concat("text", F.lit("."))).otherwise(F.col("text"))
    manifest = mf.checksums(d.filter("lang <> 'de'").withColumn("text", touched), "doc_id", "text")
    return mf.verify_checksums(d, manifest, "doc_id", "text")


@query("A15_checksums", "select page_id, sha1(html) as sha1 from pages")
def a15_pages(spark, sf):
    return mf.checksums(table(spark, sf, "pages"), "page_id", "html")


@query("A16_assemble", """
with e as (select label, row_number() over (order by vec_id) - 1 as source_index from embeddings), l as (select quality, row_number() over (order by doc_id) - 1 as source_index from labels),
c as (select c_name, row_number() over (order by c_custkey) - 1 as source_index from customer) select source_index, label, quality, c_name from e full join l using (source_index) full join c using (source_index)
""")
def a16(spark, sf):
    t = lambda n: table(spark, sf, n)
    return mf.assemble({"label": (t("embeddings"), ["vec_id"]), "quality": (t("labels"), ["doc_id"]), "c_name": (t("customer"), ["c_custkey"])})


@query("A17_group_by_length", "with n as (" + " union all ".join(f"select '{t}' as field, count(*) as length from {t}" for t in TABLES) + """)
select length, string_agg(field, ',' order by field) as fields from n where length > 0 group by length
""")
def a17(spark, sf):
    one = [table(spark, sf, t).agg(F.count("*").alias("length")).select(F.lit(t).alias("field"), "length") for t in TABLES]
    fields = one[0]
    for o in one[1:]:
        fields = fields.unionByName(o)
    return mf.group_by_length(fields).withColumn("fields", F.array_join("fields", ","))


_META = (("lang", "documents", "doc_id"), ("source", "documents", "doc_id"), ("quality", "labels", "doc_id"), ("toxic", "labels", "doc_id"), ("p_brand", "part", "p_partkey"))
_META_SQL = " union all ".join(
    f"select '{f}' as field, count(*) as length, coalesce(sum(octet_length(encode(cast({f} as varchar)))), 0) as bytes from {t}" for f, t, _ in _META
)


@query("A17_meta_tables", f"""
with f as ({_META_SQL}) select length, string_agg(field, ',' order by field) as fields, length as num_rows, cast(sum(bytes) as bigint) as bytes, true as listed from f where length > 0 group by length
""")
def a17_tables(spark, sf):
    root = scratch_path(spark, "meta")
    fields = {f: (table(spark, sf, t), [key]) for f, t, key in _META}
    fields["nothing"] = (table(spark, sf, "part").filter("false").withColumn("nothing", F.lit("")), ["p_partkey"])
    tables = mf.write_length_tables(fields, root)
    parts = []
    for length, names in tables.collect():  # one row per table
        back = spark.read.parquet(f"{root}/meta/meta_l{length}")
        sizes = sum((F.coalesce(F.sum(F.octet_length(F.col(n).cast("string"))), F.lit(0)) for n in names), F.lit(0))
        one = back.agg(F.count("*").alias("num_rows"), sizes.cast("bigint").alias("bytes"))
        parts.append(one.select(F.lit(length).cast("bigint").alias("length"), F.lit(",".join(names)).alias("fields"), "num_rows", "bytes"))
    read = reduce(lambda a, b: a.unionByName(b), parts)
    listed = mf.length_tables(spark, root).select("length", (F.col("total_size") > 0).alias("listed"))
    return read.join(listed, "length")
