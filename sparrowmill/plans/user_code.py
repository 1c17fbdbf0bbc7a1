"""Group O: user functions."""

from pyspark.sql import functions as F

from sparrowmill.operators import user_code as op
from sparrowmill.plans.corpus import BI
from sparrowmill.plans.fixtures import RULE_SQL, rule
from sparrowmill.plans.registry import query
from sparrowmill.session import scratch_path
from sparrowmill.sources import files as fs
from sparrowmill.tables import table


@query("O01_map_batches", "select doc_id, upper(lang) as lang, cast(n_chars as double) / 2 as half, length(text) as len from documents")
def o01(spark, sf):
    def fn(pdf):
        return pdf.assign(lang=pdf.lang.str.upper(), half=pdf.n_chars / 2, len=pdf.text.str.len())[["doc_id", "lang", "half", "len"]]

    d = table(spark, sf, "documents").select("doc_id", "lang", "n_chars", "text")
    return op.map_batches(d, fn, "doc_id bigint, lang string, half double, len bigint")


@query("O01_map_rows", "select doc_id, 'text is ' || lang as tag from documents")
def o01_rows(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return op.map_rows(d, lambda r: {"doc_id": r["doc_id"], "tag": "text is " + r["lang"]}, "doc_id bigint, tag string")


@query("O02_filter_rows", "select doc_id, lang from documents where text like 'A%' or n_chars > 5000")
def o02(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "text", "n_chars")
    return op.filter_rows(d, lambda p: p.text.str.startswith("A") | (p.n_chars > 5000)).select("doc_id", "lang")


class Accuracy:
    """Right rows and all rows as a state."""

    def init(self):
        return 0, 0

    def update(self, state, rows):
        return state[0] + int((rows["pred"] == rows["truth"]).sum()), state[1] + len(rows)

    def merge(self, one, two):
        return one[0] + two[0], one[1] + two[1]

    def finish(self, state):
        return state[0] / state[1] if state[1] else None


@query("O03_user_metric", f"""
with {RULE_SQL} select lang, round(count(*) filter (pred = truth) / count(*), 9) as accuracy from rule group by lang
""")
def o03(spark, sf):
    m = op.metric(rule(spark, sf), ["lang"], ["pred", "truth"], Accuracy(), "accuracy")
    return m.select("lang", F.round("accuracy", 9).alias("accuracy"))


@query("O04_ngram_udtf", f"with {BI} select w1 || ' ' || w2 as gram, n from bi")
def o04(spark, sf):
    spark.udtf.register("letter_bigrams", op.ngram_udtf(2))
    d = table(spark, sf, "documents").select("text")
    parts = op.text_parts(d, "text")
    grams = spark.sql("select g.gram from {d}, lateral letter_bigrams({d}.text) g", d=d.repartition(parts))
    return op.count_values(grams, "gram", parts)


@query("O05_read_hook", "select doc_id, md5(lower(text)) as digest from documents")
def o05(spark, sf):
    root = scratch_path(spark, "hook")
    fs.write_split(table(spark, sf, "documents").select("doc_id", "text"), root, "all")
    return fs.read_split(spark, root, "all", transform=op.lower_hook("text")).select("doc_id", F.md5("text").alias("digest"))
