"""Preparation of a corpus in stages, each an operator of sparrowmill.llm."""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparrowmill.llm.bitmaps import without
from sparrowmill.llm.exact_dedup import exact_dedup
from sparrowmill.llm.mixing import mix_sources
from sparrowmill.llm.ngram_join import ngram_components
from sparrowmill.llm.piece_bpe import encode_documents
from sparrowmill.llm.queries import quality_weight, toxic_labels
from sparrowmill.llm.text import words_in
from sparrowmill.llm.toxicity import without_toxic
from sparrowmill.session import materialize, scratch_path
from sparrowmill.tables import table

TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")


#: Rows of one file have numbers below this power of two.
_FILE_ROWS = 40


def numbered(docs: DataFrame) -> DataFrame:
    """(_doc, _row): each row of `docs` as one struct, whatever its columns are called, and a unique number of it.

    The number is that of the stored file and the place in there. It is taken where the rows lie; if that does not
    tell all rows apart, as behind an explode, or is not known, they are written first. The names of the
    files, a millionth of their bytes, pass through the driver.
    """
    placed = _places(docs)
    files = None if placed is None else _files(placed)
    if files is None:
        placed = _places(materialize(docs))
        files = sorted(r[0] for r in placed.select("_file").distinct().collect())
    known = docs.sparkSession.createDataFrame([(f, n) for n, f in enumerate(files)], "_file string, _n bigint")
    row = F.shiftleft(F.col("_n"), _FILE_ROWS) + F.col("_at")
    return placed.join(F.broadcast(known), "_file").select("_doc", row.alias("_row"))  # one row per file


def _places(docs: DataFrame) -> DataFrame | None:
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at")]
    try:
        return docs.select(F.struct("*").alias("_doc"), *place)
    except AnalysisException:
        return None


def _files(placed: DataFrame) -> list[str] | None:
    """The files of the rows, in order; None if a place has more than one row. One query tells both."""
    rows = placed.groupBy("_file", "_at").agg(F.count(F.lit(1)).alias("_n"))
    most = rows.groupBy("_file").agg(F.max("_n").alias("_n")).collect()
    return None if any(r["_n"] > 1 for r in most) else sorted(r["_file"] for r in most)


def _order():
    """Order of the rows of a group: by id, null last, and then by row."""
    return F.struct(F.col("_doc.doc_id").isNull().alias("no_id"), F.col("_doc.doc_id").alias("doc_id"), "_row")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below a half."""
    return without_toxic(docs, toxic_labels(table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group of equal texts, whatever ids the rows have."""
    rows = numbered(docs)
    judged = exact_dedup(rows.select(_order().alias("place"), "_doc.text"), key="place")
    return without(rows, "_row", judged.filter("not kept").select("doc_id._row")).select("_doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group that links of similar texts form, whatever ids the rows have."""
    rows = numbered(docs)
    found = ngram_components(rows.select("_row", "_doc.text"), key="_row")
    found = materialize(found.select(F.col("doc_id").alias("_row"), "component_id"))
    groups = found.filter("_row <> component_id").select("component_id").distinct()
    members = materialize(found.join(groups, "component_id", "left_semi").join(rows.select("_row", _order().alias("_place")), "_row"))
    first = members.groupBy("component_id").agg(F.min("_place").alias("_first"))
    gone = members.join(first, "component_id").filter(F.col("_row") != F.col("_first._row")).select("_row")
    return without(rows, "_row", gone).select("_doc.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them."""
    rows = numbered(docs)
    weights = quality_weight(table(spark, sf_dir, "labels"))
    sized = rows.select("_doc.doc_id", "_row", "_doc.source", words_in(F.col("_doc.text")).alias("size")).join(weights, "doc_id", "left")
    copies = mix_sources(sized, F.col("size"), F.col("weight"), row="_row").filter("copies > 0").select("_row", "copies")
    taken = rows.join(copies, "_row")
    return taken.select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents."""
    return encode_documents(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix),
    ("encoding", encode),
]

#: A factorization machine is not an SQL expression; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
