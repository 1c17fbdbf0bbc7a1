"""Exact dedup with a split for heavy hitters, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparrowmill.llm.text import SPACE
from sparrowmill.session import materialize

#: A digest with more than this share of the rows is a heavy hitter. There are at most 1 / share of them.
HEAVY_SHARE = 1 / 1024


def exact_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", share: float = HEAVY_SHARE) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they agree after every run of ASCII white space became one space. Of equal
    texts the row with the smallest id stays; its id is `keep_id`.

    The digests are written once. A Misra-Gries pass over them (`freqItems`) names every digest above
    `share` and perhaps some below; an exact count verifies them. The winners, at most 1 / share rows,
    are broadcast, so their rows are settled where they are read and never meet in one task. What is
    left has only small groups and goes through one ordinary shuffle.

    Null text counts as empty text. Repeated rows with one id and one text are all kept or all dropped.
    A null id stays only if its group has no other id. An empty table gives an empty result. Extra
    columns are ignored.
    """
    body = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE, " ")
    digests = materialize(
        df.select(F.col(key).alias("doc_id"), F.sha2(body, 256).alias("text_sha256"))
        .withColumn("_hash", F.xxhash64("text_sha256"))
    )
    frequent = digests.freqItems(["_hash"], share).select(F.explode("_hash_freqItems").alias("_hash")).distinct()
    least = F.lit(share) * digests.select(F.count(F.lit(1))).scalar()
    winners = (
        digests.join(F.broadcast(frequent), "_hash", "left_semi")  # at most 1 / share hashes
        .groupBy("text_sha256")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter(F.col("group_size") > least)
        .withColumn("_heavy", F.lit(True))
    )
    winners = materialize(winners)
    marked = digests.drop("_hash").join(F.broadcast(winners), "text_sha256", "left")
    heavy = marked.filter("_heavy").select("doc_id", "keep_id", "group_size", "text_sha256")
    group = Window.partitionBy("text_sha256")
    rest = marked.filter("_heavy is null").select(
        "doc_id",
        F.min("doc_id").over(group).alias("keep_id"),
        F.count(F.lit(1)).over(group).alias("group_size"),
        "text_sha256",
    )
    return heavy.unionByName(rest).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
