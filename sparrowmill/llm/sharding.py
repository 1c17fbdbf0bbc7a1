"""Shards of equal size by vector bin packing."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparrowmill.llm.text import words_in
from sparrowmill.session import materialize

#: Equal texts above 1 / BINS of the bytes, words or rows are placed alone (at most 3 * BINS groups);
#: all others share BINS bins by their digest.
BINS = 2048
#: Numbering blocks of a group that is placed alone.
SALTS = 8

FACTS = "bytes words rows".split()
#: The law is about bytes, so they weigh more than words and rows.
WEIGHTS = np.array([2.0, 1.0, 1.0])
#: A group is split into pieces of at most this part of a shard.
PIECE = 4


def place(demands: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unit: largest units first, each where demand times residual capacity is highest.

    A shard's capacity is an equal share of every dimension, so demands and residuals are in shares;
    dimensions are weighted.
    """
    total = np.maximum(demands.sum(axis=0), 1)
    shares = demands / total
    residual = np.full((shards, demands.shape[1]), 1.0 / shards)
    placed = np.zeros(len(demands), dtype=np.int64)
    for unit in np.argsort(-shares.max(axis=1), kind="stable"):
        shard = int(np.argmax(residual @ (WEIGHTS * shares[unit])))
        placed[unit] = shard
        residual[shard] -= shares[unit]
    return placed


def shard_documents(
    df: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", bins: int = BINS, salts: int = SALTS
) -> DataFrame:
    """One row per input row: doc_id, size, words, text_crc32, shard, slot.

    Bytes, words and rows are balanced together, bytes before the others. Equal texts form a group and
    go to one shard; only a group that fills more than a fourth of a shard is split, by id, into pieces
    of that size. Large groups are
    placed one by one, the many small ones in `bins` bins of about equal size, so the driver sees a
    bounded table of sums however large the input is. Slots count from 0 in each shard without gaps:
    they are numbered inside units, whose offsets come from the same table.

    Size is the UTF-8 bytes of the text plus 1; null text has the size 1, the checksum of empty text
    and is in its group. Repeated rows get slots of their own. A null id is an id. Extra columns are
    ignored; an empty table gives an empty result.
    """
    spark, body = df.sparkSession, F.coalesce(F.col(text), F.lit(""))
    facts = materialize(
        df.select(
            F.col(key).alias("doc_id"),
            (F.octet_length(body) + 1).cast("bigint").alias("size"),
            words_in(body).alias("words"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(body, 256)).alias("_digest"),
        )
    )
    sums = [F.sum("size").alias("bytes"), F.sum("words").alias("words"), F.count(F.lit(1)).alias("rows")]
    totals = facts.agg(*sums).first()
    whole = {f: max(totals[f] or 0, 1) for f in FACTS}
    share = F.greatest(*[F.col(f) / F.lit(float(whole[f])) for f in FACTS])
    groups = facts.groupBy("_digest").agg(*sums).filter(share >= 1.0 / bins)
    pieces = F.ceil(share * shards * PIECE).cast("int").alias("_pieces")
    large, first = [], bins
    for digest, n in sorted((bytes(r[0]), r[1]) for r in groups.select("_digest", pieces).collect()):
        large.append((bytearray(digest), first, n))
        first += n
    table = spark.createDataFrame(large, "_digest binary, _first bigint, _pieces int")
    spread = facts.join(F.broadcast(table), "_digest", "left").select(
        "doc_id", "size", "words", "text_crc32",
        F.coalesce(
            F.col("_first") + F.pmod(F.xxhash64("doc_id"), F.col("_pieces")), F.pmod(F.xxhash64("_digest"), F.lit(bins))
        ).alias("_unit"),
        F.when(F.col("_first").isNull(), 0).otherwise(F.pmod(F.xxhash64(F.lit("salt"), "doc_id"), F.lit(salts))).alias("_salt"),
    )
    units = spread.groupBy("_unit", "_salt").agg(*sums).toPandas().sort_values(["_unit", "_salt"])
    whole_units = units.groupby("_unit")[FACTS].sum()
    shard_of = dict(zip(whole_units.index, place(whole_units.to_numpy(dtype=float).reshape(-1, 3), shards)))
    units["shard"] = [int(shard_of[u]) for u in units["_unit"]]
    units["_offset"] = units.groupby("shard")["rows"].cumsum() - units["rows"]
    plan = [tuple(int(v) for v in r) for r in units[["_unit", "_salt", "shard", "_offset"]].itertuples(index=False)]
    plan = spark.createDataFrame(plan, "_unit bigint, _salt bigint, shard int, _offset bigint")
    inside = Window.partitionBy("_unit", "_salt").orderBy("doc_id", "size", "text_crc32")
    return (
        spread.withColumn("_at", F.row_number().over(inside) - 1)
        .join(F.broadcast(plan), ["_unit", "_salt"])
        .select("doc_id", "size", "words", "text_crc32", "shard", (F.col("_offset") + F.col("_at")).alias("slot"))
    )
