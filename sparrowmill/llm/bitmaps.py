"""Bit maps of keys: what other rows need can be told before anything is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparrowmill.session import materialize

#: Slots that keys are hashed to; the maps hold a word of 64 bits for 32 of them (8 MB) at most. Beyond some ten
#: million keys most slots are taken: all results stay right, but little is filtered out.
SLOTS = 1 << 25
_PART = 32_768  # slots of one map of bitmap_construct_agg


def slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS)) + 1


def _bit(key: Column, bits: str) -> Column:
    """Bit of the slot of a key in the map of its part."""
    at = F.bitmap_bit_position(slot(key)).cast("int")
    word = F.get(F.col(bits), F.shiftright(at, 5))
    place = (F.lit(3) - F.shiftright(at, 3).bitwiseAND(F.lit(3))) * 8 + at.bitwiseAND(F.lit(7))  # bytes come highest first
    return F.call_function("shiftright", word, place).bitwiseAND(F.lit(1))


def slot_maps(keys: Column, df: DataFrame) -> DataFrame:
    """(part, bits): the slots of all keys of `df`, one row per 32,768 slots, as an array of words of 32 slots."""
    slots = df.select(slot(keys).alias("s"))
    maps = slots.groupBy(F.bitmap_bucket_number("s").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("b"))
    four = lambda i: F.conv(F.hex(F.substring("b", i * 4 + 1, F.lit(4))), 16, 10).cast("bigint")
    return maps.select("part", F.transform(F.sequence(F.lit(0), F.lit(_PART // 32 - 1)), four).alias("bits"))


def perhaps_in(df: DataFrame, key: str, maps: DataFrame) -> DataFrame:
    """The rows of `df` whose key has a slot in the maps: all that are meant, and few others while the
    keys are fewer than the slots. The maps are broadcast; their size has a bound."""
    both = df.join(F.broadcast(maps), F.bitmap_bucket_number(slot(F.col(key))) == F.col("part"))
    return both.filter(_bit(F.col(key), "bits") == 1).drop("part", "bits")


def without(df: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """The rows of `df`, all columns, whose key is not in the one column of `dropped`.

    Rows whose slot no dropped key has pass where they are read; only the others are shuffled to be
    compared. Rows with a null key stay.
    """
    gone = dropped.toDF("_gone").filter("_gone is not null")
    maps = materialize(slot_maps(F.col("_gone"), gone).select(F.col("part").alias("_part"), F.col("bits").alias("_bits")))
    rows = df.select(F.struct("*").alias("_held"), F.col(key).alias("_key"))  # no column of `df` can clash
    marked = rows.join(F.broadcast(maps), F.bitmap_bucket_number(slot(F.col("_key"))) == F.col("_part"), "left")
    asked = F.coalesce(_bit(F.col("_key"), "_bits") == 1, F.lit(False))
    perhaps = marked.filter(asked).join(gone, F.col("_key") == F.col("_gone"), "left_anti")
    return marked.filter(~asked).select("_held").unionByName(perhaps.select("_held")).select("_held.*")
