"""Order, limits, seeded samples, splits, folds, shards and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparrowmill.functions.rand import portable_rand
from sparrowmill.operators.ordering import number_rows


def shuffle(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.orderBy(portable_rand(key, seed=seed), key)


def head(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(order).limit(n)


def sample_n(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """The first n rows of the seeded shuffle. A top-n, so only n rows per task travel."""
    return shuffle(df, key, seed).limit(n)


def random_split(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    part = F.when(portable_rand(key, seed=seed) < fraction, "test").otherwise("train")
    return df.withColumn("split", part)


def contiguous_folds(df: DataFrame, order, k: int) -> DataFrame:
    """k folds of N div k rows; the last N mod k rows are in no fold."""
    rows = number_rows(df, *order, name="_i")
    size = rows.agg(F.floor(F.count("*") / k)).scalar()
    return rows.withColumn("fold", F.floor(F.col("_i") / size)).filter(F.col("fold") < k).drop("_i")


def shards(df: DataFrame, order, n: int) -> DataFrame:
    """Shard numbers in the contiguous form (the first N mod n shards get one row more) and the strided form."""
    rows = number_rows(df, *order, name="source_index")
    count = rows.agg(F.count("*")).scalar()
    base, extra = F.floor(count / n), count % n
    cut = extra * (base + 1)
    contiguous = F.when(F.col("source_index") < cut, F.floor(F.col("source_index") / (base + 1))).otherwise(
        extra + F.floor((F.col("source_index") - cut) / F.greatest(base, F.lit(1)))
    )
    return rows.withColumn("contiguous", contiguous).withColumn("strided", F.col("source_index") % n)


def carve(df: DataFrame, order) -> DataFrame:
    """The first third (rounded down) of the rows is val, the rest test."""
    rows = number_rows(df, *order, name="_i")
    third = rows.agg(F.floor(F.count("*") / 3)).scalar()
    return rows.withColumn("split", F.when(F.col("_i") < third, "val").otherwise("test")).drop("_i")


def batches(df: DataFrame, order, size: int, drop_last: bool = False) -> DataFrame:
    rows = number_rows(df, *order, name="_i").withColumn("batch", F.floor(F.col("_i") / size))
    if drop_last:
        rows = rows.filter(F.col("batch") < rows.agg(F.floor(F.count("*") / size)).scalar())
    return rows.withColumn("slot", F.col("_i") % size).drop("_i")


def sample_with_replacement(df: DataFrame, order, draws: Column, seed: int) -> DataFrame:
    """Draw rows by position, with replacement: `draws` draws (a count expression over df).

    The draw numbers come from the rows themselves, so nothing is generated on the driver.
    """
    rows = number_rows(df, *order, name="source_index")
    count = rows.agg(F.count("*")).scalar()
    per_row = rows.select("source_index", draws.cast("int").alias("_d")).filter("_d > 0")
    tickets = per_row.select("source_index", F.explode(F.sequence(F.lit(1), F.col("_d"))).alias("_t"))
    picked = tickets.select(F.concat_ws("-", "source_index", "_t").alias("draw")).withColumn("source_index", F.floor(portable_rand("draw", seed=seed) * count))
    return picked.join(rows, "source_index")


def linspace(start: Column, stop: Column, n: Column) -> Column:
    """n evenly spaced numbers from start to stop, both included."""
    step = (stop - start) / F.greatest(n - 1, F.lit(1))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: start + i * step)


def identity_row(i: Column, n: Column) -> Column:
    """Row i of the n x n identity matrix."""
    return F.transform(F.sequence(F.lit(0), n - 1), lambda j: (i == j).cast("double"))
