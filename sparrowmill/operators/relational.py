"""Projections, filters, lookups and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparrowmill.operators.ordering import number_rows


def columns_at(df: DataFrame, positions) -> DataFrame:
    """Columns by position; negative positions count from the end."""
    return df.select(*[df.columns[p] for p in positions])


def take_rows(df: DataFrame, order, indices: DataFrame, name: str = "source_index") -> DataFrame:
    """Rows whose position in the given order is listed in indices(source_index)."""
    return number_rows(df, *order, name=name).join(indices.select(name).distinct(), name, "left_semi")


def clamp(col: Column, lo, hi) -> Column:
    return F.greatest(F.least(col, F.lit(hi)), F.lit(lo))


def last_per_key(meta: DataFrame, key: str, order) -> DataFrame:
    """One row per key, the last by order. An aggregate, so hot keys combine before the shuffle."""
    rest = [c for c in meta.columns if c != key]
    picked = meta.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return picked.select(key, *[F.col("_r")[c].alias(c) for c in rest])


def metadata_lookup(df: DataFrame, meta: DataFrame, key: str, order) -> DataFrame:
    """Left lookup by key; of several metadata rows the last wins."""
    return df.join(last_per_key(meta, key, order), key, "left")


def split_rows(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows of a split given by its index list. A split without a list is an error, not all rows."""
    if members is None:
        raise ValueError("the split has no index list")
    return df.join(members.select(key), key, "left_semi")


def complement(df: DataFrame, fold: DataFrame, key: str) -> DataFrame:
    return df.join(fold.select(key), key, "left_anti")


def hstack(a: DataFrame, b: DataFrame, order_a, order_b) -> DataFrame:
    """Columns of both frames side by side, row by position; the shorter one is filled up with nulls."""
    left = number_rows(a, *order_a, name="source_index")
    right = number_rows(b, *order_b, name="source_index")
    return left.join(right, "source_index", "full")


def gather(df: DataFrame, steps: DataFrame, on: str = "t") -> DataFrame:
    """Per row the coefficients of its step."""
    return df.join(steps, on)


def union_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def align_prefix(loaded: DataFrame, model: DataFrame, key: str, prefix: str) -> DataFrame:
    """Strip or add a prefix so that two key sets line up.

    A side counts as prefixed when more than half of its keys start with the prefix.
    """
    share = lambda df: df.agg(F.avg(F.col(key).startswith(prefix).cast("double")) > 0.5).scalar()
    strip = share(loaded) & ~share(model)
    add = share(model) & ~share(loaded)
    bare = F.when(F.col(key).startswith(prefix), F.substring(F.col(key), F.lit(len(prefix) + 1), F.length(key)))
    new = F.when(strip, F.coalesce(bare, F.col(key))).when(add, F.concat(F.lit(prefix), key)).otherwise(F.col(key))
    return loaded.withColumn(key, new)


def key_report(aligned: DataFrame, model: DataFrame, key: str) -> DataFrame:
    """Keys of the model that are missing and loaded keys nobody asked for."""
    missing = model.select(key).join(aligned.select(key), key, "left_anti").withColumn("state", F.lit("missing"))
    extra = aligned.select(key).join(model.select(key), key, "left_anti").withColumn("state", F.lit("unexpected"))
    return missing.unionByName(extra)
