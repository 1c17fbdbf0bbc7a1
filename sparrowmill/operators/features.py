"""Tabular feature preparation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparrowmill.functions.arrays import let
from sparrowmill.functions.rand import portable_normal
from sparrowmill.operators.corpus import lookup
from sparrowmill.operators.ordering import number_rows
from sparrowmill.session import materialize

MAX_CATEGORIES = 1000


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _statistics(df: DataFrame, columns, **fns) -> dict[str, Column]:
    """One pass over the rows; the single result row is used as a scalar subquery."""
    packed = [F.struct(*[fn(c).alias(n) for n, fn in fns.items()]).alias(c) for c in columns]
    row = df.agg(F.struct(*packed).alias("s")).scalar()
    return {c: row[c] for c in columns}


def impute_mean(df: DataFrame, columns) -> DataFrame:
    stats = _statistics(df, columns, m=F.avg)
    return df.withColumns({c: F.coalesce(F.col(c), stats[c]["m"]) for c in columns})


def standardize(df: DataFrame, columns, ddof: int = 1, fill: float | None = 0.0) -> DataFrame:
    """(x - mean) / std with the sample (ddof 1) or population (ddof 0) deviation; nulls become `fill`."""
    stats = _statistics(df, columns, m=F.avg, s=F.stddev_samp if ddof else F.stddev_pop)

    def score(c):
        z = F.try_divide(F.col(c) - stats[c]["m"], stats[c]["s"])
        return z if fill is None else F.coalesce(z, F.lit(fill))

    return df.withColumns({c: score(c) for c in columns})


def batch_norm(df: DataFrame, vec: str, gamma: float, beta: float, eps: float) -> DataFrame:
    """Per position (x - mean) / sqrt(var + eps) * gamma + beta over all rows."""
    long = df.select(F.posexplode(vec).alias("i", "x"))
    cells = long.groupBy("i").agg(F.avg("x").alias("m"), F.var_pop("x").alias("v"))
    scale = F.sqrt(F.col("v") + F.lit(eps)).alias("s")
    table = cells.agg(F.array_sort(F.collect_list(F.struct("i", "m", scale)))).scalar()
    norm = let(F.col("_t"), lambda t: F.transform(
        vec, lambda x, i: (x - F.get(t, i)["m"]) / F.get(t, i)["s"] * F.lit(gamma) + F.lit(beta)
    ))
    return df.withColumn("_t", table).withColumn(vec, norm).drop("_t")


def categories(df: DataFrame, column: str, limit: int = MAX_CATEGORIES) -> list:
    """Distinct non-null values in order; more than `limit` is an error."""
    rows = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} values, too many columns; use sparse_dummies")
    return sorted(r[0] for r in rows)


def get_dummies(df: DataFrame, columns, dummy_na: bool = True, values: dict | None = None) -> DataFrame:
    """One 0/1 column per value and, with dummy_na, one for null, also when nothing is null."""
    out = df
    for c in columns:
        vals = (values or {}).get(c) or categories(df, c)
        new = {f"{c}_{v}": F.coalesce((F.col(c) == v).cast("int"), F.lit(0)) for v in vals}
        if dummy_na:
            new[f"{c}_nan"] = F.col(c).isNull().cast("int")
        out = out.withColumns(new)
    return out.drop(*columns)


def dummy_index(df: DataFrame, columns, dummy_na: bool = True) -> DataFrame:
    """Stored (column, value, index): the 0/1 features of the columns, one after the other, values in order.

    With dummy_na each column ends with a feature for null (value null). The number of values has no bound.
    """
    pair = [F.struct(F.lit(n).alias("at"), F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for n, c in enumerate(columns)]
    found = df.select(F.explode(F.array(*pair)).alias("p")).select("p.*").distinct()
    known = found.filter("value is not null")
    if dummy_na:
        nulls = df.sparkSession.createDataFrame([(n, c, None) for n, c in enumerate(columns)], "at int, column string, value string")
        known = known.unionByName(nulls)
    return materialize(number_rows(known, "at", F.col("value").asc_nulls_last(), name="index").select("column", "value", "index"))


def sparse_dummies(df: DataFrame, columns, index: DataFrame, key: str) -> DataFrame:
    """`df` without the columns, with `features`: the sorted numbers of the features that are 1 in the row.

    A row with a value that is not in the index has none for that column. `key` tells rows apart. Values are
    counted first and numbered once per distinct value of a column; frequent ones are broadcast.
    """
    out, made = df, []
    for n, c in enumerate(columns):
        counts = df.groupBy(F.col(c).cast("string").alias("_v")).agg(F.count("*").alias("_n"))
        mine = index.filter(F.col("column") == c).select(F.col("value").alias("_w"), F.col("index").alias(f"_f{n}"))
        dim = counts.join(mine, F.col("_v").eqNullSafe(F.col("_w"))).select(F.coalesce(F.concat(F.lit("="), "_v"), F.lit("")).alias("_value"), f"_f{n}", "_n")
        out = out.withColumn("_value", F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")))
        out = lookup(out, dim, "_value", f"_f{n}", "_n", F.xxhash64(key)).drop("_value")
        made.append(f"_f{n}")
    return out.withColumn("features", F.array_sort(F.array_compact(F.array(*made)))).drop(*made, *columns)


def fit_transform_union_sparse(train: DataFrame, test: DataFrame, numeric, categorical, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """fit_transform_union with sparse features for any number of values: (train, test, index of the features)."""
    both = train.withColumn("_src", F.lit(0)).unionByName(test.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    index = dummy_index(both, categorical)
    ready = sparse_dummies(standardize(both, numeric, 1), categorical, index, key)
    return ready.filter("_src = 0").drop("_src"), ready.filter("_src = 1").drop("_src"), index


def fit_transform_union(train: DataFrame, test: DataFrame, numeric, categorical) -> tuple[DataFrame, DataFrame]:
    """Standardise and expand on the union of both tables, then part them again."""
    both = train.withColumn("_src", F.lit(0)).unionByName(test.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    ready = get_dummies(standardize(both, numeric, 1), categorical)
    return ready.filter("_src = 0").drop("_src"), ready.filter("_src = 1").drop("_src")


def linear_targets(df: DataFrame, features, weights, bias: float, noise: float, key: str, seed: int) -> DataFrame:
    """y = X w + b + noise * eps with a seeded standard normal eps per row."""
    total = F.lit(float(bias))
    for f, w in zip(features, weights):
        total = total + F.col(f) * F.lit(float(w))
    return df.withColumn("y", total + portable_normal(key, seed=seed) * F.lit(float(noise)))


def predictions(df: DataFrame, key: str, x: Column, fit: DataFrame) -> DataFrame:
    """(key, prediction) of a fitted line (one row: slope, intercept)."""
    line = fit.agg(F.struct(F.first("slope").alias("a"), F.first("intercept").alias("b"))).scalar()
    return df.select(key, (x * line["a"] + line["b"]).alias("prediction"))
