"""Scalar features and small linear algebra."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparrowmill.functions.arrays import let, total
from sparrowmill.operators.metrics import co_moments
from sparrowmill.operators.ordering import number_rows

# fixed values: customary per-channel mean and deviation of image data
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)

#: Values of one map.
MAP_PAGE = 10_000


def probability_margin(p: Column) -> Column:
    return F.abs(p - 0.5) * 2


def polynomial(x: Column, degree: int, divisor: str = "gamma") -> Column:
    """x**i / (i-1)! for i >= 1 (1 for i = 0); with divisor "factorial" x**i / i!."""
    below = (lambda i: max(i - 1, 0)) if divisor == "gamma" else (lambda i: i)
    return F.array(*[F.pow(x, F.lit(float(i))) / F.lit(float(math.factorial(below(i)))) for i in range(degree + 1)])


def sinusoid(t: Column, dim: int) -> Column:
    """sin half then cos half over dim / 2 frequencies from 1 down to 1 / 10000."""
    half = dim // 2
    angle = [t * F.lit(math.exp(i * (-(math.log(10000.0) / (half - 1))))) for i in range(half)]
    return F.array(*[F.sin(a) for a in angle], *[F.cos(a) for a in angle])


def to_unit_range(arr: Column) -> Column:
    """0..255 to -1..1."""
    return F.transform(arr, lambda x: x / F.lit(127.5) - 1)


def channel_normalize(arr: Column, plane: int, mean, std) -> Column:
    """0..255 to 0..1, then (x - mean) / std with the constants of the element's channel."""
    means, stds = F.array(*[F.lit(m) for m in mean]), F.array(*[F.lit(s) for s in std])
    chan = lambda i: F.floor(i / plane).cast("int")
    return F.transform(arr, lambda x, i: (x / F.lit(255.0) - F.get(means, chan(i))) / F.get(stds, chan(i)))


def matrix_vector(mat: Column, vec: Column, rows: int, cols: int) -> Column:
    """Flat row-major rows x cols matrix times a vector."""
    line = F.sequence(F.lit(0), F.lit(rows - 1))

    def product(m, v):
        return F.transform(line, lambda r: total(F.zip_with(F.slice(m, r * cols + 1, F.lit(cols)), v, lambda a, b: a * b)))

    return let(mat, lambda m: let(vec, lambda v: product(m, v)))


def matmul(a: DataFrame, b: DataFrame) -> DataFrame:
    """Product of two matrices in cell form, a(i, k, v) and b(k, j, v): join on k, sum per (i, j)."""
    joined = a.select("i", "k", F.col("v").alias("_a")).join(b.select("k", "j", F.col("v").alias("_b")), "k")
    return joined.groupBy("i", "j").agg(F.sum(F.col("_a") * F.col("_b")).alias("v"))


def hour_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHH")


def vocab_pages(df: DataFrame, col: str, page: int = MAP_PAGE) -> DataFrame:
    """(page, vocab): maps value -> index in sorted order, `page` values each; the number of values has no bound."""
    values = number_rows(df.select(F.col(col).alias("v")).filter("v is not null").distinct(), "v", name="i")
    pairs = values.groupBy(F.floor(F.col("i") / page).alias("page")).agg(F.array_sort(F.collect_list(F.struct("v", "i"))).alias("_p"))
    return pairs.select("page", F.map_from_entries(F.transform("_p", lambda p: F.struct(p["v"], p["i"].cast("int")))).alias("vocab"))


def vocab_map(df: DataFrame, col: str) -> DataFrame:
    """One row with a map value -> index (sorted order): the first page, for small code sets."""
    first = vocab_pages(df, col).filter("page = 0").select("vocab")
    none = F.create_map().cast(first.schema["vocab"].dataType)
    return first.agg(F.coalesce(F.first("vocab"), none).alias("vocab"))


def normal_solve(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Least squares with a bias: centred products on executors, the small scaled solve here.

    Rows with a null take no part. Features that depend on each other share their weight (least norm).
    """
    names = [*features, target]
    whole = df.filter(" and ".join(f"`{c}` is not null" for c in names))
    cells = co_moments(whole, F.array(*[F.col(c).cast("double") for c in names])).collect()  # one per pair of columns
    n = len(names)
    mean, c = np.zeros(n), np.zeros((n, n))
    for r in cells:
        mean[r["i"]], mean[r["j"]] = r["mean_i"], r["mean_j"]
        c[r["i"], r["j"]] = c[r["j"], r["i"]] = r["c"]
    scale = np.sqrt(np.where(np.diag(c) > 0, np.diag(c), 1.0))
    c = c / scale[:, None] / scale[None, :]
    w = np.linalg.lstsq(c[:-1, :-1], c[:-1, -1], rcond=1e-12)[0] * scale[-1] / scale[:-1]
    bias = mean[-1] - w @ mean[:-1]
    return df.sparkSession.createDataFrame([(t, float(v)) for t, v in zip(["bias", *features], [bias, *w])], "term string, weight double")
