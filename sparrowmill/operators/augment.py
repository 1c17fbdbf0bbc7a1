"""Seeded augmentation of flat channel-height-width arrays: the same row and seed give the same result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparrowmill.functions.arrays import let, mean
from sparrowmill.functions.rand import portable_normal, portable_rand


def brightness(arr: Column, key: str, seed: int) -> Column:
    return let(portable_rand(key, seed=f"{seed}b") - 0.5, lambda s: F.transform(arr, lambda x: x + s))


def saturation(arr: Column, key: str, seed: int, dims) -> Column:
    """Scale about the mean over channels at each position by 0 to 2."""
    c, plane = dims[0], dims[1] * dims[2]
    spots = F.sequence(F.lit(0), F.lit(plane - 1))

    def scaled(v, r):
        at = lambda p: sum((F.get(v, p + i * plane) for i in range(1, c)), F.get(v, p)) / c
        means = F.transform(spots, at)
        return let(means, lambda m: F.transform(v, lambda x, i: (x - F.get(m, i % plane)) * r + F.get(m, i % plane)))

    return let(arr, lambda v: let(portable_rand(key, seed=f"{seed}s") * 2, lambda r: scaled(v, r)))


def contrast(arr: Column, key: str, seed: int) -> Column:
    """Scale about the row mean by 0.5 to 1.5."""
    both = lambda v: F.struct(mean(v).alias("m"), (portable_rand(key, seed=f"{seed}c") + 0.5).alias("r"))
    return let(arr, lambda v: let(both(v), lambda s: F.transform(v, lambda x: (x - s["m"]) * s["r"] + s["m"])))


def _draw(key: str, seed, n: int) -> Column:
    """Whole number in 0..n-1."""
    return F.floor(portable_rand(key, seed=seed) * n).cast("int")


def translate(arr: Column, key: str, seed: int, dims, ratio: float = 0.125) -> Column:
    """Shift by up to ratio of each side, zeros where the source is outside."""
    _, h, w = dims
    sx, sy = int(h * ratio + 0.5), int(w * ratio + 0.5)
    shift = F.struct(
        (_draw(key, f"{seed}tx", 2 * sx + 1) - sx).alias("x"), (_draw(key, f"{seed}ty", 2 * sy + 1) - sy).alias("y")
    )

    def moved(v, t):
        def pick(_, i):
            row, col = F.floor(i / w).cast("int") % h + t["x"], i % w + t["y"]
            inside = (row >= 0) & (row < h) & (col >= 0) & (col < w)
            return F.when(inside, F.get(v, i + t["x"] * w + t["y"])).otherwise(F.lit(0.0))

        return F.transform(v, pick)

    return let(arr, lambda v: let(shift, lambda t: moved(v, t)))


def cutout(arr: Column, key: str, seed: int, dims, ratio: float = 0.5) -> Column:
    """Zero a block of ratio times each side at a random place, cut off at the border."""
    _, h, w = dims
    ch, cw = int(h * ratio + 0.5), int(w * ratio + 0.5)

    def edges(axis, n, size):
        lo = _draw(key, f"{seed}o{axis}", n + 1 - size % 2) - size // 2
        clip = lambda x: F.least(F.greatest(x, F.lit(0)), F.lit(n - 1))
        return [clip(lo).alias(f"{axis}0"), clip(lo + (size - 1)).alias(f"{axis}1")]

    block = F.struct(*edges("x", h, ch), *edges("y", w, cw))

    def masked(b):
        def keep(x, i):
            row, col = F.floor(i / w).cast("int") % h, i % w
            inside = row.between(b["x0"], b["x1"]) & col.between(b["y0"], b["y1"])
            return F.when(inside, F.lit(0.0)).otherwise(x)

        return F.transform(arr, keep)

    return let(block, masked)


def dropout(arr: Column, key: str, seed: int, p: float) -> Column:
    """Zero each element with probability p (a uniform draw) and scale the others by 1 / (1 - p)."""
    if p >= 1:
        return F.transform(arr, lambda x: F.lit(0.0))
    return F.transform(
        arr, lambda x, i: F.when(portable_rand(F.col(key), i, seed=f"{seed}d") >= p, x / F.lit(1 - p)).otherwise(F.lit(0.0))
    )


def schedule(spark: SparkSession, steps: int = 50, lo: float = 0.0001, hi: float = 0.02) -> DataFrame:
    """(t, beta, alpha, alpha_bar) of the linear schedule; alpha_bar is the running product of alpha."""
    beta = lambda t: F.lit(lo) + t * F.lit(hi - lo) / F.lit(steps - 1)
    bar = F.aggregate(F.sequence(F.lit(0), F.col("t")), F.lit(1.0), lambda acc, i: acc * (1 - beta(i)))
    rows = spark.range(steps).select(F.col("id").cast("int").alias("t"))
    return rows.select("t", beta(F.col("t")).alias("beta"), (1 - beta(F.col("t"))).alias("alpha"), bar.alias("alpha_bar"))


def add_noise(arr: Column, alpha_bar: Column, key: str, seed: int) -> Column:
    """sqrt(a) * x + sqrt(1 - a) * eps with a standard normal eps per element."""
    scale = F.struct(F.sqrt(alpha_bar).alias("s"), F.sqrt(1 - alpha_bar).alias("n"))
    eps = lambda i: portable_normal(F.col(key), i, seed=f"{seed}n")
    return let(scale, lambda a: F.transform(arr, lambda x, i: a["s"] * x + a["n"] * eps(i)))


def augment(df: DataFrame, policy: str, vec: str, key: str, seed: int, dims=(4, 4, 4)) -> DataFrame:
    """Apply a comma list of named policies in order."""
    steps = {
        "color": [
            lambda a: brightness(a, key, seed), lambda a: saturation(a, key, seed, dims), lambda a: contrast(a, key, seed),
        ],
        "translation": [lambda a: translate(a, key, seed, dims)],
        "cutout": [lambda a: cutout(a, key, seed, dims)],
    }
    for name in filter(None, policy.split(",")):
        for step in steps[name]:
            df = df.withColumn(vec, step(F.col(vec)))
    return df
