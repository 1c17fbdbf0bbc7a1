"""Losses and evaluation metrics as one-pass aggregates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparrowmill.functions.arrays import dot, let, total
from sparrowmill.operators.ordering import number_rows

ONE = "*"


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def mse(p, y):
    return F.avg(F.pow(p - y, F.lit(2.0)))


def mae(p, y):
    return F.avg(F.abs(p - y))


def smooth_l1_row(p, y, beta: float = 1.0) -> Column:
    d = F.abs(p - y)
    return F.when(d < beta, d * d * F.lit(0.5 / beta)).otherwise(d - F.lit(0.5 * beta))


def smooth_l1_sigma_row(p, y, sigma: float) -> Column:
    """The form with sigma: quadratic below 1 / sigma**2."""
    d, s2 = F.abs(p - y), sigma * sigma
    return F.when(d < 1.0 / s2, d * d * F.lit(0.5 * s2)).otherwise(d - F.lit(0.5 / s2))


def bce_logits_row(z, y) -> Column:
    """Binary cross-entropy from a logit, in the form that cannot overflow."""
    return F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))


def cross_entropy_row(zs: Column, y: Column) -> Column:
    spread = let(F.array_max(zs), lambda top: top + F.log(total(F.transform(zs, lambda z: F.exp(z - top)))))
    return spread - F.get(zs, y)


def focal_row(z: Column, y: Column, gamma: float = 2.0, eps: float = 1e-10, alpha: float | None = None) -> Column:
    """Focal loss from a logit. The class weight alpha is left out unless given."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    pt = p * y + (1 - p) * (1 - y)
    loss = -F.pow(1 - pt, F.lit(gamma)) * F.log(pt + F.lit(eps))
    return loss if alpha is None else loss * ((1 - F.lit(alpha)) * y + F.lit(alpha) * (1 - y))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))


def cosine_embedding_row(a, b, y, margin: float = 0.0) -> Column:
    c = cosine(a, b)
    return F.when(y == 1, 1 - c).otherwise(F.greatest(c - margin, F.lit(0.0)))


def contrastive_row(a, b, y, margin: float = 1.0, eps: float = 1e-6) -> Column:
    """y * d^2 + (1 - y) * max(margin - d, 0)^2; eps is added to every difference before the distance."""
    d = F.sqrt(total(F.zip_with(a, b, lambda x, z: (x - z + eps) * (x - z + eps))))
    return y * d * d + (1 - y) * F.pow(F.greatest(F.lit(margin) - d, F.lit(0.0)), F.lit(2.0))


def log_rmse(p, y):
    return F.sqrt(F.avg(F.pow(F.log(F.greatest(p, F.lit(1.0))) - F.log(y), F.lit(2.0))))


def masked_mean(losses: Column, valid: Column, normalise: str = "padded") -> Column:
    """Losses past the valid length count 0; the mean is over the padded length unless asked otherwise."""
    kept = F.slice(losses, F.lit(1), F.least(valid, F.size(losses)))
    return total(kept) / (F.size(losses) if normalise == "padded" else F.greatest(valid, F.lit(1)))


def label_score(pred, assigned, scale: float, shift: float) -> list[Column]:
    err = F.abs((pred * scale - abs(shift)) - (assigned * scale - abs(shift)))
    return [F.avg(err).alias("ls_mean"), F.stddev_pop(err).alias("ls_std")]


def binary_metrics(pred: Column, truth: Column) -> list[Column]:
    hit = lambda c: F.sum(F.when(c, 1).otherwise(0))
    tp, fp, fn = hit((pred == 1) & (truth == 1)), hit((pred == 1) & (truth == 0)), hit((pred == 0) & (truth == 1))
    right = hit(pred == truth)
    return [
        ratio(right, F.count(ONE)).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def histogram(df: DataFrame, value: Column, bins: int, lo=None, hi=None, by=()) -> DataFrame:
    """Counts in equal bins over [lo, hi], by default the range of the data; the last bin is closed on the right."""
    lo = df.agg(F.min(value).cast("double")).scalar() if lo is None else F.lit(float(lo))
    hi = df.agg(F.max(value).cast("double")).scalar() if hi is None else F.lit(float(hi))
    inside = df.filter((value >= lo) & (value <= hi))
    width = (hi - lo) / F.lit(float(bins))
    bin_no = F.least(F.floor(F.coalesce(F.try_divide(value - lo, width), F.lit(0.0))), F.lit(bins - 1)).cast("bigint")
    return inside.groupBy(*by, bin_no.alias("bin")).agg(F.count(ONE).alias("n"))


#: Numbers a worker holds in matrices of groups before it hands them on.
HELD_NUMBERS = 1 << 23


def _merged(one, two):
    """Count, means and centred products of two sets of rows together."""
    (n, mean, m), (k, other, p) = one, two
    apart = other - mean
    return n + k, mean + apart * (k / (n + k)), m + p + np.outer(apart, apart) * (n * k / (n + k))


def co_moments(df: DataFrame, vec: Column, by=(), held: int = HELD_NUMBERS) -> DataFrame:
    """Per group and (i, j), i <= j: n, mean_i, mean_j and c, the sum of (x_i - mean_i) * (x_j - mean_j).

    A task turns each Arrow batch of a group into a count, a mean vector and a centred d x d product and merges
    it pairwise with what it holds of the group, so nothing is ever summed about a point far from the
    data. Beyond `held` numbers it hands its groups on and starts anew. The states of all tasks meet cell by
    cell: means first, then each state's product about the mean of all.

    Rows with a null vector take no part; vectors of different lengths do not mix.
    """
    keys = list(by)
    src = df.select(*keys, vec.cast("array<double>").alias("_v")).filter("_v is not null").withColumn("_d", F.size("_v"))
    head = "".join(f"`{k}` {src.schema[k].dataType.simpleString()}, " for k in keys)

    def states(batches):
        found, numbers = {}, 0

        def cells():
            for key, (n, mean, m) in found.items():
                i, j = np.triu_indices(len(mean))
                out = pd.DataFrame({"i": i, "j": j, "_n": n, "_mi": mean[i], "_mj": mean[j], "_c": m[i, j]})
                for at, k in enumerate(keys):
                    name = None if key[at] != key[at] else key[at]
                    out.insert(at, k, pd.Series([name] * len(out), dtype=object))
                yield out

        for pdf in batches:
            for key, part in pdf.groupby([*keys, "_d"], sort=False, dropna=False):
                x = np.stack(part["_v"].to_numpy())
                mean = x.mean(axis=0)
                state = len(x), mean, (x - mean).T @ (x - mean)
                if key in found:
                    found[key] = _merged(found[key], state)
                    continue
                found[key], numbers = state, numbers + len(mean) ** 2
                if numbers > held:
                    yield from cells()
                    found, numbers = {}, 0
        yield from cells()

    part = src.mapInPandas(states, f"{head}i bigint, j bigint, _n bigint, _mi double, _mj double, _c double")
    cell = Window.partitionBy(*keys, "i", "j")
    n = F.sum("_n").over(cell)
    whole = part.select("*", n.alias("n"), *[(F.sum(F.col("_n") / n * F.col(f"_m{x}")).over(cell)).alias(f"mean_{x}") for x in "ij"])
    apart = F.col("_n") * (F.col("_mi") - F.col("mean_i")) * (F.col("_mj") - F.col("mean_j"))
    return whole.groupBy(*keys, "i", "j").agg(
        F.first("n").alias("n"), F.first("mean_i").alias("mean_i"), F.first("mean_j").alias("mean_j"), F.sum(F.col("_c") + apart).alias("c")
    )


def covariance(df: DataFrame, vec: Column, by=()) -> DataFrame:
    """Sample covariance (ddof 1) and the two means, for i <= j; null for a group of one row."""
    cov = F.try_divide(F.col("c"), F.col("n") - 1).alias("cov")
    return co_moments(df, vec, by).select(*by, "i", "j", "mean_i", "mean_j", cov)


def gram(df: DataFrame, vec: Column, channels: int, by=()) -> DataFrame:
    """sum(x_i * x_j) / (channels * n) over the n rows."""
    mean = F.col("c") / F.col("n") + F.col("mean_i") * F.col("mean_j")
    return co_moments(df, vec, by).select(*by, "i", "j", (mean / F.lit(channels)).alias("g"))


def _moments(df: DataFrame, vec: Column):
    cells = covariance(df, vec).collect()  # d * (d + 1) / 2 cells, whatever the number of rows
    d = max(r["i"] for r in cells) + 1
    mu, cov = np.zeros(d), np.zeros((d, d))
    for r in cells:
        mu[r["i"]] = r["mean_i"]
        cov[r["i"], r["j"]] = cov[r["j"], r["i"]] = r["cov"]
    return mu, cov


def frechet(a: DataFrame, b: DataFrame, vec: Column) -> float:
    """Frechet distance of two vector sets: moments on executors, one d x d eigen-decomposition here.

    Singular covariances need no shift: the eigenvalues of s1 @ s2 are those of the symmetric
    root(s1) @ s2 @ root(s1), whose small negative ones are rounding and count as 0.
    """
    (m1, s1), (m2, s2) = _moments(a, vec), _moments(b, vec)
    w, v = np.linalg.eigh(s1)
    root = (v * np.sqrt(np.clip(w, 0, None))) @ v.T
    inner = np.linalg.eigvalsh(root @ s2 @ root)
    trace = np.sqrt(np.clip(inner, 0, None)).sum()
    return float(((m1 - m2) ** 2).sum() + np.trace(s1) + np.trace(s2) - 2 * trace)


def frechet_diagonal(a: DataFrame, b: DataFrame, vec: Column) -> DataFrame:
    """One row `distance`: the Frechet distance of two vector sets as if their components did not vary together."""
    def each(df, side):
        long = df.select(F.posexplode(vec.cast("array<double>")).alias("i", "x"))
        return long.groupBy("i").agg(F.avg("x").alias(f"m{side}"), F.stddev_samp("x").alias(f"s{side}"))

    both = each(a, 1).join(each(b, 2), "i")
    square = lambda x, y: (F.col(x) - F.col(y)) * (F.col(x) - F.col(y))
    return both.agg(F.sum(square("m1", "m2") + square("s1", "s2")).alias("distance"))


def inception_score(df: DataFrame, order, probs: str, splits: int) -> DataFrame:
    """Mean and population deviation over splits of exp(mean KL(p(y|x), p(y))).

    sum_x KL = sum p ln p - n * sum_c mean_c ln mean_c, so one aggregate per (split, class) is enough.
    """
    rows = number_rows(df, *order, name="_i")
    size = rows.agg(F.floor(F.count(ONE) / splits)).scalar()
    parts = rows.withColumn("split", F.floor(F.col("_i") / size)).filter(F.col("split") < splits)
    long = parts.select("split", F.posexplode(probs).alias("c", "p"))
    per_class = long.groupBy("split", "c").agg(
        F.count(ONE).alias("n"), F.avg("p").alias("m"), F.sum(F.when(F.col("p") > 0, F.col("p") * F.log("p"))).alias("plogp")
    )
    per_split = per_class.groupBy("split").agg(
        F.exp((F.sum("plogp") - F.sum(F.col("n") * F.col("m") * F.log("m"))) / F.max("n")).alias("score")
    )
    return per_split.agg(F.avg("score").alias("is_mean"), F.stddev_pop("score").alias("is_std"))


def linear_fit(df: DataFrame, x: Column, y: Column, by=()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.count(ONE).alias("n")
    )


class _Line:
    """Count, means and centred products of pairs (x, y); those of two sets add up pairwise."""

    def __init__(self, n=0, mx=0.0, my=0.0, xx=0.0, xy=0.0, yy=0.0):
        self.n, self.mx, self.my, self.xx, self.xy, self.yy = n, mx, my, xx, xy, yy

    def __add__(self, other: _Line) -> _Line:
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        dx, dy, w = other.mx - self.mx, other.my - self.my, self.n * other.n / n
        share = other.n / n
        return _Line(
            n, self.mx + dx * share, self.my + dy * share, self.xx + other.xx + dx * dx * w,
            self.xy + other.xy + dx * dy * w, self.yy + other.yy + dy * dy * w,
        )

    def error(self, slope: float, mx: float, my: float) -> float | None:
        """Root mean squared error of the line through (mx, my)."""
        if not self.n:
            return None
        off = (self.my - my) - slope * (self.mx - mx)
        return max((self.yy - 2 * slope * self.xy + slope * slope * self.xx) / self.n + off * off, 0.0) ** 0.5


def kfold_line_errors(folds: DataFrame, x: Column, y: Column, fold: str = "fold") -> DataFrame:
    """Per fold: fit on the other folds, root mean squared error on both sides.

    Only count, means and centred products per fold leave the partial aggregates; those of the other folds
    are added up here, without sums about 0. Where the other folds have one x only, the line is null.
    """
    pairs = folds.select(fold, x.cast("double").alias("_x"), y.cast("double").alias("_y")).filter("_x is not null and _y is not null")
    per = pairs.groupBy(fold).agg(
        F.count(ONE).alias("n"), F.avg("_x").alias("mx"), F.avg("_y").alias("my"),
        *[(F.covar_pop(a, b) * F.count(ONE)).alias(name) for a, b, name in (("_x", "_x", "xx"), ("_x", "_y", "xy"), ("_y", "_y", "yy"))],
    )
    held = {r[fold]: _Line(*(r[c] for c in ("n", "mx", "my", "xx", "xy", "yy"))) for r in per.collect()}  # one row per fold
    out = []
    for name in sorted(held):
        train = sum((s for f, s in held.items() if f != name), _Line())
        if train.xx > 0:
            slope = train.xy / train.xx
            line = slope, train.my - slope * train.mx, train.error(slope, train.mx, train.my), held[name].error(slope, train.mx, train.my)
        else:
            line = None, None, None, None
        out.append((int(name), *line))
    return folds.sparkSession.createDataFrame(
        out, "fold bigint, slope double, intercept double, train_rmse double, valid_rmse double"
    )


def fold_means(errors: DataFrame) -> DataFrame:
    """One row: number of folds with a line, mean train and mean valid error over them."""
    return errors.filter("slope is not null").agg(
        F.count(ONE).alias("folds"), F.avg("train_rmse").alias("train_rmse"), F.avg("valid_rmse").alias("valid_rmse")
    )


def split_counts(df: DataFrame, split: str, key: str) -> DataFrame:
    """(split, n, n_distinct): rows and distinct keys of each split, and of all as `total`."""
    marked = df.select(F.explode(F.array(F.col(split).cast("string"), F.lit("total"))).alias("split"), F.col(key).alias("_k"))
    return marked.groupBy("split").agg(F.count(ONE).alias("n"), F.count_distinct("_k").alias("n_distinct"))


def throughput(df: DataFrame, by, samples: Column, size: Column, seconds: Column, order: Column) -> DataFrame:
    """Samples, bytes, seconds, samples per second, MB (2**20 bytes) per second, seconds of the first row."""
    out = df.groupBy(*by).agg(
        F.sum(samples).alias("samples"), F.sum(size).alias("bytes"), F.sum(seconds).alias("seconds"),
        F.min_by(seconds, order).alias("first_seconds"),
    )
    return out.withColumns({
        "per_second": ratio(F.col("samples"), F.col("seconds")),
        "mb_per_second": ratio(F.col("bytes"), F.lit(1048576.0) * F.col("seconds")),
    })


# fixed values: samples per second above which a reader gets the grade
GRADES = ((1000, "excellent"), (500, "good"), (200, "fair"))


def grade(speed: Column) -> Column:
    out = F.lit("slow")
    for limit, name in reversed(GRADES):
        out = F.when(speed > limit, F.lit(name)).otherwise(out)
    return out
