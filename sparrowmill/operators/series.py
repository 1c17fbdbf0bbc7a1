"""Series per key: lags, leads, pools, correlation, folds, reports, ranks.

Everything that needs neighbouring rows runs in blocks of the sorted rows (see ordering), so one long
series is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparrowmill.functions.arrays import dot
from sparrowmill.operators.corpus import lookup, top_per_group
from sparrowmill.operators.ordering import (
    BLOCK_ROWS, in_blocks, number_rows, own_rows, position_in_key, running, running_linear, shifted,
)
from sparrowmill.session import materialize


def lag_features(df: DataFrame, keys, order, value: str, tau: int, rows: int = BLOCK_ROWS) -> DataFrame:
    """tau earlier values x1 (oldest) to x<tau> and the target y; rows without a full history are dropped."""
    b, w = in_blocks(df, keys, order, before=tau, rows=rows)
    lags = [shifted(value, keys, w, i - tau).alias(f"x{i + 1}") for i in range(tau)]
    full = shifted(F.lit(True), keys, w, -tau).alias("_full")
    return own_rows(b.select("*", *lags, full)).filter("_full").drop("_full").withColumnRenamed(value, "y")


def horizons(df: DataFrame, keys, order, value: str, steps, rows: int = BLOCK_ROWS) -> DataFrame:
    """The value k rows later for several k; null past the end of the series."""
    b, w = in_blocks(df, keys, order, after=max(steps), rows=rows)
    return own_rows(b.select("*", *[shifted(value, keys, w, k).alias(f"ahead_{k}") for k in steps]))


def neighbour_difference(df: DataFrame, keys, order, value: str, rows: int = BLOCK_ROWS) -> DataFrame:
    b, w = in_blocks(df, keys, order, before=1, rows=rows)
    return own_rows(b.select("*", (F.col(value) - shifted(value, keys, w, -1)).alias("diff")))


def total_variation(df: DataFrame, keys, order, value: str, rows: int = BLOCK_ROWS) -> DataFrame:
    """Half the mean absolute difference of neighbours, per key."""
    d = neighbour_difference(df, keys, order, value, rows)
    return d.groupBy(*keys).agg((F.avg(F.abs("diff")) * 0.5).alias("tv"))


def sliding_pool(df: DataFrame, keys, order, value: str, size: int, rows: int = BLOCK_ROWS) -> DataFrame:
    """Max and mean of each full window of `size` rows, placed at its first row."""
    b, w = in_blocks(df, keys, order, after=size - 1, rows=rows)
    frame = w.rowsBetween(0, size - 1)
    full = shifted(F.lit(True), keys, w, size - 1).alias("_full")
    pooled = b.select("*", F.max(value).over(frame).alias("pool_max"), F.avg(value).over(frame).alias("pool_avg"), full)
    return own_rows(pooled).filter("_full").drop("_full")


def correlate(df: DataFrame, keys, order, value: str, kernel, rows: int = BLOCK_ROWS) -> DataFrame:
    """Cross-correlation with a fixed kernel at the positions where the kernel fits."""
    b, w = in_blocks(df, keys, order, after=len(kernel) - 1, rows=rows)
    terms = [shifted(value, keys, w, i) * F.lit(float(k)) for i, k in enumerate(kernel)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    full = shifted(F.lit(True), keys, w, len(kernel) - 1).alias("_full")
    return own_rows(b.select("*", out.alias("corr"), full)).filter("_full").drop("_full")


def block_pool(df: DataFrame, keys, order, value: str, size: int, stride: int, padding: int = 0) -> DataFrame:
    """Strided pooling with padding: per output cell the max and the mean (padding counts 0 in the mean)."""
    placed = position_in_key(df, keys, order, "_p")
    whole = F.to_json(F.struct(*keys))
    cells = (F.floor((F.col("_n") + 2 * padding - size) / stride) + 1).alias("_cells")
    lengths = df.groupBy(whole.alias("_key")).agg(F.count("*").alias("_n")).select("_key", cells, "_n")
    at = F.col("_p") - 1 + padding
    first = F.greatest(F.ceil((at - size + 1) / stride), F.lit(0)).cast("bigint")
    last = F.floor(at / stride).cast("bigint")
    hit = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    spread = placed.select(*keys, value, F.explode(hit).alias("cell"))
    pooled = spread.groupBy(*keys, "cell").agg(F.max(value).alias("pool_max"), (F.sum(value) / size).alias("pool_avg"))
    # the series length decides which cells are complete; a long series must not load one join task
    sized = lookup(pooled.withColumn("_key", whole), lengths, "_key", "_cells", "_n", F.xxhash64("_key", "cell"))
    return sized.filter(F.col("cell") < F.col("_cells")).drop("_cells", "_key")


def time_split(df: DataFrame, order, n: int) -> DataFrame:
    """The first n rows in time order are train, the others test."""
    rows = number_rows(df, *order, name="_i")
    return rows.withColumn("split", F.when(F.col("_i") < n, "train").otherwise("test")).drop("_i")


def cumulative(df: DataFrame, keys, order, value: Column, rows: int = BLOCK_ROWS) -> DataFrame:
    return running(df, keys, order, {"cumsum": ("sum", value)}, rows)


def cumulative_product(df: DataFrame, keys, order, value: Column, rows: int = BLOCK_ROWS) -> DataFrame:
    """Running product and the product of the rows before, which starts at 1."""
    out = running(df, keys, order, {"cumprod": ("product", value), "cumprod_prev": ("product_before", value)}, rows)
    return out.withColumn("cumprod_prev", F.coalesce("cumprod_prev", F.lit(1.0)))


def moving_statistics(df: DataFrame, keys, order, columns, momentum: float, rows: int = BLOCK_ROWS) -> DataFrame:
    """m = momentum * m + (1 - momentum) * x for each column, starting at 0."""
    return running_linear(df, keys, order, {f"moving_{c}": c for c in columns}, momentum, 1 - momentum, rows)


def velocity(df: DataFrame, keys, order, value: str, gamma: float, rate: float, rows: int = BLOCK_ROWS) -> DataFrame:
    """v = gamma * v + rate * x, starting at 0."""
    return running_linear(df, keys, order, {"velocity": value}, gamma, rate, rows)


def recursive_forecast(df: DataFrame, keys, recent_first, value: str, coeff, steps: int) -> DataFrame:
    """Feed a fixed linear rule over the last len(coeff) values with its own output, `steps` times."""
    tau = len(coeff)
    last = top_per_group(df, keys, recent_first, tau)
    state = last.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct((-F.col("rank")).alias("o"), value))).alias("_s"))
    state = state.filter(F.size("_s") == tau)
    seed = F.transform("_s", lambda p: p[value].cast("double"))
    rule = F.array(*[F.lit(float(c)) for c in coeff])
    path = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)), seed, lambda acc, _: F.concat(acc, F.array(dot(F.slice(acc, -tau, tau), rule)))
    )
    out = state.select(*keys, F.posexplode(F.slice(path, tau + 1, steps)).alias("step", "value"))
    return out.withColumn("step", F.col("step") + 1)


def progress_report(batches: DataFrame, batch: str, samples: str, seconds: str, every: int) -> DataFrame:
    """Batch speed and speed so far, for every `every`-th batch and the last one."""
    run = running(batches, [], [batch], {"total": ("sum", F.col(samples)), "time": ("sum", F.col(seconds))})
    last = batches.agg(F.max(batch)).scalar()
    shown = run.filter(((F.col(batch) + 1) % every == 0) | (F.col(batch) == last))
    return shown.select(
        batch, samples, F.try_divide(F.col(samples).cast("double"), seconds).alias("batch_speed"),
        F.try_divide(F.col("total").cast("double"), "time").alias("avg_speed"),
    )


def latest_version(df: DataFrame, by, name: str, pattern: str) -> DataFrame:
    """Per group the name with the highest number captured by the pattern; names without one are ignored."""
    num = F.regexp_extract(name, pattern, 1)
    found = df.withColumn("version", F.when(num != "", num.cast("bigint"))).filter("version is not null")
    return found.groupBy(*by).agg(F.max("version").alias("version"), F.max_by(name, F.struct("version", name)).alias("latest"))


def rank_frequency(counts: DataFrame, item: str = "gram") -> DataFrame:
    """Rank 1, 2, ... by falling count, ties by item, with the logarithms of rank and count."""
    ranked = number_rows(counts, F.desc("n"), F.asc(item), name="rank", start=1)
    return ranked.select(item, "n", "rank", F.log("rank").alias("log_rank"), F.log("n").alias("log_n"))


def rank_counts(counts: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """The n, rank and logarithms of rank_frequency, without the items.

    Items of one count have consecutive ranks in any order, so the ranks follow from the number of items per
    count and no item is sorted; ranks are written out `rows` at a time.
    """
    sizes = materialize(counts.groupBy("n").agg(F.count(F.lit(1)).alias("_m")))
    upto = running(sizes, [], [F.desc("n")], {"_to": ("sum", F.col("_m"))})
    starts = F.sequence(F.col("_to") - F.col("_m") + 1, F.col("_to"), F.lit(rows).cast("bigint"))
    cut = upto.select("n", "_to", F.explode(starts).alias("_from")).repartition("n", "_from")
    ranks = F.sequence("_from", F.least("_to", F.col("_from") + (rows - 1)))
    ranked = cut.select("n", F.explode(ranks).alias("rank"))
    return ranked.select("n", "rank", F.log("rank").alias("log_rank"), F.log("n").alias("log_n"))


def zipf_exponent(ranked: DataFrame) -> DataFrame:
    return ranked.agg((-F.regr_slope("log_n", "log_rank")).alias("exponent"), F.count("*").alias("n_items"))
