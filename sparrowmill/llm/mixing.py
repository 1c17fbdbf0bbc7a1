"""Mix of sources to target weights by weighted sampling with exponential keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparrowmill.operators.ordering import number_rows
from sparrowmill.session import materialize

EPOCHS = 3
RATIOS = (1.0, 2.0, 3.0)
BLOCKS = 256
#: So many documents of a source are settled one by one behind the end of a run before all are looked at again.
LOOK_AHEAD = 1024


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) from 52 bits of the md5 of the id and a seed."""
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, ratios=RATIOS, epochs: int = EPOCHS) -> DataFrame:
    """Adds `target` to a table with one row per source (source, source_size, others that stay).

    Sources in code point order, null last, take the ratios in turn and share the total size by them.
    No source gets more than `epochs` times its own size; what is above goes to the others by ratio.
    The common level (target per unit of ratio) rises from round to round as more sources reach their
    limit; a round sums over the source table and stops when the level stays.
    """
    ranked = number_rows(sizes, F.col("source").asc_nulls_last(), name="_rank")
    ratio = F.element_at(F.array(*[F.lit(r) for r in ratios]), (F.col("_rank") % len(ratios)).cast("int") + 1)
    ranked = ranked.withColumn("_ratio", ratio).withColumn("_limit", F.col("source_size") * epochs)
    level = 0.0
    while True:
        full = F.col("_limit") < F.col("_ratio") * F.lit(level)
        total, spent, open_ratio = ranked.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum(F.when(full, F.col("_limit"))), F.lit(0)), F.sum(F.when(~full, F.col("_ratio")))
        ).first()
        if not total or not open_ratio or (total - spent) / open_ratio == level:
            break
        level = (total - spent) / open_ratio
    target = F.least(F.col("_ratio") * F.lit(level), F.col("_limit").cast("double"))
    return ranked.select(*sizes.columns, target.alias("target"))


def mix_sources(
    df: DataFrame,
    size: Column,
    weight: Column,
    key: str = "doc_id",
    source: str = "source",
    ratios=RATIOS,
    epochs: int = EPOCHS,
    seed: int = 17,
    blocks: int = BLOCKS,
    row: str | None = None,
) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, copies, taken.

    A source first takes all its documents as often as its target holds its size (complete epochs).
    The rest of the target is a weighted sample without replacement: keys -ln(u) / weight are sorted
    within the source, and along them a document is in if it fits in what is left of the rest; one that
    does not fit is passed over. What is then still free goes to the one document left over whose size comes
    nearest to it, if that brings the source nearer to its target. So one very long document costs a source
    nothing while smaller ones are left.

    The keys of a source are cut into `blocks` ranges. Sums per range show in which one a run of documents
    ends; only that range is sorted. The outcome is a few runs per source (see _filled), joined back to the
    rows, so a source with a third of all rows is never in one task.

    Null or negative size counts as 0, a weight that is null, NaN or not above 0 as 1. A null source is
    a source. Draws depend on id and seed only, so reruns agree, and repeated ids share their draw;
    ties go to the smaller id. With `row`, a column of unique row ids, they go on to the smaller of these,
    and the result has that column as well. An empty table gives an empty result.
    """
    own = [row] if row else []
    tie = ["_key", "doc_id", *own]
    clean = F.when((weight > 0) & ~F.isnan(weight), weight).otherwise(F.lit(1.0)).cast("double")
    drawn = materialize(
        df.select(
            F.col(key).alias("doc_id"),
            F.col(source).alias("source"),
            F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("bigint").alias("size"),
            (-F.log(uniform(F.col(key), seed)) / clean).alias("_key"),
            clean.alias("_weight"), *own,
        )
    )
    sizes = materialize(
        drawn.groupBy("source").agg(
            F.sum("size").alias("source_size"), F.min("size").alias("_least"), F.sum("_weight").alias("_heavy"), F.count(F.lit(1)).alias("_many")
        )
    )
    usual = sizes.agg(F.sum("_heavy") / F.sum("_many")).first()[0]
    block = F.floor((F.lit(1.0) - F.exp(-F.col("_key") * F.lit(1.0 if usual is None else usual))) * blocks)
    drawn = drawn.withColumn("_block", block)
    targets = source_targets(sizes.drop("_heavy", "_many"), ratios, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = (
        targets.withColumn("_whole", whole)
        .withColumn("_left", F.col("target") - F.col("_whole") * F.col("source_size"))
        .withColumnRenamed("source", "_source")
    )
    same = F.col("source").eqNullSafe(F.col("_source"))
    pos = F.struct("_block", *tie)
    rule = _filled(drawn, targets, pos, tie)
    chosen = F.exists("_runs", lambda r: _in_run(pos, r))
    off = F.abs(F.col("_left") - F.col("size"))
    fitting = (
        drawn.join(rule, same).filter(~chosen & (off < F.col("_left")))
        .groupBy("_source").agg(F.min(F.struct(off.alias("off"), *tie)).alias("_fit"))
        .select("_source", F.struct(*[f"_fit.{c}" for c in tie]).alias("_fit"))
    )
    rule = materialize(_beside(rule, fitting))
    chosen = chosen | F.coalesce(F.struct(*tie) == F.col("_fit"), F.lit(False))
    copies = F.col("_whole") + F.when(chosen, F.lit(1)).otherwise(F.lit(0))
    return drawn.join(rule, same).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), *own
    )


def _in_run(pos: Column, run: Column) -> Column:
    """Whether a document at this place is taken in the run: those from `lo` to `hi` that its beginning had room for."""
    after = run["lo"].isNull() | (pos > run["lo"])
    return after & (pos <= run["hi"]) & (F.col("size") <= run["room"])


def _filled(drawn: DataFrame, targets: DataFrame, pos: Column, tie: list[str]) -> DataFrame:
    """`targets` with `_left`, what is free of the rest, and `_runs` of what is taken along the keys.

    A run takes the documents of a source that fit in what is left at its beginning, one after the other, up to the
    first that does not fit any more, or to the end of the room. That one and all larger ones are passed over, and the next run goes on
    behind it. Each run ends with less room than a document it had room for, so there are few.

    A round stores one table: sums per range show where the run ends, and the next documents, LOOK_AHEAD
    at most, are taken or passed over one by one. What is left behind them, mostly nothing, is for the next round.
    """
    place = drawn.select(pos.alias("p")).schema["p"].dataType
    runs = f"array<struct<lo:{place.simpleString()},hi:{place.simpleString()},room:double>>"
    open_ = (F.col("_left") > 0) & (F.col("_least") <= F.col("_left"))
    state = targets.withColumns({"_runs": F.array().cast(runs), "_from": F.lit(None).cast(place), "_open": open_})
    while True:
        step = _step(drawn, state.filter("_open"), pos, tie, place, runs)
        state = _beside(state.withColumnRenamed("_left", "_room"), step)
        state = materialize(state.select(
            *targets.drop("_left").columns, F.coalesce("_state.left", "_room").alias("_left"),
            F.concat("_runs", F.coalesce("_state.runs", F.array().cast(runs))).alias("_runs"),
            F.coalesce("_state.upto", "_from").alias("_from"),
            (F.col("_state").isNotNull() & (F.col("_state.left") > 0) & (F.col("_least") <= F.col("_state.left"))).alias("_open"),
        ))
        if state.filter("_open").isEmpty():
            return state.drop("_from", "_open", "_least")


def _step(drawn: DataFrame, state: DataFrame, pos: Column, tie: list[str], place, runs: str) -> DataFrame:
    """(_source, _state): for the sources that have documents with room for them behind `_from`, the struct of the
    runs (`runs`), of what is left after them (`left`), and of the place up to which documents are settled (`upto`)."""
    along = Window.partitionBy("source").orderBy("_block")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    until = along.rowsBetween(Window.unboundedPreceding, 0)
    inside = Window.partitionBy("source").orderBy("_block", *tie).rowsBetween(Window.unboundedPreceding, 0)
    same = F.col("source").eqNullSafe(F.col("_source"))
    known = state.select("_source", "_left", "_from")
    fits = (F.col("size") <= F.col("_left")) & (F.col("_from").isNull() | (pos > F.col("_from")))
    rows = drawn.join(known, same).filter(fits).drop("_source")
    before_end = F.col("_before") < F.col("_left")
    ends = (
        rows.groupBy("source", "_block").agg(F.sum("size").alias("_size"), F.count(F.lit(1)).alias("_n"), F.first("_left").alias("_left"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .withColumn("_upto", F.sum("_n").over(until))
        .withColumn("_n_end", F.max(F.when(before_end, F.col("_upto"))).over(Window.partitionBy("source")))
        .groupBy("source").agg(
            F.max(F.when(before_end, F.struct("_block", "_before"))).alias("_end"),
            F.max(F.when(before_end | (F.col("_upto") <= F.col("_n_end") + LOOK_AHEAD), F.col("_block"))).alias("_stop"),
        )
        .select(F.col("source").alias("_s"), F.col("_end._block").alias("_last"), F.col("_end._before").alias("_start"), "_stop")
    )
    in_reach = F.col("source").eqNullSafe(F.col("_s")) & (F.col("_block") >= F.col("_last")) & (F.col("_block") <= F.col("_stop"))
    first_run = (F.col("_sum") <= F.col("_left")) & (F.col("_sum") - F.col("size") < F.col("_left"))
    found = (
        rows.join(ends, in_reach)
        .withColumn("_sum", F.sum("size").over(inside) + F.col("_start"))
        .withColumn("_first_run", first_run)
        .withColumn("_behind", F.sum(F.when(F.col("_first_run"), 0).otherwise(1)).over(inside))
        .filter(F.col("_first_run") | (F.col("_behind") <= LOOK_AHEAD))
        .groupBy(F.col("source").alias("_source")).agg(
            F.first("_left").alias("_left"), F.first("_from").alias("_from"), F.first("_last").alias("_last"), F.first("_start").alias("_start"),
            F.max(F.when(F.col("_first_run"), pos)).alias("_reach"), F.max(F.when(F.col("_first_run"), F.col("_sum"))).alias("_sum"),
            F.sort_array(F.collect_list(F.when(~F.col("_first_run"), F.struct(pos.alias("pos"), "size")))).alias("_next"),  # at most LOOK_AHEAD
        )
    )
    # a run of whole ranges ends before the first document of the next one
    edge = F.struct(F.col("_last").alias("_block"), *[F.lit(None).alias(c) for c in tie]).cast(place)
    begin = F.struct(
        F.col("_from").alias("lo"), F.coalesce("_reach", edge).alias("hi"), F.col("_left").alias("room"),
        F.coalesce("_sum", "_start").cast("bigint").alias("sum"), F.array().cast(runs).alias("runs"),
    )
    ran = lambda s: F.struct(s["lo"].alias("lo"), s["hi"].alias("hi"), s["room"].alias("room"))

    def settle(s: Column, d: Column) -> Column:
        asked = (d["size"] <= s["room"]) & (s["sum"] < s["room"])
        taken = asked & (s["sum"] + d["size"] <= s["room"])
        ended = asked & ~taken
        return F.struct(
            F.when(ended, d["pos"]).otherwise(s["lo"]).alias("lo"),
            F.when(taken, d["pos"]).when(ended, F.lit(None)).otherwise(s["hi"]).alias("hi"),
            F.when(ended, s["room"] - s["sum"]).otherwise(s["room"]).alias("room"),
            F.when(taken, s["sum"] + d["size"]).when(ended, F.lit(0)).otherwise(s["sum"]).alias("sum"),
            F.when(ended, F.array_append(s["runs"], ran(s))).otherwise(s["runs"]).alias("runs"),
        )

    def end(s: Column) -> Column:
        all_runs = F.when(s["hi"].isNull(), s["runs"]).otherwise(F.array_append(s["runs"], ran(s)))
        return F.struct(all_runs.alias("runs"), (s["room"] - s["sum"]).alias("left"))

    ended = F.aggregate("_next", begin, settle, end)
    upto = F.coalesce(F.try_element_at(F.col("_next.pos"), F.lit(-1)), F.col("_reach"))
    return found.withColumn("_e", ended).select("_source", F.struct(F.col("_e.runs").alias("runs"), F.col("_e.left").alias("left"), upto.alias("upto")).alias("_state"))


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join of two tables with one row per `_source`, which may be null."""
    right = right.withColumnRenamed("_source", "_s")
    return left.join(right, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s")
