"""Row order without a single-task window.

A DataFrame has no row order and an un-partitioned window pulls every row into one task. The helpers
here sort by range, write the sorted rows once, and number them from per-partition counts. Windows
then run over blocks of consecutive row numbers, so a key that holds a third of all rows is spread
over as many blocks as it needs.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparrowmill.session import materialize

BLOCK_ROWS = 65536

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition number above this bit


def as_columns(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def number_rows(df: DataFrame, *order, name: str = "source_index", start: int = 0) -> DataFrame:
    """Number rows 0, 1, 2, ... by a total order.

    One range shuffle, one write of the sorted rows, one count per partition. The offsets are one
    number per partition, never more than the shuffle partition count.
    """
    order = as_columns(order)
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(placed.withColumn("_slot", F.monotonically_increasing_id()))
    part = F.shiftright("_slot", _LOCAL_BITS)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = {r["part"]: r["n"] for r in counts}
    last = max(sizes, default=0)
    before = [start, *accumulate((sizes.get(p, 0) for p in range(last)), initial=start)][1:] or [start]
    offset = F.array(*[F.lit(b).cast("bigint") for b in before])[part.cast("int")]
    local = F.col("_slot").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return placed.withColumn(name, offset + local).drop("_slot")


def in_blocks(
    df: DataFrame, keys, order, before: int = 0, after: int = 0, rows: int = BLOCK_ROWS
) -> tuple[DataFrame, Window]:
    """Cut the rows, sorted by key and order, into blocks with copies of the neighbouring rows.

    Returns the rows with `_pos`, `_block` and `_own` and a window over one block. A row is copied
    into the next block when it is one of the last `before` rows of its block, and into the previous
    block when it is one of the first `after`. Only rows with `_own` belong to the result.
    """
    if max(before, after) > rows:
        raise ValueError("the frame is longer than a block")
    numbered = number_rows(df, *keys, *order, name="_pos")
    home = F.floor(F.col("_pos") / rows)
    at = F.col("_pos") % rows
    targets = [F.struct(home.alias("block"), F.lit(True).alias("own"))]
    if before:
        nxt = F.struct((home + 1).alias("block"), F.lit(False).alias("own"))
        targets.append(F.when(at >= rows - before, nxt))
    if after:
        prev = F.struct((home - 1).alias("block"), F.lit(False).alias("own"))
        targets.append(F.when((at < after) & (home > 0), prev))
    spread = numbered.withColumn("_copy", F.explode(F.array_compact(F.array(*targets))))
    spread = spread.withColumn("_block", F.col("_copy.block")).withColumn("_own", F.col("_copy.own"))
    return spread.drop("_copy"), Window.partitionBy("_block").orderBy("_pos")


def own_rows(df: DataFrame) -> DataFrame:
    return df.filter("_own").drop("_own", "_block", "_pos")


def shifted(value, keys, window: Window, by: int) -> Column:
    """Value `by` rows later (earlier if negative) inside the same key, else null."""
    value = F.col(value) if isinstance(value, str) else value
    same = F.lit(True)
    for k in keys:
        same = same & F.lead(k, by).over(window).eqNullSafe(F.col(k))
    return F.when(same & F.lead(F.lit(1), by).over(window).isNotNull(), F.lead(value, by).over(window))


_KINDS = {
    # kind: (windowed and total aggregate, combination with the carry)
    "count": (lambda c: F.count(F.lit(1)), lambda a, b: a + b),
    "sum": (F.sum, lambda a, b: a + b),
    "product": (F.product, lambda a, b: a * b),
    "max": (F.max, lambda a, b: F.greatest(a, b)),
}


def running(df: DataFrame, keys, order, outputs: dict, rows: int = BLOCK_ROWS) -> DataFrame:
    """Running aggregates per key: `outputs` maps a new column to (kind, column).

    Kinds are count, sum, product and max, including the row itself; with the suffix _before they
    leave it out and are null on the first row of a key.

    Each block is scanned on its own; what earlier blocks of the same key add is carried over. Only
    the first key of a block can have a carry, so the carry table has at most one row per block.
    """
    numbered = number_rows(df, *keys, *order, name="_pos")
    numbered = numbered.withColumn("_block", F.floor(F.col("_pos") / rows))
    # one shuffle by block serves the windows and the join with the carry
    placed = numbered.repartition("_block")
    scan = Window.partitionBy("_block", *keys).orderBy("_pos")
    frame = lambda kind: scan.rowsBetween(Window.unboundedPreceding, -1 if kind.endswith("_before") else 0)
    base = {n: (kind.removesuffix("_before"), col) for n, (kind, col) in outputs.items()}
    local = placed.select(
        "*", *[_KINDS[base[n][0]][0](col).over(frame(kind)).alias(f"_l_{n}") for n, (kind, col) in outputs.items()]
    )
    carry = _carry(numbered, keys, rows, base)
    joined = local.join(carry, (F.col("_block") == F.col("_cb")) & (F.col("_pos") <= F.col("_upto")), "left")
    result = []
    for n, (kind, _) in base.items():
        mine, earlier = F.col(f"_l_{n}"), F.col(f"_c_{n}")
        merged = F.when(earlier.isNull(), mine).when(mine.isNull(), earlier)
        result.append(merged.otherwise(_KINDS[kind][1](mine, earlier)).alias(n))
    return joined.select(*df.columns, *result)


def _carry(numbered: DataFrame, keys, rows: int, outputs: dict) -> DataFrame:
    totals = numbered.groupBy("_block", *keys).agg(
        F.min("_pos").alias("_from"),
        F.max("_pos").alias("_upto"),
        *[_KINDS[kind][0](col).alias(f"_t_{n}") for n, (kind, col) in outputs.items()],
    )
    # only runs that touch a block edge can go on in the next block: at most two per block
    edges = totals.filter((F.col("_from") % rows == 0) | (F.col("_upto") % rows == rows - 1))
    groups = list(keys) or [F.lit(0)]
    past = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        F.col("_block").alias("_cb"),
        "_upto",
        F.count(F.lit(1)).over(past).alias("_n_before"),
        *[_KINDS[kind][0](F.col(f"_t_{n}")).over(past).alias(f"_c_{n}") if kind != "count"
          else F.sum(f"_t_{n}").over(past).alias(f"_c_{n}") for n, (kind, _) in outputs.items()],
    )
    return carried.filter("_n_before > 0").drop("_n_before")


def position_in_key(df: DataFrame, keys, order, name: str = "pos", rows: int = BLOCK_ROWS) -> DataFrame:
    """1-based position of a row inside its key."""
    return running(df, keys, order, {name: ("count", None)}, rows)


def affine_scan(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Compositions of the maps s -> a * s + b, each of all maps up to it: doubling steps over whole arrays."""
    a, b = a.copy(), b.copy()
    step = 1
    while step < len(a):
        b[step:] += _through(a[step:], b[:-step])
        a[step:] *= a[:-step]
        step *= 2
    return a, b


def _through(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b, and 0 where a is 0: an infinite value stays in its key."""
    with np.errstate(invalid="ignore"):
        return np.where(a == 0, 0.0, a * b)


def running_linear(
    df: DataFrame, keys, order, outputs: dict[str, str], decay: float, gain: float, rows: int = BLOCK_ROWS
) -> DataFrame:
    """Per key the recurrence s = decay * s + gain * value, starting at 0; a value that is null or no number leaves s as it is.

    `outputs` maps a new column to its value column. A row is the map s -> a * s + b; the first row of a key has
    a = 0, so one scan over all rows in the order of their keys serves all of them. Maps compose in any
    grouping: each block of `rows` rows is scanned by itself, then the totals of the blocks, again in
    blocks, until one block is left; what enters a block is added by one join. So neither a row loop nor
    a key is ever in one task. Jobs run while the frame is built: the sort, and one per level of blocks.
    """
    numbered = number_rows(df, *keys, *order, name="_pos").withColumn("_block", F.floor(F.col("_pos") / rows))
    heads = _block_heads(numbered, keys)
    names = list(outputs)
    made = ", ".join(f"`_a_{n}` double, `_b_{n}` double" for n in names)

    def scan(table):
        table = table.sort_by("_pos")
        head = np.zeros(table.num_rows, dtype=bool)
        head[0] = table.column("_head")[0].as_py()
        for k in keys:
            code = table.column(k).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            head[1:] |= code[1:] != code[:-1]
        for name, value in outputs.items():
            x = table.column(value).cast("double").to_numpy()
            known = ~np.isnan(x)
            a = np.where(head, 0.0, np.where(known, decay, 1.0))
            a, b = affine_scan(a, np.where(known, gain * np.where(known, x, 0.0), 0.0))
            table = table.append_column(f"_a_{name}", pa.array(a)).append_column(f"_b_{name}", pa.array(b))
        return table

    placed = numbered.join(heads, "_block")
    local = materialize(placed.groupBy("_block").applyInArrow(scan, f"{_ddl(placed.schema)}, {made}"))
    entering = _entering(_totals(local, names), names, rows)
    joined = local.join(entering, "_block")
    return joined.select(*df.columns, *[_after(n).alias(n) for n in names])


def _after(name: str) -> Column:
    """What the map of a row makes of the state that enters its block."""
    a, b, c = (F.col(f"_{kind}_{name}") for kind in "abc")
    return F.when(a == 0, b).otherwise(b + a * c)


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _block_heads(numbered: DataFrame, keys) -> DataFrame:
    """(_block, _head): whether the first row of a block starts a key. One row per block."""
    key = F.struct(F.lit(0).alias("_"), *keys)
    ends = materialize(numbered.groupBy("_block").agg(F.min_by(key, "_pos").alias("_first"), F.max_by(key, "_pos").alias("_last")))
    before = ends.select((F.col("_block") + 1).alias("_block"), F.col("_last").alias("_before"))
    same = F.col("_first").eqNullSafe(F.col("_before"))
    return materialize(ends.join(before, "_block", "left").select("_block", (~same).alias("_head")))


def _totals(scanned: DataFrame, names) -> DataFrame:
    """(_block, _a_*, _b_*): the map of each whole block, that of its last row."""
    made = [f"_{kind}_{n}" for n in names for kind in "ab"]
    last = scanned.groupBy("_block").agg(F.max_by(F.struct(*made), "_pos").alias("_t"))
    return materialize(last.select("_block", *[F.col(f"_t.{c}").alias(c) for c in made]))


def _entering(totals: DataFrame, names, rows: int) -> DataFrame:
    """(_block, _c_*): the state that enters each block, from the maps of the blocks before it."""
    maps = totals.withColumnRenamed("_block", "_pos").withColumn("_block", F.floor(F.col("_pos") / rows))

    def scan(table):
        table = table.sort_by("_pos")
        out = {"_pos": table.column("_pos"), "_block": table.column("_block")}
        for n in names:
            out[f"_a_{n}"], out[f"_b_{n}"] = affine_scan(*(table.column(f"_{kind}_{n}").to_numpy() for kind in "ab"))
        return pa.table(out)

    made = ", ".join(f"`_a_{n}` double, `_b_{n}` double" for n in names)
    local = materialize(maps.groupBy("_block").applyInArrow(scan, f"_pos bigint, _block bigint, {made}"))
    many = totals.agg(F.max("_block")).first()[0] or 0
    if many >= rows:
        local = local.join(_entering(_totals(local, names), names, rows), "_block")
    else:  # one block of blocks, and nothing enters it
        local = local.withColumns({f"_c_{n}": F.lit(0.0) for n in names})
    after = [_after(n).alias(f"_c_{n}") for n in names]
    first = local.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("_block"), *[F.lit(0.0).alias(f"_c_{n}") for n in names])
    return materialize(local.select((F.col("_pos") + 1).alias("_block"), *after).unionByName(first))
