"""Hard-negative mining: cover trees of blocks, searched for the rows in the score windows of anchors and positives."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparrowmill.llm.cover_tree import LONG, CoverTree
from sparrowmill.session import materialize

#: Rows the upper levels are made of: at most so many, and at most so many components.
SAMPLE_ROWS, SAMPLE_VALUES = 4096, 1 << 22
CELLS = 256
#: A block is one tree: at least so many rows, at most so many components, the table in about so many blocks.
BLOCK_ROWS, BLOCK_VALUES, BLOCKS = 4096, 1 << 25, 512
BATCH_QUERIES = 256

FOUND = "query bigint, place int, id bigint, row bigint, score bigint"


def whole(vectors: pa.Array, scale: int) -> list[np.ndarray]:
    """Each vector with every component x as floor(scale * x), as double."""
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64)
    with np.errstate(over="ignore"):
        flat = np.clip(np.floor(flat * scale), -1e300, 1e300)
    ends = np.cumsum([0, *vectors.value_lengths().to_pylist()])
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


class Cells:
    """The upper level of the tree: centres among a bounded sample, for each vector length in it.

    Rows of other lengths share cell 0, which no query of a length in the sample can meet.
    """

    def __init__(self, sample: pa.Table, scale: int, cells: int):
        self.trees: dict[int, Rows] = {size: rows for size, rows in by_size(sample, scale)}
        self.centres: dict[int, tuple[np.ndarray, int]] = {}
        first = 1
        for size, held in self.trees.items():
            everyone = np.arange(len(held.row))
            share = max(1, cells * len(everyone) // sample.num_rows)
            chosen, near = [0], held.tree.distances(everyone, 0)
            while len(chosen) < share and 0 < near.max() < np.inf:
                chosen.append(int(near.argmax()))
                near = np.minimum(near, held.tree.distances(everyone, chosen[-1]))
            self.centres[size] = np.array(chosen), first
            first += len(chosen)
        self.number = first

    def place(self, size: int, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each vector and its distance from the centre, in the norm-augmented space of the sample."""
        if size not in self.centres:
            return np.zeros(len(vectors), np.int64), np.full(len(vectors), np.inf)
        chosen, first = self.centres[size]
        tree = self.trees[size].tree
        with np.errstate(over="ignore", invalid="ignore"):
            squares = (vectors ** 2).sum(axis=1)
            added = np.sqrt(np.maximum(tree.most - squares, 0.0))
            plain = squares[:, None] + tree.squares[chosen] - 2.0 * (vectors @ tree.vectors[chosen].T)
            far = np.sqrt(np.maximum(plain, 0.0) + (added[:, None] - tree.added[chosen]) ** 2)
        far = np.where(np.isnan(far), np.inf, far)
        at = far.argmin(axis=1)
        return first + at, far[np.arange(len(at)), at] + tree.slack

    def bounds(self, size: int, queries: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cells a query of this length can meet, and the least and largest inner products there."""
        if size not in self.centres:
            whole_range = np.full((len(queries), 1), np.inf)
            return np.array([0]), -whole_range, whole_range
        chosen, first = self.centres[size]
        cells = first + np.arange(len(chosen))
        return cells, *self.trees[size].tree.reach(chosen, radius[cells], queries)


class Rows:
    """Rows of one vector length: their tree, labels as numbers, ids and row numbers."""

    def __init__(self, vectors: np.ndarray, labels: list, ids: list, row: np.ndarray):
        self.tree, self.ids, self.row = CoverTree(vectors), ids, row
        self.names: dict = {}
        self.label = np.array([self.names.setdefault(name, len(self.names)) for name in labels])

    def search(self, queries: np.ndarray, labels: list, row: np.ndarray, low, high, k: int, same: bool):
        """query, window, place and score of the first k rows of the same, or of another, label."""
        label = np.array([self.names.get(name, -1) for name in labels])

        def allowed(active, rows):
            alike = label[active][:, None] == self.label[rows]
            return (alike == same) & (row[active][:, None] != self.row[rows])

        return self.tree.search(queries, low, high, allowed, k)


def by_size(rows: pa.Table | pa.RecordBatch, scale: int):
    """Rows of each vector length, in their order."""
    vectors = whole(pa.chunked_array(rows["vector"]).combine_chunks(), scale)
    labels, ids, row = rows["label"].to_pylist(), rows["id"].to_pylist(), rows["row"].to_numpy()
    sizes = np.array([len(v) for v in vectors], np.int64)
    for size in np.unique(sizes).tolist():
        mine = np.flatnonzero(sizes == size)
        yield size, Rows(
            np.array([vectors[i] for i in mine]).reshape(len(mine), size), [labels[i] for i in mine], [ids[i] for i in mine], row[mine]
        )


def queries_by_size(batch: pa.RecordBatch, scale: int):
    """Runs of at most BATCH_QUERIES queries of one length: places in the batch, length, vectors, labels, rows, windows."""
    vectors, labels = whole(batch["vector"], scale), batch["label"].to_pylist()
    low, high = (np.array(batch[c].to_pylist(), np.int64).reshape(len(vectors), -1) for c in ("low", "high"))
    row = batch["row"].to_numpy()
    sizes = np.array([len(v) for v in vectors], np.int64)
    for size in np.unique(sizes).tolist():
        every = np.flatnonzero(sizes == size)
        for start in range(0, len(every), BATCH_QUERIES):
            at = every[start:start + BATCH_QUERIES]
            yield at, size, np.array([vectors[i] for i in at]).reshape(len(at), size), [labels[i] for i in at], row[at], low[at], high[at]


class Blocks:
    """The rows of a table dealt to blocks, each a tree of its own, below cells of a bounded sample.

    A block takes at most `BLOCK_VALUES` components, so it fits in a task; larger cells are cut into several
    blocks by row. The table is stored once with its cells; a search shuffles it once, each row to one
    block, and sends a query only to blocks whose bounds meet its windows.
    """

    def __init__(self, rows: DataFrame, scale: int):
        self.spark, self.scale = rows.sparkSession, scale
        seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("size")).first()
        n, size = seen["n"], max(seen["size"] or 1, 1)
        self.block_rows = max(1, min(max(BLOCK_ROWS, n // BLOCKS), BLOCK_VALUES // size))
        few = max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // size))
        sample = rows.orderBy(F.xxhash64("row"), "row").limit(few).select("row", "id", "label", "vector")
        cells = Cells(sample.toArrow(), scale, min(CELLS, n // self.block_rows + 1))
        self.cells = self.spark.sparkContext.broadcast(cells)
        self.placed = materialize(self._place(rows))
        # one row per cell: CELLS, and one for each vector length of the sample
        told = self.placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()
        parts, radius = np.zeros(cells.number, np.int64), np.zeros(cells.number)
        for r in told:
            parts[r["cell"]], radius[r["cell"]] = -(-r["n"] // self.block_rows), r["far"]
        self.parts, self.first, self.radius = parts, np.cumsum(parts) - parts, radius

    def _place(self, rows: DataFrame) -> DataFrame:
        cells, scale = self.cells, self.scale

        def place(batches):
            for batch in batches:
                vectors = whole(batch["vector"], scale)
                sizes = np.array([len(v) for v in vectors], np.int64)
                cell, far = np.zeros(len(vectors), np.int64), np.zeros(len(vectors))
                for size in np.unique(sizes).tolist():
                    mine = np.flatnonzero(sizes == size)
                    cell[mine], far[mine] = cells.value.place(size, np.array([vectors[i] for i in mine]).reshape(len(mine), size))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], [*batch.schema.names, "cell", "far"])

        kept = rows.select("row", "id", "label", "vector")
        kind = kept.schema["vector"].dataType.simpleString()
        return kept.mapInArrow(place, f"row bigint, id bigint, label string, vector {kind}, cell bigint, far double")

    def _route(self, queries: DataFrame, k: int, same: bool) -> DataFrame:
        """Copies of the queries for the blocks they can find something in, their windows cut by what the sample holds."""
        cells, scale, parts, first, radius = self.cells, self.scale, self.parts, self.first, self.radius

        def route(batches):
            for batch in batches:
                for at, size, vectors, labels, row, low, high in queries_by_size(batch, scale):
                    if size in cells.value.trees:
                        query, window, _, score = cells.value.trees[size].search(vectors, labels, row, low, high, k, same)
                        found = np.zeros(low.shape, np.int64)
                        np.add.at(found, (query, window), 1)
                        worst = np.full(low.shape, 2 * LONG - 1)
                        np.minimum.at(worst, (query, window), score)
                        low = np.where(found >= k, np.maximum(low, worst), low)
                    cell, least, largest = cells.value.bounds(size, vectors, radius)
                    meets = ((largest[:, :, None] >= low[:, None, :]) & (least[:, :, None] <= high[:, None, :]) & (low <= high)[:, None, :]).any(axis=2)
                    query, which = np.nonzero(meets)
                    for part in range(int(parts[cell].max(initial=0))):
                        some = parts[cell[which]] > part
                        if not some.any():
                            continue
                        chosen = query[some]
                        taken = batch.take(pa.array(at[chosen]))
                        yield pa.RecordBatch.from_arrays([
                            pa.array(first[cell[which[some]]] + part), pa.array(np.ones(len(chosen), np.int32)),
                            *(taken[c] for c in ("row", "id", "label", "vector")),
                            pa.array(low[chosen].tolist(), pa.list_(pa.int64())), pa.array(high[chosen].tolist(), pa.list_(pa.int64())),
                        ], ["block", "kind", "row", "id", "label", "vector", "low", "high"])

        kept = queries.select("row", "id", "label", "vector", "low", "high")
        kind = kept.schema["vector"].dataType.simpleString()
        return kept.mapInArrow(
            route, f"block bigint, kind int, row bigint, id bigint, label string, vector {kind}, low array<bigint>, high array<bigint>"
        )

    def search(self, queries: DataFrame, k: int, same: bool) -> DataFrame:
        """The first k rows of the same, or of another, label in each window of each query: query, place, rank, id, row, score.

        `queries` has row, id, label, vector and the windows `low` and `high` (arrays; every query as many); `place`
        is the place of the window. One task sorts the rows of a block before its queries, builds the
        tree and streams the queries against it.
        """
        scale = self.scale
        numbers = lambda values: F.array(*[F.lit(int(v)).cast("bigint") for v in values])
        part = F.pmod(F.xxhash64("row"), F.greatest(numbers(self.parts)[F.col("cell").cast("int")], F.lit(1)))
        none = F.lit(None).cast("array<bigint>")
        rows = self.placed.select(
            (numbers(self.first)[F.col("cell").cast("int")] + part).alias("block"), F.lit(0).alias("kind"),
            "row", "id", "label", "vector", none.alias("low"), none.alias("high"),
        )
        met = rows.unionByName(self._route(queries, k, same)).repartition(max(int(self.parts.sum()), 1), "block")

        def answer(batches):
            block, waiting, trees = None, [], {}
            for batch in batches:
                blocks, kinds = batch["block"].to_numpy(), batch["kind"].to_numpy()
                cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
                for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(blocks)]):
                    run = batch.slice(start, end - start)
                    if start == end:
                        continue
                    if blocks[start] != block:
                        block, waiting, trees = blocks[start], [], None
                    if kinds[start] == 0:
                        waiting.append(run)
                        continue
                    if trees is None:
                        trees = dict(by_size(pa.Table.from_batches(waiting), scale)) if waiting else {}
                        waiting = []
                    for _, size, vectors, labels, row, low, high in queries_by_size(run, scale):
                        if size in trees:
                            held = trees[size]
                            query, window, place, score = held.search(vectors, labels, row, low, high, k, same)
                            yield pa.RecordBatch.from_arrays([
                                pa.array(row[query]), pa.array(window.astype(np.int32)), pa.array([held.ids[p] for p in place.tolist()], pa.int64()),
                                pa.array(held.row[place]), pa.array(score),
                            ], ["query", "place", "id", "row", "score"])

        found = met.sortWithinPartitions("block", "kind", F.col("id").asc_nulls_last(), "row").mapInArrow(answer, FOUND)
        best = Window.partitionBy("query", "place").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
        return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def mine(
    df: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: Column | str = "label",
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A component x counts as floor(scale * x); the score of two rows is their inner product, exactly. The positives of
    an anchor are its first other rows of the same label, the negatives of a pair its first rows of other
    labels with a score from `low` to `high` hundredths of the positive's. Higher scores come first, then
    smaller ids, null last.

    Rows with a null label, a null vector or a null or non-finite component take no part. Vectors meet those of
    their own length only. Repeated rows and ids are rows of their own: each anchor row has its own
    positives, and a copy of it may be one. A row with a null id can be found but is no anchor unless `anchors`
    says so. Scores beyond 2**62 count as 2**62. A negative positive score leaves no window. Extra columns are
    ignored; an empty table gives an empty result.
    """
    label = F.col(label) if isinstance(label, str) else label
    given = df.select(
        F.col(key).cast("bigint").alias("id"), label.cast("string").alias("label"), F.col(vector).alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    )
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    usable = given.filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = materialize(usable.withColumn("row", F.monotonically_increasing_id()))
    blocks = Blocks(rows, scale)
    chosen = rows.filter("anchor").select("row", "id", "label", "vector")
    ends = [F.array(F.lit(v).cast("bigint")).alias(c) for v, c in ((-LONG, "low"), (LONG, "high"))]
    near = blocks.search(chosen.select("*", *ends), positives, same=True)
    near = materialize(near.filter("score >= 0").select("query", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    hundreds, rest = F.expr("positive_score div 100"), F.expr("positive_score % 100")
    window = F.struct(
        "place",
        (hundreds * low + F.floor((rest * low + 99) / 100)).alias("low"),
        (hundreds * high + F.floor(rest * high / 100)).alias("high"),
    )
    windows = near.groupBy("query").agg(F.sort_array(F.collect_list(window)).alias("w"))  # at most `positives` each
    shut = lambda name, value: F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.coalesce(F.get(F.col(f"w.{name}"), i), F.lit(value)).cast("bigint"))
    asked = chosen.join(windows, chosen["row"] == windows["query"]).select("row", "id", "label", "vector", shut("low", 1).alias("low"), shut("high", 0).alias("high"))
    far = blocks.search(asked, negatives, same=False)
    named = chosen.select(F.col("row").alias("query"), F.col("id").alias("anchor_id"))
    return far.join(near, ["query", "place"]).join(named, "query").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
