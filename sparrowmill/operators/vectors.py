"""Vector similarity."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparrowmill.functions.arrays import doubles
from sparrowmill.operators.corpus import top_per_group
from sparrowmill.operators.metrics import cosine, euclidean

#: A block of rows is held by one task; queries meet it so many rows and queries at a time.
BLOCK_ROWS, BLOCK_VALUES = 1 << 18, 1 << 24
SCAN_ROWS, SCAN_QUERIES = 2048, 256


def pair_similarity(df: DataFrame, pairs: DataFrame, key: str, vec: str) -> DataFrame:
    """Cosine and L2 distance of the listed pairs (a_id, b_id)."""
    a = df.select(F.col(key).alias("a_id"), doubles(vec).alias("_a"))
    b = df.select(F.col(key).alias("b_id"), doubles(vec).alias("_b"))
    both = pairs.join(a, "a_id").join(b, "b_id")
    return both.select(
        *pairs.columns, cosine(F.col("_a"), F.col("_b")).alias("cosine"), euclidean(F.col("_a"), F.col("_b")).alias("l2")
    )


def class_means(df: DataFrame, label: str, vec: str) -> DataFrame:
    """(query_id, vec): the mean vector of each class."""
    long = df.select(F.col(label).alias("query_id"), F.posexplode(doubles(vec)).alias("i", "x"))
    cells = long.groupBy("query_id", "i").agg(F.avg("x").alias("x"))
    rows = cells.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("_p"))
    return rows.select("query_id", F.transform("_p", lambda p: p["x"]).alias("vec"))


def nearest(df: DataFrame, queries: DataFrame, key: str, vec: str, k: int, metric: str = "cosine") -> DataFrame:
    """Exact k nearest rows for each query (query_id, vec): (query_id, key, score, rank).

    Rows are dealt by hash to blocks of at most about BLOCK_ROWS rows and BLOCK_VALUES components, and every
    query goes to every block: the smaller side is copied, as often as there are blocks. A task holds one
    block, streams the queries against it in matrix products and keeps a running k-th score per query, so
    a query leaves at most k rows per block. Scores are ranked by nine decimals, ties by key. Rows whose
    score is undefined (a zero vector, no number, null) take no part.
    """
    if metric not in ("cosine", "l2"):
        raise ValueError(metric)
    id_type, q_type = dict(df.dtypes)[key], dict(queries.dtypes)["query_id"]
    rows = df.select(F.col(key).alias("id"), doubles(vec).alias("v")).filter("v is not null")
    seen = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    blocks = max(1, -(-seen["n"] // max(1, min(BLOCK_ROWS, BLOCK_VALUES // max(seen["d"] or 1, 1)))))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = rows.select(F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "id", F.lit(None).cast(q_type).alias("query_id"), "v")
    right = queries.filter("vec is not null").select(every.alias("block"), F.lit(1).alias("kind"), F.lit(None).cast(id_type).alias("id"), "query_id", F.col("vec").alias("v"))
    met = left.unionByName(right).repartition(blocks, "block").sortWithinPartitions("block", "kind", "id")
    found = met.mapInArrow(_scan_blocks(k, metric), f"query_id {q_type}, `{key}` {id_type}, score double")
    first = F.desc(F.round("score", 9)) if metric == "cosine" else F.asc(F.round("score", 9))
    return top_per_group(found, ["query_id"], [first, key], k)


def _matrix(lists: pa.Array) -> np.ndarray:
    return np.asarray(lists.flatten().to_numpy(zero_copy_only=False), dtype=float).reshape(len(lists), -1)


def _scores(x: np.ndarray, q: np.ndarray, metric: str) -> np.ndarray:
    """Scores of all queries (rows) and rows (columns)."""
    if metric == "cosine":
        norms = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1)[None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            return (q @ x.T) / norms
    square = (q * q).sum(1)[:, None] + (x * x).sum(1)[None, :] - 2 * q @ x.T
    return np.sqrt(np.clip(square, 0, None))


def _first(score: np.ndarray, at: np.ndarray, k: int, sign: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best columns of each row, by rounded score and then place; undefined scores last."""
    rank = np.where(np.isfinite(score), sign * score.round(9), np.inf)
    order = np.lexsort((at, rank), axis=1)[:, :k]
    return np.take_along_axis(score, order, axis=1), np.take_along_axis(at, order, axis=1)


def _scan_blocks(k: int, metric: str):
    sign = -1 if metric == "cosine" else 1

    def answer(run: pa.RecordBatch, ids: pa.Array, x: np.ndarray):
        q = _matrix(run.column("v"))
        score, at = np.full((len(q), k), np.nan), np.full((len(q), k), len(ids))
        for start in range(0, len(x), SCAN_ROWS):
            new = _scores(x[start:start + SCAN_ROWS], q, metric)
            # only columns that beat the running k-th score of some query are ranked
            last = np.where(np.isfinite(score[:, -1]), sign * score[:, -1].round(9), np.inf)
            with np.errstate(invalid="ignore"):
                some = np.flatnonzero((np.isfinite(new) & (sign * new.round(9) < last[:, None])).any(axis=0))
            if len(some):
                places = np.broadcast_to(start + some, (len(q), len(some)))
                score, at = _first(np.concatenate([score, new[:, some]], axis=1), np.concatenate([at, places], axis=1), k, sign)
        query, column = np.nonzero(np.isfinite(score) & (at < len(ids)))
        return pa.RecordBatch.from_arrays(
            [run.column("query_id").take(pa.array(query)), ids.take(pa.array(at[query, column])), pa.array(score[query, column])],
            ["query_id", "id", "score"],
        )

    def scan(batches):
        block, waiting, ids, x = None, [], None, None
        for batch in batches:
            blocks, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            cuts = (np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1).tolist()
            for start, end in zip([0, *cuts], [*cuts, len(blocks)]):
                if start == end:
                    continue
                run = batch.slice(start, end - start)
                if blocks[start] != block:
                    block, waiting, x = blocks[start], [], None
                if kinds[start] == 0:
                    waiting.append(run)
                    continue
                if x is None and waiting:
                    held = pa.Table.from_batches(waiting).combine_chunks()
                    ids, x, waiting = held["id"].combine_chunks(), _matrix(held["v"].combine_chunks()), []
                if x is not None:
                    for at in range(0, len(run), SCAN_QUERIES):
                        yield answer(run.slice(at, SCAN_QUERIES), ids, x)

    return scan
