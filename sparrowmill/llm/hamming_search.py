"""Nearest vectors by multi-index hashing over learned binary codes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparrowmill.session import materialize

BITS = 64
SUBSTRINGS = 4
#: The rotation is learned on at most this many vectors, those with the smallest hash of the id.
SAMPLE = 20_000
#: The radius comes from the exact neighbours, among all rows, of at most this many queries.
PROBES = 200
#: Share of those neighbours that the radius must reach.
REACH = 0.96
#: Index rows of one task: the index in about PIECES pieces, within these bounds; larger buckets are split.
ROWS_PER_TASK, PIECES, MOST_ROWS_PER_TASK = 20_000, 4096, 400_000
#: Queries that meet a piece at a time.
QUERIES_AT_ONCE = 1024
#: The index is cut by substring and by this many upper bits of it.
HIGH_BITS = 2
_WIDTH = BITS // SUBSTRINGS


def usable(vector: Column) -> Column:
    """The vector is not null or zero and has only finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def learn_rotation(sample: np.ndarray, bits: int = BITS, rounds: int = 30, seed: int = 3) -> np.ndarray:
    """Directions, one per bit, whose signs lose least of the sample (iterative quantization).

    The sample is rotated to its principal directions, and these by the rotation that brings them
    nearest to their signs, in alternating steps. If there are more bits than directions, further
    rotations from other starts are added.
    """
    rng = np.random.default_rng(seed)
    _, vectors = np.linalg.eigh(sample.T @ sample)
    found, left = [], bits
    while left:
        basis = vectors[:, ::-1][:, : min(left, sample.shape[1])]
        flat = sample @ basis
        turn = np.linalg.qr(rng.normal(size=(basis.shape[1],) * 2))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
            turn = (u @ v).T
        found.append(basis @ turn)
        left -= basis.shape[1]
    return np.concatenate(found, axis=1)


def _matrix(column) -> np.ndarray:
    """Vectors of an Arrow list column as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _codes(x: np.ndarray, directions: np.ndarray, longest: float) -> np.ndarray:
    """Codes of vectors: with one more component that makes all equally long, so that the largest inner
    product is the smallest angle. For a query that component is 0, which its own scale does not change."""
    scaled = x / longest
    rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1)))
    bits = np.column_stack([scaled, rest]) @ directions > 0
    return np.packbits(bits, axis=1).view(">u8").astype(np.uint64).reshape(-1)


def _query_codes(x: np.ndarray, directions: np.ndarray) -> np.ndarray:
    bits = np.column_stack([x, np.zeros(len(x))]) @ directions > 0
    return np.packbits(bits, axis=1).view(">u8").astype(np.uint64).reshape(-1)


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of each query, by score and then by smaller id."""
    order = np.lexsort((ids, -score, query))
    query = query[order]
    starts = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else np.zeros(0, dtype=np.int64)
    rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.append(starts, len(query))))
    return order[rank < k]


def _rows(query_id, vec_id, score, **more) -> pa.Table:
    columns = {"query_id": pa.array(query_id, pa.int64()), "vec_id": pa.array(vec_id, pa.int64()), "score": pa.array(score, pa.float64())}
    return pa.table(columns | {n: pa.array(v, pa.int32()) for n, v in more.items()})


def _top(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _radius(coded: DataFrame, queries: DataFrame, k: int) -> int:
    """Smallest radius that reaches REACH of the exact neighbours of a few queries among all rows."""
    few = queries.orderBy(F.xxhash64(F.lit("probe"), "vec_id")).limit(PROBES).toArrow()
    if not few.num_rows:
        return 0
    ids, vectors = few.column("vec_id").to_numpy(), _matrix(few.column("vector"))
    codes = few.column("query_code").to_numpy().view(np.uint64)
    probes = coded.sparkSession.sparkContext.broadcast((ids, vectors, codes))

    def scan(batches):
        qid, qv, qc = probes.value
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column("vec_id").to_numpy(), _matrix(batch.column("vector"))
            far = np.bitwise_count(qc[:, None] ^ batch.column("code").to_numpy().view(np.uint64)[None, :]).astype(np.int32)
            score = qv @ x.T
            score[qid[:, None] == ids[None, :]] = -np.inf
            q, c = np.repeat(np.arange(len(qid)), len(ids)), np.tile(np.arange(len(ids)), len(qid))
            part = (q, ids[c], score.ravel(), far.ravel())
            held = part if held is None else tuple(np.concatenate(p) for p in zip(held, part))
            keep = _best(held[0], held[1], held[2], k)
            held = tuple(h[keep] for h in held)
        if held is not None:
            there = np.isfinite(held[2])
            yield from _rows(qid[held[0][there]], held[1][there], held[2][there], far=held[3][there]).to_batches()

    found = coded.select("vec_id", "vector", "code").mapInArrow(scan, "query_id bigint, vec_id bigint, score double, far int")
    far = np.sort(_top(found, k).select("far").toPandas()["far"].to_numpy())
    return int(far[min(len(far) - 1, int(np.ceil(REACH * len(far))))]) if len(far) else 0


def substring_radii(radius: int, substrings: int = SUBSTRINGS) -> list[int]:
    """Codes within the radius agree in some substring up to its number of bits: if all were above,
    the distances would add up to more than the radius. -1: that substring needs no probe."""
    whole, more = divmod(radius, substrings)
    return [whole if j <= more else whole - 1 for j in range(substrings)]


class _Bucket:
    """The codes and vectors of one piece of a bucket of the index of one substring."""

    def __init__(self, part: int, rows: pa.Table):
        self.part, self.ids, self.x = part, rows.column("id").to_numpy(), _matrix(rows.column("vector"))
        self.code = rows.column("code").to_numpy().view(np.uint64)
        self.values, self.of = np.unique(_substring(self.code, part), return_inverse=True)

    def search(self, queries: pa.RecordBatch, radius: int, limits: list[int], k: int) -> pa.Table:
        """Best k per query among the codes of the bucket.

        A code is met if its substring is within the substring's radius and the whole code within the
        radius. A pair met through an earlier substring is left to that one.
        """
        qv, qid = _matrix(queries.column("vector")), queries.column("id").to_numpy()
        qcode = queries.column("code").to_numpy().view(np.uint64)
        out = []
        for at in range(0, len(qid), 64):
            q = qcode[at:at + 64]
            near = np.bitwise_count(_substring(q, self.part)[:, None] ^ self.values[None, :]) <= limits[self.part]
            query, row = np.nonzero(near[:, self.of])
            differ = q[query] ^ self.code[row]
            keep = np.bitwise_count(differ) <= radius
            for i in range(self.part):
                keep &= np.bitwise_count(_substring(differ, i)).astype(np.int64) > limits[i]
            keep &= qid[at + query] != self.ids[row]
            query, row = query[keep], row[keep]
            score = np.empty(len(query))
            for a in range(0, len(query), 16_384):
                score[a:a + 16_384] = np.einsum("ij,ij->i", qv[at + query[a:a + 16_384]], self.x[row[a:a + 16_384]])
            best = _best(query, self.ids[row], score, k)
            out.append((qid[at + query[best]], self.ids[row[best]], score[best]))
        return _rows(*(np.concatenate(c) for c in zip(*out)))


def _substring(code: np.ndarray, part: int) -> np.ndarray:
    return (code >> np.uint64(part * _WIDTH)) & np.uint64((1 << _WIDTH) - 1)


def _stream(radius: int, k: int):
    """Pieces of the index, each followed by its queries: one piece is held, queries stream against it."""
    limits = substring_radii(radius)

    def search(batches):
        piece, waiting, held = None, [], None
        for batch in batches:
            names = [batch.column(c).to_numpy() for c in ("part", "high", "salt", "kind")]
            cuts = (np.flatnonzero(np.any([np.diff(n) != 0 for n in names], axis=0)) + 1).tolist()
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                if start == end:
                    continue
                run, (*now, kind) = batch.slice(start, end - start), (int(n[start]) for n in names)
                if now != piece:
                    piece, waiting, held = now, [], None
                if kind == 0:
                    waiting.append(run)
                    continue
                if waiting:
                    held, waiting = _Bucket(piece[0], pa.Table.from_batches(waiting)), []
                if held is not None:
                    for at in range(0, run.num_rows, QUERIES_AT_ONCE):
                        yield from held.search(run.slice(at, QUERIES_AT_ONCE), radius, limits, k).to_batches()

    return search


def _search(coded: DataFrame, queries: DataFrame, radius: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): the best k of each query within the radius.

    Each row of the index is shuffled once per substring, to one piece of its bucket; a query goes to every piece of the
    buckets it probes. Pieces grow with the table, up to what a task holds, so that a query meets few of them.
    """
    limits = substring_radii(radius)
    sub = lambda code, j: F.shiftright(code, j * _WIDTH).bitwiseAND(F.lit((1 << _WIDTH) - 1))
    upper = lambda code: F.transform(
        F.sequence(F.lit(0), F.lit(SUBSTRINGS - 1)),
        lambda j: F.shiftrightunsigned(
            F.element_at(F.array(*[sub(F.col(code), i) for i in range(SUBSTRINGS)]), j + 1), _WIDTH - HIGH_BITS
        ).cast("int"),
    )
    index = coded.select("vec_id", "vector", "code", F.posexplode(upper("code")).alias("part", "high"))
    sizes = {(r[0], r[1]): r[2] for r in index.groupBy("part", "high").count().collect()}  # SUBSTRINGS * 2 ** HIGH_BITS rows
    total = sum(sizes.values())
    per_task = min(max(ROWS_PER_TASK, total // PIECES), MOST_ROWS_PER_TASK)
    salts = {key: -(-n // per_task) for key, n in sizes.items()}
    split = F.lit(1)
    for (j, h), n in salts.items():
        if n > 1:
            split = F.when((F.col("part") == j) & (F.col("high") == h), n).otherwise(split)
    index = index.select(
        "part", "high", F.pmod(F.xxhash64("vec_id"), split).cast("int").alias("salt"), F.lit(0).alias("kind"),
        F.col("vec_id").alias("id"), "vector", "code",
    )
    targets = F.array(*[
        F.struct(F.lit(j).alias("part"), F.lit(h).alias("high"), F.lit(n).alias("n")) for (j, h), n in sorted(salts.items())
    ])
    asked = (
        queries.select("vec_id", "vector", F.col("query_code").alias("code"), F.explode(targets).alias("to"))
        .withColumn("mine", F.element_at(upper("code"), F.col("to.part") + 1))
        .withColumn("limit", F.element_at(F.array(*[F.lit(r) for r in limits]), F.col("to.part") + 1))
        .filter(F.bit_count(F.col("mine").bitwiseXOR(F.col("to.high"))) <= F.col("limit"))
        .select(
            F.col("to.part").alias("part"), F.col("to.high").alias("high"),
            F.explode(F.sequence(F.lit(0), F.col("to.n") - 1)).alias("salt"), F.lit(1).alias("kind"),
            F.col("vec_id").alias("id"), "vector", "code",
        )
    )
    piece = ["part", "high", "salt"]
    met = index.unionByName(asked).repartition(max(1, sum(salts.values())), *piece).sortWithinPartitions(*piece, "kind")
    found = met.mapInArrow(_stream(radius, k), "query_id bigint, vec_id bigint, score double")
    return _top(found, k).select("query_id", "vec_id", "score")


def nearest(df: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per query and neighbour: query_id, rank (from 1), vec_id, score (inner product in double precision).

    Each vector gets a code of BITS signs after a learned rotation. The code is cut into SUBSTRINGS; each
    has an index by its value. A query probes all values near its own: codes within the radius are
    near in some substring (substring_radii), so all codes within the radius are met. They are compared
    by their vectors. The radius is measured, see _radius. Queries that met fewer than k rows
    go again with the radius of all bits, which meets every row.

    A piece of an index bucket is held by one task, and its queries are streamed against it; large buckets
    are split by id and queries go to all pieces, so a vector that fills a third of the table is many
    tasks. A task keeps k rows per query and piece.

    Vectors are compared with those of their own length; each length that a query has is a search of its own.
    Rows with a null id and vectors that are null, zero or not finite somewhere take no part. A query is not its own candidate, nor are rows with its id; other rows
    with one id are rows of their own. Ties go to the smaller id. With fewer than k candidates all are
    returned. An empty table gives an empty result. Extra columns are ignored.
    """
    spark = df.sparkSession
    rows = df.filter(F.col(key).isNotNull() & usable(F.col(vector)))
    rows = rows.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("is_query"))
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    asked = (
        rows.groupBy(F.size("vector").alias("size")).agg(F.sqrt(F.max(square)), F.max("is_query").alias("asked"))
        .filter("asked").orderBy("size").collect()  # a row per length of vector
    )
    found = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    for n, (size, longest, _) in enumerate(asked):
        of_size = _nearest_of_length(rows.filter(F.size("vector") == size), longest, k)
        found = found.unionByName(of_size) if n else of_size
    return found


def _nearest_of_length(rows: DataFrame, length: float, k: int) -> DataFrame:
    """The result of `nearest` among vectors of one number of components; `length` is that of the longest."""
    spark = rows.sparkSession
    sample = rows.orderBy(F.xxhash64(F.lit("sample"), "vec_id")).limit(SAMPLE).select("vector").toArrow()
    sample = _matrix(sample.column("vector")) / length
    rest = np.sqrt(np.maximum(0.0, 1.0 - (sample * sample).sum(axis=1)))
    model = spark.sparkContext.broadcast((learn_rotation(np.column_stack([sample, rest])), length))

    def encode(batches):
        directions, longest = model.value
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("vector"))
                codes, query_codes = _codes(x, directions, longest), _query_codes(x, directions)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(n) for n in ("vec_id", "vector", "is_query")] + [pa.array(c.view(np.int64)) for c in (codes, query_codes)],
                    ["vec_id", "vector", "is_query", "code", "query_code"],
                )

    coded = materialize(
        rows.mapInArrow(encode, "vec_id bigint, vector array<double>, is_query boolean, code bigint, query_code bigint")
    )
    queries = coded.filter("is_query").select("vec_id", "vector", "query_code")
    found = materialize(_search(coded, queries, _radius(coded, queries, k), k))
    full = found.groupBy("query_id").count().filter(F.col("count") >= k).select(F.col("query_id").alias("vec_id"))
    short = materialize(queries.join(full, "vec_id", "left_anti"))
    if not short.isEmpty():
        again = _search(coded, short, BITS, k)
        found = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(again)
    return _top(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
