"""Structured Streaming versions of the running reports.

Results of a stream go to a folder per micro-batch in the shared folder. A batch that is run again
after a failure overwrites its own folder, so every result is written exactly once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout


def event_stream(spark: SparkSession, path: str, schema, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Files of one folder as a stream, ts as a timestamp that can carry a watermark."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def run_batches(stream: DataFrame, mode: str, handle, home: str):
    """Process what has arrived since the last run with the same home folder.

    handle(df, batch_id) is called once per micro-batch; batch numbers go on from run to run.
    """
    job = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", f"{home}/progress")
        .trigger(availableNow=True).foreachBatch(handle).start()
    )
    job.awaitTermination()
    return job


def collect_batches(stream: DataFrame, mode: str, home: str) -> DataFrame:
    """All rows the stream has emitted, with the number of their micro-batch in batch_id."""
    out = f"{home}/out"
    run_batches(stream, mode, lambda df, i: df.write.mode("overwrite").parquet(f"{out}/batch_id={i}"), home)
    return stream.sparkSession.read.parquet(out)


def ingest(stream: DataFrame, required: list[str], home: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad): rows with every required field, and the others with the names of what they lack.

    A micro-batch is read once and written once, each row into the folder of its side.
    """
    out = f"{home}/rows"
    schema = f"{_ddl(stream.schema)}, lacking array<string>, side string, batch_id bigint"

    def split(df, i):
        lacking = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
        marked = df.withColumn("lacking", lacking).withColumn("side", F.when(F.size("lacking") == 0, "good").otherwise("bad"))
        marked.write.mode("overwrite").partitionBy("side").parquet(f"{out}/batch_id={i}")

    run_batches(stream, "append", split, home)
    rows = stream.sparkSession.read.schema(schema).parquet(out)
    return rows.filter("side = 'good'").drop("side", "lacking"), rows.filter("side = 'bad'").drop("side")


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def tumbling_throughput(stream: DataFrame, every: str, late: str) -> DataFrame:
    """Rows and value sum per window; partial sums combine before the shuffle.

    In append mode a window is emitted once, when the watermark has passed its end, and leaves the state. In
    update mode it is emitted with every micro-batch that changes it, so windows still open are told too
    (`latest` picks the last row of each); the watermark evicts closed ones from the state just the same.
    """
    windows = stream.withWatermark("ts", late).groupBy(F.window("ts", every))
    return windows.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select("window.start", "n", "total")


def sliding_mean(stream: DataFrame, size: str, slide: str, late: str) -> DataFrame:
    """Mean and rows per sliding window, emitted like those of tumbling_throughput."""
    windows = stream.withWatermark("ts", late).groupBy(F.window("ts", size, slide))
    return windows.agg(F.avg("value").alias("mean"), F.count("*").alias("n")).select("window.start", "mean", "n")


def running_accuracy(stream: DataFrame, key: str, hit: Column) -> DataFrame:
    """Hits and rows so far per key."""
    sums = stream.groupBy(key).agg(F.sum(hit.cast("bigint")).alias("hits"), F.count("*").alias("n"))
    return sums.withColumn("accuracy", F.col("hits") / F.col("n"))


def fold_means(state: np.ndarray, of: np.ndarray, values: np.ndarray, momentum: float) -> np.ndarray:
    """The exponential means after these values: values[i] goes to state[of[i]], oldest first and all of one state
    side by side; a missing value leaves its state as it is."""
    known = ~np.isnan(values)
    of, values = of[known], values[known]
    count = np.bincount(of, minlength=len(state))
    after = np.cumsum(count)[of] - 1 - np.arange(len(of))  # known values of the same state behind this one
    sums = np.bincount(of, weights=momentum ** after.astype(float) * values, minlength=len(state))
    return state * momentum ** count.astype(float) + (1 - momentum) * sums


#: Groups that the keys of a moving mean are dealt to.
KEY_SHARES = 1024


def moving_mean(
    stream: DataFrame, key: str, order: list[str], value: str, momentum: float, late: str, expire: str | None = None, shares: int = KEY_SHARES
) -> DataFrame:
    """(key, n, moving, closed): rows and exponential mean per key, a new row with each micro-batch that has the key.

    `order` is the time column, which carries the watermark, and a column that decides among equal times. Rows
    are folded by time however they are cut into files: those the watermark has not passed wait in Spark's
    state and are added to the reported mean only; those it has passed are folded for good. A
    row older than the watermark takes no part. So the state holds one mean per key and the rows of `late`.

    With `expire`, a key without rows for that long behind the watermark is reported once more, closed, and
    its state is dropped; a later row of it starts anew.

    Keys are dealt to `shares` groups by their hash; a group folds all its keys at once and has one state, so the cost
    goes with the rows and not with calls per key. A group holds its rows of one micro-batch: maxFilesPerTrigger bounds
    them, and more shares make groups smaller. Meant for update mode.
    """
    time, tie = order
    kinds = dict(stream.dtypes)
    quiet = _seconds(expire) * 1000 if expire else None

    def advance(_, batches, state):
        keys, n, moving, due_by, *waiting = state.get if state.exists else ([], [], [], [], [], [], [], [])
        watermark = state.getCurrentWatermarkMs()
        passed, at = watermark * 1000, {k: i for i, k in enumerate(keys)}
        keys, held, seen = list(keys), [pd.DataFrame(dict(zip(("of", "at", "tie", "value"), waiting)))], []
        for pdf in () if state.hasTimedOut else batches:
            mine = [None if k != k else k for k in pdf[key].tolist()]
            for k in dict.fromkeys(mine):
                if k not in at:
                    at[k] = len(keys)
                    keys.append(k)
            of = np.array([at[k] for k in mine], dtype=np.int64)
            seen.append(np.unique(of))
            some = (pdf["_at"] > passed).to_numpy()
            held.append(pd.DataFrame({"of": of, "at": pdf["_at"], "tie": pdf[tie], "value": pdf[value]})[some])
        new = len(keys) - len(n)
        n, moving = np.array([*n, *[0] * new], dtype=np.int64), np.array([*moving, *[0.0] * new])
        due_by = np.array([*due_by, *[watermark + (quiet or 0)] * new], dtype=np.int64)
        rows = pd.concat([h for h in held if len(h)] or held[:1]).sort_values(["of", "at", "tie"])
        of, times, values = rows["of"].to_numpy(np.int64), rows["at"].to_numpy(np.int64), rows["value"].to_numpy(float)
        told = np.zeros(len(keys), dtype=bool)
        told[np.concatenate([*seen, np.zeros(0, dtype=np.int64)])] = True
        if quiet is not None:
            np.maximum.at(due_by, of, times // 1000 + quiet)
        closed = ~told & (due_by < watermark) if quiet is not None else np.zeros(len(keys), dtype=bool)
        due = times <= passed
        moving = fold_means(moving, of[due], values[due], momentum)
        n += np.bincount(of[due], minlength=len(n))
        report = pd.DataFrame({
            key: pd.Series(keys, dtype=object), "n": n + np.bincount(of[~due], minlength=len(n)),
            "moving": fold_means(moving, of[~due], values[~due], momentum), "closed": closed,
        })
        kept = np.flatnonzero(~closed)
        if len(kept):
            rest = rows[~due & ~closed[of]]
            place = np.cumsum(~closed) - 1
            state.update((
                [keys[i] for i in kept], n[kept].tolist(), moving[kept].tolist(), due_by[kept].tolist(),
                place[rest["of"].to_numpy(np.int64)].tolist(), *[rest[c].tolist() for c in ("at", "tie", "value")],
            ))
            if quiet is not None:
                state.setTimeoutTimestamp(int(max(due_by[kept].min(), watermark + 1)))
        else:
            state.remove()
        yield report[told | closed]

    share = F.when(F.col(key).isNull(), -1).otherwise(F.pmod(F.xxhash64(key), F.lit(shares)))
    rows = stream.withWatermark(time, late).withColumns({"_at": F.unix_micros(time), "_share": share})
    return rows.select("_share", "_at", time, *dict.fromkeys([key, tie, value])).groupBy("_share").applyInPandasWithState(
        advance, f"`{key}` {kinds[key]}, n bigint, moving double, closed boolean",
        f"keys array<{kinds[key]}>, n array<bigint>, moving array<double>, due_by array<bigint>, "
        f"waiting_of array<bigint>, times array<bigint>, ties array<{kinds[tie]}>, waiting array<double>", "update",
        GroupStateTimeout.EventTimeTimeout if expire else GroupStateTimeout.NoTimeout,
    )


def _seconds(duration: str) -> int:
    number, unit = duration.split()
    return int(float(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")])


def latest(rows: DataFrame, key: str) -> DataFrame:
    """The last row an update-mode stream has emitted for each key."""
    others = [c for c in rows.columns if c not in (key, "batch_id")]
    last = rows.groupBy(key).agg(F.max_by(F.struct(*others), "batch_id").alias("_last"))
    return last.select(key, *[F.col(f"_last.{c}").alias(c) for c in others])


def late_rows(stream: DataFrame, every: str, late: str, home: str, shares: int = 64) -> tuple[DataFrame, DataFrame]:
    """(rows kept per window so far, one row with `kept` and `late`): every row of every micro-batch is one or the other.

    A row is late if the watermark of its micro-batch, which Spark tells the tasks, is not older than it. Each
    micro-batch writes what it counted, so the counts hold for any number of micro-batches and restarts, and
    rows with the same event_id are rows of their own. Rows are dealt to `shares` by a hash of all columns.
    """

    def count(_, batches, state):
        passed = state.getCurrentWatermarkMs() * 1000
        for pdf in batches:
            yield pdf.assign(late=pdf["_at"] <= passed).groupby(["start", "late"], as_index=False).agg(n=("_at", "size"))

    rows = stream.withWatermark("ts", late)
    marked = rows.select(
        F.pmod(F.xxhash64(*stream.columns), F.lit(shares)).alias("_share"), F.unix_micros("ts").alias("_at"),
        F.unix_micros(F.window("ts", every)["start"]).alias("start"), "ts",
    )
    counted = marked.groupBy("_share").applyInPandasWithState(
        count, "start bigint, late boolean, n bigint", "nothing int", "append", GroupStateTimeout.NoTimeout
    )
    told = collect_batches(counted, "append", home)
    windows = told.filter("not late").groupBy(F.timestamp_micros("start").alias("start")).agg(F.sum("n").alias("n"))
    both = told.agg(F.sum(F.when(~F.col("late"), F.col("n")).otherwise(0)).alias("kept"), F.sum(F.when(F.col("late"), F.col("n")).otherwise(0)).alias("late"))
    return windows, both
