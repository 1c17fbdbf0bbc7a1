"""User functions on Spark: batched maps, predicates, metrics, row expanders, hooks.

Native expressions are faster; these are for code that has no expression.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparrowmill.session import materialize


def map_batches(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """fn(pandas frame) -> pandas frame over Arrow batches. No shuffle, no group."""

    def run(batches):
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(run, schema)


def map_rows(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """fn(dict) -> dict per row, inside Arrow batches."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            yield pd.DataFrame([fn(r) for r in pdf.to_dict("records")])

    return df.mapInPandas(run, schema)


def filter_rows(df: DataFrame, fn: Callable) -> DataFrame:
    """Keep rows where fn(pandas frame) is true; fn sees whole Arrow batches."""

    def run(batches):
        for pdf in batches:
            yield pdf[fn(pdf)]

    return df.mapInPandas(run, df.schema)


class Metric(Protocol):
    """A user metric in parts: a state that starts somewhere, takes in rows, and meets other states.

    The state is anything that pickles. `merge` has to give the same for any order and grouping.
    """

    def init(self) -> Any: ...

    def update(self, state: Any, rows: pd.DataFrame) -> Any: ...

    def merge(self, one: Any, two: Any) -> Any: ...

    def finish(self, state: Any) -> float | None: ...


#: States a worker holds before it hands them on, and states that one task merges.
HELD_STATES, MERGED_STATES = 10_000, 256


def metric(df: DataFrame, by, columns, user: Metric, name: str = "metric", merged: int = MERGED_STATES) -> DataFrame:
    """A user metric over `columns` per group, null keys included.

    Tasks update one state per group and Arrow batch; the states, not the rows, are shuffled, and merged
    `merged` at a time until one is left. So a group of any size is never in one task. A count of the
    largest number of states runs while the frame is built.
    """
    keys = list(by)
    kept = df.select(*keys, *columns)
    head = "".join(f"`{k}` {kept.schema[k].dataType.simpleString()}, " for k in keys)

    def frame(found):
        rows = pd.DataFrame([(*key, pickle.dumps(state)) for key, state in found.items()], columns=[*keys, "_state"])
        return rows.astype(object)

    def partial(batches):
        found: dict = {}
        for pdf in batches:
            groups = pdf.groupby(keys, sort=False, dropna=False) if keys else [((), pdf)]
            for key, rows in groups:
                key = tuple(None if k is pd.NaT or k != k else k for k in key)
                state = found[key] if key in found else user.init()
                found[key] = user.update(state, rows[list(columns)])
            if len(found) > HELD_STATES:
                yield frame(found)
                found = {}
        yield frame(found)

    def together(pdf):
        state = user.init()
        for part in pdf["_state"]:
            state = user.merge(state, pickle.loads(part))
        return state

    def merge(pdf):
        out = pdf[keys].iloc[:1].copy()
        out["_state"] = [pickle.dumps(together(pdf))]
        return out

    def finish(pdf):
        out = pdf[keys].iloc[:1].copy()
        out[name] = user.finish(together(pdf))
        return out

    states = materialize(kept.mapInPandas(partial, f"{head}_state binary"))
    while True:
        most = states.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= merged:
            return states.groupBy(*keys).applyInPandas(finish, f"{head}`{name}` double")
        share = F.pmod(F.xxhash64("_state", F.monotonically_increasing_id()), F.lit(-(-most // merged)))
        dealt = materialize(states.withColumn("_share", share))
        states = materialize(dealt.groupBy(*keys, "_share").applyInPandas(merge, f"{head}_state binary"))


def ngram_udtf(n: int):
    """A table function text -> (pos, gram) over the lower-case letter words of a text."""
    from pyspark.sql.functions import udtf

    @udtf(returnType="pos int, gram string")
    class Ngrams:
        def eval(self, text: str):
            import re

            words = [w for w in re.sub("[^A-Za-z]+", " ", text).lower().split(" ") if w]
            for i in range(len(words) - n + 1):
                yield i, " ".join(words[i:i + n])

    return Ngrams


#: Bytes of text that one task expands, and values that a worker combines at once.
TASK_TEXT, COMBINED = 16 << 20, 1 << 20


def text_parts(df: DataFrame, text: str, size: int = TASK_TEXT) -> int:
    """Into how many tasks the texts go so that none has much more than `size` bytes. Reads the lengths of the texts."""
    volume = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, 1 + volume // size)


def count_values(df: DataFrame, column: str, parts: int, held: int = COMBINED) -> DataFrame:
    """(column, n): how often each value of a string column occurs, in `parts` tasks, so that no task has to hold more
    than its share of the values however many there are. Workers combine `held` values at a time before the shuffle."""

    def combine(batches):
        import pyarrow as pa

        def counted(rows):
            found = pa.table({column: pa.chunked_array(rows)}).group_by(column, use_threads=False).aggregate([([], "count_all")])
            return found.select([column, "count_all"]).rename_columns([column, "n"]).to_batches()

        rows, size = [], 0
        for batch in batches:
            rows.append(batch.column(0))
            size += len(batch)
            if size >= held:
                yield from counted(rows)
                rows, size = [], 0
        if rows:
            yield from counted(rows)

    counts = df.select(column).mapInArrow(combine, f"`{column}` string, n bigint")
    return counts.repartition(parts, column).groupBy(column).agg(F.sum("n").alias("n"))


def lower_hook(column: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumn(column, F.lower(column))


