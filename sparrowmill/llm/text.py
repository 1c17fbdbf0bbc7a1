"""What the operators of this subpackage share: white space, words, sizes, ids and Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def id_remainder(key: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo a divisor: a fold that depends on the id alone; 0 for a null id."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % divisor, F.lit(0))


def text_slices(batch: pa.RecordBatch, column: str = "text", chars: int = 1 << 21) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Cut an Arrow batch into runs of whole rows with about `chars` characters, and their texts.

    One text longer than that is a run of its own.
    """
    sizes = pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for at, size in enumerate(sizes):
        if at > start and total + size > chars:
            part = batch.slice(start, at - start)
            yield part, part.column(column).to_pylist()
            start, total = at, 0
        total += size
    if start < len(sizes):
        part = batch.slice(start)
        yield part, part.column(column).to_pylist()
