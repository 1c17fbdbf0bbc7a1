"""Packing by power-of-two decomposition: documents are cut into pieces of binary lengths, equal lengths share a bucket."""

from __future__ import annotations

import json
import re
import struct
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparrowmill.llm.text import text_slices
from sparrowmill.session import materialize

ID_BYTES = 4  # ids are little-endian unsigned 32-bit numbers

#: What a worker remembers of words and of parts of texts met before; a full memory starts anew.
REMEMBERED, REMEMBERED_BYTES = 3 << 18, 64

# The steps of the vocabulary for which words may be cut into parts here.
CUT_LIKE = {
    "normalizers": ["NFC", "Replace", "Lowercase"],
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
    "pretokenizers": ["Split", "ByteLevel"],
}

#: White space and characters that every normal form leaves alone: printable ASCII, Latin letters, common signs.
PLAIN = re.compile(r"[ \t-\r!-~À-ÖØ-öø-įı-ɏ‐-‧]*")
#: The pattern above for lower-cased plain text.
PART = re.compile(r"[^\t-\r -@[-`{-~‐-‧]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[!-/:-@[-`{-~‐-‧]+")


class Memory(dict):
    """What `make` gives for a key, remembered for short keys."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= REMEMBERED_BYTES:
            if len(self) >= REMEMBERED:
                self.clear()
            self[key] = value
        return value


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Words:
    """Ids of whole texts from ids of their parts.

    A plain text falls into the parts of the vocabulary's pattern here, and each part goes to the library's merges.
    In any other text the words go through the whole library: no pre-token of these vocabularies reaches
    over ASCII white space, and the normalizer changes no character because of one on the other side of
    it, so the ids of a text are those of its words, one after the other.
    """

    def __init__(self, model: bytes):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(model.decode())
        self.merges = self.library.model
        steps = json.loads(model)
        found = {
            "normalizers": [n["type"] for n in (steps["normalizer"] or {}).get("normalizers", [])],
            "pattern": next((p["pattern"].get("Regex") for p in (steps["pre_tokenizer"] or {}).get("pretokenizers", []) if "pattern" in p), None),
            "pretokenizers": [p["type"] for p in (steps["pre_tokenizer"] or {}).get("pretokenizers", [])],
        }
        self.plain = found == CUT_LIKE
        self.added = [t["content"] for t in steps["added_tokens"]]
        # bytes as printable characters: themselves, or the next free character from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in shown]
        self.letters = {b: 256 + n for n, b in enumerate(others)}
        self.words, self.parts = Memory(self._word), Memory(self._part)

    def _word(self, word: bytes) -> bytes:
        return packed(self.library.encode(word.decode(), add_special_tokens=False).ids)

    def _part(self, part: str) -> bytes:
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(self.letters)
        return packed([t.id for t in self.merges.tokenize(part)])

    def encode(self, text: str) -> bytes:
        """Packed ids of a text."""
        if self.plain and PLAIN.fullmatch(text) and not any(a in text for a in self.added):
            return b"".join(map(self.parts.__getitem__, PART.findall(text.lower())))
        return b"".join(map(self.words.__getitem__, text.encode().split()))


_CODERS: dict[int, Words] = {}


def coder(model: bytes) -> Words:
    """The coder of a vocabulary, one per Python worker, so that tasks share what is remembered."""
    name = zlib.crc32(model)
    if name not in _CODERS:
        _CODERS[name] = Words(model)
    return _CODERS[name]


def binary_lengths(tokens: int, longest: int) -> list[int]:
    """Lengths of the pieces of a document: whole sequences first, then the binary digits of the rest."""
    rest = tokens % longest
    return [longest] * (tokens // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack_documents(
    df: DataFrame, tokenizer_file: str, key: str = "doc_id", text: str = "text", longest: int = 2048, end_id: int = 1, full: bool = False
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; with `full` also ids.

    The ids of a text (those of the tokenizers library without special tokens) end with `end_id`. A
    document of n ids gives n // `longest` pieces of `longest` (a power of two) and one piece for each
    binary digit of the rest. Every piece is a sequence by itself: no padding is needed, no sequence
    crosses documents, and a batch takes sequences of one bucket, all equally long. Sequences are
    numbered without gaps, bucket after bucket, so a bucket is a range of numbers.

    Texts are read once and not shuffled. Pieces are numbered inside their task, stored, and moved by the
    counts of earlier tasks (one number per task and length). The vocabulary file is read on the driver and
    broadcast (a few MB).

    Null and empty text give the end id alone. Rows are packed one by one, so ids of rows may be null or
    repeat. Extra columns are ignored; an empty table gives an empty result.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    with open(tokenizer_file, "rb") as f:
        model = df.sparkSession.sparkContext.broadcast(f.read())
    end = end_id.to_bytes(ID_BYTES, "little")
    names = ["start", "length", "ids_crc32", "doc_tokens", "_part", "_at"]

    def cut(batches):
        words = coder(model.value)
        part, met = TaskContext.get().partitionId(), {}
        for batch in batches:
            for run, texts in text_slices(batch):
                rows, columns, ids = [], [[] for _ in names], []
                for row, text in enumerate(texts):
                    encoded = words.encode(text or "") + end
                    tokens, start = len(encoded) // ID_BYTES, 0
                    for length in binary_lengths(tokens, longest):
                        piece = encoded[start * ID_BYTES:(start + length) * ID_BYTES]
                        at = met.get(length, 0)
                        met[length] = at + 1
                        rows.append(row)
                        for column, value in zip(columns, (start, length, zlib.crc32(piece), tokens, part, at)):
                            column.append(value)
                        if full:
                            ids.append(piece)
                        start += length
                arrays = [run.column("doc_id").take(pa.array(rows, pa.int32())), *(pa.array(c, pa.int64()) for c in columns)]
                if full:
                    ends = pa.array([0, *_sums(columns[1])], pa.int32())
                    values = pa.Array.from_buffers(pa.int32(), sum(columns[1]), [None, pa.py_buffer(b"".join(ids))])
                    arrays.append(pa.ListArray.from_arrays(ends, values))
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *names, *(["ids"] if full else [])])

    kind = df.select(F.col(key)).schema[0].dataType.simpleString()
    made = ", ".join(f"{n} bigint" for n in names) + (", ids array<int>" if full else "")
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return _numbered(materialize(rows.mapInArrow(cut, f"doc_id {kind}, {made}")))


def _sums(lengths: list[int]):
    total = 0
    for n in lengths:
        total += n
        yield total


def _numbered(pieces: DataFrame) -> DataFrame:
    """Sequence numbers of stored pieces: by length, then by task, then by place in the task."""
    counts = materialize(pieces.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n")))
    # as many totals as there are binary digits in the longest length
    totals = sorted((r["length"], r["n"]) for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect())
    first, base = F.lit(0).cast("bigint"), 0
    for length, n in totals:
        first = F.when(F.col("length") == length, F.lit(base).cast("bigint")).otherwise(first)
        base += n
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    moved = counts.select("length", "_part", (first + F.coalesce(F.sum("_n").over(earlier), F.lit(0))).alias("_first"))
    placed = pieces.join(moved, ["length", "_part"])
    extra = ["ids"] if "ids" in pieces.columns else []
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("_first") + F.col("_at")).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"), *extra,
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write the sequences with their ids as Parquet, one folder per length."""
    pieces.select("sequence_id", "doc_id", "start", "length", "ids").write.partitionBy("length").parquet(path)
