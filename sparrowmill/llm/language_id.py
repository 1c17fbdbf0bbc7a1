"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparrowmill.llm.text import text_slices
from sparrowmill.session import materialize

BUCKETS = 1 << 17
LENGTHS = (1, 2, 3)
SMOOTHING = 0.5
#: The model has BUCKETS x languages x 4 bytes; more is refused, as it is broadcast.
MODEL_BYTES = 1 << 30
UNDETERMINED = "und"
_SPACE = 32


@lru_cache(1)
def _letters() -> np.ndarray:
    """Code point to lower-case letter; everything that is no letter becomes a space."""
    table = np.full(0x110000, _SPACE, dtype=np.uint32)
    for c in range(0x110000):
        char = chr(c)
        if char.isalpha():
            table[c] = ord(char.lower()[0])
    return table


def grams(texts: list, lengths=LENGTHS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """Codes of the joined texts, the start of each text, its end, and (bucket, counts) per n-gram length.

    Each text is framed by one space. An n-gram counts if it lies within its text and its first or last
    character is a letter.
    """
    joined = "".join(f" {t} " for t in texts)
    codes = _letters()[np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")].astype(np.uint64)
    sizes = np.fromiter((len(t) + 2 for t in texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    room = np.repeat(ends, sizes) - np.arange(len(codes))
    letter = codes != _SPACE
    made, mixed = [], np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, max(lengths) + 1):
        shifted = np.zeros_like(codes)
        shifted[: len(codes) - n + 1] = codes[n - 1:]
        mixed = (mixed ^ shifted) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        if n in lengths:
            tail = np.zeros_like(letter)
            tail[: len(codes) - n + 1] = letter[n - 1:]
            counts = (room >= n) & (letter | tail)
            made.append((((mixed >> np.uint64(7)) % np.uint64(buckets)).astype(np.int64), counts))
    return codes, starts, ends, made


def count_grams(df: DataFrame, text: str, lang: str, buckets: int = BUCKETS, lengths=LENGTHS) -> DataFrame:
    """(lang, bucket, n): how often n-grams of a bucket occur in texts of a language; bucket -1 counts texts."""

    def count(batches):
        total: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            for part, texts in text_slices(batch):
                langs = part.column("lang").to_pylist()
                names = sorted(set(langs))
                number = {name: i for i, name in enumerate(names)}
                _, starts, ends, made = grams(texts, lengths, buckets)
                of = np.repeat([number[x] for x in langs], ends - starts)
                for i, name in enumerate(names):
                    held = total.setdefault(name, np.zeros(buckets, dtype=np.int64))
                    docs[name] = docs.get(name, 0) + langs.count(name)
                    for bucket, counts in made:
                        held += np.bincount(bucket[counts & (of == i)], minlength=buckets)
        for name, held in total.items():
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (len(at) + 1)), pa.array(np.append(at, -1)), pa.array(np.append(held[at], docs[name]))],
                ["lang", "bucket", "n"],
            )

    known = df.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    rows = known.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    counted = rows.mapInArrow(count, "lang string, bucket bigint, n bigint")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(counts: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING):
    """Languages in order, their log priors, and the matrix of log probabilities (buckets x languages)."""
    n_langs = counts.filter("bucket = -1").count()
    if n_langs * buckets * 4 > MODEL_BYTES:
        raise ValueError(f"{n_langs} languages times {buckets} buckets are too many to broadcast")
    rows = counts.toPandas()
    langs = sorted(rows["lang"].unique())
    number = {name: i for i, name in enumerate(langs)}
    priors = np.zeros(len(langs))
    held = np.full((buckets, len(langs)), smoothing)
    of = rows["lang"].map(number).to_numpy(dtype=np.int64)
    bucket, n = rows["bucket"].to_numpy(dtype=np.int64), rows["n"].to_numpy(dtype=float)
    docs = bucket < 0
    priors[of[docs]] = n[docs]
    held[bucket[~docs], of[~docs]] += n[~docs]
    return langs, np.log(priors / max(priors.sum(), 1)), np.log(held / held.sum(axis=0)).astype(np.float32)


def identify(
    df: DataFrame,
    train: Column,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    buckets: int = BUCKETS,
    lengths=LENGTHS,
) -> DataFrame:
    """One row per input row: doc_id, lang_pred, score.

    Counts of hashed n-grams of characters (letters in lower case, all else a space) over all training
    rows give the model; only rows with a text and a language are used. The matrix of log
    probabilities is broadcast (buckets x languages x 4 bytes, refused above MODEL_BYTES) and texts are
    scored in numpy, batch by batch, whole texts only. `score` is the posterior probability.

    A text that is null or has no letter is `und` with score 0, as is every text if nothing could be
    learned. Ties go to the first language in order. Repeated rows get equal results. Extra columns
    are ignored; an empty table gives an empty result.
    """
    counts = materialize(count_grams(df.filter(train), text, lang, buckets, lengths))
    langs, priors, matrix = fit(counts, buckets)
    model = df.sparkSession.sparkContext.broadcast((langs, priors, matrix))

    def score(batches):
        langs, priors, matrix = model.value
        for batch in batches:
            for part, texts in text_slices(batch):
                texts = [t or "" for t in texts]
                names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
                if langs and texts:
                    codes, starts, _, made = grams(texts, lengths, buckets)
                    sums = np.tile(priors, (len(texts), 1))
                    for bucket, counts in made:
                        rows = matrix[bucket]
                        rows[~counts] = 0
                        sums += np.add.reduceat(rows, starts, axis=0, dtype=np.float64)
                    known = np.add.reduceat(codes != _SPACE, starts, dtype=np.int64) > 0
                    best = sums.argmax(axis=1)
                    share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                    scores = np.where(known, share, 0.0)
                    names = [langs[b] if k else UNDETERMINED for b, k in zip(best, known)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    ["doc_id", "lang_pred", "score"],
                )

    kind = df.select(F.col(key)).schema[0].dataType.simpleString()
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(score, f"doc_id {kind}, lang_pred string, score double")
