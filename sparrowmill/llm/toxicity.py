"""Toxicity: a factorization machine over hashed terms."""

from __future__ import annotations

import ctypes
import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparrowmill.llm.text import text_slices

BUCKETS = 1 << 18
FACTORS = 8
#: The machine is fitted on at most this many labelled rows, those with the smallest hash of the id.
TRAIN_ROWS = 16_000
#: Terms in fewer training texts than this are left out: they can only be learned by heart.
MIN_TEXTS = 8
#: Terms whose number of toxic texts is within so many standard deviations of chance, alone and together
#: with each term that is not, are left out.
DEVIATION = 3.0
EPOCHS = 20
BATCH = 128
RATE = 0.1
DECAY = 2e-4
_TEXTS_AT_ONCE = 1024
_EDGES = ".,;:!?\"'()[]{}<>*#$%&|-_/\\…«»¿¡"


#: Besides a word its first letters are terms, so that endings never met before do not hide a stem.
BEGINNINGS = (4, 5)


class _Buckets(dict):
    """Term buckets of a word as it stands in a lower-cased text; signs at its edges do not count."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, word: str) -> tuple:
        term = word.strip(_EDGES)
        parts = [term, *(f"{term[:n]}*" for n in BEGINNINGS if len(term) > n)] if term else []
        found = self[word] = tuple(zlib.crc32(t.encode()) % self.buckets for t in parts)
        return found


def term_buckets(texts: list, known: _Buckets) -> tuple[np.ndarray, np.ndarray]:
    """Distinct term buckets of each text, one after the other, and where each text starts.

    A text without terms has one entry, bucket -1.
    """
    if len(known) > 200_000:
        known.clear()
    rows = []
    for text in texts:
        words = set((text or "").lower().split())
        row = np.array(sorted(set(chain.from_iterable(map(known.__getitem__, words)))), dtype=np.int64)
        rows.append(row if len(row) else np.array([-1]))
    starts = np.cumsum([0, *map(len, rows)])[:-1]
    return np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64), starts


@dataclass
class Machine:
    """score = w0 + sum of w over the terms + sum over pairs of terms of <v, v'>.

    The last row of w and v belongs to no term and is 0; terms that were not learned point to it.
    """

    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def margin(self, buckets: np.ndarray, starts: np.ndarray) -> np.ndarray:
        v = self.factor[buckets]
        sums = np.add.reduceat(v, starts, axis=0)
        squares = np.add.reduceat((v * v).sum(axis=1), starts)
        linear = np.add.reduceat(self.weight[buckets], starts)
        return self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares)

    def score(self, buckets: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(buckets, starts), -30, 30)))


def _telling(rows: list[np.ndarray], labels: np.ndarray, buckets: int) -> np.ndarray:
    """Terms worth learning: in enough texts, and more or less often with label 1 than chance explains.

    Chance is asked alone, and in the texts of each term that tells alone: a term that tells only together
    with another one stays, whatever it says alone. As these are very many questions, the bound
    grows with their number.
    """
    blocks = [rows[at:at + _TEXTS_AT_ONCE] for at in range(0, len(rows), _TEXTS_AT_ONCE)]
    texts = np.zeros(buckets + 1, dtype=np.int64)  # the first one for texts without terms, bucket -1
    for block in blocks:
        texts += np.bincount(np.concatenate(block) + 1, minlength=buckets + 1)
    often = np.flatnonzero(texts[1:] >= min(MIN_TEXTS, max(1, len(rows) // 50)))
    place = np.full(buckets + 1, -1, dtype=np.int32)  # the last one for texts without terms
    place[often] = np.arange(len(often))
    terms = [t[t >= 0] for t in (place[r] for r in rows)]
    toxic = labels > 0

    def counted(mine: np.ndarray) -> np.ndarray:
        """In how many of these texts each term is, a block of texts at a time."""
        total = np.zeros(len(often), dtype=np.int64)
        for at in range(0, len(mine), _TEXTS_AT_ONCE):
            total += np.bincount(np.concatenate([terms[r] for r in mine[at:at + _TEXTS_AT_ONCE]]), minlength=len(often))
        return total

    def apart(mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each term is met in these texts, and how many standard deviations its toxic ones are from chance."""
        bad = counted(mine[toxic[mine]])
        met, share = (bad + counted(mine[~toxic[mine]])).astype(float), toxic[mine].mean()
        spread = np.sqrt(np.maximum(met * share * (1 - share) * (1 - met / len(mine)), 1e-9))
        return met, np.abs(bad - met * share) / spread

    alone = apart(np.arange(len(rows)))[1] >= DEVIATION
    telling = np.flatnonzero(alone)
    bound = max(DEVIATION, float(np.sqrt(2 * np.log(max(1, len(telling) * len(often))))))
    together = np.zeros(len(often), dtype=bool)
    for mine in _texts_of(telling, terms, len(often)):
        if toxic[mine].any() and not toxic[mine].all():
            met, off = apart(mine)
            together |= (met >= MIN_TEXTS) & (len(mine) - met >= 1) & (off >= bound)
    kept = np.zeros(buckets, dtype=bool)
    kept[often[alone | together]] = True
    return kept


def _texts_of(asked: np.ndarray, terms: list[np.ndarray], many: int) -> list[np.ndarray]:
    """The texts that hold each of the terms asked for."""
    if not len(asked):
        return []
    place = np.full(many, -1, dtype=np.int32)
    place[asked] = np.arange(len(asked))
    found = [t[t >= 0] for t in (place[t] for t in terms)]
    text = np.repeat(np.arange(len(terms), dtype=np.int32), [len(f) for f in found])
    found = np.concatenate(found)
    order = np.argsort(found, kind="stable")
    return np.split(text[order], np.searchsorted(found[order], np.arange(1, len(asked))))


def fit(rows: list[np.ndarray], labels: np.ndarray, buckets: int = BUCKETS, factors: int = FACTORS, seed: int = 5) -> Machine:
    """Fit by AdaGrad on the log loss, in batches in seeded random order, with weight decay."""
    rng = np.random.default_rng(seed)
    share = float(np.clip(labels.mean() if len(labels) else 0.0, 1e-4, 1 - 1e-4))
    machine = Machine(
        float(np.log(share / (1 - share))),
        np.zeros(buckets + 1, dtype=np.float32),
        np.zeros((buckets + 1, factors), dtype=np.float32),
    )
    if not len(rows):
        return machine
    kept = _telling(rows, labels, buckets)
    rows = [r[(r >= 0) & kept[r]] for r in rows]
    rows = [r if len(r) else np.array([buckets]) for r in rows]
    machine.factor[:-1][kept] = rng.normal(0, 0.02, (int(kept.sum()), factors))
    grown_w, grown_v, grown_b = np.full(buckets + 1, 1e-1), np.full((buckets + 1, factors), 1e-1), 1e-1
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            take = order[at:at + BATCH]
            sizes = np.array([len(rows[i]) for i in take])
            flat = np.concatenate([rows[i] for i in take])
            starts = np.cumsum(sizes) - sizes
            error = machine.score(flat, starts) - labels[take]
            of = np.repeat(np.arange(len(take)), sizes)
            sums = np.add.reduceat(machine.factor[flat], starts, axis=0)
            grad_v = error[of, None] * (sums[of] - machine.factor[flat])
            used, place = np.unique(flat, return_inverse=True)
            w = np.bincount(place, weights=error[of]) + DECAY * len(take) * machine.weight[used]
            v = np.stack([np.bincount(place, weights=grad_v[:, f]) for f in range(factors)], axis=1)
            v += DECAY * len(take) * machine.factor[used]
            grown_w[used] += w * w
            grown_v[used] += v * v
            machine.weight[used] -= RATE * w / np.sqrt(grown_w[used])
            machine.factor[used] -= RATE * v / np.sqrt(grown_v[used])
            grown_b += error.sum() ** 2
            machine.bias -= RATE * error.sum() / np.sqrt(grown_b)
            machine.weight[-1] = 0
            machine.factor[-1] = 0
    return machine


def training_rows(
    df: DataFrame, labels: DataFrame, key: str, text: str, label: str, limit: int, buckets: int
) -> tuple[list[np.ndarray], np.ndarray]:
    """Term buckets and labels of at most `limit` labelled rows of `df`."""
    spark = df.sparkSession
    given = labels.select(F.col(key).alias("doc_id"), F.col(label).alias("label"))
    marked = given.filter("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = marked.orderBy(F.xxhash64(F.lit("toxic"), "doc_id"), "doc_id").limit(limit).toPandas()
    if chosen.empty:
        return [], np.zeros(0)
    kind = df.schema[key].dataType.simpleString()
    chosen = spark.createDataFrame(
        [(k, float(v)) for k, v in zip(chosen["doc_id"].tolist(), chosen["label"].tolist())], f"doc_id {kind}, label double"
    )

    def terms(batches):
        known = _Buckets(buckets)
        for batch in batches:
            for part, texts in text_slices(batch):
                flat, starts = term_buckets(texts, known)
                cut = pa.array(np.append(starts, len(flat)).astype(np.int32))
                rows = pa.ListArray.from_arrays(cut, pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), rows], ["doc_id", "label", "terms"])

    known = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    rows = (
        known.join(F.broadcast(chosen), "doc_id")  # at most `limit` rows
        .mapInArrow(terms, f"doc_id {kind}, label double, terms array<int>")
        .toArrow()
    )
    # views of the 32-bit numbers as they came, put in order by id: the sample is held once
    views = []
    for lists in rows.column("terms").chunks:
        edges, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        views += [flat[a:b] for a, b in zip(edges, edges[1:])]
    order = pc.sort_indices(rows.column("doc_id")).to_numpy()
    return [views[i] for i in order], rows.column("label").to_numpy()[order]


def _model(df, labels, key, text, label, limit, buckets, factors):
    rows, wanted = training_rows(df, labels, key, text, label, limit, buckets)
    machine = fit(rows, wanted, buckets, factors)
    del rows, wanted
    _give_back()
    return df.sparkSession.sparkContext.broadcast(machine)


def _give_back() -> None:
    """Return what the sample took to the system; the allocator keeps it for the rest of a long job otherwise."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)


def score_toxicity(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    limit: int = TRAIN_ROWS,
    buckets: int = BUCKETS,
    factors: int = FACTORS,
) -> DataFrame:
    """One row per input row: doc_id, score (0 to 1), predicted (1 if score >= 0.5).

    `labels` has the ids to learn from with a label of 0 or 1; repeated ids count as 1 if one row does.
    The machine is fitted on the driver on at most `limit` of those texts, broadcast (buckets x
    (factors + 1) x 4 bytes) and applied in numpy to whole texts. Nothing but the sample leaves the tasks.

    Terms are the distinct words in lower case without signs at their edges, and their beginnings. Null and empty texts, and
    texts without a learned term, have the score of the bias. Without labels every score is small and
    constant. Repeated rows get equal results; a null id is only scored. Extra columns are ignored; an
    empty table gives an empty result.
    """
    model = _model(df, labels, key, text, label, limit, buckets, factors)

    def score(batches):
        known = _Buckets(buckets)
        for batch in batches:
            for part, texts in text_slices(batch):
                scores = model.value.score(*term_buckets(texts, known)) if len(texts) else np.zeros(0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))],
                    ["doc_id", "score", "predicted"],
                )

    kind = df.select(F.col(key)).schema[0].dataType.simpleString()
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(score, f"doc_id {kind}, score double, predicted int")


def without_toxic(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    limit: int = TRAIN_ROWS,
    buckets: int = BUCKETS,
    factors: int = FACTORS,
) -> DataFrame:
    """The rows of `df`, all columns, that score_toxicity does not predict as toxic; no shuffle."""
    model = _model(df, labels, key, text, label, limit, buckets, factors)

    def keep(batches):
        known = _Buckets(buckets)
        for batch in batches:
            for part, texts in text_slices(batch, text):
                if len(texts):
                    yield part.filter(pa.array(model.value.score(*term_buckets(texts, known)) < 0.5))

    return df.mapInArrow(keep, df.schema)
