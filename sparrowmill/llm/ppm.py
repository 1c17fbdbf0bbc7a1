"""Language-model scoring by partial matching over a byte-context trie, with a word baseline."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparrowmill.llm.text import text_slices
from sparrowmill.session import materialize

#: Bytes of context.
ORDER = 5
#: Contexts with their next byte that make up this share of all bytes (at most 1 / NODE_SHARE, 16 bytes
#: each) have their code length looked up in the tasks that score; all rarer ones are joined with theirs.
NODE_SHARE = 5e-7
#: Levels of the trie up to this context length are sent to all tasks that compute code lengths: at most
#: 256 ** (BASE + 1) nodes. Longer contexts meet where the last BASE + 1 bytes of the context are equal.
BASE = 1
#: Distinct contexts with their next byte that one task computes code lengths for, about.
CONTEXTS_PER_BUCKET = 50_000
#: What each byte seen in a context gives up for those not seen there.
DISCOUNT = 0.5
#: Words with this share of all tokens (at most 1 / WORD_SHARE, 16 bytes each) are looked up in the
#: tasks that score; all rarer words are joined with their counts.
WORD_SHARE = 2e-7
SYMBOLS = 256
END = b"\n"
_SLICE = 1 << 20


def tokens(text: str | None) -> list[bytes]:
    """Words in UTF-8, A to Z in lower case; bytes.lower and bytes.split know ASCII only."""
    return (text or "").encode().lower().split()


def word_ids(words) -> np.ndarray:
    """64-bit hashes of words as signed numbers."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words)).view(np.int64)


def contexts(docs: list[list[bytes]], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the documents, `order` bytes of context and the byte as one number; bytes per document.

    A document is its words, joined by one space, and an end. It begins in a context of ends.
    """
    bodies = [b" ".join(words) + END for words in docs]
    sizes = np.array([len(b) for b in bodies], dtype=np.int64)
    pad = END * order
    stream = np.frombuffer(b"".join(pad + b for b in bodies), dtype=np.uint8).astype(np.uint64)
    packed = np.zeros(max(len(stream) - order, 0), dtype=np.uint64)
    for i in range(order + 1):
        packed = (packed << np.uint64(8)) | stream[i:len(stream) - order + i]
    # position p of the packed numbers predicts stream[p + order]: drop those that predict padding
    own = np.ones(len(packed), dtype=bool)
    ends = np.cumsum(sizes + order)[:-1]
    for i in range(order):
        own[ends - order + i] = False
    return packed[own], sizes


def _tally(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sum counts of equal keys."""
    if not keys:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    return key[first], (np.add.reduceat(n, first) if len(first) else n)


def count_corpus(df: DataFrame, text: str, train: Column, order: int = ORDER) -> DataFrame:
    """(kind, key, n) over all rows: contexts with their next byte, kind 0 in the training rows and kind 3 in
    the others, and of the training rows kind 1 words by hash, kind 2 (key 0) the ends of documents.

    A task adds up what it has read and hands on sums.
    """

    def count(batches):
        held = {0: ([], []), 3: ([], [])}
        words: Counter = Counter()
        ends = 0

        def rows(kind, key, n):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(key), kind, dtype=np.int32)), pa.array(np.asarray(key).astype(np.int64)), pa.array(np.asarray(n, dtype=np.int64))],
                ["kind", "key", "n"],
            )

        for batch in batches:
            for part, texts in text_slices(batch, chars=_SLICE):
                learn = part.column("train").to_pylist()
                docs = {0: [], 3: []}
                for t, yes in zip(texts, learn):
                    docs[0 if yes else 3].append(tokens(t))
                for kind, (keys, counts) in held.items():
                    if not docs[kind]:
                        continue
                    packed, _ = contexts(docs[kind], order)
                    place, key = pd.factorize(packed)
                    keys.append(key)
                    counts.append(np.bincount(place, minlength=len(key)))
                    if sum(map(len, keys)) > 1_500_000:
                        key, n = _tally(keys, counts)
                        keys[:], counts[:] = [key], [n]
                        if len(key) > 1_000_000:
                            yield rows(kind, key, n)
                            keys.clear()
                            counts.clear()
                for d in docs[0]:
                    words.update(d)
                ends += len(docs[0])
                if len(words) > 200_000:
                    yield rows(1, word_ids(words), list(words.values()))
                    words.clear()
        for kind, (keys, counts) in held.items():
            yield rows(kind, *_tally(keys, counts))
        yield rows(1, word_ids(words), list(words.values()))
        yield rows(2, [0] if ends else [], [ends] if ends else [])

    marked = df.select(F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    counted = marked.mapInArrow(count, "kind int, key bigint, n bigint")
    return counted.groupBy("kind", "key").agg(F.sum("n").alias("n"))


@dataclass
class Level:
    """Contexts of one length and their next bytes, both sorted.

    first_base, first_escape: log10 of the denominator and of the escape, for a text that starts here.
    next_base, next_escape: the same at the context one byte shorter, without the bytes seen here.
    """

    context: np.ndarray
    pair: np.ndarray
    count: np.ndarray
    first_base: np.ndarray
    first_escape: np.ndarray
    next_base: np.ndarray
    next_escape: np.ndarray


def _find(sorted_: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted number, -1 if it is not there."""
    if not len(sorted_):
        return np.full(len(wanted), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
    return np.where(sorted_[at] == wanted, at, -1)


def _log10(x: np.ndarray) -> np.ndarray:
    return np.log10(np.maximum(x, 1e-300))


class Trie:
    """Code lengths of bytes after their contexts.

    The longest context that was met is tried first. A byte seen there has the probability
    (count - DISCOUNT) / total. Else the model escapes to the context one byte shorter, with what the
    seen bytes gave up: DISCOUNT * distinct / total. There the bytes of the longer context are excluded
    from all counts, as they would have been coded before. After the empty context all bytes not seen
    there are equally likely.
    """

    def __init__(self, pairs: list[tuple[np.ndarray, np.ndarray]]):
        """By length of context: (context and byte, count), sorted; for each context that is in it all its bytes."""
        self.levels: list[Level] = []
        below_total = below_distinct = np.zeros(0)
        for k, (pair, count) in enumerate(pairs):
            context, at = np.unique(pair >> np.uint64(8), return_inverse=True)
            distinct = np.bincount(at, minlength=len(context)).astype(float)
            total = np.bincount(at, weights=count, minlength=len(context))
            next_base = next_escape = np.zeros(0)
            if k:
                below = self.levels[k - 1]
                mask = np.uint64((1 << (8 * k)) - 1)
                shorter = _find(below.pair, pair & mask)
                excluded = np.bincount(at, weights=below.count[shorter], minlength=len(context))
                parent = _find(below.context, context & (mask >> np.uint64(8)))
                left_total = below_total[parent] - excluded
                left_distinct = below_distinct[parent] - distinct
                next_base = _log10(left_total)
                escape = np.where(left_distinct > 0, DISCOUNT * left_distinct / np.maximum(left_total, 1), 1.0)
                next_escape = _log10(np.minimum(escape, 1.0))
            below_total, below_distinct = total, distinct
            self.levels.append(Level(
                context, pair, count.astype(float), _log10(total), _log10(DISCOUNT * distinct / np.maximum(total, 1)),
                next_base, next_escape,
            ))
        self.last = -float(np.log10(max(SYMBOLS - len(pairs[0][0]), 1)))

    def walk(self, packed: np.ndarray) -> np.ndarray:
        cost = np.zeros(len(packed))
        done = np.zeros(len(packed), dtype=bool)
        above = np.full(len(packed), -1, dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            key = packed & np.uint64((1 << (8 * (k + 1))) - 1)
            at = np.where(done, -1, _find(level.context, key >> np.uint64(8)))
            live = at >= 0
            first = live & (above < 0)
            after = live & (above >= 0)
            base, escape = np.zeros(len(packed)), np.zeros(len(packed))
            base[first], escape[first] = level.first_base[at[first]], level.first_escape[at[first]]
            if k + 1 < len(self.levels):
                longer = self.levels[k + 1]
                base[after], escape[after] = longer.next_base[above[after]], longer.next_escape[above[after]]
            found = np.where(live, _find(level.pair, key), -1)
            hit = found >= 0
            cost[hit] += _log10(level.count[found[hit]] - DISCOUNT) - base[hit]
            missed = live & ~hit
            cost[missed] += escape[missed]
            done |= hit
            above = np.where(missed, at, -1)
        cost[~done] += self.last
        return cost


def _levels(key: np.ndarray, n: np.ndarray, lengths: range) -> list[tuple[np.ndarray, np.ndarray]]:
    """Counts of contexts and bytes, summed for each of these lengths of context."""
    return [_tally([key & np.uint64((1 << (8 * (k + 1))) - 1)], [n]) for k in lengths]


def code_lengths(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, cost, met): log10 probability of every context and byte counted in any row, and how often it was met.

    Shorter contexts and all bytes after them follow from the counts of the longest ones. What contexts of
    more than BASE bytes need is found where their last BASE + 1 bytes are equal, so such groups are dealt
    out in buckets, and a bucket builds its own part of the trie. The shorter levels are broadcast.
    """
    spark = counts.sparkSession
    top = counts.filter("kind in (0, 3)").select("kind", "key", "n")
    low = min(order, BASE)
    short = top.filter("kind = 0").groupBy(F.col("key").bitwiseAND(F.lit((1 << (8 * (low + 1))) - 1)).alias("key"))
    short = short.agg(F.sum("n").alias("n")).toArrow()
    base = spark.sparkContext.broadcast(
        _levels(short.column("key").to_numpy().astype(np.uint64), short.column("n").to_numpy(), range(low + 1))
    )

    def bucket(table: pa.Table) -> pa.Table:
        key, n = table.column("key").to_numpy().astype(np.uint64), table.column("n").to_numpy()
        learned = table.column("kind").to_numpy() == 0
        trie = Trie(base.value + _levels(key[learned], n[learned], range(low + 1, order + 1)))
        wanted, met = _tally([key], [n])
        return pa.table({"key": wanted.astype(np.int64), "cost": trie.walk(wanted), "met": met.astype(np.int64)})

    buckets = top.count() // CONTEXTS_PER_BUCKET + 1
    group = F.shiftright("key", 8).bitwiseAND(F.lit((1 << (8 * (BASE + 1))) - 1))
    dealt = top.groupBy(F.pmod(F.xxhash64(group), F.lit(buckets)).alias("bucket"))
    return dealt.applyInArrow(bucket, "key bigint, cost double, met bigint")


def _least(met: DataFrame, most: float) -> float:
    """A bound that at most `most` of the numbers in the column `met` reach: a power of two."""
    sizes = met.groupBy(F.floor(F.log2("met")).alias("power")).count().collect()  # at most 63 rows
    reached, least = 0, 2.0 ** 63
    for power, n in sorted(((r[0], r[1]) for r in sizes), reverse=True):
        reached += n
        if reached > most:
            break
        least = 2.0 ** power
    return least


class Vocabulary(dict):
    """Words met in a task, numbered, with their hashes and log10(count + 1); 0 if a word is not common."""

    def __init__(self, common_ids: np.ndarray, common_counts: np.ndarray):
        super().__init__()
        self.common_ids, self.common_counts = common_ids, common_counts
        self.logs, self.ids = np.zeros(0), np.zeros(0, dtype=np.int64)
        self.new: list[int] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(xxhash.xxh64_intdigest(word))
        number = self[word] = len(self)
        return number

    def places(self, docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of each word of the documents, one after the other; logs and hashes by number."""
        if len(self) > 200_000:
            self.clear()
            self.logs, self.ids = self.logs[:0], self.ids[:0]
        words = np.fromiter(map(self.__getitem__, chain.from_iterable(docs)), dtype=np.int64, count=sum(map(len, docs)))
        if self.new:
            ids = np.array(self.new, dtype=np.uint64).view(np.int64)
            at = _find(self.common_ids, ids)
            logs = np.log10(self.common_counts[at] + 1.0) * (at >= 0) if len(self.common_ids) else np.zeros(len(ids))
            self.ids, self.logs, self.new = np.concatenate([self.ids, ids]), np.concatenate([self.logs, logs]), []
        return words, self.logs, self.ids


def _per_document(unique: np.ndarray, place: np.ndarray, wanted: np.ndarray, sizes: np.ndarray) -> tuple[pa.ListArray, pa.ListArray]:
    """Per document its distinct numbers among the wanted ones, and how often it has each.

    `place` has for each byte of the documents, `sizes` bytes each, the position of its number in `unique`.
    """
    there = wanted[place]
    doc = np.repeat(np.arange(len(sizes)), sizes)[there]
    both, times = np.unique(doc * max(len(unique), 1) + place[there], return_counts=True)
    doc, at = both // max(len(unique), 1), both % max(len(unique), 1)
    cut = pa.array(np.searchsorted(doc, np.arange(len(sizes) + 1)).astype(np.int32))
    keys = pa.array(unique[at].astype(np.int64))
    return pa.ListArray.from_arrays(cut, keys), pa.ListArray.from_arrays(cut, pa.array(times.astype(np.int32)))


def score_corpus(
    df: DataFrame,
    train: Column,
    key: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    node_share: float = NODE_SHARE,
    word_share: float = WORD_SHARE,
) -> DataFrame:
    """One row per input row: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words, A to Z in lower case, and one end per document. `base_score` is the log10
    probability of the tokens by add-one counts of the training rows, `score` that of the same words,
    byte by byte, by the trie (class Trie) learned from the same rows.

    Counts cover all bytes and words of the training rows, and every counted context takes part. Each
    distinct context and byte of any row gets its code length once (code_lengths). The most frequent ones,
    at most 1 / node_share, are broadcast; the others are counted per row and joined with their code
    lengths. Words by share likewise: rarer words of a text are counted per row and joined with the
    counts. Counts, code lengths and row results are stored in the shared folder.

    Null and empty texts are one end. Repeated rows, also with one id, get results of their own. If
    nothing is learned, bytes are equally likely. Extra columns are ignored; an empty table gives an
    empty result.
    """
    spark = df.sparkSession
    counts = materialize(count_corpus(df, text, train, order))
    lengths = materialize(code_lengths(counts, order))
    bar = F.lit(_least(lengths, 1 / node_share))
    usual = lengths.filter(F.col("met") >= bar).select("key", "cost").toArrow().sort_by("key")
    near = spark.sparkContext.broadcast((usual.column("key").to_numpy().astype(np.uint64), usual.column("cost").to_numpy()))
    words = counts.filter("kind = 1")
    ends = counts.filter("kind = 2").agg(F.sum("n")).first()[0] or 0
    n_words, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    seen, kinds = n_words + ends, distinct + (1 if ends else 0)
    least = max(1.0, word_share * seen)
    often = words.filter(F.col("n") >= F.lit(least)).toArrow()
    by_id = np.argsort(often.column("key").to_numpy())
    common = spark.sparkContext.broadcast((often.column("key").to_numpy()[by_id], often.column("n").to_numpy()[by_id]))

    def score(batches):
        (usual_keys, usual_costs), common_words = near.value, common.value
        known_words = Vocabulary(*common_words)
        for batch in batches:
            for part, texts in text_slices(batch, chars=_SLICE):
                docs = [tokens(t) for t in texts]
                packed, sizes = contexts(docs, order)
                place, unique = pd.factorize(packed)
                at = _find(usual_keys, unique)
                cost = np.where(at >= 0, usual_costs[at], 0.0) if len(usual_costs) else np.zeros(len(unique))
                scores = np.add.reduceat(cost[place], np.cumsum(sizes) - sizes) if len(docs) else np.zeros(0)
                far, far_times = _per_document(unique, place, at < 0, sizes)
                word, logs, ids = known_words.places(docs)
                lengths = np.array([len(d) for d in docs], dtype=np.int64)
                doc = np.repeat(np.arange(len(docs)), lengths)
                met = logs > 0
                of_docs = math.log10(ends + 1) + np.bincount(doc, weights=logs[word], minlength=len(docs))
                known = int(ends > 0) + np.bincount(doc, weights=met[word], minlength=len(docs)).astype(np.int64)
                rare, times = _per_document(ids, word, ~met, lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(lengths + 1, pa.int64()), pa.array(known, pa.int64()),
                        pa.array(of_docs, pa.float64()), pa.array(scores, pa.float64()), rare, times, far, far_times,
                    ],
                    ["doc_id", "n_tokens", "known", "logs", "score", "rare", "times", "far", "far_times"],
                )

    kind = df.select(F.col(key)).schema[0].dataType.simpleString()
    made = "n_tokens bigint, known bigint, logs double, score double, rare array<bigint>, times array<int>, far array<bigint>, far_times array<int>"
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(score, f"doc_id {kind}, {made}")
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()))
    rare = rows.select("_row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("_row", "w.rare", "w.times")
    far = rows.select("_row", F.explode(F.arrays_zip("far", "far_times")).alias("w")).select("_row", "w.far", "w.far_times")
    of_words = rare.join(words.filter(F.col("n") < F.lit(least)).select("key", "n"), F.col("rare") == F.col("key")).select(
        "_row", F.col("times").cast("bigint").alias("more"), (F.col("times") * F.log10(F.col("n") + 1)).alias("logs"), F.lit(0.0).alias("score")
    )
    of_contexts = far.join(lengths.filter(F.col("met") < bar).select("key", "cost"), F.col("far") == F.col("key")).select(
        "_row", F.lit(0).cast("bigint").alias("more"), F.lit(0.0).alias("logs"), (F.col("far_times") * F.col("cost")).alias("score")
    )
    found = of_words.unionByName(of_contexts).groupBy("_row").agg(
        F.sum("more").alias("more"), F.sum("logs").alias("more_logs"), F.sum("score").alias("more_score")
    )
    size = F.log10(F.lit(float(seen + kinds + 1)))
    zero = F.lit(0)
    return rows.join(found, "_row", "left").select(
        "doc_id", "n_tokens",
        (F.col("known") + F.coalesce("more", zero)).alias("n_known"),
        F.lit(seen).cast("bigint").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * size).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
