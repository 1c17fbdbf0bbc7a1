"""Corpus and sequence preparation: tokens, vocabularies, n-grams, windows, padded arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparrowmill.functions.arrays import let, pad, total
from sparrowmill.functions.rand import portable_rand
from sparrowmill.operators.ordering import number_rows
from sparrowmill.session import materialize

HOT_KEYS = 1000
MAP_SIDE_ROWS = 1_000_000
MAP_SIDE_BYTES = 64 << 20
# a vocabulary that each Python worker holds, and the tokens that one of its groups holds
TASK_ROWS = 1 << 18
TASK_BYTES = 8 << 20
BLOCK_TOKENS = 1 << 22
WORDS_A_ROW = 1 << 15


def explode_tokens(df: DataFrame, tokens: Column, keep=("doc_id",), name: str = "token") -> DataFrame:
    """Long form: one row per token with its position."""
    return df.select(*keep, F.posexplode(tokens).alias("pos", name))


def ngram_array(tokens: Column, n: int) -> Column:
    """The n-grams of one row's tokens, joined by a space. Needs no shuffle and no window."""
    if n == 1:
        return tokens

    def grams(t):
        joined = F.transform(t, lambda w, i: F.concat_ws(" ", w, *[F.get(t, i + j) for j in range(1, n)]))
        return F.slice(joined, F.lit(1), F.greatest(F.size(t) - (n - 1), F.lit(0)))

    return let(tokens, grams)


def ngram_counts(df: DataFrame, tokens: Column, n: int, by=()) -> DataFrame:
    """Counts of the n-grams; they may cross lines but never rows. Counts combine before the shuffle."""
    grams = df.select(*by, F.explode(ngram_array(tokens, n)).alias("gram"))
    return grams.groupBy(*by, "gram").agg(F.count(F.lit(1)).alias("n"))


def word_pairs(df: DataFrame, tokens: Column, by=()) -> DataFrame:
    """Stored counts (by, w1, w2, n) of neighbouring words. The last word of a row comes with w2 null, so w1 counts every
    word once and one reading of the texts serves words and pairs."""
    pair = lambda t: F.transform(t, lambda w, i: F.struct(w.alias("w1"), F.get(t, i + 1).alias("w2")))
    long = df.select(*by, F.explode(let(tokens, pair)).alias("_p")).select(*by, "_p.w1", "_p.w2")
    return materialize(long.groupBy(*by, "w1", "w2").agg(F.count(F.lit(1)).alias("n")))


def words_of_pairs(counts: DataFrame) -> DataFrame:
    """(gram, n): the words of word_pairs."""
    return counts.groupBy(F.col("w1").alias("gram")).agg(F.sum("n").alias("n"))


def bigrams_of_pairs(counts: DataFrame) -> DataFrame:
    """(gram, w1, w2, n): the bigrams of word_pairs without groups."""
    return counts.filter("w2 is not null").select(F.concat_ws(" ", "w1", "w2").alias("gram"), "w1", "w2", "n")


def most_common(counts: DataFrame, k: int, item: str = "gram") -> DataFrame:
    return counts.orderBy(F.desc("n"), item).limit(k)


def token_totals(df: DataFrame, tokens: Column) -> DataFrame:
    """(token, n, pos_sum): how often each token occurs and the sum of its positions; combined before the shuffle."""
    long = df.select(F.posexplode(tokens).alias("pos", "token"))
    return long.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("pos_sum"))


def build_vocab(df: DataFrame, tokens: Column, min_freq: int = 1, specials=("<unk>",)) -> DataFrame:
    """Stored vocabulary (token, id, freq): specials first, then by falling frequency and rising token."""
    counts = df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("freq"))
    return vocab_of(counts, min_freq, specials)


def vocab_of(counts: DataFrame, min_freq: int = 1, specials=("<unk>",)) -> DataFrame:
    """The vocabulary of counted tokens (token, freq)."""
    df = counts
    kept = counts.filter((F.col("freq") >= min_freq) & ~F.col("token").isin(*specials))
    ranked = number_rows(kept, F.desc("freq"), F.asc("token"), name="id", start=len(specials))
    head = df.sparkSession.createDataFrame(
        [(t, None, i) for i, t in enumerate(specials)], "token string, freq bigint, id bigint"
    )
    return materialize(head.unionByName(ranked).select("token", "id", "freq"))


def fits_in_tasks(dim: DataFrame, columns, limit: int = MAP_SIDE_ROWS, max_bytes: int = MAP_SIDE_BYTES) -> bool:
    """Whether these columns of a stored dimension are small enough to be sent to every task."""
    wide = [F.coalesce(F.sum(F.octet_length(F.col(c).cast("string"))), F.lit(0)) for c in columns]
    size = dim.agg(F.count("*"), sum(wide[1:], wide[0])).first()
    return size[0] <= limit and size[1] <= max_bytes


def lookup(
    rows: DataFrame, dim: DataFrame, key: str, value: str, freq: str, spread: Column, stored: bool = False,
    limit: int = MAP_SIDE_ROWS,
) -> DataFrame:
    """Left join of rows to a dimension whose keys may be very unequal in frequency.

    The dimension is stored and measured; a small one is broadcast. Of a larger one, the keys that make
    up at least one part in HOT_KEYS of the total frequency are at most HOT_KEYS many and are broadcast.
    The remaining rows meet the other keys in an ordinary join; rows already served get a key that
    matches nothing and differs by `spread`, so they do not pile up.
    """
    dim = dim if stored else materialize(dim.select(key, value, freq))
    small = fits_in_tasks(dim, [key, value], limit)
    dim = dim.select(F.col(key).alias("_k"), F.col(value).alias("_v"), F.col(freq).alias("_f"))
    if small:
        out = rows.join(F.broadcast(dim), F.col(key) == F.col("_k"), "left")
        return out.select(*rows.columns, F.col("_v").alias(value))
    dim = dim.filter(F.col("_k").isNotNull())
    share = dim.agg((F.sum("_f") / HOT_KEYS).alias("s")).scalar()
    is_hot = F.coalesce(F.col("_f") >= share, F.lit(False))
    hot = dim.filter(is_hot).select(F.col("_k").alias("_hk"), F.col("_v").alias("_hv"))
    cold = dim.filter(~is_hot).select(F.col("_k").alias("_ck"), F.col("_v").alias("_cv"))
    served = rows.join(F.broadcast(hot), F.col(key) == F.col("_hk"), "left")
    served = served.withColumn(
        "_probe",
        F.when(F.col("_hk").isNull(), F.col(key)).otherwise(F.concat(F.lit("\u0001"), spread.cast("string"))),
    )
    out = served.join(cold, F.col("_probe") == F.col("_ck"), "left")
    return out.select(*rows.columns, F.coalesce("_hv", "_cv").alias(value))


def encode_tokens(
    long: DataFrame, vocab: DataFrame, unk: int = 0, doc: str = "doc_id", limit: int = MAP_SIDE_ROWS
) -> DataFrame:
    """Token ids in long form; tokens outside the vocabulary get the unknown id."""
    found = lookup(long, vocab, "token", "id", "freq", F.xxhash64(doc, "pos"), stored=True, limit=limit)
    return found.withColumn("id", F.coalesce("id", F.lit(unk).cast("bigint")))


def encode_totals(totals: DataFrame, vocab: DataFrame, unk: int = 0) -> DataFrame:
    """Token totals with the id of each token: distinct tokens are joined, so no frequent one is a hot key."""
    ids = vocab.select("token", "id")
    return totals.join(ids, "token", "left").withColumn("id", F.coalesce("id", F.lit(unk).cast("bigint")))


def encode_rows(
    df: DataFrame, tokens: Column, vocab: DataFrame, key: str, unk: int = 0, limit: int = TASK_ROWS, block: int = BLOCK_TOKENS
) -> DataFrame:
    """(key, ids): the ids of a row's tokens in order, one row per input row, also if keys repeat.

    Rows without a token get an empty array.

    A vocabulary of at most `limit` entries goes to every task and nothing is shuffled. With a larger one,
    blocks of rows meet their own part of it (see _by_blocks).
    """
    rows = df.select(key, tokens.alias("tokens"))
    if fits_in_tasks(vocab, ["token", "id"], limit, TASK_BYTES):
        return _map_arrays(rows, vocab, key, "token", "id", unk)
    return _by_blocks(rows, vocab, key, "token", "id", unk, block)


def decode_rows(coded: DataFrame, vocab: DataFrame, key: str, limit: int = TASK_ROWS, block: int = BLOCK_TOKENS) -> DataFrame:
    """(key, tokens): the inverse of encode_rows, one row per input row."""
    rows = coded.select(key, "ids")
    if fits_in_tasks(vocab, ["token", "id"], limit, TASK_BYTES):
        return _map_arrays(rows, vocab, key, "id", "token", None)
    return _by_blocks(rows, vocab, key, "id", "token", None, block)


def _by_blocks(df: DataFrame, vocab: DataFrame, key: str, source: str, target: str, default, block: int) -> DataFrame:
    """Replace the elements of the array column of (key, array) by a vocabulary of any size.

    Rows are stored in blocks, as numbers into the distinct elements of their block. Only these elements are
    joined to the vocabulary, so a frequent one is one row per block there, and go back to their block.
    """
    import pyarrow as pa

    out, kinds = {"id": "ids", "token": "tokens"}.get(target, target), dict(vocab.dtypes)
    made = {"bigint": pa.int64(), "double": pa.float64()}.get(kinds[target], pa.string())
    local = materialize(number_in_blocks(df, kinds[source], block))
    words = local.filter("_words is not null").select(F.col("_block").alias("_of"), "_first", F.posexplode("_words").alias("_at", "_k"))
    words = words.select("_of", (F.col("_first") + F.col("_at")).alias("_code"), "_k")
    dim = vocab.select(F.col(source).alias("_k"), F.col(target).alias("_v"))
    found = words.join(dim, "_k", "left").select("_of", "_code", "_v")

    def translate(rows, found):
        import pyarrow.compute as pc

        ordered = found.sort_by("_code").column("_v").combine_chunks().cast(made)  # every code of the block is there
        arrays = []
        for codes in rows.column("_codes").chunks:
            values = ordered.take(codes.flatten())
            if default is not None:
                values = pc.fill_null(values, pa.scalar(default, made))
            arrays.append(pa.ListArray.from_arrays(_offsets(codes), values))
        return pa.table([rows.column(key), pa.chunked_array(arrays, pa.list_(made))], names=[key, out])

    rows = local.filter("_codes is not null").select("_block", key, "_codes")
    return rows.groupBy("_block").cogroup(found.groupBy("_of")).applyInArrow(
        translate, f"`{key}` {dict(df.dtypes)[key]}, `{out}` array<{kinds[target]}>"
    )


def number_in_blocks(df: DataFrame, kind: str, block: int) -> DataFrame:
    """(key, _block, _codes, _first, _words): the rows of (key, array) with numbers for their elements, and rows with the
    elements that the numbers from `_first` on stand for. A block is of one task and has at most `block` elements, or one row."""
    import pyarrow as pa

    key, column = df.columns
    element = pa.int64() if kind == "bigint" else pa.string()

    def cut(batches):
        from pyspark import TaskContext

        at, held, size = TaskContext.get().partitionId() << 33, [], 0
        for batch in batches:
            ends = _offsets(batch.column(1)).to_numpy()[1:]
            start = 0
            while start < batch.num_rows:
                before = int(ends[start - 1]) if start else 0
                stop = max(start + 1, int(ends.searchsorted(before + block - size, side="right")))
                held.append(batch.slice(start, stop - start))
                size += int(ends[stop - 1]) - before
                start = stop
                if size >= block or start < batch.num_rows:
                    yield from numbered(held, at)
                    at, held, size = at + 1, [], 0
        if held:
            yield from numbered(held, at)

    def numbered(held, at):
        arrays = [piece.column(1) for piece in held]
        coded = pa.chunked_array([a.flatten().cast(element) for a in arrays], element).combine_chunks().dictionary_encode()
        done = 0
        for piece, array in zip(held, arrays):
            offsets = _offsets(array)
            n = offsets[-1].as_py()
            codes = pa.ListArray.from_arrays(offsets, coded.indices.slice(done, n))
            done += n
            yield frame(piece.column(0), at, codes, pa.nulls(piece.num_rows, pa.int32()), pa.nulls(piece.num_rows, pa.list_(element)))
        for first in range(0, len(coded.dictionary), WORDS_A_ROW):
            part = coded.dictionary.slice(first, WORDS_A_ROW)
            words = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part)
            yield frame(pa.nulls(1, held[0].column(0).type), at, pa.nulls(1, pa.list_(pa.int32())), pa.array([first], pa.int32()), words)

    def frame(keys, at, codes, first, words):
        blocks = pa.array([at] * len(keys), pa.int64())
        return pa.RecordBatch.from_arrays([keys, blocks, codes, first, words], names=[key, "_block", "_codes", "_first", "_words"])

    made = f"`{key}` {dict(df.dtypes)[key]}, _block bigint, _codes array<int>, _first int, _words array<{kind}>"
    return df.mapInArrow(cut, made)


def _offsets(arrays):
    """Where the flattened elements of each array begin, from 0; a null array has none."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.list_value_length(arrays), 0).to_numpy(zero_copy_only=False)
    return pa.array(np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int32))


def _map_arrays(df: DataFrame, vocab: DataFrame, key: str, source: str, target: str, default) -> DataFrame:
    """Replace the elements of the array column of (key, array) by the vocabulary, in Arrow batches."""
    import pyarrow as pa

    rows = vocab.select(source, target).toArrow().combine_chunks()
    table = df.sparkSession.sparkContext.broadcast((rows[source].combine_chunks(), rows[target].combine_chunks()))
    out = "ids" if target == "id" else "tokens"
    kinds = dict(vocab.dtypes)

    def translate(batches):
        import pyarrow.compute as pc

        keys, values = table.value
        for batch in batches:
            arrays = batch.column(1)
            at = pc.index_in(arrays.flatten().cast(keys.type), value_set=keys)
            found = values.take(at)
            if default is not None:
                found = pc.fill_null(found, pa.scalar(default, values.type))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(_offsets(arrays), found)], names=[key, out]
            )

    return df.mapInArrow(translate, f"`{key}` {dict(df.dtypes)[key]}, `{out}` array<{kinds[target]}>")


def extend_vocab(vocab: DataFrame, new_tokens: list[str]) -> DataFrame:
    """Append tokens that are not there yet, in the given order, after the highest id."""
    spark = vocab.sparkSession
    wanted = spark.createDataFrame([(t, i) for i, t in enumerate(dict.fromkeys(new_tokens))], "token string, at int")
    fresh = wanted.join(vocab.select("token"), "token", "left_anti")
    top = vocab.agg(F.max("id")).scalar()
    # the list of new tokens is a driver-side argument, so one small window is enough
    ranked = fresh.withColumn("rk", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("at")))
    added = ranked.select("token", (top + F.col("rk")).cast("bigint").alias("id"), F.lit(None).cast("bigint").alias("freq"))
    return vocab.unionByName(added)


def unigram_probabilities(counts: DataFrame, eps: float = 0.0) -> DataFrame:
    """(gram, n, p, p_smooth): n / total and (n + eps / m) / (total + eps) with m distinct words."""
    both = counts.agg(F.struct(F.sum("n").alias("t"), F.count(F.lit(1)).alias("m"))).scalar()
    total, distinct = both["t"], both["m"]
    return counts.select(
        "gram", "n",
        (F.col("n") / total).alias("p"),
        ((F.col("n") + F.lit(eps) / distinct) / (total + F.lit(eps))).alias("p_smooth"),
    )


def bigram_probabilities(
    bigrams: DataFrame, unigrams: DataFrame, eps: float, limit: int = MAP_SIDE_ROWS, keep=()
) -> DataFrame:
    """(w1, w2, n, p, p_smooth) with p = n(w1,w2)/n(w1) and the back-off (n(w1,w2)+eps*p(w2))/(n(w1)+eps)."""
    unigrams = materialize(unigrams)  # one row per distinct word, used three times
    total = unigrams.agg(F.sum("n")).scalar()
    first = unigrams.select(F.col("gram").alias("w1"), F.col("n").alias("n1"), F.col("n").alias("f"))
    second = unigrams.select(F.col("gram").alias("w2"), F.col("n").alias("n2"), F.col("n").alias("f"))
    known = "w1" in bigrams.columns
    w1, w2 = (F.col(f"w{i + 1}") if known else F.split("gram", " ")[i].alias(f"w{i + 1}") for i in range(2))
    pairs = bigrams.select(w1, w2, F.col("n"), F.col("gram"), *keep)
    pairs = lookup(pairs, first, "w1", "n1", "f", F.xxhash64("gram"), stored=True, limit=limit)
    pairs = lookup(pairs, second, "w2", "n2", "f", F.xxhash64("gram"), stored=True, limit=limit)
    back_off = F.col("n2") / total
    return pairs.select(
        "gram", "w1", "w2", "n", *keep,
        (F.col("n") / F.col("n1")).alias("p"),
        ((F.col("n") + F.lit(eps) * back_off) / (F.col("n1") + F.lit(eps))).alias("p_smooth"),
    )


def perplexity(df: DataFrame, tokens: Column, by: str, eps: float, limit: int = MAP_SIDE_ROWS) -> DataFrame:
    """(by, n, perplexity): exp of the mean negative log-likelihood per bigram under the smoothed model.

    The texts are read once, for the counts of words and bigrams per group. Each distinct bigram gets its
    probability once and meets its counts by a join on the bigram, whatever the number of groups: a
    frequent bigram has one row per group there, not one per occurrence.
    """
    counts = word_pairs(df.select(F.col(by).alias("_by"), tokens.alias("_t")), F.col("_t"), ["_by"])
    whole = counts.groupBy("w1", "w2").agg(F.sum("n").alias("n"))
    model = bigram_probabilities(bigrams_of_pairs(whole), words_of_pairs(counts), eps, limit).select("w1", "w2", "p_smooth")
    scored = counts.filter("w2 is not null").withColumnRenamed("n", "_c").join(model, ["w1", "w2"])
    loss = -F.sum(F.col("_c") * F.log("p_smooth")) / F.sum("_c")
    return scored.groupBy(F.col("_by").alias(by)).agg(F.sum("_c").alias("n"), F.exp(loss).alias("perplexity"))


def random_windows(coded: DataFrame, key: str, steps: int, batch_size: int, seed: int) -> DataFrame:
    """Input and target windows at a random offset, shuffled, in full batches.

    Per row: drop a seeded offset below `steps`, keep ((L - 1) div steps) - 1 windows, y shifted by one. Windows are
    cut inside the row, so a row of any length is copied once.
    """
    offset = F.floor(portable_rand(key, seed=seed) * steps).cast("int")
    rest = coded.withColumn("_off", offset).withColumn("_n", F.floor((F.size("ids") - F.col("_off") - 1) / steps) - 1)
    starts = F.sequence(F.lit(0), F.col("_n").cast("int") - 1)
    window = lambda w: F.struct(w.alias("win"), *_shifted_pair(F.col("_off") + w * steps, steps))
    cut = rest.filter("_n > 0").select(key, F.explode(F.transform(starts, window)).alias("_w")).select(key, "_w.*")
    mixed = number_rows(cut, portable_rand(key, "win", seed=f"{seed}w"), key, "win", name="_i")
    placed = mixed.withColumn("batch", F.floor(F.col("_i") / batch_size)).withColumn("slot", F.col("_i") % batch_size)
    total = mixed.agg(F.floor(F.count(F.lit(1)) / batch_size)).scalar()
    return placed.filter(F.col("batch") < total).drop("_i")


def _shifted_pair(at: Column, steps: int) -> list[Column]:
    """Input x of `steps` ids from position `at` (from 0) and target y one position later."""
    return [F.slice("ids", at + 1, steps).alias("x"), F.slice("ids", at + 2, steps).alias("y")]


def strip_windows(coded: DataFrame, key: str, steps: int, batch_size: int, seed: int) -> DataFrame:
    """Windows of adjacent batches: the row is cut into batch_size strips that advance in parallel.

    Windows are cut inside the row, so a row of any length is copied once.
    """
    offset = F.floor(portable_rand(key, seed=seed) * steps).cast("int")
    width = F.floor((F.size("ids") - offset) / batch_size).cast("int")
    sized = coded.withColumn("_off", offset).withColumn("_w", width)
    sized = sized.withColumn("_e", F.floor((F.col("_w") - 1) / steps).cast("int")).filter("_e > 0")
    numbers = F.sequence(F.lit(0), F.col("_e") * batch_size - 1)

    def window(i):
        step, strip = F.floor(i / batch_size).cast("int"), (i % batch_size).cast("int")
        return F.struct(step.alias("step"), strip.alias("strip"), *_shifted_pair(F.col("_off") + strip * F.col("_w") + step * steps, steps))

    return sized.select(key, F.explode(F.transform(numbers, window)).alias("_c")).select(key, "_c.*")


def padded(ids: Column, max_len: int, pad_id: int = 0, bos: int | None = None, eos: int | None = None) -> Column:
    """Ids with optional begin and end marks, cut or filled to max_len."""
    parts = [F.array(F.lit(bos).cast("bigint"))] if bos is not None else []
    parts.append(ids)
    if eos is not None:
        parts.append(F.array(F.lit(eos).cast("bigint")))
    return pad(F.concat(*parts), max_len, F.lit(pad_id).cast("bigint"))


def valid_length(arr: Column, pad_id: int = 0) -> Column:
    return F.size(F.filter(arr, lambda x: x != pad_id))


def turn_pairs(conversations: DataFrame) -> DataFrame:
    """A user turn and the assistant turn right after it, in one conversation."""
    asked = conversations.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("source"), (F.col("turn") + 1).alias("_next")
    )
    answered = conversations.filter(F.col("role") == "assistant").select(
        F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("text").alias("target")
    )
    joined = asked.join(answered, (F.col("conv_id") == F.col("_c")) & (F.col("_next") == F.col("_t")))
    return joined.select(F.concat_ws("-", "conv_id", "turn").alias("pair_id"), "conv_id", "turn", "source", "target")


def encode_pair(a: Column, b: Column, max_len: int, cls: int, sep: int, pad_id: int = 0) -> dict[str, Column]:
    """Pair encoding: cls a sep b sep, the longer side cut first, then filled to max_len.

    When both sides have to shrink the first keeps the odd token.
    """
    room = max_len - 3
    la, lb = F.size(a), F.size(b)
    over = la + lb > room
    keep_a = F.when(over, F.least(la, F.greatest(F.lit(room) - lb, F.lit((room + 1) // 2)))).otherwise(la)
    keep_b = F.when(over, F.lit(room) - keep_a).otherwise(lb)
    one = lambda v: F.array(F.lit(v).cast("bigint"))
    body = F.concat(one(cls), F.slice(a, 1, keep_a), one(sep), F.slice(b, 1, keep_b), one(sep))
    used = keep_a + keep_b + 3
    spots = F.sequence(F.lit(0), F.lit(max_len - 1))
    lengths = F.struct(keep_a.alias("a"), used.alias("used"))

    def flags(test):
        return let(lengths, lambda n: F.transform(spots, lambda i: test(i, n["a"], n["used"]).cast("int")))

    return {
        "input_ids": pad(body, max_len, F.lit(pad_id).cast("bigint")),
        "token_type_ids": flags(lambda i, ka, n: (i >= ka + 2) & (i < n)),
        "attention_mask": flags(lambda i, ka, n: i < n),
        "special_tokens_mask": flags(lambda i, ka, n: (i == 0) | (i == ka + 1) | (i >= n - 1)),
        "length": used,
    }


def encode_single(a: Column, max_len: int, cls: int, sep: int, pad_id: int = 0) -> dict[str, Column]:
    """Encoding of one sentence: cls a sep, a cut to fit, then filled to max_len; all token types are 0."""
    keep = F.least(F.size(a), F.lit(max_len - 2))
    one = lambda v: F.array(F.lit(v).cast("bigint"))
    spots = F.sequence(F.lit(0), F.lit(max_len - 1))
    flags = lambda test: let(keep, lambda n: F.transform(spots, lambda i: test(i, n).cast("int")))
    return {
        "input_ids": pad(F.concat(one(cls), F.slice(a, F.lit(1), keep), one(sep)), max_len, F.lit(pad_id).cast("bigint")),
        "token_type_ids": F.array_repeat(F.lit(0), max_len),
        "attention_mask": flags(lambda i, n: i < n + 2),
        "special_tokens_mask": flags(lambda i, n: (i == 0) | (i >= n + 1)),
        "length": keep + 2,
    }


def sequence_scores(
    df: DataFrame, grams: Column, model: DataFrame, key: str = "doc_id", alpha: float = 0.75, block: int = BLOCK_TOKENS
) -> DataFrame:
    """(key, len, score): sum(ln p) / L**alpha over the bigrams of all rows of a key. The model has (gram, p_smooth).

    A block of rows meets the model with its distinct bigrams, and sums leave it, one per row.
    """
    dim = model.select("gram", F.log("p_smooth").alias("lp"))
    found = _by_blocks(df.select(key, grams.alias("grams")), dim, key, "gram", "lp", None, block)
    sums = found.select(key, F.size("lp").alias("n"), total("lp").alias("s")).filter("n > 0")
    scored = sums.groupBy(key).agg(F.sum("n").alias("len"), F.sum("s").alias("_s"))
    return scored.select(key, "len", (F.col("_s") / F.pow("len", F.lit(alpha))).alias("score"))


def top_per_group(df: DataFrame, by, order, k: int) -> DataFrame:
    """k first rows per group. Spark limits each group before the shuffle, so a large group is no burden."""
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


def collate(df: DataFrame, order: str, size: int, columns: list[str]) -> DataFrame:
    """One row per batch with a list per column, rows in order."""
    rows = number_rows(df, order, name="_i").withColumn("batch", F.floor(F.col("_i") / size))
    packed = rows.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("_i", *columns))).alias("_r"))
    return packed.select("batch", *[_field("_r", c) for c in columns])


def _field(rows: str, name: str) -> Column:
    return F.transform(rows, lambda r: r[name]).alias(name)
