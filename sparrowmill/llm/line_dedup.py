"""Line dedup within an edit distance, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparrowmill.llm.bitmaps import perhaps_in, slot_maps
from sparrowmill.session import materialize

#: Lines within so many insertions, deletions and replacements of characters are copies.
EDITS = 2
#: Shorter lines are copies only if they are equal.
MIN_CHARS = 20
#: Letters whose counts are compared before two lines are.
LETTERS = "etaoinsrhldcumpg"


def _segment(length: Column, i: int, edits: int) -> tuple[Column, Column]:
    """Start (from 1) and size of segment i of edits + 1 of a line of this length; the last ones are longer."""
    parts = edits + 1
    base, more = F.floor(length / parts).cast("int"), (length % parts).cast("int")
    longer_before = F.greatest(F.lit(0), F.lit(i - parts) + more)
    size = base + F.when(F.lit(parts - i) <= more, 1).otherwise(0) if i < parts else base + F.when(more > 0, 1).otherwise(0)
    return F.lit(1) + base * i + longer_before, size


def segment_keys(line: Column, length: Column, edits: int, own_only: bool = False) -> Column:
    """Array of (key, indexed) of a line, or only of its own segments.

    Within `edits` edits of a line that is `shorter` characters shorter, one of its edits + 1 segments is
    left as it was. The part of this line that equals it starts at most as many characters away as edits
    can lie before it, and ends as many away as can lie behind it. Keys hash length, segment number and
    characters. Those of the line's own segments are in the index, and are probes as well.
    """
    keys = []
    for shorter in range(1 if own_only else edits + 1):
        for i in range(edits + 1):
            start, size = _segment(length - shorter, i, edits)
            for off in [0] if own_only else range(max(-i, shorter - (edits - i)), min(i, shorter + edits - i) + 1):
                own = shorter == 0 and off == 0
                at = start + off
                fits = (at >= 1) & (at + size - 1 <= length)
                key = F.xxhash64(length - shorter, F.lit(i), F.substring(line, at, size))
                keys.append(F.when(fits, F.struct(key.alias("key"), F.lit(own).alias("indexed"))))
    return F.array_compact(F.array(*keys))


def within(a: Column, b: Column, edits: int) -> Column:
    """Whether two lines, given as arrays of characters, are within `edits` edits.

    Banded bit-parallel edit distance: for each character of `b` one step over the 2 * edits + 1 rows
    around the diagonal. Bits tell where the distance rises (up) or falls (down) from row to row; the
    distance itself is carried along the lower edge of the band.
    """
    width = 2 * edits + 1
    full = F.lit((1 << width) - 1).cast("bigint")
    one = F.lit(1).cast("bigint")

    def step(state: Column, j: Column) -> Column:
        up, down, c = state["up"], state["down"], F.get(b, j - 1)
        equal = F.lit(0).cast("bigint")
        for k in range(width):
            equal = equal + F.when(F.get(a, j - 1 - edits + k) == c, F.lit(1 << k).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        return _turn(up, down, equal, state["distance"])

    def _turn(up: Column, down: Column, equal: Column, distance: Column) -> Column:
        # bound once by a one-element array, else each mention would be evaluated anew
        first = F.transform(F.array(equal), lambda e: F.struct(e.alias("e"), ((((e.bitwiseAND(up) + up).bitwiseXOR(up)).bitwiseOR(e).bitwiseOR(down)).bitwiseAND(full)).alias("d")))
        second = F.transform(first, lambda x: F.struct(
            x["d"].alias("d"),
            down.bitwiseOR(F.bitwise_not(x["d"].bitwiseOR(up))).bitwiseAND(full).alias("hp"),
            x["d"].bitwiseAND(up).alias("hn"),
        ))
        third = F.transform(second, lambda y: F.struct(
            y["hn"].bitwiseOR(F.bitwise_not(F.shiftright(y["d"], 1).bitwiseOR(y["hp"]))).bitwiseAND(full).alias("up"),
            F.shiftright(y["d"], 1).bitwiseAND(y["hp"]).alias("down"),
            (distance + 1 - F.shiftright(y["d"], width - 1).bitwiseAND(one).cast("int")).alias("distance"),
        ))
        return third[0]

    start = F.struct(
        F.lit(((1 << (edits + 1)) - 1) << edits).cast("bigint").alias("up"),
        F.lit(0).cast("bigint").alias("down"), F.lit(edits).alias("distance"),
    )
    last = F.aggregate(F.sequence(F.lit(1), F.size(b)), start, step)
    rows = F.size(a) - F.size(b) + edits  # rows behind the end of a are taken off again
    masks = [F.lit(((1 << (2 * edits)) - 1) >> r << r).cast("bigint") for r in range(width)]
    over = F.coalesce(F.get(F.array(*masks), rows), F.lit(0).cast("bigint"))
    end = F.transform(F.array(last), lambda s: s["distance"] - F.bit_count(s["up"].bitwiseAND(over)) + F.bit_count(s["down"].bitwiseAND(over)))
    banded = (F.abs(F.size(a) - F.size(b)) <= edits) & (end[0] <= edits)
    return F.when(F.size(b) == 0, F.size(a) <= edits).otherwise(banded)


def letter_counts(line: Column) -> list[Column]:
    """Counts of the letters of LETTERS, modulo 256, eight to a number."""
    count = lambda c: (F.char_length(line) - F.char_length(F.replace(line, F.lit(c)))).cast("bigint") % 256
    packed = []
    for at in range(0, len(LETTERS), 8):
        parts = [F.shiftleft(count(c), 8 * i) for i, c in enumerate(LETTERS[at:at + 8])]
        packed.append(sum(parts[1:], parts[0]).alias(f"letters{at // 8}"))
    return packed


def _letters_allow(x: str, y: str, edits: int) -> Column:
    """Whether the letter counts of two lines differ by at most two per edit."""
    total = F.lit(0)
    for at in range(len(LETTERS)):
        a, b = (F.shiftrightunsigned(F.col(f"{side}.letters{at // 8}"), 8 * (at % 8)).bitwiseAND(F.lit(255)) for side in (x, y))
        total = total + F.least((a - b).bitwiseAND(F.lit(255)), (b - a).bitwiseAND(F.lit(255)))
    return total <= 2 * edits


def _verified(pairs: DataFrame, lines: DataFrame, edits: int, bit_parallel: bool) -> DataFrame:
    """`later` of the pairs (earlier, later) of line numbers whose lines are within the edits."""
    chars = lambda c: F.slice(F.split(c, ""), F.lit(1), F.char_length(c))
    of = lines.select("id", "line")
    texts = pairs.join(of.withColumnRenamed("id", "earlier"), "earlier").withColumnRenamed("line", "_a")
    texts = texts.join(of.withColumnRenamed("id", "later"), "later").withColumnRenamed("line", "_b")
    near = within(chars(F.col("_a")), chars(F.col("_b")), edits) if bit_parallel else F.levenshtein("_a", "_b", edits) >= 0
    return texts.filter(near).select(F.col("later").alias("id")).distinct()


def near_lines(lines: DataFrame, edits: int = EDITS, bit_parallel: bool = False) -> DataFrame:
    """`id` of the lines that have an earlier one within `edits` edits.

    `lines` has one row per distinct line: id, at (comparable, earlier is smaller), line, length. A key is met by
    lines that have it in the index and lines that probe it; two lines within the edits meet in one. Probes of
    nothing and keys of one line are left out first, by bit maps of the others. In the first round all lines of a key are
    compared with its earliest line only. In the second round those not yet found are compared with
    every earlier line they meet, as far as the letters of the two allow. So a key of g lines makes pairs
    for the lines that stay, not for all g * g.

    Two lines are compared by Spark's banded levenshtein, or with `bit_parallel` by `within`, to the same
    result: its steps are higher-order functions, and took about 1 ms a pair.
    """
    cut = lambda own: lines.select("id", F.explode(segment_keys(F.col("line"), F.col("length"), edits, own)).alias("k")).select(
        F.col("k.key").alias("key"), F.col("k.indexed").alias("indexed"), "id"
    )
    # a probe that no line has in the index goes before anything is stored
    keys = materialize(perhaps_in(cut(False), "key", materialize(slot_maps(F.col("key"), cut(True)))))
    shared = materialize(
        keys.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.max("indexed").alias("held"))
        .filter("held and low <> high").select("key")
    )
    # stored in between: the optimizer would move the semi join below the bit map, and shuffle all keys again
    perhaps = materialize(perhaps_in(keys, "key", slot_maps(F.col("key"), shared)))
    live = materialize(perhaps.join(shared, "key", "left_semi").join(lines.select("id", "at"), "id"))
    me = F.struct("at", "id")
    met = live.groupBy("key").agg(F.min(me).alias("first"), F.min(F.when(F.col("indexed"), me)).alias("held"))
    meeting = materialize(live.join(met, "key").select("key", "indexed", "id", "at", "first", "held"))
    texts = materialize(
        perhaps_in(lines, "id", slot_maps(F.col("id"), meeting)).select("id", "line", *letter_counts(F.col("line")))
    )
    # a line in the index meets every line of the key, one that only probes meets those in the index
    hub = F.when(F.col("indexed"), F.col("first")).otherwise(F.col("held"))
    pair = lambda x, y: [
        F.when(x.getField("at") < y.getField("at"), x.getField("id")).otherwise(y.getField("id")).alias("earlier"),
        F.when(x.getField("at") < y.getField("at"), y.getField("id")).otherwise(x.getField("id")).alias("later"),
    ]
    counts = [c for c in texts.columns if c.startswith("letters")]
    some = texts.select("id", *counts)
    star = meeting.filter(F.col("id") != hub["id"]).select(*pair(me, hub)).distinct()
    star = _allowed(star, some, edits)
    found = materialize(_verified(star, texts, edits, bit_parallel))
    marked = meeting.select("key", "indexed", "id", "at").join(some, "id")
    x, y = marked.join(found, "id", "left_anti").alias("x"), marked.alias("y")
    meet = (F.col("x.key") == F.col("y.key")) & (F.col("y.at") < F.col("x.at")) & (F.col("x.indexed") | F.col("y.indexed"))
    rest = x.join(y, meet & _letters_allow("x", "y", edits)).select(F.col("y.id").alias("earlier"), F.col("x.id").alias("later")).distinct()
    return found.union(materialize(_verified(rest.join(star, ["earlier", "later"], "left_anti"), texts, edits, bit_parallel)))


def _allowed(pairs: DataFrame, counts: DataFrame, edits: int) -> DataFrame:
    """Pairs (earlier, later) whose letters allow the edits."""
    x, y = counts.alias("x"), counts.alias("y")
    both = pairs.join(x, F.col("earlier") == F.col("x.id")).join(y, F.col("later") == F.col("y.id"))
    return both.filter(_letters_allow("x", "y", edits)).select("earlier", "later")


def dedup_lines(
    df: DataFrame, key: str = "doc_id", text: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS,
    bit_parallel: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_exact, n_near, kept (numbers of the lines that stay, from 0).

    Lines end at line feeds. In the order of id and line number the first of equal lines stays, unless an
    earlier line of at least `min_chars` characters is within `edits` edits of it (and it is that long
    itself); the earlier line counts even if it goes itself. `n_exact` lines repeat an earlier one, `n_near`
    are only similar to one. Lines of white space are no copies and always stay.

    Null text has no line, empty text one of white space. A row with a null id keeps all its lines and
    is not compared. Rows with one id count as one document: equal rows have equal results. Extra
    columns are ignored; an empty table gives an empty result.
    """
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    lines = rows.filter("doc_id is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    lines = lines.filter(F.col("line").rlike("\\S"))
    firsts = materialize(
        lines.groupBy("line").agg(F.min(F.struct("doc_id", "no")).alias("at"))
        .withColumns({"id": F.monotonically_increasing_id(), "length": F.char_length("line")})
    )
    near = near_lines(firsts.filter(F.col("length") >= min_chars), edits, bit_parallel).withColumn("near", F.lit(True))
    judged = firsts.select("id", "at").join(near, "id", "left").select("at.doc_id", "at.no", F.coalesce("near", F.lit(False)).alias("near"))
    per_doc = judged.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("_firsts"), F.count_if("near").alias("n_near"),
        F.collect_list(F.when(~F.col("near"), F.col("no"))).alias("_stay"),
    )
    cut = F.coalesce(F.split("text", "\n"), F.array().cast("array<string>"))
    blank = lambda c, i: F.when(F.col("doc_id").isNull() | ~c.rlike("\\S"), i)
    counted = rows.select(
        "doc_id", F.size(cut).cast("bigint").alias("n_lines"), F.array_compact(F.transform(cut, blank)).alias("_blank")
    )
    none = F.array().cast("array<int>")
    return counted.join(per_doc, "doc_id", "left").select(
        "doc_id", "n_lines",
        (F.col("n_lines") - F.size("_blank") - F.coalesce("_firsts", F.lit(0))).alias("n_exact"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.array_sort(F.concat("_blank", F.coalesce("_stay", none))).alias("kept"),
    )


def without_copied_lines(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `df` with the lines that dedup_lines keeps; null text stays null."""
    stay = dedup_lines(df, key, text, **options).select(F.col("doc_id").alias("_id"), F.col("kept").alias("_kept")).dropDuplicates(["_id"])
    cut = F.split(F.col(text), "\n")
    joined = F.array_join(F.transform(F.col("_kept"), lambda i: F.get(cut, i)), "\n")
    changed = df.join(stay, F.col(key).eqNullSafe(F.col("_id")), "left")
    cleaned = F.when(F.col(text).isNotNull() & F.col(key).isNotNull(), joined).otherwise(F.col(text))
    return changed.withColumn(text, cleaned).select(*df.columns)
