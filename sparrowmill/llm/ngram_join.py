"""Jaccard join of word n-grams by vertical partitioning, and the groups that its links form."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparrowmill.llm.components import components
from sparrowmill.llm.text import text_slices
from sparrowmill.session import materialize

WORDS = 5
#: Link when PARTS[1] * intersection >= PARTS[0] * union.
PARTS = (4, 5)
#: Bytes of text whose n-grams make one fragment of the first pass (about 4 million n-grams).
FRAGMENT_BYTES = 24_000_000
#: Fragments of the first pass at least.
FRAGMENTS = 32
#: N-grams in at least so many documents come last in the order, the more documents the later; at most
#: FREQUENT_GRAMS of them (9 bytes each, sent to all tasks), of each fragment those in the most documents.
FREQUENT, FREQUENT_GRAMS = 16, 1 << 20
#: Fragments in which the overlap of a pair is counted: quarters of the order, by the upper bits of the hash.
OVERLAP_FRAGMENTS = ((0,), (1,), (2, 3))
#: Rounds in which the documents of an n-gram are compared with one of them only: how many documents are
#: drawn for that from a group that shares many n-grams.
STAR_HUBS = (4, 8)
#: Bits of the parity map of a set.
PARITY_BITS = 512
#: Slots of the bit map that tells the second pass which rows to cut up again (4 MB at most).
SLOTS = 1 << 25
_SLICE = 1 << 22


class Shingler:
    """Sets of hashed word n-grams; hashes of words are remembered."""

    def __init__(self, width: int = WORDS):
        self.width = width
        self.known: dict[bytes, int] = {}

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > 400_000:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))

    def sets(self, texts: list) -> list[np.ndarray]:
        """Sorted distinct 64-bit hashes of the n-grams of each text, fewer words than `width` as one."""
        return [self._set((t or "").encode().lower().split()) for t in texts]

    def _set(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0, dtype=np.uint64)
        h = self._hashes(words)
        width = min(self.width, len(words))
        n = len(words) - width + 1
        mixed = np.full(n, width, dtype=np.uint64)
        for i in range(width):
            mixed = (mixed ^ h[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(31)
        return np.unique(mixed)


def set_key(grams: np.ndarray) -> bytes | None:
    """128-bit name of a set; None for the empty one."""
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None


def _short_key(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _fragment(grams: np.ndarray, fragments: int) -> np.ndarray:
    return (((grams >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)).astype(np.int64)


def _postings(width: int, fragments: int):
    """Batches of documents to one row per fragment: ids, set names, set sizes, counts and 32-bit n-grams."""

    def cut(batches):
        shingler = Shingler(width)
        for batch in batches:
            for part, texts in text_slices(batch, chars=_SLICE):
                sets = shingler.sets(texts)
                ids = np.array([i if i is not None else 0 for i in part.column("doc_id").to_pylist()], dtype=np.int64)
                held = [d for d, s in enumerate(sets) if len(s)]
                if not held:
                    continue
                sizes = np.array([len(sets[d]) for d in held])
                keys = np.array([_short_key(set_key(sets[d])) for d in held], dtype=np.int64)
                flat = np.concatenate([sets[d] for d in held])
                of = np.repeat(np.arange(len(held)), sizes)
                fragment = _fragment(flat, fragments)
                order = np.argsort(fragment, kind="stable")
                flat, of = flat[order].astype(np.uint32), of[order]
                edges = np.searchsorted(fragment[order], np.arange(fragments + 1))
                rows = []
                for f in range(fragments):
                    a, b = edges[f], edges[f + 1]
                    if a == b:
                        continue
                    docs, counts = np.unique(of[a:b], return_counts=True)
                    rows.append((
                        f, ids[held][docs].tobytes(), keys[docs].tobytes(), sizes[docs].astype(np.int32).tobytes(),
                        counts.astype(np.int32).tobytes(), flat[a:b].tobytes(),
                    ))
                names = ["fragment", "ids", "keys", "sizes", "counts", "grams"]
                kinds = [pa.int32()] + [pa.binary()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return cut


def _shared_in_fragment(most: int):
    def shared(table: pa.Table) -> pa.Table:
        """For each document how many of its n-grams of this fragment are in a different set as well.

        Besides, with `gram` (fragment and 32 bits) and without a document, n-grams of FREQUENT documents or more,
        the `most` frequent ones.
        """

        def column(name, kind):
            return np.concatenate([np.frombuffer(b, dtype=kind) for b in table.column(name).to_pylist()])

        ids, keys, sizes, counts = (column(n, k) for n, k in (("ids", "i8"), ("keys", "i8"), ("sizes", "i4"), ("counts", "i4")))
        grams = column("grams", "u4")
        owner = np.repeat(np.arange(len(ids), dtype=np.int32), counts)
        order = np.argsort(grams, kind="stable")
        grams, owner = grams[order], owner[order]
        starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        key = keys[owner]
        elsewhere = np.minimum.reduceat(key, starts) != np.maximum.reduceat(key, starts)
        runs = np.diff(np.append(starts, len(grams)))
        total = np.bincount(owner[np.repeat(elsewhere, runs)], minlength=len(ids))
        some = total > 0
        often = np.flatnonzero(elsewhere & (runs >= FREQUENT))
        often = often[np.argsort(-runs[often], kind="stable")[:most]]
        gram = table.column("fragment")[0].as_py() << 32 | grams[starts[often]].astype(np.int64)
        both = lambda values, kind: pa.chunked_array([pa.array(values, kind), pa.nulls(len(gram), kind)])
        return pa.table({
            "doc_id": both(ids[some], pa.int64()), "key": both(keys[some], pa.int64()), "size": both(sizes[some], pa.int32()),
            "shared": pa.chunked_array([pa.array(total[some], pa.int64()), pa.array(runs[often], pa.int64())]),
            "gram": pa.chunked_array([pa.nulls(int(some.sum()), pa.int64()), pa.array(gram, pa.int64())]),
        })

    return shared


def _frequent(shared: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The frequent n-grams, sorted, and the power of two of their documents; FREQUENT_GRAMS at most."""
    found = shared.filter("gram is not null").select("gram", F.floor(F.log2("shared")).cast("int").alias("power"))
    held = found.toArrow().sort_by("gram")
    return held.column("gram").to_numpy(), held.column("power").to_numpy().astype(np.int8)


def _in_order(grams: np.ndarray, fragments: int, often: np.ndarray, power: np.ndarray) -> np.ndarray:
    """The n-grams of a set in the global order: rare ones by hash, then frequent ones by power and hash."""
    if not len(often) or not len(grams):
        return grams
    name = _fragment(grams, fragments) << 32 | (grams & np.uint64(0xFFFFFFFF)).astype(np.int64)
    at = np.minimum(np.searchsorted(often, name), len(often) - 1)
    return grams[np.lexsort((grams, np.where(often[at] == name, power[at], 0)))]


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS)) + 1


def _bit_map(ids: DataFrame) -> bytes:
    """Bits of the slots of all ids, at most SLOTS / 8 bytes."""
    bits = np.zeros(SLOTS // 8, dtype=np.uint8)
    slots = ids.select(_slot(F.col("doc_id")).alias("slot"))
    pieces = slots.groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    for part, piece in pieces.collect():
        bits[(part - 1) * len(piece):part * len(piece)] = np.frombuffer(piece, dtype=np.uint8)
    return bits.tobytes()


def parity(grams: np.ndarray) -> np.ndarray:
    """Bit i tells whether an odd number of n-grams falls on i. Bits that differ in two sets need an
    n-gram that only one has, so there are at least as many of those."""
    odd = np.bincount((grams % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _describe(width: int, wanted, fragments: int, frequent, kind: str):
    """Set size and name of every text, and the n-grams, in the global order, of those whose slot is in the bit map."""

    def describe(batches):
        shingler, bits = Shingler(width), np.frombuffer(wanted.value, dtype=np.uint8)
        often, power = frequent.value
        for batch in batches:
            for part, texts in text_slices(batch, chars=_SLICE):
                sets = shingler.sets(texts)
                slot = part.column("slot").to_numpy() - 1
                asked = (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1
                grams = [_in_order(s, fragments, often, power).view(np.int64) if w and len(s) else None for s, w in zip(sets, asked)]
                marks = [parity(s) if w and len(s) else None for s, w in zip(sets, asked)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_key(s) for s in sets], pa.binary()), pa.array(grams, pa.list_(pa.int64())),
                        pa.array(marks, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "set_key", "grams", "parity"],
                )

    return describe, f"doc_id {kind}, n_shingles bigint, set_key binary, grams array<bigint>, parity array<bigint>"


def _parity_allows(x: Column, y: Column, sizes: Column, parts) -> Column:
    """Whether two sets of this size together can differ in so few n-grams that they link."""
    words = [F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(PARITY_BITS // 64)]
    return sum(words[1:], words[0]) * (parts[0] + parts[1]) <= sizes * (parts[1] - parts[0])


def _linked(pairs: DataFrame, pieces: DataFrame, parts) -> DataFrame:
    """Those pairs (a, b, size_a, size_b) that link.

    The overlap is counted fragment by fragment and added up. A pair goes on to the next fragment only if
    it would link with all that the smaller rest still allows; after the last that is the overlap itself.
    """
    p, q = parts
    of_a = pieces.select(F.col("node").alias("a"), F.col("parity").alias("_pa"))
    of_b = pieces.select(F.col("node").alias("b"), F.col("parity").alias("_pb"))
    pairs = pairs.join(of_a, "a").join(of_b, "b")
    pairs = pairs.filter(_parity_allows(F.col("_pa"), F.col("_pb"), F.col("size_a") + F.col("size_b"), parts)).drop("_pa", "_pb")
    pairs = pairs.withColumns({"had": F.lit(0), "seen_a": F.lit(0), "seen_b": F.lit(0)})
    for i in range(len(OVERLAP_FRAGMENTS)):
        of_a = pieces.select(F.col("node").alias("a"), F.col(f"grams{i}").alias("_ga"))
        of_b = pieces.select(F.col("node").alias("b"), F.col(f"grams{i}").alias("_gb"))
        pairs = pairs.join(of_a, "a").join(of_b, "b").select(
            "a", "b", "size_a", "size_b",
            (F.col("had") + F.size(F.array_intersect("_ga", "_gb"))).alias("had"),
            (F.col("seen_a") + F.size("_ga")).alias("seen_a"),
            (F.col("seen_b") + F.size("_gb")).alias("seen_b"),
        )
        most = F.col("had") + F.least(F.col("size_a") - F.col("seen_a"), F.col("size_b") - F.col("seen_b"))
        pairs = pairs.filter(most * (p + q) >= (F.col("size_a") + F.col("size_b")) * p)
    return pairs.select("a", "b")


def _prefix(size: str, parts) -> Column:
    """size - ceil(p / q * size) + 1"""
    return F.floor(F.col(size) * (parts[1] - parts[0]) / parts[1]).cast("int") + 1


def _pair(x: str, y: str, parts) -> tuple[list[Column], Column]:
    """Columns of an ordered pair of two structs (node, size), and whether the sizes allow a link."""
    first = F.col(f"{x}.node") < F.col(f"{y}.node")
    chosen = [
        F.when(first, F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}")).alias(f"{n}a") for c, n in (("node", ""), ("size", "size_"))
    ] + [F.when(first, F.col(f"{y}.{c}")).otherwise(F.col(f"{x}.{c}")).alias(f"{n}b") for c, n in (("node", ""), ("size", "size_"))]
    sizes = F.least(f"{x}.size", f"{y}.size") * parts[1] >= F.greatest(f"{x}.size", f"{y}.size") * parts[0]
    return chosen, sizes


def _enough_behind(x: str, y: str, parts) -> Column:
    """Whether two structs (size, pos) that share the n-gram at `pos`, from 0, can share all they need from there on."""
    rest = F.least(F.col(f"{x}.size") - F.col(f"{x}.pos"), F.col(f"{y}.size") - F.col(f"{y}.pos"))
    return rest * (parts[0] + parts[1]) >= (F.col(f"{x}.size") + F.col(f"{y}.size")) * parts[0]


def _open_pairs(placed: DataFrame, pieces: DataFrame, parts) -> DataFrame:
    """(x, y) for every n-gram at which two sets of different components meet and could still link.

    The first n-gram that two linking sets share has all their overlap at or behind it, in both. So a meeting with
    too little behind it in one of them is not made: sets that share much, but too little to link, meet at few of
    their n-grams, and linking ones at the first at least. `placed` has gram and x (node, size, root, pos).
    """
    marked = placed.join(pieces.select("node", "parity"), F.col("x.node") == F.col("node")).drop("node")
    x = marked.select("gram", "x", F.col("parity").alias("_px"))
    y = marked.select(F.col("gram").alias("_gram"), F.col("x").alias("y"), F.col("parity").alias("_py"))
    both = F.col("x.size") + F.col("y.size")
    return x.join(y, (F.col("gram") == F.col("_gram")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root"))
                  & _pair("x", "y", parts)[1] & _enough_behind("x", "y", parts)
                  & _parity_allows(F.col("_px"), F.col("_py"), both, parts)).select("x", "y")


def link_components(nodes: DataFrame, parts=PARTS, hubs=STAR_HUBS) -> DataFrame:
    """(node, root) of all nodes with a link; `nodes` has one row per set: node, size,
    grams in order, parity.

    Sets that link share an n-gram among the first of each: with a similarity of p / q, the first
    size - ceil(p / q * size) + 1 in one global order (prefix filter). Nodes that share such an n-gram
    form a bucket. In the first rounds a bucket compares all its nodes with one of them, drawn by a hash
    of the node and of the n-gram's class, so a bucket of g nodes makes g pairs, and buckets of the same
    nodes make as many as there are classes. What is linked then is one component, and pairs within a
    component need no comparison. The last round compares every pair of a bucket whose two
    nodes are still in different components and whose sizes, parity maps and places of the shared
    n-grams allow a link, so no link between components is missed.
    """
    p, q = parts
    first = materialize(
        nodes.select("node", "size", F.posexplode(F.slice("grams", F.lit(1), _prefix("size", parts))).alias("pos", "gram"))
    )
    quarter = lambda f: F.filter("grams", lambda g: F.shiftrightunsigned(g, 62).isin(*f))
    pieces = materialize(nodes.select("node", "parity", *[quarter(f).alias(f"grams{i}") for i, f in enumerate(OVERLAP_FRAGMENTS)]))
    links = None
    for round_, classes in enumerate([*hubs, None]):
        if links is None:
            placed = first.withColumn("root", F.col("node"))
        else:
            roots = components(links)
            placed = first.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        drawn = F.xxhash64(F.lit(round_), F.pmod("gram", F.lit(classes or 1)), "node")
        me = F.struct(drawn.alias("h"), "node", "size", "root", "pos")
        placed = placed.select("gram", "root", me.alias("x"))
        buckets = placed.groupBy("gram").agg(
            F.min("x").alias("y"), F.min("root").alias("_low"), F.max("root").alias("_high")
        ).filter("_low < _high")
        if classes:
            met = placed.join(buckets.select("gram", "y"), "gram")
        else:
            met = _open_pairs(placed.join(buckets.select("gram"), "gram", "left_semi"), pieces, parts)
        columns, sizes = _pair("x", "y", parts)
        places = [] if classes else [F.col("x.pos").alias("pos_a"), F.col("y.pos").alias("pos_b")]  # there x is the smaller node
        pairs = met.filter("x.root <> y.root").filter(sizes).select(*columns, *places)
        if classes:
            pairs = pairs.distinct()
        else:
            # up to the last n-gram at which two sets meet all that they share were met: these and what is behind it must do
            most = F.col("shared") + F.least(F.col("size_a") - F.col("last_a"), F.col("size_b") - F.col("last_b")) - 1
            pairs = pairs.groupBy("a", "b", "size_a", "size_b").agg(
                F.count(F.lit(1)).alias("shared"), F.max("pos_a").alias("last_a"), F.max("pos_b").alias("last_b")
            )
            pairs = pairs.filter(most * (p + q) >= (F.col("size_a") + F.col("size_b")) * p).drop("shared", "last_a", "last_b")
        found = materialize(_linked(pairs, pieces, parts))
        links = found if links is None else links.union(found)
    return components(links)


def ngram_components(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WORDS, parts=PARTS) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    The set of a text holds its distinct n-grams of `width` words (runs of no ASCII white space, A to Z in
    lower case), or all words as one n-gram if there are fewer. Two texts link when
    q * intersection >= p * union; `component_id` is the smallest id that links reach, its own included.

    N-grams are 64-bit hashes. A first pass cuts the order of the hashes
    into fragments and counts in each, apart from the others, how many n-grams of a document also occur
    in a different set, and which n-grams are in many documents: those come last in the global order, so
    that documents meet by their rare ones. The sum over the fragments is the most it can share with any other, so only
    documents with p / q of their n-grams shared can link; equal sets are one. The second pass
    gives size and name of every set and the n-grams of those few. Pairs among them are found as
    link_components says; their overlaps are again counted by fragment and summed per pair.

    A text that is null or has no word has no n-grams and links with nothing. A row with a null id has
    its size and a null component. Repeated rows are in one component. Extra columns are ignored; an
    empty table gives an empty result.
    """
    spark = df.sparkSession
    kind = df.select(F.col(key)).schema[0].dataType.simpleString()
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    volume = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    fragments = max(FRAGMENTS, 1 + volume // FRAGMENT_BYTES)
    known = rows.filter("doc_id is not null and text is not null")
    postings = known.mapInArrow(
        _postings(width, fragments), "fragment int, ids binary, keys binary, sizes binary, counts binary, grams binary"
    )
    shared = materialize(
        postings.groupBy("fragment").applyInArrow(_shared_in_fragment(FREQUENT_GRAMS // fragments + 1), "doc_id bigint, key bigint, size int, shared bigint, gram bigint")
    )
    can_link = (
        shared.filter("gram is null").groupBy("doc_id", "key", "size").agg(F.sum("shared").alias("shared"))
        .filter(F.col("shared") * parts[1] >= F.col("size") * parts[0])
        .groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    )
    wanted = spark.sparkContext.broadcast(_bit_map(can_link))
    frequent = spark.sparkContext.broadcast(_frequent(shared))
    describe, made = _describe(width, wanted, fragments, frequent, kind)
    docs = materialize(rows.withColumn("slot", _slot(F.col("doc_id"))).mapInArrow(describe, made))
    sets = materialize(
        docs.filter("set_key is not null and doc_id is not null").groupBy("set_key")
        .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("size"), F.first("grams", ignorenulls=True).alias("grams"),
             F.first("parity", ignorenulls=True).alias("parity"))
    )
    roots = link_components(sets.filter("grams is not null").select("node", "size", "grams", "parity"), parts)
    named = sets.select("set_key", "node").join(roots, "node", "left").select("set_key", F.coalesce("root", "node").alias("_root"))
    joined = docs.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_root", "doc_id")).alias("component_id")
    return joined.select("doc_id", "n_shingles", component)
