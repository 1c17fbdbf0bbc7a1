"""Bounding boxes: conversions, overlap joins, anchors, assignment, suppression, losses.

Boxes are columns x1, y1, x2, y2. Boxes of one image may be a large part of all boxes, so nothing
here gathers an image into one task: joins run on cells fitted to the box sizes, and the greedy steps
run as rounds over the overlap pairs.
"""

from __future__ import annotations

import math
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparrowmill.functions.arrays import argmax, let
from sparrowmill.operators.corpus import lookup
from sparrowmill.operators.metrics import focal_row, smooth_l1_row
from sparrowmill.operators.ordering import number_rows, position_in_key
from sparrowmill.session import materialize

CORNERS = ("x1", "y1", "x2", "y2")


def to_center(x1, y1, x2, y2, scale: float = 1.0) -> list[Column]:
    return [
        ((x1 + x2) / 2 * scale).alias("cx"), ((y1 + y2) / 2 * scale).alias("cy"),
        ((x2 - x1) * scale).alias("w"), ((y2 - y1) * scale).alias("h"),
    ]


def to_corner(cx, cy, w, h, scale: float = 1.0) -> list[Column]:
    return [
        ((cx - w / 2) * scale).alias("x1"), ((cy - h / 2) * scale).alias("y1"),
        ((cx + w / 2) * scale).alias("x2"), ((cy + h / 2) * scale).alias("y2"),
    ]


def iou(a: str, b: str) -> Column:
    """Intersection over union of two boxes whose columns carry the given prefixes."""
    c = lambda p, n: F.col(f"{p}{n}")
    w = F.least(c(a, "x2"), c(b, "x2")) - F.greatest(c(a, "x1"), c(b, "x1"))
    h = F.least(c(a, "y2"), c(b, "y2")) - F.greatest(c(a, "y1"), c(b, "y1"))
    inter = F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))
    area = lambda p: (c(p, "x2") - c(p, "x1")) * (c(p, "y2") - c(p, "y1"))
    return inter / (area(a) + area(b) - inter)


def _prefixed(df: DataFrame, prefix: str, keys) -> DataFrame:
    named = [F.col("box_id").alias(f"{prefix}_id"), *[F.col(c).alias(f"{prefix}_{c}") for c in CORNERS]]
    return df.select(*[F.col(k).alias(f"_{prefix}_{k}") for k in keys], *named)


def overlap_join(a: DataFrame, b: DataFrame, thr: float, keys=("image",)) -> DataFrame:
    """Pairs (a_id, b_id) of the same keys whose IoU is above thr, thr > 0.

    IoU > thr forces the widths, and the heights, to differ by less than the factor thr, and the left
    edges by at most (1 - thr) times the larger width. So every box of `a` has one home: its size
    level per axis and the cell of its corner on a grid as coarse as that level. A box of `b` visits
    the neighbouring levels and the cells its bound reaches. The join is an equi-join and each pair
    meets once. Cells shrink with the boxes, so a crowded image does not make a crowded cell.
    """
    if not 0 < thr < 1:
        raise ValueError("thr must be between 0 and 1")
    base = (1 / thr) * (1 + 1e-9)
    level = lambda size: F.floor(F.log(size) / F.lit(math.log(base))).cast("int")
    cell = lambda lv: F.pow(F.lit(base), (lv + 1).cast("double"))
    solid = "x2 > x1 and y2 > y1"

    home = _prefixed(a.filter(solid), "a", keys)
    lw, lh = level(F.col("a_x2") - F.col("a_x1")), level(F.col("a_y2") - F.col("a_y1"))
    home = home.select("*", lw.alias("_lx"), lh.alias("_ly"))
    home = home.select(
        "*", F.floor(F.col("a_x1") / cell(F.col("_lx"))).alias("_cx"), F.floor(F.col("a_y1") / cell(F.col("_ly"))).alias("_cy")
    )

    def visits(axis: str, size: Column, corner: Column) -> Column:
        lv = level(size)

        def cells(l):
            reach = F.greatest(size, cell(l)) * F.lit((1 - thr) * (1 + 1e-9))
            span = F.sequence(F.floor((corner - reach) / cell(l)), F.floor((corner + reach) / cell(l)))
            return F.transform(span, lambda c: F.struct(l.alias(f"l{axis}"), c.alias(f"c{axis}")))

        return F.flatten(F.transform(F.sequence(lv - 1, lv + 1), cells))

    probe = _prefixed(b.filter(solid), "b", keys)
    probe = probe.withColumn("_vx", F.explode(visits("x", F.col("b_x2") - F.col("b_x1"), F.col("b_x1"))))
    probe = probe.withColumn("_vy", F.explode(visits("y", F.col("b_y2") - F.col("b_y1"), F.col("b_y1"))))

    on = [F.col(f"_a_{k}") == F.col(f"_b_{k}") for k in keys]
    on += [F.col(f"_l{x}") == F.col(f"_v{x}.l{x}") for x in "xy"] + [F.col(f"_c{x}") == F.col(f"_v{x}.c{x}") for x in "xy"]
    pairs = home.join(probe, on).withColumn("iou", iou("a_", "b_")).filter(F.col("iou") > thr)
    return pairs.select(*[F.col(f"_a_{k}").alias(k) for k in keys], "a_id", "b_id", "iou")


def touching_pairs(a: DataFrame, b: DataFrame, per_cell: int = 64) -> DataFrame:
    """Pairs (a_id, b_id, iou) of one image with any overlap.

    Each image gets a grid over the extent of its own boxes, in whatever unit, that is finer the more boxes
    of `a` it has. A pair is kept only in the cell that holds the corner (larger x1, larger y1), the
    lowest cell both share.
    """
    both = a.select("image", *CORNERS, F.lit(1).alias("_a")).unionByName(b.select("image", *CORNERS, F.lit(0).alias("_a")))
    per_image = both.groupBy(F.col("image").cast("string").alias("_img")).agg(
        F.sum("_a").alias("_n"), *[F.min(c).alias(f"_lo{c[0]}") for c in ("x1", "y1")], *[F.max(c).alias(f"_hi{c[0]}") for c in ("x2", "y2")]
    )
    grid = F.greatest(F.ceil(F.sqrt(F.col("_n") / per_cell)), F.lit(1)).cast("int")
    scale = lambda x: F.when(F.col(f"_hi{x}") > F.col(f"_lo{x}"), grid / (F.col(f"_hi{x}") - F.col(f"_lo{x}"))).otherwise(F.lit(0.0))
    where = F.struct(*[F.col(f"_lo{x}").alias(f"lo{x}") for x in "xy"], *[scale(x).alias(f"by{x}") for x in "xy"])
    dim = per_image.select("_img", where.alias("_g"), "_n")
    cell = lambda g, axis, at: F.floor((at - F.col(f"{g}.lo{axis}")) * F.col(f"{g}.by{axis}"))

    def celled(df, prefix):
        part = _prefixed(df, prefix, ["image"]).withColumn("_img", F.col(f"_{prefix}_image").cast("string"))
        part = lookup(part, dim, "_img", "_g", "_n", F.xxhash64(f"{prefix}_id")).filter(F.col("_g").isNotNull())
        for axis in "xy":
            span = F.sequence(*[cell("_g", axis, F.col(f"{prefix}_{axis}{n}")) for n in (1, 2)])
            part = part.withColumn(f"_{prefix}c{axis}", F.explode(span))
        return part.withColumnRenamed("_g", f"_{prefix}g").drop("_img")

    left, right = celled(a, "a"), celled(b, "b")
    met = left.join(
        right,
        (F.col("_a_image") == F.col("_b_image")) & (F.col("_acx") == F.col("_bcx")) & (F.col("_acy") == F.col("_bcy")),
    )
    lowest = (F.col("_acx") == cell("_ag", "x", F.greatest("a_x1", "b_x1"))) & (F.col("_acy") == cell("_ag", "y", F.greatest("a_y1", "b_y1")))
    pairs = met.filter(lowest).withColumn("iou", iou("a_", "b_")).filter(F.col("iou") > 0)
    return pairs.select(F.col("_a_image").alias("image"), "a_id", "b_id", "iou")


#: Candidates are looked for above these overlaps, one after the other.
TIERS = (0.5, 0.1, 0.0)
#: Anchors a truth lists at a time.
LIST_ROWS = 256


def _listed(anchors: DataFrame, truths: DataFrame, asking: DataFrame, tier: int, rows: int) -> DataFrame:
    """(b_id, pos, a_id, iou, tier): the next `rows` anchors of the truths in `asking`, best first, above the tier's overlap.

    `asking` has b_id, the position `at` of the first, and the entry (bi, ba) after which it comes.
    """
    some = truths.join(asking.select(F.col("b_id").alias("box_id")), "box_id", "left_semi")
    near = anchors.join(some.select("image").distinct(), "image", "left_semi")
    above = TIERS[tier]
    pairs = overlap_join(near, some, above) if above else touching_pairs(near, some)
    later = (F.col("iou") < F.col("bi")) | ((F.col("iou") == F.col("bi")) & (F.col("a_id") > F.col("ba")))
    best = Window.partitionBy("b_id").orderBy(F.desc("iou"), "a_id")
    ranked = pairs.join(asking, "b_id").filter(later).withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= rows)
    return ranked.select("b_id", (F.col("_r") + F.col("at") - 1).cast("bigint").alias("pos"), "a_id", "iou", F.lit(tier).alias("tier"))


def match_truths(anchors: DataFrame, truths: DataFrame, rows: int = LIST_ROWS) -> DataFrame:
    """(a_id, b_id, iou) of the greedy one-to-one matching by falling IoU, ties by the smaller ids.

    Truths propose to their best anchors, an anchor holds the best truth it was asked by, and the others ask
    their next one: as both sides rank pairs by one order, the stable matching this ends with is the
    greedy one. So a truth only needs the head of its list. It is drawn from the pairs above the first of
    TIERS, `rows` at a time, and refilled when it is spent, at last from all pairs that touch.
    Rounds of proposals and refills are stored; they run while the frame is built.
    """
    asking = truths.select(
        F.col("box_id").alias("b_id"), F.lit(1).cast("bigint").alias("at"), F.lit(0).alias("tier"),
        F.lit(2.0).alias("bi"), F.lit(_LEAST).cast("bigint").alias("ba"),
    )
    held = lists = levels = None
    while True:
        asking = materialize(asking)
        tiers = [t for (t,) in sorted(asking.select("tier").distinct().collect())]  # at most len(TIERS)
        if not tiers:
            return held.select("a_id", "b_id", "iou")
        pieces = [_listed(anchors, truths, asking.filter(F.col("tier") == t), t, rows) for t in tiers]
        new = materialize(reduce(DataFrame.unionByName, pieces))
        lists = new if lists is None else lists.unionByName(new)
        asked = asking.select("b_id", F.struct("tier", "at").alias("asked"))
        levels = asked if levels is None else levels.unionByName(asked)
        held = new.limit(0).select("a_id", "b_id", "iou", F.col("pos").alias("at")) if held is None else held
        free = asking.select("b_id", F.col("at").alias("pos"))
        while not free.isEmpty():
            offers = lists.join(free, ["b_id", "pos"]).select("a_id", "b_id", "iou", F.col("pos").alias("at")).unionByName(held)
            best = Window.partitionBy("a_id").orderBy(F.desc("iou"), "b_id")
            judged = materialize(offers.withColumn("_r", F.row_number().over(best)))
            held = judged.filter("_r = 1").drop("_r")
            free = judged.filter("_r > 1").select("b_id", (F.col("at") + 1).alias("pos"))
        asking = _next_lists(truths.select(F.col("box_id").alias("b_id")).join(held, "b_id", "left_anti"), lists, levels, rows)


_LEAST = -(1 << 63)


def _next_lists(without: DataFrame, lists: DataFrame, levels: DataFrame, rows: int) -> DataFrame:
    """What the truths that no anchor holds ask for next: more of a full list, else the next tier; nothing after the last."""
    asked = levels.groupBy("b_id").agg(F.max("asked").alias("_a")).select("b_id", "_a.tier", F.col("_a.at").alias("_from"))
    ends = lists.groupBy("b_id").agg(F.max("pos").alias("_p"), F.max_by(F.struct("iou", "a_id"), "pos").alias("_e"))
    known = without.join(asked, "b_id").join(ends, "b_id", "left")
    again = F.coalesce(F.col("_p") - F.col("_from") + 1 == rows, F.lit(False))  # the last list asked for was full
    bound = F.element_at(F.array(*[F.lit(t) for t in TIERS]), F.col("tier") + 1)
    following = known.select(
        "b_id", (F.coalesce("_p", F.lit(0)) + 1).cast("bigint").alias("at"), F.when(again, F.col("tier")).otherwise(F.col("tier") + 1).alias("tier"),
        F.when(again, F.col("_e.iou")).otherwise(bound).alias("bi"),
        F.when(again, F.col("_e.a_id")).otherwise(F.lit(_LEAST).cast("bigint")).alias("ba"),
    )
    return following.filter(F.col("tier") < len(TIERS))


def assign(anchors: DataFrame, truths: DataFrame, thr: float, rows: int = LIST_ROWS) -> DataFrame:
    """(box_id, truth_id, iou, stage) for every anchor.

    First every truth gets its anchor by greedy matching; truths that overlap no free anchor get the free
    anchors with the smallest ids of their image, in the order of theirs, with IoU 0. Then each other
    anchor gets its best truth if the IoU reaches thr, else it is background (no truth).
    """
    first = materialize(match_truths(anchors, truths, rows))
    left = truths.select("image", "box_id").join(first.select(F.col("b_id").alias("box_id")), "box_id", "left_anti")
    free = anchors.select("image", "box_id").join(first.select(F.col("a_id").alias("box_id")), "box_id", "left_anti")
    free = free.join(left.select("image").distinct(), "image", "left_semi")
    order = lambda df, name: position_in_key(df, ["image"], ["box_id"], "_p").select("image", "_p", F.col("box_id").alias(name))
    given = order(free, "a_id").join(order(left, "b_id"), ["image", "_p"]).select("a_id", "b_id", F.lit(0.0).alias("iou"))
    first = first.unionByName(given).select("a_id", F.col("b_id").alias("_t1"), F.col("iou").alias("_i1"))
    near = overlap_join(anchors, truths, thr * (1 - 1e-9)).filter(F.col("iou") >= thr)
    best = near.groupBy("a_id").agg(F.max(F.struct("iou", (-F.col("b_id")).alias("nb"))).alias("_m"))
    best = best.select("a_id", (-F.col("_m.nb")).alias("_t2"), F.col("_m.iou").alias("_i2"))
    ids = anchors.select(F.col("box_id").alias("a_id"), "image")
    joined = ids.join(first, "a_id", "left").join(best, "a_id", "left")
    stage = F.when(F.col("_t1").isNotNull(), "greedy").when(F.col("_t2").isNotNull(), "threshold").otherwise("background")
    return joined.select(
        F.col("a_id").alias("box_id"), "image", F.coalesce("_t1", "_t2").alias("truth_id"),
        F.coalesce("_i1", "_i2").alias("iou"), stage.alias("stage"),
    )


#: Boxes of one tile of suppression.
TILE_BOXES = 4096
_OPEN, _KEPT, _GONE = 0, 1, 2


def _decide(batches):
    """(box_id, kept) of the boxes of each tile that follow from what is known and from better boxes of the same tile.

    Edges (tile, lo, hi, known state of hi) come sorted by tile and by falling rank of `lo`, so one pass settles a
    chain inside a tile; the states of one tile are all that is held.
    """
    tile = box = None
    states, gone, open_ = {}, False, False
    for batch in batches:
        out = []

        def settle():
            if gone or not open_:
                states[box] = _GONE if gone else _KEPT
                out.append((box, not gone))

        columns = [batch.column(c).to_pylist() for c in ("tile", "lo", "hi", "state")]
        for t, lo, hi, state in zip(*columns):
            if t != tile or lo != box:
                if box is not None:
                    settle()
                if t != tile:
                    states = {}
                tile, box, gone, open_ = t, lo, False, False
            state = state or states.get(hi, _OPEN)
            gone |= state == _KEPT
            open_ |= state == _OPEN
        yield _decisions(out)
    out = []
    if box is not None and (gone or not open_):
        out.append((box, not gone))
    yield _decisions(out)


def _decisions(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.bool_())], ["box_id", "kept"])


def suppress(boxes: DataFrame, thr: float, keys=("image", "cls"), tile_boxes: int = TILE_BOXES) -> DataFrame:
    """Non-maximum suppression: boxes that no kept, better box of their group overlaps above thr.

    Pairs point from the better box (higher score, then lower id) to the worse. Boxes are dealt to tiles of
    `tile_boxes` neighbours in the order of their group and left edge. In each round every tile decides all
    boxes that follow from its own and from what is known of other tiles; then the decisions are handed
    to the pairs that reach over. So a chain takes a round for each tile border it crosses, not for each
    link. Rounds are stored; they run while the frame is built.
    """
    narrow = boxes.select("box_id", "score", *keys, "x1", "y1")
    placed = number_rows(narrow, *keys, "x1", "y1", "box_id", name="_pos").select("box_id", "score", F.floor(F.col("_pos") / tile_boxes).alias("tile"))
    side = lambda x: placed.select(F.col("box_id").alias(f"{x}_id"), F.struct("score", "tile").alias(f"_{x}"))
    pairs = overlap_join(boxes, boxes, thr, keys).filter("a_id < b_id").select("a_id", "b_id")
    pairs = pairs.join(side("a"), "a_id").join(side("b"), "b_id")
    swap = F.col("_b.score") > F.col("_a.score")
    worse = F.when(swap, F.col("_a")).otherwise(F.col("_b"))
    edges = materialize(pairs.select(
        F.when(swap, F.col("b_id")).otherwise(F.col("a_id")).alias("hi"), F.when(swap, F.col("a_id")).otherwise(F.col("b_id")).alias("lo"),
        worse["tile"].alias("tile"), worse["score"].alias("score"), F.lit(_OPEN).alias("state"),
    ))
    # boxes that are never the worse one stay
    now = edges.select(F.col("hi").alias("box_id")).distinct().join(edges.select(F.col("lo").alias("box_id")), "box_id", "left_anti")
    now = materialize(now.withColumn("kept", F.lit(True)))
    gone = None
    while not edges.isEmpty():
        told = now.select(F.col("box_id").alias("hi"), F.when(F.col("kept"), _KEPT).otherwise(_GONE).alias("_now"))
        edges = edges.join(told, "hi", "left").withColumn("state", F.coalesce("_now", "state")).drop("_now")
        edges = materialize(edges.join(now.select(F.col("box_id").alias("lo")), "lo", "left_anti"))
        line = edges.repartition("tile").sortWithinPartitions("tile", F.desc("score"), "lo")
        now = materialize(line.select("tile", "lo", "hi", "state").mapInArrow(_decide, "box_id bigint, kept boolean"))
        out = now.filter("not kept").select("box_id")
        gone = out if gone is None else gone.unionByName(out)
    return boxes if gone is None else boxes.join(gone, "box_id", "left_anti")


def anchors(df: DataFrame, cells: Column, step: Column, size: Column, next_size: Column, ratio: float = 2.0) -> DataFrame:
    """Four anchors per cell of each row's square feature map, centre form.

    Centres are (i + 0.5) * step; sizes are size, next_size and size at the ratio both ways round.
    """
    side = math.sqrt(ratio)
    shape = lambda w, h: F.struct(w.alias("w"), h.alias("h"))
    shapes = F.array(
        shape(size, size), shape(next_size, next_size), shape(size * side, size / side), shape(size / side, size * side)
    )
    return _on_grid(df, cells, cells, step, step, shapes)


def anchor_lists(df: DataFrame, rows: Column, cols: Column, sizes: Column, ratios: Column) -> DataFrame:
    """The anchors of each cell of each row's feature map of rows x cols cells over the unit square, centre form.

    Of n sizes and m ratios the n + m - 1 pairs with the first size or the first ratio are used: the first size
    with every ratio, then the other sizes with the first ratio. Size s at ratio r is s * sqrt(r) wide
    and s / sqrt(r) high. Lists may differ from row to row; an empty list of either gives no anchor.
    """
    shape = lambda s, r: F.struct((s * F.sqrt(r)).alias("w"), (s / F.sqrt(r)).alias("h"))
    by_ratio = let(F.get(sizes, 0), lambda s: F.transform(ratios, lambda r: shape(s, r)))
    by_size = let(F.get(ratios, 0), lambda r: F.transform(F.slice(sizes, F.lit(2), F.greatest(F.size(sizes) - 1, F.lit(0))), lambda s: shape(s, r)))
    shapes = F.when((F.size(sizes) > 0) & (F.size(ratios) > 0), F.concat(by_ratio, by_size))
    return _on_grid(df, rows, cols, F.lit(1.0) / rows, F.lit(1.0) / cols, shapes)


def _on_grid(df: DataFrame, rows: Column, cols: Column, high: Column, wide: Column, shapes: Column) -> DataFrame:
    """The shapes around the centre of each cell; cells are `high` and `wide`."""
    grid = df.select("*", F.explode(F.sequence(F.lit(0), rows - 1)).alias("row")).select("*", F.explode(F.sequence(F.lit(0), cols - 1)).alias("col"))
    boxes = grid.select("*", F.posexplode(shapes).alias("shape", "_s"))
    return boxes.select(
        *df.columns, "row", "col", "shape", ((F.col("col") + 0.5) * wide).alias("cx"),
        ((F.col("row") + 0.5) * high).alias("cy"), F.col("_s.w").alias("w"), F.col("_s.h").alias("h"),
    )


# fixed values: spread of the centre and size offsets
CENTER_SIGMA, SIZE_SIGMA = 0.1, 0.2


def encode_offsets(a: list[Column], b: list[Column], sigmas=(CENTER_SIGMA, SIZE_SIGMA)) -> list[Column]:
    """Offsets of box b relative to anchor a, both in centre form (cx, cy, w, h)."""
    sc, ss = sigmas
    return [
        ((b[0] - a[0]) / a[2] / sc).alias("dx"), ((b[1] - a[1]) / a[3] / sc).alias("dy"),
        (F.log(b[2] / a[2]) / ss).alias("dw"), (F.log(b[3] / a[3]) / ss).alias("dh"),
    ]


def decode_offsets(a: list[Column], d: list[Column], sigmas=(CENTER_SIGMA, SIZE_SIGMA)) -> list[Column]:
    sc, ss = sigmas
    return [
        (d[0] * sc * a[2] + a[0]).alias("cx"), (d[1] * sc * a[3] + a[1]).alias("cy"),
        (F.exp(d[2] * ss) * a[2]).alias("w"), (F.exp(d[3] * ss) * a[3]).alias("h"),
    ]


def best_class(df: DataFrame, probs: str, background: float) -> DataFrame:
    """Drop rows whose first probability is not below the limit, keep the best other class and its score."""
    kept = df.filter(F.col(probs)[0] < background)
    classes = F.slice(F.col(probs), F.lit(2), F.size(probs) - 1)
    return kept.withColumn("cls", argmax(classes)).withColumn("score", F.array_max(classes))


def detection_loss(
    anchors: DataFrame, truths: DataFrame, offsets: str, logits: str, classes: int, thr: float, loc_weight: float
) -> DataFrame:
    """One row (loss, loc_loss, class_loss).

    Offset loss: smooth L1 summed over an image's anchors above thr for a truth, divided by their
    number, averaged over truths and then images. Class loss: focal loss summed over anchors and
    classes (background 0), divided by the truths, averaged over images. Of several truths the last
    one sets an anchor's class. Images without a truth are left out.
    """
    pairs = materialize(overlap_join(anchors, truths, thr).select("image", "a_id", "b_id"))
    per_image = truths.groupBy("image").agg(F.count("*").alias("truths"))
    corner = lambda p: [F.col(f"{p}{c}") for c in CORNERS]
    a = anchors.select(F.col("box_id").alias("a_id"), F.col(offsets).alias("_o"), *[F.col(c).alias(f"a_{c}") for c in CORNERS])
    b = truths.select(F.col("box_id").alias("b_id"), *[F.col(c).alias(f"b_{c}") for c in CORNERS])
    both = pairs.join(a, "a_id").join(b, "b_id")
    target = encode_offsets(to_center(*corner("a_")), to_center(*corner("b_")), (1.0, 1.0))
    row = sum((smooth_l1_row(F.col("_o")[i], t) for i, t in enumerate(target)), F.lit(0.0))
    per_truth = both.groupBy("image", "b_id").agg((F.sum(row) / F.count("*")).alias("l"))
    loc = per_truth.groupBy("image").agg(F.sum("l").alias("loc"))

    last = pairs.groupBy("a_id").agg(F.max("b_id").alias("b_id")).join(
        truths.select(F.col("box_id").alias("b_id"), (F.col("cls") + 1).alias("_c")), "b_id"
    )
    scored = anchors.select(F.col("box_id").alias("a_id"), "image", F.col(logits).alias("_z")).join(
        last.select("a_id", "_c"), "a_id", "left"
    )
    label = F.coalesce("_c", F.lit(0))
    focal = sum(
        (focal_row(F.col("_z")[c], (label == c).cast("double")) for c in range(classes + 1)), F.lit(0.0)
    )
    cls = scored.groupBy("image").agg(F.sum(focal).alias("cls"))
    joined = per_image.join(loc, "image", "left").join(cls, "image", "left")
    share = lambda c: F.avg(F.coalesce(F.col(c), F.lit(0.0)) / F.col("truths"))
    out = joined.agg(share("loc").alias("loc_loss"), share("cls").alias("class_loss"))
    return out.select((F.col("class_loss") + F.col("loc_loss") * loc_weight).alias("loss"), "loc_loss", "class_loss")
