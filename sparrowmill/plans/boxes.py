"""Group L: boxes and detection post-processing."""

from pyspark.sql import functions as F

from sparrowmill.functions import arrays as ar
from sparrowmill.operators import boxes as op
from sparrowmill.plans.fixtures import BOXES_SQL, IOU_SQL, LOGITS_SQL, boxes, folded, folded_sql, logits
from sparrowmill.plans.registry import query
from sparrowmill.tables import table


def r9(*names):
    return [F.round(n, 9).alias(n) for n in names]


CENTER_A = "(a.x1 + a.x2) / 2 as acx, (a.y1 + a.y2) / 2 as acy, a.x2 - a.x1 as aw, a.y2 - a.y1 as ah"
CENTER_B = "(b.x1 + b.x2) / 2 as bcx, (b.y1 + b.y2) / 2 as bcy, b.x2 - b.x1 as bw, b.y2 - b.y1 as bh"


@query("L01_box_forms", f"""
with {BOXES_SQL}, c as (select box_id, (x1 + x2) / 2 * 256 as cx, (y1 + y2) / 2 * 256 as cy, (x2 - x1) * 256 as w, (y2 - y1) * 256 as h from boxes)
select box_id, round(cx, 9) as cx, round(cy, 9) as cy, round(w, 9) as w, round(h, 9) as h,
 round((cx - w / 2) / 256, 9) as x1, round((cy - h / 2) / 256, 9) as y1, round((cx + w / 2) / 256, 9) as x2, round((cy + h / 2) / 256, 9) as y2 from c
""")
def l01(spark, sf):
    b = boxes(spark, sf)
    corners = [F.col(c) for c in op.CORNERS]
    center = b.select("box_id", *op.to_center(*corners, scale=256.0))
    back = center.select("*", *op.to_corner(*[F.col(c) for c in ("cx", "cy", "w", "h")], scale=1 / 256.0))
    return back.select("box_id", *r9("cx", "cy", "w", "h", *op.CORNERS))


@query("L02_iou", f"""
with {BOXES_SQL} select a.box_id as a_id, b.box_id as b_id, round({IOU_SQL}, 9) as iou from boxes a join boxes b on b.box_id = a.box_id + 1
""")
def l02(spark, sf):
    b = boxes(spark, sf)
    left = b.select(F.col("box_id").alias("a_id"), *[F.col(c).alias(f"a_{c}") for c in op.CORNERS])
    right = b.select(F.col("box_id").alias("b_id"), *[F.col(c).alias(f"b_{c}") for c in op.CORNERS])
    pairs = left.join(right, F.col("a_id") + 1 == F.col("b_id"))
    return pairs.select("a_id", "b_id", F.round(op.iou("a_", "b_"), 9).alias("iou"))


@query("L03_anchors", """
with e as (select vec_id, 0.2 + 0.05 * label as size, 0.25 + 0.05 * label as nxt from embeddings),
r as (select *, cast(unnest(range(0, 4)) as int) as "row" from e), c as (select *, cast(unnest(range(0, 4)) as int) as col from r),
s as (select *, cast(unnest(range(0, 4)) as int) as shape from c)
select vec_id, "row", col, shape, (col + 0.5) / 4 as cx, ("row" + 0.5) / 4 as cy,
 round(case shape when 0 then size when 1 then nxt when 2 then size * sqrt(2.0) else size / sqrt(2.0) end, 9)::double as w,
 round(case shape when 0 then size when 1 then nxt when 2 then size / sqrt(2.0) else size * sqrt(2.0) end, 9)::double as h from s
""")
def l03(spark, sf):
    e = table(spark, sf, "embeddings").select(
        "vec_id", (F.lit(0.2) + F.col("label") * 0.05).alias("size"), (F.lit(0.25) + F.col("label") * 0.05).alias("nxt")
    )
    a = op.anchors(e, F.lit(4), F.lit(0.25), F.col("size"), F.col("nxt"))
    return a.select("vec_id", "row", "col", "shape", "cx", "cy", *r9("w", "h"))


@query("L03_anchor_lists", """
with e as (select vec_id, [0.2 + 0.05 * label, 0.25 + 0.05 * label, 0.7] as sizes, [1.0, 2.0, 0.5] as ratios from embeddings),
r as (select *, cast(unnest(range(0, 2)) as int) as "row" from e), c as (select *, cast(unnest(range(0, 3)) as int) as col from r),
s as (select *, cast(unnest(range(0, 5)) as int) as shape from c),
p as (select *, case when shape < 3 then sizes[1] else sizes[shape - 1] end as s, case when shape < 3 then ratios[shape + 1] else ratios[1] end as r from s)
select vec_id, "row", col, shape, round((col + 0.5) / 3, 9)::double as cx, ("row" + 0.5)::double / 2 as cy, round(s * sqrt(r), 9)::double as w, round(s / sqrt(r), 9)::double as h from p
""")
def l03_lists(spark, sf):
    sizes = F.array(F.lit(0.2) + F.col("label") * 0.05, F.lit(0.25) + F.col("label") * 0.05, F.lit(0.7))
    e = table(spark, sf, "embeddings").select("vec_id", sizes.alias("sizes"), F.array(*map(F.lit, (1.0, 2.0, 0.5))).alias("ratios"))
    a = op.anchor_lists(e, F.lit(2), F.lit(3), F.col("sizes"), F.col("ratios"))
    return a.select("vec_id", "row", "col", "shape", *r9("cx"), "cy", *r9("w", "h"))


@query("L04_assign", f"""
with recursive {BOXES_SQL}, p0 as (select a.image, a.box_id as a_id, b.box_id as b_id, {IOU_SQL} as iou from boxes a join boxes b on a.image = b.image where not a.is_truth and b.is_truth),
p as (select *, row_number() over (partition by image order by iou desc, a_id, b_id) as rn from p0 where iou > 0),
g(image, rn, used_a, used_b, a_id, b_id, hit) as (
 select image, 0::bigint, []::bigint[], []::bigint[], null::bigint, null::bigint, false from (select distinct image from p)
 union all select g.image, p.rn,
  case when list_contains(g.used_a, p.a_id) or list_contains(g.used_b, p.b_id) then g.used_a else list_append(g.used_a, p.a_id) end,
  case when list_contains(g.used_a, p.a_id) or list_contains(g.used_b, p.b_id) then g.used_b else list_append(g.used_b, p.b_id) end,
  p.a_id, p.b_id, not (list_contains(g.used_a, p.a_id) or list_contains(g.used_b, p.b_id)) from g join p on p.image = g.image and p.rn = g.rn + 1),
m0 as (select g.a_id, g.b_id, p.iou from g join p on p.a_id = g.a_id and p.b_id = g.b_id where g.hit),
lt as (select image, box_id as b_id, row_number() over (partition by image order by box_id) as k from boxes where is_truth and box_id not in (select b_id from m0)),
la as (select image, box_id as a_id, row_number() over (partition by image order by box_id) as k from boxes where not is_truth and box_id not in (select a_id from m0)),
m as (select * from m0 union all select a_id, b_id, 0.0 from la join lt using (image, k)),
b as (select a_id, arg_max(b_id, (iou, -b_id)) as b_id, max(iou) as iou from p where iou >= 0.5 group by a_id)
select x.box_id, coalesce(m.b_id, b.b_id) as truth_id, round(coalesce(m.iou, b.iou), 9) as iou,
 case when m.b_id is not null then 'greedy' when b.b_id is not null then 'threshold' else 'background' end as stage
from boxes x left join m on m.a_id = x.box_id left join b on b.a_id = x.box_id where not x.is_truth
""")
def l04(spark, sf):
    b = boxes(spark, sf)
    got = op.assign(b.filter("not is_truth"), b.filter("is_truth"), 0.5)
    return got.select("box_id", "truth_id", F.round("iou", 9).alias("iou"), "stage")


@query("L05_offsets", f"""
with {BOXES_SQL}, p as (select a.box_id as a_id, {CENTER_A}, {CENTER_B} from boxes a join boxes b on b.box_id = a.box_id + 1)
select a_id, round((bcx - acx) / aw / 0.1, 8) + 0.0 as dx, round((bcy - acy) / ah / 0.1, 8) + 0.0 as dy, round(ln(bw / aw) / 0.2, 8) + 0.0 as dw, round(ln(bh / ah) / 0.2, 8) + 0.0 as dh,
 round(bcx, 8) as cx, round(bcy, 8) as cy, round(bw, 8) as w, round(bh, 8) as h from p
""")
def l05(spark, sf):
    b = boxes(spark, sf)
    form = lambda p: b.select(
        F.col("box_id").alias(f"{p}_id"), F.struct(*op.to_center(*[F.col(c) for c in op.CORNERS])).alias(p)
    )
    pairs = form("a").join(form("b"), F.col("a_id") + 1 == F.col("b_id"))
    parts = lambda p: [F.col(p)[c] for c in ("cx", "cy", "w", "h")]
    coded = pairs.select("a_id", "a", *op.encode_offsets(parts("a"), parts("b")))
    offs = [F.col(c) for c in ("dx", "dy", "dw", "dh")]
    both = coded.select("a_id", *offs, *op.decode_offsets(parts("a"), offs))
    return both.select("a_id", *[(F.round(c, 8) + 0.0).alias(c) for c in ("dx", "dy", "dw", "dh", "cx", "cy", "w", "h")])


@query("L06_best_class", f"""
with {LOGITS_SQL}, p as (select vec_id, list_transform(z, lambda v: 1.0 / (1.0 + exp(-v))) as p from logits)
select vec_id, cast(list_position(p[2:], list_max(p[2:])) - 1 as int) as cls, round(list_max(p[2:]), 9) as score from p where p[1] < 0.55
""")
def l06(spark, sf):
    p = logits(spark, sf).select("vec_id", F.transform("z", ar.sigmoid).alias("p"))
    return op.best_class(p, "p", 0.55).select("vec_id", "cls", F.round("score", 9).alias("score"))


@query("L07_nms", f"""
with recursive {BOXES_SQL}, r as (select *, row_number() over (partition by image, cls order by score desc, box_id) as rn from boxes),
g(image, cls, rn, kept, box_id, hit) as (
 select image, cls, 0::bigint, []::struct(x1 double, y1 double, x2 double, y2 double)[], null::bigint, false from (select distinct image, cls from r)
 union all select a.image, a.cls, a.rn,
  case when len(list_filter(g.kept, lambda b: {IOU_SQL} > 0.3)) = 0 then list_append(g.kept, {{'x1': a.x1, 'y1': a.y1, 'x2': a.x2, 'y2': a.y2}}) else g.kept end,
  a.box_id, len(list_filter(g.kept, lambda b: {IOU_SQL} > 0.3)) = 0 from g join r a on a.image = g.image and a.cls = g.cls and a.rn = g.rn + 1)
select g.box_id, g.image, g.cls, round(r.score, 9) as score from g join r on r.box_id = g.box_id where g.hit
""")
def l07(spark, sf):
    kept = op.suppress(boxes(spark, sf), 0.3)
    return kept.select("box_id", "image", "cls", F.round("score", 9).alias("score"))


@query("L08_detection_loss", f"""
with {BOXES_SQL}, z as (select box_id, image, {folded_sql('e', 4)} as z, e from boxes where not is_truth),
p as (select a.image, a.box_id as a_id, b.box_id as b_id, b.cls, a.e, {CENTER_A}, {CENTER_B} from boxes a join boxes b on a.image = b.image
 where not a.is_truth and b.is_truth and {IOU_SQL} > 0.3),
d as (select image, a_id, b_id, abs(e[9] - (bcx - acx) / aw) as d1, abs(e[10] - (bcy - acy) / ah) as d2, abs(e[11] - ln(bw / aw)) as d3, abs(e[12] - ln(bh / ah)) as d4 from p),
s as (select image, b_id, avg({' + '.join(f'(case when d{i} < 1 then 0.5 * d{i} * d{i} else d{i} - 0.5 end)' for i in range(1, 5))}) as l from d group by image, b_id),
loc as (select image, sum(l) as loc from s group by image),
lc as (select a_id, arg_max(cls, b_id) + 1 as c from p group by a_id),
u as (select z.image, unnest(z.z) as v, generate_subscripts(z.z, 1) - 1 as k, coalesce(lc.c, 0) as c from z left join lc on lc.a_id = z.box_id),
f as (select image, case when k = c then 1.0 / (1.0 + exp(-v)) else 1 - 1.0 / (1.0 + exp(-v)) end as pt from u),
cl as (select image, sum(-pow(1 - pt, 2.0) * ln(pt + 1e-10)) as cls from f group by image),
t as (select image, count(*) as n from boxes where is_truth group by image),
o as (select avg(coalesce(loc, 0) / n) as loc_loss, avg(coalesce(cls, 0) / n) as class_loss from t left join loc using (image) left join cl using (image))
select round(class_loss + 2.0 * loc_loss, 6) as loss, round(loc_loss, 6) as loc_loss, round(class_loss, 6) as class_loss from o
""")
def l08(spark, sf):
    b = boxes(spark, sf)
    a = b.filter("not is_truth").withColumn("z", folded(F.col("e"), 4)).withColumn("offs", F.slice("e", 9, 4))
    out = op.detection_loss(a, b.filter("is_truth"), "offs", "z", 3, 0.3, 2.0)
    return out.select(*[F.round(c, 6).alias(c) for c in ("loss", "loc_loss", "class_loss")])
