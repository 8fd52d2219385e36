"""Registered detection-evaluation queries (E1-E7) on the box fixtures, and
model selection on ``events``.  The DuckDB SQL rebuilds the whole chain
independently: window cap, IoU join, per-group ``list_reduce`` fold for the
greedy matching, window running sums, recall grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import boxes as X
from ..operators import deteval as E
from . import fixtures as FX
from .registry import register, table

ALL = {"all": E.AREA_RANGES["all"]}


def duck_eval(ranges: dict[str, tuple[float, float]], source: str | None = None) -> str:
    """CTEs ending in ``m`` (matches), ``flags``, ``npos``, ``ap`` and ``rec``,
    from a with clause that defines fx_truth and fx_pred."""
    rv = ", ".join(f"('{n}', cast({lo} as double), cast({hi} as double))" for n, (lo, hi) in ranges.items())
    return (source or FX.duck_with("fx_truth", "fx_pred")) + f""",
thr as (select cast(p as double) / cast(100 as double) as thr from (select unnest(range(50, 100, 5)) as p)),
rng as (select * from (values {rv}) as t(rng, lo, hi)),
cap as (select *, row_number() over (partition by image_id, label order by score desc, det_id) as det_rank
        from fx_pred qualify det_rank <= 100),
pairs as (
  select p.image_id, p.label, p.det_id, p.det_rank, t.gt_id, (t.x2 - t.x1) * (t.y2 - t.y1) as t_area,
    case when ((p.x2 - p.x1) * (p.y2 - p.y1) + (t.x2 - t.x1) * (t.y2 - t.y1)
               - greatest(least(p.x2, t.x2) - greatest(p.x1, t.x1), 0.0)
                 * greatest(least(p.y2, t.y2) - greatest(p.y1, t.y1), 0.0)) > 0
         then greatest(least(p.x2, t.x2) - greatest(p.x1, t.x1), 0.0)
              * greatest(least(p.y2, t.y2) - greatest(p.y1, t.y1), 0.0)
              / ((p.x2 - p.x1) * (p.y2 - p.y1) + (t.x2 - t.x1) * (t.y2 - t.y1)
                 - greatest(least(p.x2, t.x2) - greatest(p.x1, t.x1), 0.0)
                   * greatest(least(p.y2, t.y2) - greatest(p.y1, t.y1), 0.0))
         else 0.0 end as iou
  from cap p join fx_truth t on p.image_id = t.image_id and p.label = t.label),
x as (
  select pr.*, thr.thr, rng.rng, case when t_area < lo or t_area > hi then 1 else 0 end as gt_ign
  from pairs pr, thr, rng
  where pr.iou >= 0.5 and pr.iou >= thr.thr
  qualify row_number() over (partition by image_id, label, thr, rng, det_id order by gt_ign, iou desc, gt_id) <= 100),
grp as (
  select image_id, label, thr, rng,
         list({{'a': det_rank, 'b': gt_ign, 'c': -iou, 'd': gt_id, 'e': det_id}}
              order by det_rank, gt_ign, -iou, gt_id) as ps
  from x group by image_id, label, thr, rng),
mm as (
  select image_id, label, thr, rng,
    unnest(list_reduce(ps, lambda acc, p:
      case when list_contains(acc.dets, p.e) or list_contains(acc.taken, p.d) then acc
           else {{'taken': list_append(acc.taken, p.d), 'dets': list_append(acc.dets, p.e),
                 'm': list_append(acc.m, {{'det_id': p.e, 'gt_id': p.d, 'gt_ignored': p.b}})}} end,
      {{'taken': []::BIGINT[], 'dets': []::BIGINT[],
        'm': []::STRUCT(det_id BIGINT, gt_id BIGINT, gt_ignored INTEGER)[]}}).m) as z
  from grp),
m as (select image_id, label, thr, rng, z.det_id as det_id, z.gt_id as gt_id, z.gt_ignored as gt_ignored from mm),
dx as (select d.*, (d.x2 - d.x1) * (d.y2 - d.y1) as d_area, thr.thr, rng.rng, rng.lo, rng.hi from cap d, thr, rng),
flags as (
  select dx.image_id, dx.label, dx.det_id, dx.det_rank, dx.score, dx.thr, dx.rng,
         case when m.gt_id is not null then 1 else 0 end as tp
  from dx left join m on dx.image_id = m.image_id and dx.label = m.label and dx.det_id = m.det_id
                     and dx.thr = m.thr and dx.rng = m.rng
  where not coalesce(m.gt_ignored = 1 or (m.gt_id is null and (dx.d_area < dx.lo or dx.d_area > dx.hi)), false)),
npos as (
  select label, rng, count(*) as npos from fx_truth, rng
  where not ((x2 - x1) * (y2 - y1) < lo or (x2 - x1) * (y2 - y1) > hi) group by label, rng),
runs as (
  select *, sum(1) over w as k, sum(tp) over w as i from flags
  window w as (partition by label, thr, rng order by score desc, image_id, det_id
               rows between unbounded preceding and current row)),
buckets as (
  select r.label, r.thr, r.rng, least((r.i * 100) // n.npos, 100) as j, max(r.i / r.k) as prec
  from runs r join npos n on r.label = n.label and r.rng = n.rng where r.tp = 1
  group by r.label, r.thr, r.rng, j),
grid as (
  select n.label, n.rng, thr.thr, g.j from npos n, thr, (select unnest(range(0, 101)) as j) g where n.npos > 0),
q as (
  select g.label, g.thr, g.rng, g.j,
         coalesce(max(b.prec) over (partition by g.label, g.thr, g.rng order by g.j desc
                                    rows between unbounded preceding and current row), 0.0) as q
  from grid g left join buckets b on g.label = b.label and g.thr = b.thr and g.rng = b.rng and g.j = b.j),
ap as (select label, thr, rng, sum(q) / 101.0 as ap from q group by label, thr, rng),
md as (select unnest([1, 10, 100]) as max_dets),
ntp as (
  select f.label, f.thr, f.rng, md.max_dets, sum(f.tp) as ntp from flags f, md
  where f.det_rank <= md.max_dets group by f.label, f.thr, f.rng, md.max_dets),
base as (select n.label, n.rng, n.npos, thr.thr, md.max_dets from npos n, thr, md where n.npos > 0),
rec as (
  select b.label, b.thr, b.rng, b.max_dets, coalesce(t.ntp, 0) / b.npos as recall
  from base b left join ntp t on b.label = t.label and b.thr = t.thr and b.rng = t.rng
                               and b.max_dets = t.max_dets)"""


def _duck_summary(digits: int) -> str:
    parts = [("map", "rng = 'all'"), ("map_50", "rng = 'all' and thr = 0.5"), ("map_75", "rng = 'all' and thr = 0.75"),
             ("map_small", "rng = 'small'"), ("map_medium", "rng = 'medium'"), ("map_large", "rng = 'large'")]
    ars = [("mar_1", "rng = 'all' and max_dets = 1"), ("mar_10", "rng = 'all' and max_dets = 10"),
           ("mar_100", "rng = 'all' and max_dets = 100"), ("mar_small", "rng = 'small' and max_dets = 100"),
           ("mar_medium", "rng = 'medium' and max_dets = 100"), ("mar_large", "rng = 'large' and max_dets = 100")]
    sel = [f"select '{n}' as metric, round(coalesce(avg(ap), -1.0), {digits}) as value from ap where {c}"
           for n, c in parts]
    sel += [f"select '{n}' as metric, round(coalesce(avg(r), -1.0), {digits}) as value "
            f"from (select label, avg(recall) as r from rec where {c} group by label)" for n, c in ars]
    return "\nunion all ".join(sel)


def _eval(spark, sf, ranges=None):
    return E.evaluate(FX.pred(spark, sf), FX.truth(spark, sf), ranges=ranges or E.AREA_RANGES)


@register("iou_pairs_50", sql=FX.duck_with("fx_truth", "fx_pred") + """,
pairs as (
  select p.image_id, p.label, p.det_id, t.gt_id,
         greatest(least(p.x2, t.x2) - greatest(p.x1, t.x1), 0.0)
         * greatest(least(p.y2, t.y2) - greatest(p.y1, t.y1), 0.0) as both_area,
         (p.x2 - p.x1) * (p.y2 - p.y1) + (t.x2 - t.x1) * (t.y2 - t.y1) as areas
  from fx_pred p join fx_truth t on p.image_id = t.image_id and p.label = t.label)
select image_id, label, det_id, gt_id, round(both_area / (areas - both_area), 9) as iou
from pairs where areas > both_area and both_area / (areas - both_area) >= 0.5
""")
def iou_pairs_50(spark, sf):
    """Same-image, same-class pairs with IoU >= 0.5, all detections."""
    p = E.iou_pairs(FX.pred(spark, sf), FX.truth(spark, sf), 0.5)
    return p.select("image_id", "label", "det_id", "gt_id", F.round("iou", 9).alias("iou"))


@register("greedy_matches", sql=duck_eval(ALL) + """
select image_id, label, thr, det_id, gt_id from m
""")
def greedy_matches(spark, sf):
    """Greedy matches at all ten thresholds (40,352 at 0.50 on sf0.01)."""
    m = E.match_greedy(FX.pred(spark, sf), FX.truth(spark, sf), E.IOU_THRESHOLDS_PCT, ALL)
    return m.select("image_id", "label", "thr", "det_id", "gt_id")


@register("average_precision_by_class", sql=duck_eval(ALL) + """
select label, thr, round(ap, 6) as ap from ap
""")
def average_precision_by_class(spark, sf):
    """101-point AP per class and threshold."""
    r = _eval(spark, sf, ALL)
    return r["ap"].select("label", "thr", F.round("ap", 6).alias("ap"))


@register("detection_summary", sql=duck_eval(E.AREA_RANGES) + "\n" + _duck_summary(6))
def detection_summary(spark, sf):
    """mAP, at 0.50 and 0.75, by size; mean recall at 1/10/100 and by size."""
    r = _eval(spark, sf)
    s = E.map_summary(r["ap"], r["recall"])
    return s.select("metric", F.round("value", 6).alias("value"))


@register("recall_by_class", sql=duck_eval(ALL) + """
select label, max_dets, round(avg(recall), 6) as recall from rec group by label, max_dets
""")
def recall_by_class(spark, sf):
    """E5: per class, mean recall over thresholds at 1/10/100 detections."""
    r = _eval(spark, sf, ALL)
    return (r["recall"].groupBy("label", "max_dets").agg(F.round(F.avg("recall"), 6).alias("recall")))


def _duck_table(digits: int) -> str:
    """Summary and per-class rows, classes of either side, -1 without truths."""
    return f"""{_duck_summary(digits)}
union all select 'map_' || coalesce(c.category_name, cast(l.label as varchar)),
                 round(coalesce(avg(a.ap), -1.0), {digits})
  from labels_any l left join ap a on a.label = l.label and a.rng = 'all'
  left join fx_classes c on l.label = c.category_id group by l.label, c.category_name
union all select 'mar_100_' || coalesce(c.category_name, cast(l.label as varchar)),
                 round(coalesce(avg(r.recall), -1.0), {digits})
  from labels_any l left join rec r on r.label = l.label and r.rng = 'all' and r.max_dets = 100
  left join fx_classes c on l.label = c.category_id group by l.label, c.category_name
"""


_DUCK_LABELS = "labels_any as (select label from fx_truth union select label from fx_pred)"


@register("detection_metrics_table", sql=duck_eval(E.AREA_RANGES) + ",\n" + FX.DUCK["fx_classes"] + ",\n" + _DUCK_LABELS
          + "\n" + _duck_table(4))
def detection_metrics_table(spark, sf):
    """The reference's metric dictionary as a long frame, rounded to 4."""
    r = _eval(spark, sf)
    return E.metrics_table(r["ap"], r["recall"], FX.classes(spark, sf), 4, r["classes"])


# From raw outputs to metrics: the detector's queries, kept at any score, against normalised centre
# boxes of the same images (every second query's box, shifted, of a class drawn from the image).
_DUCK_CHAIN = FX.duck_with("fx_det", "fx_classes") + """,
fx_pred as (
  select image_id, cast(query as bigint) as det_id, cast(list_position(p, list_max(p)) - 1 as integer) as label,
         list_max(p) as score, (bx[1] - bx[3] / 2) * width as x1, (bx[2] - bx[4] / 2) * height as y1,
         (bx[1] + bx[3] / 2) * width as x2, (bx[2] + bx[4] / 2) * height as y2
  from fx_det where list_max(p) > 0.0),
fx_truth as (
  select image_id, cast(query as bigint) as gt_id, cast(image_id % 6 as integer) as label,
         (bx[1] + 0.01 - bx[3] / 2) * width as x1, (bx[2] - bx[4] / 2) * height as y1,
         (bx[1] + 0.01 + bx[3] / 2) * width as x2, (bx[2] + bx[4] / 2) * height as y2
  from fx_det where query % 2 = 0)"""


@register("detection_chain_metrics", sql=duck_eval(E.AREA_RANGES, _DUCK_CHAIN) + ",\n" + _DUCK_LABELS + "\n" + _duck_table(6))
def detection_chain_metrics(spark, sf):
    """X11 at threshold 0, X6, E1-E6 in one chain: raw logits and normalised
    boxes to named metrics."""
    raw = FX.detector_outputs(spark, sf)
    pred = X.postprocess_detections(raw, threshold=0.0).select(
        "image_id", F.col("query").cast("bigint").alias("det_id"), "label", "score", "x1", "y1", "x2", "y2")
    boxes = raw.select("image_id", "width", "height", F.posexplode("pred_boxes").alias("query", "b")).filter("query % 2 = 0")
    truth = X.center_to_corners(boxes.select(
        "image_id", F.col("query").cast("bigint").alias("gt_id"), (F.col("image_id") % 6).cast("int").alias("label"),
        "width", "height", (F.get("b", 0) + 0.01).alias("cx"), F.get("b", 1).alias("cy"),
        F.get("b", 2).alias("bw"), F.get("b", 3).alias("bh")))
    r = E.evaluate(pred, truth)
    return E.metrics_table(r["ap"], r["recall"], FX.classes(spark, sf), 6, r["classes"])


@register("best_checkpoint_per_run", sql="""
select user_id, event_id as step, value as eval_map from (
  select user_id, event_id, value,
         row_number() over (partition by user_id order by value desc, event_id desc) as rn
  from events) where rn = 1
""")
def best_checkpoint_per_run(spark, sf):
    """Per run (``user_id``), the step (``event_id``) with the best
    metric (``value``), larger is better."""
    ev = table(spark, sf, "events").select("user_id", F.col("event_id").alias("step"),
                                           F.col("value").alias("eval_map"))
    return E.best_by(ev, "eval_map", "step", by=["user_id"]).select("user_id", "step", "eval_map")
