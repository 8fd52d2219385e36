"""Detection evaluation (E1-E7): IoU pairs, greedy matching, average
precision and recall, summary, per-class table, model selection.

Semantics follow the public COCO evaluation: IoU thresholds 0.50:0.05:0.95,
101 recall points, at most 1/10/100 detections per image and class, area
ranges small < 32^2 <= medium < 96^2 <= large (bounds inclusive), classes
without truths reported as -1 and left out of means.  Pinned tie rules:
detections in (score desc, image_id, det_id) order; a detection takes the
free truth with (not-ignored first, IoU desc, gt_id asc).  Recall points are
compared in integers (``tp * 100 >= j * npos``) rather than floats.

Plan shape, and why it holds at scale:

* the per-(image, class) cap is ``row_number() <= 100``, which Spark plans
  with a partial ``WindowGroupLimit`` before the shuffle, so a hot image
  ships at most 100 rows per map task;
* detections meet their truths in one left join by (image, class), whose
  partitioning the candidate window and the grouping reuse.  Only keys with
  more truths than ``hot_rows`` take a salted path of their own; that there
  are none follows from the counts of hashed keys, one row for each bucket;
* each detection keeps only its best 100 candidates per ignore pattern of
  the truths: at most 99 truths can be taken before it, so its best free
  truth is always among them, for every threshold and range (exact);
* where no detection of an (image, class) has two candidates and no truth is
  the candidate of two, nothing competes: a detection takes its truth at every
  threshold up to their IoU.  Only the other groups are folded (``aggregate``
  per threshold and range inside one row, at most 100 detections and their
  capped candidates);
* a detection leaves with one row: two bit sets over thresholds and ranges
  (true positive; taken by an ignored truth).  One range cut in (class, score)
  order holds these rows; a first pass over it counts per (partition, class),
  a second one, which starts from the counts of the partitions before, keeps
  the best precision of each recall point.  No table holds a detection per
  threshold;
* the 101-point envelope works on at most 101 buckets per class and threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import checkpoint_dir
from .index import ranged_checkpoint

# Fixed values of the public COCO evaluation protocol.
IOU_THRESHOLDS_PCT = [50, 55, 60, 65, 70, 75, 80, 85, 90, 95]
RECALL_POINTS = 101
MAX_DETS = [1, 10, 100]
AREA_RANGES = {"all": (0.0, 1e10), "small": (0.0, 32.0 ** 2),
               "medium": (32.0 ** 2, 96.0 ** 2), "large": (96.0 ** 2, 1e10)}


def iou(a: str = "p_", b: str = "t_") -> Column:
    """IoU of two two-corner boxes given by column prefixes."""
    c = F.col
    iw = F.greatest(F.least(c(f"{a}x2"), c(f"{b}x2")) - F.greatest(c(f"{a}x1"), c(f"{b}x1")), F.lit(0.0))
    ih = F.greatest(F.least(c(f"{a}y2"), c(f"{b}y2")) - F.greatest(c(f"{a}y1"), c(f"{b}y1")), F.lit(0.0))
    inter = iw * ih
    area_a = (c(f"{a}x2") - c(f"{a}x1")) * (c(f"{a}y2") - c(f"{a}y1"))
    area_b = (c(f"{b}x2") - c(f"{b}x1")) * (c(f"{b}y2") - c(f"{b}y1"))
    union = area_a + area_b - inter
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def cap_detections(pred: DataFrame, max_dets: int = 100) -> DataFrame:
    """Rank detections per (image, class) by (score desc, det_id) and keep
    the first ``max_dets`` (adds ``det_rank``, 1-based)."""
    w = Window.partitionBy("image_id", "label").orderBy(F.desc("score"), F.asc("det_id"))
    return pred.withColumn("det_rank", F.row_number().over(w)).filter(F.col("det_rank") <= max_dets)


def iou_pairs(pred: DataFrame, truth: DataFrame, min_iou: float = 0.5, max_dets: int | None = None,
              hot_rows: int | None = None) -> DataFrame:
    """Detections and truths of the same image and class with IoU at or
    above ``min_iou``.  All detections, unless the protocol's ``max_dets``
    per image and class is asked for."""
    p = (pred if max_dets is None else cap_detections(pred, max_dets)).select(
        "image_id", "label", "det_id", "score", *[F.col(k).alias(f"p_{k}") for k in ("x1", "y1", "x2", "y2")])
    t = truth.select("image_id", "label", "gt_id",
                     *[F.col(k).alias(f"t_{k}") for k in ("x1", "y1", "x2", "y2")])
    pairs = keyed_join(p, t, ["image_id", "label"], "gt_id", hot_rows or HOT_ROWS).withColumn("iou", iou())
    pairs = pairs.filter(F.col("iou") >= F.lit(float(min_iou)))
    return pairs.select("image_id", "label", "det_id", "gt_id", "iou",
                        "p_x1", "p_y1", "p_x2", "p_y2", "t_x1", "t_y1", "t_x2", "t_y2")


def _thresholds(pcts: Sequence[int]) -> Column:
    return F.array(*[F.lit(float(p)) / F.lit(100.0) for p in pcts])


def _range_table(ranges: dict[str, tuple[float, float]]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("rng"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
                     for n, (lo, hi) in ranges.items()])


def _outside(area: Column, lo: Column, hi: Column) -> Column:
    return (area < lo) | (area > hi)


def _mask(area: Column, ranges: dict[str, tuple[float, float]]) -> Column:
    """Bit r set when the area lies outside range r (ignored there)."""
    m = F.lit(0)
    for r, (lo, hi) in enumerate(ranges.values()):
        m = m + F.when(_outside(area, F.lit(lo), F.lit(hi)), F.lit(1 << r)).otherwise(F.lit(0))
    return m


def _bit(mask: Column, bit: Column) -> Column:
    """1 when ``mask`` has the bit ``bit`` (a power of two) set, else 0."""
    return F.when(mask.bitwiseAND(bit) != 0, F.lit(1)).otherwise(F.lit(0))


_MATCH_TYPE = "array<struct<det_id:bigint,gt_id:bigint,gt_ignored:int>>"


# An (image, class) with more truths than this is split into buckets.
HOT_ROWS = 1_000_000


def _hot_keys(big: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    counts = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > hot_rows).select(
        *keys, F.ceil(F.col("_n") / F.lit(float(hot_rows))).cast("int").alias("_buckets"))


def salted_join(small: DataFrame, big: DataFrame, keys: Sequence[str], spread_col: str,
                hot_rows: int = HOT_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """Equi-join on the keys with more than ``hot_rows`` rows on the big side
    (found by a partial-aggregated count): their big-side rows are spread over
    ``ceil(count / hot_rows)`` buckets (hash of ``spread_col``) and the small
    side's rows are repeated once per bucket.  The list of such keys is joined
    without a hint; the planner decides by its size."""
    hot = _hot_keys(big, keys, hot_rows) if hot is None else hot
    b = big.join(hot, list(keys)).withColumn(
        "_salt", F.pmod(F.xxhash64(F.col(spread_col)), F.col("_buckets")).cast("int")).drop("_buckets")
    s = small.join(hot, list(keys)).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.col("_buckets") - 1))).drop("_buckets")
    return s.join(b, [*keys, "_salt"]).drop("_salt")


def keyed_join(small: DataFrame, big: DataFrame, keys: Sequence[str], spread_col: str,
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """Equi-join where a key of ``big`` may hold a large share of all rows:
    ordinary keys join as usual and keep their partitioning, hot ones take
    ``salted_join``.  A scalar job finds whether there are any."""
    hot = _hot_keys(big, keys, hot_rows)
    if hot.limit(1).count() == 0:
        return small.join(big, list(keys))
    ordinary = small.join(hot, list(keys), "left_anti").join(big, list(keys))
    return ordinary.unionByName(salted_join(small, big, keys, spread_col, hot_rows))


def _folded(thresholds_pct: Sequence[int], ranges: dict[str, tuple[float, float]]) -> Column:
    """The greedy matching of the pairs ``ps`` (``max_iou`` the largest) for
    every threshold and range, as ``match_by_image`` returns it in ``by``."""
    combos = F.array(*[F.struct(F.lit(float(pct)) / F.lit(100.0), F.lit(1 << r), F.lit(name))
                       .cast("struct<thr:double,bit:int,rng:string>")
                       for pct in thresholds_pct for r, name in enumerate(ranges)])
    init = F.struct(F.array().cast("array<bigint>").alias("taken"),
                    F.array().cast("array<bigint>").alias("dets"),
                    F.array().cast("array<bigint>").alias("ign"),
                    F.array().cast(_MATCH_TYPE).alias("m"))

    def step(acc, q):
        free = ~F.array_contains(acc["dets"], q["e"]) & ~F.array_contains(acc["taken"], q["d"])
        return F.when(free, F.struct(
            F.array_append(acc["taken"], q["d"]).alias("taken"),
            F.array_append(acc["dets"], q["e"]).alias("dets"),
            F.when(q["b"] == 1, F.array_append(acc["ign"], q["e"])).otherwise(acc["ign"]).alias("ign"),
            F.array_append(acc["m"], F.struct(q["e"].alias("det_id"), q["d"].alias("gt_id"),
                                              q["b"].alias("gt_ignored"))).alias("m"))).otherwise(acc)

    def fold(c):
        items = F.array_sort(F.transform(F.filter("ps", lambda q: q["iou"] >= c["thr"]), lambda q: F.struct(
            q["det_rank"].alias("a"), _bit(q["g_mask"], c["bit"]).alias("b"), (-q["iou"]).alias("c"),
            q["gt_id"].alias("d"), q["det_id"].alias("e"))))
        # no candidate at this threshold: nothing to fold
        res = F.when(F.col("max_iou") < c["thr"], init).otherwise(F.aggregate(items, init, step))
        return F.struct(c["thr"].alias("thr"), c["bit"].alias("bit"), c["rng"].alias("rng"), res.alias("res"))
    return F.transform(combos, fold)


def match_by_image(pred: DataFrame, truth: DataFrame, thresholds_pct: Sequence[int] = IOU_THRESHOLDS_PCT,
                   ranges: dict[str, tuple[float, float]] | None = None, max_dets: int = 100,
                   capped: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """E2 core: greedy matching for every (threshold, area range) inside one
    row per (image, class) that has pairs.

    Detections in rank order; each takes its best free truth at or above
    the threshold, truths outside the area range last, then IoU desc, then
    ``gt_id``.  Each detection keeps its first ``max_dets`` candidates per
    ignore pattern of the truths (``g_mask``: which ranges ignore them): at
    most ``max_dets - 1`` truths are taken before it, so its choice is always
    among them, for every threshold and range (exact).

    Plan: detections and truths are shuffled by (image, class); the candidate
    window, the grouping of pairs and their join with the grouped detections
    reuse that partitioning.

    Returns one row per (image, class): ``ds`` (the detections in rank order)
    and ``by``: for every threshold and range (thr, bit, rng) the matches
    ``m`` (det_id, gt_id, gt_ignored) in detection order, the matched
    detection ids ``dets`` and those matched to an ignored truth ``ign``."""
    ranges = ranges or {"all": AREA_RANGES["all"]}
    d = pred if capped else cap_detections(pred, max_dets)
    d_area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    d = d.select("image_id", "label", "det_id", "det_rank", "x1", "y1", "x2", "y2",
                 _mask(d_area, ranges).alias("d_mask"))
    t_area = d_area
    t = truth.select("image_id", "label", "gt_id", *[F.col(k).alias(f"t_{k}") for k in ("x1", "y1", "x2", "y2")],
                     _mask(t_area, ranges).alias("g_mask"))
    pairs = (keyed_join(d, t, ["image_id", "label"], "gt_id", hot_rows).withColumn("iou", iou("", "t_"))
             .filter(F.col("iou") >= F.lit(min(thresholds_pct) / 100.0)))
    wc = Window.partitionBy("image_id", "label", "det_id", "g_mask").orderBy(F.desc("iou"), F.asc("gt_id"))
    pairs = pairs.withColumn("_c", F.row_number().over(wc)).filter(F.col("_c") <= max_dets)
    ps = pairs.groupBy("image_id", "label").agg(
        F.collect_list(F.struct("det_rank", "det_id", "gt_id", "iou", "g_mask")).alias("ps"),
        F.max("iou").alias("max_iou"))
    ds = d.groupBy("image_id", "label").agg(
        F.array_sort(F.collect_list(F.struct("det_rank", "det_id", "d_mask"))).alias("ds"))
    g = ps.join(ds, ["image_id", "label"])
    return g.select("image_id", "label", "ds", _folded(thresholds_pct, ranges).alias("by"))


def matches_of(grouped: DataFrame) -> DataFrame:
    """One row per match ``(image_id, label, thr, rng, det_id, gt_id, gt_ignored)``."""
    flat = F.flatten(F.transform("by", lambda c: F.transform(c["res"]["m"], lambda m: F.struct(
        c["thr"].alias("thr"), c["rng"].alias("rng"), m["det_id"].alias("det_id"), m["gt_id"].alias("gt_id"),
        m["gt_ignored"].alias("gt_ignored")))))
    return grouped.select("image_id", "label", F.explode(flat).alias("mm")).select("image_id", "label", "mm.*")


# Bits of a word that holds (threshold, range) sets; buckets per class that keys are counted in.
_WORD_BITS = 60
_KEY_BUCKETS = 1024


def _paired(d: DataFrame, t: DataFrame, hot: DataFrame | None, min_iou: float) -> DataFrame:
    """Every detection of ``d`` beside each truth of ``t`` at or above
    ``min_iou``, or beside none.  Detections of hot keys have a row without a
    truth in any case, and ``_hot`` set."""
    keys = ["image_id", "label"]
    td = t.withColumnsRenamed({"image_id": "_ti", "label": "_tl"})
    near = iou("", "t_")

    def plain(rows: DataFrame) -> DataFrame:
        j = rows.join(td, (rows["image_id"] == td["_ti"]) & (rows["label"] == td["_tl"]) & (near >= F.lit(min_iou)), "left")
        return j.select(*d.columns, "gt_id", "g_mask", F.when(F.col("gt_id").isNotNull(), near).alias("iou"),
                        F.lit(False).alias("_hot"))

    if hot is None:
        return plain(d)
    pairs = salted_join(d, t, keys, "gt_id", hot_rows=HOT_ROWS, hot=hot).withColumn("iou", near).filter(F.col("iou") >= F.lit(min_iou))
    alone = d.join(hot.select(*keys), keys).select(
        *d.columns, F.lit(None).cast(t.schema["gt_id"].dataType).alias("gt_id"), F.lit(None).cast("int").alias("g_mask"),
        F.lit(None).cast("double").alias("iou"))
    return plain(d.join(hot, keys, "left_anti").select(*d.columns)).unionByName(
        pairs.select(*d.columns, "gt_id", "g_mask", "iou").unionByName(alone).withColumn("_hot", F.lit(True)))


def _words(n_thr: int, n_rng: int) -> list[range]:
    """The ranges whose threshold sets share a word."""
    if n_thr > _WORD_BITS:
        raise ValueError(f"at most {_WORD_BITS} thresholds in one evaluation")
    per = _WORD_BITS // n_thr
    return [range(a, min(a + per, n_rng)) for a in range(0, n_rng, per)]


def flags_of(capped: DataFrame, truth: DataFrame, thresholds_pct: Sequence[int], ranges: dict[str, tuple[float, float]],
             max_dets: int, hot: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """One row per capped detection with ``d_mask`` (ranges it lies outside of)
    and, per word of (threshold, range) bits, ``tp{w}`` (true positive) and
    ``counted{w}`` (that, or inside the range and not taken by an ignored
    truth); and the matches as ``matches_of`` has them.  ``hot``: the (image, class) keys with too many truths for one
    task, with their number of buckets."""
    keys, words, n_thr = ["image_id", "label"], _words(len(thresholds_pct), len(ranges)), len(thresholds_pct)
    corners = ("x1", "y1", "x2", "y2")
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    d = capped.select(*keys, "det_id", "det_rank", "score", *corners, _mask(area, ranges).alias("d_mask"))
    t = truth.select(*keys, "gt_id", *[F.col(k).alias(f"t_{k}") for k in corners], _mask(area, ranges).alias("g_mask"))
    rows = _paired(d, t, hot, min(thresholds_pct) / 100.0).drop(*corners)
    best = Window.partitionBy(*keys, "det_rank", "g_mask").orderBy(F.desc("iou"), F.asc("gt_id"))
    rows = rows.withColumn("_c", F.row_number().over(best)).filter(F.col("_c") <= max_dets).drop("_c")
    group = Window.partitionBy(*keys)
    pairs = F.count("iou").over(group)
    free = ~F.col("_hot") & ((F.col("_n") <= 1) | ((F.col("_n") == F.size("_ds")) & (F.col("_n") == F.size("_gs"))))
    rows = (rows.withColumn("_n", pairs).withColumn("_ds", F.collect_set(F.when(F.col("iou").isNotNull(), F.col("det_id"))).over(group))
            .withColumn("_gs", F.collect_set(F.when(F.col("iou").isNotNull(), F.col("gt_id"))).over(group))
            .withColumn("_free", free).drop("_n", "_ds", "_gs", "_hot"))
    mine = [*keys, "det_id", "det_rank", "score", "d_mask"]

    # nothing competes: matched at each threshold up to the IoU
    alone = rows.filter("_free").drop("_free")
    at = F.lit(0).cast("bigint")
    for b, pct in enumerate(thresholds_pct):
        at = at + F.when(F.col("iou") >= F.lit(float(pct)) / F.lit(100.0), F.lit(1 << b).cast("bigint")).otherwise(F.lit(0))

    def word(w, ignored):
        total = F.lit(0).cast("bigint")
        for r in words[w]:
            hit = F.col("g_mask").bitwiseAND(F.lit(1 << r))
            total = total + F.when((hit != 0) if ignored else (hit == 0), F.shiftleft(F.col("_at"), (r - words[w][0]) * n_thr)).otherwise(F.lit(0))
        return total

    names = [(f"{kind}{w}", w, kind == "ig") for w in range(len(words)) for kind in ("tp", "ig")]
    plain = alone.withColumn("_at", at).select(*mine, *[word(w, ignored).alias(n) for n, w, ignored in names])

    # the others: folded inside one row per (image, class)
    pair = F.struct("det_rank", "det_id", "gt_id", "iou", "g_mask")
    grouped = rows.filter("not _free").groupBy(*keys).agg(
        F.collect_list(F.when(F.col("iou").isNotNull(), pair)).alias("ps"), F.max("iou").alias("max_iou"),
        F.collect_set(F.struct("det_rank", "det_id", "score", "d_mask")).alias("ds"))
    folded = grouped.select(*keys, "ds", _folded(thresholds_pct, ranges).alias("by"))
    place = {(i, r): (w, (r - ws[0]) * n_thr + i) for w, ws in enumerate(words) for r in ws for i in range(n_thr)}
    order = [place[i, r] for i in range(n_thr) for r in range(len(ranges))]  # of the entries of "by"
    spots = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(1 << b).cast("bigint").alias("v")) for w, b in order])
    spread = folded.select(*keys, F.explode("ds").alias("dd"), F.arrays_zip(F.col("by").alias("c"), spots.alias("s")).alias("z"))

    def from_fold(w, ignored):
        def add(acc, z):
            res = z["c"]["res"]
            ign = F.array_contains(res["ign"], F.col("dd.det_id"))
            hit = ign if ignored else F.array_contains(res["dets"], F.col("dd.det_id")) & ~ign
            return acc + F.when((z["s"]["w"] == w) & hit, z["s"]["v"]).otherwise(F.lit(0).cast("bigint"))
        return F.aggregate("z", F.lit(0).cast("bigint"), add)

    fought = spread.select(*keys, "dd.det_id", "dd.det_rank", "dd.score", "dd.d_mask",
                           *[from_fold(w, ignored).alias(n) for n, w, ignored in names])
    combos = F.array(*[F.struct((F.lit(float(pct)) / F.lit(100.0)).alias("thr"), F.lit(name).alias("rng"), F.lit(1 << r).alias("bit"))
                       for pct in thresholds_pct for r, name in enumerate(ranges)])
    sure = alone.filter("iou is not null").withColumn("c", F.explode(combos)).filter("iou >= c.thr").select(
        *keys, "c.thr", "c.rng", "det_id", "gt_id", _bit(F.col("g_mask"), F.col("c.bit")).alias("gt_ignored"))
    rows, kept = plain.unionByName(fought), [*mine]
    for w, ws in enumerate(words):
        inside = F.lit(0).cast("bigint")
        for r in ws:
            inside = inside + F.when(F.col("d_mask").bitwiseAND(F.lit(1 << r)) == 0,
                                     F.lit(((1 << n_thr) - 1) << ((r - ws[0]) * n_thr)).cast("bigint")).otherwise(F.lit(0))
        rows = rows.withColumn(f"counted{w}", F.col(f"tp{w}").bitwiseOR(inside.bitwiseAND(F.bitwise_not(f"ig{w}"))))
        kept += [f"tp{w}", f"counted{w}"]
    return rows.select(*kept), sure.unionByName(matches_of(folded))


def _slices(batch) -> list[tuple[int, int]]:
    """The runs of equal labels."""
    import numpy as np
    codes = batch.column("label").dictionary_encode(null_encoding="encode").indices.to_numpy()
    edges = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
    return [(a, b) for a, b in zip(edges, edges[1:]) if a < b]


def _flag_columns(batch, words: list[range], n_thr: int):
    """``(c, tp, counted)`` for c = range * thresholds + threshold: the rows
    that are true positives, and those that count."""
    for w, ws in enumerate(words):
        tp, counted = (batch.column(f"{k}{w}").to_numpy() for k in ("tp", "counted"))
        for b in range(len(ws) * n_thr):
            yield ws[0] * n_thr + b, (tp & (1 << b)) != 0, (counted & (1 << b)) != 0


def _count_pass(words: list[range], n_thr: int, n_rng: int, max_dets: Sequence[int], schema):
    """Per (partition, label): true positives, counted detections, and true
    positives among the first detections of an image; ``nth`` numbers the
    partition's labels from 0, in row order."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        found = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            slices, runs = _slices(batch), []
            pid = int(batch.column("_mid")[0].as_py()) >> 33
            for a, _ in slices:
                label = batch.column("label")[a].as_py()
                runs.append(found.setdefault(label, [pid, len(found), np.zeros((2 + len(max_dets), n_thr * n_rng), dtype="int64")])[2])
            early = [batch.column("det_rank").to_numpy() <= m for m in max_dets]
            for c, tp, counted in _flag_columns(batch, words, n_thr):
                each = [tp, counted, *[tp & e for e in early]]
                for (a, b), sums in zip(slices, runs):
                    sums[:, c] += [np.count_nonzero(x[a:b]) for x in each]
        rows = [{"_pid": pid, "label": label, "nth": nth, "tp": s[0].tolist(), "counted": s[1].tolist(), "hits": s[2:].ravel().tolist()}
                for label, (pid, nth, s) in found.items()]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def _best_pass(words: list[range], n_thr: int, n_rng: int, schema):
    """Per (partition, label, range and threshold, recall point): the best
    precision of the true positives that reach it.  The first row's ``note``
    has the counts of the partitions before and, label by label, the truths."""
    def run(batches):
        import json

        import numpy as np
        import pyarrow as pa
        size, now, npos = n_thr * n_rng, None, None  # now: label, best, true positives and counted detections so far

        def out(label, best, *_):
            c, j = np.nonzero(best)
            rows = [{"label": label, "c": int(x), "j": int(y), "prec": float(best[x, y])} for x, y in zip(c, j)]
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            runs, ended, start = [], [], [np.zeros(size, dtype="int64")] * 2
            if npos is None:
                note = json.loads(batch.column("note")[0].as_py())
                npos, start = iter(note["npos"]), [np.array(note[k], dtype="int64") for k in ("tp", "counted")]
            for a, b in _slices(batch):
                label = batch.column("label")[a].as_py()
                if now is None or now[0] != label:
                    ended += [] if now is None else [now]
                    # only a partition's first label can go on from the partitions before
                    now = (label, np.zeros((size, RECALL_POINTS)), *[x.copy() if now is None else np.zeros_like(x) for x in start], next(npos))
                runs.append((a, b, now))
            for c, tp, counted in _flag_columns(batch, words, n_thr):
                for a, b, (_, best, before, seen, truths) in runs:
                    at, n = np.flatnonzero(tp[a:b]), truths[c // n_thr]
                    if n and len(at):
                        i = np.arange(before[c] + 1, before[c] + 1 + len(at))
                        k = np.cumsum(counted[a:b], dtype="int64")[at] + seen[c]
                        j = np.minimum(i * 100 // n, RECALL_POINTS - 1)  # never falls along the rows
                        starts = np.concatenate(([0], np.flatnonzero(np.diff(j)) + 1))
                        best[c, j[starts]] = np.maximum(best[c, j[starts]], np.maximum.reduceat(i / k, starts))
                    before[c] += len(at)
                    seen[c] += np.count_nonzero(counted[a:b])
            yield from (out(*x) for x in ended)
        if now is not None:
            yield out(*now)
    return run


def match_greedy(pred: DataFrame, truth: DataFrame, thresholds_pct: Sequence[int] = IOU_THRESHOLDS_PCT,
                 ranges: dict[str, tuple[float, float]] | None = None, max_dets: int = 100,
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """Greedy matches per (image, class, threshold, area range).
    ``max_dets`` is the protocol's setting: the best 100 detections of an
    image and class take part."""
    return matches_of(match_by_image(pred, truth, thresholds_pct, ranges, max_dets, hot_rows=hot_rows))


def truth_counts(truth: DataFrame, ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Number of not-ignored truths per (class, range)."""
    ranges = ranges or {"all": AREA_RANGES["all"]}
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    t = truth.select("label", area.alias("_a")).withColumn("_r", F.explode(_range_table(ranges)))
    return (t.filter(~_outside(F.col("_a"), F.col("_r.lo"), F.col("_r.hi")))
            .groupBy("label", F.col("_r.rng").alias("rng")).agg(F.count(F.lit(1)).alias("npos")))


def _truth_facts(truth: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Truths and not-ignored truths (``n{r}``) per class and bucket of the
    hashed (image, class), in one pass."""
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    inside = [F.sum(F.when(_outside(area, F.lit(lo), F.lit(hi)), 0).when(area.isNull(), 0).otherwise(1)).alias(f"n{r}")
              for r, (lo, hi) in enumerate(ranges.values())]
    return truth.groupBy("label", F.pmod(F.xxhash64("image_id", "label"), F.lit(_KEY_BUCKETS)).alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"), *inside)


def _hot_truths(truth: DataFrame, facts: DataFrame, hot_rows: int) -> DataFrame | None:
    """The (image, class) keys with more than ``hot_rows`` truths; None if no
    bucket holds so many, or none of its keys does."""
    full = facts.filter(F.col("_n") > hot_rows).select("label", "_b")
    if full.limit(1).count() == 0:
        return None
    some = truth.withColumn("_b", F.pmod(F.xxhash64("image_id", "label"), F.lit(_KEY_BUCKETS))).join(full, ["label", "_b"])
    hot = _hot_keys(some, ["image_id", "label"], hot_rows).filter("image_id is not null").checkpoint()
    return None if hot.limit(1).count() == 0 else hot


def _ap_from_buckets(buckets: DataFrame, npos: DataFrame, thresholds_pct: Sequence[int]) -> DataFrame:
    """101-point AP from the best precision ``prec`` of each recall point ``j``."""
    grid = (npos.filter(F.col("npos") > 0)
            .withColumn("thr", F.explode(_thresholds(thresholds_pct)))
            .withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(RECALL_POINTS - 1)))))
    g = grid.join(buckets, ["label", "thr", "rng", "j"], "left")
    w = Window.partitionBy("label", "thr", "rng").orderBy(F.desc("j")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    g = g.withColumn("q", F.coalesce(F.max("prec").over(w), F.lit(0.0)))
    return g.groupBy("label", "thr", "rng").agg((F.sum("q") / F.lit(float(RECALL_POINTS))).alias("ap"))


def _score_order() -> list[Column]:
    return [F.desc("score"), F.asc("image_id"), F.asc("det_id")]


def evaluate(pred: DataFrame, truth: DataFrame, thresholds_pct: Sequence[int] = IOU_THRESHOLDS_PCT,
             ranges: dict[str, tuple[float, float]] | None = None, max_dets: Sequence[int] = MAX_DETS,
             num_partitions: int | None = None, hot_rows: int = HOT_ROWS) -> dict[str, DataFrame]:
    """E1-E5 under the protocol's largest ``max_dets``.  Returns frames:
    ``matches``, ``flags`` (see ``flags_of``), ``npos``, ``ap`` (class, thr,
    rng, ap), ``recall`` (class, thr, rng, max_dets, recall) and ``classes``
    (every label of either side)."""
    ranges = ranges or AREA_RANGES
    top = max(max_dets)
    checkpoint_dir(pred.sparkSession)
    n_thr, n_rng = len(thresholds_pct), len(ranges)
    words, size, label_type = _words(n_thr, n_rng), n_thr * n_rng, pred.schema["label"].dataType
    facts = _truth_facts(truth, ranges).checkpoint()
    per_label = facts.groupBy("label").agg(*[F.sum(f"n{r}").alias(f"n{r}") for r in range(n_rng)])
    npos = per_label.select("label", F.explode(F.array(*[F.struct(F.lit(name).alias("rng"), F.col(f"n{r}").alias("npos"))
                                                         for r, name in enumerate(ranges)])).alias("e"))
    npos = npos.select("label", "e.*").filter("npos > 0").checkpoint()
    capped = cap_detections(pred, top).select("image_id", "label", "det_id", "det_rank", "score", "x1", "y1", "x2", "y2")
    flags, matches = flags_of(capped, truth, thresholds_pct, ranges, top, _hot_truths(truth, facts, hot_rows))
    ranged = ranged_checkpoint(flags, ["label", *_score_order()], num_partitions, materialize=True)
    bits = [f"{k}{w}" for w in range(len(words)) for k in ("tp", "counted")]
    totals_type = T.StructType([T.StructField("_pid", T.LongType()), T.StructField("label", label_type), T.StructField("nth", T.IntegerType())]
                               + [T.StructField(c, T.ArrayType(T.LongType())) for c in ("tp", "counted", "hits")])
    totals = ranged.select("_mid", "label", "det_rank", *bits).mapInArrow(
        _count_pass(words, n_thr, n_rng, max_dets, to_arrow_schema(totals_type)), totals_type).checkpoint()
    # what the partitions before count of a partition's first label, and the truths of each of its labels, for its
    # first row alone: few columns and no arrays go to the workers with every row
    each = totals.select("_pid", "label", "nth", F.posexplode(F.arrays_zip("tp", "counted")).alias("c", "e"))
    earlier = Window.partitionBy("label", "c").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    each = each.select("_pid", "nth", "c", *[F.coalesce(F.sum(f"e.{k}").over(earlier), F.lit(0)).alias(k) for k in ("tp", "counted")])
    carry = each.filter("nth = 0").groupBy("_pid").agg(F.array_sort(F.collect_list(F.struct("c", "tp", "counted"))).alias("_s"))
    truths = F.array(*[F.coalesce(f"n{r}", F.lit(0)) for r in range(n_rng)]).alias("npos")
    known = totals.select("_pid", "label", "nth").join(per_label, "label", "left").groupBy("_pid").agg(
        F.array_sort(F.collect_list(F.struct("nth", truths))).alias("_n"))
    notes = carry.join(known, "_pid").select(F.shiftleft("_pid", 33).alias("_mid"), F.to_json(F.struct(
        F.col("_s.tp").alias("tp"), F.col("_s.counted").alias("counted"), F.col("_n.npos").alias("npos"))).alias("note"))
    best_type = T.StructType([T.StructField("label", label_type), T.StructField("c", T.IntegerType()), T.StructField("j", T.IntegerType()),
                              T.StructField("prec", T.DoubleType())])
    # one row per partition: the rows stay where and as the range cut put them
    rows = ranged.select("_mid", "label", *bits).join(F.broadcast(notes), "_mid", "left").select("label", *bits, "note")
    best = rows.mapInArrow(_best_pass(words, n_thr, n_rng, to_arrow_schema(best_type)), best_type).checkpoint()
    thr = F.get(_thresholds(thresholds_pct), F.col("c") % n_thr).alias("thr")
    rng = F.get(F.array(*[F.lit(n) for n in ranges]), F.expr(f"c div {n_thr}").cast("int")).alias("rng")
    buckets = best.groupBy("label", thr, rng, "j").agg(F.max("prec").alias("prec"))
    ap = _ap_from_buckets(buckets, npos, thresholds_pct)
    # recall per max_dets: true positives among the first m detections per image and class
    ntp = totals.select("label", F.posexplode("hits").alias("h", "n")).groupBy(
        "label", (F.col("h") % size).alias("c"), F.expr(f"h div {size}").alias("m")).agg(F.sum("n").alias("n"))
    ntp = ntp.groupBy("label", thr, rng).agg(*[F.sum(F.when(F.col("m") == i, F.col("n"))).alias(f"_m{m}") for i, m in enumerate(max_dets)])
    grid = (npos.withColumn("thr", F.explode(_thresholds(thresholds_pct))).join(ntp, ["label", "thr", "rng"], "left"))
    each = F.array(*[F.struct(F.lit(m).alias("max_dets"), F.coalesce(F.col(f"_m{m}"), F.lit(0)).alias("n")) for m in max_dets])
    recall = grid.select("label", "thr", "rng", "npos", F.explode(each).alias("e")).select(
        "label", "thr", "rng", F.col("e.max_dets").alias("max_dets"), (F.col("e.n") / F.col("npos")).alias("recall"))
    classes = totals.select("label").union(per_label.select("label")).distinct()
    return {"matches": matches, "flags": ranged.drop("_mid"), "npos": npos, "ap": ap, "recall": recall, "classes": classes}


_AP_METRICS = [
    ("map", "rng = 'all'"), ("map_50", "rng = 'all' AND thr = 0.5"), ("map_75", "rng = 'all' AND thr = 0.75"),
    ("map_small", "rng = 'small'"), ("map_medium", "rng = 'medium'"), ("map_large", "rng = 'large'"),
]
_AR_METRICS = [
    ("mar_1", "rng = 'all' AND max_dets = 1"), ("mar_10", "rng = 'all' AND max_dets = 10"),
    ("mar_100", "rng = 'all' AND max_dets = 100"), ("mar_small", "rng = 'small' AND max_dets = 100"),
    ("mar_medium", "rng = 'medium' AND max_dets = 100"), ("mar_large", "rng = 'large' AND max_dets = 100"),
]


def _stack(df: DataFrame, names: Sequence[str]) -> DataFrame:
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return df.selectExpr(f"stack({len(names)}, {pairs}) as (metric, value)")


def map_summary(ap: DataFrame, recall: DataFrame) -> DataFrame:
    """The summary metrics as a long frame ``(metric, value)``:
    map, map_50, map_75, map_small/medium/large, mar_1/10/100,
    mar_small/medium/large.  A metric with no class holding truths is -1.
    Each side is one aggregation with conditional means, then unpivoted."""
    a = ap.agg(*[F.avg(F.when(F.expr(c), F.col("ap"))).alias(n) for n, c in _AP_METRICS])
    per = recall.groupBy("label").agg(*[F.avg(F.when(F.expr(c), F.col("recall"))).alias(n)
                                        for n, c in _AR_METRICS])
    r = per.agg(*[F.avg(n).alias(n) for n, _ in _AR_METRICS])
    out = _stack(a, [n for n, _ in _AP_METRICS]).unionByName(_stack(r, [n for n, _ in _AR_METRICS]))
    return out.select("metric", F.coalesce(F.col("value"), F.lit(-1.0)).alias("value"))


def metrics_table(ap: DataFrame, recall: DataFrame, classes: DataFrame | None = None,
                  digits: int = 4, labels: DataFrame | None = None) -> DataFrame:
    """Summary plus ``map_{class}`` and ``mar_100_{class}`` per class
    (name from the class list when given), rounded like the reference.
    ``labels`` lists the classes of either side; one without truths is -1."""
    c = F.col
    per_ap = ap.filter(c("rng") == "all").groupBy("label").agg(F.avg("ap").alias("v"))
    per_ar = (recall.filter((c("rng") == "all") & (c("max_dets") == 100))
              .groupBy("label").agg(F.avg("recall").alias("v")))
    if labels is not None:
        per_ap, per_ar = (labels.join(x, "label", "left").select("label", F.coalesce("v", F.lit(-1.0)).alias("v"))
                          for x in (per_ap, per_ar))
    if classes is not None:
        cl = classes.select(c("category_id").alias("label"), c("category_name").alias("_n"))
        per_ap = per_ap.join(cl, "label", "left")
        per_ar = per_ar.join(cl, "label", "left")
        name = F.coalesce(c("_n"), c("label").cast("string"))
    else:
        name = c("label").cast("string")
    rows = (map_summary(ap, recall)
            .unionByName(per_ap.select(F.concat(F.lit("map_"), name).alias("metric"), c("v").alias("value")))
            .unionByName(per_ar.select(F.concat(F.lit("mar_100_"), name).alias("metric"), c("v").alias("value"))))
    return rows.select("metric", F.round("value", digits).alias("value"))


def best_by(df: DataFrame, metric: str, id_col: str = "step", by: Sequence[str] = ()) -> DataFrame:
    """The id with the largest metric (ties: larger id), per group."""
    pick = [F.max_by(F.col(id_col), F.struct(F.col(metric), F.col(id_col))).alias(id_col),
            F.max(metric).alias(metric)]
    return df.groupBy(*by).agg(*pick) if by else df.agg(*pick)
