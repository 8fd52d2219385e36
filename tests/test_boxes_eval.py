"""Box transforms and detection evaluation: properties and a brute-force
check of greedy matching and AP on a small fixture."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.operators import boxes as X
from shardloom.operators import deteval as E

BOX_SCHEMA = "image_id long, bbox_id long, x double, y double, w double, h double, width int, height int"


def test_flip_twice_is_identity(spark):
    df = spark.createDataFrame([(1, 1, 10.0, 5.0, 30.0, 20.0, 100, 80)], BOX_SCHEMA)
    once = X.flip_boxes(df).first()
    twice = X.flip_boxes(X.flip_boxes(df)).first()
    assert once["x"] == 60.0 and twice["x"] == 10.0


def test_resize_there_and_back(spark):
    df = spark.createDataFrame([(1, 1, 10.0, 5.0, 30.0, 20.0, 100, 80)], BOX_SCHEMA)
    r = X.resize_boxes(X.resize_boxes(df, 480, 480).withColumn("width", F.lit(480)), 100, 80)
    r = X.resize_boxes(df, 480, 480)
    back = r.select("image_id", "bbox_id", (F.col("x") * 100 / 480).alias("x"), (F.col("w") * 100 / 480).alias("w"))
    b = back.first()
    assert b["x"] == pytest.approx(10.0) and b["w"] == pytest.approx(30.0)


def test_clip_area_boundary(spark):
    df = spark.createDataFrame([(1, 1, -2.0, 0.0, 7.0, 5.0, 100, 80),    # clipped to 5x5 = 25: kept
                                (1, 2, 98.0, 0.0, 10.0, 10.0, 100, 80),  # clipped to 2x10 = 20: dropped
                                (1, 3, 0.0, 0.0, 100.0, 80.0, 100, 80)], BOX_SCHEMA)
    got = {r["bbox_id"]: r["area"] for r in X.clip_boxes(df, 25).collect()}
    assert got == {1: 25.0, 3: 8000.0}


def test_runaway_drops_whole_image(spark):
    boxes = spark.createDataFrame([(1, 1, 0.0, 0.0, 10.0, 10.0, 100, 80), (1, 2, 95.0, 0.0, 10.0, 10.0, 100, 80),
                                   (2, 1, 0.0, 0.0, 100.0, 80.0, 100, 80)], BOX_SCHEMA)
    images = spark.createDataFrame([(1,), (2,), (3,)], "image_id long")
    assert sorted(r[0] for r in X.drop_runaway_images(images, boxes).collect()) == [2, 3]


def test_zip_stops_at_shortest(spark):
    df = spark.createDataFrame(
        [(7, ([1, 2, 3], [0, 1, 2], [[0.0, 0.0, 1.0, 1.0]] * 3, [1.0, 1.0]))],
        "image_id long, objects struct<bbox_id: array<bigint>, category: array<int>, "
        "bbox: array<array<double>>, area: array<double>>")
    assert X.explode_objects(df).count() == 2
    ann = X.to_annotations(df).first()["annotations"]
    assert [a["id"] for a in ann] == [1, 2] and all(a["iscrowd"] == 0 for a in ann)


def test_corners_scale_only_normalised(spark):
    df = spark.createDataFrame([(1, 1, 0.1, 0.2, 0.5, 0.25, 200, 100), (1, 2, 10.7, 5.2, 3.9, 1.0, 200, 100)],
                               BOX_SCHEMA)
    r = {x["bbox_id"]: (x["px1"], x["py1"], x["px2"], x["py2"]) for x in X.to_corners_px(df).collect()}
    assert r[1] == (20, 20, 120, 45) and r[2] == (10, 5, 14, 6)


def test_perspective_is_the_homography_of_the_drawn_corners(spark):
    rng = random.Random(5)
    rows = [(i % 7, i, rng.uniform(0, 60), rng.uniform(0, 40), rng.uniform(0, 39), rng.uniform(0, 39), 100, 80) for i in range(60)]
    df = spark.createDataFrame(rows, BOX_SCHEMA)
    draws = {r["image_id"]: [r[f"d{i}"] for i in range(8)] for r in df.select("image_id", *[
        X._corner_draw("image_id", i, 3).alias(f"d{i}") for i in range(8)]).collect()}
    assert len({tuple(d) for d in draws.values()}) == 7
    got = {r["bbox_id"]: r for r in X.perspective_boxes(df, strength=0.2, seed=3).collect()}
    for image, box, x, y, w, h, width, height in rows:
        d = [0.2 * v for v in draws[image]]
        target = [(d[0], d[1]), (1 - d[2], d[3]), (1 - d[4], 1 - d[5]), (d[6], 1 - d[7])]
        eqs, rhs = [], []
        for (u, v), (tx, ty) in zip([(0, 0), (1, 0), (1, 1), (0, 1)], target):
            eqs += [[u, v, 1, 0, 0, 0, -tx * u, -tx * v], [0, 0, 0, u, v, 1, -ty * u, -ty * v]]
            rhs += [tx, ty]
        m = np.append(np.linalg.solve(np.array(eqs, float), rhs), 1).reshape(3, 3)
        ends = [m @ [a / width, b / height, 1] for a in (x, x + w) for b in (y, y + h)]
        px, py = [e[0] / e[2] * width for e in ends], [e[1] / e[2] * height for e in ends]
        r = got[box]
        assert [r["x"], r["y"], r["w"], r["h"]] == pytest.approx(
            [min(px), min(py), max(px) - min(px), max(py) - min(py)], abs=1e-9)


def test_perspective_of_no_strength_or_flag_changes_nothing(spark):
    df = spark.createDataFrame([(1, 1, 10.0, 5.0, 30.0, 20.0, 100, 80), (2, 2, -5.0, 0.0, 10.0, 6.0, 100, 80),
                                (3, 3, None, 5.0, 30.0, 20.0, 100, 80)], BOX_SCHEMA)
    flat = {r["bbox_id"]: r for r in X.perspective_boxes(df, strength=0.0).collect()}
    assert [flat[1][k] for k in "xywh"] == pytest.approx([10, 5, 30, 20])
    assert [flat[2][k] for k in "xywh"] == pytest.approx([0, 0, 5, 6])
    unflagged = X.perspective_boxes(df.withColumn("f", F.lit(None).cast("boolean")), flag_col="f", strength=0.3)
    assert [unflagged.filter("bbox_id = 1").first()[k] for k in "xywh"] == [10, 5, 30, 20]
    assert X.perspective_boxes(df, strength=0.3, min_area=200.0).filter("bbox_id = 2").count() == 0
    with pytest.raises(ValueError):
        X.perspective_boxes(df, strength=0.5)


def test_augment_plan_is_stable(spark):
    df = spark.range(2000).withColumnRenamed("id", "image_id")
    a = X.augment_plan(df, seed=3).orderBy("image_id").collect()
    b = X.augment_plan(df.repartition(7), seed=3).orderBy("image_id").collect()
    assert a == b
    share = sum(r["aug_hflip"] for r in a) / len(a)
    assert 0.45 < share < 0.55


def _brute(pred, truth, thr):
    """Plain-Python greedy matching and 101-point AP (pinned tie rules)."""
    out = {}
    labels = sorted({t[1] for t in truth})
    for lab in labels:
        P = [p for p in pred if p[1] == lab]
        T = [t for t in truth if t[1] == lab]
        npos = len(T)
        by_img = {}
        for p in P:
            by_img.setdefault(p[0], []).append(p)
        tp = {}
        for img, ps in by_img.items():
            ps = sorted(ps, key=lambda p: (-p[7], p[2]))[:100]
            taken = set()
            gts = [t for t in T if t[0] == img]
            for p in ps:
                best, key = None, None
                for t in gts:
                    if t[2] in taken:
                        continue
                    iw = max(min(p[5], t[5]) - max(p[3], t[3]), 0.0)
                    ih = max(min(p[6], t[6]) - max(p[4], t[4]), 0.0)
                    inter = iw * ih
                    u = (p[5] - p[3]) * (p[6] - p[4]) + (t[5] - t[3]) * (t[6] - t[4]) - inter
                    iou = inter / u if u > 0 else 0.0
                    if iou >= thr and (key is None or (-iou, t[2]) < key):
                        best, key = t[2], (-iou, t[2])
                if best is not None:
                    taken.add(best)
                tp[(img, p[2])] = best is not None
        order = sorted(tp, key=lambda k: (-[p for p in P if (p[0], p[2]) == k][0][7], k[0], k[1]))
        i = 0
        prec = {}
        for k, key in enumerate(order, 1):
            if tp[key]:
                i += 1
                j = min(i * 100 // npos, 100)
                prec[j] = max(prec.get(j, 0.0), i / k)
        q, best = [], 0.0
        for j in range(100, -1, -1):
            best = max(best, prec.get(j, 0.0))
            q.append(best)
        out[lab] = sum(q) / 101.0
    return out


def _random_fixture(seed=7, n_img=30):
    rnd = random.Random(seed)
    truth, pred = [], []
    for img in range(n_img):
        for g in range(rnd.randint(0, 6)):
            x, y = rnd.uniform(0, 80), rnd.uniform(0, 80)
            w, h = rnd.uniform(5, 30), rnd.uniform(5, 30)
            lab = rnd.randint(0, 2)
            truth.append((img, lab, g + 1, x, y, x + w, y + h))
            for d in range(rnd.randint(0, 2)):
                dx, dy = rnd.uniform(-4, 4), rnd.uniform(-4, 4)
                pred.append((img, lab if rnd.random() > 0.2 else (lab + 1) % 3, 100 * g + d + 1,
                             x + dx, y + dy, x + w + dx, y + h + dy, round(rnd.random(), 2)))
    return pred, truth


def test_ap_matches_brute_force(spark):
    pred, truth = _random_fixture()
    pdf = spark.createDataFrame(pred, "image_id long, label int, det_id long, x1 double, y1 double, x2 double, "
                                      "y2 double, score double")
    tdf = spark.createDataFrame(truth, "image_id long, label int, gt_id long, x1 double, y1 double, x2 double, "
                                       "y2 double")
    res = E.evaluate(pdf, tdf, ranges={"all": E.AREA_RANGES["all"]})
    got = {(r["label"], r["thr"]): r["ap"] for r in res["ap"].collect()}
    for pct in (50, 75):
        exp = _brute(pred, truth, pct / 100)
        for lab, ap in exp.items():
            assert got[(lab, pct / 100)] == pytest.approx(ap, abs=1e-12), (lab, pct)


def test_perfect_predictions_give_map_one(spark):
    truth = [(i, i % 3, 1, 10.0, 10.0, 40.0, 50.0) for i in range(12)]
    pred = [(i, lab, 1, x1, y1, x2, y2, 0.9) for (i, lab, _, x1, y1, x2, y2) in truth]
    pdf = spark.createDataFrame(pred, "image_id long, label int, det_id long, x1 double, y1 double, x2 double, "
                                      "y2 double, score double")
    tdf = spark.createDataFrame(truth, "image_id long, label int, gt_id long, x1 double, y1 double, x2 double, "
                                       "y2 double")
    res = E.evaluate(pdf, tdf)
    s = {r["metric"]: r["value"] for r in E.map_summary(res["ap"], res["recall"]).collect()}
    assert s["map"] == pytest.approx(1.0) and s["mar_100"] == pytest.approx(1.0)
    assert s["map_small"] == -1.0      # 30 x 40 boxes are medium: no small truth at all


def test_iou_symmetric_and_bounded(spark):
    rnd = np.random.default_rng(1)
    rows = []
    for k in range(50):
        a = rnd.uniform(0, 50, 2); b = rnd.uniform(0, 50, 2)
        rows.append((float(a[0]), float(a[1]), float(a[0] + 10), float(a[1] + 10),
                     float(b[0]), float(b[1]), float(b[0] + 12), float(b[1] + 8)))
    df = spark.createDataFrame(rows, "p_x1 double, p_y1 double, p_x2 double, p_y2 double, "
                                     "t_x1 double, t_y1 double, t_x2 double, t_y2 double")
    swapped = df.select(*[F.col(f"t_{k}").alias(f"p_{k}") for k in ("x1", "y1", "x2", "y2")],
                        *[F.col(f"p_{k}").alias(f"t_{k}") for k in ("x1", "y1", "x2", "y2")])
    a = [r[0] for r in df.select(E.iou()).collect()]
    b = [r[0] for r in swapped.select(E.iou()).collect()]
    assert a == pytest.approx(b) and all(0.0 <= v <= 1.0 for v in a)


def test_best_by(spark):
    df = spark.createDataFrame([(1, 0.2), (2, 0.5), (3, 0.5)], "step long, eval_map double")
    assert E.best_by(df, "eval_map").first()["step"] == 3


def test_cap_uses_window_group_limit(spark, capsys):
    df = spark.createDataFrame([(1, 0, 1, 0.5)], "image_id long, label int, det_id long, score double")
    capsys.readouterr()
    E.cap_detections(df, 100).explain(mode="simple")
    assert "WindowGroupLimit" in capsys.readouterr().out


def _brute_ranges(pred, truth, thr, lo, hi, max_dets=100):
    """Plain-Python COCO-style evaluation for one threshold and area range:
    truths outside the range are ignored (matched last), unmatched
    detections outside it are ignored; returns {label: (ap, recall)}."""
    out = {}
    area = lambda b: (b[5] - b[3]) * (b[6] - b[4])
    for lab in sorted({t[1] for t in truth}):
        T = [t for t in truth if t[1] == lab]
        npos = sum(1 for t in T if lo <= area(t) <= hi)
        if npos == 0:
            continue
        rows = []
        for img in sorted({p[0] for p in pred if p[1] == lab}):
            ps = sorted([p for p in pred if p[0] == img and p[1] == lab], key=lambda p: (-p[7], p[2]))[:max_dets]
            gts = [t for t in T if t[0] == img]
            taken = set()
            for p in ps:
                best, key = None, None
                for t in gts:
                    if t[2] in taken:
                        continue
                    iw = max(min(p[5], t[5]) - max(p[3], t[3]), 0.0)
                    ih = max(min(p[6], t[6]) - max(p[4], t[4]), 0.0)
                    inter = iw * ih
                    u = area(p) + area(t) - inter
                    v = inter / u if u > 0 else 0.0
                    ign = not (lo <= area(t) <= hi)
                    if v >= thr and (key is None or (ign, -v, t[2]) < key):
                        best, key = t, (ign, -v, t[2])
                if best is not None:
                    taken.add(best[2])
                    if not key[0]:
                        rows.append((p, 1))
                elif lo <= area(p) <= hi:
                    rows.append((p, 0))
        rows.sort(key=lambda r: (-r[0][7], r[0][0], r[0][2]))
        i, prec = 0, {}
        for k, (_, tp) in enumerate(rows, 1):
            if tp:
                i += 1
                j = min(i * 100 // npos, 100)
                prec[j] = max(prec.get(j, 0.0), i / k)
        q, best = [], 0.0
        for j in range(100, -1, -1):
            best = max(best, prec.get(j, 0.0))
            q.append(best)
        out[lab] = (sum(q) / 101.0, i / npos)
    return out


def test_area_ranges_match_brute_force(spark):
    rnd = random.Random(11)
    truth, pred = [], []
    for img in range(25):
        for g in range(rnd.randint(1, 5)):
            w, h = rnd.choice([(6, 8), (20, 30), (40, 40), (80, 150), (31, 33)])
            x, y = rnd.uniform(0, 100), rnd.uniform(0, 100)
            lab = rnd.randint(0, 1)
            truth.append((img, lab, g + 1, x, y, x + w, y + h))
            for d in range(rnd.randint(1, 2)):
                s = rnd.uniform(0.8, 1.25)
                dx, dy = rnd.uniform(-3, 3), rnd.uniform(-3, 3)
                pred.append((img, lab, 10 * g + d + 1, x + dx, y + dy, x + dx + w * s, y + dy + h * s,
                             round(rnd.random(), 3)))
    pdf = spark.createDataFrame(pred, "image_id long, label int, det_id long, x1 double, y1 double, x2 double, "
                                      "y2 double, score double")
    tdf = spark.createDataFrame(truth, "image_id long, label int, gt_id long, x1 double, y1 double, x2 double, "
                                       "y2 double")
    res = E.evaluate(pdf, tdf)
    ap = {(r["label"], r["thr"], r["rng"]): r["ap"] for r in res["ap"].collect()}
    rec = {(r["label"], r["thr"], r["rng"]): r["recall"]
           for r in res["recall"].filter("max_dets = 100").collect()}
    for rng, (lo, hi) in E.AREA_RANGES.items():
        for pct in (50, 70, 90):
            exp = _brute_ranges(pred, truth, pct / 100, lo, hi)
            got_labels = {lab for (lab, t, r) in ap if t == pct / 100 and r == rng}
            assert got_labels == set(exp), (rng, pct)
            for lab, (a, r) in exp.items():
                assert ap[(lab, pct / 100, rng)] == pytest.approx(a, abs=1e-12), (lab, pct, rng)
                assert rec[(lab, pct / 100, rng)] == pytest.approx(r, abs=1e-12), (lab, pct, rng)


def test_hot_image_caps_are_exact(spark):
    """One image holding most rows: 150 identical truths and 120 detections
    of one class.  Only the top 100 detections count, and each detection's
    100-candidate cap still finds its free truth (at most 99 are taken)."""
    truth = [(0, 0, g, 10.0, 10.0, 50.0, 50.0) for g in range(1, 151)]
    truth += [(i, 0, 1, 0.0, 0.0, 20.0, 20.0) for i in range(1, 6)]
    pred = [(0, 0, d, 10.0, 10.0, 50.0, 50.0, 1.0 - d / 1000.0) for d in range(1, 121)]
    pred += [(i, 0, 1, 0.0, 0.0, 20.0, 21.0, 0.5) for i in range(1, 6)]
    pdf = spark.createDataFrame(pred, "image_id long, label int, det_id long, x1 double, y1 double, x2 double, "
                                      "y2 double, score double")
    tdf = spark.createDataFrame(truth, "image_id long, label int, gt_id long, x1 double, y1 double, x2 double, "
                                       "y2 double")
    m = E.match_greedy(pdf, tdf, [50], {"all": E.AREA_RANGES["all"]})
    hot = {r["det_id"]: r["gt_id"] for r in m.filter("image_id = 0").collect()}
    assert len(hot) == 100 and all(hot[d] == d for d in range(1, 101))
    res = E.evaluate(pdf, tdf, thresholds_pct=[50, 75], ranges={"all": E.AREA_RANGES["all"]})
    got = {r["thr"]: r["ap"] for r in res["ap"].collect()}
    for pct in (50, 75):
        assert got[pct / 100] == pytest.approx(_brute(pred, truth, pct / 100)[0], abs=1e-12)


def test_hot_image_split_into_buckets_is_exact(spark):
    """The same hot image with the hot-key threshold set low: its truths are
    spread over buckets for the IoU join, results are unchanged."""
    truth = [(0, 0, g, 10.0 + g % 3, 10.0, 50.0 + g % 3, 50.0) for g in range(1, 151)]
    truth += [(i, 0, 1, 0.0, 0.0, 20.0, 20.0) for i in range(1, 6)]
    pred = [(0, 0, d, 10.0, 10.0, 50.0, 50.0, 1.0 - d / 1000.0) for d in range(1, 121)]
    pred += [(i, 0, 1, 0.0, 0.0, 20.0, 21.0, 0.5) for i in range(1, 6)]
    pdf = spark.createDataFrame(pred, "image_id long, label int, det_id long, x1 double, y1 double, x2 double, "
                                      "y2 double, score double")
    tdf = spark.createDataFrame(truth, "image_id long, label int, gt_id long, x1 double, y1 double, x2 double, "
                                       "y2 double")
    joined = E.keyed_join(pdf, tdf.select("image_id", "label", "gt_id"), ["image_id", "label"], "gt_id", 40)
    assert joined.count() == 120 * 150 + 5
    res = E.evaluate(pdf, tdf, thresholds_pct=[50, 75], ranges={"all": E.AREA_RANGES["all"]}, hot_rows=40)
    got = {r["thr"]: r["ap"] for r in res["ap"].collect()}
    for pct in (50, 75):
        assert got[pct / 100] == pytest.approx(_brute(pred, truth, pct / 100)[0], abs=1e-12)
    plain = E.match_greedy(pdf, tdf, [50, 75], {"all": E.AREA_RANGES["all"]})
    split = E.match_greedy(pdf, tdf, [50, 75], {"all": E.AREA_RANGES["all"]}, hot_rows=40)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.collect()))


def test_full_range_with_ignored_giants_matches_brute_force(spark):
    """Boxes above 1e10 square pixels are ignored even by 'all': the
    true-positive ranking must subtract the ignored detections before each."""
    rnd = random.Random(5)
    truth, pred = [], []
    for img in range(12):
        for g in range(4):
            giant = g == 0 and img % 3 == 0
            w, h = (2e5, 1e5) if giant else (rnd.uniform(10, 60), rnd.uniform(10, 60))
            x, y = rnd.uniform(0, 50), rnd.uniform(0, 50)
            truth.append((img, 0, g + 1, x, y, x + w, y + h))
            for d in range(2):
                s = rnd.uniform(0.9, 1.1)
                pred.append((img, 0, 10 * g + d + 1, x, y, x + w * s, y + h * s, round(rnd.random(), 4)))
        # an unmatched giant detection: ignored, not a false positive
        pred.append((img, 0, 999, 0.0, 0.0, 3e5, 3e5, round(rnd.random(), 4)))
    pdf = spark.createDataFrame(pred, "image_id long, label int, det_id long, x1 double, y1 double, x2 double, "
                                      "y2 double, score double")
    tdf = spark.createDataFrame(truth, "image_id long, label int, gt_id long, x1 double, y1 double, x2 double, "
                                       "y2 double")
    res = E.evaluate(pdf, tdf, thresholds_pct=[50, 80], ranges={"all": E.AREA_RANGES["all"]})
    ap = {r["thr"]: r["ap"] for r in res["ap"].collect()}
    rec = {r["thr"]: r["recall"] for r in res["recall"].filter("max_dets = 100").collect()}
    for pct in (50, 80):
        a, r = _brute_ranges(pred, truth, pct / 100, *E.AREA_RANGES["all"])[0]
        assert ap[pct / 100] == pytest.approx(a, abs=1e-12)
        assert rec[pct / 100] == pytest.approx(r, abs=1e-12)


def test_a_class_over_many_partitions_matches_brute_force(spark):
    """Contested and uncontested boxes in one evaluation; each class lies in
    several partitions, which go on from the counts of those before."""
    pred, truth = _random_fixture(3, 40)
    pdf = spark.createDataFrame(pred, "image_id long, label int, det_id long, x1 double, y1 double, x2 double, "
                                      "y2 double, score double")
    tdf = spark.createDataFrame(truth, "image_id long, label int, gt_id long, x1 double, y1 double, x2 double, "
                                       "y2 double")
    res = E.evaluate(pdf, tdf, thresholds_pct=[50, 60, 75], num_partitions=11)
    ap = {(r["label"], r["thr"], r["rng"]): r["ap"] for r in res["ap"].collect()}
    for rng in ("all", "small", "medium"):
        for pct in (50, 60, 75):
            for lab, (a, _) in _brute_ranges(pred, truth, pct / 100, *E.AREA_RANGES[rng]).items():
                assert ap[lab, pct / 100, rng] == pytest.approx(a, abs=1e-12), (lab, pct, rng)
    # a row for each capped detection, none for each threshold
    assert res["flags"].count() == len(pred)
    greedy = E.match_greedy(pdf, tdf, [50, 60, 75], E.AREA_RANGES)
    columns = ["image_id", "label", "thr", "rng", "det_id", "gt_id", "gt_ignored"]
    assert sorted(map(tuple, res["matches"].select(columns).collect())) == sorted(map(tuple, greedy.select(columns).collect()))
