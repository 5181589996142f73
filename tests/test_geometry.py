"""Invariances of the descriptor, and the traps of masks, rounding and absent bodies."""

import math
import random

import pytest
from pyspark.sql import functions as F

from poseframes.functions import geometry as G
from poseframes.functions import naming as N
from poseframes.operators import clusters as K
from poseframes.operators import landmarks as L
from poseframes.operators.features import frame_features


def frame(rng):
    return [rng.uniform(0, 1) for _ in range(171)]


KINDS = "i int, xyz array<double>, mask array<boolean>"


def features(spark, rows):
    return frame_features(spark.createDataFrame(rows, KINDS), "filled", "norm", "descriptor").orderBy("i").collect()


def test_shift_and_scale_leave_the_descriptor(spark):
    base = frame(random.Random(2))
    d = features(spark, [(0, base, [True] * 57), (1, [3 * v + 5 for v in base], [True] * 57)])
    assert len(d[0]["descriptor"]) == 178
    assert max(abs(a - b) for a, b in zip(d[0]["descriptor"], d[1]["descriptor"])) < 1e-4
    n = d[0]["norm"]
    assert abs(sum((n[a] - n[3 + a]) ** 2 for a in range(3)) - 1) < 1e-9 and max(abs(n[a] + n[3 + a]) for a in range(3)) < 1e-9


def test_features_of_a_frame_one_by_one(spark):
    """The last seven numbers by the law of cosines, and what the column functions give."""
    rng = random.Random(7)
    rows = [(i, frame(rng), [True] * 57) for i in range(20)]
    got = frame_features(spark.createDataFrame(rows, KINDS), "norm", "descriptor").withColumn("f", F.array(*G.angle_features(F.col("norm")))).collect()
    for r in got:
        p = lambda j: r["norm"][3 * j : 3 * j + 3]  # noqa: E731, B023
        d = lambda a, b: math.dist(p(a), p(b))  # noqa: E731, B023
        angle = lambda a, b, c: math.degrees(math.acos((d(a, b) ** 2 + d(b, c) ** 2 - d(a, c) ** 2) / (2 * d(a, b) * d(b, c)))) / 45  # noqa: E731, B023
        want = [angle(0, 2, 4), angle(1, 3, 5), angle(1, 0, 2), angle(0, 1, 3), p(14)[1] - p(4)[1], p(14)[1] - p(5)[1], d(4, 5)]
        assert r["descriptor"][171:] == pytest.approx(want, abs=1e-3) and r["descriptor"][171:] == pytest.approx([x / 45 for x in r["f"]], abs=1e-9)
        assert r["descriptor"][:171] == r["norm"]


def test_missing_hand_falls_on_the_wrist(spark):
    xyz, mask = frame(random.Random(3)), [False] * 15 + [False] * 21 + [False, True] + [False] * 19
    (r,) = features(spark, [(0, xyz, mask)])
    assert r["filled"] == xyz[:45] + xyz[12:15] * 21 + xyz[108:]
    (r,) = features(spark, [(0, xyz, [True] * 36 + [False] * 21)])
    assert r["filled"] == xyz[:108] + xyz[15:18] * 21


def test_absent_body_gives_the_least_scale(spark):
    xyz = [0.0] * 45 + [0.5] * 63 + [0.0] * 63
    (r,) = features(spark, [(0, xyz, [False] * 15 + [True] * 21 + [False] * 21)])
    assert r["norm"][45] == pytest.approx(0.5 / 1e-6) and all(math.isfinite(v) for v in r["descriptor"])


def test_frames_that_cannot_be_read(spark):
    good = frame(random.Random(4))
    rows = [(0, None, [True] * 57), (1, good, None), (2, good[:170], [True] * 57), (3, good, [True] * 56), (4, [], []), (5, good, [True] * 57)]
    got = features(spark, rows)
    assert [r["descriptor"] is not None for r in got] == [r["norm"] is not None for r in got] == [r["filled"] is not None for r in got] == [False] * 5 + [True]
    assert features(spark, []) == []


def test_straight_angle_is_no_nan(spark):
    p = lambda *v: tuple(F.lit(float(x)) for x in v)
    r = spark.range(1).select(G.joint_angle(p(0, 0, 0), p(1, 0, 0), p(2, 0, 0)).alias("a"), G.joint_angle(p(0, 0, 0), p(0, 0, 0), p(2, 0, 0)).alias("b")).first()
    assert r["a"] == pytest.approx(180, abs=0.2) and r["b"] == pytest.approx(90)


def test_empty_cluster_is_described_as_raised(spark):
    r = spark.range(1).select(N.describe_pose(F.array_repeat(F.lit(0.0), 171)).alias("d")).select(N.base_pose_name(F.col("d")).alias("n")).first()
    assert r["n"] == "BOTH_FACE_TOGETHER"


def test_sampling_rounds_half_to_even(spark):
    body = "array<struct<x: double, y: double, z: double, visibility: double>>"
    hand = "array<struct<x: double, y: double, z: double>>"
    raw = spark.createDataFrame([(1, i, 25.0, None, None, []) for i in range(6)] + [(2, 0, 0.0, None, None, [])], f"clip_id long, idx long, src_fps double, body {body}, left_hand {hand}, right_hand {hand}")
    got = L.assemble_keypoints(L.sample_frames(raw)).orderBy("clip_id", "frame_idx").collect()
    assert [(r["clip_id"], r["frame_idx"], r["fps"]) for r in got] == [(1, 0, 12.5), (1, 1, 12.5), (1, 2, 12.5), (2, 0, 12.5)]
    assert all(len(r["xyz"]) == 171 and not any(r["mask"]) for r in got)


def test_scaler_is_population_and_survives_constants(spark):
    v = spark.createDataFrame([([1.0, 5.0],), ([3.0, 5.0],)], "v array<double>")
    out = K.scale(v, K.fit_scaler(v, "v"), "v").collect()
    assert sorted(r["scaled"] for r in out) == [[-1.0, 0.0], [1.0, 0.0]]


def test_kmeans_splits_two_clouds(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(10 * (i % 2), 1), rng.gauss(0, 1)]) for i in range(200)]
    df = spark.createDataFrame(rows, "i int, scaled array<double>")
    got = K.assign_clusters(df, K.fit_kmeans(df, 2, ["i"]), "scaled")
    assert got.groupBy(F.col("i") % 2).agg(F.countDistinct("cluster_id").alias("n")).where("n > 1").count() == 0
    assert K.silhouette(got, "scaled") > 0.7
