"""Queries over keypoint frames: landmarks, geometry, features, naming."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from poseframes.functions import geometry as G
from poseframes.functions import naming as N
from poseframes.operators import landmarks as L
from poseframes.operators.features import frame_features, weighted_sum
from poseframes.params import L_HAND, NOSE, R_HAND
from poseframes.plans.scratch import new_folder
from poseframes.plans.views import POINTS, keypoint_frames, raw_landmarks, table, with_views
from poseframes.sources import clips as S
from poseframes.sources import files as D

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None, more: list[tuple[str, str]] = POINTS, views: list[str] = ["frame_clusters"]):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = with_views(views, sql, more)
        return f

    return keep


def check(xyz: Column | str, digits: int = 4) -> Column:
    """A number that depends on every coordinate and its place."""
    return F.round(weighted_sum(xyz), digits)


_CHECK = "round(sum((3 * j + 1) * x + (3 * j + 2) * y + (3 * j + 3) * z), 4)"
_KEY = ["clip_id", "frame_idx"]


def normalised(spark, sf, *wanted: str, of=None):
    """Frames with ``norm`` coordinates, or with what else is wanted of them."""
    return frame_features(keypoint_frames(spark, sf, of), *(wanted or ("norm",)))


# Normalised points of a frame side by side in the other engine.
_WIDE = [*POINTS, ("wide", "SELECT clip_id, frame_idx, any_value(n_frames) AS n_frames, any_value(event_id) AS event_id, any_value(cluster_id) AS cluster_id, " + ", ".join(f"max({a}) FILTER (WHERE j = {j}) AS {a}{j}" for j in (0, 1, 2, 3, 4, 5, 14, 15, 24, 36, 45) for a in "xyz") + f", {_CHECK} AS ck, {_CHECK[6:-4]} AS raw_ck FROM norm GROUP BY clip_id, frame_idx")]


def _sq(a: int, b: int) -> str:
    return " + ".join(f"({c}{a} - {c}{b}) * ({c}{a} - {c}{b})" for c in "xyz")


def _cos(a: int, b: int, c: int, eps: str) -> str:
    top = " + ".join(f"({k}{a} - {k}{b}) * ({k}{c} - {k}{b})" for k in "xyz")
    bottom = f"(sqrt({_sq(a, b)}) + 1e-6::DOUBLE) * (sqrt({_sq(c, b)}) + 1e-6::DOUBLE)" if eps == "each" else f"sqrt({_sq(a, b)}) * sqrt({_sq(c, b)}) + 1e-6::DOUBLE"
    return f"greatest(-1.0::DOUBLE, least(1.0::DOUBLE, ({top}) / ({bottom})))"


def _angle(a: int, b: int, c: int, eps: str = "each") -> str:
    return f"degrees(acos({_cos(a, b, c, eps)}))"


_FEATURES = [_angle(0, 2, 4), _angle(1, 3, 5), _angle(1, 0, 2), _angle(0, 1, 3), "(y14 - y4) * 45", "(y14 - y5) * 45", f"sqrt({_sq(4, 5)}) * 45"]


def _sampled(spark, sf):
    return L.sample_frames(raw_landmarks(spark, sf))


_RAW = [
    ("raw", "SELECT *, CASE clip_id % 5 WHEN 0 THEN 25.0 WHEN 1 THEN 30.0 WHEN 2 THEN 29.97 WHEN 3 THEN 25.0 ELSE 5.0 END::DOUBLE AS f FROM frame_clusters"),
    ("kept", "SELECT * FROM (SELECT *, greatest(1, CAST(round_even(f / 10.0::DOUBLE, 0) AS BIGINT)) AS step FROM raw) WHERE frame_idx % step = 0"),
]


@query("P8_frame_sampling", "SELECT clip_id, CAST(frame_idx / step AS BIGINT) AS frame_idx, round(f / step, 6) AS fps, event_id FROM kept", _RAW)
def _(spark, sf):
    return _sampled(spark, sf).select("clip_id", "frame_idx", F.round("fps", 6).alias("fps"), "event_id")


@query("P9_frame_clock_ms", "SELECT clip_id, CAST(frame_idx / step AS BIGINT) AS frame_idx, CAST(trunc(frame_idx / f * 1000) AS BIGINT) AS clock_ms FROM kept", _RAW)
def _(spark, sf):
    return _sampled(spark, sf).select("clip_id", "frame_idx", "clock_ms")


_GIVEN = [*POINTS, ("given", "SELECT clip_id, frame_idx, event_id, j, CASE WHEN j < 15 AND event_id % 501 = 0 THEN 0 ELSE x END AS x, CASE WHEN j < 15 AND event_id % 501 = 0 THEN 0 ELSE y END AS y, CASE WHEN j < 15 AND event_id % 501 = 0 THEN 0 ELSE z END AS z, CASE WHEN j >= 15 THEN ok WHEN event_id % 501 = 0 THEN false ELSE (event_id + j) % 11 = 0 OR ((event_id * 13 + j * 37) % 100) / 100.0::DOUBLE >= 0.3::DOUBLE END AS ok FROM pts")]
_bits = lambda mask: F.aggregate(F.transform(mask, lambda m, i: F.when(m, (i + 1) * (i + 1)).otherwise(0)), F.lit(0), lambda a, b: a + b)
_BITS = "CAST(sum(CASE WHEN ok THEN ({0}) * ({0}) ELSE 0 END) AS BIGINT)"


def _flat(points: Column) -> Column:
    return F.flatten(F.transform(points, lambda p: F.array(p["x"], p["y"], p["z"])))


@query("P10_upper_body_select", f"SELECT clip_id, frame_idx, {_CHECK} AS body_check FROM given WHERE j < 15 GROUP BY ALL", _GIVEN)
def _(spark, sf):
    return raw_landmarks(spark, sf).select("clip_id", F.col("idx").alias("frame_idx"), check(_flat(L.body_points(F.col("body")))).alias("body_check"))


@query("P11_visibility_mask", f"SELECT clip_id, frame_idx, {_BITS.format('j + 1')} AS mask_check FROM given WHERE j < 15 GROUP BY ALL", _GIVEN)
def _(spark, sf):
    return raw_landmarks(spark, sf).select("clip_id", F.col("idx").alias("frame_idx"), _bits(L.body_mask(F.col("body"))).cast("long").alias("mask_check"))


@query("P12_hand_block", "SELECT clip_id, frame_idx, " + ", ".join(f"round(sum((3 * (j - {s}) + 1) * x + (3 * (j - {s}) + 2) * y + (3 * (j - {s}) + 3) * z) FILTER (WHERE j BETWEEN {s} AND {s + 20}), 4) AS {n}_check, bool_and(ok) FILTER (WHERE j BETWEEN {s} AND {s + 20}) AS {n}_there" for n, s in (("left", 15), ("right", 36))) + " FROM given GROUP BY ALL", _GIVEN)
def _(spark, sf):
    cols = [c for n in ("left", "right") for c in (check(_flat(L.hand_points(F.col(f"{n}_hand")))).alias(f"{n}_check"), F.forall(L.hand_mask(F.col(f"{n}_hand")), lambda m: m).alias(f"{n}_there"))]
    return raw_landmarks(spark, sf).select("clip_id", F.col("idx").alias("frame_idx"), *cols)


@query("P13_assemble_keypoints", f"SELECT clip_id, frame_idx, {_CHECK} AS xyz_check, {_BITS.format('j + 1')} AS mask_check FROM given GROUP BY ALL", _GIVEN)
def _(spark, sf):
    df = L.assemble_keypoints(raw_landmarks(spark, sf))
    return df.select("clip_id", F.col("idx").alias("frame_idx"), check("xyz").alias("xyz_check"), _bits(F.col("mask")).cast("long").alias("mask_check"))


@query("F1_fill_missing_hands", f"SELECT clip_id, frame_idx, {_CHECK} AS xyz_check FROM filled GROUP BY clip_id, frame_idx")
def _(spark, sf):
    return normalised(spark, sf, "filled").select(*_KEY, check("filled").alias("xyz_check"))


@query("F2_normalize_pose", "SELECT clip_id, frame_idx, ck AS norm_check, round(x4, 6) AS left_wrist_x, round(y5, 6) AS right_wrist_y, round(z14, 6) AS nose_z FROM wide", _WIDE)
def _(spark, sf):
    g = lambda i, n: F.round(F.get("norm", F.lit(i)), 6).alias(n)
    return normalised(spark, sf).select(*_KEY, check("norm").alias("norm_check"), g(12, "left_wrist_x"), g(16, "right_wrist_y"), g(3 * NOSE + 2, "nose_z"))


@query("F3_joint_angle", f"SELECT clip_id, frame_idx, round({_angle(0, 2, 4)}, 5) AS left_elbow, round({_angle(1, 3, 5)}, 5) AS right_elbow FROM wide", _WIDE)
def _(spark, sf):
    p = lambda j: G.point(F.col("norm"), j)
    return normalised(spark, sf).select(*_KEY, F.round(G.joint_angle(p(0), p(2), p(4)), 5).alias("left_elbow"), F.round(G.joint_angle(p(1), p(3), p(5)), 5).alias("right_elbow"))


@query("F4_angle_features", "SELECT clip_id, frame_idx, " + ", ".join(f"round({f}, 5) AS f{i}" for i, f in enumerate(_FEATURES)) + " FROM wide", _WIDE)
def _(spark, sf):
    return normalised(spark, sf).select(*_KEY, *(F.round(f, 5).alias(f"f{i}") for i, f in enumerate(G.angle_features(F.col("norm")))))


@query("F5_descriptor", "SELECT clip_id, frame_idx, 178 AS n, round(raw_ck + " + " + ".join(f"{172 + i} * (({f}) / 45)" for i, f in enumerate(_FEATURES)) + ", 3) AS desc_check FROM wide", _WIDE)
def _(spark, sf):
    df = normalised(spark, sf, "descriptor")
    return df.select(*_KEY, F.size("descriptor").alias("n"), check("descriptor", 3).alias("desc_check"))


def _bone(a: int, b: int) -> list[str]:
    size = f"(sqrt({_sq(b, a)}) + 1e-6::DOUBLE)"
    return [f"(x{b} - x{a}) / {size}", f"-(y{b} - y{a}) / {size}", f"-(z{b} - z{a}) / {size}"]


def _rotation_sql() -> str:
    out = []
    for side, s, e, w, h in (("left", 0, 2, 4, 15), ("right", 1, 3, 5, 36)):
        u, f, p = _bone(s, e), _bone(e, w), _bone(h, h + 9)
        out += [f"round(degrees(asin(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, {u[1]})))), 5) AS {side}_pitch", f"round(degrees(atan2({u[2]}, {u[0]})), 5) AS {side}_yaw", f"round(180.0::DOUBLE - {_angle(s, e, w)}, 5) AS {side}_flexion"]
        out += [f"round_even({v[i]}, 4) + 0.0::DOUBLE AS {side}_{n}_{c}" for n, v in (("upper", u), ("fore", f), ("palm", p)) for i, c in enumerate("xyz")]
    return ", ".join(out)


@query("F6_joint_rotations", f"SELECT clip_id, frame_idx, {_rotation_sql()} FROM wide", _WIDE)
def _(spark, sf):
    df = normalised(spark, sf).withColumn("r", G.joint_rotations(F.col("norm")))
    cols = []
    for side in ("left", "right"):
        sh, el, wr = (F.col(f"r.{side}_{n}") for n in ("shoulder", "elbow", "wrist"))
        cols += [F.round(sh["pitch"], 5).alias(f"{side}_pitch"), F.round(sh["yaw"], 5).alias(f"{side}_yaw"), F.round(el["flexion"], 5).alias(f"{side}_flexion")]
        cols += [F.get(d["dir"], F.lit(i)).alias(f"{side}_{n}_{c}") for n, d in (("upper", sh), ("fore", el), ("palm", wr)) for i, c in enumerate("xyz")]
    return df.select(*_KEY, *cols)


_ZONE = "CASE WHEN {0} < -0.60::DOUBLE THEN 'WAIST' WHEN {0} < -0.10::DOUBLE THEN 'CHEST' WHEN {0} < 0.50::DOUBLE THEN 'FACE' ELSE 'ABOVE_HEAD' END"
_DESCRIBE = [
    ("d0", f"SELECT *, -y4 AS lh, -y5 AS rh, sqrt({_sq(4, 5)}) AS gap FROM wide"),
    ("d1", "SELECT *, CASE WHEN lh > -1.8::DOUBLE AND rh > -1.8::DOUBLE THEN 'BOTH' WHEN lh > -1.8::DOUBLE THEN 'LEFT' WHEN rh > -1.8::DOUBLE THEN 'RIGHT' ELSE 'REST' END AS side FROM d0"),
    ("d2", "SELECT *, CASE side WHEN 'LEFT' THEN lh WHEN 'RIGHT' THEN rh ELSE greatest(lh, rh) END AS h FROM d1"),
    ("described", f"SELECT *, {_ZONE.format('h')} AS zone, round_even(gap, 3) AS hands_gap, CASE WHEN gap < 1.5::DOUBLE THEN 'TOGETHER' ELSE 'APART' END AS contact, round_even({_angle(0, 2, 4, 'sum')}, 1) AS left_elbow_deg, round_even({_angle(1, 3, 5, 'sum')}, 1) AS right_elbow_deg, round_even(lh, 3) AS left_wrist_height, round_even(rh, 3) AS right_wrist_height FROM d2"),
]
_BASE_NAME = "CASE side WHEN 'REST' THEN 'REST_LOW' WHEN 'BOTH' THEN side || '_' || zone || '_' || contact ELSE side || '_' || zone END"
_IDLE = "side = 'REST' AND left_wrist_height < -1.8::DOUBLE AND right_wrist_height < -1.8::DOUBLE"


def described(spark, sf):
    return normalised(spark, sf).withColumn("d", N.describe_pose(F.col("norm")))


@query("F7_describe_pose", "SELECT clip_id, frame_idx, side, zone, hands_gap, contact, left_elbow_deg, right_elbow_deg, left_wrist_height, right_wrist_height FROM described", [*_WIDE, *_DESCRIBE])
def _(spark, sf):
    return described(spark, sf).select(*_KEY, "d.*")


@query("F8_height_zone", f"SELECT clip_id, frame_idx, {_ZONE.format('(-y4)')} AS left_zone, {_ZONE.format('(-y5)')} AS right_zone FROM wide", _WIDE)
def _(spark, sf):
    return normalised(spark, sf).select(*_KEY, N.height_zone(-F.get("norm", F.lit(13))).alias("left_zone"), N.height_zone(-F.get("norm", F.lit(16))).alias("right_zone"))


@query("F9_is_idle_pose", f"SELECT clip_id, frame_idx, {_IDLE} AS is_idle FROM described", [*_WIDE, *_DESCRIBE])
def _(spark, sf):
    return described(spark, sf).select(*_KEY, N.is_idle_pose(F.col("d")).alias("is_idle"))


@query("F10_base_pose_name", f"SELECT clip_id, frame_idx, {_BASE_NAME} AS base FROM described", [*_WIDE, *_DESCRIBE])
def _(spark, sf):
    return described(spark, sf).select(*_KEY, N.base_pose_name(F.col("d")).alias("base"))


def _spread(start: int) -> str:
    return f"max(sqrt((n.x - w.x{start}) * (n.x - w.x{start}) + (n.y - w.y{start}) * (n.y - w.y{start}))) FILTER (WHERE j BETWEEN {start} AND {start + 20})"


@query("F14_hand_present", f"SELECT n.clip_id, n.frame_idx, {_spread(15)} >= 0.03::DOUBLE AS left_there, {_spread(36)} >= 0.03::DOUBLE AS right_there, round({_spread(15)}, 6) AS left_spread FROM norm n JOIN wide w ON n.clip_id = w.clip_id AND n.frame_idx = w.frame_idx GROUP BY n.clip_id, n.frame_idx", _WIDE)
def _(spark, sf):
    n = F.col("norm")
    return normalised(spark, sf).select(*_KEY, G.hand_present(n, L_HAND).alias("left_there"), G.hand_present(n, R_HAND).alias("right_there"), F.round(G.hand_spread(n, L_HAND), 6).alias("left_spread"))


def _bone_sql(name: str, a: int, b: int, there: str = "true") -> str:
    size = f"sqrt({_sq(b, a)})"
    return f"SELECT clip_id, frame_idx, '{name}' AS bone, " + ", ".join(f"CASE WHEN ({_sq(b, a)}) >= 1e-9::DOUBLE AND ({there}) THEN round({'-' if c != 'x' else ''}({c}{b} - {c}{a}) / {size}, 6) END AS d{c}" for c in "xyz") + " FROM wide"


_AIM = "sqrt((x{1} - x{0}) * (x{1} - x{0}) + (y{1} - y{0}) * (y{1} - y{0})) >= 0.03::DOUBLE"


@query("F15_avatar_bone_dirs", " UNION ALL ".join([_bone_sql("leftUpperArm", 0, 2), _bone_sql("leftLowerArm", 2, 4), _bone_sql("rightUpperArm", 1, 3), _bone_sql("rightLowerArm", 3, 5), _bone_sql("leftHand", 4, 24, _AIM.format(15, 24)), _bone_sql("rightHand", 5, 45, _AIM.format(36, 45))]), _WIDE)
def _(spark, sf):
    df = normalised(spark, sf).select(*_KEY, F.inline(G.avatar_bones(F.col("norm"))))
    return df.select(*_KEY, "bone", *(F.round(F.get("dir", F.lit(i)), 6).alias(f"d{c}") for i, c in enumerate("xyz")))


@query("F16_mirror_pose", "SELECT clip_id, frame_idx, round(sum(-(3 * j + 1) * x + (3 * j + 2) * y + (3 * j + 3) * z), 4) AS mirror_check FROM norm GROUP BY clip_id, frame_idx")
def _(spark, sf):
    return normalised(spark, sf).select(*_KEY, check(G.mirror(F.col("norm"))).alias("mirror_check"))


_STORED = f"SELECT c.clip_id, c.label, round(c.fps::DOUBLE, 6) AS fps, c.source, count(DISTINCT frame_idx) AS n_frames, round(sum((3 * j + 1) * x + (3 * j + 2) * y + (3 * j + 3) * z), 0) AS xyz_check, CAST(sum(ok::INT) AS BIGINT) AS n_ok FROM pts JOIN clips c ON pts.clip_id = c.clip_id GROUP BY ALL"


def _sums(clips):
    return clips.agg(F.count("*").alias("n_frames"), F.sum(weighted_sum(F.col("xyz").cast("array<double>"))).alias("s"), F.sum(F.size(F.filter("mask", lambda m: m))).alias("n_ok"))


def _stored(clips, frames):
    per = _sums(frames.groupBy("clip_id"))
    return clips.drop("n_frames").join(per, "clip_id").select("clip_id", "label", F.round(F.col("fps").cast("double"), 6).alias("fps"), "source", "n_frames", F.round("s", 0).alias("xyz_check"), "n_ok")


@query("S4_clip_store_write_S5_read", _STORED, views=["frame_clusters", "clips"])
def _(spark, sf):
    folder = new_folder(spark, "store")
    S.write_clips(table(spark, sf, "clips"), keypoint_frames(spark, sf), folder)
    return _stored(*S.read_clips(spark, folder))


@query("S6_read_npz_clips", f"SELECT label, round(fps, 6) AS fps, source, n_frames, xyz_check, n_ok FROM ({_STORED})", views=["frame_clusters", "clips"])
def _(spark, sf):
    frames = S.parse_npz(S.pack_npz(table(spark, sf, "clips"), keypoint_frames(spark, sf).select("clip_id", "frame_idx", "xyz", "mask")))
    per = _sums(frames.groupBy("source", "label", "fps"))  # archives are read once
    return per.select("label", F.round(F.col("fps").cast("double"), 6).alias("fps"), "source", "n_frames", F.round("s", 0).alias("xyz_check"), "n_ok")


@query("S6_npz_source", f"SELECT label, round(fps, 6) AS fps, source, n_frames, xyz_check, n_ok FROM ({_STORED})", views=["frame_clusters", "clips"])
def _(spark, sf):
    """Archives as files, read through a source of their own: heads from headers, frames whole."""
    folder = new_folder(spark, "npz")
    D.write_files(S.pack_npz(table(spark, sf, "clips"), keypoint_frames(spark, sf).select("clip_id", "frame_idx", "xyz", "mask")), folder)
    D.register(spark)
    heads = spark.read.format("pose_npz").option("headers", True).load(folder).where("error IS NULL").withColumn("clip_id", F.col("source"))
    frames = spark.read.format("pose_npz").option("partitionBytes", 1 << 20).load(folder).withColumn("clip_id", F.col("source"))
    return _stored(heads, frames).drop("clip_id")
