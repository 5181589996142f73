"""Geometry of one frame. ``xyz`` is a flat array: point j has its axes at 3 j, 3 j + 1, 3 j + 2."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from poseframes.params import EPS, HAND_SPREAD, L_ELB, L_HAND, L_SHO, L_WRI, N_HAND, NOSE, R_ELB, R_HAND, R_SHO, R_WRI

Vector = tuple[Column, Column, Column]


def point(xyz: Column, j: int) -> Vector:
    return tuple(F.get(xyz, F.lit(3 * j + a)) for a in range(3))  # type: ignore[return-value]


def minus(p: Vector, q: Vector) -> Vector:
    return tuple(a - b for a, b in zip(p, q, strict=True))  # type: ignore[return-value]


def dot(p: Vector, q: Vector) -> Column:
    return p[0] * q[0] + p[1] * q[1] + p[2] * q[2]


def norm(p: Vector) -> Column:
    return F.sqrt(dot(p, p))


def _clip(x: Column) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x))


def joint_angle(a: Vector, b: Vector, c: Vector) -> Column:
    """The angle at b in degrees."""
    v, w = minus(a, b), minus(c, b)
    return F.degrees(F.acos(_clip(dot(v, w) / ((norm(v) + EPS) * (norm(w) + EPS)))))


def angle_features(norm_xyz: Column) -> list[Column]:
    """Both elbows, both shoulders, wrists relative to the nose, and the gap between the wrists."""
    p = {j: point(norm_xyz, j) for j in (L_SHO, R_SHO, L_ELB, R_ELB, L_WRI, R_WRI, NOSE)}
    return [
        joint_angle(p[L_SHO], p[L_ELB], p[L_WRI]), joint_angle(p[R_SHO], p[R_ELB], p[R_WRI]),
        joint_angle(p[R_SHO], p[L_SHO], p[L_ELB]), joint_angle(p[L_SHO], p[R_SHO], p[R_ELB]),
        (p[NOSE][1] - p[L_WRI][1]) * 45.0, (p[NOSE][1] - p[R_WRI][1]) * 45.0, norm(minus(p[L_WRI], p[R_WRI])) * 45.0,
    ]


def _bone(xyz: Column, a: int, b: int) -> Vector:
    """Unit direction from a to b with y up and z towards the viewer."""
    v = minus(point(xyz, b), point(xyz, a))
    return tuple(x / (norm(v) + EPS) for x in (v[0], -v[1], -v[2]))  # type: ignore[return-value]


def joint_rotations(norm_xyz: Column) -> Column:
    """Angles and directions that aim an avatar's arms, for each side a struct."""

    def direction(v: Vector) -> Column:
        return F.array(*(F.bround(x, 4) for x in v))

    fields = []
    for side, sho, elb, wri, hand in (("left", L_SHO, L_ELB, L_WRI, L_HAND), ("right", R_SHO, R_ELB, R_WRI, R_HAND)):
        upper, fore, palm = _bone(norm_xyz, sho, elb), _bone(norm_xyz, elb, wri), _bone(norm_xyz, hand, hand + 9)
        # straight to the right without depth: the depth is minus zero, which atan2 here would drop
        yaw = F.when((upper[2] == 0) & (upper[0] < 0), F.lit(-180.0)).otherwise(F.degrees(F.atan2(upper[2], upper[0])))
        bend = joint_angle(point(norm_xyz, sho), point(norm_xyz, elb), point(norm_xyz, wri))
        fields += [
            F.struct(F.degrees(F.asin(_clip(upper[1]))).alias("pitch"), yaw.alias("yaw"), direction(upper).alias("dir")).alias(f"{side}_shoulder"),
            F.struct((180.0 - bend).alias("flexion"), direction(fore).alias("dir")).alias(f"{side}_elbow"),
            F.struct(direction(palm).alias("dir")).alias(f"{side}_wrist"),
        ]
    return F.struct(*fields)


def _flat_distance(p: Vector, q: Vector) -> Column:
    return F.sqrt((p[0] - q[0]) * (p[0] - q[0]) + (p[1] - q[1]) * (p[1] - q[1]))


def hand_spread(xyz: Column, start: int) -> Column:
    """The greatest distance, seen from the front, of a hand's points from its root."""
    root = point(xyz, start)
    return F.array_max(F.transform(F.sequence(F.lit(start), F.lit(start + N_HAND - 1)), lambda j: _flat_distance((F.get(xyz, j * 3), F.get(xyz, j * 3 + 1), F.lit(0)), root)))


def hand_present(xyz: Column, start: int) -> Column:
    return hand_spread(xyz, start) >= HAND_SPREAD


def hand_aims(xyz: Column, start: int) -> Column:
    """The variant for bones: whether the middle knuckle is away from the root."""
    return _flat_distance(point(xyz, start + 9), point(xyz, start)) >= HAND_SPREAD


def avatar_bones(xyz: Column) -> Column:
    """Six bones with unit directions; null where there is none to give."""

    def unit(a: int, b: int, there: Column | None = None) -> Column:
        v = minus(point(xyz, b), point(xyz, a))
        size = dot(v, v)
        there = size >= 1e-9 if there is None else there & (size >= 1e-9)
        return F.when(there, F.array(v[0] / F.sqrt(size), -v[1] / F.sqrt(size), -v[2] / F.sqrt(size)))

    bones = [
        ("leftUpperArm", unit(L_SHO, L_ELB)), ("leftLowerArm", unit(L_ELB, L_WRI)), ("rightUpperArm", unit(R_SHO, R_ELB)), ("rightLowerArm", unit(R_ELB, R_WRI)),
        ("leftHand", unit(L_WRI, L_HAND + 9, hand_aims(xyz, L_HAND))), ("rightHand", unit(R_WRI, R_HAND + 9, hand_aims(xyz, R_HAND))),
    ]
    return F.array(*(F.struct(F.lit(n).alias("bone"), d.alias("dir")) for n, d in bones))


def mirror(xyz: Column) -> Column:
    """The signer's own view."""
    return F.transform(xyz, lambda v, i: F.when(i % 3 == 0, -v).otherwise(v))


def lerp(a: Column, b: Column, w: Column) -> Column:
    return F.zip_with(a, b, lambda p, q: p + (q - p) * w)
