"""Features of many frames at once: a batch of frames is one matrix, a row a frame.

Array operations, since a lambda over 171 coordinates runs outside generated code and is several times
slower. Map-only, in slices of ROWS frames: a task holds a batch and the numbers of a slice, however many
frames it has.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poseframes.llm.common import bound_batches
from poseframes.params import EPS, L_ELB, L_HAND, L_SHO, L_WRI, N_HAND, N_POINTS, NOSE, R_ELB, R_HAND, R_SHO, R_WRI

WIDTH = 3 * N_POINTS
#: Frames that are worked on at once.
ROWS = 1024


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ROWS."""
    for b in batches:
        for lo in range(0, b.num_rows, ROWS):
            yield b.slice(lo, ROWS)


def matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists of this width as rows, and which lists those are: others and null ones are left out."""
    good = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == width
    if not good.all():
        column = column.filter(pa.array(good))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width), good


def lists(rows: np.ndarray, good: np.ndarray) -> pa.Array:
    """Rows as lists again, null where there was none to read."""
    offsets = np.concatenate([[0], np.cumsum(np.where(good, rows.shape[1], 0))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).reshape(-1)), mask=pa.array(~good))


#: For each point the hand it belongs to (0 left, 1 right, 2 none), and where that hand hangs.
_HAND = np.full(N_POINTS, 2)
_HAND[L_HAND : L_HAND + N_HAND], _HAND[R_HAND : R_HAND + N_HAND] = 0, 1
_WRIST = np.array([L_WRI, R_WRI, 0])
#: Joints whose angle counts, between their two neighbours: elbows, then shoulders.
_ANGLES = np.array([[L_SHO, L_ELB, L_WRI], [R_SHO, R_ELB, R_WRI], [R_SHO, L_SHO, L_ELB], [L_SHO, R_SHO, R_ELB]])


def fill_missing_hands(xyz: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """A hand without any true mask falls onto its wrist: every point is read from its own place or
    from the wrist's. ``xyz`` is frames x points x 3."""
    seen = np.stack([mask[:, _HAND == h].any(1) for h in (0, 1)] + [np.ones(len(mask), bool)], 1)
    source = np.where(seen[:, _HAND], np.arange(N_POINTS), _WRIST[_HAND])
    return np.take_along_axis(xyz.astype(np.float64), source[:, :, None], 1)


def normalise(xyz: np.ndarray) -> np.ndarray:
    """Relative to the middle of the shoulders, in units of their distance."""
    shoulders = xyz[:, [L_SHO, R_SHO]]
    width = np.linalg.norm(np.diff(shoulders, axis=1), axis=2)
    return (xyz - shoulders.mean(1, keepdims=True)) / np.maximum(width, EPS)[:, :, None]


def descriptors(norm: np.ndarray) -> np.ndarray:
    """All normalised coordinates, then seven features at a like scale: four angles in units of 45
    degrees, how far the nose is above each wrist (y points down), and the gap between the wrists."""
    corner = norm[:, _ANGLES]
    arms = corner[:, :, ::2] - corner[:, :, 1:2]
    cosine = arms.prod(2).sum(2) / (np.linalg.norm(arms, axis=3) + EPS).prod(2)
    angles = np.arccos(np.clip(cosine, -1, 1)) * (4 / np.pi)
    wrists = norm[:, [L_WRI, R_WRI]]
    height = norm[:, [NOSE], 1] - wrists[:, :, 1]
    gap = np.linalg.norm(np.diff(wrists, axis=1), axis=2)
    return np.hstack([norm.reshape(len(norm), WIDTH), angles, height, gap])


def frame_features(frames: DataFrame, *wanted: str) -> DataFrame:
    """``frames`` with the columns ``wanted``, of ``filled``, ``norm`` and ``descriptor``, in this
    order. They are null for a frame whose ``xyz`` or ``mask`` is null or of another width."""
    names = [n for n in ("filled", "norm", "descriptor") if n in wanted]
    kept = [c for c in frames.columns if c not in names]
    at, of = kept.index("xyz"), kept.index("mask")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            good = (b.column(at).value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == WIDTH) & (b.column(of).value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == N_POINTS)
            use = b.filter(pa.array(good))
            xyz, _ = matrix(use.column(at), WIDTH)
            mask, _ = matrix(use.column(of), N_POINTS)
            filled = fill_missing_hands(xyz.reshape(-1, N_POINTS, 3), mask.astype(bool))
            made = {"filled": filled.reshape(-1, WIDTH)}
            if "norm" in names or "descriptor" in names:
                norm = normalise(filled)
                made["norm"] = norm.reshape(-1, WIDTH)
                if "descriptor" in names:
                    made["descriptor"] = descriptors(norm)
            yield pa.RecordBatch.from_arrays([*b.columns, *(lists(made[n], good) for n in names)], names=[*kept, *names])

    bound_batches(frames.sparkSession)
    schema = T.StructType([*frames.select(*kept).schema.fields, *(T.StructField(n, T.ArrayType(T.DoubleType())) for n in names)])
    return frames.select(*kept).mapInArrow(run, schema)


def weighted_sum(column: Column | str) -> Column:
    """Sum of (i + 1) times element i of each list: a number that depends on every element and its
    place. Lists of a batch may differ in length; null for a null list."""

    @F.arrow_udf(T.DoubleType())
    def total(x: pa.Array) -> pa.Array:
        sums = np.zeros(len(x))
        for lo in range(0, len(x), ROWS):
            part = x.slice(lo, ROWS)
            sizes = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(sizes)
            place = np.arange(len(flat)) - np.repeat(ends - sizes, sizes) + 1
            some = sizes > 0
            if some.any():
                sums[lo : lo + ROWS][some] = np.add.reduceat(flat * place, (ends - sizes)[some])
        return pa.array(sums, mask=x.is_null().to_numpy(zero_copy_only=False))

    return total(F.col(column) if isinstance(column, str) else column)
