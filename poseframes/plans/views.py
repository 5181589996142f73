"""Deterministic views of the star-schema tables that stand for landmark recordings.

Most are one SQL text for both engines; keypoint frames are arrays here and rows of points in the
other engine, from the same rule.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poseframes.operators.features import lists, slices
from poseframes.operators.timeline import parts
from poseframes.params import N_POINTS

VIEWS = {
    "frame_clusters": (("events",), """
WITH f AS (SELECT user_id AS clip_id, event_id,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_idx,
  count(*) OVER (PARTITION BY user_id) AS n_frames FROM {events})
SELECT clip_id, frame_idx, n_frames, event_id,
  CAST(CASE
   WHEN clip_id % 37 = 13 THEN 3
   WHEN clip_id % 5 <> 0 AND frame_idx < 1 + clip_id % 4 THEN 0
   WHEN clip_id % 7 <> 0 AND frame_idx >= n_frames - (1 + clip_id % 3) THEN 0
   WHEN clip_id % 11 = 0 THEN 1 + frame_idx % 5
   WHEN event_id % 9 = 0 THEN event_id % 6
   ELSE 1 + (CAST(floor(frame_idx / (2 + clip_id % 3)) AS BIGINT) + clip_id) % 5 END AS INT) AS cluster_id
FROM f"""),
    "clips": (("events",), """
SELECT user_id AS clip_id, concat('sign ', CAST(user_id % 12 AS STRING)) AS label,
  CAST(CASE user_id % 3 WHEN 0 THEN 10.0 WHEN 1 THEN 12.5 ELSE 9.99 END AS FLOAT) AS fps,
  concat('clip_', CAST(user_id AS STRING)) AS source, count(*) AS n_frames
FROM {events} GROUP BY user_id"""),
    "media_files": (("documents",), """
SELECT doc_id, CASE WHEN doc_id % 29 = 0 THEN concat('MVI_', CAST(doc_id AS STRING), '.MOV')
  ELSE concat(
   CASE doc_id % 5 WHEN 0 THEN 'Animals' WHEN 1 THEN 'Animals 2' WHEN 2 THEN 'Greetings' WHEN 3 THEN 'Home' ELSE '_zips' END, '/',
   CASE doc_id % 4 WHEN 0 THEN concat(CAST(doc_id % 40 AS STRING), '. ') WHEN 1 THEN concat(CAST(doc_id % 40 AS STRING), '_') WHEN 2 THEN concat(CAST(doc_id % 40 AS STRING), ' - ') ELSE '' END,
   CASE doc_id % 3 WHEN 0 THEN 'Bird' WHEN 1 THEN 'Good Morning ' ELSE 'HOUSE' END, '/MVI_', CAST(doc_id AS STRING),
   CASE doc_id % 6 WHEN 0 THEN '.MOV' WHEN 1 THEN '.mp4' WHEN 2 THEN '.txt' WHEN 3 THEN '.mov' WHEN 4 THEN '.MKV' ELSE '.json' END)
  END AS rel_path
FROM {documents}"""),
    "metadata": (("documents",), """
SELECT CASE doc_id % 3 WHEN 0 THEN 'Bird' WHEN 1 THEN 'Good Morning' ELSE 'House' END AS label,
  concat('x/y/MVI_', CAST(doc_id AS STRING), CASE WHEN doc_id % 2 = 0 THEN '.MOV' ELSE '.mp4' END) AS video_path,
  doc_id % 4 <= 1 AS include_50,
  CASE WHEN doc_id % 10 < 7 THEN 'train' WHEN doc_id % 10 < 8 THEN 'val' ELSE 'test' END AS split
FROM {documents}"""),
    "archive_files": (("part",), """
SELECT p_partkey, CASE WHEN p_partkey % 43 = 0 THEN concat('helper_', CAST(p_partkey AS STRING), '.py') WHEN p_partkey % 9 = 0 THEN concat('Solo', CAST(p_partkey AS STRING), '.zip')
  ELSE concat('Cat', CAST(p_partkey % 7 AS STRING), '_', CAST(p_partkey AS STRING), 'of44.zip') END AS name,
  CAST(p_size AS BIGINT) * 41234567 + 500000 AS size_bytes
FROM {part}"""),
    "attempts": (("orders",), """
WITH o AS (SELECT o_orderkey, o_orderkey % 25 AS run_id,
  row_number() OVER (PARTITION BY o_orderkey % 25 ORDER BY o_orderdate, o_orderkey) AS seq FROM {orders})
SELECT run_id, seq, concat('arc', CAST(CAST(floor((seq - 1) / 20) AS BIGINT) AS STRING)) AS archive,
  CASE WHEN run_id % 4 = 0 AND seq <= 9 THEN 'failed'
       WHEN run_id % 4 = 1 AND seq = 1 THEN 'stored'
       WHEN run_id % 4 = 1 AND seq <= 10 THEN 'failed'
       WHEN o_orderkey % 10 = 0 THEN 'failed' WHEN o_orderkey % 10 = 1 THEN 'stored' ELSE 'success' END AS outcome
FROM o"""),
    "centroids": (("embeddings",), """
SELECT label AS cluster_id, embedding AS center FROM (
  SELECT label, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM {embeddings}) t WHERE rn = 1"""),
    "cluster_names": (("frame_clusters",), """
SELECT DISTINCT cluster_id, CASE cluster_id WHEN 0 THEN 'IDLE' WHEN 1 THEN 'LEFT_CHEST' WHEN 2 THEN 'RIGHT_FACE' WHEN 3 THEN 'BOTH_CHEST_TOGETHER'
  WHEN 4 THEN 'BOTH_ABOVE_HEAD_APART' ELSE 'BOTH_WAIST_APART' END AS name, cluster_id = 0 AS is_idle FROM {frame_clusters}"""),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view if there is one of this name, else the table."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    needs, text = VIEWS[name]
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in needs})


def with_views(names: list[str], body: str, more: list[tuple[str, str]] = []) -> str:
    """SQL for the other engine: ``body`` after the views and further named parts."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in VIEWS and name not in done:
            needs, text = VIEWS[name]
            for n in needs:
                add(n)
            done[name] = text.format(**{n: n for n in needs})

    for n in names:
        add(n)
    parts = [f"{n} AS ({t})" for n, t in [*done.items(), *more]]
    return f"WITH {', '.join(parts)} {body}" if parts else body


# ---- keypoint frames by arithmetic, in thousandths ----
_FIXED = {0: (600, 450, -100), 1: (400, 450, -100), 2: (650, 650, -100), 3: (350, 650, -100), 12: (570, 850, 0), 13: (430, 850, 0), 14: (500, 250, -300)}
_WRISTS = {
    "left": [(660, 900), (660, 550), (660, 900), (520, 560), (800, 300), (700, 590)],
    "right": [(340, 900), (340, 900), (340, 430), (480, 560), (200, 300), (300, 590)],
}


def _side(j: int) -> str:
    return "left" if j in (4, 6, 8, 10) or 15 <= j <= 35 else "right"


def _base(j: int, a: int, state: int) -> int:
    """Coordinate ``a`` of point ``j`` in a state, before jitter."""
    if j in _FIXED:
        return _FIXED[j][a]
    side = _side(j)
    wrist = (*_WRISTS[side][state], -150)[a]
    if j in (4, 5):
        return wrist
    if j <= 11:
        return wrist + ((10 if side == "left" else -10), 20, 0)[a]
    return wrist + ((j - (15 if j <= 35 else 36)) * 17 + a * 29) % 61 - 30


def _spread(df: DataFrame) -> DataFrame:
    """Rows of ids over all cores. Adaptive execution would fold the few bytes of the window's shuffle
    into one task, and all that is made of a row would follow it there."""
    return df.repartition(parts(df.sparkSession))


def keypoint_frames(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """``clip_id, frame_idx, n_frames, event_id, cluster_id, xyz, mask``; of the rows ``of`` and with
    their columns, if given."""
    fc = _spread(table(spark, sf_dir, "frame_clusters") if of is None else of)
    states = np.array([[_base(j, a, s) for j in range(N_POINTS) for a in range(3)] for s in range(6)])
    joint, axis = np.divmod(np.arange(3 * N_POINTS), 3)
    source = np.where(joint <= 14, joint, np.where(joint <= 35, 4, 5))
    at = [fc.columns.index(c) for c in ("event_id", "cluster_id")]

    def run(batches):
        for b in slices(batches):
            e, state = (b.column(i).to_numpy() for i in at)
            jitter = np.where(joint < 2, 0, (e[:, None] * 31 + source * 7 + axis * 13) % 41 - 20)
            ok = np.hstack([(e[:, None] * 13 + np.arange(15) * 37) % 100 >= 30, np.repeat([e % 4 != 0], 21, 0).T, np.repeat([e % 5 != 0], 21, 0).T])
            gone = (joint >= 15) & ~ok[:, joint]
            xyz = np.where(gone, 0.0, (states[state] + jitter) / 1000.0)
            every = np.ones(len(e), bool)
            yield pa.RecordBatch.from_arrays([*b.columns, lists(xyz, every), lists(ok, every)], names=[*b.schema.names, "xyz", "mask"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fc.schema.fields)
    return fc.mapInArrow(run, f"{kinds}, xyz array<double>, mask array<boolean>")


def raw_landmarks(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """The inverse: landmarks of source frames, some without a body or a hand; of the rows ``of`` of
    ``frame_clusters`` and with what columns they have besides, if given."""
    from poseframes.params import UPPER_BODY

    f = keypoint_frames(spark, sf_dir, of)
    more = [c for c in f.columns if c not in ("clip_id", "frame_idx", "n_frames", "event_id", "cluster_id", "xyz", "mask")]
    e = F.col("event_id")

    def landmark(i: int):
        if i not in UPPER_BODY:
            zero = F.lit(0.0)
            return F.struct(zero.alias("x"), zero.alias("y"), zero.alias("z"), F.lit(1.0).alias("visibility"))
        j = UPPER_BODY.index(i)
        seen = F.when((e + j) % 11 != 0, ((e * 13 + j * 37) % 100) / F.lit(100.0))
        return F.struct(*(F.get("xyz", F.lit(3 * j + a)).alias(n) for a, n in enumerate("xyz")), seen.alias("visibility"))

    hand = lambda start: F.transform(F.sequence(F.lit(start), F.lit(start + 20)), lambda j: F.struct(F.get("xyz", j * 3).alias("x"), F.get("xyz", j * 3 + 1).alias("y"), F.get("xyz", j * 3 + 2).alias("z")))
    fps = F.element_at(F.array(*map(F.lit, (25.0, 30.0, 29.97, 0.0, 5.0))), (F.col("clip_id") % 5 + 1).cast("int"))
    return f.select(
        "clip_id", F.col("frame_idx").alias("idx"), fps.alias("src_fps"), "event_id", F.when(e % 501 != 0, F.array(*(landmark(i) for i in range(33)))).alias("body"),
        F.when(e % 4 != 0, hand(15)).alias("left_hand"), F.when(e % 5 != 0, hand(36)).alias("right_hand"), *more,
    )


def _case(values: dict[str, str], other: str) -> str:
    return "CASE " + " ".join(f"WHEN {k} THEN {v}" for k, v in values.items()) + f" ELSE {other} END"


def _sql_value(a: int) -> str:
    wrist = lambda side: "-150" if a == 2 else _case({f"cluster_id = {s}": str(w[a]) for s, w in enumerate(_WRISTS[side])}, "0")
    left, right = wrist("left"), wrist("right")
    base = _case(
        {f"j = {j}": str(p[a]) for j, p in _FIXED.items()} | {
            "j = 4": left, "j = 5": right, "j IN (6, 8, 10)": f"{left} + {(10, 20, 0)[a]}", "j IN (7, 9, 11)": f"{right} + {(-10, 20, 0)[a]}",
            "j BETWEEN 15 AND 35": f"{left} + ((j - 15) * 17 + {a * 29}) % 61 - 30",
        }, f"{right} + ((j - 36) * 17 + {a * 29}) % 61 - 30",
    )
    jitter = f"CASE WHEN j < 2 THEN 0 ELSE (event_id * 31 + (CASE WHEN j <= 14 THEN j WHEN j <= 35 THEN 4 ELSE 5 END) * 7 + {a * 13}) % 41 - 20 END"
    return f"CASE WHEN (j BETWEEN 15 AND 35 AND event_id % 4 = 0) OR (j >= 36 AND event_id % 5 = 0) THEN 0::DOUBLE ELSE (({base}) + ({jitter}))::DOUBLE / 1000.0::DOUBLE END"


def _pick(j: int, *names: str, table: str = "") -> str:
    return ", ".join(f"max({n}) FILTER (WHERE j = {j}) AS {n}{j}" for n in names)


#: Rows of points in the other engine: pts, then with hands filled, then normalised.
POINTS = [
    ("pts", f"SELECT clip_id, frame_idx, n_frames, event_id, cluster_id, j, {_sql_value(0)} AS x, {_sql_value(1)} AS y, {_sql_value(2)} AS z, "
     "CASE WHEN j < 15 THEN (event_id * 13 + j * 37) % 100 >= 30 WHEN j <= 35 THEN event_id % 4 <> 0 ELSE event_id % 5 <> 0 END AS ok FROM frame_clusters, (SELECT unnest(range(57)) AS j)"),
    ("heads", f"SELECT clip_id, frame_idx, {', '.join(_pick(j, 'x', 'y', 'z') for j in (0, 1, 4, 5))}, bool_or(ok) FILTER (WHERE j BETWEEN 15 AND 35) AS lok, bool_or(ok) FILTER (WHERE j >= 36) AS rok FROM pts GROUP BY clip_id, frame_idx"),
    ("filled", "SELECT p.clip_id, p.frame_idx, n_frames, event_id, cluster_id, j, " + ", ".join(f"CASE WHEN j BETWEEN 15 AND 35 AND NOT lok THEN {a}4 WHEN j >= 36 AND NOT rok THEN {a}5 ELSE {a} END AS {a}" for a in "xyz")
     + ", x0, y0, z0, x1, y1, z1 FROM pts p JOIN heads h ON p.clip_id = h.clip_id AND p.frame_idx = h.frame_idx"),
    ("norm", "SELECT clip_id, frame_idx, n_frames, event_id, cluster_id, j, " + ", ".join(f"({a} - ({a}0 + {a}1) * 0.5::DOUBLE) / greatest(sqrt((x0 - x1) * (x0 - x1) + (y0 - y1) * (y0 - y1) + (z0 - z1) * (z0 - z1)), 1e-6::DOUBLE) AS {a}" for a in "xyz") + " FROM filled"),
]
