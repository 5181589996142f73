"""What keeps tasks and driver small on larger tables."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from poseframes.operators import features as X
from poseframes.operators import playback as B
from poseframes.plans import timeline_queries as Q
from poseframes.plans.views import keypoint_frames, table
from poseframes.sources import clips as S

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_archives_are_packed_without_frames_on_the_driver(spark):
    frames = keypoint_frames(spark, SF).select("clip_id", "frame_idx", "xyz", "mask")
    assert "Broadcast" not in plan(S.pack_npz(table(spark, SF, "clips"), frames))


def test_instants_of_the_scrub_bar_are_not_sorted(spark):
    words = [(c, p, "abcd"[(c + p) % 4], *ends) for c in range(9) for p, ends in enumerate([(0.0, 1.0), (1.0, 1.0), (0.5, 0.25 * c), (2.0, 3.0 - c / 4)][: 1 + c % 4])]
    words += [(20, 0, "a", 0.0, 0.0), (21, 0, "a", -2.0, -1.0), (21, 1, "b", -1.0, -0.5), (22, 0, "a", 0.0, 5.0), (22, 1, "b", 5.0, 0.0)]
    w = spark.createDataFrame(words, "clip_id long, pos int, word string, start double, end double")
    key = lambda df: sorted(map(tuple, df.select("clip_id", "step", "t", "word", "next_word", "weight").collect()), key=lambda r: r[:2])
    assert key(B.scrub(w, 40)) == key(B.pose_at_time(B.playback_grid(w, 40), w))
    made = plan(Q._at(spark, SF)).split("Generate explode(sequence")[0]  # what is done with the instants
    assert "Sort" not in made and "Exchange" not in made and "Window" not in made


def test_poses_are_blended_where_they_are_checked(spark):
    poses = spark.createDataFrame([("a", [0.0, 1.0]), ("b", [4.0, -1.0])], "name string, average_pose array<double>")
    at = spark.createDataFrame([(1, "a", "b", 0.5), (2, "a", None, 0.0), (3, "b", "gone", 0.0), (4, "b", "gone", 0.5), (5, "gone", "a", 0.0)], "clip_id int, word string, next_word string, weight double")
    got = {r["clip_id"]: r["pose"] for r in B.playback_pose(at, poses).collect()}
    assert got == {1: [2.0, 0.0], 2: [0.0, 1.0], 3: [4.0, -1.0], 4: None}
    checked = plan(B.playback_pose(at, poses).select(X.weighted_sum("pose")))
    assert checked.count("ArrowEvalPython") == 1  # poses do not go to the JVM and back


def test_frames_are_worked_on_in_slices():
    b = pa.RecordBatch.from_pydict({"x": list(range(3 * X.ROWS + 5))})
    parts = list(X.slices([b]))
    assert max(p.num_rows for p in parts) <= X.ROWS and pa.Table.from_batches(parts).column("x").to_pylist() == b.column("x").to_pylist()


def test_weighted_sums_over_slices(spark):
    rows = [None if i % 7 == 0 else [float(i + j) for j in range(i % 4)] for i in range(2 * X.ROWS + 9)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v array<double>").coalesce(1)
    got = {r["i"]: r["s"] for r in df.select("i", X.weighted_sum("v").alias("s")).collect()}
    assert all(got[i] is None if r is None else np.isclose(got[i], sum((j + 1) * v for j, v in enumerate(r))) for i, r in enumerate(rows))
    assert df.agg(F.count("*")).first()[0] == len(rows)
