"""Extraction in several runs, one of which breaks off, and playback of saved timelines."""

import pytest
from pyspark.sql import functions as F

from poseframes.functions.paths import clip_key
from poseframes.operators import extraction as X
from poseframes.operators import playback as B
from poseframes.sources import attempts as A
from poseframes.sources import clips as S
from poseframes.sources import results as R
from poseframes.streaming.ingest import RAW

PATHS = ["Animals/1. Dog/a.MOV", "Animals/2. Cat/b.mp4", "Greetings/3. Hello/a.MOV", "Greetings/note.txt", "_zips/c.mp4", "Animals/1. Dog/no frames.mov"]


def tables(spark):
    paths = spark.createDataFrame([(p,) for p in PATHS], "rel_path string")
    raw = spark.createDataFrame([(0, i, 25.0, [(0.5, 0.5, 0.5, 1.0)] * 33, None, None) for i in range(6)], RAW).drop("clip_id")
    return paths, raw.crossJoin(paths.where("rel_path NOT LIKE '%no frames%'"))


def test_runs_add_up(spark, tmp_path):
    paths, raw = tables(spark)
    store = str(tmp_path / "store")
    first = X.extract(X.choose_videos(paths, limit=2), raw, store, 1)
    assert [(r["archive"], r["outcome"]) for r in first.orderBy("seq").collect()] == [("Animals", "success"), ("Animals", "failed")]
    second = X.extract(X.choose_videos(paths), raw, store, 2)
    assert [(r["run_id"], r["archive"], r["outcome"]) for r in second.orderBy("seq").collect()] == [(2, "Animals", "stored"), (2, "Animals", "failed"), (2, "Animals", "success"), (2, "Greetings", "success")]
    clips, frames = X.stored_clips(spark, store)
    key = {r["rel_path"]: r["k"] for r in paths.select("rel_path", clip_key(F.col("rel_path")).alias("k")).collect()}
    assert {(r["source"], r["label"], r["fps"], r["n_frames"]) for r in clips.collect()} == {(key[PATHS[0]], "dog", 12.5, 3), (key[PATHS[1]], "cat", 12.5, 3), (key[PATHS[2]], "hello", 12.5, 3)}
    assert frames.count() == 9 and frames.select("clip_id").distinct().count() == 3
    log = str(tmp_path / "log")
    for x in (first, second):
        A.append_attempts(x.drop("source"), log)
    assert {r["name"] for r in A.archives_done(A.read_attempts(spark, log)).collect()} == {"Animals", "Greetings"}


def test_a_run_that_breaks_off_before_the_heads(spark, tmp_path):
    paths, raw = tables(spark)
    store = str(tmp_path / "store")
    videos = X.choose_videos(paths, categories=["greetings"])
    frames = X.assemble_keypoints(X.sample_frames(raw.join(videos, "rel_path"))).withColumn("clip_id", X.clip_id_of("source"))
    S.write_frames(frames, f"{store}/run=1")
    assert X.extract(videos, raw, store, 2).first()["outcome"] == "success"
    assert X.stored_clips(spark, store)[1].count() == 3


def test_only_the_subset(spark):
    paths, _ = tables(spark)
    meta = spark.createDataFrame([("cat", "x/b.mp4", True), ("dog", "y/a.MOV", False)], "label string, video_path string, include_50 boolean")
    assert [r["rel_path"] for r in X.choose_videos(paths, meta).collect()] == [PATHS[1]]


def test_saved_timelines_with_an_unknown_word(spark, tmp_path):
    word = lambda name, start, end: {"word": name, "cluster_id": 0, "start": start, "end": end, "duration": end - start}
    rows = [("x/a.mp4", [word("IDLE", 0.0, 1.0), word("UP", 1.0, 2.0)])]
    kinds = "video string, words array<struct<word: string, cluster_id: int, start: double, end: double, duration: double>>"
    R.write_timelines(spark.createDataFrame(rows, kinds), str(tmp_path / "t"))
    poses = spark.createDataFrame([("IDLE", [0.0, 0.0]), ("UP", [1.0, 2.0])], "name string, average_pose array<double>")
    got = {r["step"]: r for r in B.play_stored(R.read_timelines(spark, str(tmp_path / "t")), poses, 20).collect()}
    assert got[9]["pose"] == pytest.approx([(0.9 - 0.7) / 0.3, 2 * (0.9 - 0.7) / 0.3]) and got[20]["word"] == "UP" and got[0]["name"] == "a.mp4"
    with pytest.raises(ValueError, match="UP"):
        B.play_stored(R.read_timelines(spark, str(tmp_path / "t")), poses.where("name = 'IDLE'"))
