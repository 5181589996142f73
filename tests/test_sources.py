"""Sources on real files, and ingestion that is interrupted, repeated or started anew."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from poseframes.operators import timeline as L
from poseframes.sources import attempts as A
from poseframes.sources import catalog as C
from poseframes.sources import clips as S
from poseframes.sources import results as R
from poseframes.streaming.ingest import RAW, ingest_new_clips, new_frames, read_store, stored_clips


def test_catalogue_over_many_lines(spark, tmp_path):
    files = [{"key": n, "size": 1_500_000, "links": {"self": "u"}} for n in ("A_1of2.zip", "B.ZIP", "readme.md")]
    (tmp_path / "c.json").write_text(json.dumps({"files": files}, indent=1))
    got = C.read_archive_catalog(spark, str(tmp_path / "c.json")).collect()
    assert {(r["name"], r["size_mb"], r["category"]) for r in got} == {("A_1of2.zip", 2, "A"), ("B.ZIP", 2, "B.ZIP")}


def test_media_below_a_folder_of_any_name(spark, tmp_path):
    root = tmp_path / "it's a folder"
    for name in ("x/1. Bird/a.MOV", "x/_zips/b.mp4", "c.mkv", "x/note.txt"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"0")
    for start in (str(root), f"file://{root}/"):
        assert {r["rel_path"] for r in C.list_media(spark, start).collect()} == {"x/1. Bird/a.MOV", "c.mkv", "x/note.txt"}  # Spark leaves out names with a low line in front, and media_files drops _zips anyway
    assert {(r["rel_path"], r["label"]) for r in C.media_files(C.list_media(spark, str(root))).collect()} == {("x/1. Bird/a.MOV", "bird"), ("c.mkv", "unknown")}


def test_numpy_archives(spark, tmp_path):
    xyz = np.arange(2 * 57 * 3, dtype=np.float32).reshape(2, 57, 3)
    for name in ("a.npz", "half.tmp.npz"):
        np.savez(tmp_path / name, xyz=xyz, mask=np.ones((2, 57), bool), fps=np.float32(10), label="bird", source=name)
    (tmp_path / "broken.npz").write_bytes(b"PK no archive")
    got = sorted(S.read_npz_clips(spark, str(tmp_path)).collect(), key=lambda r: r["frame_idx"])
    assert [(r["source"], r["label"], r["fps"], r["frame_idx"]) for r in got] == [("a.npz", "bird", 10.0, 0), ("a.npz", "bird", 10.0, 1)]
    assert got[1]["xyz"] == xyz[1].reshape(-1).tolist() and all(got[0]["mask"])


def test_a_frame_of_another_width_fails_the_write(spark, tmp_path):
    clips = spark.createDataFrame([(1, "a", 10.0, "s", 1)], "clip_id long, label string, fps double, source string, n_frames long")
    frames = spark.createDataFrame([(1, 0, [0.0] * 170, [True] * 57)], "clip_id long, frame_idx long, xyz array<double>, mask array<boolean>")
    with pytest.raises(Exception, match="not 57 points: clip 1, frame 0"):
        S.write_clips(clips, frames, str(tmp_path / "store"))


def test_archives_done_and_restart(spark):
    rows = [(1, i, "a" if i < 5 else "b", "failed") for i in range(1, 10)] + [(2, 1, "b", "success"), (2, 2, "c", "failed")]
    done = A.archives_done(spark.createDataFrame(rows, "run_id long, seq long, archive string, outcome string"))
    assert {r["name"] for r in done.collect()} == {"a", "b", "c"}
    alone = A.archives_done(spark.createDataFrame(rows[:9], "run_id long, seq long, archive string, outcome string"))
    assert {r["name"] for r in alone.collect()} == {"a"}
    archives = spark.createDataFrame([("a", 1), ("d", 2)], "name string, size_mb long")
    assert [r["name"] for r in C.pending_archives(archives, done).collect()] == ["d"]
    assert C.pending_archives(archives, done, restart=True).count() == 2
    with pytest.raises(ValueError):
        C.require_any(archives.where("false"))


def test_overwrite_and_keep_all(spark):
    videos, stored = spark.createDataFrame([("k1",), ("k2",)], "key string"), spark.createDataFrame([("k1",)], "key string")
    assert [r["key"] for r in S.uncached(videos, stored, "key").collect()] == ["k2"]
    assert S.uncached(videos, stored, "key", overwrite=True).count() == 2
    frames = spark.createDataFrame([(1, i, c) for i, c in enumerate([1, 1, 0, 0, 2, 2, 0, 0, 3, 3])], "clip_id long, frame_idx long, cluster_id int")
    runs = L.stretch_runs(L.merge_adjacent_runs(L.drop_short_runs(L.run_length(L.by_clip(frames)), 0)))
    kept = lambda **k: [r["cluster_id"] for r in L.trim_to_idle(runs, 0, **k).orderBy("start").collect()]
    assert kept() == [0, 2, 0] and kept(keep_all=True) == [1, 0, 2, 0, 3]


def test_timelines_as_a_list(spark, tmp_path):
    words = [{"word": "IDLE", "cluster_id": 0, "start": 0.0, "end": 1.0, "duration": 1.0}]
    (tmp_path / "t.json").write_text(json.dumps([{"video": "x/a.mp4", "words": words}, {"video": "b.mp4", "words": words}], indent=2))
    assert {(r["name"], r["pos"], r["word"]) for r in R.read_timelines(spark, str(tmp_path), multi_line=True).collect()} == {("a.mp4", 0, "IDLE"), ("b.mp4", 0, "IDLE")}


def raw(spark, *clips):
    return spark.createDataFrame([(c, i, 10.0, None, None, None) for c in clips for i in range(3)], RAW)


def test_no_clip_twice(spark, tmp_path):
    source, store, marks = (str(tmp_path / n) for n in ("in", "store", "marks"))
    frames = lambda: {r["clip_id"]: r["n"] for r in spark.read.parquet(store).groupBy("clip_id").agg(F.count("*").alias("n")).collect()}
    raw(spark, 1, 2).coalesce(1).write.mode("append").parquet(source)
    raw(spark, 2, 3).coalesce(1).write.mode("append").parquet(source)  # clip 2 is in two files of one batch
    ingest_new_clips(spark, source, store, marks)
    assert frames() == {1: 3, 2: 3, 3: 3}
    raw(spark, 3, 4).coalesce(1).write.mode("append").parquet(source)  # clip 3 comes again later
    ingest_new_clips(spark, source, store, marks)
    assert frames() == {1: 3, 2: 3, 3: 3, 4: 3}
    ingest_new_clips(spark, source, store, f"{marks}-lost")  # with a checkpoint that starts at 0 again
    assert frames() == {1: 3, 2: 3, 3: 3, 4: 3}


def test_a_clip_in_many_files_triggers_and_calls(spark, tmp_path):
    source, store, marks = (str(tmp_path / n) for n in ("in", "store", "marks"))
    rows = [(c, i, 25.0, [(0.1 * i, 0.2, 0.3, 1.0)] * 33, None, [(0.5, 0.5, float(c))]) for c in (1, 2, 3) for i in range(40)]
    every = {(c, i // 2) for c in (1, 2, 3) for i in range(0, 40, 2)}
    stored = lambda: sorted((r["clip_id"], r["frame_idx"]) for r in read_store(spark, store).collect())

    def put(some):
        spark.createDataFrame(some, RAW).coalesce(1).write.mode("append").parquet(source)

    for k in range(5):  # each file has a part of every clip, and some frames of the file before
        put([r for r in rows if r[1] % 10 < 8 and (r[1] % 5 == k or r[1] % 5 == k - 1)])
    ingest_new_clips(spark, source, store, marks, files_per_trigger=1)
    assert stored() == sorted(x for x in every if x[1] * 2 % 10 < 8)
    assert {(r["clip_id"], r["n_frames"], r["next_idx"]) for r in stored_clips(spark, store).collect()} == {(c, 16, 19) for c in (1, 2, 3)}
    put([r for r in rows if r[1] % 10 >= 8])  # the gaps, in a later call
    ingest_new_clips(spark, source, store, marks, files_per_trigger=1)
    assert stored() == sorted(every)
    ingest_new_clips(spark, source, store, f"{marks}-lost", files_per_trigger=2)
    assert stored() == sorted(every)
    one = read_store(spark, store).where("clip_id = 2 AND frame_idx = 3").first()
    assert one["fps"] == 12.5 and one["xyz"][0] == pytest.approx(0.6) and one["mask"] == [True] * 15 + [False] * 21 + [True] * 21


def test_a_batch_that_runs_again(spark, tmp_path):
    """The driver ends between a batch's files and the checkpoint's note of it."""
    source, store, marks = (str(tmp_path / n) for n in ("in", "store", "marks"))
    for c in (1, 2):
        raw(spark, c).coalesce(1).write.mode("append").parquet(source)
        ingest_new_clips(spark, source, store, marks)
    for name in ("1", ".1.crc"):
        (tmp_path / "marks" / "commits" / name).unlink()
    ingest_new_clips(spark, source, store, marks)
    assert sorted(r["clip_id"] for r in read_store(spark, store).collect()) == [1] * 3 + [2] * 3


def test_landmarks_are_not_shuffled(spark):
    """A frame's rows meet as keypoints, and are dealt out once."""
    batch = raw(spark, 1, 2).withColumn("_file", F.lit("a"))
    new = new_frames(batch.unionByName(batch.withColumn("_file", F.lit("b"))), raw(spark, 2).select("clip_id", F.col("idx").alias("frame_idx")))
    plan = new._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("RepartitionByExpression")
    node = new._jdf.queryExecution().optimizedPlan()
    while "RepartitionByExpression" not in node.nodeName():
        node = node.children().apply(0)
    dealt = [node.output().apply(i).name() for i in range(node.output().size())]
    assert sorted(dealt) == ["_file", "clip_id", "fps", "frame_idx", "mask", "xyz"]
    assert sorted((r["clip_id"], r["frame_idx"]) for r in new.collect()) == [(1, 0), (1, 1), (1, 2)]
