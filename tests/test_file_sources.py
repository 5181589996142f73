"""Deep trees listed by tasks, and NumPy archives through their own source."""

import os

import numpy as np
import pytest

from poseframes.sources import catalog as C
from poseframes.sources import files as D


def test_a_deep_tree_equals_a_plain_walk(spark, tmp_path):
    root = tmp_path / "a tree"
    want = {}
    for i in range(300):
        rel = "/".join([f"d {i % 3}", *(f"l{j}" for j in range(i % 7)), f"é{i}" + [".mp4", ".MOV", ".txt"][i % 3]])
        (root / rel).parent.mkdir(parents=True, exist_ok=True)
        (root / rel).write_bytes(b"x" * i)
        want[rel] = i
    (root / "empty" / "folders").mkdir(parents=True)
    (root / "_zips").mkdir()
    (root / "_zips" / ".hidden.mp4").write_bytes(b"")
    want["_zips/.hidden.mp4"] = 0
    assert {os.path.relpath(os.path.join(d, f), root) for d, _, files in os.walk(root) for f in files} == set(want)
    for k, start in enumerate((str(root), f"file://{root}/")):
        got = D.walk(spark, start, str(tmp_path / f"scratch{k}"))
        assert {r["rel_path"]: r["size"] for r in got.collect()} == want
    assert C.media_files(got).count() == 200


def test_an_empty_tree(spark, tmp_path):
    (tmp_path / "t").mkdir()
    assert D.walk(spark, str(tmp_path / "t"), str(tmp_path / "s")).count() == 0


def save(path, n=2, label="bird", shape=(57, 3), **more):
    xyz = np.arange(n * shape[0] * shape[1], dtype=np.float32).reshape(n, *shape)
    np.savez(path, **{"xyz": xyz, "mask": np.ones((n, 57), bool), "fps": np.float32(10), "label": label, "source": path.name} | more)
    return xyz


def test_archives(spark, tmp_path):
    folder = tmp_path / "npz"
    folder.mkdir()
    D.register(spark)
    xyz = save(folder / "a.npz")
    save(folder / "b.npz", 300, "cat")
    save(folder / "half.tmp.npz")
    save(folder / "wide.npz", shape=(58, 3))
    save(folder / "pickled.npz", label=np.array([{"a": 1}], dtype=object))
    (folder / "broken.npz").write_bytes(b"PK no archive")
    (folder / "note.txt").write_text("no archive")
    read = spark.read.format("pose_npz")
    for size in (1, 1 << 30):
        frames = read.option("partitionBytes", size).load(str(folder))
        got = sorted(frames.collect(), key=lambda r: (r["source"], r["frame_idx"]))
        assert [(r["source"], r["frame_idx"]) for r in got] == [("a.npz", 0), ("a.npz", 1), *(("b.npz", i) for i in range(300))]
        assert got[1]["xyz"] == xyz[1].reshape(-1).tolist() and got[1]["fps"] == 10 and got[1]["label"] == "bird" and all(got[1]["mask"])
        assert frames.rdd.getNumPartitions() == (5 if size == 1 else 1)
    heads = {os.path.basename(r["path"]): r for r in spark.read.format("pose_npz").option("headers", True).load(f"file://{folder}").collect()}
    assert {k: (h["n_frames"], h["error"] is None) for k, h in heads.items()} == {"a.npz": (2, True), "b.npz": (300, True), "wide.npz": (None, False), "pickled.npz": (None, False), "broken.npz": (None, False)}
    assert "58" in heads["wide.npz"]["error"]
    with pytest.raises(Exception, match="broken|zip|magic|pickle|shapes"):
        spark.read.format("pose_npz").option("badFiles", "fail").load(str(folder)).collect()


def test_written_files_are_read(spark, tmp_path):
    rows = [(f"{i}.npz", bytes([i]) * 10) for i in range(20)]
    D.write_files(spark.createDataFrame(rows, "path string, content binary").repartition(3), str(tmp_path / "out"))
    assert {f.name: f.read_bytes() for f in (tmp_path / "out").iterdir()} == dict(rows)
