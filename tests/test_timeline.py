"""Hand-worked clips, and properties on random ones."""

import random

import pytest

from poseframes.operators import timeline as L
from poseframes.sources import clips as S

GOLDEN = [
    ([0, 0, 1, 1, 1, 2, 1, 1, 0, 0], [(0, 0.0, 0.2), (1, 0.2, 0.8), (0, 0.8, 1.0)]),
    ([1, 1, 1, 1], [(0, 0.0, 0.0), (1, 0.0, 0.4), (0, 0.4, 0.5)]),
    ([0, 0, 0], [(0, 0.0, 0.3)]),
    ([1, 1, 0, 0, 2, 2], [(0, 0.0, 0.2), (2, 0.2, 0.4), (0, 0.4, 0.5)]),
    ([1, 1, 2, 2, 0, 0], [(0, 0.0, 0.0), (1, 0.0, 0.2), (2, 0.2, 0.4), (0, 0.4, 0.6)]),
    ([1, 1, 1, 3, 5, 5, 5], [(0, 0.0, 0.0), (1, 0.0, 0.4), (5, 0.3, 0.7), (0, 0.7, 0.8)]),
    ([0, 1, 1, 5, 5, 0], [(0, 0.0, 0.1), (1, 0.1, 0.3), (5, 0.3, 0.5), (0, 0.5, 0.6)]),
]


def run(spark, clips):
    frames = spark.createDataFrame([(c, i, v) for c, ids in enumerate(clips) for i, v in enumerate(ids)], "clip_id long, frame_idx long, cluster_id int")
    heads = spark.createDataFrame([(c, 10.0) for c in range(len(clips))], "clip_id long, fps float")
    names = spark.createDataFrame([(i, f"w{i}") for i in range(6)], "cluster_id int, name string")
    out = {}
    for r in sorted(L.encode(frames, heads, names, 0).collect(), key=lambda r: (r["clip_id"], r["pos"])):
        out.setdefault(r["clip_id"], []).append((r["cluster_id"], r["start"], r["end"]))
    return out


def test_golden(spark):
    got = run(spark, [ids for ids, _ in GOLDEN])
    assert [got[i] for i in range(len(GOLDEN))] == [w for _, w in GOLDEN]


def test_properties(spark):
    rng = random.Random(1)
    clips = [[rng.choice([0, 0, 1, 1, 2, 5]) for _ in range(rng.randint(1, 40))] for _ in range(60)]
    got = run(spark, clips)
    assert set(got) == set(range(60))
    for words in got.values():
        assert words[0][0] == 0 and words[-1][0] == 0 and words[0][1] == 0
        assert all(a[1] <= b[1] for a, b in zip(words, words[1:]))


def test_even_window_is_refused(spark):
    with pytest.raises(ValueError):
        L.median_smooth(spark.createDataFrame([], "clip_id long, frame_idx long, cluster_id int"), 4)


def test_one_shuffle(spark):
    frames = spark.createDataFrame([(c % 9, c, c % 4) for c in range(300)], "clip_id long, frame_idx long, cluster_id int")
    plan = L.pad_idle(L.trim_to_idle(L.segments_of(frames, 0), 0), 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1, plan


@pytest.mark.parametrize("piece", [1, 2, 3, 10, 1000])
def test_pieces_of_long_recordings(spark, piece):
    rng = random.Random(piece)
    rows = []
    for c in range(40):
        at = rng.randint(0, 5)
        for _ in range(rng.randint(1, 60)):
            rows.append((c, at, rng.choice([0, 0, 1, 2, 2, 5])))
            at += rng.choice([1, 1, 1, 2, 30])  # frames may be missing, whole pieces of them
    frames = spark.createDataFrame(rows, "clip_id long, frame_idx long, cluster_id int")
    whole = sorted(L.run_length(L.median_smooth(L.by_clip(frames))).select("clip_id", "start", "end", "cluster_id", "clip_end").collect())
    assert sorted(L.run_length_in_pieces(frames, piece).select("clip_id", "start", "end", "cluster_id", "clip_end").collect()) == whole
    assert sorted(L.segments_of(frames, 0, piece=piece).collect()) == sorted(L.segments_of(frames, 0).collect())


def test_stored_in_buckets_no_shuffle(spark, tmp_path):
    rows = [(c % 9, c // 9, c % 4) for c in range(300)]
    frames = spark.createDataFrame(rows, "clip_id long, frame_idx long, cluster_id int")
    heads = spark.createDataFrame([(c, 10.0, f"s{c}", 34) for c in range(9)], "clip_id long, fps float, source string, n_frames long")
    names = spark.createDataFrame([(i, f"w{i}") for i in range(4)], "cluster_id int, name string")
    path = str(tmp_path / "store")
    clips, stored = S.write_bucketed(spark, "test_buckets", heads, frames, path, 4)
    want = sorted(L.encode(frames, heads, names, 0).collect())
    assert sorted(L.encode(stored, clips, names, 0, dealt=True).collect()) == want
    other = spark.newSession()
    spark.sql("DROP TABLE test_buckets_frames")
    spark.sql("DROP TABLE test_buckets_clips")
    clips, stored = S.open_bucketed(other, "test_buckets", path, 4)
    assert sorted(L.encode(stored, clips, other.createDataFrame(names.collect(), names.schema), 0, dealt=True).collect()) == want
    plan = L.word_times(L.pad_idle(L.trim_to_idle(L.segments_of(stored, 0, True), 0), 0), clips)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "Bucketed: true" in plan, plan
