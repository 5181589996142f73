"""Samples, fits and profiles against plain loops, and their plans."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from poseframes.operators import clusters as K
from poseframes.plans import cluster_queries as Q

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_k_is_swept_and_fitted(spark):
    scores = {r["k"]: r["score"] for r in Q.QUERIES["A7_sweep_k"](spark, SF).collect()}
    assert sorted(scores) == list(range(12, 61, 6)) and all(-1 <= s <= 1 for s in scores.values())
    (row,) = Q.QUERIES["A12_fit_summary_swept"](spark, SF).collect()
    assert row["k"] in scores and -1 <= row["silhouette"] <= 1 and row["idle"] == "IDLE" and row["frames"] == Q.table(spark, SF, "frame_clusters").count()


def lloyd(x, first, rounds):
    c = x[first].copy()
    for _ in range(rounds):
        near = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
        c = np.array([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(len(c))])
    far = ((x[:, None] - c[None]) ** 2).sum(2)
    return c, np.bincount(far.argmin(1), minlength=len(c)), far.min(1).sum()


def test_all_starts_at_once_are_the_single_fits(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(size=(80, 5)) + 3 * rng.normal(size=5) for _ in range(6)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1001, [None, 1.0, 1.0, 1.0, 1.0])], "i int, scaled array<double>").repartition(7)
    fits = K.fit_starts(df, [3, 6], 4, ["i"], rounds=30)
    assert fits.models == [(k, s) for k in (3, 6) for s in range(4)]
    for (k, s), c, n, inertia in zip(fits.models, fits.centres, fits.counts, fits.inertia, strict=True):
        first = sorted(range(len(x)), key=lambda i: (hashlib.md5(f"0:{s}:{i}".encode()).hexdigest(), i))[:k]
        want = lloyd(x, first, 30)
        assert np.allclose(c, want[0]) and (n == want[1]).all() and inertia == pytest.approx(want[2])
    for k in (3, 6):
        assert fits.inertia[fits.best(k)] <= min(f for m, f in zip(fits.models, fits.inertia, strict=True) if m[0] == k) * (1 + 1e-5)
    centers = K.fit_kmeans(df, 6, ["i"], starts=4)
    got = K.assign_clusters(df.where("i < 1000"), centers, "scaled").groupBy("cluster_id").agg(F.count("*").alias("n")).collect()
    assert {r["cluster_id"]: r["n"] for r in got} == {r["cluster_id"]: r["n"] for r in centers.collect()}


def test_fits_of_few_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [5.0, 5.0])], "i int, scaled array<double>")
    assert sorted(r["n"] for r in K.fit_kmeans(df, 5, ["i"]).collect()) in ([0, 1, 2], [1, 2, 0])
    assert K.fit_kmeans(df.where("i > 9"), 5, ["i"]).count() == 0


def test_silhouettes_together_and_alone(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(90, 3))
    labels = [np.arange(90) % 2, np.arange(90) // 30, np.zeros(90, int), np.r_[np.zeros(89, int), 1]]
    got = K.silhouettes(spark.range(1), x, labels)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    for y, s in zip(labels, got, strict=True):
        if y.max() == 0:
            assert s is None
            continue
        out = []
        for i in range(90):
            own = (y == y[i]) & (np.arange(90) != i)
            other = min(d[i, y == c].mean() for c in set(y) - {y[i]})
            out.append((other - d[i, own].mean()) / max(other, d[i, own].mean()) if own.any() else 0)
        assert s == pytest.approx(np.mean(out))


def test_silhouette_of_rows_in_order_of_label(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=3) + 4 * (i >= 4200)).tolist(), int(i >= 4200)) for i in range(5000)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = Q.QUERIES["A6_silhouette"](spark, str(tmp_path)).first()["silhouette"]
    taken = K.fit_sample(Q.table(spark, str(tmp_path), "embeddings"), 4000, ["vec_id"]).collect()
    x, c = np.array([r["embedding"] for r in taken]), np.array([r["label"] for r in taken])
    assert len(x) == 4000 and set(c) == {0, 1}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    own = np.where(c == 0, d[:, c == 0].sum(1), d[:, c == 1].sum(1)) / (np.bincount(c)[c] - 1)
    other = np.where(c == 0, d[:, c == 1].mean(1), d[:, c == 0].mean(1))
    assert abs(got - ((other - own) / np.maximum(own, other)).mean()) < 1e-5


@pytest.mark.parametrize(("digits", "few"), [(3, 2000), (1, 5), (2, 0), (16, 3)])
def test_samples_are_exact(spark, monkeypatch, digits, few):
    monkeypatch.setattr(K, "_DIGITS", digits)
    monkeypatch.setattr(K, "_FEW", few)
    df = spark.range(700).select("id", (F.col("id") % 3).alias("x"))
    order = sorted(range(700), key=lambda i: (hashlib.md5(f"7:{i}".encode()).hexdigest(), i))
    for n in (0, 1, 17, 350, 699, 700, 900):
        assert sorted(r["id"] for r in K.fit_sample(df, n, ["id"], 7).collect()) == sorted(order[:n])


def test_a_sample_sorts_few_rows(spark):
    df = spark.range(60_000)
    sample = K.fit_sample(df, 20_000, ["id"])
    text = plan(sample)
    assert sample.count() == 20_000 and "20000" not in text and "Exchange hashpartitioning" not in text


def test_top_signs_of_a_large_cluster(spark):
    """A cluster of 30,000 clips, of which the first 20,000 frames count; its clips are not sorted."""
    clips = spark.range(30_000).select((F.col("id") * 1_000_003 % 30_011).alias("clip_id"), F.lit(0).alias("cluster_id"))
    clips = clips.unionByName(spark.range(50).select(F.col("id").alias("clip_id"), F.lit(1).alias("cluster_id")))
    frames = clips.withColumn("label", F.concat(F.lit("sign "), (F.col("clip_id") % 13).cast("string"))).withColumn("_", F.explode(F.sequence(F.lit(0), F.col("clip_id") % 3)))
    got = {(r["cluster_id"], r["rank"]): (r["label"], r["n"]) for r in K.cluster_top_signs(frames).collect()}
    left, counts = 20_000, {}
    for c in sorted(r["clip_id"] for r in clips.where("cluster_id = 0").collect()):
        n = min(c % 3 + 1, left)
        counts[f"sign {c % 13}"] = counts.get(f"sign {c % 13}", 0) + n
        left -= n
        if not left:
            break
    want = sorted(counts.items(), key=lambda x: -x[1])[:8]
    assert [got[0, i + 1][1] for i in range(8)] == [n for _, n in want] and {got[0, i + 1] for i in range(7)} <= set(counts.items()) and (1, 8) in got
    few = K._ends(frames.groupBy("cluster_id", "clip_id").agg(F.any_value("label").alias("label"), F.count("*").alias("n")), 20_000)
    assert [e[0] for e in few] == [0] and few[0][2] - few[0][1] < 3000
    text = re.sub(r"#\d+L?", "", plan(K.cluster_top_signs(frames)))
    summed = re.search(r"\(\d+\) Window\n.*\nArguments: \[sum\(n\)", text)  # the only sum in order of clips, over what a filter leaves
    assert summed and "(clip_id >= _from)" in text and text.count("Arguments: [sum(n)") == 1
