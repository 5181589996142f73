"""Scaling, clustering and profiling of all frames."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poseframes.operators.features import ROWS, lists, matrix
from poseframes.params import EDGE_FRAC, K_SAMPLE, K_VALUES, MAX_FRAMES_FOR_FIT, SEED, SILHOUETTE_SAMPLE, STARTS, SWEEP_STARTS, TOP_SIGN_FRAMES, TOP_SIGNS

#: Centroids that may go to the tasks as one matrix; a fit has at most a few dozen (see K_VALUES).
MAX_CENTROIDS = 10_000
#: Rounds of a fit, and of those that only compare values of k.
ROUNDS, SWEEP_ROUNDS = 25, 10


def edge_flags(frames: DataFrame) -> DataFrame:
    """``edge`` for the first and last frames of each clip; ``n_frames`` is the clip's length."""
    e = F.greatest(F.lit(1), F.floor(F.col("n_frames") * F.lit(EDGE_FRAC)))
    return frames.withColumn("edge", (F.col("frame_idx") < e) | (F.col("frame_idx") >= F.col("n_frames") - e))


def fit_scaler(vectors: DataFrame, column: str) -> DataFrame:
    """One row: mean and population deviation of each feature (1 where it is zero)."""
    s = vectors.select(Summarizer.metrics("mean", "variance", "count").summary(array_to_vector(F.col(column).cast("array<double>"))).alias("s"))
    s = s.select(vector_to_array("s.mean").alias("mean"), vector_to_array("s.variance").alias("variance"), F.col("s.count").alias("n"))
    std = F.transform("variance", lambda v: F.sqrt(F.greatest(F.lit(0.0), v * (F.col("n") - 1) / F.col("n"))))
    return s.select("mean", F.transform(std, lambda x: F.when(x == 0, F.lit(1.0)).otherwise(x)).alias("std"))


def scale(vectors: DataFrame, scaler: DataFrame, column: str, out: str = "scaled") -> DataFrame:
    """``column`` with mean 0 and deviation 1; the scaler is one row."""
    df = vectors.crossJoin(F.broadcast(scaler.select(F.col("mean").alias("_mean"), F.col("std").alias("_std"))))
    return df.withColumn(out, _scaled(F.col(column), F.col("_mean"), F.col("_std"))).drop("_mean", "_std")


def _scaled(x: Column, mean: Column, std: Column) -> Column:
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def run(x: pa.Array, mean: pa.Array, std: pa.Array) -> pa.Array:
        if not len(x):
            return pa.array([], pa.list_(pa.float64()))
        m, s = (np.array(a[0].as_py(), np.float64) for a in (mean, std))  # the same in every row
        rows, good = matrix(x, len(m))
        out = np.empty(rows.shape)
        for lo in range(0, len(rows), ROWS):
            out[lo : lo + ROWS] = (rows[lo : lo + ROWS] - m) / s
        return lists(out, good)

    return run(x, mean, std)


def _digest(seed: Column, keys: list[str]) -> Column:
    return F.md5(F.concat_ws(":", seed, *(F.col(k).cast("string") for k in keys)).cast("binary"))


#: Hexadecimal digits of a digest that one count tells apart, and rows that are few enough to sort.
_DIGITS, _FEW = 3, 2_000


def fit_sample(rows: DataFrame, n: int, keys: list[str], seed: int = SEED) -> DataFrame:
    """n rows without replacement, by a digest of the seed and their keys; all if there are fewer.

    How many digests begin with each few digits tells in which of these the n-th row is; there the
    next digits are counted, until few rows are left to sort. Nothing else is sorted, and the rows stay
    where they are. Rows with equal keys are taken together, so keys should tell rows apart."""
    digest = _digest(F.lit(str(seed)), keys)
    start, left = "", n
    while True:
        inside = rows.where(digest.startswith(start)) if start else rows
        digits = F.substring(digest, len(start) + 1, _DIGITS)
        counts = sorted((r["d"], r["count"]) for r in inside.groupBy(digits.alias("d")).count().collect())  # 16 ** _DIGITS rows at most
        if sum(c for _, c in counts) <= left:
            last = None  # all of them
            break
        for d, c in counts:
            if c > left:
                break
            left -= c
        start, few = start + d, c
        if left == 0 or few <= _FEW or len(start) + _DIGITS > 32:
            order = inside.where(digest.startswith(start)).select(F.struct(digest.alias("h"), *keys).alias("place")).orderBy("place")
            last = order.limit(left).agg(F.max("place").alias("_last")) if left else None
            break
    if last is None:
        return rows.where(digest < start) if start else rows
    before, inside = (digest < start), digest.startswith(start)
    place = F.struct(digest.alias("h"), *keys)
    return rows.crossJoin(F.broadcast(last)).where(before | (inside & (place <= F.col("_last")))).select(*rows.columns)  # last is one row


@dataclass
class Fits:
    """What several fits at once have found: for each (k, start) the centres, and after the last round
    the rows of each cluster and their squared distances."""

    models: list[tuple[int, int]]
    centres: list[np.ndarray]
    counts: list[np.ndarray]
    inertia: list[float]

    def best(self, k: int) -> int:
        """The fit with the least inertia to six digits, the first start among equals."""
        own = [i for i, m in enumerate(self.models) if m[0] == k]
        return min(own, key=lambda i: (float(f"{self.inertia[i]:.6g}"), self.models[i][1]))


def _first_centres(rows: DataFrame, most: int, starts: int, keys: list[str], column: str, seed: int) -> list[np.ndarray]:
    """For each start the first ``most`` rows by a digest of seed, start and keys."""
    tried = rows.select(*keys, F.col(column).cast("array<double>").alias("_x"), F.explode(F.sequence(F.lit(0), F.lit(starts - 1))).alias("_start"))
    tried = tried.withColumn("_h", _digest(F.concat_ws(":", F.lit(str(seed)), F.col("_start").cast("string")), keys))
    rank = F.row_number().over(W.partitionBy("_start").orderBy("_h", *keys))
    got = tried.select("_start", "_x", rank.alias("_rank")).where(F.col("_rank") <= most).orderBy("_start", "_rank").toArrow()  # starts times most rows
    start, x = got["_start"].to_numpy(), np.array(got["_x"].to_pylist(), np.float64)
    return [x[start == s] for s in range(starts)]


def _partial(centres: list[np.ndarray]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of a task's rows, for each model and cluster: sums of the rows, their number, squared distances."""
    every, ends = np.concatenate(centres), np.cumsum([len(c) for c in centres])
    square = (every * every).sum(1)

    def run(batches):
        total = np.zeros((len(every), every.shape[1] + 2))
        for b in batches:
            x, _ = matrix(b.column(0), every.shape[1])
            for lo in range(0, len(x), 1024):
                part = x[lo : lo + 1024].astype(np.float64)
                far = square - 2 * part @ every.T
                own = (part * part).sum(1)
                member = np.zeros(far.shape)
                for end, c in zip(ends, centres, strict=True):
                    at = far[:, end - len(c) : end].argmin(1) + end - len(c)
                    member[np.arange(len(part)), at] = 1
                    total[:, -1] += np.bincount(at, np.maximum(0, far[np.arange(len(part)), at] + own), len(every))
                total[:, :-2] += member.T @ part
                total[:, -2] += member.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(centres)), pa.int32()), pa.array([total[e - len(c) : e].ravel() for e, c in zip(ends, centres, strict=True)], pa.list_(pa.float64()))], names=["model", "sums"])

    return run


def fit_starts(rows: DataFrame, ks: list[int], starts: int, keys: list[str], column: str = "scaled", seed: int = SEED, rounds: int = ROUNDS) -> Fits:
    """K-means for every k and start at once: each of Lloyd's rounds is one pass over the rows, which
    leaves one row a task and model for the shuffle. The first centres are rows by their digest; a
    cluster that loses all its rows stays where it was. Ends after ``rounds``, or when nothing moves.

    Rows with nulls or another length than the first centres take no part. The driver holds the centres
    of all models, some hundreds."""
    rows = rows.where(F.col(column).isNotNull() & ~F.exists(column, lambda v: v.isNull() | F.isnan(v)))
    vectors = rows.select(F.col(column).cast("array<double>").alias("_x"))
    first = _first_centres(rows, max(ks), starts, keys, column, seed)
    models = [(k, s) for k in ks for s in range(starts)]
    centres = [first[s][:k] for k, s in models]
    if not len(first[0]):
        return Fits(models, centres, [np.zeros(0)] * len(models), [0.0] * len(models))
    for turn in range(rounds + 1):
        sums = vectors.mapInArrow(_partial(centres), "model int, sums array<double>").groupBy("model").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))
        found = dict(tuple(r) for r in sums.collect())
        # sums are made of means, so counts come out not quite whole
        total = [np.array(found[m]).reshape(len(c), -1) for m, c in enumerate(centres)]
        counts, inertia = [np.rint(t[:, -2]) for t in total], [float(t[:, -1].sum()) for t in total]
        if turn == rounds:
            break
        moved = [np.where(t[:, -2:-1] > 0, t[:, :-2] / np.maximum(t[:, -2:-1], 1), c) for t, c in zip(total, centres, strict=True)]
        still = max(float(np.abs(a - b).max()) for a, b in zip(moved, centres, strict=True)) < 1e-9
        centres = moved
        if still:
            break
    return Fits(models, centres, counts, inertia)


def fit_kmeans(scaled: DataFrame, k: int, keys: list[str], column: str = "scaled", seed: int = SEED, starts: int = STARTS) -> DataFrame:
    """``cluster_id, center, n`` of k clusters, from the best of ``starts`` fits. Fewer if there are
    fewer rows."""
    fits = fit_starts(scaled, [k], starts, keys, column, seed)
    i = fits.best(k)
    centers = [(c, [float(x) for x in x], int(n)) for c, (x, n) in enumerate(zip(fits.centres[i], fits.counts[i], strict=True))]
    return scaled.sparkSession.createDataFrame(centers, "cluster_id int, center array<double>, n long")


def assign_clusters(vectors: DataFrame, centroids: DataFrame, column: str, out: str = "cluster_id") -> DataFrame:
    """The nearest centroid of each row, the least id among equals; null for a null vector, one with
    a null or of another length, and if there is no centroid. No row is shuffled: the centroids go
    to the tasks as one matrix, and more than MAX_CENTROIDS of them raise."""
    table = centroids.orderBy("cluster_id").limit(MAX_CENTROIDS + 1).collect()
    if len(table) > MAX_CENTROIDS:
        raise ValueError(f"more than {MAX_CENTROIDS} centroids")
    if not table:
        return vectors.withColumn(out, F.lit(None).cast("int"))
    ids, centers = np.array([r["cluster_id"] for r in table], np.int32), np.array([r["center"] for r in table], np.float64)
    step = max(1, (1 << 20) // centers.size)

    @F.arrow_udf(T.IntegerType())
    def nearest(x: pa.Array) -> pa.Array:
        v, good = matrix(x, centers.shape[1])
        v = v.astype(np.float64, copy=False)
        # distances by differences, block by block: exact enough for ties
        found = [((v[i : i + step, None, :] - centers[None]) ** 2).sum(2) for i in range(0, len(v), step)]
        near = np.zeros(len(x), np.int32)
        known = np.concatenate([~np.isnan(d).any(1) for d in found]) if found else np.empty(0, bool)
        near[good] = ids[np.concatenate([d.argmin(1) for d in found])] if found else 0
        good[good] = known
        return pa.array(near, mask=~good)

    return vectors.withColumn(out, nearest(F.col(column)))


def silhouette(sample: DataFrame, column: str, cluster: str = "cluster_id") -> float | None:
    """Mean Euclidean silhouette of a sample (see ``fit_sample``) of at most SILHOUETTE_SAMPLE rows;
    more raise. Single members count 0; null if there are fewer than two clusters."""
    rows = _judged(sample.select(F.col(column).cast("array<double>").alias("v"), F.col(cluster).alias("c")))
    if not rows.num_rows:
        return None
    return silhouettes(sample, np.array(rows["v"].to_pylist()), [np.unique(rows["c"].to_numpy(), return_inverse=True)[1]])[0]


def _judged(sample: DataFrame) -> pa.Table:
    rows = sample.limit(SILHOUETTE_SAMPLE + 1).toArrow()
    if rows.num_rows > SILHOUETTE_SAMPLE:
        raise ValueError(f"more than {SILHOUETTE_SAMPLE} rows")
    return rows


def silhouettes(of: DataFrame, x: np.ndarray, labels: list[np.ndarray]) -> list[float | None]:
    """Mean silhouettes of one sample under several labellings (from 0, without gaps), in one job: the
    sample goes to the tasks as one matrix, each compares a part of it with all, and every labelling
    takes its sums from the same distances."""
    sizes = [np.bincount(y) for y in labels]
    member = np.hstack([np.eye(len(n))[y] for n, y in zip(sizes, labels, strict=True)])
    ends = np.cumsum([len(n) for n in sizes])

    def scores(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i = b.column(0).to_numpy()
            for lo in range(0, len(i), 512):
                who, out = i[lo : lo + 512], []
                at = np.arange(len(who))
                d = np.sqrt(np.maximum(0, (x[who] ** 2).sum(1)[:, None] + (x**2).sum(1)[None] - 2 * x[who] @ x.T))
                d[at, who] = 0
                every = d @ member
                for end, size, y in zip(ends, sizes, labels, strict=True):
                    total, own = every[:, end - len(size) : end], y[who]
                    mine, mean = total[at, own] / np.maximum(1, size[own] - 1), total / size
                    mean[at, own] = np.inf
                    other = mean.min(1)
                    out.append(np.where(size[own] > 1, (other - mine) / np.maximum(np.maximum(mine, other), 1e-300), 0.0) if len(size) > 1 else np.zeros(len(who)))
                yield pa.RecordBatch.from_arrays([pa.array(np.array(out).T.tolist(), pa.list_(pa.float64()))], names=["s"])

    made = of.sparkSession.range(len(x)).mapInArrow(scores, "s array<double>")
    mean = made.agg(vector_to_array(Summarizer.mean(array_to_vector("s")))).first()[0]
    return [m if len(n) > 1 else None for m, n in zip(mean, sizes, strict=True)]


def pick_k(scores: DataFrame) -> DataFrame:
    """``k, score`` of the best score, the smallest k among equals."""
    return scores.orderBy(F.col("score").desc(), "k").limit(1)


def _gathered(sample: DataFrame) -> DataFrame:
    """A sample in as many parts as there are cores: each of dozens of passes over it would else have
    a task for every part of the table that it was taken from."""
    return sample.repartition(sample.sparkSession.sparkContext.defaultParallelism)


def sweep_k(scaled: DataFrame, keys: list[str], column: str = "scaled", ks: list[int] = K_VALUES, starts: int = SWEEP_STARTS, rounds: int = SWEEP_ROUNDS) -> DataFrame:
    """``k, score``: the silhouette of the best fit for each k, -1 where there is none. All values of k
    are fitted together on one sample, and judged together on a part of it."""
    sample = _gathered(fit_sample(scaled, K_SAMPLE, keys)).cache()
    fits = fit_starts(sample, ks, starts, keys, column, rounds=rounds)
    rows = _judged(fit_sample(sample, SILHOUETTE_SAMPLE, keys, SEED + 1).select(F.col(column).cast("array<double>").alias("v")).where("v IS NOT NULL"))
    x, labels = np.array(rows["v"].to_pylist()), []
    for k in ks:
        c = fits.centres[fits.best(k)]
        near = ((c * c).sum(1)[None] - 2 * x @ c.T).argmin(1) if len(x) else np.zeros(0, int)
        labels.append(np.unique(near, return_inverse=True)[1])
    scores = silhouettes(sample, x, labels) if len(x) else [None] * len(ks)
    sample.unpersist()
    return scaled.sparkSession.createDataFrame([(k, -1.0 if s is None else float(s)) for k, s in zip(ks, scores, strict=True)], "k int, score double")


def fit(scaled: DataFrame, keys: list[str], k: int | None = None, column: str = "scaled") -> tuple[DataFrame, DataFrame]:
    """Centroids, and one row ``k, silhouette`` (null if k was given)."""
    rows = _gathered(fit_sample(scaled, MAX_FRAMES_FOR_FIT, keys)).cache()
    score = None
    if k is None:
        best = pick_k(sweep_k(rows, keys, column)).first()
        k, score = best["k"], best["score"]
    centers = fit_kmeans(rows, k, keys, column)
    rows.unpersist()
    return centers, scaled.sparkSession.createDataFrame([(k, score)], "k int, silhouette double")


def fit_summary(assigned: DataFrame, fitted: DataFrame, names: DataFrame) -> DataFrame:
    """``k, silhouette, frames, idle``, one row."""
    return fitted.crossJoin(assigned.agg(F.count("*").alias("frames"))).crossJoin(names.where("is_idle").select(F.col("name").alias("idle")))


def cluster_mean_pose(assigned: DataFrame, ids: DataFrame, column: str, size: int) -> DataFrame:
    """The mean of ``column`` in each cluster; zeros for a cluster without frames."""
    means = assigned.groupBy("cluster_id").agg(Summarizer.mean(array_to_vector(F.col(column).cast("array<double>"))).alias("m")).select("cluster_id", vector_to_array("m").alias("average_pose"))
    return ids.join(means, "cluster_id", "left").withColumn("average_pose", F.coalesce("average_pose", F.array_repeat(F.lit(0.0), size)))


def cluster_stats(assigned: DataFrame, ids: DataFrame) -> DataFrame:
    """Frames of each cluster, their share of all, and how many of them are at the ends of clips.
    Partial sums leave one row a cluster for the shuffle, so the large idle cluster is no burden."""
    own = assigned.groupBy("cluster_id").agg(F.count("*").alias("frames"), F.avg(F.col("edge").cast("int")).alias("_edge"))
    total = own.agg(F.sum("frames").alias("_all"))
    df = ids.join(own, "cluster_id", "left").crossJoin(F.broadcast(total))  # total is one row
    frames = F.coalesce("frames", F.lit(0))
    return df.select("cluster_id", frames.alias("frames"), F.bround(frames / F.col("_all"), 5).alias("share"), F.bround(F.coalesce("_edge", F.lit(0.0)), 4).alias("edge_rate"))


#: Parts into which a range of clips is cut in one count; a part of so few clips is summed up in order.
_PARTS, _SHORT = 1024, 256


def _ends(clip: DataFrame, most: int) -> list[tuple]:
    """For each cluster with more than ``most`` frames the clips among which its last one is: cluster,
    first and last clip id, and how many frames those before have. Frames are counted by ranges of
    clips, each time finer in the range that the last frame is in, so no cluster's clips are sorted."""
    clip = clip.persist()
    whole = clip.groupBy("cluster_id").agg(F.min("clip_id"), F.max("clip_id"), F.sum("n")).collect()  # a row a cluster
    open_, done = [(c, lo, hi, 0) for c, lo, hi, n in whole if n > most], []
    spark = clip.sparkSession
    while open_:
        table = spark.createDataFrame([(*r, -(-(r[2] - r[1] + 1) // _PARTS)) for r in open_], f"cluster_id {clip.schema['cluster_id'].dataType.simpleString()}, _lo long, _hi long, _before long, _step long")
        inside = clip.join(F.broadcast(table), "cluster_id").where(F.col("clip_id").between(F.col("_lo"), F.col("_hi")))  # table: a row a cluster
        part = F.floor((F.col("clip_id") - F.col("_lo")) / F.col("_step")).alias("_part")
        counts = inside.groupBy("cluster_id", "_lo", "_step", "_before", part).agg(F.sum("n").alias("n"), F.count("*").alias("clips"), F.min("clip_id").alias("_from"), F.max("clip_id").alias("_to"))
        sofar = F.col("_before") + F.sum("n").over(W.partitionBy("cluster_id").orderBy("_part"))
        reached = counts.withColumn("_sofar", sofar).where(f"_sofar >= {most} AND _sofar - n < {most}")
        open_ = []
        for r in reached.select("cluster_id", "_from", "_to", (F.col("_sofar") - F.col("n")).alias("_before"), "clips").collect():  # a row a cluster
            (done if r["clips"] <= _SHORT or r["_from"] == r["_to"] else open_).append(tuple(r)[:4])
    clip.unpersist()
    return done


def cluster_top_signs(assigned: DataFrame, most: int = TOP_SIGN_FRAMES, top: int = TOP_SIGNS) -> DataFrame:
    """``cluster_id, rank, label, n``: labels of the cluster's first frames in clip order. A clip has
    one label, so frames are first counted by clip. Clips before the one with the last frame count
    whole, and only the few around that one are summed up in order. Ids of clips are whole numbers."""
    assigned = assigned.where("cluster_id IS NOT NULL")
    clip = assigned.groupBy("cluster_id", "clip_id", "label").agg(F.count("*").alias("n"))  # any_value of a text would sort all frames
    ends = clip.sparkSession.createDataFrame(_ends(clip, most), f"cluster_id {clip.schema['cluster_id'].dataType.simpleString()}, _from long, _to long, _before long")
    clip = clip.join(F.broadcast(ends), "cluster_id", "left").where(F.col("_to").isNull() | (F.col("clip_id") <= F.col("_to")))  # ends: a row a cluster
    whole = clip.where(F.col("_to").isNull() | (F.col("clip_id") < F.col("_from"))).select("cluster_id", "clip_id", "label", "n")
    sofar = F.coalesce(F.sum("n").over(W.partitionBy("cluster_id").orderBy("clip_id").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    edge = clip.where(F.col("clip_id") >= F.col("_from")).withColumn("n", F.least("n", most - F.col("_before") - sofar)).where("n > 0")
    clip = whole.unionByName(edge.select(*whole.columns))
    label = clip.groupBy("cluster_id", "label").agg(F.sum("n").alias("n"), F.min("clip_id").alias("_first"))
    rank = F.row_number().over(W.partitionBy("cluster_id").orderBy(F.col("n").desc(), "_first"))
    return label.withColumn("rank", rank).where(F.col("rank") <= top).select("cluster_id", "rank", "label", "n")


def pose_name_listing(pose_map: DataFrame) -> DataFrame:
    """``name, cluster_id, frames, signs``, the clusters with most frames first."""
    signs = F.array_join(F.slice(F.transform("top_signs", lambda s: s["label"]), 1, 4), ", ")
    return pose_map.select("name", "cluster_id", "frames", signs.alias("signs")).orderBy(F.col("frames").desc(), "cluster_id")
