"""Queries over clusters of frames and of vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from poseframes.functions import geometry as G
from poseframes.functions import naming as N
from poseframes.operators import clusters as K
from poseframes.operators import model as M
from poseframes.params import K_SAMPLE, K_VALUES, MAX_FRAMES_FOR_FIT, N_POINTS, SILHOUETTE_SAMPLE, STARTS, SWEEP_STARTS
from poseframes.plans.frame_queries import _BASE_NAME, _DESCRIBE, _IDLE, check, normalised
from poseframes.plans.scratch import new_folder
from poseframes.plans.views import POINTS, table, with_views
from poseframes.sources import results as R

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None, more: list[tuple[str, str]] = [], views: list[str] = ["frame_clusters"]):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = with_views(views, sql, more)
        return f

    return keep


def _stored(spark, df, label):
    """``df`` written and read again, so that it is not computed twice."""
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def _flags(spark, sf):
    return K.edge_flags(table(spark, sf, "frame_clusters"))


def _ids(spark, k: int = 7):
    """One more than there are: the last cluster is empty."""
    return spark.range(k).select(F.col("id").cast("int").alias("cluster_id"))


def _poses(spark, sf):
    return K.cluster_mean_pose(normalised(spark, sf), _ids(spark), "norm", 3 * N_POINTS)


_EDGE = ("flags", "SELECT *, frame_idx < e OR frame_idx >= n_frames - e AS edge FROM (SELECT *, greatest(1, CAST(floor(n_frames * 0.12::DOUBLE) AS BIGINT)) AS e FROM frame_clusters)")
_K = ("k", "SELECT CAST(unnest(range(7)) AS INT) AS cluster_id")
_STATS = [_EDGE, _K, ("stats", "SELECT k.cluster_id, count(f.clip_id) AS frames, round_even(count(f.clip_id) / (SELECT count(*) FROM flags)::DOUBLE, 5) AS share, round_even(coalesce(avg(CAST(edge AS INT)), 0), 4) AS edge_rate FROM k LEFT JOIN flags f ON k.cluster_id = f.cluster_id GROUP BY k.cluster_id")]
_MEAN = [*POINTS, _K, ("mean", "SELECT k.cluster_id, p.j, coalesce(avg(x), 0) AS x, coalesce(avg(y), 0) AS y, coalesce(avg(z), 0) AS z FROM k CROSS JOIN (SELECT CAST(unnest(range(57)) AS BIGINT) AS j) p LEFT JOIN norm n ON n.cluster_id = k.cluster_id AND n.j = p.j GROUP BY k.cluster_id, p.j")]
_MEAN_WIDE = ("wide", "SELECT cluster_id, " + ", ".join(f"max({a}) FILTER (WHERE j = {j}) AS {a}{j}" for j in (0, 1, 2, 3, 4, 5, 14) for a in "xyz") + " FROM mean GROUP BY cluster_id")
_CHOICE = [
    *_MEAN, _MEAN_WIDE, *_DESCRIBE, *[x for x in _STATS if x[0] != "k"],
    ("cand", f"SELECT s.*, {_BASE_NAME} AS base, {_IDLE} AS looks_idle FROM stats s JOIN described d ON s.cluster_id = d.cluster_id"),
    ("idle", "SELECT cluster_id AS idle_id FROM cand ORDER BY looks_idle DESC, edge_rate DESC, cluster_id LIMIT 1"),
    ("named", "SELECT cluster_id, cluster_id = idle_id AS is_idle, CASE WHEN cluster_id = idle_id THEN 'IDLE' WHEN n = 1 THEN base ELSE base || '_' || CAST(n AS VARCHAR) END AS name FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id = idle_id, base ORDER BY cluster_id) AS n FROM cand, idle)"),
]
_TOP = ("top", """SELECT cluster_id, rank, label, n FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, first) AS rank FROM (
  SELECT cluster_id, label, count(*) AS n, min(f.clip_id) AS first FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY clip_id, frame_idx) AS rn FROM frame_clusters) f JOIN clips c ON f.clip_id = c.clip_id WHERE rn <= 20000 GROUP BY cluster_id, label)) WHERE rank <= 8""")


@query("W1_edge_flags", "SELECT clip_id, frame_idx, edge FROM flags", [_EDGE])
def _(spark, sf):
    return _flags(spark, sf).select("clip_id", "frame_idx", "edge")


@query("A4_fit_scaler", "SELECT i, round(avg(v), 6) AS mean, round(CASE WHEN stddev_pop(v) = 0 THEN 1 ELSE stddev_pop(v) END, 6) AS std FROM (SELECT unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS i FROM embeddings) GROUP BY i", views=[])
def _(spark, sf):
    s = K.fit_scaler(table(spark, sf, "embeddings"), "embedding")
    return s.select(F.posexplode(F.arrays_zip("mean", "std")).alias("i", "s")).select(F.col("i").cast("long").alias("i"), F.round("s.mean", 6).alias("mean"), F.round("s.std", 6).alias("std"))


@query("A4_scale", "SELECT vec_id, round(sum((v - mean) / std * (i + 1)), 4) AS scaled_check FROM e JOIN m USING (i) GROUP BY vec_id", [("e", "SELECT vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS i FROM embeddings"), ("m", "SELECT i, avg(v) AS mean, CASE WHEN stddev_pop(v) = 0 THEN 1 ELSE stddev_pop(v) END AS std FROM e GROUP BY i")], [])
def _(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    return K.scale(e, K.fit_scaler(e, "embedding"), "embedding").select("vec_id", check("scaled").alias("scaled_check"))


@query("J4_assign_clusters", "SELECT vec_id, cluster_id FROM (SELECT vec_id, cluster_id, row_number() OVER (PARTITION BY vec_id ORDER BY list_distance(embedding::DOUBLE[], center::DOUBLE[]), cluster_id) AS rn FROM embeddings, centroids) WHERE rn = 1", views=["centroids"])
def _(spark, sf):
    return K.assign_clusters(table(spark, sf, "embeddings"), table(spark, sf, "centroids"), "embedding").select("vec_id", "cluster_id")


# The same seeded sample in the other engine: the first rows by a digest of the seed and the id.
_SAMPLED = ("sampled", "SELECT * FROM embeddings ORDER BY md5('0:' || CAST(vec_id AS VARCHAR)), vec_id LIMIT 4000")


@query("A6_silhouette", """SELECT round(avg(CASE WHEN size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM (
  SELECT vec_id, any_value(n) FILTER (WHERE same) AS size, any_value(s / greatest(n - 1, 1)) FILTER (WHERE same) AS a, min(s / n) FILTER (WHERE NOT same) AS b FROM (
    SELECT x.vec_id, x.label = y.label AS same, y.label, count(*) AS n,
      sum(CASE WHEN x.vec_id = y.vec_id THEN 0 ELSE list_distance(x.embedding::DOUBLE[], y.embedding::DOUBLE[]) END) AS s
    FROM sampled x, sampled y GROUP BY x.vec_id, x.label = y.label, y.label) GROUP BY vec_id)""", [_SAMPLED], [])  # fmt: skip
def _(spark, sf):
    rows = K.fit_sample(table(spark, sf, "embeddings"), SILHOUETTE_SAMPLE, ["vec_id"])
    return spark.createDataFrame([(K.silhouette(rows, "embedding", "label"),)], "silhouette double").select(F.round("silhouette", 6).alias("silhouette"))


def _scaled(spark, sf):
    e = table(spark, sf, "embeddings")
    return K.scale(e, K.fit_scaler(e, "embedding"), "embedding")


def _fitted(ks: list[int], starts: int, rounds: int, limit: int) -> list[tuple[str, str]]:
    """K-means over scaled vectors in the other engine: ``fit`` has the centres of every k and start
    after each round, ``judged`` the rows and squared distances of the last one's clusters, ``best``
    the start of each k with the least."""
    near = "SELECT k, s, vec_id, arg_min(c, struct_pack(d := list_distance(x, m), c := c)) AS c, min(list_distance(x, m)) AS d, any_value(x) AS x FROM {}, x GROUP BY k, s, vec_id"
    means = f"SELECT k, s, c, list(v ORDER BY i) AS mean FROM (SELECT k, s, c, i, avg(x[i + 1]) AS v FROM ({near.format('fit')}), range(64) r(i) GROUP BY k, s, c, i) GROUP BY k, s, c"
    return [
        ("e", "SELECT vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS i FROM embeddings"),
        ("m", "SELECT i, avg(v) AS mean, CASE WHEN stddev_pop(v) = 0 THEN 1 ELSE stddev_pop(v) END AS std FROM e GROUP BY i"),
        ("x", f"SELECT vec_id, list((v - mean) / std ORDER BY i) AS x FROM e JOIN m USING (i) GROUP BY vec_id ORDER BY md5('0:' || CAST(vec_id AS VARCHAR)), vec_id LIMIT {limit}"),
        ("firsts", f"SELECT s, row_number() OVER (PARTITION BY s ORDER BY md5('0:' || CAST(s AS VARCHAR) || ':' || CAST(vec_id AS VARCHAR)), vec_id) - 1 AS c, x FROM x, range({starts}) r(s)"),
        ("fit(round, k, s, c, m)", f"SELECT 0, k, s, c, x FROM firsts, (SELECT unnest({ks}) AS k) WHERE c < k UNION ALL SELECT round + 1, k, s, c, coalesce(mean, f.m) FROM fit f LEFT JOIN ({means}) USING (k, s, c) WHERE round < {rounds}"),
        ("final", f"SELECT * FROM fit WHERE round = {rounds}"),
        ("judged", f"SELECT k, s, c, count(*) AS n, sum(d * d) AS inertia FROM ({near.format('final')}) GROUP BY k, s, c"),
        ("totals", "SELECT k, s, sum(inertia) AS inertia FROM judged GROUP BY k, s"),
        ("best", "SELECT k, arg_min(s, struct_pack(i := round(inertia, CAST(5 - floor(log10(inertia)) AS INT)), s := s)) AS s FROM totals GROUP BY k"),
    ]


def _recursive(name: str) -> None:
    SQL[name] = SQL[name].replace("WITH ", "WITH RECURSIVE ", 1)


@query("A5_fit_kmeans", "SELECT CAST(c AS INT) AS cluster_id, coalesce(n, 0) AS n, round(list_sum(list_transform(m, lambda v, i: v * i)), 3) AS center_check FROM final JOIN best USING (k, s) LEFT JOIN judged USING (k, s, c)", _fitted([12], STARTS, K.ROUNDS, MAX_FRAMES_FOR_FIT), [])
def _(spark, sf):
    return K.fit(_scaled(spark, sf), ["vec_id"], 12)[0].select("cluster_id", "n", check("center", 3).alias("center_check"))


@query("A7_pick_k", "SELECT k, score FROM scores ORDER BY score DESC, k LIMIT 1", [("scores", "SELECT CAST(12 + 6 * (user_id % 9) AS INT) AS k, round(avg(value), 1) AS score FROM events GROUP BY user_id % 9")], [])
def _(spark, sf):
    scores = table(spark, sf, "events").groupBy((12 + 6 * (F.col("user_id") % 9)).cast("int").alias("k")).agg(F.round(F.avg("value"), 1).alias("score"))
    return K.pick_k(scores)


_SWEPT = [
    *_fitted(K_VALUES, SWEEP_STARTS, K.SWEEP_ROUNDS, K_SAMPLE),
    ("judges", "SELECT * FROM x ORDER BY md5('1:' || CAST(vec_id AS VARCHAR)), vec_id LIMIT 4000"),
    ("labelled", "SELECT k, vec_id, arg_min(c, struct_pack(d := list_distance(x, m), c := c)) AS c FROM final JOIN best USING (k, s), judges GROUP BY k, vec_id"),
    ("apart", "SELECT a.vec_id AS a, b.vec_id AS b, CASE WHEN a.vec_id = b.vec_id THEN 0 ELSE list_distance(a.x, b.x) END AS d FROM judges a, judges b"),
    ("sums", "SELECT p.k, a, p.c AS own, q.c, count(*) AS n, sum(d) AS d FROM apart JOIN labelled p ON p.vec_id = a JOIN labelled q ON q.vec_id = b AND q.k = p.k GROUP BY ALL"),
    ("sides", "SELECT k, a, max(CASE WHEN own = c THEN n END) AS size, max(CASE WHEN own = c THEN d / greatest(n - 1, 1) END) AS mine, min(CASE WHEN own <> c THEN d / n END) AS other FROM sums GROUP BY k, a"),
]


@query("A7_sweep_k", "SELECT CAST(k AS INT) AS k, round(avg(CASE WHEN size = 1 THEN 0 ELSE (other - mine) / greatest(mine, other) END), 6) AS score FROM sides GROUP BY k", _SWEPT, [])
def _(spark, sf):
    return K.sweep_k(_scaled(spark, sf), ["vec_id"]).select("k", F.round("score", 6).alias("score"))


_recursive("A5_fit_kmeans")
_recursive("A7_sweep_k")


@query("O3_fit_sample", f"""SELECT clip_id, frame_idx, 300 AS of FROM (SELECT clip_id, frame_idx FROM frame_clusters
  ORDER BY md5('0:' || CAST(clip_id AS VARCHAR) || ':' || CAST(frame_idx AS VARCHAR)), clip_id, frame_idx LIMIT 300)
  UNION ALL SELECT clip_id, frame_idx, {MAX_FRAMES_FOR_FIT} FROM (SELECT clip_id, frame_idx FROM frame_clusters
  ORDER BY md5('0:' || CAST(clip_id AS VARCHAR) || ':' || CAST(frame_idx AS VARCHAR)), clip_id, frame_idx LIMIT {MAX_FRAMES_FOR_FIT})""")  # fmt: skip
def _(spark, sf):
    f = table(spark, sf, "frame_clusters").select("clip_id", "frame_idx")
    few, many = (K.fit_sample(f, n, ["clip_id", "frame_idx"]).withColumn("of", F.lit(n)) for n in (300, MAX_FRAMES_FOR_FIT))
    return few.unionByName(many)


@query("A8_cluster_mean_pose", "SELECT cluster_id, j * 3 + a AS i, round(CASE a WHEN 0 THEN x WHEN 1 THEN y ELSE z END, 6) AS v FROM mean, (SELECT unnest([0, 1, 2]) AS a)", _MEAN)
def _(spark, sf):
    return _poses(spark, sf).select("cluster_id", F.posexplode("average_pose").alias("i", "v")).select("cluster_id", F.col("i").cast("long").alias("i"), F.round("v", 6).alias("v"))


@query("A9_cluster_stats", "SELECT * FROM stats", _STATS)
def _(spark, sf):
    return K.cluster_stats(_flags(spark, sf), _ids(spark))


@query("A10_cluster_top_signs", "SELECT * FROM top", [_TOP], ["frame_clusters", "clips"])
def _(spark, sf):
    f = table(spark, sf, "frame_clusters").join(table(spark, sf, "clips").select("clip_id", "label"), "clip_id")
    return K.cluster_top_signs(f).withColumn("rank", F.col("rank").cast("long"))


def _candidates(spark, sf):
    stats = K.cluster_stats(_flags(spark, sf), _ids(spark))
    d = _poses(spark, sf).withColumn("description", N.describe_pose(F.col("average_pose")))
    d = d.withColumns({"base": N.base_pose_name(F.col("description")), "looks_idle": N.is_idle_pose(F.col("description"))})
    return stats, d, stats.join(d, "cluster_id")


@query("A11_choose_idle", "SELECT idle_id FROM idle", _CHOICE)
def _(spark, sf):
    return N.choose_idle(_candidates(spark, sf)[2])


@query("W9_unique_cluster_names", "SELECT cluster_id, name, is_idle FROM named", _CHOICE)
def _(spark, sf):
    c = _candidates(spark, sf)[2]
    return N.unique_cluster_names(c, N.choose_idle(c))


def fit_frames(spark, sf, k):
    """A model of all frames' descriptors, stored and loaded again. Labels are joined while a frame is
    a few numbers, and a descriptor begins with the normalised coordinates, so it is stored alone."""
    labelled = table(spark, sf, "frame_clusters").join(table(spark, sf, "clips").select("clip_id", "label").hint("merge"), "clip_id")
    frames = normalised(spark, sf, "descriptor", of=labelled).select("clip_id", "frame_idx", "n_frames", "label", "descriptor")
    frames = _stored(spark, frames, "features").withColumn("norm", F.slice("descriptor", 1, 3 * N_POINTS))
    folder = new_folder(spark, "models")
    M.store_model(M.fit_model(frames, k), folder)
    return M.load_model(spark, folder)


# The fit's idle cluster is always called so; which cluster it is, A11 and W9 have.
@query("A12_fit_summary", "SELECT 6 AS k, CAST(NULL AS DOUBLE) AS silhouette, count(*) AS frames, 'IDLE' AS idle FROM frame_clusters")
def _(spark, sf):
    return fit_frames(spark, sf, 6).summary


@query("A12_fit_summary_swept")
def _(spark, sf):
    """The same with k chosen by the sweep."""
    return fit_frames(spark, sf, None).summary


def pose_map(spark, sf):
    stats, d, c = _candidates(spark, sf)
    f = table(spark, sf, "frame_clusters").join(table(spark, sf, "clips").select("clip_id", "label"), "clip_id")
    return R.build_pose_map(stats, N.unique_cluster_names(c, N.choose_idle(c)), d, K.cluster_top_signs(f))


_SIGNS = ("signs", "SELECT cluster_id, string_agg(label, ', ' ORDER BY rank) FILTER (WHERE rank <= 4) AS signs, count(*) AS n_signs FROM top GROUP BY cluster_id")


@query("S7_pose_map_write_read", "SELECT n.name, n.cluster_id, frames, share, edge_rate, n.is_idle, side, zone, hands_gap, n_signs, round(ck, 0) AS pose_check FROM named n JOIN stats s USING (cluster_id) JOIN described d USING (cluster_id) LEFT JOIN signs USING (cluster_id) JOIN (SELECT cluster_id, sum((3 * j + 1) * x + (3 * j + 2) * y + (3 * j + 3) * z) AS ck FROM (SELECT cluster_id, j, round_even(x, 4) AS x, round_even(y, 4) AS y, round_even(z, 4) AS z FROM mean) GROUP BY cluster_id) USING (cluster_id)", [*_CHOICE, _TOP, _SIGNS], ["frame_clusters", "clips"])
def _(spark, sf):
    m, folder = pose_map(spark, sf), new_folder(spark, "pose-map")
    R.write_pose_map(m, folder)
    back = R.read_pose_map(spark, folder)
    return back.select("name", "cluster_id", "frames", "share", "edge_rate", "is_idle", "description.side", "description.zone", "description.hands_gap", F.size("top_signs").cast("long").alias("n_signs"), check("average_pose", 0).alias("pose_check"))  # coarse: stored poses have 4 digits, and engines may round a half apart


@query("O2_pose_name_listing", "SELECT name, n.cluster_id, frames, coalesce(signs, '') AS signs FROM named n JOIN stats s USING (cluster_id) LEFT JOIN signs USING (cluster_id)", [*_CHOICE, _TOP, _SIGNS], ["frame_clusters", "clips"])
def _(spark, sf):
    return K.pose_name_listing(pose_map(spark, sf)).withColumn("signs", F.coalesce("signs", F.lit("")))


@query("A13_pose_extents", """SELECT round(x - (wide - w) / 2, 6) AS x, round(y, 6) AS y, round(wide, 6) AS w, round(h, 6) AS h FROM (SELECT *, greatest(w, h * 0.62::DOUBLE) AS wide FROM (
  SELECT min(-x) - 0.35::DOUBLE AS x, min(y) - 0.85::DOUBLE - 0.3::DOUBLE AS y, max(-x) - min(-x) + 0.7::DOUBLE AS w, max(y) - (min(y) - 0.85::DOUBLE) + 0.6::DOUBLE AS h FROM mean))""", _MEAN)
def _(spark, sf):
    from poseframes.operators.playback import pose_extents

    return pose_extents(_poses(spark, sf)).select(*(F.round(c, 6).alias(c) for c in "xywh"))


