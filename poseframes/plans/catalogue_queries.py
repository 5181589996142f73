"""Queries over the catalogue, the metadata, the clip store's headers and the attempts log."""

from __future__ import annotations

from pyspark.sql import functions as F

from poseframes.functions import paths as P
from poseframes.operators import extraction as X
from poseframes.plans.scratch import new_folder
from poseframes.plans.views import raw_landmarks, table, with_views
from poseframes.sources import attempts as T
from poseframes.sources import catalog as C
from poseframes.sources import clips as S

QUERIES, SQL = {}, {}


def query(name: str, views: list[str] | None = None, sql: str | None = None, more: list[tuple[str, str]] = []):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = with_views(views or [], sql, more)
        return f

    return keep


_ARCHIVES = [("archives", "SELECT p_partkey, name, CAST(round_even(size_bytes / 1e6::DOUBLE, 0) AS BIGINT) AS size_mb, replace(regexp_replace(name, '_\\d+of\\d+\\.zip$', ''), '.zip', '') AS category FROM archive_files WHERE lower(name) LIKE '%.zip'")]
_VIDEO = "lower(regexp_extract(rel_path, '[^/](\\.[^./]+)$', 1)) IN ('.mp4', '.mov', '.avi', '.mkv', '.webm', '.mpg', '.mpeg', '.m4v') AND NOT list_contains(string_split(rel_path, '/'), '_zips')"
_LABEL = ("CASE WHEN len(string_split(rel_path, '/')) = 1 THEN 'unknown' ELSE coalesce(nullif(lower(trim(regexp_replace(string_split(rel_path, '/')[-2], '^\\d+[.\\-_ ]+', ''))), ''), 'unknown') END")
_BASE = "string_split({}, '/')[-1]"


def archives(spark, sf):
    """The catalogue's archives, straight from the view."""
    f = table(spark, sf, "archive_files")
    return C.archive_catalog(f.select(F.array(F.struct(F.col("name").alias("key"), F.col("size_bytes").alias("size"), F.struct(F.concat(F.lit("https://example.org/"), "name").alias("self")).alias("links"))).alias("files")))


@query("S1_metadata_union", ["metadata"], "SELECT label, video_path, include_50, split FROM metadata")
def _(spark, sf):
    m = table(spark, sf, "metadata")
    union = C.metadata_union({s: m.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")})
    folder = new_folder(spark, "metadata")
    C.write_metadata(union, folder)
    return C.read_metadata(spark, folder)


@query("S2_archive_catalog", ["archive_files"], "SELECT name, 'https://example.org/' || name AS url, size_mb, category FROM archives", _ARCHIVES)
def _(spark, sf):
    f = table(spark, sf, "archive_files")
    entry = F.struct(F.col("name").alias("key"), F.col("size_bytes").alias("size"), F.struct(F.concat(F.lit("https://example.org/"), "name").alias("self")).alias("links"))
    pages = f.groupBy(F.floor(F.col("p_partkey") / 100).alias("page")).agg(F.collect_list(entry).alias("files"))
    folder = new_folder(spark, "catalogue")
    pages.select("files").write.json(folder)
    return C.read_archive_catalog(spark, folder, multi_line=False).orderBy("name")


@query("S3_media_files", ["media_files"], f"SELECT doc_id, rel_path, {_LABEL} AS label FROM media_files WHERE {_VIDEO}")
def _(spark, sf):
    return C.media_files(table(spark, sf, "media_files")).select("doc_id", "rel_path", "label")


@query("S9_attempts_log", ["attempts"], "SELECT run_id, archive, count(*) FILTER (WHERE outcome <> 'failed') AS n_done, count(*) FILTER (WHERE outcome = 'failed') AS n_failed FROM attempts GROUP BY ALL")
def _(spark, sf):
    a, folder = table(spark, sf, "attempts").select("run_id", "seq", "archive", "outcome"), new_folder(spark, "attempts")
    for part in (0, 1):  # two runs append to one log
        T.append_attempts(a.where(F.col("run_id") % 2 == part), folder)
    return T.archive_counts(T.read_attempts(spark, folder))


_DONE = [
    ("counted", "SELECT *, sum((outcome = 'success')::INT) OVER w AS since, sum((outcome <> 'failed')::INT) OVER w AS done FROM attempts WINDOW w AS (PARTITION BY run_id ORDER BY seq)"),
    ("streaks", "SELECT *, sum((outcome = 'failed')::INT) OVER (PARTITION BY run_id, since ORDER BY seq) AS streak FROM counted"),
    ("ends", "SELECT run_id, min(seq) FILTER (WHERE outcome = 'failed' AND done = 0 AND streak >= 8) AS gave_up FROM streaks GROUP BY run_id"),
    ("done_archives", "SELECT DISTINCT archive AS name FROM (SELECT a.run_id, archive, max(seq) AS last, any_value(gave_up) AS gave_up FROM attempts a JOIN ends USING (run_id) GROUP BY a.run_id, archive) WHERE gave_up IS NULL OR last < gave_up"),
]


@query("S9_archives_done", ["attempts"], "SELECT name FROM done_archives", _DONE)
def _(spark, sf):
    return T.archives_done(table(spark, sf, "attempts"))


@query("J3_pending_after_attempts", ["attempts"], "SELECT DISTINCT archive AS name FROM attempts WHERE run_id % 4 = 0 AND archive NOT IN (SELECT name FROM (SELECT * FROM done_archives) d)", _DONE)
def _(spark, sf):
    """Of the archives of some runs, those that no run has gone through."""
    tried = table(spark, sf, "attempts").where("run_id % 4 = 0").select(F.col("archive").alias("name")).distinct()
    return C.pending_archives(tried, T.archives_done(table(spark, sf, "attempts")))


@query("P1_label_from_path", ["media_files"], f"SELECT doc_id, {_LABEL} AS label FROM media_files")
def _(spark, sf):
    return table(spark, sf, "media_files").select("doc_id", P.label_from_path(F.col("rel_path")).alias("label"))


@query("P2_category_filter", ["media_files"], "SELECT doc_id, rel_path FROM media_files WHERE list_has_any(list_transform(string_split(rel_path, '/'), lambda x: lower(x)), ['animals', 'home'])")
def _(spark, sf):
    return table(spark, sf, "media_files").where(P.in_category(F.col("rel_path"), ["Animals", "home"])).select("doc_id", "rel_path")


@query("P3_archive_category", ["archive_files"], "SELECT p_partkey, replace(regexp_replace(name, '_\\d+of\\d+\\.zip$', ''), '.zip', '') AS category FROM archive_files")
def _(spark, sf):
    return table(spark, sf, "archive_files").select("p_partkey", P.archive_category(F.col("name")).alias("category"))


@query("P4_select_archives_by_category", ["archive_files"], "SELECT name, size_mb, category FROM archives WHERE lower(category) IN ('cat3', 'solo1') OR lower(name) LIKE 'cat3%' OR lower(name) LIKE 'solo1%'", _ARCHIVES)
def _(spark, sf):
    return C.require_any(C.select_archives(archives(spark, sf), ["Cat3", "Solo1"])).select("name", "size_mb", "category")


@query("P5_clip_key", ["media_files"], f"SELECT doc_id, regexp_replace({_BASE.format('rel_path')}, '\\.[^.]+$', '') || '_' || substr(sha1(rel_path), 1, 16) AS clip_key FROM media_files")
def _(spark, sf):
    return table(spark, sf, "media_files").select("doc_id", P.clip_key(F.col("rel_path")).alias("clip_key"))


@query("P6_clips_of_label", ["clips"], "SELECT clip_id, label, n_frames FROM clips WHERE label = 'sign 7'")
def _(spark, sf):
    return S.clips_of_label(table(spark, sf, "clips"), " Sign 7 ").select("clip_id", "label", "n_frames")


@query("P7_label_suggestions", ["clips"], "SELECT DISTINCT label FROM clips WHERE contains(label, 'gn 1') ORDER BY label LIMIT 5")
def _(spark, sf):
    return S.label_suggestions(table(spark, sf, "clips"), "GN 1")


@query("J1_subset_semi_join", ["media_files", "metadata"], f"SELECT doc_id, rel_path FROM media_files WHERE {_BASE.format('rel_path')} IN (SELECT {_BASE.format('video_path')} FROM metadata WHERE include_50)")
def _(spark, sf):
    return C.subset_only(table(spark, sf, "media_files"), table(spark, sf, "metadata")).select("doc_id", "rel_path")


@query("J2_uncached_anti_join", ["media_files"], f"SELECT doc_id, rel_path FROM media_files WHERE {_VIDEO} AND doc_id % 3 <> 0")
def _(spark, sf):
    videos = C.media_files(table(spark, sf, "media_files")).withColumn("key", P.clip_key(F.col("rel_path")))
    stored = table(spark, sf, "media_files").where("doc_id % 3 = 0").select(P.clip_key(F.col("rel_path")).alias("key"))
    return S.uncached(videos, stored, "key").select("doc_id", "rel_path")


@query("J3_pending_archives", ["archive_files"], "SELECT name, size_mb FROM archives WHERE p_partkey % 5 <> 0", _ARCHIVES)
def _(spark, sf):
    done = table(spark, sf, "archive_files").where("p_partkey % 5 = 0").select("name")
    return C.pending_archives(archives(spark, sf), done).select("name", "size_mb")


@query("A1_metadata_summary", ["metadata"], "SELECT count(*) AS n_rows, count(DISTINCT label) AS n_labels, CAST(sum(CAST(include_50 AS INT)) AS BIGINT) AS n_subset FROM metadata")
def _(spark, sf):
    return C.metadata_summary(table(spark, sf, "metadata"))


@query("A2_archive_totals", ["archive_files"], "SELECT count(*) AS archives, CAST(sum(size_mb) AS BIGINT) / 1000::DOUBLE AS gb FROM archives", _ARCHIVES)
def _(spark, sf):
    return C.archive_totals(archives(spark, sf))


@query("A3_label_clip_counts", ["clips"], "SELECT label, count(*) AS n_clips, count(*) OVER () AS n_labels FROM clips GROUP BY label")
def _(spark, sf):
    return S.label_clip_counts(table(spark, sf, "clips"))


@query("A14_extraction_report", ["attempts"], "SELECT archive, count(*) FILTER (WHERE outcome <> 'failed') AS done, count(*) FILTER (WHERE outcome = 'failed') AS failed FROM attempts GROUP BY ROLLUP (archive)")
def _(spark, sf):
    return T.extraction_report(table(spark, sf, "attempts"))


@query("A14_first_failures", ["attempts"], "SELECT run_id, seq, archive FROM attempts WHERE outcome = 'failed' ORDER BY run_id, seq LIMIT 10")
def _(spark, sf):
    return T.first_failures(table(spark, sf, "attempts")).select("run_id", "seq", "archive")


@query("W8_size_budget", ["archive_files"], "SELECT name, size_mb FROM (SELECT *, sum(size_mb) OVER (ORDER BY name ROWS UNBOUNDED PRECEDING) / 1000.0::DOUBLE AS run, row_number() OVER (ORDER BY name) AS rn FROM archives) WHERE rn = 1 OR run <= 700", _ARCHIVES)
def _(spark, sf):
    return C.size_budget(archives(spark, sf), 700.0).select("name", "size_mb")


@query("W10_first_n_per_label", ["clips"], "SELECT clip_id, label, rn FROM (SELECT clip_id, label, row_number() OVER (PARTITION BY label ORDER BY clip_id) AS rn FROM clips) WHERE rn <= 3")
def _(spark, sf):
    return S.first_n_per_label(table(spark, sf, "clips")).select("clip_id", "label", F.col("rn").cast("long").alias("rn"))


@query("W11_limit_per_archive", ["attempts"], "SELECT archive, run_id, seq, rn FROM (SELECT archive, run_id, seq, row_number() OVER (PARTITION BY archive ORDER BY run_id, seq) AS rn FROM attempts) WHERE rn <= 7")
def _(spark, sf):
    members = table(spark, sf, "attempts").select("archive", "run_id", "seq", F.struct("run_id", "seq").alias("member_pos"))
    return S.limit_per_archive(members, 7).select("archive", "run_id", "seq", F.col("rn").cast("long").alias("rn"))


@query("W12_failure_streak", ["attempts"], """SELECT run_id, min(CASE WHEN outcome = 'failed' AND done = 0 AND streak >= 8 THEN seq END) AS abort_seq, CAST(max(streak) AS BIGINT) AS longest_streak FROM (
  SELECT *, sum(CASE WHEN outcome = 'failed' THEN 1 ELSE 0 END) OVER (PARTITION BY run_id, since ORDER BY seq) AS streak FROM (
    SELECT *, sum(CASE WHEN outcome = 'success' THEN 1 ELSE 0 END) OVER w AS since, sum(CASE WHEN outcome <> 'failed' THEN 1 ELSE 0 END) OVER w AS done FROM attempts WINDOW w AS (PARTITION BY run_id ORDER BY seq))) GROUP BY run_id""")
def _(spark, sf):
    return T.failure_streak(table(spark, sf, "attempts"))


@query("O1_path_order_limit", ["media_files"], "SELECT doc_id, rel_path FROM media_files ORDER BY string_split(rel_path, '/') LIMIT 25")
def _(spark, sf):
    return C.path_order_limit(table(spark, sf, "media_files"), 25).select("doc_id", "rel_path")


@query("U1_union_of_splits", ["metadata"], "SELECT split, count(*) AS n FROM metadata GROUP BY split")
def _(spark, sf):
    m = table(spark, sf, "metadata")
    return C.metadata_union({s: m.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")}).groupBy("split").agg(F.count("*").alias("n"))




_RATE = "CASE doc_id % 5 WHEN 0 THEN 25.0 WHEN 1 THEN 30.0 WHEN 2 THEN 29.97 WHEN 3 THEN 25.0 ELSE 5.0 END::DOUBLE"


@query("M11_extract_flow", ["media_files", "metadata", "frame_clusters"], "SELECT archive, count(n) AS done, count(*) - count(n) AS failed, CAST(coalesce(sum(n), 0) AS BIGINT) AS frames FROM tried GROUP BY ROLLUP (archive)", [
    ("videos", f"SELECT doc_id, split_part(rel_path, '/', 1) AS archive, greatest(1, CAST(round_even({_RATE} / 10.0::DOUBLE, 0) AS BIGINT)) AS step FROM media_files WHERE {_VIDEO} AND {_BASE.format('rel_path')} IN (SELECT {_BASE.format('video_path')} FROM metadata WHERE include_50)"),
    ("tried", "SELECT v.archive, nullif(count(f.clip_id), 0) AS n FROM videos v LEFT JOIN frame_clusters f ON f.clip_id = v.doc_id AND f.frame_idx % v.step = 0 GROUP BY v.doc_id, v.archive"),
])
def _(spark, sf):
    """A first run over some of the files, a second over all: list, choose, skip, store, report."""
    media, folder = table(spark, sf, "media_files"), new_folder(spark, "extracted")
    # paths are joined while a frame is a few numbers
    of = table(spark, sf, "frame_clusters").join(media.select(F.col("doc_id").alias("clip_id"), "rel_path"), "clip_id")
    landmarks = raw_landmarks(spark, sf, of).drop("clip_id", "event_id")
    paths, metadata = media.select("rel_path"), table(spark, sf, "metadata")
    for run, limit in ((1, 40), (2, None)):
        attempts = X.extract(X.choose_videos(paths, metadata, limit=limit), landmarks, folder, run)
        T.append_attempts(attempts, f"{folder}-log")
    log = spark.read.parquet(f"{folder}-log").where("run_id = 2")
    clips, frames = X.stored_clips(spark, folder)
    stored = frames.groupBy("clip_id").count().join(clips, "clip_id").join(log, "source")
    per = stored.rollup("archive").agg(F.sum("count").alias("frames"))
    report = T.extraction_report(log)
    return report.join(per, report["archive"].eqNullSafe(per["archive"]), "left").select(report["archive"], "done", "failed", F.coalesce("frames", F.lit(0)).alias("frames"))
