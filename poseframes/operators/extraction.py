"""From a list of files to stored clips and a log of attempts, in one job that can be run again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poseframes.functions.paths import clip_key
from poseframes.operators.landmarks import assemble_keypoints, sample_frames
from poseframes.sources import catalog as C
from poseframes.sources import clips as S


def choose_videos(paths: DataFrame, metadata: DataFrame | None = None, categories: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """``rel_path, label, source``: the videos among ``rel_path`` rows, of the wanted categories, only
    those of the metadata's subset if it is given, the first ``limit`` by path."""
    videos = C.media_files(paths, categories)
    if metadata is not None:
        videos = C.subset_only(videos, metadata)
    if limit:
        videos = C.path_order_limit(videos, limit)
    return videos.withColumn("source", clip_key(F.col("rel_path")))


def clip_id_of(source: str) -> Column:
    """A number for a clip, by its key; that two of ten million keys share one has odds of 1 : 300,000."""
    return F.xxhash64(source)


def extract(videos: DataFrame, landmarks: DataFrame, store: str, run_id: int) -> DataFrame:
    """Store the frames of those ``videos`` (see ``choose_videos``) that the store lacks, and return the
    run's attempts, ``run_id, seq, archive, outcome, source``, in the order of paths.

    ``landmarks``: ``rel_path, idx, src_fps, body, left_hand, right_hand``. A video that is stored
    already counts as ``stored``, one without any frame as ``failed``. The archive is the top folder.
    Heads of clips are written last: without one, what a run has left of a clip before it broke off
    is not seen, and the next run writes the clip again.
    """
    spark = videos.sparkSession
    before = stored_sources(spark, store)
    pending = S.uncached(videos, before, "source")
    frames = assemble_keypoints(sample_frames(landmarks.join(pending, "rel_path"))).withColumn("clip_id", clip_id_of("source"))
    key = F.col("source")
    S.write_frames(frames, f"{store}/run={run_id}")
    written = spark.read.schema("clip_id bigint").parquet(f"{store}/run={run_id}/frames").groupBy("clip_id").agg(F.count("*").alias("n_frames"))
    rates = sample_frames(landmarks.select("rel_path", "idx", "src_fps").join(pending, "rel_path")).groupBy("source").agg(F.any_value("label").alias("label"), F.any_value("fps").alias("fps"))
    heads = rates.withColumn("clip_id", clip_id_of("source")).join(written, "clip_id")
    S.write_heads(heads, f"{store}/run={run_id}")
    new = spark.read.schema("source string").parquet(f"{store}/run={run_id}/clips").withColumn("_new", F.lit(True))
    log = videos.join(before.withColumn("_old", F.lit(True)), "source", "left").join(new, "source", "left")
    outcome = F.when(F.col("_old"), "stored").when(F.col("_new"), "success").otherwise("failed")
    log = log.select(F.lit(run_id).cast("long").alias("run_id"), "rel_path", F.element_at(F.split("rel_path", "/"), 1).alias("archive"), outcome.alias("outcome"), key)
    return log.orderBy(F.split("rel_path", "/")).select("run_id", F.monotonically_increasing_id().alias("seq"), "archive", "outcome", "source")


def stored_sources(spark: SparkSession, store: str) -> DataFrame:
    """``source`` of the clips that any run has stored whole; none if there is no store yet."""
    spark.createDataFrame([], S.HEADS).write.mode("append").parquet(f"{store}/run=0/clips")
    return spark.read.option("basePath", store).schema("source string").parquet(f"{store}/run=*/clips").select("source").distinct()


def stored_clips(spark: SparkSession, store: str) -> tuple[DataFrame, DataFrame]:
    """Heads and frames of all runs; frames without a head are left out. Of a clip that two runs have,
    one that broke off and one that did not, the head's run counts."""
    read = spark.read.option("basePath", store)
    clips = read.schema(f"{S.HEADS}, run bigint").parquet(f"{store}/run=*/clips")
    frames = read.schema(f"{S.FRAMES}, run bigint").parquet(f"{store}/run=*/frames")
    return clips.drop("run"), frames.join(clips.select("clip_id", "run"), ["clip_id", "run"], "left_semi").drop("run")
