"""Resumable ingestion of landmark files: every frame once, however its clip is spread over files.

The store is asked which frames it has, not the checkpoint, so neither the end of a micro-batch nor a
lost checkpoint is the end of a clip: what comes later of a clip is added to it. Frames lie in BUCKETS
folders by a hash of their clip, and a batch reads the keys of those buckets only that its clips are in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poseframes.operators.landmarks import assemble_keypoints, sample_frames

RAW = "clip_id bigint, idx bigint, src_fps double, body array<struct<x: double, y: double, z: double, visibility: double>>, left_hand array<struct<x: double, y: double, z: double>>, right_hand array<struct<x: double, y: double, z: double>>"

_STORED = "clip_id bigint, frame_idx bigint, fps double, xyz array<float>, mask array<boolean>"
_PLACE = "run string, batch bigint, bucket int"
_KEY = ["clip_id", "frame_idx"]

#: Folders of a batch; a store keeps the number that it was begun with.
BUCKETS = 64


def _bucket(clip_id: str = "clip_id") -> Column:
    return F.pmod(F.xxhash64(clip_id), F.lit(BUCKETS)).cast("int")


def stored_frames(sampled: DataFrame, *more: str) -> DataFrame:
    return assemble_keypoints(sampled).select("clip_id", "frame_idx", "fps", F.col("xyz").cast("array<float>").alias("xyz"), "mask", *more)


def new_frames(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Frames of ``batch``, as they are stored, whose clip and number ``stored`` lacks, each once: from
    the first file by path (``_file``), and any of the rows of one file.

    They are shuffled and sorted once, as keypoints, which take a third of the bytes of landmarks."""
    frames = stored_frames(sample_frames(batch), "_file").repartition(*_KEY)
    own = [c for c in frames.columns if c not in (*_KEY, "_file")]
    first = frames.groupBy(*_KEY).agg(F.min_by(F.struct(*own), "_file").alias("_row")).select(*_KEY, "_row.*")
    return first.join(stored.select(*_KEY), _KEY, "left_anti")


def read_store(spark: SparkSession, store: str) -> DataFrame:
    """All frames that were stored; clips may have come in any number of pieces."""
    return spark.read.schema(f"{_STORED}, {_PLACE}").parquet(store).where("bucket >= 0").select("clip_id", "frame_idx", "fps", "xyz", "mask")


def stored_clips(spark: SparkSession, store: str) -> DataFrame:
    """``clip_id, n_frames, next_idx``: frames that the store has, and one more than the last number.
    A clip of which frames are missing in between has fewer than ``next_idx``."""
    keys = spark.read.schema(f"clip_id bigint, frame_idx bigint, {_PLACE}").parquet(store).where("bucket >= 0")
    return keys.groupBy("clip_id").agg(F.count("*").alias("n_frames"), (F.max("frame_idx") + 1).alias("next_idx"))


def ingest_new_clips(spark: SparkSession, source: str, store: str, checkpoint: str, files_per_trigger: int = 1000) -> None:
    """Process the files that have come since the last call; ``files_per_trigger`` of them at a time.

    A batch goes to a folder named after the checkpoint and its number, which a second run of this
    batch replaces and of which it takes no notice; all other folders count as stored. So a batch that
    runs again after a crash adds nothing twice, and neither does a lost checkpoint, which reads all
    files again and finds their frames. Of a frame that comes twice, what was stored first stays.
    """
    spark.createDataFrame([], _STORED).write.mode("append").parquet(f"{store}/run=none/batch=-1/bucket=-1")  # so that there is a store to ask

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        buckets = [r[0] for r in batch.select(_bucket().alias("b")).distinct().collect()]  # BUCKETS at most
        keys = session.read.schema(f"clip_id bigint, frame_idx bigint, {_PLACE}").parquet(store)
        keys = keys.where(F.col("bucket").isin(buckets) & ~((F.col("run") == query) & (F.col("batch") == number)))
        new = new_frames(batch, keys).withColumn("bucket", _bucket())
        new.hint("rebalance", "bucket").sortWithinPartitions(*_KEY).write.partitionBy("bucket").mode("overwrite").parquet(f"{store}/run={query}/batch={number}")

    stream = spark.readStream.schema(RAW).option("maxFilesPerTrigger", files_per_trigger).parquet(source).withColumn("_file", F.col("_metadata.file_path"))
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
