"""The clip store: one row a frame, and a header for each clip."""

from __future__ import annotations

from collections.abc import Iterator
from io import BytesIO

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from poseframes import schemas
from poseframes.params import N_POINTS


HEADS, FRAMES = schemas.CLIPS, schemas.FRAMES


def write_heads(clips: DataFrame, path: str, mode: str = "append") -> None:
    """A row for each clip."""
    clips.select("clip_id", "label", F.col("fps").cast("float").alias("fps"), "source", "n_frames").write.mode(mode).parquet(f"{path}/clips")


def _checked(frames: DataFrame) -> DataFrame:
    """Frames as they are stored. One of another width, or without coordinates or mask, fails the write:
    a store without it would hold fewer frames than the clip's header says."""
    valid = F.coalesce((F.size("xyz") == 3 * N_POINTS) & (F.size("mask") == N_POINTS), F.lit(False))
    wrong = F.raise_error(F.concat(F.lit(f"not {N_POINTS} points: clip "), F.col("clip_id").cast("string"), F.lit(", frame "), F.col("frame_idx").cast("string")))
    frames = frames.withColumn("xyz", F.when(valid, F.col("xyz")).otherwise(wrong.cast("array<double>")))
    return frames.select("clip_id", "frame_idx", F.col("xyz").cast("array<float>").alias("xyz"), "mask")


def write_frames(frames: DataFrame, path: str, mode: str = "append") -> None:
    """Frames of a clip stay together and in order; Spark commits whole files or none."""
    _checked(frames).repartition("clip_id").sortWithinPartitions("clip_id", "frame_idx").write.mode(mode).parquet(f"{path}/frames")


def write_clips(clips: DataFrame, frames: DataFrame, path: str, mode: str = "append") -> None:
    """Heads and frames of clips."""
    write_heads(clips.select(clips["clip_id"], "label", "fps", "source", "n_frames"), path, mode)
    write_frames(frames, path, mode)


def _bucketed(columns: str, buckets: int, order: str, path: str) -> str:
    return f"({columns}) USING parquet CLUSTERED BY (clip_id) SORTED BY ({order}) INTO {buckets} BUCKETS LOCATION '{path}'"


def write_bucketed(spark: SparkSession, name: str, clips: DataFrame, clusters: DataFrame, path: str, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Heads (``clip_id, fps, source, n_frames``) and frames' clusters (``clip_id, frame_idx,
    cluster_id``) as tables ``{name}_clips`` and ``{name}_frames`` in files bucketed by clip: what
    works clip by clip then reads them without a shuffle. ``open_bucketed`` gives them again."""
    for part, df, order in (("clips", clips.select("clip_id", "fps", "source", "n_frames"), ["clip_id"]), ("frames", clusters.select("clip_id", "frame_idx", "cluster_id"), ["clip_id", "frame_idx"])):
        df.repartition(buckets, "clip_id").write.mode("overwrite").option("path", f"{path}/{part}").bucketBy(buckets, "clip_id").sortBy(*order).saveAsTable(f"{name}_{part}")
    return spark.table(f"{name}_clips"), spark.table(f"{name}_frames")


def open_bucketed(spark: SparkSession, name: str, path: str, buckets: int) -> tuple[DataFrame, DataFrame]:
    """The tables that ``write_bucketed`` left in a folder, for a session that does not know them."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name}_clips {_bucketed('clip_id BIGINT, fps FLOAT, source STRING, n_frames BIGINT', buckets, 'clip_id', f'{path}/clips')}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name}_frames {_bucketed('clip_id BIGINT, frame_idx BIGINT, cluster_id INT', buckets, 'clip_id, frame_idx', f'{path}/frames')}")
    return spark.table(f"{name}_clips"), spark.table(f"{name}_frames")


def read_clips(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Clips and frames of a store; files that a crash left corrupt are skipped."""
    read = spark.read.option("ignoreCorruptFiles", True)
    return read.schema(schemas.CLIPS).parquet(f"{path}/clips"), read.schema(schemas.FRAMES).parquet(f"{path}/frames")


_NPZ = "source string, label string, fps float, frame_idx long, xyz array<float>, mask array<boolean>"


def parse_npz(files: DataFrame) -> DataFrame:
    """Frames of ``path, content`` rows that hold NumPy archives with xyz, mask, fps, label and
    source. A file that cannot be read gives no rows; nothing is unpickled."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                try:
                    with np.load(BytesIO(content), allow_pickle=False) as z:
                        xyz, mask, fps, label, source = z["xyz"], z["mask"], float(z["fps"]), str(z["label"]), str(z["source"])
                except Exception:  # noqa: BLE001 - a store may hold files of interrupted runs
                    continue
                flat = xyz.reshape(len(xyz), -1).astype(np.float32)
                yield pd.DataFrame({"source": source, "label": label, "fps": np.float32(fps), "frame_idx": np.arange(len(flat)), "xyz": list(flat), "mask": list(mask.astype(bool))})

    return files.select("path", "content").mapInPandas(parse, _NPZ)


def read_npz_clips(spark: SparkSession, root: str) -> DataFrame:
    """Frames of all ``.npz`` files in a folder except unfinished ones."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(root)
    return parse_npz(files.where(~F.col("path").endswith(".tmp.npz")))


def pack_npz(clips: DataFrame, frames: DataFrame) -> DataFrame:
    """``path, content`` with one NumPy archive for each clip: the inverse of ``parse_npz``."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("frame_idx")
        first, out = pdf.iloc[0], BytesIO()
        xyz = np.stack(pdf["xyz"].to_list()).astype(np.float32).reshape(len(pdf), -1, 3)
        np.savez_compressed(out, xyz=xyz, mask=np.stack(pdf["mask"].to_list()).astype(bool), fps=np.float32(first["fps"]), label=np.array(first["label"]), source=np.array(first["source"]))
        return pd.DataFrame({"path": [f"{first['source']}.npz"], "content": [out.getvalue()]})

    # Spark takes an array for a few bytes, so by its estimate frames are small enough to be sent to every
    # executor by way of the driver; the hint keeps both sides dealt out by clip, as the groups are.
    return frames.join(clips.select("clip_id", "label", "fps", "source").hint("merge"), "clip_id").groupBy("clip_id").applyInPandas(pack, "path string, content binary")


def uncached(videos: DataFrame, clips: DataFrame, key: str, overwrite: bool = False) -> DataFrame:
    """Videos whose key no stored clip has."""
    return videos if overwrite else videos.join(clips.select(key).distinct(), key, "left_anti")


def clips_of_label(clips: DataFrame, word: str) -> DataFrame:
    return clips.where(F.col("label") == word.strip().lower())


def label_suggestions(clips: DataFrame, text: str, n: int = 5) -> DataFrame:
    return clips.where(F.col("label").contains(text.strip().lower())).select("label").distinct().orderBy("label").limit(n)


def label_clip_counts(clips: DataFrame) -> DataFrame:
    """Clips of each label, and how many labels there are."""
    counts = clips.groupBy("label").agg(F.count("*").alias("n_clips"))
    return counts.crossJoin(counts.agg(F.count("*").alias("n_labels")))


def first_n_per_label(clips: DataFrame, n: int = 3) -> DataFrame:
    """The first n clips of each label in store order."""
    return clips.withColumn("rn", F.row_number().over(W.partitionBy("label").orderBy("clip_id"))).where(F.col("rn") <= n)


def limit_per_archive(members: DataFrame, n: int) -> DataFrame:
    return members.withColumn("rn", F.row_number().over(W.partitionBy("archive").orderBy("member_pos"))).where(F.col("rn") <= n)
