"""Catalogue and metadata tables: read, combine, select."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from poseframes import schemas
from poseframes.functions.paths import archive_category, base_name, in_category, is_video, label_from_path

#: What stands before the path in an address: a scheme, and the store's name.
_SCHEME = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?")


def metadata_union(splits: dict[str, DataFrame]) -> DataFrame:
    """Rows of all splits, each with the name of its own."""
    parts = [df.withColumn("split", F.lit(name)) for name, df in splits.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_metadata(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.METADATA).option("header", True).csv(path)


def read_archive_catalog(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A saved catalogue (a JSON object with ``files``, or without ``multi_line`` one on each line) as
    one row for each zip archive."""
    return archive_catalog(spark.read.schema(schemas.CATALOGUE).option("multiLine", multi_line).json(path))


def archive_catalog(catalogue: DataFrame) -> DataFrame:
    """``name, url, size_mb, category`` of the files that end in .zip, whatever the case."""
    f = catalogue.select(F.explode("files").alias("f")).select("f.*").where(F.lower("key").endswith(".zip"))
    return f.select(
        F.col("key").alias("name"), F.col("links.self").alias("url"), F.bround(F.col("size") / 1e6).cast("long").alias("size_mb"), archive_category(F.col("key")).alias("category")
    )


def list_media(spark: SparkSession, root: str) -> DataFrame:
    """``rel_path`` of every file below a folder, given by its full path or address. Contents are
    never read: only the path is kept."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    start = _SCHEME.sub("", root).rstrip("/") + "/"
    path = F.regexp_replace("path", _SCHEME.pattern, "")
    return files.select(F.when(path.startswith(F.lit(start)), F.substring(path, len(start) + 1, 1 << 30)).otherwise(path).alias("rel_path"))


def media_files(paths: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """The videos among ``rel_path`` rows, with the label of their folder."""
    vids = paths.where(is_video(F.col("rel_path")))
    if categories:
        vids = vids.where(in_category(F.col("rel_path"), categories))
    return vids.withColumn("label", label_from_path(F.col("rel_path")))


def path_order_limit(files: DataFrame, n: int) -> DataFrame:
    """The first n by path components: ``a/x`` stands before ``a b/x``, unlike in string order. Of
    equal paths any may be taken."""
    return files.orderBy(F.split("rel_path", "/")).limit(n)


def subset_only(files: DataFrame, metadata: DataFrame) -> DataFrame:
    """Files whose base name a metadata row of the subset has. Spark broadcasts the names if they
    are few enough for its own limit."""
    names = metadata.where("include_50").select(base_name(F.col("video_path")).alias("_name")).distinct()
    return files.join(names, base_name(files["rel_path"]) == names["_name"], "left_semi")


def select_archives(archives: DataFrame, wanted: list[str]) -> DataFrame:
    """Archives whose category is wanted or whose name starts with a wanted word."""
    low = [w.lower() for w in wanted]
    starts = F.lit(False)
    for w in low:
        starts = starts | F.lower("name").startswith(w)
    return archives.where(F.lower("category").isin(low) | starts)


def require_any(archives: DataFrame) -> DataFrame:
    """The same rows; an error if there are none."""
    if archives.isEmpty():
        raise ValueError("no archive matches the wanted categories")
    return archives


def size_budget(archives: DataFrame, max_gb: float | None) -> DataFrame:
    """The prefix, by name, whose running size fits; the first always does. The table has a row an
    archive, so one sort of it is small."""
    if not max_gb:
        return archives
    running = W.orderBy("name").rowsBetween(W.unboundedPreceding, 0)
    sized = archives.withColumns({"_run": F.sum("size_mb").over(running) / F.lit(1000.0), "_rn": F.row_number().over(W.orderBy("name"))})
    return sized.where((F.col("_rn") == 1) | (F.col("_run") <= max_gb)).drop("_run", "_rn")


def pending_archives(archives: DataFrame, done: DataFrame, restart: bool = False) -> DataFrame:
    return archives if restart else archives.join(done.select("name").distinct(), "name", "left_anti")


def archive_totals(archives: DataFrame) -> DataFrame:
    return archives.agg(F.count("*").alias("archives"), (F.coalesce(F.sum("size_mb"), F.lit(0)) / 1000).alias("gb"))


def metadata_summary(metadata: DataFrame) -> DataFrame:
    return metadata.agg(F.count("*").alias("n_rows"), F.countDistinct("label").alias("n_labels"), F.sum(F.col("include_50").cast("int")).alias("n_subset"))
