"""The log of extraction attempts and what is read from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from poseframes import schemas
from poseframes.params import ABORT_AFTER_FAILURES


def append_attempts(attempts: DataFrame, path: str) -> None:
    attempts.write.mode("append").parquet(path)


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ATTEMPTS).parquet(path)


def archive_counts(attempts: DataFrame) -> DataFrame:
    """Done and failed attempts of each run and archive."""
    return attempts.groupBy("run_id", "archive").agg(F.count_if(F.col("outcome") != "failed").alias("n_done"), F.count_if(F.col("outcome") == "failed").alias("n_failed"))


def archives_done(attempts: DataFrame) -> DataFrame:
    """``name`` of the archives that later runs skip: a run went through them, whatever failed in
    them. The archive in which a run gave up (see ``failure_streak``) is not done by it."""
    last = attempts.join(failure_streak(attempts).select("run_id", "abort_seq"), "run_id").groupBy("run_id", "archive", "abort_seq").agg(F.max("seq").alias("last"))
    return last.where(F.col("abort_seq").isNull() | (F.col("last") < F.col("abort_seq"))).select(F.col("archive").alias("name")).distinct()


def failure_streak(attempts: DataFrame, most: int = ABORT_AFTER_FAILURES) -> DataFrame:
    """Per run the first attempt that aborts it, null if none: ``most`` failures in a row while
    nothing has succeeded. A stored file counts as done but does not end the streak."""
    w = W.partitionBy("run_id").orderBy("seq").rowsBetween(W.unboundedPreceding, 0)
    failed, success = (F.col("outcome") == "failed").cast("int"), (F.col("outcome") == "success").cast("int")
    marked = attempts.withColumns({"_since": F.sum(success).over(w), "_done": F.sum((F.col("outcome") != "failed").cast("int")).over(w)})
    streak = F.sum(failed).over(W.partitionBy("run_id", "_since").orderBy("seq").rowsBetween(W.unboundedPreceding, 0))
    marked = marked.withColumn("_streak", streak)
    aborts = (F.col("outcome") == "failed") & (F.col("_done") == 0) & (F.col("_streak") >= most)
    return marked.groupBy("run_id").agg(F.min(F.when(aborts, F.col("seq"))).alias("abort_seq"), F.max("_streak").alias("longest_streak"))


def extraction_report(attempts: DataFrame) -> DataFrame:
    """Done and failed attempts of each archive, and of all in a row without a name."""
    return attempts.rollup("archive").agg(F.count_if(F.col("outcome") != "failed").alias("done"), F.count_if(F.col("outcome") == "failed").alias("failed"))


def first_failures(attempts: DataFrame, n: int = 10) -> DataFrame:
    return attempts.where(F.col("outcome") == "failed").orderBy("run_id", "seq").limit(n)
