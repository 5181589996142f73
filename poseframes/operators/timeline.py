"""From the clusters of a clip's frames to its words.

All steps work within clips, over the same partitioning: ``by_clip`` deals frames out once, with
three integers a row, and no step after it shuffles again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from poseframes.params import MIN_SEGMENT_FRAMES, SMOOTH_WINDOW


def parts(spark: SparkSession) -> int:
    """Parts for rows whose bytes tell little of the work on them."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _clip() -> WindowSpec:
    return W.partitionBy("clip_id")


def by_clip(frames: DataFrame, dealt: bool = False) -> DataFrame:
    """Three integers a frame, dealt out by clip unless they are (see ``write_bucketed``)."""
    frames = frames.select("clip_id", "frame_idx", "cluster_id")
    return frames if dealt else frames.repartition("clip_id")


def median_smooth(frames: DataFrame, w: int = SMOOTH_WINDOW) -> DataFrame:
    """``cluster_id`` replaced by the median of the w frames around; ends repeat their own. Clips
    with fewer frames stay as they are. w must be odd."""
    if w % 2 == 0:
        raise ValueError("the window must be odd")
    if w < 3:
        return frames
    order = _clip().orderBy("frame_idx")
    first, last = F.first("cluster_id").over(order), F.last("cluster_id").over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    around = [F.coalesce(F.lag("cluster_id", -i).over(order), first if i < 0 else last) for i in range(-(w // 2), w // 2 + 1)]
    if w == 3:
        middle = around[0] + around[1] + around[2] - F.greatest(*around) - F.least(*around)
    else:
        middle = F.element_at(F.array_sort(F.array(*around)), w // 2 + 1)
    return frames.withColumn("cluster_id", F.when(F.count("*").over(_clip()) < w, F.col("cluster_id")).otherwise(middle))


def run_length(frames: DataFrame) -> DataFrame:
    """``clip_id, start, end, cluster_id, clip_end`` of the maximal runs; ends are exclusive."""
    order = _clip().orderBy("frame_idx")
    new = F.coalesce((F.lag("cluster_id").over(order) != F.col("cluster_id")).cast("int"), F.lit(0))
    marked = frames.withColumn("_new", new).withColumn("_run", F.sum("_new").over(order))
    runs = marked.groupBy("clip_id", "_run").agg(F.min("frame_idx").alias("start"), (F.max("frame_idx") + 1).alias("end"), F.any_value("cluster_id").alias("cluster_id"))
    return runs.drop("_run").withColumn("clip_end", F.max("end").over(_clip()))


#: Frames of a piece of a long recording.
PIECE = 100_000


def run_length_in_pieces(frames: DataFrame, piece: int = PIECE) -> DataFrame:
    """What ``run_length`` gives of frames that ``median_smooth`` has gone over with its usual window,
    but no recording is one task: frames are dealt out by pieces of clips. What a piece has to know of
    the others is the cluster beside either border; a row a piece carries it. Runs that go on over a
    border are put together at the end, when only runs are left."""
    f = frames.select("clip_id", "frame_idx", "cluster_id", F.floor(F.col("frame_idx") / piece).alias("_piece")).repartition("clip_id", "_piece")
    ends = f.groupBy("clip_id", "_piece").agg(F.min_by("cluster_id", "frame_idx").alias("_first"), F.max_by("cluster_id", "frame_idx").alias("_last"), F.count("*").alias("_n"))
    beside = _clip().orderBy("_piece")
    ends = ends.select("clip_id", "_piece", F.lag("_last").over(beside).alias("_before"), F.lead("_first").over(beside).alias("_after"), F.sum("_n").over(_clip()).alias("_frames"))
    order = W.partitionBy("clip_id", "_piece").orderBy("frame_idx")
    own = F.col("cluster_id")
    around = [F.coalesce(F.lag("cluster_id").over(order), "_before", own), own, F.coalesce(F.lead("cluster_id").over(order), "_after", own)]
    middle = around[0] + around[1] + around[2] - F.greatest(*around) - F.least(*around)
    smooth = f.join(ends, ["clip_id", "_piece"]).withColumn("cluster_id", F.when(F.col("_frames") < SMOOTH_WINDOW, own).otherwise(middle))
    new = F.coalesce((F.lag("cluster_id").over(order) != own).cast("int"), F.lit(0))
    runs = smooth.withColumn("_new", new).withColumn("_run", F.sum("_new").over(order)).groupBy("clip_id", "_piece", "_run").agg(
        F.min("frame_idx").alias("start"), (F.max("frame_idx") + 1).alias("end"), F.any_value("cluster_id").alias("cluster_id")
    )
    runs = merge_adjacent_runs(runs.select("clip_id", "start", "end", "cluster_id", F.lit(None).cast("long").alias("clip_end")).repartition("clip_id"))
    return runs.withColumn("clip_end", F.max("end").over(_clip()))


def drop_short_runs(runs: DataFrame, idle_id: int, least: int = MIN_SEGMENT_FRAMES) -> DataFrame:
    """Runs of ``least`` frames or more, idle ones at either end of the clip, and the only run of a
    clip. If that leaves none, the longest, the first among equals."""
    order = _clip().orderBy("start")
    n, pos = F.count("*").over(_clip()), F.row_number().over(order)
    size = F.col("end") - F.col("start")
    df = runs.withColumns({"_n": n, "_pos": pos, "_size": size})
    at_end = (F.col("cluster_id") == idle_id) & ((F.col("_pos") == 1) | (F.col("_pos") == F.col("_n")))
    df = df.withColumn("_keep", (F.col("_n") == 1) | (F.col("_size") >= least) | at_end)
    df = df.withColumns({"_any": F.max("_keep").over(_clip()), "_place": F.row_number().over(_clip().orderBy(F.col("_size").desc(), "start"))})
    return df.where(F.col("_keep") | (~F.col("_any") & (F.col("_place") == 1))).select(*runs.columns)


def merge_adjacent_runs(runs: DataFrame) -> DataFrame:
    """Neighbours of one cluster become one run, from the first's start to the last's end."""
    order = _clip().orderBy("start")
    new = F.coalesce((F.lag("cluster_id").over(order) != F.col("cluster_id")).cast("int"), F.lit(0))
    marked = runs.withColumn("_new", new).withColumn("_run", F.sum("_new").over(order))
    merged = marked.groupBy("clip_id", "_run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.any_value("cluster_id").alias("cluster_id"), F.any_value("clip_end").alias("clip_end")
    )
    return merged.drop("_run")


def stretch_runs(runs: DataFrame) -> DataFrame:
    """Each run from the end of the one before (as it was) to the start of the next (as it was), so
    a gap goes to both sides. ``pos`` numbers them from 0."""
    order = _clip().orderBy("start")
    return runs.select(
        "clip_id", (F.row_number().over(order) - 1).alias("pos"), "cluster_id", F.coalesce(F.lag("end").over(order), F.lit(0).cast("long")).alias("start"),
        F.coalesce(F.lead("start").over(order), F.col("clip_end")).alias("end"),
    )


def trim_to_idle(runs: DataFrame, idle_id: int, keep_all: bool = False) -> DataFrame:
    """From the first to the last idle run. With one only, from it on if it is in the first half,
    else up to it; with none, everything."""
    if keep_all:
        return runs
    at = F.when(F.col("cluster_id") == idle_id, F.col("pos"))
    df = runs.withColumns({"_n": F.count("*").over(_clip()), "_idle": F.count(at).over(_clip()), "_first": F.min(at).over(_clip()), "_last": F.max(at).over(_clip())})
    early = F.col("_first") < F.col("_n") / 2
    keep = F.when(F.col("_idle") == 0, True).when(F.col("_idle") > 1, F.col("pos").between(F.col("_first"), F.col("_last"))).when(early, F.col("pos") >= F.col("_first")).otherwise(F.col("pos") <= F.col("_first"))
    return df.where(keep).select(*runs.columns)


def pad_idle(runs: DataFrame, idle_id: int) -> DataFrame:
    """``clip_id, segs``: the clip's runs in order, with an idle one at either end."""
    segs = F.sort_array(F.collect_list(F.struct("pos", "cluster_id", "start", "end")))
    df = runs.groupBy("clip_id").agg(F.transform(segs, lambda s: F.struct(s["cluster_id"], s["start"], s["end"])).alias("segs"))
    seg = lambda start, end: F.array(F.struct(F.lit(idle_id).cast("int").alias("cluster_id"), start.cast("long").alias("start"), end.cast("long").alias("end")))
    none = F.filter("segs", lambda s: F.lit(False))
    first, last = F.element_at("segs", 1), F.element_at("segs", -1)
    before = F.when(first["cluster_id"] != idle_id, seg(F.lit(0), first["start"])).otherwise(none)
    after = F.when(last["cluster_id"] != idle_id, seg(last["end"], last["end"] + 1)).otherwise(none)
    return df.withColumn("segs", F.concat(before, F.col("segs"), after))


def word_times(padded: DataFrame, clips: DataFrame) -> DataFrame:
    """``clip_id, pos, cluster_id, start, end, duration`` in seconds from the first idle."""
    df = padded.join(clips.select("clip_id", F.col("fps").cast("double").alias("_fps")), "clip_id")
    zero = F.element_at("segs", 1)["start"] / F.col("_fps")
    df = df.select("clip_id", "_fps", zero.alias("_zero"), F.posexplode("segs").alias("pos", "s"))
    second = lambda x: F.bround(x, 3)
    return df.select(
        "clip_id", "pos", F.col("s.cluster_id").alias("cluster_id"), second(F.col("s.start") / F.col("_fps") - F.col("_zero")).alias("start"),
        second(F.col("s.end") / F.col("_fps") - F.col("_zero")).alias("end"), second((F.col("s.end") - F.col("s.start")) / F.col("_fps")).alias("duration"),
    )


def name_words(words: DataFrame, names: DataFrame) -> DataFrame:
    """Cluster ids with their words; there are a few dozen, so Spark broadcasts them by size."""
    return words.join(names.select("cluster_id", F.col("name").alias("word")), "cluster_id")


def segments_of(frames: DataFrame, idle_id: int, dealt: bool = False, piece: int | None = None) -> DataFrame:
    """The stretched runs of every clip, before trimming. With ``piece`` long recordings are worked on
    in pieces of so many frames."""
    runs = run_length_in_pieces(frames, piece) if piece else run_length(median_smooth(by_clip(frames, dealt)))
    return stretch_runs(merge_adjacent_runs(drop_short_runs(runs, idle_id)))


def encode(frames: DataFrame, clips: DataFrame, names: DataFrame, idle_id: int, keep_all: bool = False, dealt: bool = False) -> DataFrame:
    """``clip_id, pos, word, cluster_id, start, end, duration`` of every clip. ``dealt``: the frames'
    partitions hold whole clips already."""
    padded = pad_idle(trim_to_idle(segments_of(frames, idle_id, dealt), idle_id, keep_all), idle_id)
    return name_words(word_times(padded, clips), names).select("clip_id", "pos", "word", "cluster_id", "start", "end", "duration")


def nested(words: DataFrame, clips: DataFrame) -> DataFrame:
    """``video, fps, frames, sequence, words``: a row for each clip."""
    packed = F.sort_array(F.collect_list(F.struct("pos", "word", "cluster_id", "start", "end", "duration")))
    df = words.groupBy("clip_id").agg(F.transform(packed, lambda w: F.struct(w["word"], w["cluster_id"], w["start"], w["end"], w["duration"])).alias("words"))
    df = df.join(clips, "clip_id")
    return df.select(F.col("source").alias("video"), F.bround(F.col("fps").cast("double"), 3).alias("fps"), F.col("n_frames").alias("frames"), F.transform("words", lambda w: w["word"]).alias("sequence"), "words")


def timeline_shares(words: DataFrame) -> DataFrame:
    """Where each word stands in its clip, in percent of the last word's end; null if that is 0."""
    whole = W.partitionBy("clip_id").orderBy("pos").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    end = F.nullif(F.last("end").over(whole), F.lit(0.0))
    return words.withColumn("_end", end).select("clip_id", "pos", "word", (100 * F.col("start") / F.col("_end")).alias("left_pct"), (100 * (F.col("end") - F.col("start")) / F.col("_end")).alias("width_pct"))

