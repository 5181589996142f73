"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Every document of a source has the same expected number of copies, target / source size. Documents
stand in a fixed order; the prefix sum of expected copies moves by one random offset a source, and
a document is emitted once for each integer that its step crosses. Within a source they stand by
size: rounding errors of neighbours then cancel between documents of like size, and the words taken
miss the target by no more than the largest document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from poseframes.llm.common import fresh

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in the order of their names, again and again.
WEIGHTS = (3, 1, 2)
#: Words of the mix, as a multiple of all words; and the most that a source may give of its own.
SHARE, MOST = 1.5, 2.0
SEED = "mix-1"


def _unit(x: Column) -> Column:
    """A fixed pseudo-random number in [0, 1) of a string."""
    return F.conv(F.substring(F.md5(x.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(sizes: DataFrame) -> DataFrame:
    """``_source, _source_size, _target, _offset`` of a table ``_source, _size``: targets in
    proportion to the weights, none over MOST times its source's size, the rest shared again.

    That is target = min(cap, level * weight). By cap / weight, a source is capped if the level
    at which it becomes so needs no more words than the mix has. One row a source is sorted.
    """
    by_source = sizes.groupBy("_source").agg(F.sum("_size").alias("_source_size"))
    name = W.orderBy(F.col("_source").asc_nulls_last())
    turn = F.array(*map(F.lit, WEIGHTS))
    w = by_source.withColumn("_w", F.element_at(turn, ((F.row_number().over(name) - 1) % len(WEIGHTS) + 1).cast("int")))
    w = w.withColumn("_cap", MOST * F.col("_source_size").cast("double")).withColumn("_level", F.col("_cap") / F.col("_w"))
    order = W.orderBy("_level", F.col("_source").asc_nulls_last())
    upto, after, every = order.rowsBetween(W.unboundedPreceding, 0), order.rowsBetween(1, W.unboundedFollowing), W.partitionBy()
    w = w.withColumn("_all", SHARE * F.sum("_source_size").over(every).cast("double"))
    need = MOST * F.sum("_source_size").over(upto).cast("double") + F.col("_level") * F.coalesce(F.sum("_w").over(after), F.lit(0)).cast("double")
    w = w.withColumn("_capped", need <= F.col("_all"))
    full = MOST * F.coalesce(F.sum(F.when(F.col("_capped"), F.col("_source_size"))).over(every), F.lit(0)).cast("double")
    free = F.sum(F.when(~F.col("_capped"), F.col("_w"))).over(every).cast("double")
    w = w.withColumn("_target", F.when(F.col("_capped"), F.col("_cap")).otherwise((F.col("_all") - full) * F.col("_w") / free))
    offset = _unit(F.concat(F.lit(SEED), F.coalesce(F.concat(F.lit(":"), "_source"), F.lit(""))))
    return w.select("_source", "_source_size", "_target", offset.alias("_offset"))


def systematic_copies(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id") -> DataFrame:
    """All columns of ``docs`` and ``_size, _source_size, _target, _copies`` (with low lines behind a
    name that ``docs`` has already).

    A document's place in its source comes from three counts: of smaller sizes in the source, of
    its size in lower buckets of a hash, and of its bucket's rows before it. So a source, or a
    size within one, that holds much of all rows is spread over many tasks.

    Null texts have size 0; null sources are one source, the last; null ids stand first in their
    bucket. Equal rows may swap places, which changes nothing that is returned. A source without
    words has target 0 and no copies; an empty table gives an empty one. Texts of any length count
    whole, and a document larger than its source's target is still taken twice at most. Columns of
    ``docs`` keep their values whatever their names.
    """
    made = ("_size", "_source_size", "_target", "_copies")
    inside = [f"c{i}" for i in range(len(docs.columns))]
    at = {c: f"c{docs.columns.index(c)}" for c in (text, source, id_col)}
    found = _copies(docs.toDF(*inside), at[text], at[source], at[id_col])
    named = [F.col(c).alias(n) for c, n in zip([*inside, *made], [*docs.columns, *fresh(docs.columns, *made)], strict=True)]
    return found.select(*named)


def _copies(docs: DataFrame, text: str, source: str, id_col: str) -> DataFrame:
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    rows = docs.withColumns({
        "_source": F.col(source), "_size": F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long"),
        "_mix_digest": digest, "_mix_bucket": F.substring(digest, 1, 2),
    })
    buckets = rows.groupBy("_source", "_size", "_mix_bucket").agg(F.count("*").alias("_n"))
    sizes = buckets.groupBy("_source", "_size").agg(F.sum("_n").alias("_n"))
    targets = source_targets(sizes.select("_source", (F.col("_size") * F.col("_n")).alias("_size")))
    before = lambda *keys: W.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("_source", "_size", F.coalesce(F.sum("_n").over(before("_source", "_size")), F.lit(0)).alias("_smaller"))
    lower = F.coalesce(F.sum("_n").over(before("_source", "_size", "_mix_bucket")), F.lit(0)).alias("_lower")
    places = buckets.select("_source", "_size", "_mix_bucket", lower)
    for more, keys in ((sizes, ("_source", "_size")), (targets, ("_source",))):
        here = more.select(*(F.col(c).alias(f"{c}_r" if c in keys else c) for c in more.columns))
        same = [places[k].eqNullSafe(here[f"{k}_r"]) for k in keys]
        places = places.join(here, same).drop(*(f"{k}_r" for k in keys))
    places = places.select(*(F.col(k).alias(f"_mix_r{k}") for k in ("_source", "_size", "_mix_bucket")), "_smaller", "_lower", "_source_size", "_target", "_offset")
    same = [rows[k].eqNullSafe(places[f"_mix_r{k}"]) for k in ("_source", "_size", "_mix_bucket")]
    own = W.partitionBy("_source", "_size", "_mix_bucket").orderBy("_mix_digest", id_col)
    placed = rows.join(places, same).withColumn("_mix_place", F.col("_smaller") + F.col("_lower") + F.row_number().over(own))
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(F.lit(0.0))
    step = lambda place: F.floor(F.col("_offset") + rate * place)
    placed = placed.withColumn("_copies", (step(F.col("_mix_place")) - step(F.col("_mix_place") - 1)).cast("long"))
    return placed.select(*docs.columns, "_size", "_source_size", "_target", "_copies")


def mix(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it has copies."""
    copies = systematic_copies(docs, text, source, id_col)
    many, one = copies.columns[-1], fresh(copies.columns, "_copy")[0]
    return copies.where(F.col(many) > 0).withColumn(one, F.explode(F.sequence(F.lit(1), F.col(many).cast("int")))).select(*docs.columns)


#: For DuckDB: the same, with one window a source instead of three counts.
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS INT)] AS w FROM s),
l AS (SELECT *, {MOST}::DOUBLE * source_size AS cap, {MOST}::DOUBLE * source_size / w AS level, {SHARE}::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM w),
n AS (SELECT *, {MOST}::DOUBLE * CAST(sum(source_size) OVER (ORDER BY level, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
  + level * CAST(coalesce(sum(w) OVER (ORDER BY level, encode(source) NULLS LAST ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS DOUBLE) <= total AS capped FROM l),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap ELSE
    (total - {MOST}::DOUBLE * CAST(coalesce(sum(CASE WHEN capped THEN source_size END) OVER (), 0) AS DOUBLE)) * w / CAST(sum(CASE WHEN NOT capped THEN w END) OVER () AS DOUBLE) END AS target,
  CAST(CAST('0x' || substr(md5('{SEED}' || coalesce(':' || source, '')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0::DOUBLE AS shift FROM n),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.shift, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
  row_number() OVER (PARTITION BY d.source ORDER BY d.size, md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), d.doc_id) AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * CAST(floor(shift + rate * place) - floor(shift + rate * (place - 1)) AS BIGINT) AS taken FROM p
"""
