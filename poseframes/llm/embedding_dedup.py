"""Near-duplicate vectors: Euclidean p-stable hashing, then exact cosines inside buckets.

A normalised vector's projection on a Gaussian direction, shifted and cut into steps, is one hash;
several make a table's bucket, and vectors meet if any table puts them into one bucket. On unit
vectors the Euclidean distance is a function of the cosine, so the chance to agree in one hash is
known for a pair at the threshold and for unrelated ones (cosine 0). From the largest label's size
follow as many projections as leave a vector SPARE unrelated ones a table on average, and as many
tables as leave no more than MISS of the pairs at the threshold apart. Projections grow with the
logarithm of the size and tables with a small power of it (0.22 for 0.93), so pairs that are compared
in vain stay in proportion to the vectors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poseframes.llm.common import cut, small_batches, trim, trimmed
from poseframes.llm.components import components_sql, connected_components, roots

#: Width of a hash's steps, and the seed of directions and shifts.
STEP, SEED = 2.5, 7
#: Unrelated vectors that a vector meets in a table on average, and the share of pairs at the
#: threshold that no table brings together.
SPARE, MISS = 0.1, 0.01
#: Rows of one block; larger buckets are compared block by block, those of up to SMALL rows many at
#: once: so many memberships of classes in tables, of which few are in buckets of several, are one lot.
BLOCK, SMALL, LOT = 1024, 64, 20_000
#: Linked pairs whose hashes are compared in one go.
PAIRS = 1 << 16


@dataclass(frozen=True)
class Tables:
    tables: int
    projections: int


def agreement(cosine: float) -> float:
    """The chance that two unit vectors with this cosine have one hash in common."""
    r = STEP / math.sqrt(2 - 2 * cosine)
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def tables_for(largest: int, least: float) -> Tables:
    """For a label with so many vectors and links from this cosine on."""
    projections = max(2, math.ceil(math.log(max(largest, 2) / SPARE) / -math.log(agreement(0.0))))
    meet = agreement(min(least, 1 - 1e-9)) ** projections
    return Tables(math.ceil(math.log(MISS) / math.log1p(-meet)), projections)


def _matrix(column: pa.Array) -> np.ndarray:
    """Equal-length lists as rows of a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _normal(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # squares of extreme numbers would vanish or overflow
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def hashes(unit: np.ndarray, p: Tables) -> np.ndarray:
    """One bucket number for each row and table."""
    random = np.random.default_rng([SEED, unit.shape[1]])
    lines = random.standard_normal((unit.shape[1], p.tables * p.projections))
    cells = np.floor((unit @ lines + random.uniform(0, STEP, p.tables * p.projections)) / STEP).astype(np.int64).reshape(len(unit), p.tables, p.projections)
    key = np.full((len(unit), p.tables), unit.shape[1], np.uint64)
    for i in range(p.projections):
        key = (key ^ cells[:, :, i].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(29)
    return (key >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _result(table: pa.Table, a: np.ndarray, b: np.ndarray) -> pa.Table:
    """For each class with links its number of them, and a root that joins those they connect."""
    n = table["n"].to_numpy()
    counts = np.zeros(len(n), np.int64)
    np.add.at(counts, a, n[b])
    np.add.at(counts, b, n[a])
    some = np.flatnonzero(counts)
    out = pa.table({"class": table["class"].take(pa.array(some)), "links": pa.array(counts[some]), "root": table["class"].take(pa.array(roots(len(n), a, b)[some]))})
    trim(table.nbytes)
    return out


def _keys(table: pa.Table) -> np.ndarray:
    flat = table["keys"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, -1)


def compare_lot(table: pa.Table, least: float) -> pa.Table:
    """Links within each of many small buckets. A pair counts in the first table only that brings it
    together. Buckets whose vectors have another length than most are never mixed with them."""
    order = table.select(["bucket"]).append_column("at", pa.array(np.arange(table.num_rows))).sort_by("bucket")["at"]
    table = table.take(order).combine_chunks()
    lengths = table["embedding"].combine_chunks().value_lengths().to_numpy()
    bucket, t, keys = table["bucket"].to_numpy(), table["t"].to_numpy(), _keys(table)
    unit = np.zeros((len(bucket), int(lengths.max())))
    for d in np.unique(lengths):
        own = np.flatnonzero(lengths == d)
        unit[own, :d] = _normal(_matrix(table["embedding"].take(pa.array(own)).combine_chunks()))
    found_a, found_b = [], []
    for step in range(1, SMALL):
        a = np.flatnonzero(bucket[:-step] == bucket[step:])
        if not len(a):
            break
        for lo in range(0, len(a), PAIRS):
            x = a[lo : lo + PAIRS]
            x = x[(np.einsum("ij,ij->i", unit[x], unit[x + step]) >= least) & (lengths[x] == lengths[x + step])]
            x = x[(keys[x] == keys[x + step]).argmax(1) == t[x]]
            found_a.append(x)
            found_b.append(x + step)
    none = [np.empty(0, np.int64)]
    return _result(table, np.concatenate(found_a or none), np.concatenate(found_b or none))


def compare_bucket(table: pa.Table, least: float) -> pa.Table:
    """Links of one large bucket, or of two blocks of it, counted in the same way."""
    table = table.combine_chunks()
    unit, keys = _normal(_matrix(table["embedding"].combine_chunks())), _keys(table)
    second, t = table["second"].to_numpy(zero_copy_only=False), table["t"][0].as_py()
    one = table["i"][0].as_py() == table["j"][0].as_py()
    left, right = (np.arange(len(unit)),) * 2 if one else (np.flatnonzero(~second), np.flatnonzero(second))
    linked = unit[left] @ unit[right].T >= least
    a, b = np.nonzero(np.triu(linked, 1) if one else linked)
    a, b = left[a], right[b]
    fresh = np.ones(len(a), bool)
    for lo in range(0, len(a), PAIRS):
        fresh[lo : lo + PAIRS] = ~(keys[a[lo : lo + PAIRS], :t] == keys[b[lo : lo + PAIRS], :t]).any(1)
    return _result(table, a[fresh], b[fresh])


def near_duplicates(vectors: DataFrame, least: float = 0.93, params: Tables | None = None, id_col: str = "vec_id", label: str = "label", embedding: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Only rows with equal, non-null labels are compared, by the cosine in double precision. Null
    and zero vectors and those with null or non-finite components link with nothing; so do vectors
    of different lengths. Equal vectors of a label are one class that goes through the search once
    and counts as often as it has rows. A class meets the others of its buckets; buckets over
    BLOCK rows are cut into blocks, each pair of blocks is one task. Tasks return a count for each
    class and a spanning forest of its links, never pairs. Repeated rows are vectors of their own
    with the same id; null ids count as links but are no component's least id unless alone. Other
    columns are ignored, an empty table gives an empty one.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    of = vectors.schema[embedding].dataType
    number = "float" if isinstance(of, T.ArrayType) and isinstance(of.elementType, T.FloatType) else "double"
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(embedding).cast(f"array<{number}>").alias("embedding"))
    x = F.col("embedding")
    usable = x.isNotNull() & F.col("label").isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(x, lambda v: v != 0)
    digest = lambda c: F.unhex(F.md5(c.cast("binary")))
    same = digest(F.concat_ws(",", F.length("label").cast("string"), "label", F.to_json(x)))
    # what takes no part has classes of its own, so that it spreads over the tasks of the last join
    rows = rows.withColumn("usable", usable).withColumn("class", F.when(usable, same).otherwise(digest(F.concat(F.lit("alone "), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))))))
    classes = rows.where("usable").groupBy("class").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.any_value("label").alias("label"), F.any_value("embedding").alias("embedding"))
    classes = cut(classes, "classes")
    largest, total = (x or 0 for x in classes.groupBy("label").count().agg(F.max("count"), F.sum("count")).first())
    params = params or tables_for(largest, least)
    lots = total * params.tables // LOT + 1

    def keys(batches):
        for b in small_batches(batches):
            lengths = b.column(1).value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(lengths):
                own = b.take(pa.array(np.flatnonzero(lengths == d)))
                found = hashes(_normal(_matrix(own.column(1))), params)
                yield pa.RecordBatch.from_arrays([own.column(0), pa.array(list(found), pa.list_(pa.int32()))], names=["class", "keys"])

    keyed = cut(classes.select("class", "embedding").mapInArrow(trimmed(keys), "class binary, keys array<int>"), "keys")
    met = keyed.join(classes.select("class", "label"), "class").select("class", "label", F.posexplode("keys").alias("t", "key"))
    bucket = ["t", "label", "key"]
    sizes = met.groupBy(*bucket).agg(F.count("*").alias("size")).where("size > 1").withColumn("blocks", F.ceil(F.col("size") / BLOCK))
    met = met.join(sizes, bucket).withColumn("block", F.pmod(F.xxhash64("class"), "blocks")).withColumn("bucket", F.xxhash64(*bucket))
    payload = classes.join(keyed, "class").select("class", "n", "embedding", "keys")
    kinds = "class binary, links long, root binary"
    small = met.where(F.col("size") <= SMALL).select("class", "t", "bucket", F.pmod("bucket", F.lit(lots)).cast("int").alias("lot")).join(payload, "class")
    few = small.groupBy("lot").applyInArrow(lambda table: compare_lot(table, least), kinds)
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    tasks = met.where(F.col("size") > SMALL).select("class", *bucket, "block", other).select("class", *bucket, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).alias("second"))
    found = tasks.join(payload, "class").groupBy(*bucket, "i", "j").applyInArrow(lambda table: compare_bucket(table, least), kinds)
    found = cut(few.unionByName(found), "links")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    reps = classes.select("class", "rep", "n")
    edges = found.where("class != root").select("class", "root").distinct().join(reps.select("class", F.col("rep").alias("a")), "class").join(reps.select(F.col("class").alias("root"), F.col("rep").alias("b")), "root")
    component = connected_components(edges, "a", "b")
    per_class = reps.join(links, "class", "left").join(component, reps["rep"] == component["id"], "left").select(
        "class", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component")
    )
    own = F.coalesce("component", "vec_id")
    return rows.select("vec_id", "class").join(per_class, "class", "left").select(
        F.col("vec_id").cast(kind).alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept")
    )


#: For DuckDB: all pairs of a label. Ids must be distinct.
ORACLE_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL
  AND len(list_filter(embedding, lambda a: a IS NULL OR NOT isfinite(a))) = 0 AND len(list_filter(embedding, lambda a: a <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93::DOUBLE),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x),
{components_sql("embeddings", "vec_id")}
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN components ON id = vec_id LEFT JOIN counts ON x = vec_id
"""
