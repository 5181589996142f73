"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poseframes.llm.common import cut


class Forest:
    """Union by least root over the positions of an array; for links found inside one task."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return int(i)

    def link(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)

    def roots(self) -> np.ndarray:
        up = self.up
        while (up[up] != up).any():
            up = up[up]
        return up


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each position below n the least one that the links a - b connect it with."""
    least = np.arange(n)
    while True:
        low = np.minimum(least[a], least[b])
        new = least.copy()
        for side in (a, b, least[a], least[b]):
            np.minimum.at(new, side, low)
        new = new[new]
        if (new == least).all():
            return least
        least = new


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node of distinct links ``u > v`` that has a lesser neighbour has only one, and is
    itself the lesser of none."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("up")))
    both = (F.sum("up") > 1) | ((F.max("up") == 1) & (F.min("up") == 0))
    return not ends.groupBy("id").agg(both.alias("both")).agg(F.max("both")).first()[0]


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``id`` and ``component`` (the least id that its links reach) of every id in a link.

    Each round replaces the links of a node by links to its least neighbour; rounds end when each
    component is a star around its least id. A node's least neighbour is a partial aggregate, and the joins that hand it
    to the neighbours have one row a key on that side, so a node with very many links is split.
    Links to itself, repeated and null ones do not count.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = cut(edges.distinct(), "links")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def components_sql(table: str, id_col: str) -> str:
    """For DuckDB: ``components`` (``id, component_id``) of every id of a table under ``links`` (``x,
    y`` in both directions); the query has to begin with WITH RECURSIVE."""
    return f"""reach(id, c) AS (SELECT DISTINCT {id_col}, {id_col} FROM {table} UNION SELECT l.y, r.c FROM reach r JOIN links l ON l.x = r.id),
components AS (SELECT id, min(c) AS component_id FROM reach GROUP BY id)"""
