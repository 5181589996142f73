"""Hard negatives through an inverted multi-index over both halves of the vectors.

Each half of a vector belongs to the nearest of some centres of its own, and a pair of centres is a
cell. What a row can score with an anchor is at most the sum of two half scores: the anchor's half
times the centre, plus its norm times the radius of the cell in that half. For each anchor a heap goes
over the pairs of centres by the sum of these bounds (multi-sequence), and stops when the next bound is
below what would still count: then the rows found are certainly the first ones, whatever was left out.

Cells are packed into blocks of about BLOCK rows, larger cells are split. A block meets the anchors
that ask it: its rows come first and are held, the anchors follow as a stream. First each anchor asks
the one place with its best bound, then every block that may hold a positive at least as good as the
fifth found there; with the positives known, every block that may reach the lowest window of scores.
No row is left out, so the results are exact; how many blocks have to be asked depends on how far the
bounds tell blocks apart. Where they do not, all anchors meet all rows, block by block.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from poseframes.llm.common import bound_batches, cut, fields, trimmed

#: Rows that the centres are fitted on, at most; rounds of the fit; most centres a half. A cell has
#: about CELL rows until there are as many centres, and a block about BLOCK.
FIT_ROWS, ROUNDS, CENTRES, CELL, BLOCK = 20_000, 8, 128, 64, 1024
#: Scores are sums of products; up to here a double holds them all.
_EXACT = 1 << 53
#: Anchors whose bounds are made in one go.
_LOT = 128


def fit_centres(x: np.ndarray, k: int) -> np.ndarray:
    """Centres of the rows by Lloyd's rounds, from evenly spaced rows on."""
    k = min(k, len(x))
    if not k:
        return x
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(ROUNDS):
        of = nearest(x, centres)
        count = np.bincount(of, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, of, x)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1)[None] - 2 * x @ centres.T).argmin(1)


@dataclass
class Index:
    """Centres of both halves, and the cells with their radii; cells of one unit stand together. A
    unit is one block of several cells, or one cell in several blocks."""

    width: int
    centres: tuple[np.ndarray, np.ndarray]
    cells: np.ndarray  # pairs of centres
    radii: np.ndarray
    unit_starts: np.ndarray
    first_block: np.ndarray
    blocks: np.ndarray

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.width // 2], x[:, self.width // 2 :]

    def unit_bounds(self, x: np.ndarray) -> np.ndarray:
        """For each vector and unit the most that a row there can score."""
        if not len(self.cells):
            return np.empty((len(x), 0))
        total = 0
        for h, half in enumerate(self.halves(x)):
            total = total + (half @ self.centres[h].T)[:, self.cells[:, h]] + np.sqrt((half * half).sum(1))[:, None] * self.radii[None, :, h]
        return np.maximum.reduceat(_safe(total), self.unit_starts, axis=1)


def _safe(bound):
    """A bound that no rounding puts below the score."""
    return bound + np.abs(bound) * 1e-9 + 1


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _lengths(column: pa.Array) -> np.ndarray:
    return column.value_lengths().to_numpy(zero_copy_only=False)


class _Block:
    """The rows of one block by cell, and how an anchor searches them."""

    def __init__(self, table: pa.Table, index: Index, exact: bool):
        table = table.sort_by([("i", "ascending"), ("j", "ascending")]).combine_chunks()
        self.ids, keys = table["vec_id"].to_pylist(), table["key"].to_pylist()
        self.own = {(k, i): at for at, (k, i, first) in enumerate(zip(keys, self.ids, table["first"].to_pylist(), strict=True)) if first}
        self.labels = {x: n for n, x in enumerate(table["label"].unique().to_pylist())}
        self.label = np.array([self.labels[x] for x in table["label"].to_pylist()])
        self.width, self.index = _lengths(table["q"].combine_chunks()), index
        flat = table["q"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64 if exact else np.int64)
        self.rows = np.split(flat, np.cumsum(self.width)[:-1]) if len(set(self.width)) > 1 else flat.reshape(len(self.ids), -1)
        i, j, radius = table["i"].to_numpy(), table["j"].to_numpy(), np.stack([table["r1"].to_numpy(), table["r2"].to_numpy()], 1)
        starts = np.flatnonzero(np.r_[True, (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
        stops = np.r_[starts[1:], len(i)]
        self.cells = {(int(i[a]), int(j[a])): (int(a), int(b)) for a, b in zip(starts, stops, strict=True)}
        widest = np.maximum.reduceat(radius, starts)
        self.radii = {c: r for c, r in zip(self.cells, widest, strict=True)}
        self.codes = [np.unique(i[starts]), np.unique(j[starts])]
        self.most = [np.array([widest[x[starts] == c, h].max() for c in self.codes[h]]) for h, x in enumerate((i, j))]

    def visit(self, q: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """Cells by falling bound: the bound of all that follow, and the rows from - to."""
        if self.codes[0][0] < 0:  # vectors of other lengths have no cells
            for start, stop in self.cells.values():
                yield np.inf, start, stop
            return
        x = q.astype(np.float64)
        halves = self.index.halves(x[None])
        half = [h[0] @ self.index.centres[n][self.codes[n]].T for n, h in enumerate(halves)]
        norm = [float(np.sqrt((h[0] * h[0]).sum())) for h in halves]
        bound = [half[n] + norm[n] * self.most[n] for n in (0, 1)]
        order = [np.argsort(-b, kind="stable") for b in bound]
        u, v = (b[o].tolist() for b, o in zip(bound, order, strict=True))
        heap, seen = [(-(u[0] + v[0]), 0, 0)], {(0, 0)}
        while heap:
            most, a, b = heapq.heappop(heap)
            cell = (int(self.codes[0][order[0][a]]), int(self.codes[1][order[1][b]]))
            yield _safe(-most), *self.cells.get(cell, (0, 0))
            for step in ((a + 1, b), (a, b + 1)):
                if step[0] < len(u) and step[1] < len(v) and step not in seen:
                    seen.add(step)
                    heapq.heappush(heap, (-(u[step[0]] + v[step[1]]), *step))

    def scores(self, q: np.ndarray, start: int, stop: int) -> np.ndarray:
        if isinstance(self.rows, np.ndarray):
            return self.rows[start:stop] @ q if self.rows.shape[1] == len(q) else np.empty(0)
        return np.array([r @ q if len(r) == len(q) else -np.inf for r in self.rows[start:stop]])

    def positives(self, q: np.ndarray, label, own: int, least: float, n: int) -> list[tuple]:
        """The first n rows of the label that score ``least`` or more."""
        code, best = self.labels.get(label, -1), []
        if code < 0:
            return best
        for bound, start, stop in self.visit(q):
            if bound < (best[-1][0] if len(best) == n else least):
                break
            s = self.scores(q, start, stop)
            at = np.flatnonzero((s >= (best[-1][0] if len(best) == n else least)) & (self.label[start:stop][: len(s)] == code))
            best = _first(best, ((int(s[k]), self.ids[start + k]) for k in at.tolist() if start + k != own), n)
        return best

    def negatives(self, q: np.ndarray, label, windows: list[int], n: int) -> dict[int, list[tuple]]:
        """For each score of a positive, the first n rows of other labels in its window."""
        code, best = self.labels.get(label, -1), {w: [] for w in windows}
        need = {w: -(-80 * w // 100) for w in windows}
        for bound, start, stop in self.visit(q):
            if bound < min(need.values()):
                break
            s = self.scores(q, start, stop)
            other = self.label[start:stop][: len(s)] != code
            for w in windows:
                at = np.flatnonzero(other & (s >= need[w]) & (s <= w))
                if len(at):
                    best[w] = _first(best[w], ((int(s[k]), self.ids[start + k]) for k in at.tolist()), n)
                    need[w] = best[w][-1][0] if len(best[w]) == n else need[w]
        return best


def _first(best: list[tuple], more: Iterable[tuple], n: int) -> list[tuple]:
    """The first n of both by falling score, then rising id, null ids last."""
    return sorted([*best, *more], key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:n]


_ASK = ["block", "anchor", "key", "vec_id", "label", "q", "least", "windows"]


def _asked(index: Index, exact: bool, n: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For partitions in which a block's rows come before those that ask it."""

    def run(batches):
        block, parts, at = None, [], None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            blocks, asks = table["block"].to_numpy(), table["asks"].to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.r_[True, (blocks[1:] != blocks[:-1]) | (asks[1:] != asks[:-1])])
            out = []
            for lo, hi in zip(edges, [*edges[1:], len(blocks)], strict=True):
                piece = table.slice(lo, hi - lo)
                if blocks[lo] != at:
                    at, block, parts = blocks[lo], None, []
                if not asks[lo]:
                    parts.append(piece)
                    continue
                if block is None:
                    if not parts:
                        continue
                    block, parts = _Block(pa.concat_tables(parts), index, exact), []
                for a in piece.select(["anchor", "key", "vec_id", "label", "q", "least", "windows"]).to_pylist():
                    q = np.array(a["q"], np.float64 if exact else np.int64)
                    if a["windows"] is None:
                        own = block.own.get((a["key"], a["vec_id"]), -1)
                        least = -np.inf if a["least"] is None else a["least"]
                        out += [(a["anchor"], None, i, s) for s, i in block.positives(q, a["label"], own, least, n)]
                    else:
                        out += [(a["anchor"], w, i, s) for w, best in block.negatives(q, a["label"], a["windows"], n).items() for s, i in best]
            if out:
                kinds = [pa.string(), pa.int64(), batch.schema.field("vec_id").type, pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds, strict=True)], names=["anchor", "window", "id", "score"])

    return run


def _placed(index: Index, known: dict[tuple[int, int], tuple[int, int]]) -> Callable:
    """Rows with their block; ``known`` has each cell's first block and the blocks it is split into."""

    def run(batches):
        for b in batches:
            i, j, pieces = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("i", "j", "spread"))
            at = [known[cell] for cell in zip(i.tolist(), j.tolist(), strict=True)]
            block = np.array([first + s % n for (first, n), s in zip(at, pieces.tolist(), strict=True)], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(block), *b.columns], names=["block", *b.schema.names])

    return run


def _celled(index: Index) -> Callable:
    """Rows with their cell and their distances from its centres."""

    def run(batches):
        for b in batches:
            q = b.column(b.schema.get_field_index("q"))
            length = _lengths(q)
            i, j = np.full(len(length), -1, np.int32), (length % 64).astype(np.int32)
            r = np.zeros((2, len(length)))
            use = np.flatnonzero(length == index.width)
            if len(use):
                x = _rows(q.take(pa.array(use)), index.width)
                for h, (half, code) in enumerate(zip(index.halves(x), (i, j), strict=True)):
                    code[use] = nearest(half, index.centres[h])
                    away = half - index.centres[h][code[use]]
                    r[h, use] = np.sqrt((away * away).sum(1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(i), pa.array(j), pa.array(r[0]), pa.array(r[1])], names=[*b.schema.names, "i", "j", "r1", "r2"])

    return run


def _asking(index: Index, others: list[tuple[int, int, int]], best_only: bool) -> Callable:
    """For each anchor the units whose bound reaches ``least``: first block and number of blocks. With
    ``best_only`` just the one of the best bound. ``others``: length mod 64, first block, blocks."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, _LOT):
                b = batch.slice(lo, _LOT)
                q, least = b.column(b.schema.get_field_index("q")), b.column(b.schema.get_field_index("least")).to_numpy(zero_copy_only=False).astype(np.float64)
                length = _lengths(q)
                use = np.flatnonzero(length == index.width)
                who, first, n = [], [], []
                if len(use):
                    bound = index.unit_bounds(_rows(q.take(pa.array(use)), index.width))
                    if best_only:
                        a, unit = np.arange(len(use)), bound.argmax(1)
                    else:
                        a, unit = np.nonzero(bound >= np.where(np.isnan(least[use]), -np.inf, least[use])[:, None])
                    who, first, n = [use[a]], [index.first_block[unit]], [index.blocks[unit]]
                for k in np.flatnonzero(length != index.width):
                    for of, start, blocks in others:
                        if of == length[k] % 64:
                            who.append([k]), first.append([start]), n.append([blocks])
                if who:
                    who, first, n = (np.concatenate(x).astype(np.int64) for x in (who, first, n))
                    took = b.take(pa.array(who))
                    yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(n), *took.columns], names=["start", "blocks", *b.schema.names])

    return run


def build_index(rows: DataFrame, total: int, width: int) -> tuple[DataFrame, Index, list[tuple[int, int, int]]]:
    """``rows`` with their cells and blocks, the index, and the blocks of vectors of other lengths."""
    sample = rows.where(F.size("q") == width).orderBy(F.xxhash64("key"), "vec_id").select(F.col("q").cast("array<double>").alias("q")).limit(FIT_ROWS).toArrow()
    x = _rows(sample["q"].combine_chunks(), width) if sample.num_rows else np.empty((0, width))
    k = int(np.clip(np.sqrt(total / CELL), 1, CENTRES))
    index = Index(width, (np.empty((0, 0)),) * 2, np.empty((0, 2), int), np.empty((0, 2)), *(np.empty(0, np.int64) for _ in range(3)))
    index.centres = tuple(fit_centres(h, k) for h in index.halves(x))
    celled = cut(rows.mapInArrow(trimmed(_celled(index)), f"{fields(rows.schema)}, i int, j int, r1 double, r2 double"), "cells")
    cells = celled.groupBy("i", "j").agg(F.count("*").alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).orderBy("i", "j").collect()  # CENTRES squared and 64 at most
    known, others, starts, firsts, counts, block, filled, kept = {}, [], [], [], [], 0, 0, []
    for c in cells:
        size = -(-c["n"] // BLOCK)
        if c["i"] < 0:
            known[c["i"], c["j"]] = (block, size)
            others.append((c["j"], block, size))
            block += size
            continue
        if size > 1 or not kept or filled + c["n"] > BLOCK:
            starts.append(len(kept))
            firsts.append(block)
            counts.append(size)
            block += size
            filled = c["n"] if size == 1 else BLOCK
        else:
            filled += c["n"]
        known[c["i"], c["j"]] = (firsts[-1], counts[-1])
        kept.append(c)
    index.cells = np.array([(c["i"], c["j"]) for c in kept], int).reshape(-1, 2)
    index.radii = np.array([(c["r1"], c["r2"]) for c in kept], float).reshape(-1, 2)
    index.unit_starts, index.first_block, index.blocks = (np.array(v, np.int64) for v in (starts, firsts, counts))
    spread = celled.withColumn("spread", F.pmod(F.xxhash64("key", "copy"), F.lit(1 << 30)))
    placed = spread.mapInArrow(trimmed(_placed(index, known)), f"block long, {fields(spread.schema)}").drop("spread")
    return cut(placed, "blocks"), index, others


def mine(vectors: DataFrame, is_anchor: str, n_positives: int = 5, n_negatives: int = 5, scale: int = 256, id_col: str = "vec_id", label: str = "label", embedding: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A component x counts as floor(scale * x), a score is the inner product of two rows. The anchors are
    the rows for which the SQL condition ``is_anchor`` over ``id`` holds. An anchor's positives are its
    first rows of the same label, its negatives for each of them the first rows of other labels whose
    score is between four fifths of the positive's and the positive's, so none if that is negative.
    First is who scores more, among equals the smaller id; a null id comes last.

    Rows with a null label or vector, or with a null or non-finite component, take no part. Rows with
    equal labels and vectors count one by one, but only as many of them travel as could be returned:
    their ids are the smallest. Repeated anchors repeat their results. Vectors meet those of the same
    length only; scores have to fit in a long. Other columns are ignored, an empty table gives an
    empty one.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    c = lambda name: F.col(f"`{name}`")
    x = c(embedding)
    sound = x.isNotNull() & c(label).isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    rows = vectors.where(sound).select(c(id_col).alias("vec_id"), c(label).cast("string").alias("label"), F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("q"))
    lengths = rows.groupBy(F.size("q").alias("width")).agg(F.count("*").alias("n"), F.max(F.array_max(F.transform("q", lambda v: F.abs(v)))).alias("top"))
    common = lengths.agg(F.sum("n").alias("n"), F.max("top").alias("top"), F.max(F.struct("n", "width")).alias("most"), F.max("width").alias("longest")).first()
    total, top, longest = common["n"] or 0, common["top"] or 0, common["longest"] or 0
    exact = top * top * longest < _EXACT
    kind = "smallint" if top < 1 << 15 else "int" if top < 1 << 31 else "bigint"
    rows = rows.withColumn("q", F.col("q").cast(f"array<{kind}>")).withColumn("key", F.unhex(F.md5(F.concat_ws(",", F.length("label").cast("string"), "label", F.to_json("q")).cast("binary"))))
    same = W.partitionBy("key").orderBy(F.col("vec_id").asc_nulls_last())
    few = rows.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= max(n_positives + 1, n_negatives))
    few = few.withColumn("first", (F.col("copy") == 1) | ~F.lag("vec_id").over(same).eqNullSafe(F.col("vec_id")))
    index_rows, index, others = build_index(few, total, (common["most"] or {"width": 0})["width"])
    name = F.concat(F.hex("key"), F.lit(":"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    anchors = rows.withColumn("id", F.col("vec_id")).where(is_anchor).groupBy("key", "vec_id").agg(F.any_value("label").alias("label"), F.any_value("q").alias("q"), F.count("*").alias("times"))
    anchors = cut(anchors.withColumn("anchor", name), "anchors")

    def found(asking: DataFrame, best_only: bool = False) -> DataFrame:
        """``anchor, window, id, score`` from all blocks that the anchors ask."""
        asking = asking.select("anchor", "key", "vec_id", "label", "q", "least", "windows")
        asks = asking.mapInArrow(trimmed(_asking(index, others, best_only)), f"start long, blocks long, {fields(asking.schema)}")
        asks = asks.select(F.explode(F.sequence("start", F.col("start") + F.col("blocks") - 1)).alias("block"), *asking.columns, F.lit(True).alias("asks"))
        both = index_rows.withColumn("asks", F.lit(False)).unionByName(asks, allowMissingColumns=True)
        both = both.repartition("block").sortWithinPartitions("block", "asks")
        return both.mapInArrow(trimmed(_asked(index, exact, max(n_positives, n_negatives))), f"anchor string, window long, id {rows.schema['vec_id'].dataType.simpleString()}, score long")

    def first(df: DataFrame, n: int, *by: str) -> DataFrame:
        order = W.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

    nothing = {"least": F.lit(None).cast("long"), "windows": F.lit(None).cast("array<long>")}
    seeds = first(found(anchors.withColumns(nothing), True), n_positives, "anchor").groupBy("anchor").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    seeds = seeds.select("anchor", F.when(F.col("n") == n_positives, F.col("least")).alias("least"))
    asking = anchors.join(seeds, "anchor", "left").withColumn("windows", nothing["windows"])
    positives = cut(first(found(asking), n_positives, "anchor").select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    windows = positives.where("positive_score >= 0").groupBy("anchor").agg(F.sort_array(F.collect_set("positive_score")).alias("windows"))
    asking = anchors.join(windows.withColumn("least", F.ceil(F.element_at("windows", 1) * F.lit(80) / 100)), "anchor")
    negatives = first(found(asking), n_negatives, "anchor", "window")
    done = positives.join(negatives.withColumnRenamed("window", "positive_score"), ["anchor", "positive_score"]).join(anchors.select("anchor", "vec_id", "times"), "anchor")
    return done.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select(
        F.col("vec_id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


#: For DuckDB: every anchor with every row. Ids must be distinct, vectors of one length.
ORACLE_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score QUALIFY rank <= 5
"""
