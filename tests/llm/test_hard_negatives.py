"""Hard negatives against a plain loop over all rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from poseframes.llm import hard_negatives as H

KINDS = "vec_id long, embedding array<double>, label int"


def expected(rows, is_anchor, n=5):
    sound = [(i, [math.floor(256 * x) for x in e], lab) for i, e, lab in rows if lab is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for a, (i, q, lab) in enumerate(sound):
        if i is None or not is_anchor(i):
            continue
        scored = [(-sum(x * y for x, y in zip(q, p)), j is None, j or 0, j, m == lab) for b, (j, p, m) in enumerate(sound) if b != a and len(p) == len(q)]
        for s, _, _, j, _ in sorted(x for x in scored if x[4])[:n]:
            fit = sorted(x for x in scored if not x[4] and 80 * -s <= 100 * -x[0] <= 100 * -s)[:n]
            out += [(i, j, k + 1, x[3], -s, -x[0]) for k, x in enumerate(fit)]
    return sorted(out, key=str)


def mined(spark, rows, condition="id % 10 = 0"):
    got = H.mine(spark.createDataFrame(rows, KINDS), condition)
    assert got.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.fixture
def small(monkeypatch):
    """Many cells and blocks on few rows."""
    monkeypatch.setattr(H, "CELL", 6)
    monkeypatch.setattr(H, "BLOCK", 20)
    monkeypatch.setattr(H, "FIT_ROWS", 300)


def cloud(rng, n, width=9, groups=8):
    centre = rng.normal(size=(groups, width))
    return [(i, (centre[i % groups] + 0.3 * rng.normal(size=width)).round(2).tolist(), int(rng.integers(3))) for i in range(n)]


def test_equals_plain_loop(spark, small):
    rows = cloud(np.random.default_rng(1), 500)
    want = expected(rows, lambda i: i % 10 == 0)
    assert len(want) > 200 and mined(spark, rows) == want


def test_odd_rows(spark, small):
    rng = np.random.default_rng(2)
    rows = cloud(rng, 200)
    rows += [(1000, None, 1), (1010, [1.0, None] + [0.0] * 7, 1), (1020, [math.nan] + [1.0] * 8, 1), (1030, [math.inf] * 9, 1), (1040, [1.0] * 9, None), (1050, [0.0] * 9, 0), (1060, [], 1), (1061, [], 2), (1070, [1.0, 2.0], 1), (1071, [2.0, 1.0], 1), (1072, [2.0, 0.9], 2)]
    rows += [(None, rows[0][1], rows[0][2]), (None, rows[0][1], (rows[0][2] + 1) % 3)]  # rows without an id count
    rows += [rows[10], rows[20], rows[20], rows[33]]  # repeated rows, anchors among them
    want = expected(rows, lambda i: i % 10 == 0)
    assert {1070, 20} <= {r[0] for r in want} and mined(spark, rows) == want


def test_hot_copies_and_ties(spark, small):
    """A third of the rows are one vector, in two labels; few values, so many scores are equal."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-1, 2, 6).astype(float).tolist(), int(rng.integers(2))) for i in range(300)]
    rows += [(i, [1.0, 1.0, 0.0, 1.0, 0.0, 0.0], i % 5 // 4) for i in range(300, 450)]
    want = expected(rows, lambda i: i % 10 == 0)
    assert mined(spark, rows) == want
    few = H.mine(spark.createDataFrame(rows, KINDS), "id % 10 = 0")
    assert few.count() == len(want)


def test_large_components_and_floats(spark, small):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=4) * 2.0**18).tolist(), i % 3) for i in range(120)]  # products need whole numbers
    assert mined(spark, rows) == expected(rows, lambda i: i % 10 == 0)
    floats = spark.createDataFrame([(i, e, lab) for i, e, lab in cloud(rng, 80)], "vec_id long, embedding array<float>, label int").collect()
    rows = [(r[0], list(r[1]), r[2]) for r in floats]
    assert mined(spark, rows) == expected(rows, lambda i: i % 10 == 0)


@pytest.mark.parametrize("rows", [[], [(10, [1.0, 2.0], 1)], [(10, [1.0], 1), (20, [1.0], 1)], [(10, None, None)]])
def test_small_tables(spark, rows):
    assert mined(spark, rows) == []


def test_clashing_columns(spark, small):
    rows = cloud(np.random.default_rng(5), 100)
    more = spark.createDataFrame(rows, KINDS).withColumns({c: F.lit(1) for c in ("id", "q", "key", "copy", "first", "block", "i", "anchor", "times", "a.b")}).withColumnRenamed("embedding", "e.e")
    got = sorted((tuple(r) for r in H.mine(more, "id % 10 = 0", embedding="e.e").collect()), key=str)
    assert got == expected(rows, lambda i: i % 10 == 0)


def test_bounds_prune_and_hold(spark, small):
    """No bound is below a score, and in separate groups an anchor asks few of the blocks."""
    rng = np.random.default_rng(6)
    rows = [(i, (10 * np.eye(12)[i % 12] + 0.1 * rng.normal(size=12)).tolist(), int(rng.integers(2))) for i in range(600)]
    df = spark.createDataFrame([(i, [math.floor(256 * x) for x in e], str(lab), bytes([i % 256, i // 256])) for i, e, lab in rows], "vec_id long, q array<int>, label string, key binary").withColumns({"copy": F.lit(1), "first": F.lit(True)})
    placed, index, others = H.build_index(df, 600, 12)
    blocks = placed.groupBy("block").count().collect()
    assert not others and sum(b["count"] for b in blocks) == 600 and max(b["count"] for b in blocks) <= 60
    x = np.array([[math.floor(256 * v) for v in e] for _, e, _ in rows], float)
    bound = index.unit_bounds(x[:50])
    unit = np.repeat(np.arange(len(index.blocks)), index.blocks)
    at = {r["vec_id"]: unit[r["block"]] for r in placed.select("vec_id", "block").collect()}
    score = x[:50] @ x.T
    assert all(bound[a, at[b]] >= score[a, b] for a in range(50) for b in range(600))
    fifth = np.sort(score, 1)[:, -6]
    assert (bound >= fifth[:, None]).mean() < 0.4
