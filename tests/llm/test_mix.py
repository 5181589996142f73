"""Targets and copies against a plain loop."""

import random

from pyspark.sql import functions as F

from poseframes.llm import source_mix as M


def targets(sizes):
    """By rounds: share by weight, stop at the cap, share the rest again."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + ([None] if None in sizes else [])
    weight = {n: M.WEIGHTS[i % 3] for i, n in enumerate(names)}
    out, left, open_ = dict.fromkeys(names, 0.0), M.SHARE * sum(sizes.values()), set(names)
    while open_:
        level = left / sum(weight[n] for n in open_)
        full = {n for n in open_ if level * weight[n] >= 2 * sizes[n]}
        if not full:
            return out | {n: level * weight[n] for n in open_}
        for n in full:
            out[n] = 2.0 * sizes[n]
            left -= out[n]
        open_ -= full
    return out


def test_targets_and_copies(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice(["a", "a", "a", "b", "ä", "Z", None]), " ".join(["w"] * rng.choice([0, 1, 5, 5, 5, 40])) or None, i) for i in range(600)]
    df = spark.createDataFrame(rows + [(7, "a", "x y", 1)] * 3 + [(None, "b", "x", 1)] * 2, "doc_id long, source string, text string, size long")
    got = M.systematic_copies(df).collect()
    size = {}
    for r in got:
        assert r["_size"] == len((r["text"] or "").split()) and 0 <= r["_copies"] <= 2
        size[r["source"]] = size.get(r["source"], 0) + r["_size"]
    want = targets(size)
    for s, t in want.items():
        own = [r for r in got if r["source"] == s]
        assert all(abs(r["_target"] - t) < 1e-6 and r["_source_size"] == size[s] for r in own)
        assert abs(sum(r["_size"] * r["_copies"] for r in own) - t) <= 2 * max(r["_size"] for r in own)
    mixed = M.mix(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r["_copies"] for r in got)
    again = M.systematic_copies(df.repartition(7)).groupBy("doc_id").agg(F.sum("_copies")).collect()
    first = M.systematic_copies(df).groupBy("doc_id").agg(F.sum("_copies")).collect()
    assert sorted(again, key=str) == sorted(first, key=str)


def test_columns_of_any_name(spark):
    df = spark.createDataFrame([(i, "a", "x y", i, i + 1, i + 2, "s", 0.5) for i in range(6)], "doc_id long, source string, text string, _size long, _copies long, _mix_place long, _source string, _target double")
    got = M.systematic_copies(df)
    assert got.columns == [*df.columns, "_size_", "_source_size", "_target_", "_copies_"]
    assert sorted(tuple(r[:8]) for r in got.collect()) == sorted(map(tuple, df.collect())) and {r["_size_"] for r in got.collect()} == {2}
    assert {tuple(r) for r in M.mix(df).collect()} <= {tuple(r) for r in df.collect()}


def test_no_words_and_no_rows(spark):
    schema = "doc_id long, source string, text string"
    assert M.systematic_copies(spark.createDataFrame([], schema)).collect() == []
    got = M.systematic_copies(spark.createDataFrame([(1, "a", None), (2, None, " \n")], schema)).collect()
    assert [(r["_target"], r["_copies"]) for r in got] == [(0.0, 0)] * 2


def test_plan_has_no_python(spark):
    plan = M.mix(spark.createDataFrame([(1, "a", "x")], "doc_id long, source string, text string").repartition(2))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan.replace("Scan ExistingRDD", "") for x in ("Python", "Arrow", "Pandas"))
