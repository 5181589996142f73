"""WARC fixity and training-order shards."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from poseframes.llm import training_order as O
from poseframes.llm import warc_fixity as X

SCHEMA = "page_id long, url string, html string, digest string"


def test_damage_is_found_where_it_is(spark):
    pages = [(i, f"http://x/{i}", f"<p>{i}é</p>", "z") for i in [*range(40), *range(1000, 1100), 70_000, -5]] + [(None, "u", None, "z"), (None, None, "q", "z"), (3, "twice", "r", "z")]
    worn = [p if p[0] not in (7, 1050, 70_000) else (p[0], p[1], p[2] + "!", "z") for p in pages if p[0] != 1099]
    ours, theirs = (spark.createDataFrame(p, SCHEMA) for p in (pages, worn))
    got = X.audit(ours, theirs).collect()
    assert len(got) == len(pages)
    assert {r["page_id"] for r in got if r["damaged"]} == {7, 1050, 70_000, 1099}
    for r in got:
        before = [q for q in got if q["file"] == r["file"] and q["offset"] < r["offset"]]
        assert r["offset"] == sum(q["n_bytes"] for q in before)
    one = next(r for r in got if r["page_id"] == 5)
    record = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://x/5\r\nContent-Type: text/html\r\nContent-Length: 10\r\n\r\n<p>5é</p>\r\n\r\n".encode()
    assert (one["n_bytes"], one["sha256"]) == (len(record), hashlib.sha256(record).hexdigest())


def test_equal_replicas_and_no_rows(spark):
    pages = spark.createDataFrame([(1, "a", "b", "z")], SCHEMA)
    assert [r["damaged"] for r in X.audit(pages, pages).collect()] == [False]
    assert X.audit(pages.limit(0), pages.limit(0)).collect() == []


def test_a_lost_or_repeated_record_moves_no_other(spark):
    pages = [(i, f"http://x/{i}", f"<p>{i}</p>", "z") for i in range(100)] + [(None, f"u{i}", "n", "z") for i in range(9)] + [(5, "http://x/5", "<p>5</p>", "z"), (5, "other", "q", "z")]
    theirs = [p for p in pages if p[0] != 3 and p[1] != "u4"]
    theirs[-1] = (5, "other", "changed", "z")
    got = X.audit(*(spark.createDataFrame(p, SCHEMA) for p in (pages, theirs))).collect()
    assert len(got) == len(pages) and sorted((r["page_id"], r["n_bytes"]) for r in got if r["damaged"] and r["page_id"] is not None) == sorted((r["page_id"], r["n_bytes"]) for r in got if r["page_id"] == 3 or r["page_id"] == 5 and r["n_bytes"] == min(q["n_bytes"] for q in got if q["page_id"] == 5))
    assert sum(r["damaged"] for r in got if r["page_id"] is None) == 1


def feistel(number, n, key):
    """One number's slot by the definition, in plain integers."""
    bits = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    word, half = 2**64 - 1, 2**bits - 1
    while True:
        left, right = number >> bits, number & half
        for i in range(O.ROUNDS):
            x = (right + key + 0x9E3779B97F4A7C15 * (i + 1)) * 0xBF58476D1CE4E5B9 & word
            x = (x ^ x >> 27) * 0x94D049BB133111EB & word
            left, right = right, left ^ (x ^ x >> 31) & half
        number = left << bits | right
        if number < n:
            return number


@pytest.mark.parametrize("n", [1, 2, 5, 300, 5000])
def test_slots_are_those_of_the_definition(n):
    assert O.slots(np.arange(n), n, 2**61 + 7).tolist() == [feistel(i, n, 2**61 + 7) for i in range(n)]


def test_wide_token_ids_and_long_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(O, "PER_SHARD", 64)
    ids = {i: np.arange(n, dtype="<u4") * 70_001 for i, n in enumerate((0, 1, 511, 512, 513, 150_000))}
    path, folder = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(i, x.tobytes()) for i, x in ids.items()], "doc_id long, ids binary").write.parquet(path)
    n = O.write_shards(spark.read.parquet(path), folder, key=9, text="ids", width=4)
    got: dict = {}
    for r in sorted(O.read_shards(spark, folder, width=4).collect(), key=lambda r: r["part"]):
        assert r["offset"] == r["slot"] % 64 * O.stride(4) and r["n_tokens"] * 4 == len(r["tokens"])
        got.setdefault(r["doc_id"], []).append(bytes(r["tokens"]))
    assert n > 4 * 64 and {i: b"".join(t) for i, t in got.items()} == {i: x.tobytes() for i, x in ids.items() if len(x)}


def test_other_partitions_than_counted_fail(spark, tmp_path):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.when(F.rand() < 0.5, F.lit("a")).otherwise(F.lit("b" * 600)).alias("text"))
    moving = docs.withColumn("text", F.expr("if(shiftright(unix_micros(now()), 3) % 2 = 0, text, text || repeat('x', cast(rand() * 5000 as int)))"))
    with pytest.raises(Exception, match="when it was counted"):
        for i in range(8):
            O.write_shards(moving.withColumn("text", F.concat("text", F.repeat(F.lit("y"), (F.unix_micros(F.now()) % 9973).cast("int")))), str(tmp_path / str(i)))


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 4097])
def test_slots_are_a_permutation(n):
    got = O.slots(np.arange(n), n, 99)
    assert sorted(got.tolist()) == list(range(n)) and (n < 1000 or (got != O.slots(np.arange(n), n, 98)).any())


def test_shards_hold_every_sequence(spark, tmp_path, monkeypatch):
    texts = [None, "", "a", "é" * 700, "x\ny" * 900, "\x00\n" * 300, "b" * 512, "b" * 512]
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(None, "no id", 0)]
    path = str(tmp_path / "in")
    spark.createDataFrame(rows, "doc_id int, text string, slot int").write.parquet(path)
    docs, folder = spark.read.parquet(path), str(tmp_path / "out")
    n = O.write_shards(docs, folder, key=3)
    got = sorted(O.read_shards(spark, folder).collect(), key=lambda r: r["slot"])
    want = sorted(((i, p, (t or "").encode()[p * 512 : p * 512 + 512]) for i, t, _ in rows for p in range(-(-len((t or "").encode()) // 512))), key=str)
    assert [r["slot"] for r in got] == list(range(n))
    assert sorted(((r["doc_id"], r["part"], bytes(r["tokens"])) for r in got), key=str) == want
    assert [r["slot"] for r in sorted(O.read_shards(spark, folder, start=4).collect(), key=lambda r: r["slot"])] == list(range(4, n))


def test_no_text_no_shards(spark):
    assert O.materialised(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect() == []


def test_slots_are_in_place_when_tasks_spill(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(O, "PER_SHARD", 256)
    path, folder = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(i, f"{i} " * 700) for i in range(700)], "doc_id long, text string").coalesce(1).write.parquet(path)
    docs = spark.read.parquet(path)
    assert docs.rdd.getNumPartitions() == 1
    conf, key = spark._jvm.org.apache.spark.SparkEnv.get().conf(), "spark.shuffle.spill.numElementsForceSpillThreshold"
    conf.set(key, "100")
    try:
        n = O.write_shards(docs, folder, key=5)
    finally:
        conf.remove(key)
    order = [(r["doc_id"], p) for r in docs.collect() for p in range(-(-len(r["text"]) // 512))]
    want = dict(zip(order, O.slots(np.arange(n), n, 5).tolist(), strict=True))
    got = {(r["doc_id"], r["part"]): r["slot"] for r in O.read_shards(spark, folder).collect()}
    assert n > 8 * 256 and got == want
