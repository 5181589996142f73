"""Training-order materialisation: fixed-stride shards of token ids in a keyed random order.

Documents are token ids of 1, 2 or 4 bytes (by default the bytes of their text, ids 0 to 255) and
are cut into sequences. Sequences are
numbered 0 to n - 1, and a keyed Feistel permutation gives each number its slot: it permutes the
next even power of two, and numbers that land at n or above walk on along their cycle until they
are below. A shard is a range of slots. Records have one length, so slot s starts at byte
(s - first slot of the shard) * stride of its shard, and reading can start or resume anywhere.

Spark's text writer makes the files: a record and a line end are one stride. So tasks that are run
again replace what they wrote before, on any file system. On their way to their shard, records are
compressed with a small dictionary of the table's own text, since one by one they compress badly.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poseframes.llm.common import scratch_dir, small_batches, trimmed

#: Tokens of a sequence, and sequences of a shard.
LENGTH, PER_SHARD = 512, 16_384
#: In front of the tokens: document id, number of the sequence in it, tokens that count.
HEAD = np.dtype([("doc_id", "<i8"), ("part", "<i4"), ("n", "<i4")])
#: Bytes of records that a task writes, about; it may write more than one shard.
TASK_BYTES = 1 << 28
PAD, NO_ID = 0, np.iinfo(np.int64).min
ROUNDS = 6
#: Texts, and characters of each, that make the dictionary. It changes the size of the shuffle only.
DICT_TEXTS, DICT_CHARS = 128, 512


def _round(half: np.ndarray, key: int, i: int, bits: int) -> np.ndarray:
    x = (half + np.uint64((key + 0x9E3779B97F4A7C15 * (i + 1)) & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) & np.uint64((1 << bits) - 1)


def slots(numbers: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slot of each number below n; a permutation of 0 to n - 1."""
    bits = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    x = np.asarray(numbers).astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> np.uint64(bits), x[todo] & np.uint64((1 << bits) - 1)
        for i in range(ROUNDS):
            left, right = right, left ^ _round(right, key, i, bits)
        x[todo] = (left << np.uint64(bits)) | right
        todo = todo[x[todo] >= np.uint64(n)]
    return x.astype(np.int64)


def _dictionary(common: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(common, dict_type=zstandard.DICT_TYPE_RAWCONTENT)} if common else {}


def stride(width: int) -> int:
    """Bytes of a record whose token ids have so many bytes each."""
    return HEAD.itemsize + LENGTH * width + 1


def write_shards(docs: DataFrame, folder: str, key: int = 1, text: str = "text", id_col: str = "doc_id", width: int = 1) -> int:
    """Write the shards of ``docs`` below ``folder`` (``shard=<number>/``); returns how many
    sequences there are.

    ``text`` is a text or a binary column with token ids of ``width`` bytes, little end first. The
    sequences of a partition follow those of the partitions before it, so ``docs`` has to come
    from a scan, whose partitions are the same whenever it runs; a partition that differs from what
    was counted fails the job. Null and empty texts have no sequences. A null id is written as the least 64-bit integer. Repeated rows have sequences of
    their own; other columns are ignored; an empty table writes no shard.
    """
    spark = docs.sparkSession
    size = LENGTH * width
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))
    parts = F.ceil(F.octet_length("text") / size)
    counts = rows.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(parts).alias("n")).orderBy("p").collect()  # a row a partition
    first, total = {}, 0
    for r in counts:
        first[r["p"]] = total, total + int(r["n"])
        total += int(r["n"])
    if not total:
        return 0

    sample = rows.select(F.substring("text", 1, DICT_CHARS)).limit(DICT_TEXTS).collect()
    common = b"".join(r[0] for r in sample)

    def records(batches):
        z = zstandard.ZstdCompressor(level=3, write_content_size=False, **_dictionary(common))
        number, stop = first.get(TaskContext.get().partitionId(), (0, 0))
        for b in small_batches(batches, 500):
            ids = b.column(0).fill_null(NO_ID).to_numpy()
            data = b.column(1).to_pylist()
            sizes = np.array([len(d) for d in data])
            n = -(-sizes // size)
            if not n.sum():
                continue
            doc = np.repeat(np.arange(len(n)), n)
            part = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            out = np.zeros((len(doc), stride(width) - 1), np.uint8)
            head = np.zeros(len(doc), HEAD)
            head["doc_id"], head["part"], head["n"] = ids[doc], part, np.minimum(sizes[doc] - part * size, size) // width
            out[:, : HEAD.itemsize] = head.view(np.uint8).reshape(len(doc), -1)
            for i, (d, p) in enumerate(zip(doc, part)):
                chunk = data[d][p * size : (p + 1) * size]
                out[i, HEAD.itemsize : HEAD.itemsize + len(chunk)] = np.frombuffer(chunk, np.uint8)
            slot = slots(np.arange(number, number + len(doc)), total, key)
            number += len(doc)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array([z.compress(r) for r in out], pa.binary())], names=["slot", "record"])
        if number != stop:
            raise ValueError("a partition has other rows than when it was counted: docs must come from a scan")

    def whole(batches):
        z = zstandard.ZstdDecompressor(**_dictionary(common))
        for b in batches:
            full = [z.decompress(r, max_output_size=stride(width)) for r in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(full, pa.binary())], names=["slot", "record"])

    made = rows.mapInArrow(trimmed(records), "slot long, record binary")
    shard = F.floor(F.col("slot") / PER_SHARD)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total * stride(width) // TASK_BYTES)
    placed = made.repartitionByRange(max(1, min(tasks, -(-total // PER_SHARD))), shard).mapInArrow(trimmed(whole), "slot long, record binary")
    # Places in a file are slots. The writer needs rows by shard; this order spares it a sort of its
    # own, which would keep the slots of a shard in order only as long as it does not spill.
    placed = placed.select(shard.alias("shard"), "slot", F.col("record").cast("string").alias("value")).sortWithinPartitions("shard", "slot")
    placed.select("shard", "value").write.partitionBy("shard").option("lineSep", "\n").text(folder)
    return total


def read_shards(spark: SparkSession, folder: str, start: int = 0, width: int = 1) -> DataFrame:
    """``slot, shard, offset, doc_id, part, n_tokens, tokens`` of the sequences from slot ``start``
    on. Shards that end before it are not opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    files = files.where(F.col("shard") >= start // PER_SHARD).select("shard", "content")

    def parse(batches):
        for b in batches:
            for shard, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                raw = np.frombuffer(data.as_buffer(), np.uint8).reshape(-1, stride(width))
                for at in range(0, len(raw), 4096):
                    part = raw[at : at + 4096]
                    head = np.ascontiguousarray(part[:, : HEAD.itemsize]).view(HEAD)[:, 0]
                    local = np.arange(at, at + len(part))
                    tokens = [r[HEAD.itemsize : HEAD.itemsize + n * width].tobytes() for r, n in zip(part, head["n"])]
                    ids = pa.array(head["doc_id"], mask=head["doc_id"] == NO_ID)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard * PER_SHARD + local), pa.array(np.full(len(local), shard)), pa.array(local * stride(width)), ids, pa.array(head["part"].astype(np.int64)), pa.array(head["n"].astype(np.int64)), pa.array(tokens, pa.binary())],
                        names=["slot", "shard", "offset", "doc_id", "part", "n_tokens", "tokens"],
                    )

    kinds = "slot long, shard long, offset long, doc_id long, part long, n_tokens long, tokens binary"
    return files.select(F.col("shard").cast("long"), "content").mapInArrow(parse, kinds).where(F.col("slot") >= start)


def materialised(docs: DataFrame, key: int = 1) -> DataFrame:
    """Write shards to the shared scratch folder and read what they hold: a row for each slot with
    the digest of its tokens."""
    spark = docs.sparkSession
    folder = f"{scratch_dir(spark)}/shards-{uuid.uuid4().hex}"
    digest = F.sha2("tokens", 256).alias("sha256")
    if not write_shards(docs, folder, key):
        return spark.createDataFrame([], "slot long, shard long, offset long, doc_id long, part long, n_tokens long, sha256 string")
    return read_shards(spark, folder).select("slot", "shard", "offset", "doc_id", "part", "n_tokens", digest)
