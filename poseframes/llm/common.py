"""What several operators share: scratch tables in the shared folder, text columns, vocabularies."""

from __future__ import annotations

import base64
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@lru_cache(maxsize=1)
def _own_scratch() -> str:
    return tempfile.mkdtemp(prefix="spark-")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names. Where it is unset, a folder of one's
    own stands in for it if Spark runs in this process alone, as in tests; on a cluster, executors
    could not read what others write there, so it has to be set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = _own_scratch()
    return folder.rstrip("/")


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared scratch folder and read it back.

    What follows no longer depends on the executors that made it, and is not computed twice.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches by bytes, since 10,000 long texts in one are too many for a small executor;
    a limit that the session already has stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


#: Bytes of an Arrow batch that goes to Python.
BATCH_BYTES = 4 << 20


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """``names``, with low lines behind those that clash with a column in ``taken``."""
    used, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def fields(schema: T.StructType) -> str:
    """The schema as a string that Arrow functions take."""
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


#: Blocks of memory from this size on go back to the system when they are freed, and others when a
#: task has ended or a group of this many bytes.
RETURNED, LARGE = 1 << 20, 1 << 22


@lru_cache(maxsize=1)
def _libc():
    """The C library, told once in a worker to keep no large free blocks; None if it can't."""
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        lib = ctypes.CDLL(None)
        lib.mallopt(-3, RETURNED)  # M_MMAP_THRESHOLD
        lib.malloc_trim  # noqa: B018
        return lib
    except (OSError, AttributeError):
        return None


def trim(used: int = LARGE) -> None:
    """Give a Python worker's free memory back, which would else stay with it for later tasks; not
    worth the time where little was ``used``."""
    lib = _libc()
    if lib is not None and used >= LARGE:
        lib.malloc_trim(0)


def trimmed(run: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A function of ``mapInArrow`` that trims its worker when a task ends."""

    @wraps(run)
    def wrapped(batches):
        trim()
        yield from run(batches)
        trim()

    return wrapped


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def byte_batches(texts, most: int):
    """Lists of positions of ``texts`` (strings) whose UTF-8 lengths add up to about ``most``."""
    group, size = [], 0
    for i, x in enumerate(texts):
        if group and size + len(x) > most:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(x)
    if group:
        yield group


def small_batches(batches, rows: int = 1000):
    """Arrow batches of at most ``rows`` rows, so that what is derived from one stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


@lru_cache(maxsize=4)
def ranks_of(path: str) -> dict[bytes, int]:
    """The ranks of a ``.tiktoken`` file: base64 of the bytes, then the rank, on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
