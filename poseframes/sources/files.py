"""Files where Spark has no reader: listing deep trees on executors, and clips in NumPy archives.

Both reach any store that Arrow's file systems know (local folders, HDFS, S3, GCS), given by address.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.fs as pfs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from poseframes.params import N_POINTS


def _store(address: str) -> tuple[pfs.FileSystem, str]:
    """The file system of an address or full path, and the path in it."""
    if address.startswith(("/", "file:")):
        return pfs.LocalFileSystem(), "/" + address.removeprefix("file:").lstrip("/")
    return pfs.FileSystem.from_uri(quote(address, safe=":/@?=&%"))


def walk(spark: SparkSession, root: str, scratch: str) -> DataFrame:
    """``rel_path, size`` of every file below ``root``. Folders are rows: each level's are listed by the
    tasks and written to ``scratch``, a new folder in the shared store, so the driver never holds a list
    of files and a lost executor costs the listing of a few folders."""
    base = _store(root)[1].rstrip("/")

    def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = _store(root)[0]
        for b in batches:
            for folder in b.column(0).to_pylist():
                found = fs.get_file_info(pfs.FileSelector(f"{base}/{folder}" if folder else base))
                for lo in range(0, len(found), 10_000):
                    part = found[lo : lo + 10_000]
                    paths = [f.path[len(base) + 1 :] for f in part]
                    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array([f.type == pfs.FileType.Directory for f in part]), pa.array([f.size for f in part], pa.int64())], names=["rel_path", "is_folder", "size"])

    level, folders = 0, spark.createDataFrame([("",)], "rel_path string")
    while True:
        path = f"{scratch}/level={level}"
        folders.repartition("rel_path").mapInArrow(children, "rel_path string, is_folder boolean, size long").write.parquet(path)
        folders = spark.read.schema("rel_path string, is_folder boolean").parquet(path).where("is_folder").select("rel_path")
        if folders.isEmpty():
            break
        level += 1
    return spark.read.schema("rel_path string, is_folder boolean, size long, level int").parquet(scratch).where("NOT is_folder").select("rel_path", "size")


_FRAMES = "source string, label string, fps float, frame_idx long, xyz array<float>, mask array<boolean>"
_HEADS = "path string, source string, label string, fps float, n_frames long, error string"


@dataclass
class _Files(InputPartition):
    paths: list[str]


class NpzClips(DataSource):
    """``spark.read.format("pose_npz").load(folder)``: frames of all ``.npz`` archives in a folder but
    unfinished ones (``.tmp.npz``), with keys xyz, mask, fps, label, source; nothing is unpickled.

    Options: ``headers`` (true: a row a file without its arrays; ``error`` says what is wrong with a
    file, null if nothing), ``badFiles`` (``skip``, the default, or ``fail``; ``headers`` counts those
    skipped) and ``partitionBytes`` (files of about so many bytes are one task; 64 MB)."""

    @classmethod
    def name(cls) -> str:
        return "pose_npz"

    def schema(self) -> str:
        return _HEADS if self.options.get("headers", "false").lower() == "true" else _FRAMES

    def reader(self, schema) -> DataSourceReader:
        return _NpzReader(dict(self.options))


class _NpzReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root, self.heads = options["path"], options.get("headers", "false").lower() == "true"
        self.fail, self.bytes = options.get("badfiles", options.get("badFiles", "skip")) == "fail", int(options.get("partitionbytes", options.get("partitionBytes", 64 << 20)))

    def partitions(self) -> list[_Files]:
        fs, path = _store(self.root)
        files = sorted((f.path, f.size) for f in fs.get_file_info(pfs.FileSelector(path)) if f.path.endswith(".npz") and not f.path.endswith(".tmp.npz"))
        out, filled = [_Files([])], 0
        for name, size in files:
            if out[-1].paths and filled + size > self.bytes:
                out.append(_Files([]))
                filled = 0
            out[-1].paths.append(name)
            filled += size
        return out

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        fs = _store(self.root)[0]
        for path in partition.paths:
            try:
                with fs.open_input_file(path) as f:
                    made = _head(f, path) if self.heads else _frames(f.read())
            except Exception as e:  # noqa: BLE001 - a folder may hold files of interrupted runs
                if self.fail:
                    raise
                if not self.heads:
                    continue
                made = _batch(_HEADS, [path], [None], [None], [None], [None], [f"{type(e).__name__}: {e}"])
            yield made


_ARROW = {"string": pa.string(), "float": pa.float32(), "long": pa.int64(), "array<float>": pa.list_(pa.float32()), "array<boolean>": pa.list_(pa.bool_())}


def _batch(schema: str, *columns) -> pa.RecordBatch:
    named = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, (_, t) in zip(columns, named, strict=True)], names=[n for n, _ in named])


def _head(f, path: str) -> pa.RecordBatch:
    """Small arrays, and the shapes of the large ones from their headers."""
    shape = {}
    with zipfile.ZipFile(f) as z:
        for name in ("xyz", "mask"):
            with z.open(f"{name}.npy") as member:
                read = {(1, 0): np.lib.format.read_array_header_1_0, (2, 0): np.lib.format.read_array_header_2_0}[np.lib.format.read_magic(member)]
                shape[name] = read(member)[0]
        fps, label, source = (np.load(io.BytesIO(z.read(f"{n}.npy")), allow_pickle=False) for n in ("fps", "label", "source"))
    _check(shape["xyz"], shape["mask"])
    return _batch(_HEADS, [path], [str(source)], [str(label)], [float(fps)], [shape["xyz"][0]], [None])


def _check(xyz: tuple[int, ...], mask: tuple[int, ...]) -> None:
    if xyz != (len(xyz) and xyz[0], N_POINTS, 3) or mask != (xyz[0], N_POINTS):
        raise ValueError(f"shapes {xyz} and {mask}")


def _frames(content: bytes) -> pa.RecordBatch:
    with np.load(io.BytesIO(content), allow_pickle=False) as z:
        xyz, mask, fps, label, source = z["xyz"], z["mask"], float(z["fps"]), str(z["label"]), str(z["source"])
    _check(xyz.shape, mask.shape)
    n = len(xyz)
    return _batch(_FRAMES, [source] * n, [label] * n, [fps] * n, range(n), list(xyz.reshape(n, -1).astype(np.float32)), list(mask.astype(bool)))


def write_files(files: DataFrame, folder: str) -> None:
    """``path, content`` rows as files in a folder. Each is written under another name first, so a
    reader never sees a half of one."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _store(folder)
        fs.create_dir(base, recursive=True)
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                whole = f"{base}/{path}"
                part = f"{whole.removesuffix('.npz')}.tmp.npz"
                with fs.open_output_stream(part) as f:
                    f.write(content)
                fs.move(part, whole)
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    files.select("path", "content").mapInArrow(write, "n long").agg(F.sum("n")).collect()


def register(spark: SparkSession) -> None:
    """Make ``pose_npz`` known to a session."""
    spark.dataSource.register(NpzClips)
