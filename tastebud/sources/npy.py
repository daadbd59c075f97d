"""Dense matrices as ``.npy`` files: a Spark data source, ``format("npy")``.

Reading: a file, or a folder of files in the order of their names, as rows
``row`` (position, from 0) and ``values`` (array of float or double).  A file
is cut into ranges of rows of about ``rangeBytes`` (option, 32 MB by default);
a task reads its byte range only.

Writing: rows with one array column (others are ignored, so is the order inside
it of equal rows); every partition becomes one file whose name carries the
partition's number, so a table sorted before (``orderBy``) is read back in
order.  Files get their final names and the list ``_files.json`` when the job
commits; a reader of a folder with that list reads the files it names.  ``dtype``
(option): ``float64`` or ``float32``.

Paths go through ``pyarrow.fs``: a local path or any address it knows.  All
executors have to see them.
"""

from __future__ import annotations

import ast
import json
import struct
import tempfile
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

RANGE_BYTES = 32 << 20
BATCH_BYTES = 4 << 20
LIST = "_files.json"
_MAGIC = b"\x93NUMPY"
_DTYPES = {"<f4": "float32", "<f8": "float64", "|f4": "float32", "|f8": "float64"}


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        fs, inner = pafs.FileSystem.from_uri(path if "://" in path else "file://" + path[len("file:"):])
        return fs, inner
    return pafs.LocalFileSystem(), path


@dataclass
class Header:
    """What a file says about itself: rows, columns, numpy type, and where its data begin."""

    rows: int
    width: int
    dtype: str
    start: int


def read_header(fs: pafs.FileSystem, path: str) -> Header:
    with fs.open_input_file(path) as f:
        head = f.read(12)
        if head[:6] != _MAGIC:
            raise ValueError(f"{path}: not an .npy file")
        size, start = (struct.unpack("<H", head[8:10])[0], 10) if head[6] == 1 else (struct.unpack("<I", head[8:12])[0], 12)
        f.seek(start)
        said = ast.literal_eval(f.read(size).decode("latin1"))
        length = f.size()
    shape = said["shape"]
    if said["descr"] not in _DTYPES:
        raise ValueError(f"{path}: dtype {said['descr']}; float32 and float64, little-endian, can be read")
    if len(shape) != 2:
        raise ValueError(f"{path}: shape {shape}; a matrix is needed")
    if said["fortran_order"] and min(shape) > 1:
        raise ValueError(f"{path}: columns are stored one after the other (Fortran order); rows are needed")
    out = Header(shape[0], shape[1], _DTYPES[said["descr"]], start + size)
    if length - out.start < out.rows * out.width * np.dtype(out.dtype).itemsize:
        raise ValueError(f"{path}: {length} bytes are too few for shape {shape}")
    return out


def header_bytes(rows: int, width: int, dtype: str) -> bytes:
    said = f"{{'descr': '{np.dtype(dtype).newbyteorder('<').str}', 'fortran_order': False, 'shape': ({rows}, {width}), }}"
    pad = -(10 + len(said) + 1) % 64
    text = (said + " " * pad + "\n").encode("latin1")
    return _MAGIC + bytes([1, 0]) + struct.pack("<H", len(text)) + text


def matrix_files(path: str) -> list[str]:
    """The files of a matrix, in order."""
    fs, inner = _open(path)
    if fs.get_file_info(inner).type == pafs.FileType.File:
        return [path]
    if fs.get_file_info(f"{inner}/{LIST}").type == pafs.FileType.File:
        with fs.open_input_file(f"{inner}/{LIST}") as f:
            names = json.loads(f.read())
    else:
        found = fs.get_file_info(pafs.FileSelector(inner))
        names = sorted(x.base_name for x in found if x.base_name.endswith(".npy") and not x.base_name.startswith(("_", ".")))
    return [f"{path.rstrip('/')}/{n}" for n in names]


@dataclass
class RowRange(InputPartition):
    path: str
    first: int      # row in the file
    last: int
    before: int     # rows of the files before it


class NpySource(DataSource):
    """See the module's text."""

    @classmethod
    def name(cls) -> str:
        return "npy"

    def _headers(self) -> list[tuple[str, Header]]:
        out = [(p, read_header(*_open(p))) for p in matrix_files(self.options["path"])]
        if len({(h.width, h.dtype) for _, h in out if h.rows}) > 1:
            raise ValueError(f"{self.options['path']}: files of different widths or types")
        return out

    def schema(self) -> str:
        single = all(h.dtype == "float32" for _, h in self._headers() if h.rows)
        return f"row bigint, values array<{'float' if single and self._headers() else 'double'}>"

    def reader(self, schema: StructType) -> "NpyReader":
        return NpyReader(self._headers(), int(self.options.get("rangebytes", self.options.get("rangeBytes", RANGE_BYTES))))

    def writer(self, schema: StructType, overwrite: bool) -> "NpyWriter":
        arrays = [f.name for f in schema.fields if f.dataType.typeName() == "array"]
        if len(arrays) != 1:
            raise ValueError(f"one array column is written; there are {arrays}")
        dtype = self.options.get("dtype", "float64")
        if dtype not in ("float32", "float64"):
            raise ValueError(f"dtype {dtype}; float32 or float64")
        return NpyWriter(self.options["path"], arrays[0], dtype, overwrite)


class NpyReader(DataSourceReader):
    def __init__(self, headers: list, range_bytes: int):
        self.headers, self.range_bytes = headers, range_bytes

    def partitions(self) -> list[RowRange]:
        out, before = [], 0
        for path, h in self.headers:
            step = max(1, self.range_bytes // max(1, h.width * np.dtype(h.dtype).itemsize))
            out += [RowRange(path, a, min(a + step, h.rows), before) for a in range(0, h.rows, step)]
            before += h.rows
        return out or [RowRange("", 0, 0, 0)]

    def read(self, partition: RowRange):
        if partition.first == partition.last:
            return
        fs, inner = _open(partition.path)
        h = read_header(fs, inner)
        row_bytes = h.width * np.dtype(h.dtype).itemsize
        step = max(1, BATCH_BYTES // max(1, row_bytes))
        with fs.open_input_file(inner) as f:
            for a in range(partition.first, partition.last, step):
                z = min(a + step, partition.last)
                f.seek(h.start + a * row_bytes)
                data = np.frombuffer(f.read((z - a) * row_bytes), np.dtype(h.dtype).newbyteorder("<"))
                values = pa.ListArray.from_arrays(np.arange(0, (z - a) * h.width + 1, h.width, dtype=np.int32)
                                                  if h.width else np.zeros(z - a + 1, np.int32), pa.array(data))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(a, z) + partition.before), values], names=["row", "values"])


@dataclass
class Written(WriterCommitMessage):
    part: int
    name: str
    rows: int
    width: int


class NpyWriter(DataSourceArrowWriter):
    def __init__(self, path: str, column: str, dtype: str, overwrite: bool):
        self.path, self.column, self.dtype, self.overwrite = path, column, dtype, overwrite

    def write(self, iterator) -> Written:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        rows, width = 0, 0
        with tempfile.TemporaryFile() as data:  # the header in front tells the number of rows
            for batch in iterator:
                column = batch.column(self.column)
                if column.null_count or column.flatten().null_count:
                    raise ValueError("a matrix has no null rows or cells")
                sizes = np.unique(np.diff(column.offsets.to_numpy()))
                if len(sizes) > 1 or (rows and len(sizes) and sizes[0] != width):
                    raise ValueError("rows of different lengths are no matrix")
                if len(sizes):
                    width = int(sizes[0])
                    rows += len(column)
                    data.write(column.flatten().to_numpy(zero_copy_only=False).astype(np.dtype(self.dtype).newbyteorder("<")).tobytes())
            name = f"part-{part:06d}-{uuid.uuid4().hex}.npy"
            if rows:
                fs, inner = _open(self.path)
                fs.create_dir(inner, recursive=True)
                data.seek(0)
                with fs.open_output_stream(f"{inner}/_{name}") as out:
                    out.write(header_bytes(rows, width, self.dtype))
                    while block := data.read(1 << 20):
                        out.write(block)
        return Written(part, name, rows, width)

    def commit(self, messages: list) -> None:
        fs, inner = _open(self.path)
        fs.create_dir(inner, recursive=True)
        done = sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.part)
        if len({m.width for m in done}) > 1:
            self.abort(messages)
            raise ValueError("rows of different lengths are no matrix")
        before = [] if self.overwrite else [x.rsplit("/", 1)[1] for x in matrix_files(self.path)]
        for m in done:
            fs.move(f"{inner}/_{m.name}", f"{inner}/{m.name}")
        with fs.open_output_stream(f"{inner}/{LIST}") as out:
            out.write(json.dumps(before + [m.name for m in done]).encode())

    def abort(self, messages: list) -> None:
        fs, inner = _open(self.path)
        for m in messages:
            if m is not None and m.rows and fs.get_file_info(f"{inner}/_{m.name}").type == pafs.FileType.File:
                fs.delete_file(f"{inner}/_{m.name}")


def register(spark) -> None:
    spark.dataSource.register(NpySource)


def read_npy(spark, path: str, range_bytes: int = RANGE_BYTES):
    """Rows ``row, values`` of a matrix."""
    register(spark)
    return spark.read.format("npy").option("rangeBytes", str(range_bytes)).load(path)


def write_npy(df, path: str, dtype: str = "float64") -> None:
    """The one array column of ``df`` as a matrix, in the order of its partitions."""
    register(df.sparkSession)
    df.write.format("npy").mode("overwrite").option("dtype", dtype).save(path)


def align_by_position(matrix, meta, order_col: str, id_col: str = "item_id"):
    """``(id, values)``: row ``i`` of a matrix belongs to the ``i``-th row of ``meta`` by ``order_col``.

    Stops when the two have different numbers of rows, or numbers with gaps or repeats.
    """
    from pyspark.sql import functions as F

    from tastebud.operators.ranking import dense_index
    n_rows, n_meta = matrix.count(), meta.count()
    if n_rows != n_meta:
        raise ValueError(f"the matrix has {n_rows} rows, the metadata {n_meta}")
    index = dense_index(meta, order_col, "_at")
    if index.count() != n_meta:
        raise ValueError(f"{order_col} does not give every row of the metadata a place of its own")
    return meta.join(index, order_col).join(matrix, F.col("_at") == F.col("row")).select(id_col, "values")
