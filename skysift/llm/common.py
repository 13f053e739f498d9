"""Shared helpers: input tables, written intermediate tables, array batches, free column names."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Bytes of text and rows that an array function handles at once.
SLICE_BYTES, SLICE_ROWS = 2 << 20, 2000
_folders: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application in the one that the driver and all executors share (spark.checkpoint.dir).

    Where the session names none, a local temporary folder is used on a single
    machine (as in tests), and it is an error on a cluster. The folder is
    removed when the driver's Python ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="skysift-")
        spark.conf.set("spark.checkpoint.dir", folder)
    own = f"{folder.rstrip('/')}/skysift-{spark.sparkContext.applicationId}"
    if own not in _folders:
        _folders.add(own)
        atexit.register(_remove, spark, own)
    return own


def _remove(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    if context._jsc is not None:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table written to the shared folder and read back.

    This cuts the lineage in a form that outlives lost executors, and makes a
    result that several jobs read be computed once.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z and nothing else, whatever the locale."""
    return F.translate(col, UPPER, LOWER)


def fresh(name: str, taken: Iterable[str]) -> str:
    """`name`, with as many underscores as keep it apart from the `taken` ones, in any case of letters."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of bounded rows and bytes in column `text`; a longer text is a part of its own."""
    n = batch.num_rows
    if not n:
        return
    ends = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0), np.int64))
    a = 0
    while a < n:
        before = int(ends[a - 1]) if a else 0
        z = min(n, a + SLICE_ROWS, max(a + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right"))))
        yield batch.slice(a, z - a)
        a = z


def bytes_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column end to end, and n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]
