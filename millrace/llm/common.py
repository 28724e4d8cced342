"""Helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where that is unset, a local master gets a temporary folder; on a cluster, whose executors could not
    read it, that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
        path = getattr(spark, "_millrace_shared", None)
        if not path:
            path = "file://" + tempfile.mkdtemp(prefix="millrace-")
            spark._millrace_shared = path
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(path)
    return path


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder; it goes when the driver ends, or by ``discard``."""
    path = f"{shared_dir(spark)}/millrace-{name}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(at.getParent())
    fs.deleteOnExit(at)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a working table that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The frame, written in the shared folder and read back, and its path."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage by a table written in the shared folder and read back."""
    return written(df, name)[0]


WHOLE = {pa.int8(): pd.Int8Dtype(), pa.int16(): pd.Int16Dtype(), pa.int32(): pd.Int32Dtype(), pa.int64(): pd.Int64Dtype()}


def map_slices(df: DataFrame, function: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str, rows: int = 1000) -> DataFrame:
    """``mapInPandas`` in slices of at most ``rows`` rows, in which whole numbers never become floats.

    A nullable long reaches pandas as Int64, so that ids beyond 2**53 beside a null survive; Arrow batches
    (bounded by bytes in Spark) are cut here and no setting of the session is touched.
    """
    kinds = StructType.fromDDL(schema)
    names = kinds.names
    target = to_arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def slices() -> Iterator[pd.DataFrame]:
            for batch in batches:
                for at in range(0, batch.num_rows, rows):
                    yield batch.slice(at, rows).to_pandas(types_mapper=WHOLE.get)

        trim()  # what an earlier task has left
        for frame in function(slices()):
            if len(frame):
                yield pa.RecordBatch.from_pandas(frame[names], schema=target, preserve_index=False)

    return df.mapInArrow(run, schema)


def exact_ids(ids: pd.Series) -> list[int | None]:
    """Python integers, None for null, of a column of ``map_slices``."""
    return ids.astype(object).where(ids.notna(), None).tolist()


def frame_of(rows: list[tuple], names: list[str], ids: tuple[str, ...]) -> pd.DataFrame:
    """A frame of rows, in which the columns ``ids`` hold integers or None and stay exact."""
    columns = dict(zip(names, zip(*rows, strict=True) if rows else [()] * len(names), strict=True))
    return pd.DataFrame({n: pd.array(c, dtype="Int64") if n in ids else list(c) for n, c in columns.items()})


def utf8(texts: Iterable[str | None]) -> list[bytes]:
    """UTF-8 bytes of each text; null and NaN count as empty, lone surrogates as ``?``."""
    return [t.encode("utf-8", "replace") if isinstance(t, str) else b"" for t in texts]


def chunks(blobs: list[bytes] | list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive blobs (or texts) with at most ``limit`` bytes (characters) each, or a single longer one."""
    start = size = 0
    for i, b in enumerate(blobs):
        if size and size + len(b) > limit:
            yield start, i
            start, size = i, 0
        size += len(b)
    if start < len(blobs):
        yield start, len(blobs)


def trim() -> None:
    """Give back what this worker has freed: it is used again, by stages that need their own memory."""
    pa.default_memory_pool().release_unused()
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if release:
        release(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
