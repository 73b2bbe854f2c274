"""What the operators share: tables in the shared folder, word splitting, digests."""

from __future__ import annotations

import atexit
import ctypes
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Up to so many row numbers are broadcast to pick rows before their texts move; more are joined by a shuffle.
BROADCAST_ROWS = 2_000_000
#: Bytes of an Arrow batch on its way to a Python worker, and Spark's bound where nobody has set one.
BATCH_BYTES, SPARK_BATCH = 7_500_000, str(64 << 20)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where unset on one machine, one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        import tempfile

        found = f"file://{tempfile.gettempdir()}/lexispark-shared"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Scratch:
    """Written tables that cut lineage.

    Each keep() writes a Parquet table below the shared folder and reads it again, so that a lost executor costs the
    current job's tasks only. drop() deletes a table that no later step reads; the rest goes when Python ends.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0
        atexit.register(self.close)

    def path(self, name: str = "t") -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def keep(self, df: DataFrame, name: str = "t") -> DataFrame:
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def delete(self, path: str) -> None:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            self.delete(df.scratch_path)

    def close(self) -> None:
        try:
            self.delete(self.root)
        except Exception:  # noqa: BLE001  the session may have ended before
            pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], size: int, *columns: str) -> Iterator[pa.RecordBatch]:
    """Parts of batches with at most so many bytes in columns of text, or with one longer row."""
    for b in batches:
        ends = sum(np.cumsum(pc.fill_null(pc.binary_length(b.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) for c in columns)
        lo = 0
        while lo < len(b):
            before = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield b.slice(lo, hi - lo)
            lo = hi


Batches = Iterator[pa.RecordBatch]


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """run, as a task's function over batches, that gives what its allocators keep back to the system when the task ends:
    Python workers outlive their tasks, and an executor has one for each core beside its heap."""

    @wraps(run)
    def task(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return task


def mapped(df: DataFrame, run: Callable[[Batches], Batches], schema: str | T.StructType) -> DataFrame:
    """df through run in Arrow batches of BATCH_BYTES, with lean() tasks.

    The bound is a setting of the session, set here unless the session has one already: a batch lies whole in the
    executor's direct memory and again in the worker's, for each core, and Spark's own bound is 64 MB. A longer row is
    a batch of its own; nothing is cut.
    """
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxBytesPerBatch", SPARK_BATCH)) == int(SPARK_BATCH):
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(lean(run), schema)
