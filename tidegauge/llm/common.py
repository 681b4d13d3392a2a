"""Shared helpers: the cluster's shared folder, bounded slices of Arrow batches, iterated edges."""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Iterable, Iterator
from contextlib import suppress
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 3 << 20


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: below spark.checkpoint.dir, else below the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def set_apart(df: DataFrame, own: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """df with other names for columns that are named like an operator's own, and the names to give back."""
    taken = {name.lower() for name in own}
    names = {c: f"_given_{i}" for i, c in enumerate(df.columns) if c.lower() in taken}
    return (df.withColumnsRenamed(names) if names else df), {new: old for old, new in names.items()}


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed once and reread from the shared folder, whichever executors are lost."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint(eager=True)


class Scratch:
    """Tables written on the way, below one new shared folder, which the operator removes after their last reader.

    Within `with`, shuffle files go when the job that wrote them has ended: what it made is stored by then.
    """

    _SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession, name: str) -> None:
        self._spark, self._path, self._paths = spark, shared_folder(spark, name), {}

    def __enter__(self) -> Scratch:
        self._before = self._spark.conf.get(self._SETTING)
        self._spark.conf.set(self._SETTING, "true")
        return self

    def __exit__(self, *_: object) -> None:
        self._spark.conf.set(self._SETTING, self._before)

    def keep(self, df: DataFrame) -> DataFrame:
        """df, written and reread."""
        path = f"{self._path}/{len(self._paths)}"
        df.write.parquet(path)
        out = self._spark.read.schema(df.schema).parquet(path)
        self._paths[path] = out
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Remove tables that nothing reads any more."""
        for path, df in self._paths.items():
            if any(df is f for f in frames):
                place = self._spark._jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(place, True)


def kept_between_tasks() -> ModuleType:
    """What this process keeps for its next tasks; modules of this package travel with their functions, so it lies beside them."""
    return sys.modules.setdefault("_tidegauge_kept", ModuleType("_tidegauge_kept"))


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES, keep: bool = False) -> Iterator[pa.RecordBatch]:
    """The rows in order, in slices of about `most` bytes of `column`; one longer value makes its own slice.

    A worker that goes on to other work gives back what it has kept, but with `keep`.
    """
    if not keep:
        vars(kept_between_tasks()).clear()
    give_back()  # also what earlier tasks of other kinds have left
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


def give_back() -> None:
    """A worker goes on to other tasks: what this one held for a while goes back to the system."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with suppress(AttributeError):  # a C library without it
            ctypes.CDLL(None).malloc_trim(0)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """A text column with null as the empty text."""
    return pc.fill_null(batch.column(column), "")


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return table.select(*(F.col(c) for c in columns)) if columns else table
