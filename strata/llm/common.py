"""Helpers shared by the operators: Arrow maps, scratch tables, UTF-8 columns."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def utf8(column: Column | str) -> Column:
    """The column's UTF-8 bytes; null counts as empty."""
    col = F.col(column) if isinstance(column, str) else column
    return F.coalesce(col.cast("string").cast("binary"), F.lit(b""))


def decode(data: bytes) -> str:
    return data.decode("utf-8", errors="replace")


def release_memory() -> None:
    """Gives memory that a task has freed back to the system; its Python worker lives on with other work."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not every C library has it
        pass


Batches = Iterator[pa.RecordBatch]


def released(run: Callable[[Batches], Batches], forget: Callable[[], None] | None = None) -> Callable[[Batches], Batches]:
    """``run``, with ``forget`` called and memory given back when the task ends."""

    def task(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            if forget:
                forget()
            release_memory()

    return task


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str, forget: Callable[[], None] | None = None) -> DataFrame:
    """``fn`` over every Arrow batch of ``df``; empty batches are skipped.

    ``forget`` drops what ``fn`` keeps between batches; it runs when the task ends.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(released(run, forget), schema)


def scratch(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a fresh table in the shared folder, and read back.

    Cuts the lineage: what follows survives a lost executor without
    recomputing what came before.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted
