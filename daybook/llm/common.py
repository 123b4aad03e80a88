"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.staging import frozen
from daybook.session import configure

__all__ = ["frozen", "table", "text_or_empty", "ceil_div", "batch_rows", "learns_from", "map_columns", "kind_of"]

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ceil_div(a: int, b: int) -> int:
    return -(-a // b)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, whatever their import path."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def batch_rows(df: DataFrame) -> DataFrame:
    """``df`` for a Python task: Arrow batches bounded by bytes (a session setting), the package shipped."""
    configure(df.sparkSession)
    ship_package(df.sparkSession)
    return df


def learns_from(doc_id: Column | str, held_out_remainder: int = 2) -> Column:
    """True for rows a model may learn from: crc32 of the id's text mod 4 is not 2.

    A null id has no such remainder; the row is neither learned from nor held out.
    """
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 4 != held_out_remainder


def give_back() -> None:
    """Return what a task has freed to the system; Python workers outlive their tasks and keep it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


#: glibc's M_MMAP_THRESHOLD and its value here: larger blocks are mapped on their own and leave the process when freed.
MMAP_THRESHOLD, OWN_BLOCK = -3, 1 << 20


def separate_blocks() -> None:
    """Keep large arrays off the heap; left alone, glibc raises that bound with each freed block and the heap stays high."""
    option = getattr(ctypes.CDLL(None), "mallopt", None)  # glibc alone has it
    if option:
        option(MMAP_THRESHOLD, OWN_BLOCK)


def lean(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` over a partition's batches that gives back its memory in the end."""

    def over(batches):
        separate_blocks()
        pa.set_memory_pool(pa.system_memory_pool())  # its blocks go back like the others
        try:
            yield from work(batches)
        finally:
            give_back()

    return over


#: Arrow types of the simple column types that operators return.
ARROW = {
    "tinyint": pa.int8(),
    "int": pa.int32(),
    "bigint": pa.int64(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<bigint>": pa.list_(pa.int64()),
    "array<tinyint>": pa.list_(pa.int8()),
}

Columns = dict[str, list]


def map_columns(df: DataFrame, work: Callable[[Iterator[Columns]], Iterator[Columns]], schema: dict[str, str], rows: int | None = None) -> DataFrame:
    """``work`` over each partition: columns as plain lists in and out, nulls as None, at most ``rows`` at a time.

    Lists, unlike pandas columns, keep integers exact where a column has nulls.
    """

    def over(batches):
        given = (b.slice(at, rows).to_pydict() for b in batches for at in range(0, b.num_rows, rows or max(1, b.num_rows)))
        for out in work(given):
            yield pa.RecordBatch.from_arrays([pa.array(out[name], ARROW[kind]) for name, kind in schema.items()], names=list(schema))

    return batch_rows(df).mapInArrow(lean(over), ", ".join(f"`{name}` {kind}" for name, kind in schema.items()))


def kind_of(df: DataFrame, column: str) -> str:
    return dict(df.dtypes)[column]
