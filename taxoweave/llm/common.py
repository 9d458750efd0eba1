"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, settle, ship_package

__all__ = ["give_back", "let", "measured", "of_text", "or_empty", "read_table", "row_numbers", "scratch_path", "settle", "ship_package", "small", "tidy", "worker_cache"]

#: White space and words as every contract of this subpackage has them.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

#: A table is broadcast only when counted to stay below both bounds.
MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by a path that Spark's reader opens."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def or_empty(text: str | Column) -> Column:
    """A text, null as the empty one."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def of_text(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches of a pattern, leftmost first and not overlapping."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def row_numbers(df: DataFrame, name: str) -> DataFrame:
    """Number rows for joins within one run; settle the result before it is used twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


def small(df: DataFrame, rows: int, size: int) -> DataFrame:
    """Mark a table for broadcast if its counted rows and bytes are below the bounds; else Spark shuffles it."""
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS and size <= MAX_BROADCAST_BYTES else df


def measured(ids: DataFrame) -> DataFrame:
    """A settled table of one id column, marked for broadcast if its count allows it."""
    n = ids.count()
    return small(ids, n, n * (8 if ids.schema[0].dataType.simpleString() in ("bigint", "int") else 64))


_CACHES: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What a Python worker remembers for one operator.

    Spark reuses workers for later stages, so asking for it lets go of what other operators remembered.
    """
    for other in [o for o in _CACHES if o != owner]:
        _CACHES.pop(other).clear()
    return _CACHES.setdefault(owner, {})


def give_back() -> None:
    """Give freed memory back to the system, else it stays with the process."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches that gives freed memory back to the system when its task ends.

    A worker waits for other tasks and stages afterwards, beside the executor's own needs.
    """
    @functools.wraps(run)
    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied
