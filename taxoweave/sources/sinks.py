"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows sorted over all files: by ranges of the columns, so each task writes the next range."""
    return df.orderBy(*columns) if columns else df


def write_csv(df: DataFrame, path: str, *, header: bool = True, order_by: Sequence[str] = ()) -> str:
    """CSV without an index; quotes inside fields are doubled. Files follow ``order_by``, such as the input's id."""
    in_order(df, order_by).write.mode("overwrite").options(
        header=header, quote='"', escape='"', emptyValue='""', nullValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, *, order_by: Sequence[str] = ()) -> str:
    """Parquet; files follow ``order_by``."""
    in_order(df, order_by).write.mode("overwrite").parquet(path)
    return path


def write_store_json(store: DataFrame, path: str) -> str:
    """The store as one JSON object per line: the key and the result under it."""
    body = F.struct([c for c in store.columns if c != "cache_key"])
    store.select("cache_key", body.alias("result")).write.mode("overwrite").json(path)
    return path
