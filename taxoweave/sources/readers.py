"""Readers with declared schemas. A missing path is Spark's own clear error."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxoweave import schemas
from taxoweave.operators.cleaning import clean_taxonomy, clean_transactions, rename_sheet
from taxoweave.operators.joins import file_ordinals

# Quoted fields may hold commas and quotes. Only an unquoted empty field is null: words such
# as NA stay text, and the null mark is a character that no export holds.
CSV = {"header": True, "quote": '"', "escape": '"', "mode": "FAILFAST", "nullValue": "\u0001", "emptyValue": "",
       "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str | None = None) -> DataFrame:
    """CSV, JSON or Parquet by ``fmt``, or by the ending of the path."""
    fmt = fmt or next((f for f in ("csv", "json", "parquet") if path.rstrip("/").endswith(f)), "parquet")
    reader = spark.read.schema(schema)
    return (reader.options(**CSV) if fmt == "csv" else reader).format(fmt).load(path)


def read_transactions(spark: SparkSession, path: str, fmt: str | None = None, *, strict_ids: bool = True) -> DataFrame:
    """The exported transaction sheet, renamed and cleaned."""
    return clean_transactions(rename_sheet(read_table(spark, path, schemas.RAW_SHEET, fmt)), strict_ids=strict_ids)


def read_taxonomy(spark: SparkSession, path: str, fmt: str | None = None, *, numbered: bool = True) -> DataFrame:
    """The exported taxonomy sheet, its columns taken by position.

    A ``numbered`` sheet has an ``ordinal`` before its six columns. Others get
    it from the places of their rows, over all files in the order of their paths.
    """
    if numbered:
        raw = read_table(spark, path, schemas.TAXONOMY, fmt)
    else:
        raw = file_ordinals(read_table(spark, path, T.StructType(schemas.TAXONOMY.fields[1:]), fmt)).select(schemas.TAXONOMY.fieldNames())
    return clean_taxonomy(raw.toDF(*schemas.TAXONOMY.fieldNames()))


def read_dropdown(spark: SparkSession, path: str) -> DataFrame:
    """A headerless list of full paths."""
    return spark.read.schema(schemas.DROPDOWN).options(**CSV | {"header": False}).csv(path)


def read_predictions(
    spark: SparkSession, path: str, schema: T.StructType, fallback: str | None = None, fmt: str | None = None
) -> DataFrame:
    """Predictions, from the fallback path when the first one does not exist."""
    try:
        return read_table(spark, path, schema, fmt)
    except AnalysisException as exc:
        if fallback is None or exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return read_table(spark, fallback, schema, fmt)


def profile_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(name, n_rows, n_cols)`` per table."""
    profiles = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("name"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols")
        )
        for name, df in tables.items()
    ]
    result = profiles[0]
    for profile in profiles[1:]:
        result = result.unionByName(profile)
    return result
