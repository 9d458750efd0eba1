"""Joins and numbering that hold up under skew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxoweave.session import settle

# A hot key gets one salt per this many rows of the large side.
ROWS_PER_SALT = 500_000


def dimension_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    *,
    bounded: bool,
    how: str = "inner",
    condition: Column | None = None,
    salts: int = 16,
) -> DataFrame:
    """Join many rows with a dimension.

    ``bounded`` says that the size of ``small`` was measured and is fit to
    broadcast. If not, both sides are shuffled, with the dimension repeated
    once per salt so that a hot key spreads over ``salts`` tasks. Spark judges
    the copies by the size of a file and would broadcast them: they are kept
    from it.
    """
    on = list(on)
    if bounded:
        joined = big.join(F.broadcast(small), on, how)
    else:
        salted = big.withColumn("_salt", F.pmod(F.xxhash64(*big.columns), F.lit(salts)).cast("int"))
        copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = salted.join(copies.hint("merge"), [*on, "_salt"], how).drop("_salt")
    return joined if condition is None else joined.filter(condition)


def hot_keys(counts: DataFrame, on: Sequence[str], rows: str, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """The keys of a table of key counts that need salts, with their number.

    There are fewer than the table's rows over ``rows_per_salt``, which bounds
    the list.
    """
    return (
        counts.filter(F.col(rows) > rows_per_salt)
        .select(*on, F.ceil(F.col(rows) / F.lit(rows_per_salt)).cast("int").alias("_salts"))
    )


def hot_key_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    *,
    counts: DataFrame,
    rows: str,
    spread: Sequence[str],
    how: str = "left",
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Equi-join whose hot keys are split over several tasks.

    ``counts`` holds the number of left rows per key. Rows of a hot key are
    spread by a hash of the ``spread`` columns, and only the right rows of hot
    keys are repeated; all other keys join as they are. Rows beyond the list of
    hot keys are not lost: they take the ordinary way.
    """
    on = list(on)
    hot = F.broadcast(hot_keys(counts, on, rows, rows_per_salt))
    salted = left.join(hot, on, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*spread), F.coalesce("_salts", F.lit(1))).cast("int")
    )
    copies = right.join(hot, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    )
    return salted.drop("_salts").join(copies.drop("_salts"), [*on, "_salt"], how).drop("_salt")


def one_row_per_key(df: DataFrame, keys: Sequence[str], order: str, *, last: bool = False, count: str | None = None) -> DataFrame:
    """Of the rows of each key the one with the lowest ``order`` number, or the highest if ``last``.

    Keys travel as two hashes, and a row as its order and a hash of itself in one
    number, which decides between rows of the same order; the row is then looked
    up. So only numbers are aggregated, by hash and before the shuffle. ``count``
    names a column for the number of rows of the key.
    """
    weight = F.lit(1 << 62).cast("decimal(19,0)")
    itself = F.shiftrightunsigned(F.xxhash64(*df.columns), 2)
    packed = F.col(order).cast("decimal(19,0)") * weight + itself
    marked = df.withColumns({"_key_a": F.xxhash64(*keys), "_key_b": F.xxhash64(F.lit(1), *keys), "_row": packed})
    found = [F.max("_row").alias("_row") if last else F.min("_row").alias("_row")]
    if count:
        found.append(F.count(F.lit(1)).alias(count))
    chosen = marked.groupBy("_key_a", "_key_b").agg(*found)
    # Rows that are equal in everything meet here once.
    return marked.join(chosen, ["_key_a", "_key_b", "_row"]).distinct().drop("_key_a", "_key_b", "_row")


def numbered(df: DataFrame, groups: Sequence[str], order: str, name: str) -> DataFrame:
    """Number rows 0, 1, 2, ... by ``groups`` and within a group by ``order``.

    Every group is numbered by itself and shifted by the measured sizes of the
    groups before it, so no task sorts the whole table. Groups are few: ranges
    of a shuffle, or blocks of files.
    """
    sizes = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy(*groups).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*groups, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*groups).orderBy(order)
    return (
        df.withColumn("_rank", F.row_number().over(inside))
        .join(offsets, list(groups))
        .withColumn(name, (F.col("_offset") + F.col("_rank") - 1).cast("long"))
        .drop("_rank", "_offset")
    )


def global_position(df: DataFrame, order: str, buckets: int | None = None) -> DataFrame:
    """Add ``position``: 0, 1, 2, ... in ascending order of a unique number.

    A range shuffle puts the rows into ordered parts, as many as the session has
    shuffle partitions or ``buckets``; the parts are written down and counted.
    """
    ranged = df.repartitionByRange(buckets, order) if buckets else df.repartitionByRange(order)
    parts = settle(ranged.withColumn("_part", F.spark_partition_id()), "ranges")
    return numbered(parts, ["_part"], order, "position").drop("_part")


def file_ordinals(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """Add the place of each row, from 1, in files read in the order of their paths.

    ``df`` is a file source as read: a row's place is that of its file, of its
    block in the file, and its own in the block.
    """
    placed = df.withColumns({
        "_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"), "_row": F.monotonically_increasing_id(),
    })
    ordered = numbered(settle(placed, "rows"), ["_file", "_block"], "_row", name)
    return ordered.withColumn(name, F.col(name) + 1).drop("_file", "_block", "_row")


def forward_fill(df: DataFrame, columns: Sequence[str], order: str, block: int = 100_000) -> DataFrame:
    """Fill nulls with the last value above, in ascending ``order``.

    Rows are cut into blocks of ``order`` values. Within a block a running
    window fills; across blocks only the last value of each block travels.
    """
    df = df.withColumn("_block", F.floor(F.col(order) / F.lit(block)))
    # One row per block: a table smaller by the factor `block`.
    last = df.groupBy("_block").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_last_{c}") for c in columns]
    )
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(
        "_block", *[F.last(f"_last_{c}", ignorenulls=True).over(earlier).alias(f"_carry_{c}") for c in columns]
    )
    running = Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = df.withColumns({c: F.last(c, ignorenulls=True).over(running) for c in columns}).join(
        carried, "_block", "left"
    )
    return filled.withColumns({c: F.coalesce(c, f"_carry_{c}") for c in columns}).drop(
        "_block", *[f"_carry_{c}" for c in columns]
    )
