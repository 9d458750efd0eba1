"""Substring matching as an equi-join.

"Which of these needles occur in this text" is a theta join. Here every needle
is filed under the one of its substrings that the fewest needles share, every text is cut once into all of its
substrings of that length, and the two meet in an equi-join. The work grows with
the text, not with the number of needles, and nothing is missed: a needle occurs
in a text only if each of its substrings does.

Needles that fit to be broadcast come to the texts, and the few pairs that meet
are checked with ``contains``. Other needles are also cut into tiles that cover
them side by side, and the texts send the place of every substring: a needle
whose filed substring is met occurs where all its tiles lie at their distances
from one start. Places and substrings
travel then, the texts stay where they are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoweave.functions.text import grams
from taxoweave.operators.joins import dimension_join

LONG_GRAM = 4
ANY_NEEDLE = (1, 3)
# Needles of this length that do not fit a broadcast have longer substrings: the more
# needles there are, the more of them share each short one.
WIDE_GRAM = 8


def gram_sizes(shortest: int | None) -> tuple[int, ...]:
    """Substring lengths to cut a text into, given the shortest needle.

    One length is enough unless there are needles of one or two characters.
    """
    shortest = min(shortest or LONG_GRAM, LONG_GRAM)
    return (shortest,) if shortest >= 3 else (shortest, 3)


def wide_sizes(needles: DataFrame, sizes: Sequence[int]) -> tuple[int, ...]:
    """``sizes`` with the wide one where needles are long enough for it, and that alone where all are."""
    length = F.length("needle")
    found = needles.filter(length > 0).agg(F.min(length).alias("shortest"), F.max(length).alias("longest")).first()
    if (found.longest or 0) < WIDE_GRAM:
        return tuple(sizes)
    return (WIDE_GRAM,) if found.shortest >= WIDE_GRAM else (*sizes, WIDE_GRAM)


def _by_longest(needle: Column, sizes: Sequence[int], cut: Callable[[int], Column]) -> Column:
    """``cut`` by the longest size that fits."""
    shortest, *others = sorted(sizes)
    return reduce(lambda less, size: F.when(F.length(needle) >= size, cut(size)).otherwise(less), others, cut(shortest))


def _cut_needle(needle: Column, sizes: Sequence[int]) -> Column:
    """All substrings of the longest size that fits."""
    return _by_longest(needle, sizes, lambda size: grams(needle, size))


def filed_needles(needles: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """``needles`` that are not empty, with ``_gram``, of their substrings the one on the fewest needles, and its place ``_shift``."""
    whole = needles.filter(F.length("needle") > 0)
    cut = whole.select("needle").distinct().select("needle", F.posexplode(_cut_needle(F.col("needle"), sizes)).alias("_shift", "_gram"))
    shared = cut.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    best = cut.join(shared, "_gram").groupBy("needle").agg(F.min(F.struct("_n", "_shift", "_gram")).alias("_best"))
    return whole.join(best.select("needle", "_best._gram", "_best._shift"), "needle")


def text_grams(text: Column, sizes: Sequence[int]) -> Column:
    """All substrings of the given sizes, repeats kept."""
    cut = [grams(text, size) for size in sizes]
    return cut[0] if len(cut) == 1 else F.concat(*cut)


def tiles(needle: Column, sizes: Sequence[int]) -> Column:
    """Substrings that cover a needle side by side, the last one at its end, each with its ``offset``."""
    def cover(size: int) -> Column:
        cut = grams(needle, size)
        last = F.size(cut) - 1
        places = F.array_distinct(F.array_append(F.sequence(F.lit(0), last, F.lit(size)), last))
        return F.transform(places, lambda at: F.struct(at.alias("offset"), F.get(cut, at).alias("gram")))

    return _by_longest(needle, sizes, cover)


def placed_grams(text: Column, sizes: Sequence[int]) -> Column:
    """All substrings of the given sizes, each with its place ``at``."""
    def cut(size: int) -> Column:
        return F.transform(grams(text, size), lambda gram, at: F.struct(at.alias("at"), gram.alias("gram")))

    parts = [cut(size) for size in sizes]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def placed_hits(texts: DataFrame, text: str, needles: DataFrame, sizes: Sequence[int] = ANY_NEEDLE) -> DataFrame:
    """:func:`substring_hits` without the text in any shuffle, for needles beyond a broadcast."""
    kept = [c for c in texts.columns if c != text]
    sizes = wide_sizes(needles, sizes)
    filed = filed_needles(needles, sizes)
    postings = texts.select(*kept, F.inline(placed_grams(F.col(text), sizes))).withColumnRenamed("gram", "_gram")
    met = dimension_join(postings, filed, ["_gram"], bounded=False)
    columns = [*kept, *needles.columns]
    asked = met.select(*columns, (F.col("at") - F.col("_shift")).alias("_start")).filter(F.col("_start") >= 0).distinct()
    cut = asked.withColumn("_tiles", tiles(F.col("needle"), sizes))
    tiled = cut.select(*columns, "_start", F.size("_tiles").alias("_needed"), F.inline("_tiles"))
    places = postings.select(*[F.col(c).alias(f"_its_{c}") for c in kept], F.col("at").alias("_at"), F.col("_gram").alias("_there"))
    same = (F.col("_at") == F.col("_start") + F.col("offset")) & (F.col("_there") == F.col("gram"))
    for c in kept:
        same = same & F.col(c).eqNullSafe(F.col(f"_its_{c}"))
    found = tiled.join(places, same).groupBy(*columns, "_needed", "_start").agg(F.count_distinct("offset").alias("_tiles"))
    return found.filter(F.col("_tiles") == F.col("_needed")).select(*columns).distinct()


def substring_hits(
    texts: DataFrame, text: str, needles: DataFrame, *, bounded: bool, sizes: Sequence[int] = ANY_NEEDLE
) -> DataFrame:
    """Pairs of text row and needle row where the text contains the needle.

    ``needles`` has a column ``needle``; empty needles never match. All columns
    of both sides but the text are kept. Matching is case-sensitive. Rows of
    ``needles`` and, where they are not ``bounded``, of ``texts`` are told apart
    by their columns.
    """
    if not bounded:
        return placed_hits(texts, text, needles, sizes)
    kept = [c for c in texts.columns if c != text]
    filed = filed_needles(needles, sizes).drop("_shift")
    # A gram that repeats must meet its needles once.
    pieces = F.array_distinct(text_grams(F.col(text), sizes))
    cut = texts.select(*kept, F.col(text).alias("_text"), F.explode(pieces).alias("_gram"))
    met = dimension_join(cut, filed, ["_gram"], bounded=True, condition=F.contains("_text", "needle"))
    return met.drop("_gram", "_text")
