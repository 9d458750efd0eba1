"""Exact deduplication through recipes of content-defined chunks.

A text is cut at sentence marks that follow a minimum length, so that texts
with a common passage share most of its chunks. Every distinct chunk gets an
identifier: its 64-bit hash and, where different chunks share a hash, the
chunk's place among them. A text is then its ordered list of identifiers, its
recipe, and equal texts are equal recipes. Chunks travel once, to be verified;
after that only recipes do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, measured, of_text, or_empty, settle

#: A chunk ends at the first mark after so many characters, and after eight times as many in any case.
MIN_CHUNK = 1024
MAX_CHUNK = 8 * MIN_CHUNK
MARKS = ".!?;:,。！？、"


def normalised(text: str | Column) -> Column:
    """The text with every run of white space as one space; null is the empty text."""
    # A lone space is its own replacement, so only other white space and longer runs match.
    return F.regexp_replace(or_empty(text), rf"[\x09-\x0D][{SPACE}]*+|\x20[{SPACE}]++", " ")


def chunks(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """The text's chunks in order; they join to the text, and the empty text has none."""
    return of_text(text, rf"(?s).{{{least},{most - 1}}}?[{MARKS}]|.{{1,{most}}}")


def chunk_recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(recipes, chunk table)`` of a corpus.

    ``recipes`` has a row for each document: ``id``, ``text_sha256`` of the
    normalised text in UTF-8, ``hashes`` (ordered) and ``places``: for chunks
    whose hash belongs to several different chunks, their position in the text
    and their place among these. ``hashes`` and ``places`` together are the
    verified recipe. The chunk table has each distinct chunk once: ``hash``,
    ``chunk``, ``place`` (0 where the hash has one chunk only).
    """
    cut = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("norm")).select(
        "id", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"), chunks(F.col("norm")).alias("chunks"))
    hashed = cut.select("id", "text_sha256", F.transform("chunks", lambda c: F.xxhash64(c)).alias("hashes"))
    pieces = cut.select(F.explode("chunks").alias("chunk")).select(F.xxhash64("chunk").alias("hash"), "chunk").distinct()
    clashing = settle(pieces.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"), "clashing")
    table = pieces.join(clashing.withColumn("clash", F.lit(True)), "hash", "left")
    ranked = table.where("clash").withColumn("place", F.row_number().over(Window.partitionBy("hash").orderBy("chunk")))
    chunk_table = table.where("clash is null").select("hash", "chunk", F.lit(0).alias("place")).unionByName(
        ranked.select("hash", "chunk", "place"))
    if clashing.isEmpty():
        return hashed.withColumn("places", F.lit(None).cast("array<struct<at:int,place:int>>")), chunk_table
    numbered = settle(cut.withColumn("row", F.monotonically_increasing_id()).select(
        "row", "id", "text_sha256", "chunks", F.transform("chunks", lambda c: F.xxhash64(c)).alias("hashes")), "chunked")
    places = (
        numbered.select("row", F.posexplode("chunks").alias("at", "chunk")).withColumn("hash", F.xxhash64("chunk"))
        .join(ranked.select("hash", "chunk", "place"), ["hash", "chunk"])
        .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "place"))).alias("places"))
    )
    return numbered.join(places, "row", "left").select("id", "text_sha256", "hashes", "places"), chunk_table


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group documents whose normalised texts are equal.

    Returns a row for each input row: ``id_col``, ``keep_id``, ``group_size``,
    ``kept``, ``text_sha256``. Of equal texts the smallest id stays. Null and
    empty texts are equal to each other. Rows that repeat an id share its fate,
    and count in ``group_size``. A row without an id stays only if none of its
    group has one. An empty table gives an empty result; columns besides id and
    text are ignored.
    """
    recipes, _ = chunk_recipes(docs, id_col, text_col)
    recipes = settle(recipes, "recipes")
    recipe = F.struct(F.col("hashes"), F.col("places"))
    groups = recipes.groupBy(recipe.alias("recipe")).agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # Texts without a copy are their own group; only the others look theirs up.
    return recipes.withColumn("recipe", recipe).join(groups.where("group_size > 1"), "recipe", "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("group_size").isNull(), True).otherwise(F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of the documents that stay, with all their columns.

    Rows without an id stay, for nothing tells them apart.
    """
    groups = exact_groups(docs, id_col, text_col)
    dropped = settle(groups.where("not kept").select(F.col(id_col).alias("__dropped")).distinct(), "dropped")
    return docs.join(measured(dropped), F.col(id_col) == F.col("__dropped"), "left_anti")


#: The rows of op5_exact_dedup in DuckDB.
EXACT_DEDUP_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
k AS (SELECT doc_id, norm, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
"""
