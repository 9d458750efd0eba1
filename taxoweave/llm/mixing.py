"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Documents are cut into blocks of words. Each source gets an exact quota of
block draws: whole passes over its blocks, and a part of one more pass. A tree
then deals the quotas to output shards: a node halves its draws, and how many
of each source go left is a multivariate-hypergeometric draw, as if all draws
had been shuffled. Within a source the blocks stand in a random order, and a
shard takes the next ones of it, so that shards are disjoint; each shard is
shuffled by itself. All randomness is a hash of the seed, so reruns agree.

Everything is DataFrame code. Positions in a source's order come from small
buckets and a table of their totals, never from one sort of a whole source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, WORD, let, of_text, or_empty, row_numbers, settle, small

#: Weights that the sources repeat in their order, the size of the mix, and the most copies.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2

BLOCK_WORDS = 256
SHARD_DRAWS = 8_192
#: Blocks that one bucket numbers.
BUCKET_BLOCKS = 16_384
SEED = 20


def word_count(text: str | Column) -> Column:
    """Number of words; null counts as empty."""
    return F.regexp_count(or_empty(text), F.lit(WORD)).cast("long")


def unit(*parts: str | int | Column) -> Column:
    """A number in (0, 1) drawn by a hash."""
    columns = [p if isinstance(p, Column) else F.lit(p) if isinstance(p, int) else F.col(p) for p in parts]
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most_copies: int = MOST_COPIES) -> DataFrame:
    """``place``, ``source``, ``source_size``, ``blocks``, ``target``: a row for each source.

    Sources are in code-point order with null last, and ``place`` counts them
    from 0. Their targets are the common level times their weight, or their
    size times ``most_copies`` if that is less; the level is where the targets
    add up to ``share`` of all sizes. The numbering and the level use windows
    over this table, which has one row for each source.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum("blocks").alias("blocks"))
    placed = totals.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * most_copies
    order = Window.orderBy((limit / weight).alias("fill"), "place")
    whole = Window.partitionBy(F.lit(0))
    filling = placed.withColumn("weight", weight).withColumn("limit", limit).withColumns({
        "full": F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "open": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
        "goal": F.sum("source_size").over(whole) * share,
    })
    # With the sources before it at their limit, the rest share what is left; the first that stays within its limit sets the level.
    at = (F.col("goal") - F.col("full")) / F.col("open")
    level = F.first(F.when(at * F.col("weight") <= F.col("limit"), F.struct("goal", "full", "open")), ignorenulls=True)
    leveled = filling.withColumn("level", level.over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    share_of = (F.col("level.goal") - F.col("level.full")) * F.col("weight") / F.col("level.open")
    return leveled.select(
        F.col("place").cast("int").alias("place"), "source", "source_size", "blocks",
        F.coalesce(F.least(F.col("limit").cast("double"), share_of), F.col("limit").cast("double")).alias("target"))


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are among the ``marked``, by inversion at ``u``.

    The weights of the outcomes follow from one another by their ratio. Outcomes
    over 12 standard deviations from the mean are left out, for they weigh less
    than a double can tell.
    """
    d = "double"
    mean = drawn.cast(d) * marked.cast(d) / total.cast(d)
    spread = F.sqrt(mean * (total - marked).cast(d) / total.cast(d) * (total - drawn).cast(d) / F.greatest(total - 1, F.lit(1)).cast(d))
    low = F.greatest(F.lit(0).cast("long"), drawn + marked - total, F.floor(mean - 12 * spread - 4).cast("long"))
    high = F.least(drawn, marked, F.ceil(mean + 12 * spread + 4).cast("long"))

    def ratio(k: Column) -> Column:
        """Weight of ``k + 1`` over the weight of ``k``."""
        return (marked - k).cast(d) * (drawn - k).cast(d) / ((k + 1).cast(d) * (total - marked - drawn + k + 1).cast(d))

    def search(bounds: Column) -> Column:
        lo, hi = bounds["lo"], bounds["hi"]
        steps = F.sequence(lo, hi - 1)
        start = F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum"))
        weigh = F.aggregate(steps, start, lambda acc, k: let(
            acc["w"] * ratio(k), lambda w: F.struct(w.alias("w"), (acc["sum"] + w).alias("sum"))), lambda acc: acc["sum"])

        def pick(whole: Column) -> Column:
            begin = F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum"), lo.alias("k"))
            found = F.aggregate(steps, begin, lambda acc, k: F.when(acc["sum"] >= u * whole, acc).otherwise(let(
                acc["w"] * ratio(k), lambda w: F.struct(w.alias("w"), (acc["sum"] + w).alias("sum"), (k + 1).alias("k")))))
            return found["k"]

        return F.when(hi <= lo, lo).otherwise(let(weigh, pick))

    return let(F.struct(low.alias("lo"), high.alias("hi")), search)


def splitting_tree(quotas: DataFrame, shards: int, draws: int, seed: int = SEED) -> DataFrame:
    """``shard``, ``place``, ``draws``: how many draws of each source every shard gets.

    ``quotas`` has ``place`` and ``quota``. A node is a range of shards with a
    count for each source; shards differ by one draw at most.
    """
    def border(shard: Column) -> Column:
        """Draws before a shard: its even share of all, in whole numbers."""
        return F.floor(F.lit(draws).cast("decimal(38,0)") * shard / F.lit(shards)).cast("long")

    nodes = quotas.groupBy().agg(F.array_sort(F.collect_list(F.struct("place", "quota"))).alias("q")).select(
        F.lit(0).cast("long").alias("a"), F.lit(shards).cast("long").alias("b"), F.transform("q", lambda x: x["quota"]).alias("counts"))
    for level in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        middle = F.floor((F.col("a") + F.col("b")) / 2).cast("long")
        taken = F.when(F.col("b") - F.col("a") > 1, border(middle) - border(F.col("a"))).otherwise(F.lit(0).cast("long"))
        node = nodes.withColumn("middle", middle).withColumn("taken", taken)
        begin = F.struct(F.aggregate("counts", F.lit(0).cast("long"), lambda s, c: s + c).alias("total"),
                         F.col("taken").alias("drawn"), F.array().cast("array<bigint>").alias("left"))

        def step(acc: Column, item: Column) -> Column:
            count, place = item["count"], item["place"]
            u = unit(seed, level, F.col("a"), place)
            draw = F.when((acc["drawn"] == 0) | (count == 0), F.lit(0).cast("long")).when(acc["drawn"] == acc["total"], count).otherwise(
                hypergeometric(acc["total"], count, acc["drawn"], u))
            return let(draw, lambda x: F.struct((acc["total"] - count).alias("total"), (acc["drawn"] - x).alias("drawn"),
                                                F.concat(acc["left"], F.array(x)).alias("left")))

        items = F.transform("counts", lambda c, i: F.struct(c.alias("count"), i.alias("place")))
        halves = node.withColumn("left", F.aggregate(items, begin, step, lambda acc: acc["left"]))
        inner = F.col("b") - F.col("a") > 1
        nodes = halves.select(F.explode(F.when(inner, F.array(
            F.struct(F.col("a"), F.col("middle").alias("b"), F.col("left").alias("counts")),
            F.struct(F.col("middle").alias("a"), F.col("b"), F.zip_with("counts", "left", lambda c, x: c - x).alias("counts")),
        )).otherwise(F.array(F.struct("a", "b", "counts")))).alias("n")).select("n.*")
        if level % 6 == 5:  # enough nodes for all tasks from here on
            nodes = nodes.repartition("a")
    return nodes.select(F.col("a").alias("shard"), F.posexplode("counts").alias("place", "draws")).where("draws > 0")


def mix(sized: DataFrame, block_words: int = BLOCK_WORDS, shard_draws: int = SHARD_DRAWS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """``(draws, sources)`` of a mix.

    ``sized`` has ``row`` (unique), ``id``, ``source`` and ``size`` and must be
    settled. ``sources`` is :func:`source_targets`. ``draws`` has a row for each
    block drawn: ``shard``, ``order`` (from 0 within the shard), ``row``,
    ``block`` (number within its document), ``pass``, ``words`` (all of the
    block but for the last draw of a source, which is cut so that the source
    takes its target in whole words). A block is drawn at most twice.
    """
    spark = sized.sparkSession
    sized = sized.withColumn("blocks", F.ceil(F.col("size") / block_words).cast("long"))
    sources = settle(source_targets(sized), "sources").withColumn(
        "passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    sources = sources.withColumn("rest", F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long"))
    counted = sources.agg(F.count(F.lit(1)), F.sum(F.coalesce(F.length("source"), F.lit(0)) * 4 + 64)).first()
    few = small(sources, counted[0], counted[1] or 0)

    # Blocks in a source's random order: a bucket by hash, the order within it by another hash.
    per_source = few.select("place", "source", "passes", "rest", F.greatest(F.lit(1), F.ceil(F.col("blocks") / BUCKET_BLOCKS)).cast("long").alias("buckets"))
    documents = sized.where("blocks > 0").join(per_source, sized["source"].eqNullSafe(per_source["source"]))
    blocks = documents.select("row", "id", "size", "place", "passes", "rest", "buckets", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    blocks = blocks.select(
        "row", "id", "place", "passes", "rest", "block", F.least(F.lit(block_words).cast("long"), F.col("size") - F.col("block") * block_words).alias("words"),
        F.pmod(F.xxhash64(F.lit(seed), F.lit(1), "id", "block"), "buckets").alias("bucket"))
    within = Window.partitionBy("place", "bucket").orderBy(F.xxhash64(F.lit(seed), F.lit(2), "id", "block"), "id", "block", "row")
    # Extra words may be drawn from any block, so a bucket counts both blocks and words.
    ordered = settle(blocks.withColumns({
        "at": F.row_number().over(within).cast("long") - 1,
        "before": F.sum("words").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("words"),
    }), "blocks")
    bucket_order = Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = ordered.groupBy("place", "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("w")).select(
        "place", "bucket", F.coalesce(F.sum("n").over(bucket_order), F.lit(0)).alias("n_before"), F.coalesce(F.sum("w").over(bucket_order), F.lit(0)).alias("w_before"))
    total_rows = ordered.select("place", "bucket").groupBy().agg(F.count(F.lit(1))).first()[0] // BUCKET_BLOCKS + 2 * counted[0]
    placed = ordered.join(small(totals, total_rows, 64 * total_rows), ["place", "bucket"]).withColumns({
        "at": F.col("at") + F.col("n_before"), "before": F.col("before") + F.col("w_before")})
    # The pass that is taken in part: the words of the target that whole passes leave over.
    extra = F.least(F.col("words"), F.greatest(F.lit(0).cast("long"), F.col("rest") - F.col("before")))
    copies = F.transform(F.sequence(F.lit(0).cast("long"), F.col("passes")), lambda p: F.struct(
        p.alias("pass"), F.when(p < F.col("passes"), F.col("words")).otherwise(extra).alias("words")))
    drawn = placed.select("place", "row", "id", "block", "at", F.inline(copies)).where("words > 0")
    drawn = settle(drawn, "drawn")
    quotas = settle(drawn.groupBy("place").agg(F.count(F.lit(1)).alias("quota")), "quotas")
    draws = quotas.agg(F.sum("quota")).first()[0] or 0
    if draws == 0:
        return spark.createDataFrame([], "shard long, order int, row long, block long, pass long, words long"), sources
    shards = math.ceil(draws / shard_draws)
    # A source with no draw has no quota; the tree counts by the order of those that have.
    numbered = quotas.withColumn("seat", F.row_number().over(Window.orderBy("place")) - 1)
    tree = splitting_tree(numbered.select(F.col("seat").alias("place"), "quota"), shards, draws, seed).withColumnRenamed("place", "seat")
    tree = tree.join(small(numbered, counted[0], 24 * counted[0]), "seat")
    order = Window.partitionBy("place").orderBy("shard")
    ranges = tree.select("place", "shard", "draws", F.greatest(F.lit(1), F.floor(F.col("quota") / shards)).cast("long").alias("grid"),
                         (F.sum("draws").over(order) - F.col("draws")).alias("first"))
    # A range lies in few cells of a grid as wide as an average range, so finding a draw's range is an equi-join.
    cells = settle(ranges.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("first") / F.col("grid")), F.floor((F.col("first") + F.col("draws") - 1) / F.col("grid"))))), "ranges")
    grids = small(cells.select("place", "grid").distinct(), counted[0], 24 * counted[0])
    whole = few.select("place", F.col("blocks").alias("n_blocks"))
    numbered_draws = drawn.join(grids, "place").join(F.broadcast(whole) if few is not sources else whole, "place").withColumn(
        "number", F.col("pass") * F.col("n_blocks") + F.col("at")).withColumn("cell", F.floor(F.col("number") / F.col("grid")))
    n_cells = cells.count()
    dealt = numbered_draws.join(small(cells.select("place", "cell", "shard", "first", "draws"), n_cells, 48 * n_cells), ["place", "cell"]).where(
        "number >= first and number < first + draws")
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), F.lit(3), "id", "block", "pass"), "id", "block", "pass", "row")
    return dealt.select("shard", (F.row_number().over(local) - 1).alias("order"), "row", "block", "pass", "words"), sources


def mixed_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """How much of each document a mix of all sources takes.

    Returns ``id_col``, ``size``, ``source_size``, ``target``, ``taken`` and
    ``shards`` (ascending numbers of the shards that the splitting tree dealt
    the document's blocks to, empty if none was drawn), one row for each input
    row. A null text has size 0, a null source is a source
    of its own. Rows that repeat an id are drawn each for itself. An empty table
    gives an empty result; other columns are ignored.
    """
    sized = settle(row_numbers(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size")), "row"), "sizes")
    draws, sources = mix(sized)
    taken = draws.groupBy("row").agg(F.sum("words").alias("taken"), F.array_sort(F.collect_set("shard")).alias("shards"))
    counted = sources.agg(F.count(F.lit(1)), F.sum(F.coalesce(F.length("source"), F.lit(0)) * 4 + 64)).first()
    targets = small(sources.select(F.col("source").alias("of"), "source_size", "target"), counted[0], counted[1] or 0)
    return sized.join(targets, F.col("source").eqNullSafe(F.col("of"))).join(taken, "row", "left").select(
        F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("shards", F.array().cast("array<bigint>")).alias("shards"))


def block_texts(text: Column, block_words: int = BLOCK_WORDS) -> Column:
    """The text's blocks with the white space between their words; they join to the whole text."""
    return of_text(text, rf"[{SPACE}]*+(?:{WORD}+[{SPACE}]*+){{1,{block_words}}}")


def leading_words(text: Column, words: Column) -> Column:
    """The first ``words`` words of a text, joined by one space."""
    return F.array_join(F.slice(of_text(text, WORD), F.lit(1), words.cast("int")), " ")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: the blocks drawn, in shards, with the columns of their documents.

    Every row is one drawn block. ``text_col`` is the block's text, ``n_chars``,
    if there is such a column, its length; other columns are the document's. A
    document of at most ``BLOCK_WORDS`` words is one block and keeps its text as
    it is. Documents without words are in no mix. ``mix_shard`` and
    ``mix_order`` say where the block stands.
    """
    numbered = settle(row_numbers(docs, "__row"), "numbered")
    sized = settle(numbered.select(F.col("__row").alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size")), "sizes")
    draws, _ = mix(sized)
    picked = draws.select(F.col("row").alias("__row"), F.struct("block", "words", "shard", "order").alias("__draw"))
    # All draws of a document meet its text once: few numbers travel, and each text once.
    per_row = picked.groupBy("__row").agg(F.array_sort(F.collect_list("__draw")).alias("__draws"))
    joined = numbered.join(per_row, "__row").withColumn("__blocks", block_texts(or_empty(text_col)))
    rows = joined.withColumn("__draw", F.explode("__draws"))
    block = F.get("__blocks", F.col("__draw.block").cast("int"))
    whole = F.when(F.size("__blocks") == 1, F.col(text_col)).otherwise(block)
    rows = rows.withColumn("__words", word_count(block)).withColumn(
        text_col, F.when(F.col("__draw.words") >= F.col("__words"), whole).otherwise(leading_words(block, F.col("__draw.words"))))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.char_length(text_col).cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns, F.col("__draw.shard").alias("mix_shard"), F.col("__draw.order").alias("mix_order"))


def in_mixed_order(mixed: DataFrame) -> DataFrame:
    """The rows of :func:`mixed_documents` as the mix deals them: a shard in one partition, its blocks by their order.

    A shard has ``SHARD_DRAWS`` blocks at most, so a partition grows with the number of its shards only.
    """
    return mixed.repartition("mix_shard").sortWithinPartitions("mix_shard", "mix_order")
