"""Explainable keyword retrieval of taxonomy leaves.

A leaf's score is a sum of points over *features*: a taxonomy token that is in
the query's token set, or a level name that occurs in its text. A query's score
against every leaf is therefore fixed by its set of features, its *signature*.
Many queries share one signature, so the scoring runs once per distinct
signature, against an inverted index (feature -> leaf, points), and the result
is joined back. No pair of query and leaf without a common feature is formed.

In a large taxonomy most leaves share some cheap feature with a query and cannot
reach its best twelve. There the postings of a feature lie in blocks, the best
points first, and a few leaves scored first give each signature a limit: a block
is opened only if its best leaf, with all that the features behind it could still
add, can pass the limit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxoweave import fixed_values as fv
from taxoweave.functions.text import token_set, with_note
from taxoweave.operators.cleaning import cross_section
from taxoweave.operators.joins import dimension_join, hot_key_join
from taxoweave.operators.matching import LONG_GRAM, filed_needles, gram_sizes, placed_hits, substring_hits, text_grams
from taxoweave.schemas import TAXONOMY as SCHEMA
from taxoweave.session import settle

# A taxonomy above this many leaves or characters is joined by shuffle instead.
BROADCAST_LEAVES = 100_000
BROADCAST_CHARS = 50_000_000

# Answers to distinct signatures up to these bounds come to the rows.
BROADCAST_ANSWERS = 50_000
BROADCAST_ANSWER_CHARS = 16_000_000

# A lexicon of this many keys stands in the plan as it is.
LITERAL_KEYS = 256

# A taxonomy above this many leaves is ranked by bounds. Postings of a block, and the
# features and leaves of each that give a signature its first limit.
PRUNED_LEAVES = 1_000
BLOCK_LEAVES = 64
FIRST_FEATURES = 4
FIRST_LEAVES = 16
# Blocks of a list are opened to this many times the depth of the stage before.
DEEPER = 2
# Features on more leaves than a block, up to which a signature's bounds look at pairs of them.
PAIRED_FEATURES = 32

# A feature every query has: it lists the first leaves with zero points, which
# is what fills a ranking up when too few leaves score.
_FILLER = -1
_FILLER_TOKEN = ""
_SIG = ["sig_a", "sig_b"]


def _feature(kind: Column, term: Column) -> Column:
    """The number of a feature: a hash of its kind and term, whatever leaf it comes from."""
    return F.xxhash64(kind, term).alias("feature")


@dataclass(frozen=True)
class Lexicon:
    """Stop words and synonyms; a synonym key with a space is a phrase."""

    stopwords: Sequence[str] = field(default_factory=lambda: tuple(fv.STOPWORDS))
    synonyms: Mapping[str, Sequence[str]] = field(default_factory=lambda: fv.SYNONYMS)

    @property
    def bounded(self) -> bool:
        """True when the tokens that keys add may be broadcast."""
        words = [word for words in self.synonyms.values() for word in words]
        return len(words) <= BROADCAST_LEAVES and sum(map(len, [*self.synonyms, *words])) <= BROADCAST_CHARS

    def table(self, spark) -> DataFrame:
        """``(key, is_phrase, token)``, one row per token a key adds."""
        rows = [(key, " " in key, token) for key, words in self.synonyms.items() for token in words]
        names = ["key", "is_phrase", "token"]
        types = [pa.string(), pa.bool_(), pa.string()]
        columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(types)]
        return spark.createDataFrame(pa.table(dict(zip(names, columns))))


def expand_tokens(queries: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``(query_id, tokens)``: token set with synonyms added, sorted."""
    words = token_set(F.col("text"), lexicon.stopwords)
    if lexicon.bounded and len(lexicon.synonyms) <= LITERAL_KEYS:
        # A row of its own, so that the words are cut out of a text once however often they are named.
        own = queries.select("query_id", F.inline(F.array(F.struct(words.alias("_words"), F.lower("text").alias("_text")))))
        listed = own.select("query_id", F.concat("_words", _added_tokens(F.col("_words"), F.col("_text"), lexicon)).alias("_tokens"))
        folded = listed.groupBy("query_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_tokens")))).alias("tokens"))
        return folded.filter(F.size("tokens") > 0)
    spark = queries.sparkSession
    table = lexicon.table(spark)
    lowered = F.lower("text")
    words = queries.select("query_id", F.explode(words).alias("key"))
    by_word = dimension_join(words, table.filter(~F.col("is_phrase")), ["key"], bounded=lexicon.bounded).select("query_id", "token")
    hits = by_word.unionByName(words.withColumnRenamed("key", "token"))
    phrases = table.filter("is_phrase").select(F.col("key").alias("needle"), "token")
    shortest = min((len(key) for key in lexicon.synonyms if " " in key), default=None)
    by_phrase = substring_hits(queries.select("query_id", lowered.alias("text")), "text", phrases, bounded=lexicon.bounded, sizes=gram_sizes(shortest))
    hits = hits.unionByName(by_phrase.select("query_id", "token"))
    return hits.groupBy("query_id").agg(F.array_sort(F.collect_set("token")).alias("tokens"))


def _added_tokens(words: Column, lowered: Column, lexicon: Lexicon) -> Column:
    """What a lexicon of few keys adds to a text, from the row alone."""
    def strings(values) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    if not lexicon.synonyms:
        return strings([])
    phrases = [key for key in lexicon.synonyms if " " in key]
    met = F.array_intersect(words, strings(key for key in lexicon.synonyms if " " not in key))
    said = F.array_compact(F.array(*[F.when(F.contains(lowered, F.lit(key)), F.lit(key)) for key in phrases]).cast("array<string>"))
    adds = F.create_map(*[c for key, tokens in lexicon.synonyms.items() for c in (F.lit(key), strings(tokens))])
    return F.flatten(F.transform(F.concat(met, said), lambda key: F.element_at(adds, key)))


class TaxonomyIndex:
    """Inverted index of a taxonomy for one lexicon.

    The taxonomy and the index tables are written to the shared folder when
    first used, so a query plan holds scans of them and not their derivation.
    """

    def __init__(self, taxonomy: DataFrame, lexicon: Lexicon | None = None):
        self.taxonomy = settle(taxonomy.select(SCHEMA.fieldNames()), "taxonomy")
        self.lexicon = lexicon or Lexicon()

    # -- size ------------------------------------------------------------

    @cached_property
    def _measure(self):
        """Leaves, characters and the shortest level name: one row, one small job."""
        chars = sum((F.length(c) for c in ("L1", "L2", "L3", "L4", "boundary_note")), F.lit(0))
        shortest = F.least(*[F.when(F.length(c) > 0, F.length(c)) for c in ("L3", "L4")])
        return self.taxonomy.agg(
            F.count(F.lit(1)).alias("leaves"),
            F.coalesce(F.sum(chars), F.lit(0)).alias("chars"),
            F.min(shortest).alias("shortest"),
        ).first()

    @cached_property
    def bounded(self) -> bool:
        """True when everything derived from the taxonomy may be broadcast."""
        return self._measure.leaves <= BROADCAST_LEAVES and self._measure.chars <= BROADCAST_CHARS

    @cached_property
    def _gram_sizes(self) -> tuple[int, ...]:
        lengths = [len(key) for key in self.lexicon.synonyms if " " in key]
        return gram_sizes(min([*lengths, self._measure.shortest or LONG_GRAM]))

    # -- index tables ----------------------------------------------------

    @cached_property
    def _leaf_tokens(self) -> DataFrame:
        """``(ordinal, term, signals)``: each token of a leaf with what it earns."""
        stop = self.lexicon.stopwords
        note = F.coalesce("boundary_note", F.lit(""))
        sets = {"NOTE": token_set(note, stop)} | {c: token_set(F.col(c), stop) for c in ("L4", "L3", "L2", "L1")}
        tokenised = self.taxonomy.select("ordinal", *[s.alias(f"_{name}") for name, s in sets.items()])
        everything = F.array_distinct(F.concat(*[F.col(f"_{name}") for name in sets]))
        return tokenised.select("*", F.explode(everything).alias("term")).select(
            "ordinal",
            "term",
            F.filter(
                F.array(*[
                    F.when(
                        F.array_contains(f"_{name}", F.col("term")),
                        F.struct(F.lit(name).alias("signal"), F.lit(fv.POINTS[name]).alias("points")),
                    )
                    for name in sets
                ]),
                lambda s: s.isNotNull(),
            ).alias("signals"),
        )

    @cached_property
    def _names(self) -> DataFrame:
        """``(ordinal, name, signal, points)`` for L4 and L3 names."""
        return self.taxonomy.select(
            "ordinal",
            F.inline(F.array(*[
                F.struct(
                    F.lower(level).alias("name"),
                    F.lit(f"{level}_NAME").alias("signal"),
                    F.lit(fv.POINTS[f"{level}_NAME"]).alias("points"),
                )
                for level in ("L4", "L3")
            ])),
        )

    @cached_property
    def signals(self) -> DataFrame:
        """``(feature, ordinal, signal, term, points)``: every point there is."""
        by_token = self._leaf_tokens.select(_feature(F.lit("TOKEN"), F.col("term")), "ordinal", "term", F.inline("signals"))
        by_name = self._names.filter(F.length("name") > 0).select(
            _feature(F.col("signal"), F.col("name")), "ordinal", F.col("name").alias("term"), "signal", "points"
        )
        return settle(by_token.unionByName(by_name), "signals")

    @cached_property
    def postings(self) -> DataFrame:
        """``(feature, ordinal, points)`` with the filler's zero-point leaves."""
        scored = self.signals.groupBy("feature", "ordinal").agg(F.sum("points").alias("points"))
        first = self.taxonomy.orderBy("ordinal").limit(fv.MODERATE_MAX)
        filler = first.select(F.lit(_FILLER).cast("long").alias("feature"), "ordinal", F.lit(0).cast("long").alias("points"))
        return scored.unionByName(filler)

    @cached_property
    def _triggers(self) -> DataFrame:
        """``(kind, probe, needle, feature)``: what in a text sets a feature.

        A token sets its own feature and those of its synonyms. A gram leads to
        the level names and phrases that are filed under it.
        """
        spark = self.taxonomy.sparkSession
        known = self.signals.select("feature", "term", F.endswith("signal", F.lit("_NAME")).alias("is_name")).distinct()
        tokens, names = known.filter(~F.col("is_name")), known.filter("is_name")
        added = dimension_join(tokens.withColumn("token", F.col("term")), self.lexicon.table(spark), ["token"], bounded=self.lexicon.bounded)

        def by_token(df: DataFrame, token: Column) -> DataFrame:
            return df.select(F.lit("t").alias("kind"), token.alias("probe"), F.lit(None).cast("string").alias("needle"), "feature")

        filler = spark.range(1).withColumn("feature", F.lit(_FILLER).cast("long"))
        needles = added.filter("is_phrase").select(F.col("key").alias("needle"), "feature").unionByName(names.select(F.col("term").alias("needle"), "feature"))
        filed = filed_needles(needles, self._gram_sizes).select(F.lit("g").alias("kind"), F.col("_gram").alias("probe"), "needle", "feature")
        triggers = by_token(tokens, F.col("term"))
        for more in (by_token(added.filter(~F.col("is_phrase")), F.col("key")), filed, by_token(filler, F.lit(_FILLER_TOKEN))):
            triggers = triggers.unionByName(more)
        return settle(triggers, "triggers")

    # -- queries ---------------------------------------------------------

    def signatures(self, queries: DataFrame) -> DataFrame:
        """``(query_id, signature)`` for rows of ``(query_id, text)``.

        One pass over the texts: tokens and grams are exploded together and
        meet the triggers in one join; partial aggregation folds them back per
        query before the only shuffle.
        """
        queries = queries.select("query_id", F.coalesce("text", F.lit("")).alias("text"))  # a null text still has the filler
        words = F.array_append(token_set(F.col("text"), self.lexicon.stopwords), F.lit(_FILLER_TOKEN))
        if self.bounded:
            pieces = queries.select(
                "query_id",
                F.lower("text").alias("_text"),
                F.inline(F.array(
                    F.struct(F.lit("t").alias("kind"), words.alias("_probes")),
                    F.struct(F.lit("g").alias("kind"), F.array_distinct(text_grams(F.lower("text"), self._gram_sizes)).alias("_probes")),
                )),
            ).select("query_id", "_text", "kind", F.explode("_probes").alias("probe"))
            met = dimension_join(
                pieces, self._triggers, ["kind", "probe"], bounded=True,
                condition=F.col("needle").isNull() | F.contains("_text", "needle"),
            )
        else:
            by_word, by_needle = self._triggers.filter("kind = 't'"), self._triggers.filter("kind = 'g'")
            probes = queries.select("query_id", F.explode(words).alias("probe"))
            met = dimension_join(probes, by_word, ["probe"], bounded=False).select("query_id", "feature").unionByName(
                placed_hits(queries.select("query_id", F.lower("text").alias("text")), "text", by_needle.select("needle", "feature"), self._gram_sizes)
                .select("query_id", "feature")
            )
        folded = met.groupBy("query_id").agg(F.sort_array(F.collect_set("feature")).alias("signature"))
        # 128 bits of hash stand for the array in every later key: longs sort, join and
        # aggregate far faster, and a chance collision is out of reach of any table size.
        hashes = {"sig_a": F.xxhash64("signature"), "sig_b": F.xxhash64(F.lit("b"), "signature")}
        # Ranking and the join back both read this, so the texts are cut only once.
        return settle(folded.select("query_id", *[h.alias(k) for k, h in hashes.items()], "signature"), "signatures")

    def _distinct(self, signatures: DataFrame) -> DataFrame:
        """One row per signature and feature, spread over a fixed number of tasks.

        The table of distinct signatures is small, but each one meets many
        leaves; left to its size it would be squeezed into few tasks.
        """
        partitions = int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        distinct = signatures.select(*_SIG, "signature").distinct().repartition(partitions, *_SIG)
        return distinct.select(*_SIG, F.explode("signature").alias("feature"))

    def rank_signatures(self, signatures: DataFrame, top_n: int = fv.DEFAULT_TOP_N) -> DataFrame:
        """``(sig_a, sig_b, branch, max_score, candidates)`` per distinct signature.

        ``candidates`` is an ordered array of ``(rank, ordinal, score, full_path,
        boundary_note)``. Ties fall to the lower ordinal.
        """
        features = self._distinct(signatures)
        if self._measure.leaves > PRUNED_LEAVES:
            _, best = self._staged(settle(features, "features"))
        else:
            scored = (
                dimension_join(features, self.postings, ["feature"], bounded=self.bounded)
                .groupBy(*_SIG, "ordinal")
                .agg(F.sum("points").alias("score"))
            )
            order = Window.partitionBy(*_SIG).orderBy(F.desc("score"), "ordinal")
            best = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= fv.MODERATE_MAX)
        named = dimension_join(best, self._leaf_labels, ["ordinal"], bounded=self.bounded)
        entry = F.struct("rank", "ordinal", "score", "full_path", "boundary_note")
        # At most MODERATE_MAX rows per signature are left to gather.
        ranked = named.groupBy(*_SIG).agg(F.sort_array(F.collect_list(entry)).alias("ranked"))
        top = F.get(F.col("ranked"), F.lit(0))["score"]
        branch = F.when(top >= fv.STRONG_SCORE, "strong").when(top >= fv.MODERATE_SCORE, "moderate").otherwise("weak")
        size = F.when(F.col("branch") == "strong", min(top_n, fv.STRONG_MAX)).otherwise(
            min(max(top_n, fv.MODERATE_MIN), fv.MODERATE_MAX)
        )
        return ranked.select(*_SIG, branch.alias("branch"), top.alias("max_score"), "ranked").select(
            *_SIG, "branch", "max_score",
            F.when(F.col("branch") == "weak", self._cross_section.scalar())
            .otherwise(F.slice("ranked", F.lit(1), size))
            .alias("candidates"),
        )

    @cached_property
    def _scored_postings(self) -> DataFrame:
        """``(feature, ordinal, points)``; a leaf with an ordinal that repeats has its points added up."""
        return settle(self.signals.groupBy("feature", "ordinal").agg(F.sum("points").alias("points")), "postings")

    @cached_property
    def _blocks(self) -> DataFrame:
        """``(feature, block, entries)``: postings in blocks, the most points and then the lowest ordinal first."""
        place = F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("points"), "ordinal")) - 1
        dealt = self._scored_postings.withColumn("block", F.floor(place / BLOCK_LEAVES))
        entry = F.struct((-F.col("points")).alias("minus"), "ordinal")
        # At most BLOCK_LEAVES rows per block.
        return settle(dealt.groupBy("feature", "block").agg(F.sort_array(F.collect_list(entry)).alias("entries")), "blocks")

    @cached_property
    def _sizes(self) -> DataFrame:
        """``(feature, most, leaves)``: the most points that a feature earns, and how many leaves it is on."""
        return settle(self._scored_postings.groupBy("feature").agg(F.max("points").alias("most"), F.count(F.lit(1)).alias("leaves")), "sizes")

    @cached_property
    def _together(self) -> DataFrame:
        """``(feature, other, points)``: the most that ``other`` earns on a leaf of ``feature``, for features on more leaves than a block."""
        long = self._sizes.filter(F.col("leaves") > BLOCK_LEAVES).select("feature")
        kept = dimension_join(self._scored_postings, long, ["feature"], bounded=self.bounded)
        others = kept.select("ordinal", F.col("feature").alias("other"), "points")
        pairs = kept.select("ordinal", "feature").join(others, "ordinal").filter(F.col("feature") != F.col("other"))
        return settle(pairs.groupBy("feature", "other").agg(F.max("points").alias("points")), "together")

    @cached_property
    def _leaf_entries(self) -> DataFrame:
        """``(ordinal, earns)``: all that a leaf can earn, feature by feature."""
        return settle(self._scored_postings.groupBy("ordinal").agg(F.collect_list(F.struct("feature", "points")).alias("earns")), "leaf_entries")

    def _scores(self, pairs: DataFrame, features: DataFrame) -> DataFrame:
        """``(sig_a, sig_b, ordinal, score)``: exact scores of distinct pairs of signature and leaf.

        ``pairs`` is read twice where leaves do not fit a broadcast.
        """
        asked = pairs.join(features.groupBy(*_SIG).agg(F.collect_list("feature").alias("asked")), _SIG)
        if self.bounded:
            met = dimension_join(asked, self._leaf_entries, ["ordinal"], bounded=True, how="left")
        else:
            # Every signature asks for the first leaves.
            counts = pairs.groupBy("ordinal").agg(F.count(F.lit(1)).alias("n_pairs"))
            met = hot_key_join(asked, self._leaf_entries, ["ordinal"], counts=counts, rows="n_pairs", spread=_SIG)
        earned = F.transform(F.filter("earns", lambda e: F.array_contains("asked", e["feature"])), lambda e: e["points"])
        total = F.aggregate(earned, F.lit(0).cast("long"), lambda x, y: x + y)
        return met.select(*_SIG, "ordinal", F.coalesce(total, F.lit(0).cast("long")).alias("score"))

    def contenders(self, features: DataFrame) -> DataFrame:
        """``(sig_a, sig_b, ordinal, score)``: the leaves that can be among a signature's best, and few others."""
        scored, _ = self._staged(features)
        return scored

    def _staged(self, features: DataFrame) -> tuple[DataFrame, DataFrame]:
        """What :meth:`contenders` gives, and of it the best of each signature with their ``rank``.

        ``features`` has a row per signature and feature. A signature's features
        are ordered by the number of their leaves, the fewest first. A leaf is
        looked for in the list of its first feature only, so what it can earn
        beyond its points there is at most what the later features can on
        leaves of that list. Lists are opened in stages, each to several times
        the depth of the one before, and every stage raises the limits. Nothing
        in a list is better than the entries before it, so a list is closed where
        its next entry fails, and a signature without an open list is done.
        """
        known = dimension_join(features, self._sizes, ["feature"], bounded=self.bounded)
        order = Window.partitionBy(*_SIG).orderBy("leaves", F.desc("most"), "feature")
        listed = settle(known.select(
            *_SIG, "feature", "most", "leaves", F.row_number().over(order).alias("place"),
            F.coalesce(F.sum("most").over(order.rowsBetween(1, Window.unboundedFollowing)), F.lit(0)).alias("later"),
        ), "listed")
        fillers = self.taxonomy.orderBy("ordinal").limit(fv.MODERATE_MAX).agg(F.collect_list("ordinal"))  # a dozen
        opened = dimension_join(listed.filter(F.col("place") <= FIRST_FEATURES), self._blocks.filter("block = 0"), ["feature"], bounded=self.bounded)
        first = opened.select(*_SIG, F.explode(F.slice("entries", 1, FIRST_LEAVES)).alias("e")).select(*_SIG, "e.ordinal")
        first = settle(first.unionByName(features.select(*_SIG).distinct().select(*_SIG, F.explode(fillers.scalar()).alias("ordinal"))).distinct(), "first")
        opened = [settle(self._scores(first, features), "scored")]
        order = Window.partitionBy(*_SIG).orderBy(F.desc("score"), "ordinal")

        def best_of(scored: DataFrame) -> DataFrame:
            placed = scored.distinct().withColumn("rank", F.row_number().over(order))
            return settle(placed.filter(F.col("rank") <= fv.MODERATE_MAX), "best")

        def with_limit(rows: DataFrame) -> DataFrame:
            last = best.filter(F.col("rank") == fv.MODERATE_MAX)
            return rows.join(last.select(*_SIG, F.struct((-F.col("score")).alias("minus"), "ordinal").alias("limit")), _SIG, "left")

        def passes(minus: Column, ordinal: Column) -> Column:
            return F.col("limit").isNull() | (F.struct((minus - F.col("later")).alias("minus"), ordinal.alias("ordinal")) < F.col("limit"))

        best = best_of(opened[0])
        likely = F.col("limit").isNull() | (F.col("most") + F.col("later") >= -F.col("limit.minus"))
        bounds = settle(self._tightened(with_limit(listed).filter(likely).drop("limit"), listed), "bounds")
        head = self._blocks.select("feature", "block", F.get("entries", F.lit(0)).alias("e"), F.array_min(F.transform("entries", lambda x: x["ordinal"])).alias("lowest"))
        ranked, done, depth = [], 0, 1
        while True:
            following = head.filter(F.col("block") == done).select("feature", "e")
            live = dimension_join(with_limit(bounds), following, ["feature"], bounded=self.bounded).filter(passes(F.col("e.minus"), F.col("e.ordinal")))
            live = settle(live.drop("e"), "live")
            if live.isEmpty():
                break
            asking = live.select(*_SIG).distinct()
            ranked.append(best.join(asking, _SIG, "left_anti"))
            stage = (F.col("block") >= done) & (F.col("block") < depth)
            # A block's best leaf has its most points and, for ties, its lowest ordinal.
            asked = dimension_join(live, head.filter(stage), ["feature"], bounded=self.bounded).filter(passes(F.col("e.minus"), F.col("lowest")))
            more = dimension_join(asked.drop("e", "lowest"), self._blocks.filter(stage), ["feature", "block"], bounded=self.bounded)
            more = more.select(*_SIG, "later", "limit", F.explode("entries").alias("e")).filter(passes(F.col("e.minus"), F.col("e.ordinal")))
            pairs = settle(more.select(*_SIG, "e.ordinal").distinct(), "pairs")
            opened.append(settle(self._scores(pairs, features), "scored"))
            best = best_of(best.join(asking, _SIG, "left_semi").drop("rank").unionByName(opened[-1]))
            bounds, done, depth = live.drop("limit"), depth, depth * DEEPER
        return reduce(DataFrame.unionByName, opened).distinct(), reduce(DataFrame.unionByName, [*ranked, best])

    def _tightened(self, asking: DataFrame, listed: DataFrame) -> DataFrame:
        """``(sig_a, sig_b, feature, later)``: how much the leaves of a list can earn by later features.

        Behind a list of several blocks stand longer ones only, which are all in
        the table of pairs. A leaf earns by a next feature and by others behind
        that, the latter no more than they earn beside either of the two.
        """
        long = listed.filter(F.col("leaves") > BLOCK_LEAVES).select(*_SIG, "feature", "place")
        few = long.groupBy(*_SIG).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= PAIRED_FEATURES).select(*_SIG)
        long = long.join(few, _SIG)
        after = long.select(*_SIG, F.col("feature").alias("other"), F.col("place").alias("behind"))
        met = long.join(after, _SIG).filter(F.col("behind") > F.col("place"))
        pairs = settle(dimension_join(met, self._together, ["feature", "other"], bounded=self.bounded).select(*_SIG, "feature", "other", "points"), "pairs")
        third = pairs.select(*_SIG, F.col("feature").alias("other"), F.col("other").alias("last"), F.col("points").alias("beside"))
        same = pairs.select(*_SIG, "feature", F.col("other").alias("last"), F.col("points").alias("own"))
        beyond = pairs.join(third, [*_SIG, "other"]).join(same, [*_SIG, "feature", "last"])
        beyond = beyond.groupBy(*_SIG, "feature", "other").agg(F.sum(F.least("beside", "own")).alias("beyond"))
        best = pairs.join(beyond, [*_SIG, "feature", "other"], "left").groupBy(*_SIG, "feature").agg(
            F.max(F.col("points") + F.coalesce("beyond", F.lit(0))).alias("next"))
        marked = asking.join(few.withColumn("_paired", F.lit(True)), _SIG, "left").join(best, [*_SIG, "feature"], "left")
        tight = F.when((F.col("leaves") > BLOCK_LEAVES) & F.col("_paired"), F.coalesce("next", F.lit(0))).otherwise(F.col("later"))
        return marked.select(*_SIG, "feature", tight.alias("later"))

    @cached_property
    def _leaf_labels(self) -> DataFrame:
        return self.taxonomy.select("ordinal", "full_path", F.coalesce("boundary_note", F.lit("")).alias("boundary_note"))

    @cached_property
    def _cross_section(self) -> DataFrame:
        """One value: the fallback list for weak queries, a few leaves per L1."""
        leaves = cross_section(self.taxonomy).select(
            F.row_number().over(Window.orderBy("ordinal")).alias("rank"),
            "ordinal",
            F.lit(None).cast("long").alias("score"),
            "full_path",
            F.coalesce("boundary_note", F.lit("")).alias("boundary_note"),
        )
        entry = F.struct("rank", "ordinal", "score", "full_path", "boundary_note")
        return leaves.agg(F.sort_array(F.collect_list(entry)).alias("section"))

    def _joined(self, queries: DataFrame, top_n: int, columns: dict[str, Column]) -> DataFrame:
        """Rank per signature, reshape per signature, then join back per query."""
        signatures = self.signatures(queries)
        ranked = self.rank_signatures(signatures, top_n)
        return self._back_to_queries(signatures, ranked.select(*_SIG, *[c.alias(name) for name, c in columns.items()]))

    @staticmethod
    def _back_to_queries(signatures: DataFrame, answers: DataFrame) -> DataFrame:
        return TaxonomyIndex._back_to_rows(signatures.select("query_id", *_SIG), answers, "query_id")

    @staticmethod
    def _back_to_rows(rows: DataFrame, answers: DataFrame, spread: str) -> DataFrame:
        """Rows that carry a signature with its answer.

        Answers are one for each distinct signature; measured to be few, they
        come to the rows, so that rows do not travel with what is said of them.
        """
        answers = settle(answers, "answers")
        size = answers.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(F.to_json(F.struct(*answers.columns)))).alias("chars")).first()
        if size.n <= BROADCAST_ANSWERS and (size.chars or 0) <= BROADCAST_ANSWER_CHARS:
            return rows.join(F.broadcast(answers), _SIG).drop(*_SIG)
        counts = rows.groupBy(*_SIG).agg(F.count(F.lit(1)).alias("n_queries"))
        return hot_key_join(
            rows, answers, _SIG, counts=counts, rows="n_queries", spread=[spread], how="inner"
        ).drop(*_SIG)

    def candidates(self, queries: DataFrame, top_n: int = fv.DEFAULT_TOP_N) -> DataFrame:
        """``(query_id, branch, rank, ordinal, score, full_path, boundary_note)``.

        ``score`` is null for the cross-section that weak queries receive.
        """
        columns = {"branch": F.col("branch"), "candidates": F.col("candidates")}
        return self._joined(queries, top_n, columns).select("query_id", "branch", F.inline("candidates"))

    def contexts(self, queries: DataFrame, top_n: int = fv.DEFAULT_TOP_N) -> DataFrame:
        """``(query_id, branch, max_score, paths, raw_paths)`` for prompts."""
        return self._joined(queries, top_n, self._context_columns())

    @staticmethod
    def _context_columns() -> dict[str, Column]:
        listed = F.col("candidates")
        return {
            "branch": F.col("branch"),
            "max_score": F.col("max_score"),
            "paths": F.transform(listed, lambda c: with_note(c["full_path"], c["boundary_note"])),
            "raw_paths": F.transform(listed, lambda c: c["full_path"]),
        }

    def with_contexts(self, rows: DataFrame, key: str, queries: DataFrame, top_n: int = fv.DEFAULT_TOP_N) -> DataFrame:
        """``rows`` whose ``key`` is a query's id, with the columns of :meth:`contexts`.

        Rows meet the hashes of their signature first and the lists of paths last.
        """
        signatures = self.signatures(queries)
        ranked = self.rank_signatures(signatures, top_n)
        answers = ranked.select(*_SIG, *[c.alias(name) for name, c in self._context_columns().items()])
        marked = rows.join(signatures.select(F.col("query_id").alias(key), *_SIG), key)
        return self._back_to_rows(marked, answers, key)

    def explain(self, queries: DataFrame, top_n: int = fv.DEFAULT_TOP_N) -> DataFrame:
        """One row per candidate and matched signal: what earned which points."""
        signatures = self.signatures(queries)
        ranked = self.rank_signatures(signatures, top_n)
        listed = ranked.select(*_SIG, F.inline("candidates")).select(*_SIG, "rank", "ordinal", "full_path")
        features = self._distinct(signatures).join(listed, _SIG)
        why = dimension_join(features, self.signals, ["feature", "ordinal"], bounded=self.bounded)
        reasons = why.groupBy(*_SIG).agg(
            # Bounded: candidates of one signature times the tokens of a leaf.
            F.collect_list(F.struct("rank", "ordinal", "full_path", "signal", "term", "points")).alias("reasons")
        )
        return self._back_to_queries(signatures, reasons).select("query_id", F.inline("reasons"))

    def top_candidate(self, queries: DataFrame, top_n: int = fv.DEFAULT_TOP_N) -> DataFrame:
        """The first candidate of every query."""
        first = F.get(F.col("candidates"), F.lit(0))
        return self._joined(queries, top_n, {
            "branch": F.col("branch"), "full_path": first["full_path"], "score": first["score"],
        })


def transaction_queries(transactions: DataFrame) -> DataFrame:
    """``(query_id, text)`` from the description and vendor of transactions."""
    text = F.concat_ws(" ", "spend_description", "vendor")
    return transactions.select(F.col("transaction_id").alias("query_id"), text.alias("text"))
