"""Scan for personal data: fixed patterns, and contexts that these teach for identifiers they miss.

The matches of the fixed patterns are seeds. The words around a seed are its
lexical patterns: the two words before it, and the word on either side. Tokens
and numbers spaced like phones or cards that look like an identifier of some kind
without matching its pattern are candidates, with patterns of their own. Patterns and instances form a graph,
which is scored in rounds: a pattern by the share of its different instances
that are known, an instance by the patterns it occurs in. Candidates that reach
the cut are known from then on; at the end they are what is discovered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import or_empty, row_numbers, settle
from .spans import Kind, count_of, in_order, joined, overlaps, with_spans


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(value: Column) -> Column:
    """Whether a number's check digit is right: from the right every second digit counts twice, less 9 if above 9."""
    digits = F.reverse(_digits(value))
    doubled = F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), lambda acc, i: acc + F.when(
        i % 2 == 1, F.substring(digits, i, F.lit(1)).cast("int")).otherwise(
        F.substring(digits, i, F.lit(1)).cast("int") * 2 - F.when(F.substring(digits, i, F.lit(1)).cast("int") > 4, 9).otherwise(0)))
    return F.char_length(digits).between(14, 19) & (F.when(F.char_length(digits).between(14, 19), doubled % 10).otherwise(1) == 0)


# The patterns of the known kinds. A match can begin inside a run of its first class only where the one
# before ended, so the search may start at runs; loops that need no second try take none.
IP_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
BASE = [
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", lambda m: m.rlike(rf"^(?:{IP_PART}\.){{3}}{IP_PART}$")),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){13,}+", None, passes_luhn),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", lambda m: F.char_length(_digits(m)).between(10, 15)),
]
KINDS = [k.name for k in BASE]
NAMES = KINDS + [f"context_{k}" for k in KINDS]
#: Tokens that may be an identifier, and what they must look like to be one of a kind.
CANDIDATE = Kind("token", r"(?:(?<![A-Za-z0-9@._%+()-])|\G)(?=[A-Za-z._%+()-]*+[0-9@])[A-Za-z0-9@._%+()-]{4,}+")
#: Numbers with the separators of phones and cards, spaces among them.
NUMBER = Kind("number", r"(?<![A-Za-z0-9@._%+()-])[(+]{0,2}+[0-9](?:[\x20().-]{0,3}+[0-9])++", None, lambda m: F.contains(m, F.lit(" ")))
SPACED = {
    "card": r"^[0-9](?:[\x20-]?[0-9]){12,18}$", "phone": r"^[(+]*[0-9](?:[^0-9]*[0-9]){6,14}$",
}
SHAPES = {
    "email": r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9._-]+$", "ip": r"^[0-9]+(?:\.[0-9]+){3}$",
    "card": r"^[0-9][0-9-]{10,21}[0-9]$", "phone": r"^\(?[0-9][0-9().-]{5,}[0-9]$",
}
ROUNDS = 3
#: Different known instances a pattern needs, the share of its instances they must be, and what an instance must reach.
SUPPORT, PRECISION, CONFIDENCE = 3, 0.7, 0.8


def _contexts(left: Column, right: Column) -> Column:
    """Lexical patterns of an occurrence: the two words before it, and the word before with the word behind."""
    before = F.lower(F.regexp_extract(left, r"(\S*\s*\S*)\s*$", 1))
    last = F.lower(F.regexp_extract(left, r"(\S*)\s*$", 1))
    behind = F.lower(F.regexp_extract(right, r"^\s*(\S*)", 1))
    squeezed = F.regexp_replace(before, r"\s+", " ")
    return F.array(F.concat(squeezed, F.lit(" _")), F.concat(last, F.lit(" _ "), behind))


def _learnt(edges: DataFrame, rounds: int) -> DataFrame:
    """``kind``, ``value``, ``confidence`` of the candidates that reach the cut.

    ``edges`` has each ``kind``, ``context``, ``value`` once, with ``seed``.
    """
    known = None
    for _ in range(rounds):
        if known is None:
            held = edges.withColumn("weight", F.col("seed").cast("double"))
        else:
            held = edges.join(known, ["kind", "value"], "left").withColumn(
                "weight", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("confidence", F.lit(0.0))))
        patterns = held.groupBy("kind", "context").agg(F.sum("weight").alias("known"), F.count(F.lit(1)).alias("all")).where(
            (F.col("known") >= SUPPORT) & (F.col("known") >= PRECISION * F.col("all"))).select("kind", "context", (F.col("known") / F.col("all")).alias("score"))
        found = edges.where("not seed").join(patterns, ["kind", "context"]).groupBy("kind", "value").agg(
            (1 - F.exp(F.sum(F.log(1 - F.least("score", F.lit(0.999)))))).alias("confidence")).where(F.col("confidence") >= CONFIDENCE - 1e-9)
        known = settle(found, "known")
    return known


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Personal data of whole texts: ``id_col``, ``base`` and ``found``, a row for each input row.

    Both are arrays of ``start``, ``kind`` (place in ``NAMES``) and ``end`` in
    code points, by start and then kind; ``found`` has the base spans and the
    candidates that contexts discover, which overlap none of them. Null texts
    count as empty and hold nothing. Rows that repeat an id are scanned each
    for itself. Other columns are ignored; an empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).alias("id"), or_empty(text_col).alias("text"))
    spans = with_spans(texts, "text", [*BASE, CANDIDATE, NUMBER]).withColumn("base", in_order(KINDS))
    spans = spans.withColumn("number", F.coalesce(F.filter("number", lambda s: ~overlaps(s, F.col("base"))), F.array().cast(spans.schema["number"].dataType)))
    seeds = F.flatten(F.array(*[F.coalesce(_occurrences(F.col(k), F.lit(i), True), _none()) for i, k in enumerate(KINDS)]))
    # A part of a spaced number is no candidate of its own.
    clean = F.filter("token", lambda s: ~overlaps(s, F.col("base")) & ~overlaps(s, F.col("number")))
    shaped = F.flatten(F.array(*[
        F.coalesce(_occurrences(_of_shape(found, shapes[k]), F.lit(i), False), _none())
        for found, shapes in ((clean, SHAPES), (F.col("number"), SPACED)) for i, k in enumerate(KINDS) if k in shapes]))
    rows = settle(row_numbers(spans.select("id", "base", seeds.alias("seeds"), shaped.alias("shaped")), "row"), "identifiers")

    occurrences = rows.select("row", F.explode(F.concat("seeds", "shaped")).alias("o")).select("row", "o.*")
    edges = occurrences.withColumn("context", F.explode("contexts")).groupBy("kind", "context", "value").agg(F.max("seed").alias("seed"))
    known = _learnt(settle(edges, "edges"), rounds)
    hits = rows.select("row", F.explode("shaped").alias("o")).select("row", "o.kind", "o.value", "o.start", "o.end").join(known, ["kind", "value"])
    per_row = hits.groupBy("row", "start", "end").agg(F.min("kind").alias("kind")).groupBy("row").agg(
        F.collect_list(F.struct(F.col("start"), (F.col("kind") + len(KINDS)).alias("kind"), F.col("end"))).alias("extra"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return rows.select("row", "id", "base").join(per_row, "row", "left").select(
        F.col("id").alias(id_col), "base", F.array_sort(F.concat("base", F.coalesce("extra", none))).alias("found"))


def _none() -> Column:
    return F.array().cast("array<struct<kind:int,value:string,start:int,end:int,seed:boolean,contexts:array<string>>>")


def _of_shape(spans: Column, shape: str) -> Column:
    """Tokens of a shape, without the marks that follow them."""
    ended = F.transform(spans, lambda s: F.struct(
        F.regexp_replace(s["value"], r"[.,%+(_-]+$", "").alias("value"), s["start"].alias("start"), s["left"].alias("left"), s["right"].alias("right")))
    placed = F.transform(ended, lambda s: F.struct(
        s["value"].alias("value"), s["start"].alias("start"), (s["start"] + F.char_length(s["value"])).alias("end"), s["left"].alias("left"), s["right"].alias("right")))
    return F.filter(placed, lambda s: s["value"].rlike(shape))


def _occurrences(spans: Column, kind: Column, seed: bool) -> Column:
    return F.transform(spans, lambda s: F.struct(
        kind.alias("kind"), F.lower(s["value"]).alias("value"), s["start"].alias("start"), s["end"].alias("end"), F.lit(seed).alias("seed"),
        _contexts(s["left"], s["right"]).alias("contexts")))


def personal_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as text."""
    counts = [count_of(F.col("base"), i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select(id_col, *counts, F.sha2(joined(F.col("base"), NAMES).cast("binary"), 256).alias("base_sha256"), joined(F.col("found"), NAMES).alias("spans"))
