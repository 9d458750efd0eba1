"""Scan for secrets: fixed patterns, and a battery of randomness tests for tokens that fit none.

A long token's encoding gives its alphabet. Three statistics compare it with
independent, uniform characters: chi-squared over the alphabet, the number of
runs above and below the middle of the alphabet, and the correlation of
neighbours. The letters of an alphabet stand in the order of their frequency in
text, so text stays on one side of the middle and has few runs. A weighted sum of
the three is one score, whose distribution on ordinary tokens gives the p-value:
stated values for each length, moved and widened by what the ordinary tokens of
the whole corpus show in each class of length. Step-up control of the false
discovery rate then runs within the classes; its cut is found on a grid of
p-values, so it needs counts only.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, or_empty, settle
from .spans import Kind, count_of, in_order, joined, normal_cdf, of_kind, overlaps, with_spans

# The patterns of the known kinds. Runs of a character class match whole, so a least length within
# the pattern gives the same matches as a check afterwards; the value of an assignment is checked afterwards.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""
BASE = [
    Kind("assign", ASSIGN, keep=lambda m: F.char_length(F.regexp_extract(m, ASSIGN, 2)) >= 6),
    Kind("access", "AKIA[A-Z0-9]{16,}+", "AKIA"),
    Kind("hex", "[0-9a-f]{24,}+"),
]
NAMES = [k.name for k in BASE] + ["random"]
CANDIDATE = Kind("token", r"[A-Za-z0-9+/_-]{20,}+={0,2}+")

# Letters by their frequency in text.
LOWER, UPPER, DIGITS = "etaoinsrhldcumfpgwybvkxjqz", "ETAOINSRHLDCUMFPGWYBVKXJQZ", "0123456789"
LETTERS = "".join(a + b for a, b in zip(LOWER, UPPER))
#: Encodings by the narrowest first: pattern and alphabet.
ENCODINGS = [
    ("^[0-9a-f]+$", DIGITS + "abcdef"), ("^[0-9A-F]+$", DIGITS + "ABCDEF"), ("^[A-Z2-7]+$", UPPER + "234567"),
    ("^[0-9a-z]+$", LOWER + DIGITS), ("^[0-9A-Z]+$", UPPER + DIGITS), ("^[0-9A-Za-z]+$", LETTERS + DIGITS),
    ("^[0-9A-Za-z+/]+$", "/+" + LETTERS + DIGITS), ("", "_-/+" + LETTERS + DIGITS),
]
#: How uneven text is: index of coincidence over uniform less 1, correlation of neighbours, deviation of runs over sqrt(n).
TEXT_EXCESS, TEXT_CORRELATION, TEXT_RUNS = 0.7, 0.5, 0.5
#: By least length: weights of the logarithm of chi-squared over its freedom and of the correlation (runs weigh 1), and
#: mean and deviation of the sum on ordinary tokens, measured on joined words (plain, camel case, snake case, paths).
SCORES = [
    (20, 3.64, 0.29, 5.43, 1.74), (24, 4.21, 0.29, 6.60, 1.97), (32, 5.15, 0.32, 9.38, 2.49), (48, 4.08, 0.19, 12.61, 2.88), (96, 6.79, 0.16, 23.87, 4.94),
]
#: Mean and deviation of the scores of random tokens by length class, which follow from the formula alone.
RANDOM = ((-3.3, 0.8), (-3.9, 0.7), (-4.4, 0.55), (-4.9, 0.4))
#: What ordinary tokens are held for before the corpus is measured, the tokens that this weighs as much as, and bounds.
ORDINARY, PRIOR, LEAST_DEVIATION, MOST_SCORE = (0.0, 0.85), 50, 0.6, 3.0
STEPS, BINS = 60, 10
RATE = 0.01
#: Length classes of the false-discovery control, by their least length.
CLASSES = (20, 32, 48, 96)
GRID = 16


def battery(token: Column) -> Column:
    """The first test of a token, and what the others need: its length, its alphabet's size and its characters' places there."""
    trimmed = F.rtrim(token, F.lit("="))
    chosen = F.coalesce(*[F.when(trimmed.rlike(p), F.lit(a)) for p, a in ENCODINGS[:-1]], F.lit(ENCODINGS[-1][1]))

    def measured(t: Column) -> Column:
        body, alphabet = t["body"], t["alphabet"]
        n, size = F.char_length(body).cast("double"), F.char_length(alphabet).cast("double")
        symbols = F.filter(F.split(alphabet, ""), lambda c: c != "")
        counts = F.transform(symbols, lambda c: F.char_length(body) - F.char_length(F.replace(body, c, F.lit(""))))
        square = F.aggregate(counts, F.lit(0.0), lambda acc, k: acc + (k - n / size) * (k - n / size))
        freedom, text = size - 1, n * TEXT_EXCESS
        uniform = normal_cdf((square * size / n - freedom - text) / F.sqrt(2 * (freedom + 2 * text)))
        numbers = F.transform(F.filter(F.split(body, ""), lambda c: c != ""), lambda c: F.call_function("instr", alphabet, c).cast("double"))
        excess = F.log(F.greatest(square * size / n / freedom, F.lit(0.05)))
        return F.struct(n.alias("n"), size.alias("size"), uniform.alias("uniform"), excess.alias("excess"), numbers.alias("x"))

    return let(F.struct(trimmed.alias("body"), chosen.alias("alphabet")), measured)


def _compared(b: Column, body: Callable[[Column, Column, Column], Column]) -> Column:
    """``body`` of the correlation of neighbours, the number of runs and twice the product of the sides' counts.

    The runs and the correlation are those of the characters' places in their
    alphabet.
    """
    n, middle = b["n"], (b["size"] + 1) / 2
    total = F.aggregate(b["x"], F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("squares"), F.lit(0.0).alias("above")), lambda acc, v: F.struct(
        (acc["sum"] + v).alias("sum"), (acc["squares"] + v * v).alias("squares"), (acc["above"] + F.when(v > middle, 1.0).otherwise(0.0)).alias("above")))
    pairs = F.zip_with(F.slice(b["x"], F.lit(1), (n - 1).cast("int")), F.slice(b["x"], F.lit(2), (n - 1).cast("int")), lambda a, c: F.struct(a.alias("a"), c.alias("c")))

    def tests(sums: Column) -> Column:
        mean, above = sums["sum"] / n, sums["above"]
        start = F.struct(F.lit(0.0).alias("product"), F.lit(1.0).alias("runs"))
        followed = F.aggregate(pairs, start, lambda acc, p: F.struct(
            (acc["product"] + (p["a"] - mean) * (p["c"] - mean)).alias("product"),
            (acc["runs"] + F.when((p["a"] > middle) != (p["c"] > middle), 1.0).otherwise(0.0)).alias("runs")))
        spread = sums["squares"] - n * mean * mean
        return let(followed, lambda f: body(F.when(spread <= 1e-9, 1.0).otherwise(f["product"] / spread), f["runs"], 2 * above * (n - above)))

    return let(total, tests)


def p_value(b: Column) -> Column:
    """How likely text of a token's length looks as random by all three tests, each for itself; for single tokens, without power below 64 characters."""
    n = b["n"]

    def largest(correlation: Column, runs: Column, mixed: Column) -> Column:
        deviation = F.sqrt(F.greatest(mixed * (mixed - n) / (n * n * (n - 1)), F.lit(0.0)))
        z = F.when(deviation <= 1e-9, F.sqrt(n)).otherwise(F.abs(runs - mixed / n - 1) / deviation)
        return F.greatest(b["uniform"], normal_cdf((F.abs(correlation) - TEXT_CORRELATION) * F.sqrt(n)), normal_cdf(z - TEXT_RUNS * F.sqrt(n)))

    return _compared(b, largest)


def score(b: Column) -> Column:
    """The three tests in one number: about 0 with deviation 1 on ordinary tokens of any length, far below on random ones."""
    n = b["n"]

    def of_length(place: int) -> Column:
        return F.coalesce(*[F.when(n >= row[0], F.lit(row[place])) for row in reversed(SCORES)], F.lit(SCORES[0][place]))

    def weighed(correlation: Column, runs: Column, mixed: Column) -> Column:
        total = b["excess"] * of_length(1) + correlation * F.sqrt(n) * of_length(2) + ((n + 1) / 2 - runs) / (F.sqrt(n - 1) / 2)
        return (total - of_length(3)) / of_length(4)

    return _compared(b, weighed)


def nulls(candidates: DataFrame) -> dict[int, tuple[float, float]]:
    """For each length class mean and deviation of the scores of ordinary tokens.

    ``candidates`` has ``class``, ``score`` and, to tell tokens apart, ``hash``. The
    scores are a mixture of ordinary tokens and of random ones, whose
    distribution is known; the ordinary part is fitted by expectation and
    maximisation on counts, so that secrets do not shift it. At most some
    hundred counts to a class reach the driver.
    """
    place = F.floor(F.greatest(F.least("score", F.lit(MOST_SCORE)), F.lit(-30.0)) * BINS).cast("int")
    counts = candidates.distinct().groupBy("class", place.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
    return {c: _fitted([((r["bin"] + 0.5) / BINS, r["n"]) for r in counts if r["class"] == c], *RANDOM[c]) for c in range(len(CLASSES))}


def _fitted(counts: list[tuple[float, int]], random_mean: float, random_sd: float) -> tuple[float, float]:
    """Mean and deviation of the ordinary part of counted scores."""
    (mean, sd), share, total = ORDINARY, 0.9, sum(n for _, n in counts)
    for _ in range(STEPS if counts else 0):
        held = []
        for x, n in counts:
            ordinary = share / sd * math.exp(-((x - mean) / sd) ** 2 / 2)
            other = (1 - share) / random_sd * math.exp(-((x - random_mean) / random_sd) ** 2 / 2)
            held.append((x, n * (ordinary / (ordinary + other) if ordinary + other else float(x > mean))))
        weight = sum(n for _, n in held)
        mean = (sum(x * n for x, n in held) + PRIOR * ORDINARY[0]) / (weight + PRIOR)
        spread = sum((x - mean) ** 2 * n for x, n in held) + PRIOR * (ORDINARY[1] ** 2 + (mean - ORDINARY[0]) ** 2)
        sd, share = max(LEAST_DEVIATION, math.sqrt(spread / (weight + PRIOR))), min(max(weight / total, 0.01), 0.99)
    return mean, sd


def length_class(length: Column) -> Column:
    return sum(F.when(length >= least, 1).otherwise(0) for least in CLASSES[1:])


def grid_cell(p: Column) -> Column:
    """Cells of equal ratio; a cell holds the p-values from ``exp(-(cell + 1) / GRID)``, left out, to ``exp(-cell / GRID)``."""
    return F.floor(-F.log(F.greatest(p, F.lit(1e-300))) * GRID + 1e-9).cast("int")


def cuts(candidates: DataFrame, rate: float = RATE) -> dict[int, int]:
    """For each length class the first grid cell that counts as discovered.

    ``candidates`` has ``class`` and ``cell``. A cell with its largest p-value
    ``t`` is discovered if ``t * m <= rate * (candidates at or below t)``, or if
    a cell of larger p-values is. At most ``CLASSES`` rows reach the driver.
    """
    counts = candidates.groupBy("class", "cell").agg(F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy("class").orderBy(F.col("cell").desc())  # at most 11,053 cells to a class
    held = counts.withColumn("below", F.sum("n").over(down)).withColumn("m", F.sum("n").over(Window.partitionBy("class")))
    good = held.where(F.exp(-F.col("cell") / GRID) * F.col("m") <= rate * F.col("below"))
    return {r["class"]: r["cell"] for r in good.groupBy("class").agg(F.min("cell").alias("cell")).collect()}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """Secrets of whole texts: ``id_col``, ``base`` and ``found``, a row for each input row.

    Both are arrays of ``start``, ``kind`` (place in ``NAMES``) and ``end`` in
    code points, by start and then kind; ``found`` has the base spans and the
    tokens that the battery adds, which overlap none of them; only tokens that
    overlap none are tested, and equal ones counted once. Null texts count
    as empty and hold nothing; rows that repeat an id, or have none, are scanned
    each for itself. Other columns are ignored; an empty table gives
    an empty result.
    """
    texts = docs.select(F.col(id_col).alias("id"), or_empty(text_col).alias("text"))
    spans = with_spans(texts, "text", [*BASE, CANDIDATE]).select("id", in_order(NAMES[:-1]).alias("base"), "token")
    spans = spans.withColumn("token", F.filter("token", lambda s: ~overlaps(s, F.col("base"))))
    tested = spans.withColumn("tests", F.transform("token", lambda s: battery(s["value"])))
    tested = tested.withColumn("token", F.zip_with("token", "tests", lambda s, b: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), length_class(b["n"]).alias("class"), score(b).alias("score"), F.xxhash64(s["value"]).alias("hash"))))
    tested = settle(tested.select("id", "base", "token"), "tokens")
    # Equal tokens count once, in the null and in the control: copies of one say nothing about others.
    candidates = settle(tested.select(F.explode("token").alias("t")).select("t.hash", "t.class", "t.score").distinct(), "candidates")
    ordinary = nulls(candidates)

    def cell(t: Column) -> Column:
        return grid_cell(F.coalesce(*[F.when(t["class"] == c, normal_cdf((t["score"] - mean) / sd)) for c, (mean, sd) in ordinary.items()]))

    cut = cuts(candidates.select("class", cell({"class": F.col("class"), "score": F.col("score")}).alias("cell")), rate)

    def discovered(t: Column) -> Column:
        return F.coalesce(*[F.when(t["class"] == c, cell(t) >= first) for c, first in sorted(cut.items())], F.lit(False))

    added = F.filter("token", discovered)
    extra = of_kind(added, len(NAMES) - 1)
    return tested.select(F.col("id").alias(id_col), "base", F.array_sort(F.concat("base", extra)).alias("found"))


def secret_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as text."""
    counts = {f"n_{name}": count_of(F.col("base"), i) for i, name in enumerate(NAMES[:-1])}
    return found.select(id_col, *[c.alias(n) for n, c in counts.items()],
                        F.sha2(joined(F.col("base"), NAMES).cast("binary"), 256).alias("base_sha256"), joined(F.col("found"), NAMES).alias("spans"))
