"""Positions of pattern matches as columns, shared by the scans for secrets and personal data.

Spark has no function for match positions. The matches and the gaps between
them, each from one pass, give every position by adding up lengths.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, of_text

#: Matches that one step of adding up takes; a text's steps are added up again.
STEP = 256
#: Characters of context beside a match.
CONTEXT = 64


@dataclass(frozen=True)
class Kind:
    """A kind of span: its pattern, a text that every match holds, and what a match must fulfil."""

    name: str
    pattern: str
    hint: str | None = None
    keep: Callable[[Column], Column] | None = None

    def kept(self, spans: Column) -> Column:
        """The spans that fulfil the condition."""
        return F.filter(spans, lambda s: self.keep(s["value"])) if self.keep else spans


def _positions(matches: Column, gaps: Column) -> Column:
    """``value``, ``start``, ``end``, ``left`` and ``right`` (context) of each match, in code points, end exclusive."""
    def before(i: Column) -> Column:
        """The text before a match, over the match before it where that is close."""
        further = F.concat(F.right(F.get(gaps, i - 1), F.lit(CONTEXT)), F.right(F.get(matches, i - 1), F.lit(CONTEXT)))
        return F.right(F.concat(F.coalesce(further, F.lit("")), F.right(F.get(gaps, i), F.lit(CONTEXT))), F.lit(CONTEXT))

    def behind(i: Column) -> Column:
        further = F.concat(F.left(F.get(matches, i + 1), F.lit(CONTEXT)), F.left(F.get(gaps, i + 2), F.lit(CONTEXT)))
        return F.left(F.concat(F.left(F.get(gaps, i + 1), F.lit(CONTEXT)), F.coalesce(further, F.lit(""))), F.lit(CONTEXT))

    items = F.transform(matches, lambda m, i: F.struct(
        m.alias("value"), F.char_length(F.get(gaps, i)).alias("gap"), F.char_length(m).alias("length"),
        before(i).alias("left"), behind(i).alias("right")))

    def summed(items: Column) -> Column:
        steps = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / STEP).cast("int")), lambda s: F.slice(items, s * STEP + 1, F.lit(STEP)))

        def placed(steps: Column) -> Column:
            sizes = F.transform(steps, lambda part: F.aggregate(part, F.lit(0), lambda acc, x: acc + x["gap"] + x["length"]))
            begins = F.aggregate(sizes, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))

            def step(acc: Column, x: Column) -> Column:
                start = acc["at"] + x["gap"]
                end = start + x["length"]
                return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
                    x["value"].alias("value"), start.alias("start"), end.alias("end"), x["left"].alias("left"), x["right"].alias("right")))).alias("out"))

            empty = F.array().cast("array<struct<value:string,start:int,end:int,left:string,right:string>>")
            return let(begins, lambda b: F.flatten(F.transform(steps, lambda part, k: F.aggregate(
                part, F.struct(F.get(b, k).alias("at"), empty.alias("out")), step, lambda acc: acc["out"]))))

        return let(steps, placed)

    return let(items, summed)


def with_spans(df: DataFrame, text: str, kinds: list[Kind]) -> DataFrame:
    """Add for each kind a column of its name: the spans of its matches that are kept, null where there is none."""
    found = {k.name: of_text(F.col(text), k.pattern) for k in kinds}
    df = df.withColumns({f"__m_{k.name}": F.when(F.contains(F.col(text), F.lit(k.hint)), found[k.name]) if k.hint else found[k.name] for k in kinds})
    df = df.withColumns({f"__g_{k.name}": F.when(F.size(f"__m_{k.name}") > 0, F.split(text, k.pattern, -1)) for k in kinds})
    spans = {}
    for k in kinds:
        placed = _positions(F.col(f"__m_{k.name}"), F.col(f"__g_{k.name}"))
        spans[k.name] = F.when(F.size(f"__m_{k.name}") > 0, k.kept(placed))
    return df.withColumns(spans).drop(*[f"__{x}_{k.name}" for x in "mg" for k in kinds])


def of_kind(spans: Column, kind: int) -> Column:
    """Spans as ``start``, ``kind``, ``end``; null is none."""
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return F.coalesce(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"))), none)


def in_order(names: list[str]) -> Column:
    """The spans of the named columns as ``start``, ``kind`` (place of the name), ``end``, by start and then kind."""
    return F.array_sort(F.concat(*[of_kind(F.col(name), i) for i, name in enumerate(names)]))


def count_of(spans: Column, kind: int) -> Column:
    """Number of the spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def joined(spans: Column, names: list[str]) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    name = F.array(*[F.lit(n) for n in names])
    return F.array_join(F.transform(spans, lambda s: F.concat(
        F.get(name, s["kind"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def overlaps(span: Column, spans: Column) -> Column:
    """Whether a span shares a character with any of the others."""
    return F.exists(spans, lambda s: (s["start"] < span["end"]) & (span["start"] < s["end"]))


def normal_cdf(x: Column) -> Column:
    """The standard normal distribution function: a polynomial near 0, a continued fraction in the tails."""
    z = F.abs(x)
    density = F.exp(-z * z / 2) / 2.5066282746310002
    t = 1 / (1 + 0.2316419 * z)
    near = density * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    far = density / (z + 1 / (z + 2 / (z + 3 / (z + 4 / (z + 0.65)))))
    tail = F.when(z < 3, near).otherwise(far)
    return F.when(x < 0, tail).otherwise(1 - tail)
