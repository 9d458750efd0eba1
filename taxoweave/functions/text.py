"""Column expressions over text: all built-in, all JVM-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from taxoweave import fixed_values as fv

# Unicode white space plus the four separators that Java's class leaves out.
_WHITE = r"(?U)[\s\x1c-\x1f]+"
# A run of two or more characters; single-character runs carry no signal.
_TOKEN = "[a-z0-9&]{2,}"


def squeeze(text: Column) -> Column:
    """Strip, and turn every run of white space into one space."""
    return F.trim(F.regexp_replace(text, _WHITE, " "))


def strip(text: Column) -> Column:
    """Strip white space at both ends, Unicode spaces included."""
    return F.regexp_replace(text, rf"^{_WHITE}|{_WHITE}$", "")


def present(text: Column) -> Column:
    """True when the text is neither null nor empty."""
    return F.coalesce(text, F.lit("")) != ""


def is_error(api_error: Column) -> Column:
    """True when the error text says something; blank, 'nan' and 'None' do not."""
    return ~F.trim(F.coalesce(api_error, F.lit(""))).isin("", "nan", "None")


def tokens(text: Column, stopwords: Sequence[str] = fv.STOPWORDS) -> Column:
    """Tokens in order of appearance, repeats kept."""
    found = F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(0))
    stop = F.array(*[F.lit(w) for w in stopwords]).cast("array<string>")
    return F.filter(found, lambda token: ~F.array_contains(stop, token))


def token_set(text: Column, stopwords: Sequence[str] = fv.STOPWORDS) -> Column:
    """Distinct tokens, in order of first appearance."""
    found = F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(0))
    stop = F.array(*[F.lit(w) for w in stopwords]).cast("array<string>")
    return F.array_except(found, stop)


def join_text(*parts: Column) -> Column:
    """Description and vendor as one text; null parts count as empty."""
    return F.trim(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts]))


def cache_key(description: Column, vendor: Column, version: str = fv.KEY_VERSION) -> Column:
    """Versioned identity of a transaction in the result store; a null part reads as the null text."""
    parts = [F.coalesce(strip(c), F.lit(fv.NULL_TEXT)) for c in (description, vendor)]
    return F.concat_ws(fv.KEY_SEPARATOR, F.lit(version), *parts)


def path_of(l1: Column, l2: Column, l3: Column, l4: Column) -> Column:
    """The full path of four levels; null when the first or last is missing."""
    levels = [l1, F.coalesce(l2, F.lit("None")), F.coalesce(l3, F.lit("None")), l4]
    return F.when(present(l1) & present(l4), F.concat_ws(fv.PATH_SEPARATOR, *levels))


def same_text(left: Column, right: Column) -> Column:
    """Equality after strip and lower; two nulls are equal."""
    return F.lower(strip(left)).eqNullSafe(F.lower(strip(right)))


def with_note(path: Column, note: Column) -> Column:
    """A candidate path, with its boundary note when there is one."""
    note = strip(F.coalesce(note, F.lit("")))
    return F.when(note != "", F.concat(path, F.lit("  [Boundary note: "), note, F.lit("]"))).otherwise(path)


def contains_any(text: Column, terms: Sequence[str]) -> Column:
    """True when any of a few fixed terms occurs in the text."""
    hit = F.lit(False)
    for term in terms:
        hit = hit | F.contains(text, F.lit(term))
    return hit


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part`` as a percentage of ``whole``; 0.0 when ``whole`` is 0."""
    return F.round(F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0)), digits)


def grams(text: Column, size: int) -> Column:
    """Every substring of the given length, in one pass over the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))
