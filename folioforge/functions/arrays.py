"""Functions over arrays: ordered deduplication by key, overlaps, ordered unions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text


def dedupe(values: Column, key: Callable[[Column], Column], emit: Callable[[Column], Column] | None = None) -> Column:
    """First value of each non-empty key, in order; values are emitted through `emit`."""
    pairs = F.transform(values, lambda v: F.struct(key(v).alias("k"), (emit(v) if emit else v).alias("v")))
    pairs = F.filter(pairs, lambda p: p["k"] != "")

    def first(own: Column) -> Column:
        return text.let(F.transform(own, lambda p: p["k"]), lambda keys: F.filter(own, lambda p, i: F.array_position(keys, p["k"]) == i + 1))

    return F.transform(text.let(pairs, first), lambda p: p["v"])


def dedupe_lines(values: Column) -> Column:
    """By line-preserving normal form in lower case; emits the normal form."""
    return dedupe(values, lambda v: F.lower(text.normalize_lines(v)), text.normalize_lines)


def dedupe_flat(values: Column) -> Column:
    return dedupe(values, lambda v: F.lower(text.normalize_flat(v)), text.normalize_flat)


def dedupe_for_match(values: Column) -> Column:
    return dedupe(values, text.normalize_for_match)


def dedupe_trimmed(values: Column) -> Column:
    """By trimmed lower case; emits values as they are."""
    return dedupe(values, lambda v: text.strip(F.lower(v)))


def overlap(left: Column, right: Column) -> Column:
    """Shared distinct tokens over those of the smaller side; 0 if either is empty."""

    def share(s: Column) -> Column:
        small = F.least(F.size(s["a"]), F.size(s["b"]))
        return F.when(small == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(s["a"], s["b"])) / F.greatest(F.lit(1), small))

    return text.let(F.struct(F.array_distinct(left).alias("a"), F.array_distinct(right).alias("b")), share)


def date_overlap(left: Column, right: Column) -> Column:
    """1 for equal date ranges, else the overlap of their tokens; 0 if either is empty."""

    def share(s: Column) -> Column:
        a, b = s["a"], s["b"]
        return F.when((a == "") | (b == ""), F.lit(0.0)).when(a == b, F.lit(1.0)).otherwise(overlap(text.identity_tokens(a), text.identity_tokens(b)))

    return text.let(F.struct(text.normalize_date_range(left).alias("a"), text.normalize_date_range(right).alias("b")), share)
