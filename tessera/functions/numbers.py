"""Column functions on numbers: estimates, canonical forms, tolerances, vectors and tariffs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEAST_TOLERANCE, WHOLE_TOLERANCE = 0.011, 0.5


def estimated_tokens(c: Column) -> Column:
    """A quarter of the UTF-8 bytes, rounded up."""
    return F.ceil(F.octet_length(c) / 4)


def canonical_number(c: Column) -> Column:
    """A decimal as text without trailing zeros."""
    text = c.cast("decimal(30,10)").cast("string")
    return F.regexp_replace(F.regexp_replace(text, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")


def decimals(text: Column) -> Column:
    return F.length(F.regexp_extract(text, r"\.([0-9]+)$", 1))


def rounding_tolerance(text: Column) -> Column:
    """How far a number may lie from one reported with these decimals."""
    d = decimals(text)
    return F.when(d == 0, F.lit(WHOLE_TOLERANCE)).otherwise(F.greatest(F.lit(LEAST_TOLERANCE), F.lit(0.5) * F.pow(F.lit(10.0), -d)))


def overlap_coefficient(a: Column, b: Column) -> Column:
    """Shared members over the size of the smaller set; 0 if one is empty."""
    smaller = F.least(F.size(a), F.size(b))
    return F.when(smaller > 0, F.size(F.array_intersect(a, b)) / smaller).otherwise(0.0)


def share(part: Column, whole: Column) -> Column:
    """A ratio that is 0 for an empty whole."""
    return F.when(whole != 0, part / whole).otherwise(0.0)


def price(regular: Column, cached: Column, output: Column, in_rate: float, cached_rate: float, out_rate: float) -> Column:
    """Cost by a tariff per million; what is cached is taken off the regular amount, which never falls below 0."""
    paid = F.greatest(F.coalesce(regular, F.lit(0)) - F.coalesce(cached, F.lit(0)), F.lit(0))
    return (paid * in_rate + F.coalesce(cached, F.lit(0)) * cached_rate + F.coalesce(output, F.lit(0)) * out_rate) / 1e6


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
