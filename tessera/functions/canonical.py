"""Canonical forms of stated values, by field, with the rule that made them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import collapsed

# Dashes and micro signs that are written several ways.
DASHES, MICRO = "‐‑‒–—−", "µ"


def plain_marks(c: Column) -> Column:
    """One dash, one micro sign, no space around slashes and colons, single spaces, lower case."""
    one = F.regexp_replace(F.regexp_replace(F.lower(c), f"[{DASHES}]", "-"), MICRO, "μ")
    return collapsed(F.regexp_replace(one, r"\s*([/:])\s*", "$1"))


def with_aliases(c: Column, aliases: Mapping[str, str]) -> Column:
    """Whole words replaced by their canonical names."""
    out = c
    for name, other in aliases.items():
        out = F.regexp_replace(out, rf"(^|[^a-z0-9]){name}($|[^a-z0-9])", rf"$1{other}$2")
    return out


def without_zeros(c: Column) -> Column:
    """Decimals in a text without trailing zeros."""
    return F.regexp_replace(F.regexp_replace(c, r"(\.[0-9]*?[1-9])0+($|[^0-9])", "$1$2"), r"\.0+($|[^0-9])", "$1")


def canonical_fact(field: Column, raw: Column, aliases: Mapping[str, str]) -> tuple[Column, Column]:
    """The canonical value and the name of its rule: ratios lose spaces, units get one name, other text is normalised."""
    ratio = field.isin("ratio", "molar_ratio")
    unit = field.endswith("_unit") | (field == "unit")
    plain = plain_marks(raw)
    value = F.when(ratio, without_zeros(F.regexp_replace(plain, r"\s+", ""))).when(unit, with_aliases(plain, aliases)).otherwise(without_zeros(plain))
    return value, F.when(ratio, "ratio").when(unit, "unit").otherwise("text")
