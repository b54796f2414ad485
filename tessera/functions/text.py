"""Column functions on text: identifiers, canonical forms, tokens, sentences, numbers and classifiers."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The prefixes of a DOI, stripped in this order.
DOI_PREFIXES = ("https://doi.org/", "http://doi.org/", "doi:")
# What counts as no value.
PLACEHOLDERS = ("", "na", "n/a", "none", "null", "unknown", "missing", "not_reported", "not_available", "unspecified")
# Words that say nothing about what a question is about.
STOP_WORDS = ("a", "an", "and", "are", "as", "at", "by", "for", "from", "in", "is", "of", "on", "or", "that", "the", "to", "was", "were", "with")
# The function words of related sentences, and those left out when an outcome is looked for.
CONTEXT_STOP_WORDS = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "into", "is", "it", "of", "on", "or", "that", "the", "their", "these", "this", "to", "was", "were", "with")
OUTCOME_STOP_WORDS = ("the", "and", "of", "in", "to", "a", "an", "was", "were", "with", "from", "for", "after", "outcome", "cells", "cell", "reported")


def blank_to_null(c: Column) -> Column:
    return F.when(F.length(c) > 0, c)


def collapsed(c: Column) -> Column:
    """White space runs as one space, trimmed."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def normalize_doi(c: Column) -> Column:
    """Lower case without URL or scheme prefix; null for nothing."""
    out = F.lower(F.trim(c))
    for prefix in DOI_PREFIXES:
        out = F.when(out.startswith(prefix), F.substring(out, len(prefix) + 1, 1 << 30)).otherwise(out)
    return blank_to_null(F.trim(out))


def normalize_pmcid(c: Column) -> Column:
    """Upper case; bare digits get their prefix."""
    out = F.upper(F.trim(c))
    return F.when(F.length(c) > 0, F.when(out.rlike("^[0-9]+$"), F.concat(F.lit("PMC"), out)).otherwise(out))


def unicode_form(c: Column, form: str, casefold: bool = False) -> Column:
    """Compatibility forms and case folding, which Spark lacks; an Arrow UDF."""

    @F.pandas_udf("string")
    def convert(values: pd.Series) -> pd.Series:
        made = values.map(lambda x: None if x is None else unicodedata.normalize(form, x))
        return made.map(lambda x: None if x is None else x.casefold()) if casefold else made

    return convert(c)


def normalize_title(c: Column) -> Column:
    """Decomposed, lower case, punctuation and marks as spaces."""
    words = F.regexp_replace(F.lower(unicode_form(c, "NFKD")), r"[^\p{L}\p{N}_\s]", " ")
    return blank_to_null(collapsed(words))


def normalize_text(c: Column) -> Column:
    return collapsed(unicode_form(c, "NFKC", casefold=True))


def alnum_tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit("([a-z0-9]+)"), 1)


def token_set(c: Column, stop_words: tuple[str, ...] = STOP_WORDS) -> Column:
    """Distinct tokens without stop words, a plural s taken off words of four letters and more."""
    kept = F.filter(alnum_tokens(c), lambda x: ~x.isin(*stop_words))
    return F.array_distinct(F.transform(kept, lambda x: F.when((F.length(x) >= 4) & x.endswith("s") & ~x.endswith("ss"), F.substring(x, F.lit(1), F.length(x) - 1)).otherwise(x)))


def sentences(c: Column) -> Column:
    """Sentences of the collapsed text, cut after . ! or ? and a space."""
    cut = F.regexp_replace(collapsed(c), r"([.!?])\s+", "$1\u0001")
    return F.filter(F.transform(F.split(cut, "\u0001"), lambda x: F.trim(x)), lambda x: F.length(x) > 0)


def content_terms(c: Column) -> Column:
    """Words of four letters and more that are no stop words, in order."""
    return F.filter(F.regexp_extract_all(F.lower(c), F.lit("([a-z]+)"), 1), lambda x: (F.length(x) >= 4) & ~x.isin(*CONTEXT_STOP_WORDS))


def bigrams(terms: Column) -> Column:
    firsts = F.slice(terms, F.lit(1), F.greatest(F.size(terms) - 1, F.lit(0)))
    return F.zip_with(firsts, F.slice(terms, F.lit(2), F.greatest(F.size(terms) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))


def sentence_pairs(sentences: Column) -> Column:
    """Each sentence but the last with its terms, the sentence that follows and that one's terms."""
    each = F.transform(sentences, lambda x: F.struct(x.alias("x"), content_terms(x).alias("terms")))
    firsts = F.greatest(F.size(sentences) - 1, F.lit(0))
    paired = lambda rows: F.zip_with(
        F.slice(rows, F.lit(1), firsts), F.slice(rows, F.lit(2), firsts), lambda a, b: F.struct(a["x"].alias("sentence"), b["x"].alias("following"), a["terms"].alias("terms"), b["terms"].alias("following_terms"))
    )
    # A lambda's argument is computed once.
    return F.flatten(F.transform(F.array(each), paired))


def related(first: Column, second: Column, first_terms: Column | None = None, second_terms: Column | None = None) -> Column:
    """Whether neighbouring sentences belong together: anaphora, an open end, a shared term pair, or half the terms shared."""
    a = content_terms(first) if first_terms is None else first_terms
    b = content_terms(second) if second_terms is None else second_terms
    shared = F.size(F.array_intersect(a, b))
    smaller = F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    open_end = F.rtrim(first).rlike("[:;]$") | F.lower(second).rlike("^(this|these|those|they|it|such)( |$)")
    return open_end | F.coalesce(F.arrays_overlap(bigrams(a), bigrams(b)), F.lit(False)) | ((shared >= 2) & (2 * shared >= smaller))


def section_parts(c: Column, separator: str = ">") -> tuple[Column, Column]:
    """Head and rest of a section path; ``Unknown`` and null for an empty one."""
    parts = F.filter(F.transform(F.split(c, separator), lambda x: F.trim(x)), lambda x: F.length(x) > 0)
    rest = F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), f" {separator} ")
    return F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit("Unknown")), blank_to_null(rest)


def has_value(c: Column) -> Column:
    """Whether a text says something: not null and no placeholder, whatever its case and spacing."""
    return c.isNotNull() & ~F.regexp_replace(F.lower(F.trim(c)), r"\s+", "_").isin(*PLACEHOLDERS)


def first_number(c: Column) -> Column:
    return F.regexp_extract(c, r"([-+]?[0-9]+(?:\.[0-9]+)?)", 1).try_cast("double")


def ratio_parts(c: Column) -> Column:
    """The first ratio of three or more numbers, without spaces; null if none."""
    found = F.regexp_extract(c, r"([0-9]+(?:\.[0-9]+)?(?:\s*:\s*[0-9]+(?:\.[0-9]+)?){2,})", 1)
    return blank_to_null(F.regexp_replace(found, r"\s+", ""))


def time_unit(c: Column) -> Column:
    """Lower case without any trailing s."""
    return F.regexp_replace(F.lower(F.trim(c)), "s+$", "")


def first_match(c: Column, rules: Mapping[str, str], otherwise: str = "other") -> Column:
    """The name of the first rule (a pattern, any case) that matches."""
    out = F.lit(otherwise)
    for name, pattern in reversed(rules.items()):
        out = F.when(c.rlike(f"(?i){pattern}"), F.lit(name)).otherwise(out)
    return out


def only_match(c: Column, rules: Mapping[str, str], otherwise: str = "other") -> Column:
    """The name of the rule that matches, if it is the only one."""
    hits = matches(c, rules)
    return F.when(F.size(hits) == 1, hits[0]).otherwise(otherwise)


def matches(c: Column, rules: Mapping[str, str]) -> Column:
    """Names of all rules that match, in their order."""
    return F.array_compact(F.array(*(F.when(c.rlike(f"(?i){p}"), F.lit(n)) for n, p in rules.items())))


def weighted(signals: Mapping[str, tuple[Column, int]]) -> tuple[Column, Column]:
    """Sum of the weights of the signals that hold, and their names."""
    score = sum((F.when(F.coalesce(c, F.lit(False)), w).otherwise(0) for c, w in signals.values()), F.lit(0))
    return score, F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, (c, _) in signals.items())))


def expanded(question: Column, additions: Mapping[str, str]) -> Column:
    """A question with the expansions of the triggers that it contains."""
    parts = [F.when(F.lower(question).contains(t), F.lit(x)) for t, x in additions.items()]
    return F.concat_ws(" ", question, *parts)


def display(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("NA"))


def digest(*columns: Column) -> Column:
    """SHA-256 over columns, with nulls told from empty texts and no way to run fields together."""
    apart = lambda c: F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
    parts = [F.coalesce(F.concat(F.lit("="), apart(c.cast("string"))), F.lit("-")) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def url_host(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1))


def url_path(c: Column) -> Column:
    return F.regexp_extract(c, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def url_file(c: Column) -> Column:
    return F.regexp_extract(url_path(c), r"([^/]*)$", 1)
