"""Claims in sentences: relation, subject, object, polarity, nearest number and unit, with spans."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NUMBER = re.compile(r"[-+]?\d+(?:\.\d+)?\s*(%|[a-zµ]{1,4}/[a-z]{1,4}|mg|kg|g|ml|h|days?)?", re.IGNORECASE)
NEGATIVE = re.compile(r"\b(?:not|no|without|never|neither|nor|nicht|kein|ne|pas|sin)\b", re.IGNORECASE)
NOT_ONLY = re.compile(r"\bnot only\b", re.IGNORECASE)
CLAUSE = re.compile(r"\s*(?:;|,?\s+(?:but|whereas|while|however)\s+)\s*", re.IGNORECASE)


def nearest(numbers: list[re.Match], start: int, end: int) -> re.Match | None:
    """The number with the least distance from end to start on either side; the first of equals."""
    return min(numbers, key=lambda m: min(abs(m.start() - end), abs(start - m.end())), default=None)


def claims_of(sentence: str, relations: Mapping[str, re.Pattern]) -> list[tuple]:
    """(clause, predicate, start, end, subject, object, negative, number, unit) of each relation, by clause."""
    out, at = [], 0
    for k, clause in enumerate(CLAUSE.split(sentence)):
        offset = sentence.index(clause, at)
        at = offset + len(clause)
        found = sorted(((m.start(), m.end(), name) for name, p in relations.items() for m in p.finditer(clause)))
        numbers = list(NUMBER.finditer(clause))
        for j, (start, end, name) in enumerate(found):
            if j and start < found[j - 1][1]:
                continue  # a relation inside another
            before = clause[found[j - 1][1] if j else 0 : start].strip(" ,.")
            after = clause[end : found[j + 1][0] if j + 1 < len(found) else len(clause)].strip(" ,.")
            around = NOT_ONLY.sub("", clause[max(0, start - 30) : end + 12])
            n = nearest(numbers, start, end)
            number = float(re.match(r"[-+]?\d+(?:\.\d+)?", n[0])[0]) if n else None
            out.append((k, name, offset + start, offset + end, before, after, bool(NEGATIVE.search(around)), number, n[1] if n else None))
    return out


def claims(sentences: DataFrame, keys: list[str], text_col: str, relations: Mapping[str, str]) -> DataFrame:
    """The claims of each sentence row, after its keys; null sentences have none."""
    made = "clause int, predicate string, start int, stop int, subject string, object string, negative boolean, number double, unit string"
    kinds = {f.name: f.dataType.simpleString() for f in sentences.schema}
    types = [pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.float64(), pa.string()]
    names = [x.split()[0] for x in made.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = {n: re.compile(p, re.IGNORECASE) for n, p in relations.items()}
        for batch in batches:
            rows = []
            for *key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows += [(*key, *c) for c in claims_of(text or "", compiled)]
            if rows:
                own = [batch.schema.field(k).type for k in range(len(keys))] + types
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), own, strict=True)], names=[*keys, *names])

    return sentences.select(*keys, F.col(text_col)).mapInArrow(read, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", " + made)
