"""Cleaning and typing of model replies as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StructType

from .text import col, strip_ws

# The code fence and the greedy array-or-object pattern.
FENCE = "```(?:json)?"
JSON_BODY = r"(?s)(\[.*\]|\{.*\})"


def clean_reply(c: Column | str) -> Column:
    """Remove code fences, then keep the outermost array or object if any."""
    text = strip_ws(F.regexp_replace(col(c), FENCE, ""))
    body = F.regexp_extract(text, JSON_BODY, 1)
    # regexp_extract gives '' for "no match".
    return F.when(body == "", text).otherwise(strip_ws(body))


def parse_rows(cleaned: Column, fields: StructType | str) -> Column:
    """Array of records; a single object counts as an array of one.

    NULL when the text is not JSON of that shape (scalars, lists of scalars).
    """
    inner = fields if isinstance(fields, str) else fields.simpleString()
    if not inner.startswith("struct<"):
        inner = f"struct<{inner}>"
    return F.from_json(cleaned, f"array<{inner}>")


def all_null(record: Column, names: list[str]) -> Column:
    empty = F.lit(True)
    for name in names:
        empty = empty & record.getField(name).isNull()
    return empty
