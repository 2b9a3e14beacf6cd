"""Payload and text functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Filler text of the fixed-size events.
FILLER = "abcdefghijklmnopqrstuvwxyz0123456789"


def json_value(value: Column) -> Column:
    """One value of any type as JSON text; NULL becomes ``null``."""
    wrapped = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)


def to_json_payload(values: Sequence[Column]) -> Column:
    """A single value as its JSON, several as a JSON array."""
    if len(values) == 1:
        return json_value(values[0])
    return F.concat(F.lit("["), F.concat_ws(",", *[json_value(v) for v in values]), F.lit("]"))


def render_fields(fields: Sequence[Column], names: Sequence[str] | None = None, sep: str = ", ", eq: str = " = ") -> Column:
    """``0 = a, 1 = b``, or with names and separators given ``VIN=a,Make=b``; NULL renders empty."""
    labels = names or [str(i) for i in range(len(fields))]
    parts = [
        F.concat(F.lit(label + eq), F.coalesce(field.cast("string"), F.lit("")))
        for label, field in zip(labels, fields, strict=True)
    ]
    return F.concat_ws(sep, *parts)


def url_encode(text: Column) -> Column:
    return F.url_encode(text)


def struct_to_json(value: Column) -> Column:
    return F.to_json(value)


def struct_from_json(text: Column, schema: T.StructType | str) -> Column:
    return F.from_json(text, schema)


def fixed_payload(size: int, filler: str = FILLER) -> Column:
    return F.substring(F.repeat(F.lit(filler), -(-size // len(filler))), 1, size)


def csv_fields(line: Column, names: Sequence[str], sep: str = ",") -> list[Column]:
    """Positional fields of a delimited line; absent trailing fields are NULL."""
    fields = F.split(line, f"\\Q{sep}\\E", -1)
    return [F.get(fields, F.lit(i)).alias(name) for i, name in enumerate(names)]


def words(text: Column) -> Column:
    """Array of the pieces between single spaces; consecutive spaces give empty pieces."""
    return F.split(text, " ", -1)
