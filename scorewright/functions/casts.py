"""ANSI-safe casts with the lenient semantics of a non-ANSI ``cast``.

Spark 4 runs with ANSI mode on, where ``cast("abc" as double)`` fails the
whole query.  A message stream must never die on one bad field, so every
declared type goes through ``try_cast``: unparsable text becomes null.

Integral targets get one extra rule: the non-ANSI string-to-integer cast
truncates a decimal fraction (``"149.62"`` as int is 149).  ``try_cast``
returns null there, so a second attempt casts the integer part of a plain
decimal literal.  Exponents (``"1e3"``) stay null, as before.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
)

_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)

# A plain decimal literal, optionally signed, with a fraction to drop.
_DECIMAL_LITERAL = r"^([+-]?[0-9]+)\.[0-9]*$"


def parse_type(type_name: str | DataType) -> DataType:
    """Resolve a type name as ``Column.cast`` accepts it (``double``,
    ``decimal(10,2)``, ``timestamp_ntz`` ...) to a ``DataType``."""
    if isinstance(type_name, DataType):
        return type_name
    from pyspark.sql.types import _parse_datatype_string

    try:
        return _parse_datatype_string(type_name)
    except Exception as exc:  # pragma: no cover - message only
        raise ValueError(f"unknown type name {type_name!r}") from exc


def lenient_cast(col: Column, type_name: str | DataType, source: DataType | None = None) -> Column:
    """Cast ``col`` to ``type_name``; text that does not parse becomes null.

    ``source`` is the type of ``col`` when known: the decimal-fraction rule
    only applies to text, so other sources get a plain ``try_cast``.
    ``col`` appears up to three times in the result, so pass a column
    reference, not an expensive expression.
    """
    target = parse_type(type_name)
    if isinstance(target, StringType):
        return col.cast(StringType())
    direct = col.try_cast(target)
    if source is not None and not isinstance(source, StringType):
        return direct
    if isinstance(target, _INTEGRAL):
        text = F.trim(col.cast(StringType()))
        whole = F.regexp_extract(text, _DECIMAL_LITERAL, 1)
        truncated = F.when(whole != "", whole.try_cast(target))
        return F.coalesce(direct, truncated)
    return direct
