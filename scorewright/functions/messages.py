"""Message encoding: one row becomes one flat JSON object (UTF-8 bytes).

This is the producer side of the scoring job: the load generators of the
original application serialised each table row with ``json.dumps`` and sent
it to a topic.  Here the same message is built by the JVM with ``to_json``,
so any table can feed the parser, a file stream or a Kafka sink.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Timestamps keep all six fraction digits (the writer's default keeps three).
JSON_WRITE_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def message_text(columns: Sequence[str | Column]) -> Column:
    """JSON text of the given columns, keyed by column name."""
    return F.to_json(F.struct(*columns), JSON_WRITE_OPTIONS)


def encode_messages(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    key: str | None = None,
    value_col: str = "value",
    as_binary: bool = True,
) -> DataFrame:
    """Encode rows as messages with a ``value`` column (and optional ``key``).

    The result has the shape of a Kafka record batch: ``value`` holds the
    JSON bytes, ``key`` (when given) the key column as bytes.  Map-only: no
    shuffle, one output row per input row.
    """
    cols = list(columns) if columns is not None else df.columns
    text = message_text(cols)
    value = text.cast("binary") if as_binary else text
    out = [value.alias(value_col)]
    if key is not None:
        k = F.col(key).cast("string")
        out.insert(0, (k.cast("binary") if as_binary else k).alias("key"))
    return df.select(*out)
