"""File sources.

* message files (JSON lines, text, parquet with a ``value`` column) as a
  batch or as a replayable stream that stands in for a topic;
* any table read as a stream of rows; ``maxFilesPerTrigger`` bounds each
  micro-batch by files, ``maxBytesPerTrigger`` by their size;
* CSV tables with a header;
* HTML or other text documents, one row per file.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_messages(spark: SparkSession, path: str, *, fmt: str = "text", value_col: str = "value") -> DataFrame:
    """Batch of messages: one JSON document per line (``text``/``json``
    lines) or a parquet/orc table holding ``value_col``."""
    if fmt in ("text", "json"):
        return spark.read.text(path).withColumnRenamed("value", value_col)
    return spark.read.format(fmt).load(path).select(value_col)


def admission(max_files: int | str | None, max_bytes: int | str | None) -> dict[str, str]:
    """The file source's limit for a micro-batch, by files or by bytes (``"512m"``
    works too).  One file is always admitted, however large."""
    if max_files and max_bytes:
        raise ValueError("set either max_files_per_trigger or max_bytes_per_trigger")
    if max_bytes:
        m = re.fullmatch(r"\s*(\d+)\s*([kmgt]?)b?\s*", str(max_bytes).lower())
        if not m or not int(m.group(1)):
            raise ValueError(f"max_bytes_per_trigger: {max_bytes!r} is not a size")
        return {"maxBytesPerTrigger": str(int(m.group(1)) << (10 * " kmgt".index(m.group(2) or " ")))}
    return {"maxFilesPerTrigger": str(int(max_files))} if max_files else {}


def stream_messages(spark: SparkSession, path: str, *, fmt: str = "text", max_files_per_trigger: int | None = None,
                    schema: StructType | None = None, max_bytes_per_trigger: int | str | None = None) -> DataFrame:
    """Stream of messages from files arriving in ``path`` (one file may be
    many messages); the streaming twin of :func:`read_messages`.  For
    parquet/orc message files pass ``schema`` when the folder may start
    empty (it is otherwise read from the files already there)."""
    reader = spark.readStream.options(**admission(max_files_per_trigger, max_bytes_per_trigger))
    if fmt in ("text", "json"):
        return reader.text(path)
    if schema is None:
        schema = spark.read.format(fmt).load(path).schema
    return reader.schema(schema).format(fmt).load(path)


def stream_table(spark: SparkSession, path: str, *, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None, schema: StructType | None = None,
                 options: Mapping[str, str] | None = None, max_bytes_per_trigger: int | str | None = None) -> DataFrame:
    """A table's rows as a stream (S5).  The schema is taken from the files
    (metadata only) unless given; pass it when the folder may start empty."""
    if schema is None:
        schema = spark.read.format(fmt).load(path).schema
    reader = spark.readStream.schema(schema).format(fmt)
    limits = admission(max_files_per_trigger, max_bytes_per_trigger)
    return reader.options(**limits, **dict(options or {})).load(path)


def read_csv_table(spark: SparkSession, path: str, *, schema: StructType | str | None = None,
                   infer_schema: bool = False, header: bool = True) -> DataFrame:
    """A CSV table with a header; a declared schema avoids a pass over
    the data (``infer_schema`` reads it twice)."""
    reader = spark.read.option("header", str(header).lower())
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def read_documents(spark: SparkSession, path: str, *, name_col: str = "path") -> DataFrame:
    """Whole text files, one row per file (``path``, ``html``)."""
    from pyspark.sql import functions as F

    df = spark.read.text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias(name_col), F.col("value").alias("html"))


def write_message_files(df: DataFrame, columns, path: str, *, mode: str = "errorifexists") -> str:
    """The producer side of a file-based topic: ``df``'s rows as JSON
    messages, one per line, one file per partition (so a stream with
    ``maxFilesPerTrigger`` replays them batch by batch)."""
    from ..functions.messages import encode_messages

    encode_messages(df, list(columns), as_binary=False).write.mode(mode).text(path)
    return path
