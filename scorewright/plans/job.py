"""The scoring job: one configuration, four sections.

* ``kafka`` (or ``source``): where the messages come from;
* ``schema``: what to extract and derive (see :mod:`..operators.parse`);
* ``model``: how to score (see :mod:`..operators.score`);
* ``sink``: where the scored rows go (see :mod:`..streaming.sinks`).

``build`` returns the scored streaming (or batch) DataFrame; ``start``
attaches the sink; ``main`` is the command-line entry
(``python -m scorewright.plans.job --config job.yaml``).  Errors
propagate: a failing query ends the process with a non-zero status.

A ``source`` section reads files instead of a topic::

    source: {format: parquet, path: "/data/events/*.parquet",
             max_files_per_trigger: 8, encode: [event_id, value, props]}

``encode`` turns table rows into JSON messages first, as a producer would.

The ``schema`` section may also be the older flat form ``{column: type}``
(double, string, integer, float; other names read as string), which parses
each message with one struct schema.
"""

from __future__ import annotations

import argparse
import logging
import os
import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..functions.messages import encode_messages
from ..operators.parse import parse_messages, parse_struct
from ..operators.score import score
from ..session import spread_scan
from ..sources.files import read_messages, stream_messages, stream_table
from ..sources.kafka import read_kafka
from ..streaming.sinks import write_batch, write_stream

log = logging.getLogger(__name__)

_ENV = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)\}")


def load_config(path: str, spark: SparkSession | None = None) -> dict:
    """Read a YAML job file; ``${NAME}`` in a value is replaced by the
    environment variable NAME (keeps secrets out of the file).

    A local file is read directly; with a session, any path Spark can read
    (``hdfs://``, ``s3a://``, ``dbfs:/`` ...) is read as one whole-text row.
    """
    import yaml

    if path.startswith("dbfs:/") and os.path.exists("/dbfs/" + path[len("dbfs:/"):]):
        path = "/dbfs/" + path[len("dbfs:/"):]  # the workspace's local mount
    if os.path.exists(path) or spark is None:
        with open(path, encoding="utf-8") as fh:
            text = fh.read()
    else:
        text = spark.read.text(path, wholetext=True).first()[0]
    raw = yaml.safe_load(text)
    if not isinstance(raw, dict):
        raise ValueError(f"{path}: configuration must be a mapping")
    return _expand(raw)


def _expand(node: Any) -> Any:
    if isinstance(node, dict):
        return {k: _expand(v) for k, v in node.items()}
    if isinstance(node, list):
        return [_expand(v) for v in node]
    if isinstance(node, str):
        def sub(m):
            if m.group(1) not in os.environ:
                raise KeyError(f"environment variable {m.group(1)} is not set")
            return os.environ[m.group(1)]

        return _ENV.sub(sub, node)
    return node


def read_source_batch(spark: SparkSession, config: Mapping) -> DataFrame:
    """The same source read once as a bounded batch (a backfill): message
    files or a table (encoded when ``encode`` is set), or the topic's
    retained records."""
    if "source" not in config:
        from ..sources.kafka import read_kafka_batch

        return read_kafka_batch(spark, config["kafka"])
    src = config["source"]
    fmt = src.get("format", "text")
    if src.get("encode") is not None:
        rows = spread_scan(spark.read.format(fmt).load(src["path"]))
        return encode_messages(rows, src["encode"] or rows.columns)
    return spread_scan(read_messages(spark, src["path"], fmt=fmt))


def run_batch(spark: SparkSession, config: Mapping, *, model: Any = None) -> None:
    """The job over a batch: source -> parse -> score -> batch sink (K8)."""
    scored = build(spark, config, raw=read_source_batch(spark, config), model=model)
    sink = dict(config["sink"])
    options = dict(sink.get("options", {}))
    options.setdefault("mode", "append")
    sink["options"] = options
    write_batch(scored, sink)


def read_source(spark: SparkSession, config: Mapping) -> DataFrame:
    """The raw message stream named by the configuration.

    ``partitions`` in the source section spreads each micro-batch over that
    many tasks (a round-robin shuffle), for sources that arrive as few large
    splits; a Kafka source should rather set ``min_partitions``.
    """
    if "source" not in config:
        return read_kafka(spark, config["kafka"])
    src = config["source"]
    fmt, n = src.get("format", "text"), src.get("partitions")
    rate = {k: src[k] for k in ("max_files_per_trigger", "max_bytes_per_trigger") if src.get(k)}

    def spread(rows: DataFrame) -> DataFrame:
        return rows.repartition(int(n)) if n else rows

    if src.get("encode") is None:
        return spread(stream_messages(spark, src["path"], fmt=fmt, **rate))
    # rows are dealt out before they are encoded: they are smaller
    rows = spread(stream_table(spark, src["path"], fmt=fmt, **rate))
    return encode_messages(rows, src["encode"] or rows.columns)


def build(spark: SparkSession, config: Mapping, *, raw: DataFrame | None = None, model: Any = None) -> DataFrame:
    """Source -> parse -> score.  ``raw`` replaces the configured source
    (any DataFrame with a ``value`` column, batch or stream)."""
    messages = raw if raw is not None else read_source(spark, config)
    schema = config["schema"]
    if schema and all(isinstance(v, str) for v in schema.values()):
        # the older flat form {column: type}: one struct schema per message
        parsed = parse_struct(messages, schema, passthrough=config.get("passthrough", ()))
    else:
        parsed = parse_messages(messages, schema, passthrough=config.get("passthrough", ()),
                                mode=config.get("parse_mode", "struct"), error_col=config.get("error_col"))
    if config.get("model"):
        return score(parsed, config["model"], model=model)
    return parsed


def start(spark: SparkSession, config: Mapping, *, model: Any = None, query_name: str | None = None):
    """Build the job and start its sink; returns the ``StreamingQuery``."""
    scored = build(spark, config, model=model)
    return write_stream(scored, config["sink"], query_name=query_name or config.get("name"))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="configuration-driven streaming scoring job")
    parser.add_argument("--config", required=True, help="YAML job file")
    parser.add_argument("--batch", action="store_true",
                        help="read the source once as a batch and write with the batch sink")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = SparkSession.builder.appName("scorewright-job").getOrCreate()
    try:
        config = load_config(args.config, spark)
    except Exception as exc:  # unreadable or malformed job file
        log.error("cannot load configuration %s: %s", args.config, exc)
        return 1
    if args.batch:
        run_batch(spark, config)
        return 0
    query = start(spark, config)
    log.info("query %s started", query.id)
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        query.stop()
    return 0


if __name__ == "__main__":  # pragma: no cover
    raise SystemExit(main())
