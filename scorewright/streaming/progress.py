"""Batch telemetry of streaming queries.

``ProgressLog`` appends every progress report of a query to a table in the
shared folder, so telemetry covers the whole run however many batches it has
(Spark itself keeps only the latest reports).  ``progress_frame`` turns
reports into a table with the columns of the original telemetry file
(``Timestamp``, ``Batch_Duration_ms``, ``Input_Rows``) plus the rates and the
per-operation durations.  ``summarize`` gives mean, min, max, exact
percentiles and totals of any numeric columns.
"""

from __future__ import annotations

import hashlib
import json
import threading
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import (
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from ..functions.naming import free_prefix
from ..operators.quantiles import exact_percentiles, percentile_name, sketch_of
from ..session import shared_dir, written_table

PROGRESS_SCHEMA = StructType([
    StructField("query_id", StringType()),
    StructField("run_id", StringType()),
    StructField("name", StringType()),
    StructField("batch_id", LongType()),
    StructField("reported_at", StringType()),
    StructField("num_input_rows", LongType()),
    StructField("input_rows_per_second", DoubleType()),
    StructField("processed_rows_per_second", DoubleType()),
    StructField("duration_ms", MapType(StringType(), LongType())),
])


def _as_dict(p) -> dict:
    if isinstance(p, dict):
        return p
    if hasattr(p, "json"):
        return json.loads(p.json)
    return json.loads(str(p))


def _row(p: dict) -> tuple:
    def num(key):
        v = p.get(key)
        return None if v is None else float(v)

    return (
        str(p.get("id")),
        str(p.get("runId")),
        p.get("name"),
        int(p.get("batchId", -1)),
        p.get("timestamp"),
        int(p.get("numInputRows", 0)),
        num("inputRowsPerSecond"),
        num("processedRowsPerSecond"),
        {k: int(v) for k, v in (p.get("durationMs") or {}).items()},
    )


def progress_frame(spark: SparkSession, progress: DataFrame | Iterable) -> DataFrame:
    """Telemetry rows from the table of a :class:`ProgressLog`, or from a
    few reports at hand."""
    df = progress if isinstance(progress, DataFrame) else spark.createDataFrame(
        [_row(_as_dict(p)) for p in progress], PROGRESS_SCHEMA)
    return df.select(
        "*",
        F.to_timestamp("reported_at").alias("Timestamp"),
        F.col("duration_ms")["triggerExecution"].cast("double").alias("Batch_Duration_ms"),
        F.col("num_input_rows").cast("double").alias("Input_Rows"),
    ).drop("reported_at")


def operation_means_from_progress(progress: DataFrame, *, decimals: int = 2) -> DataFrame:
    """A7 from live telemetry: mean duration per streaming operation
    (``addBatch``, ``getBatch``, ``queryPlanning``, ``walCommit``, ...)
    over the progress rows, rounded like the chart-based
    :func:`..operators.timeline.operation_means`."""
    ops = progress.select(F.explode("duration_ms").alias("operation", "ms"))
    return ops.groupBy("operation").agg(F.round(F.avg(F.col("ms").cast("double")), decimals).alias("mean_ms"))


REPORT_KEY = ["query_id", "run_id", "batch_id"]


class ProgressLog(StreamingQueryListener):
    """A listener that writes every report of every query of the session to
    a table, one JSON line each, after ``reports_per_file`` reports and when a
    query ends.  Reports are keyed by query, run and batch (a later report of
    a batch replaces an earlier one) and are held until their write has
    succeeded; a file is named by its content, so writing it again adds
    nothing.  Memory holds the reports not yet written and per query the
    number of rows seen so far."""

    def __init__(self, spark: SparkSession, path: str | None = None, reports_per_file: int = 500):
        super().__init__()
        self.spark, self.path, self.reports_per_file = spark, path or shared_dir(spark, "telemetry"), reports_per_file
        self._changed, self._writing = threading.Condition(), threading.Lock()
        self._pending: dict[tuple, str] = {}
        self.failure: Exception | None = None  # of the last write, if it failed
        self._rows: dict[str, int] = {}
        self._ended: set[str] = set()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_):
        self.spark.streams.removeListener(self)
        self._flush()

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        report = _as_dict(event.progress)
        row = dict(zip(PROGRESS_SCHEMA.fieldNames(), _row(report)))
        with self._changed:
            self._pending[tuple(row[k] for k in REPORT_KEY)] = json.dumps(row)
            self._rows[row["query_id"]] = self._rows.get(row["query_id"], 0) + row["num_input_rows"]
            full = len(self._pending) >= self.reports_per_file
            self._changed.notify_all()
        if full:
            self._try_flush()

    def onQueryTerminated(self, event):
        try:
            self._try_flush()  # who waits for the end finds all reports written
        finally:
            with self._changed:
                self._ended.add(str(event.id))
                self._changed.notify_all()

    def _try_flush(self) -> None:
        """From a callback: a failed write is tried again with the next one
        and, at the latest, raised by :meth:`table` or at the end."""
        try:
            self._flush()
        except Exception as exc:
            self.failure = exc

    def _flush(self) -> None:
        with self._writing:
            with self._changed:
                lines = dict(self._pending)
            if not lines:
                return
            text = "\n".join(lines.values()) + "\n"
            self._write(f"{hashlib.sha256(text.encode('utf-8')).hexdigest()}.json", text)
            self.failure = None
            with self._changed:
                for key, line in lines.items():
                    if self._pending.get(key) == line:  # not replaced meanwhile
                        del self._pending[key]

    def _write(self, name: str, text: str) -> None:
        """A file below ``path``, complete under its name or not there."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        final, temporary = path(f"{self.path}/{name}"), path(f"{self.path}/_{name}")
        fs = final.getFileSystem(self.spark._jsc.hadoopConfiguration())
        out = fs.create(temporary, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        if not fs.rename(temporary, final) and not fs.exists(final):
            raise OSError(f"cannot write {final}")

    def rows(self, query) -> int:
        """Input rows of a query reported so far."""
        with self._changed:
            return self._rows.get(str(query.id), 0)

    def wait_for_rows(self, query, rows: int) -> None:
        """Until the reports of a running query add up to ``rows`` or it ends
        (its error is raised)."""
        with self._changed:
            while self._rows.get(str(query.id), 0) < rows and str(query.id) not in self._ended:
                self._changed.wait(1.0)
        if query.exception() is not None:
            raise RuntimeError(f"streaming query failed: {query.exception()}")

    def wait_for_end(self, query) -> None:
        """Until the last report of an ended query has arrived."""
        with self._changed:
            while str(query.id) not in self._ended:
                self._changed.wait(1.0)

    def table(self, query=None) -> DataFrame:
        """All reports so far (of one query) as a table."""
        self._flush()
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(hadoop)
        rows = self.spark.read.schema(PROGRESS_SCHEMA).json(self.path)
        # one report per query, run and batch: the last one
        latest = rows.groupBy(*REPORT_KEY).agg(F.max_by(F.struct(*PROGRESS_SCHEMA.fieldNames()), "reported_at").alias("r"))
        df = latest.select("r.*")
        return df if query is None else df.filter(F.col("query_id") == str(query.id))


def summarize(df: DataFrame, value_cols: Sequence[str], *, group_cols: Sequence[str] = (),
              percentiles: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """Per metric (and group): n, mean, min, max, percentiles, total; nulls
    and NaN are left out everywhere.

    Columns are unpivoted into ``metric``/``v`` rows, so one aggregation
    covers all of them; every aggregate merges partial results, so a group of
    any size is reduced map-side first.  Percentiles are the exact
    inverse-distribution values of
    :func:`..operators.quantiles.exact_percentiles`, named ``p50``, ``p99_9``.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v")) for c in value_cols])
    long = df.select(*group_cols, F.inline(cells)).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    keys = [*group_cols, "metric"]
    base = [F.count("v").alias("n"), F.avg("v").alias("mean"), F.min("v").alias("min"), F.max("v").alias("max"),
            F.sum("v").alias("total")]
    wanted = list(dict.fromkeys(float(p) for p in percentiles))
    if not wanted:
        return long.groupBy(*keys).agg(*base)
    # one read for the sums and the sketches, one for the percentiles
    stats = written_table(long.groupBy(*keys).agg(*base, sketch_of(F.col("v")).alias("sketch")), "summary")
    base = stats.drop("sketch")
    found = exact_percentiles(long, "v", wanted, group_cols=keys, stats=stats)
    wide = found.groupBy(*keys).agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(percentile_name(p))
                                      for p in wanted])
    own = free_prefix([*keys, *base.columns])
    named = wide.select(*[F.col(c).alias(f"{own}{c}") for c in keys], *[percentile_name(p) for p in wanted])
    cond = F.lit(True)
    for c in keys:
        cond = cond & F.col(c).eqNullSafe(F.col(f"{own}{c}"))
    return base.join(named, cond, "left").drop(*[f"{own}{c}" for c in keys])
