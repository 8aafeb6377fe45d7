"""Session helpers: a local session for tests and the bench, and the
shared checkpoint folder.

Library functions never change session configuration; they read it.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def local_session(app: str = "scorewright", cores: str | int = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SCOREWRIGHT_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        return spark.conf.get(key, None)
    except Exception:
        return None


def _local_base(spark: SparkSession) -> str:
    """Scratch of a local session: where Spark itself spills."""
    base = _conf(spark, "spark.local.dir") or spark._jvm.System.getProperty("java.io.tmpdir")
    return os.path.join(base.split(",")[0], "scorewright-scratch")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The base is ``spark.checkpoint.dir`` as the session names it (on a
    cluster this is shared storage every executor can reach).  A local
    session without it uses Spark's own scratch folder
    (``spark.local.dir``); a cluster session without it is an error.
    """
    base = _conf(spark, "spark.checkpoint.dir")
    if not base:
        try:
            base = spark.sparkContext.getCheckpointDir()
        except Exception:
            base = None
    if not base:
        master = _conf(spark, "spark.master") or ""
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_base(spark)
    return "/".join([qualified(spark, base).rstrip("/"), "scorewright", *parts, uuid.uuid4().hex])


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers.

    Called by every operator that runs Python on executors (pandas UDFs,
    ``applyInPandas``).  The package is zipped once on the driver and
    handed to ``addPyFile``, which copies it to each executor; nothing is
    done when the context already has it.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: code must be installed on the cluster
        return
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import atexit
    import shutil
    import tempfile
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    # The zip is staged on the driver only: addPyFile serves it to every
    # executor through Spark's own file distribution, so no executor ever
    # reads this folder (it is not scratch shared with the cluster).
    out_dir = tempfile.mkdtemp(prefix="scorewright-pyfiles-")
    atexit.register(shutil.rmtree, out_dir, True)
    target = os.path.join(out_dir, "scorewright.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    _SHIPPED.add(key)


def write_file(spark: SparkSession, path: str, data: bytes) -> str:
    """Write a small file (a model, a listing) on any file system that the
    session knows; returns its path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    return path


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder with its scheme: a plain path belongs to the cluster's
    default file system, which need not be the local one."""
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    except AttributeError:  # no JVM at hand (Spark Connect): as the session has it
        return folder


def written_table(df, name: str):
    """Write ``df`` below the shared checkpoint folder and read it back: the
    rows are fixed from then on, whatever is recomputed later."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(df) -> None:
    """Delete the files behind a table of :func:`written_table`."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# What makes a plan more than a file scan with projections and filters.
_NOT_A_SCAN = ("Join", "Aggregate", "Sort", "Repartition", "Window", "Distinct", "Limit", "Union", "Generate",
               "LogicalRDD", "Range", "MapIn", "Python")


def _scan_partitions(df) -> int | None:
    """Splits of a plain file scan; None for anything else.  No job runs."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        names = [line.strip(" +-:").split(" ")[0].split("[")[0] for line in plan.treeString().splitlines()]
        if any(n.startswith(_NOT_A_SCAN) for n in names) or not any(n.startswith("Relation") for n in names):
            return None
        return df.rdd.getNumPartitions()
    except Exception:  # no plan or RDD access (Spark Connect)
        return None


def spread_scan(df, min_partitions: int | None = None):
    """Give a CPU-heavy map stage over files enough tasks.

    A file scan with fewer splits than ``min_partitions`` (default: the
    default parallelism), as one small file has, is dealt out by the hash of
    the row position, which is the same on every retry and unique, so there
    is no hot key.  Scans that are already split (large tables), streams and
    anything else than a file scan are returned unchanged.
    """
    if df.isStreaming:
        return df
    current = _scan_partitions(df)
    if current is None:
        return df
    target = int(min_partitions or df.sparkSession.sparkContext.defaultParallelism)
    if current >= target:
        return df
    from pyspark.sql import functions as F

    return (df.withColumn("_scan_pos", F.monotonically_increasing_id())
            .repartition(target, "_scan_pos").drop("_scan_pos"))
