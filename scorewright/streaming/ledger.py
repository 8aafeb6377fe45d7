"""K2, K3: a relational sink in which a replayed batch changes nothing.

Executors write a micro-batch in parallel into a staging table (replaced each
time).  One transaction on the driver then moves it: rows of the same batch
are deleted from the target, the staged rows are inserted by the database
itself (``INSERT ... SELECT``; none pass through the driver) and the batch is
entered in a ledger table of (query, batch).  A batch that the ledger has is
done and not written again; a failure before the commit leaves the target as
it was, and the replay starts over.

The target gets the columns ``query_name`` and ``batch_id`` next to the
batch's own; target, staging and ledger tables are created by Spark's writer
where they are missing.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sinks import save

QUERY, BATCH = "query_name", "batch_id"


def _settings(options: Mapping) -> tuple[str, str, str, dict]:
    """url, target, ledger and the writer's options."""
    own = {k: v for k, v in options.items() if k not in ("mode", "ledger", "dbtable")}
    for key in ("url", "dbtable"):
        if not options.get(key):
            raise ValueError(f"a relational sink needs the option {key!r}")
    if options.get("mode", "append") != "append":
        raise ValueError("an idempotent relational sink appends batches: leave 'mode' out")
    return str(options["url"]), str(options["dbtable"]), str(options.get("ledger") or f"{options['dbtable']}_batches"), own


def open_connection(spark, options: Mapping):
    """A ``java.sql.Connection`` of the driver, and how it quotes names."""
    url, _, _, own = _settings(options)
    jvm = spark._jvm
    if own.get("driver"):
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(own["driver"])
    properties = jvm.java.util.Properties()
    for key, value in own.items():
        properties.setProperty(str(key), str(value))
    dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
    return jvm.java.sql.DriverManager.getConnection(url, properties), dialect.quoteIdentifier


def publish(connection, quote: Callable[[str], str], *, target: str, staged: str, ledger: str, query: str, batch_id: int,
            columns: list[str]) -> bool:
    """Move a staged batch in one transaction; False if the ledger had it."""
    def run(sql: str, *values) -> Any:
        statement = connection.prepareStatement(sql)
        try:
            for n, value in enumerate(values, 1):
                (statement.setLong if isinstance(value, int) else statement.setString)(n, value)
            if not sql.startswith("SELECT"):
                return statement.executeUpdate()
            found = statement.executeQuery()
            found.next()
            return found.getLong(1)
        finally:
            statement.close()

    mine = f"{quote(QUERY)} = ? AND {quote(BATCH)} = ?"
    names = ", ".join(quote(c) for c in columns)
    connection.setAutoCommit(False)
    try:
        if run(f"SELECT count(*) FROM {ledger} WHERE {mine}", query, batch_id):
            connection.rollback()
            return False
        run(f"DELETE FROM {target} WHERE {mine}", query, batch_id)
        run(f"INSERT INTO {target} ({names}) SELECT {names} FROM {staged}")
        run(f"INSERT INTO {ledger} ({quote(QUERY)}, {quote(BATCH)}) VALUES (?, ?)", query, batch_id)
        connection.commit()
        return True
    except BaseException:
        connection.rollback()
        raise


def ledger_writer(options: Mapping, query: str, *, connect: Callable = open_connection,
                  write: Callable = save) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` callback.  ``connect`` and ``write`` are the
    driver's connection and Spark's batch writer."""
    _, target, ledger, own = _settings(options)
    if not query:
        raise ValueError("an idempotent relational sink needs a query name for its ledger")
    staged = f"{target}_staged_" + re.sub(r"\W", "_", query)

    def replace(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        tagged = rows.withColumns({QUERY: F.lit(query), BATCH: F.lit(int(batch_id)).cast("long")})
        entries = tagged.select(QUERY, BATCH).limit(0)
        for table, empty in ((target, tagged.limit(0)), (ledger, entries)):  # made where missing
            write(empty, "jdbc", {**own, "dbtable": table}, mode="append")
        write(tagged, "jdbc", {**own, "dbtable": staged}, mode="overwrite")
        connection, quote = connect(spark, options)
        try:
            publish(connection, quote, target=target, staged=staged, ledger=ledger, query=query, batch_id=int(batch_id),
                    columns=tagged.columns)
        finally:
            connection.close()

    return replace
