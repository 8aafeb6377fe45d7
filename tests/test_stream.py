"""Batch = stream, restart on one checkpoint, progress rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from scorewright.operators.score import ThresholdRule
from scorewright.plans import catalog, configs, job
from scorewright.streaming.sinks import run_until_done

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.select("event_id", "value", "k", "prediction").collect())


def test_stream_equals_batch(spark, scratch):
    cfg = catalog.stream_job_config(SF, scratch)
    q = job.start(spark, cfg, model=ThresholdRule("value", 50.0))
    run_until_done(q, 600)
    streamed = spark.read.parquet(f"{scratch}/data")
    batch = catalog.scored_events(spark, SF)
    assert _rows(streamed) == _rows(batch)


def test_restart_adds_nothing(spark, scratch):
    cfg = catalog.stream_job_config(SF, scratch)
    for _ in range(2):
        run_until_done(job.start(spark, cfg, model=ThresholdRule("value", 50.0)), 600)
    assert spark.read.parquet(f"{scratch}/data").count() == spark.read.parquet(f"{SF}/events.parquet").count()


def test_foreach_batch_idempotent(spark):
    out = catalog.q_stream_batches(spark, SF)
    assert out.count() == out.select("event_id").distinct().count()


def test_progress_rows(spark):
    tele = catalog.q_telemetry(spark, SF).collect()
    assert len(tele) >= 1
    assert sum(r["Input_Rows"] for r in tele) == 1000.0


def test_telemetry_covers_many_batches(spark):
    summary = {r["metric"]: r for r in catalog.q_telemetry_summary(spark, SF).collect()}
    assert summary["Input_Rows"]["n"] > 1 and summary["Input_Rows"]["total"] == 1000.0
    assert summary["Input_Rows"]["max"] < 1000.0


def test_yaml_config_with_env(tmp_path, monkeypatch):
    monkeypatch.setenv("DB_PASSWORD", "s3cret")
    p = tmp_path / "job.yaml"
    p.write_text("sink:\n  format: jdbc\n  options:\n    password: ${DB_PASSWORD}\nschema:\n  a: {path: a, type: double}\n")
    cfg = job.load_config(str(p))
    assert cfg["sink"]["options"]["password"] == "s3cret"
    assert cfg["schema"]["a"]["type"] == "double"


def test_message_round_trip_is_exact(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    parsed = catalog.q_parse(spark, SF)
    assert events.select("event_id", "ts", "value").exceptAll(parsed.select("event_id", "ts", "value")).count() == 0
    # summation order differs between the plans; the rows themselves are equal
    assert round(parsed.agg(F.sum("value")).collect()[0][0], 6) == round(events.agg(F.sum("value")).collect()[0][0], 6)


def test_example_job_file_builds(spark, monkeypatch):
    """The example configuration parses and scores a batch message."""
    import os

    monkeypatch.setenv("SCORES_DB_USER", "u")
    monkeypatch.setenv("SCORES_DB_PASSWORD", "p")
    cfg = job.load_config(os.path.join(os.path.dirname(__file__), "..", "examples", "sensor_job.yaml"))
    assert cfg["sink"]["options"]["password"] == "p"
    messages = ['{"event_id": 7, "event_type": "view", "value": 12.0, "props": "{\\"k\\": 4}"}', "not json"]
    raw = spark.createDataFrame([(bytearray(m, "utf-8"), i) for i, m in enumerate(messages)], "value binary, offset long")
    out = job.build(spark, cfg, raw=raw, model=ThresholdRule("value", 10.0))
    good, bad = out.orderBy("offset").collect()
    assert (good["event_id"], good["k"], good["value_per_k"], good["prediction"], good["unread"]) == (7, 4, 3.0, 1, [])
    assert bad["unread"] == ["_message"] and bad["offset"] == 1 and "props_text" not in out.columns
    assert set(cfg["sink"]["columns"]) <= set(out.columns)


def test_wide_messages(spark):
    """Thirty numeric fields (F3), one derived column."""
    import json

    schema = {f"c{i}": {"path": f"c{i}", "type": "double"} for i in range(30)}
    schema["both"] = {"transform": "c0 + c29", "type": "double"}
    raw = spark.createDataFrame([(json.dumps({f"c{i}": i / 4 for i in range(30)}),)], "value string")
    row = job.build(spark, {"schema": schema}, raw=raw).first()
    assert row["c7"] == 1.75 and row["both"] == 7.25 and len(row) == 31


def test_cli_runs_a_job_to_completion(spark, scratch):
    import yaml

    cfg = catalog.stream_job_config(SF, scratch)
    cfg["model"] = {"type": "pickle", "path": f"{scratch}/rule.pkl", "features": ["value"]}
    import pickle

    with open(f"{scratch}/rule.pkl", "wb") as fh:
        pickle.dump(ThresholdRule("value", 50.0), fh)
    path = f"{scratch}/job.yaml"
    with open(path, "w") as fh:
        yaml.safe_dump(cfg, fh)
    assert job.main(["--config", path]) == 0
    assert spark.read.parquet(f"{scratch}/data").count() == 1000


def test_progress_log_keeps_every_report(spark, scratch):
    """More batches than Spark's own report window holds."""
    from scorewright.sources.files import write_message_files
    from scorewright.streaming.progress import ProgressLog, progress_frame, summarize

    events = spark.read.parquet(f"{SF}/events.parquet").repartition(9)
    write_message_files(events, catalog.EVENT_COLUMNS, f"{scratch}/topic")
    cfg = catalog.stream_job_config(SF, scratch)
    cfg["source"] = {"format": "text", "path": f"{scratch}/topic", "max_files_per_trigger": 1}
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        with ProgressLog(spark, reports_per_file=4) as log:
            query = job.start(spark, cfg, model=ThresholdRule("value", 50.0))
            run_until_done(query)
            log.wait_for_end(query)
            assert len(query.recentProgress) <= 2
            tele = progress_frame(spark, log.table(query)).filter("Input_Rows > 0")
            assert tele.count() == 9 and log.rows(query) == 1000
            row = summarize(tele, ["Input_Rows"], percentiles=[0.5, 0.995, 0.999]).first()
            assert row["total"] == 1000 and {"p50", "p99_5", "p99_9"} <= set(row.asDict())
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)


def test_cli_bad_config_exits_nonzero(tmp_path):
    bad = tmp_path / "bad.yaml"
    bad.write_text("kafka:\n  topic: [unclosed\n")
    assert job.main(["--config", str(bad)]) == 1
    assert job.main(["--config", str(tmp_path / "missing.yaml")]) == 1


def test_older_flat_schema_config(spark):
    import json

    cfg = {"schema": {"event_id": "integer", "value": "double", "user_id": "no_such_type"}, "model": {"features": ["value"]}}
    rows = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "value", "user_id").collect()
    raw = spark.createDataFrame([(bytearray(json.dumps(r.asDict()), "utf-8"),) for r in rows], "value binary")
    out = job.build(spark, cfg, raw=raw, model=ThresholdRule("value", 50.0))
    # an unknown type is text
    assert sorted(map(tuple, out.collect())) == sorted((r.event_id, r.value, str(r.user_id), int(r.value > 50.0)) for r in rows)


def test_training_job_cli(spark, scratch, capsys):
    from pyspark.sql import functions as F

    from scorewright.plans import train_job
    from scorewright.streaming.sinks import write_batch

    li = spark.read.parquet(f"{SF}/../sf0.001/lineitem.parquet").select(
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("Class"))
    write_batch(li, {"format": "csv", "options": {"path": f"{scratch}/data", "header": "true"}})
    code = train_job.main(["--input", f"{scratch}/data", "--label", "Class",
                           "--model-out", f"{scratch}/model", "--report-out", f"{scratch}/report",
                           "--num-trees", "5", "--max-depth", "3"])
    assert code == 0
    out = capsys.readouterr().out
    assert '"accuracy"' in out and '"weighted avg"' in out
    cfg = {"type": "spark_mllib", "path": f"{scratch}/model",
           "features": ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]}
    from scorewright.operators.score import score

    assert score(li, cfg).count() == li.count()


def test_batch_mode_equals_stream(spark, scratch):
    import pickle

    import yaml

    cfg = catalog.stream_job_config(SF, scratch)
    cfg["sink"] = {"format": "parquet", "options": {"path": f"{scratch}/batch_out"}}
    cfg["model"] = {"type": "pickle", "path": f"{scratch}/rule.pkl", "features": ["value"]}
    with open(f"{scratch}/rule.pkl", "wb") as fh:
        pickle.dump(ThresholdRule("value", 50.0), fh)
    with open(f"{scratch}/job.yaml", "w") as fh:
        yaml.safe_dump(cfg, fh)
    assert job.main(["--config", f"{scratch}/job.yaml", "--batch"]) == 0
    batch = spark.read.parquet(f"{scratch}/batch_out")
    assert _rows(batch) == _rows(catalog.scored_events(spark, SF))


def test_derived_checkpoint_resumes_by_query_name(spark, scratch):
    import uuid

    name = f"resume_{uuid.uuid4().hex[:12]}"
    cfg = catalog.stream_job_config(SF, scratch)
    cfg["sink"] = {"format": "parquet", "options": {"path": f"{scratch}/named"},
                   "trigger": {"availableNow": True}}  # no checkpointLocation
    for _ in range(2):
        query = job.start(spark, cfg, model=ThresholdRule("value", 50.0), query_name=name)
        run_until_done(query, 600)
    assert spark.read.parquet(f"{scratch}/named").count() == 1000
    from scorewright.streaming.sinks import checkpoint_for

    assert checkpoint_for(spark.range(1), {}, name).endswith(f"/scorewright/streams/{name}")


@pytest.mark.parametrize("fmt", ["memory", "console"])
def test_native_sinks_run(spark, scratch, fmt):
    import uuid

    name = f"sink_{fmt}_{uuid.uuid4().hex[:8]}"
    cfg = catalog.stream_job_config(SF, scratch)
    cfg["sink"] = {"format": fmt, "checkpointLocation": f"{scratch}/ck", "trigger": {"availableNow": True},
                   "options": {"numRows": "2"} if fmt == "console" else {}}
    run_until_done(job.start(spark, cfg, model=ThresholdRule("value", 50.0), query_name=name), 600)
    if fmt == "memory":
        assert spark.table(name).count() == 1000


def _logged(spark, scratch, files, log, source=None):
    from scorewright.sources.files import write_message_files

    events = spark.read.parquet(f"{SF}/events.parquet").repartition(files)
    write_message_files(events, catalog.EVENT_COLUMNS, f"{scratch}/topic")
    cfg = catalog.stream_job_config(SF, scratch)
    cfg["source"] = {"format": "text", "path": f"{scratch}/topic", **(source or {"max_files_per_trigger": 1})}
    with log:
        query = job.start(spark, cfg, model=ThresholdRule("value", 50.0))
        run_until_done(query)
        log.wait_for_end(query)
    return query, cfg


def test_a_failed_telemetry_write_loses_nothing(spark, scratch):
    from scorewright.streaming.progress import ProgressLog

    class Failing(ProgressLog):
        calls = 0

        def _write(self, name, text):
            self.calls += 1
            if self.calls <= 3:
                raise OSError("store is away")
            super()._write(name, text)

    log = Failing(spark, reports_per_file=2)
    query, cfg = _logged(spark, scratch, 5, log)
    assert log.calls > 3 and not log._pending
    reports = log.table(query)
    assert reports.filter("num_input_rows > 0").count() == 5
    # a restart on the same checkpoint is another run: nothing is counted twice
    with log:
        again = job.start(spark, cfg, model=ThresholdRule("value", 50.0))
        run_until_done(again)
        log.wait_for_end(again)
    rows = log.table(again).filter("num_input_rows > 0")
    assert rows.count() == 5 and rows.agg({"num_input_rows": "sum"}).first()[0] == 1000


def test_a_telemetry_write_that_never_succeeds_is_raised(spark, scratch):
    from scorewright.streaming.progress import ProgressLog

    class Broken(ProgressLog):
        def _write(self, name, text):
            raise OSError("store is away")

    log = Broken(spark, reports_per_file=1)
    with pytest.raises(OSError, match="away"):
        _logged(spark, scratch, 2, log)  # the end is reached all the same
    assert len(log._pending) >= 2 and isinstance(log.failure, OSError)


def test_written_reports_are_named_by_content(spark, scratch):
    from scorewright.streaming.progress import ProgressLog

    log = ProgressLog(spark, path=f"{scratch}/log")
    for _ in range(2):
        log._pending = {("q", "r", 1): '{"query_id":"q","run_id":"r","batch_id":1,"num_input_rows":5,"reported_at":"t1"}'}
        log._flush()
    log._pending = {("q", "r", 1): '{"query_id":"q","run_id":"r","batch_id":1,"num_input_rows":7,"reported_at":"t2"}'}
    assert [(r.batch_id, r.num_input_rows) for r in log.table().collect()] == [(1, 7)]


def test_micro_batches_by_size(spark, scratch):
    import os

    from scorewright.streaming.progress import ProgressLog

    log = ProgressLog(spark)
    query, _ = _logged(spark, scratch, 8, log, {"max_bytes_per_trigger": 25_000})
    sizes = [os.path.getsize(f"{scratch}/topic/{f}") for f in os.listdir(f"{scratch}/topic") if f.endswith((".txt", ".json"))]
    reports = log.table(query).filter("num_input_rows > 0").collect()
    assert sum(r.num_input_rows for r in reports) == 1000
    assert 2 <= len(reports) <= -(-sum(sizes) // 25_000) * 2
    if sizes:
        most = max(sizes)
        assert max(r.num_input_rows for r in reports) <= 1000 * (25_000 + most) / sum(sizes) * 1.3


def test_telemetry_rows_counts_batches_and_their_median(spark, tmp_path):
    """Ids of any sign, repeated and null: every file is a batch, whose rows
    follow from the ids alone."""
    ids = [None] * 4 + list(range(-3, 21)) + [7] * 6
    events = spark.createDataFrame([(i, 1, "click", 2.0, '{"k": 1}') for i in ids],
                                   "event_id long, user_id long, event_type string, value double, props string")
    events.selectExpr("event_id", "timestamp'2024-01-01 00:00:00' AS ts", "user_id", "event_type", "value", "props") \
        .write.parquet(f"{tmp_path}/events.parquet")
    sizes = sorted(Counter(0 if i is None else i % 8 for i in ids).values())
    got = catalog.QUERIES["q_telemetry_rows"](spark, str(tmp_path)).collect()
    assert [r.asDict() for r in got] == [
        {"metric": "Input_Rows", "n": 8, "total": float(len(ids)), "p50": float(sizes[3]), "several": True}]
