"""Timelines in pages (A6-A8) and telemetry summaries (A10)."""

from scorewright.operators.timeline import TIMELINE_METRICS, operation_means, timeline_means
from scorewright.plans import catalog
from scorewright.streaming.progress import progress_frame, summarize

PAGE_A = """<html><script>
var v1 = [{x: "15:13:19", y: 5.0}, {x: "15:13:20", y: 7.0}];
var v2 = [{x: "15:13:19", y: 4.0},
          {x: "15:13:20", y: 6.0}];
var v4 = [{x: "15:13:19", y: 1478.0}];
var v5 = [{x: "15:13:19", addBatch: 800, getBatch: 10}, {x: "15:13:20", addBatch: 1000, walCommit: 3}];
</script></html>"""
PAGE_B = """<script>var v1 = [{x: "15:14:00", y: 9.0}];</script>"""


def test_timeline_means(spark):
    pages = spark.createDataFrame([(PAGE_A,), (PAGE_B,)], "html string")
    got = {r["metric"]: (r["mean"], r["n_points"]) for r in timeline_means(pages).collect()}
    assert set(got) == set(TIMELINE_METRICS)
    assert got["Input Rate (records/sec)"] == (7.0, 3)
    assert got["Process Rate (records/sec)"] == (5.0, 2)
    assert got["Input Rows (records/batch)"] == (None, 0)  # missing series
    assert got["Batch Duration (ms)"] == (1478.0, 1)


def test_operation_means(spark):
    pages = spark.createDataFrame([(PAGE_A,)], "html string")
    got = {r["operation"]: r["mean_ms"] for r in operation_means(pages).collect()}
    assert got == {"addBatch": 900.0, "getBatch": 10.0, "walCommit": 3.0}


def test_summarize(spark):
    df = spark.createDataFrame([(float(i), i % 2) for i in range(1, 11)], "d double, g int")
    row = summarize(df, ["d"]).collect()[0]
    assert (row["n"], row["mean"], row["min"], row["max"], row["total"]) == (10, 5.5, 1.0, 10.0, 55.0)
    assert row["p50"] == 5.0
    grouped = {r["g"]: r["total"] for r in summarize(df, ["d"], group_cols=["g"]).collect()}
    assert grouped == {0: 30.0, 1: 25.0}


def test_progress_frame(spark):
    reports = [{"id": "q", "name": "n", "batchId": 3, "timestamp": "2026-07-08T15:13:19.079Z",
                "numInputRows": 5, "inputRowsPerSecond": 3.3, "processedRowsPerSecond": 3.4,
                "durationMs": {"triggerExecution": 1478, "addBatch": 900}}]
    row = progress_frame(spark, reports).collect()[0]
    assert row["Batch_Duration_ms"] == 1478.0 and row["Input_Rows"] == 5.0 and row["batch_id"] == 3


def test_operation_means_from_progress(spark):
    from scorewright.streaming.progress import operation_means_from_progress

    reports = [{"id": "q", "batchId": i, "timestamp": "2026-07-08T15:13:19.079Z", "numInputRows": 5,
                "durationMs": {"addBatch": 100 * (i + 1), "walCommit": 4}} for i in range(3)]
    got = {r["operation"]: r["mean_ms"] for r in operation_means_from_progress(progress_frame(spark, reports)).collect()}
    assert got == {"addBatch": 200.0, "walCommit": 4.0}


def test_metrics_job_cli(spark, scratch, capsys):
    import json

    from scorewright.plans import metrics_job

    for i, page in enumerate([PAGE_A, PAGE_B]):
        with open(f"{scratch}/page{i}.html", "w") as fh:
            fh.write(page)
    assert metrics_job.main(["--pages", f"{scratch}/*.html"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["means"]["Input Rate (records/sec)"] == 7.0
    assert out["means"]["Input Rows (records/batch)"] is None
    assert out["operations"] == {"addBatch": 900.0, "getBatch": 10.0, "walCommit": 3.0}


def test_page_files_keep_every_page(spark, scratch):
    call = "<script>var t = 1; track(2)</script>"
    rows = [(1, call), (None, call), (None, None), (2, None), (-3, "track(4)"), (5, "a<!--page:9-->track(6)"),
            (7, "track(<!--page:--><!--page;;:x)"), (8, "var t = <!--page:8-->\n<!--page;:;; track(<!--page:)")]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(f"{scratch}/pages.parquet")
    got = sorted(map(str, catalog.q_page_files(spark, scratch).collect()))
    assert len(got) == len(rows) and got == sorted(map(str, catalog.q_page_vars(spark, scratch).collect()))


def test_charts_with_any_text_in_their_strings(spark):
    page = """<script>var v1 = [{x: "a];b", y: 2.0}, {x: "c \\"]; d", y: 4}, {x: "[[", y: 6}];
    var v2 = [{x: ";", y: 1}]; var v3 = [broken; var v4 = [];
    var v5 = [{x: "];", addBatch: 8}, {x: "q", addBatch: 4}];</script>"""
    pages = spark.createDataFrame([(page,), (None,), ("",)], "html string")
    got = {r["metric"]: (r["mean"], r["n_points"]) for r in timeline_means(pages).collect()}
    assert got == {"Input Rate (records/sec)": (4.0, 3), "Process Rate (records/sec)": (1.0, 1),
                   "Input Rows (records/batch)": (None, 0), "Batch Duration (ms)": (None, 0)}
    assert [tuple(r) for r in operation_means(pages).collect()] == [("addBatch", 6.0)]
