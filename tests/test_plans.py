"""Plan shapes: the map-only operators add no shuffle; aggregations are
partial before their shuffle; filters and projections reach the scan."""

import pytest

from scorewright.functions.messages import encode_messages
from scorewright.operators import classes as C
from scorewright.operators.parse import parse_messages
from scorewright.operators.score import ThresholdRule, score
from scorewright.plans import configs

SF = "/root/testdata/sf0.001"


def _plan(spark, df) -> str:
    name = "plan_probe"
    df.createOrReplaceTempView(name)
    return spark.sql(f"EXPLAIN FORMATTED SELECT * FROM {name}").collect()[0][0]


@pytest.fixture()
def split_events(spark, scratch):
    # a multi-file input, as large tables are: the scan itself has many splits
    spark.read.parquet(f"{SF}/events.parquet").repartition(4).write.parquet(f"{scratch}/ev")
    return spark.read.parquet(f"{scratch}/ev")


def test_parse_derive_score_is_map_only(spark, split_events):
    msgs = encode_messages(split_events, ["event_id", "ts", "user_id", "event_type", "value", "props"])
    scored = score(parse_messages(msgs, configs.EVENT_SCHEMA), dict(configs.EVENT_MODEL),
                   model=ThresholdRule("value", 50.0))
    plan = _plan(spark, scored)
    assert "Exchange" not in plan
    assert "ArrowEvalPython" in plan
    assert plan.count("from_json") >= 1


def test_hash_split_is_map_only(spark, split_events):
    assert "Exchange" not in _plan(spark, C.hash_split(split_events, ["event_id"]))


def test_rebalance_moves_no_row_of_few_copies(spark, split_events):
    shares = {t: 0.2 for t in ["click", "error", "purchase", "signup", "view"]}
    plan = _plan(spark, C.rebalance(split_events, "event_type", shares, ["event_id"]))
    # rows meet their class's numbers without a shuffle, copies are made in place
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "hashpartitioning" not in plan and plan.count("Exchange") == plan.count("BroadcastExchange")


def test_rebalance_deals_only_long_runs(spark, split_events):
    shares = {"click": 1.0, "error": 0.0, "purchase": 0.0, "signup": 0.0, "view": 0.0}
    out = C.rebalance(split_events, "event_type", shares, ["event_id"], total_rows=5_000_000)
    plan = _plan(spark, out)
    assert "REBALANCE" in plan and out.count() > 4_990_000


def test_rebalance_with_a_key_in_a_third_of_the_rows(spark, scratch):
    """No task gets more than its share of the input."""
    spark.range(90_000, numPartitions=6).selectExpr(
        "if(id % 3 = 0, 0, id) AS key", "id % 2 AS label").write.parquet(f"{scratch}/hot")
    hot = spark.read.parquet(f"{scratch}/hot")
    out = C.rebalance(hot, "label", {0: 0.5, 1: 0.5}, ["key"], total_rows=180_000)
    tasks = [r["n"] for r in out.selectExpr("spark_partition_id() AS p").groupBy("p").count().withColumnRenamed("count", "n").collect()]
    assert sum(tasks) == 180_000 and max(tasks) < 1.1 * 180_000 / 6


def test_split_writes_the_same_for_any_width(spark, scratch, monkeypatch):
    import os

    from scorewright import session

    def written_bytes(df):
        made = []
        monkeypatch.setattr(C, "written_table", lambda d, name: made.append(session.written_table(d, name)) or made[-1])
        C.stratified_split(df, "label", ["key"], train_percent=50).count()
        paths = [f.removeprefix("file://").removeprefix("file:") for d in made for f in d.inputFiles()]
        return sum(os.path.getsize(p) for p in paths)

    base = spark.range(20_000).selectExpr("id AS key", "id % 3 AS label")
    base.write.parquet(f"{scratch}/narrow")
    base.selectExpr("*", *[f"md5(cast(id as string)) AS w{i}".replace("id", "key") for i in range(20)]).write.parquet(f"{scratch}/wide")
    narrow, wide = (written_bytes(spark.read.parquet(f"{scratch}/{n}")) for n in ("narrow", "wide"))
    assert wide < 1.05 * narrow


def test_spread_leaves_split_and_shuffled_input_alone(spark, split_events):
    from scorewright.session import spread_scan

    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup(None))
    grouped = split_events.groupBy("event_type").count()
    assert spread_scan(grouped) is grouped and spread_scan(split_events.repartition(2)) is not None
    assert len(jobs.getJobIdsForGroup(None)) == before
    one = spark.read.parquet(f"{SF}/lineitem.parquet")
    assert spread_scan(one, 1) is one and "Exchange" not in _plan(spark, spread_scan(one, 1))
    assert "Exchange" in _plan(spark, spread_scan(one, 64))


def test_class_counts_aggregate_partially(spark, split_events):
    plan = _plan(spark, C.class_counts(split_events, "event_type"))
    assert "partial_count" in plan


def test_filter_and_projection_reach_the_scan(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_returnflag")
    plan = _plan(spark, C.filter_class(li, "l_returnflag", "R"))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plan


@pytest.mark.parametrize("where", ["query", "job"])
def test_training_reads_rows_that_were_split_once(spark, where, tmp_path, monkeypatch):
    """The forest's passes over its rows neither hash nor join them again."""
    from scorewright.plans import catalog, train_job

    rows = [(i, i % 7, float(i % 50), 100.0 + i, 0.01 * (i % 10), 0.0, "R" if i % 50 > 30 else "N") for i in range(400)]
    li = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                     "l_discount double, l_tax double, l_returnflag string")
    seen = []

    def spy(train, *args, **kwargs):
        seen.append(train)
        return fit(train, *args, **kwargs)

    module = catalog if where == "query" else train_job
    fit = module.train_random_forest
    monkeypatch.setattr(module, "train_random_forest", spy)
    if where == "query":
        li.write.parquet(f"{tmp_path}/lineitem.parquet")
        report = catalog.q_mllib(spark, str(tmp_path))
    else:
        report = train_job.run(spark, li.drop("l_returnflag").withColumn("label", (li.l_quantity > 30).cast("int")), "label",
                               f"{tmp_path}/model", key_cols=["l_orderkey"])
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan and "Join" not in plan
    support = {r.label: r.support for r in report.collect()}
    assert (support["0"], support["1"], support["accuracy"]) == (50, 31, 81) and seen[0].count() == 319
