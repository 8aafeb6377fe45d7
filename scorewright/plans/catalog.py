"""Registered queries: each one runs an operator of the toolkit over the
given tables, at whatever scale they have.

Every query is a function ``(spark, sf_dir) -> DataFrame`` and most have a
DuckDB SQL twin in :mod:`scorewright.plans.oracle` that computes the same
rows independently.  Column names are aliased identically on both sides.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.messages import encode_messages, message_text
from ..operators.classes import (
    class_counts,
    filter_class,
    hash_split,
    rebalance,
    split_features_label,
    stratified_split,
)
from ..operators.parse import derive, parse_messages, parse_struct
from ..operators.report import classification_report
from ..operators.score import (
    CategoryRule,
    LinearScore,
    ThresholdRule,
    assemble,
    feature_array,
    register_loader,
    score,
    score_mllib,
)
from ..operators.timeline import (
    call_argument,
    operation_means,
    script_value,
    timeline_means,
    unquote_keys,
)
from ..operators.train import load_model, save_model, train_random_forest
from ..operators.trees import forest_from_saved, score_forest
from ..session import shared_dir, spread_scan, write_file, written_table
from ..sources.files import write_message_files
from ..streaming.progress import ProgressLog, operation_means_from_progress, progress_frame, summarize
from ..streaming.sinks import foreach_batch_writer, run_until_done, to_kafka_records, write_stream
from . import configs, job

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def register(name: str):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str, *, spread_rows: bool = False) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread_scan(df) if spread_rows else df


EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events rows as JSON messages in a binary ``value`` column."""
    events = table(spark, sf_dir, "events", spread_rows=True)
    return encode_messages(events, EVENT_COLUMNS)


# --------------------------------------------------------------------------
# messages
# --------------------------------------------------------------------------


@register("q_encode")
def q_encode(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        message_text(["event_id", "user_id", "event_type", "props"]).alias("message"),
    )


_EVENT_BASE = {k: v for k, v in configs.EVENT_SCHEMA.items() if "path" in v and k != "props_txt"}
_EVENT_BASE["props"] = {"path": "props", "type": "string"}


@register("q_parse")
def q_parse(spark, sf_dir):
    return parse_messages(event_messages(spark, sf_dir), _EVENT_BASE)


@register("q_parse_path")
def q_parse_path(spark, sf_dir):
    return parse_messages(event_messages(spark, sf_dir), _EVENT_BASE, mode="path")


@register("q_parse_nested")
def q_parse_nested(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    nested = events.select(
        F.to_json(
            F.struct(
                "event_id",
                F.struct("event_type", F.from_json("props", "k int").alias("props")).alias("body"),
                F.array("value", "value").alias("pair"),
            )
        ).alias("value")
    )
    cfg = {
        "event_id": {"path": "event_id", "type": "long"},
        "event_type": {"path": "body.event_type", "type": "string"},
        "k": {"path": "body.props.k", "type": "int"},
        "first_value": {"path": "pair[0]", "type": "double"},
        "body_key": {"path": "$['body']['event_type']", "type": "string"},
    }
    return parse_messages(nested, cfg)


def trie_messages(spark, sf_dir):
    """Line items as nested messages with arrays of objects."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.to_json(F.struct(
        F.struct(
            F.struct("l_orderkey", "l_linenumber").alias("order"),
            F.array(F.struct(F.col("l_partkey").alias("key"), F.lit("part").alias("kind")),
                    F.struct(F.col("l_suppkey").alias("key"), F.concat(F.lit("supp "), F.col("l_returnflag")).alias("kind"))).alias("refs"),
            F.array("l_quantity", "l_extendedprice", "l_tax").alias("amounts"),
        ).alias("item"),
        F.struct(F.array(F.struct(F.col("l_linestatus").alias("s"))).alias("one"), F.col("l_returnflag").alias("flag x")).alias("state"),
    )).alias("value"))


TRIE_SCHEMA = {
    "orderkey": {"path": "item.order.l_orderkey", "type": "long"},
    "line": {"path": "$['item']['order']['l_linenumber']", "type": "int"},
    "quantity": {"path": "item.amounts[0]", "type": "double"},
    "tax": {"path": "item.amounts[2]", "type": "double"},
    "beyond": {"path": "item.amounts[3]", "type": "double"},
    "partkey": {"path": "item.refs[0].key", "type": "long"},
    "supplier": {"path": "item.refs[1].kind", "type": "string"},
    "all_keys": {"path": "item.refs[*].key", "type": "string"},
    "status": {"path": "state.one[*].s", "type": "string"},
    "flag": {"path": "state.flag x", "type": "string"},
    "absent": {"path": "state.none.such", "type": "string"},
}


@register("q_parse_trie")
def q_parse_trie(spark, sf_dir):
    return parse_messages(spread_scan(trie_messages(spark, sf_dir)), TRIE_SCHEMA)


@register("q_derive")
def q_derive(spark, sf_dir):
    return parse_messages(event_messages(spark, sf_dir), configs.EVENT_SCHEMA)


@register("q_prune")
def q_prune(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem", spread_rows=True)
    msgs = encode_messages(lineitem, configs.LINEITEM_COLUMNS)
    return parse_messages(msgs, configs.LINEITEM_SCHEMA)


@register("q_parse_struct")
def q_parse_struct(spark, sf_dir):
    return parse_struct(event_messages(spark, sf_dir), configs.EVENT_FLAT_SCHEMA)


# --------------------------------------------------------------------------
# Scalar function families through configured transforms (P5)
# --------------------------------------------------------------------------


def _family(df: DataFrame, keys: list[str], exprs: dict[str, tuple[str, str]]) -> DataFrame:
    cfg = {name: {"transform": sql, "type": typ} for name, (sql, typ) in exprs.items()}
    return derive(df, cfg).select(*keys, *cfg.keys())


@register("q_fn_arith")
def q_fn_arith(spark, sf_dir):
    return _family(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], {
        "disc_price": ("l_extendedprice * (1 - l_discount)", "double"),
        "charge": ("l_extendedprice * (1 - l_discount) * (1 + l_tax)", "double"),
        "qty_x2": ("l_quantity * 2", "double"),
        "line_mod": ("l_linenumber % 3", "int"),
        "order_div": ("l_orderkey div 10", "long"),
    })


@register("q_fn_cond")
def q_fn_cond(spark, sf_dir):
    return _family(table(spark, sf_dir, "events"), ["event_id"], {
        "big": ("CASE WHEN value > 100 THEN 1 ELSE 0 END", "int"),
        "kind": ("CASE WHEN event_type IN ('click', 'view') THEN 'browse' "
                 "WHEN event_type = 'purchase' THEN 'buy' ELSE 'other' END", "string"),
        "v_or_zero": ("coalesce(CASE WHEN value > 200 THEN NULL ELSE value END, 0.0)", "double"),
        "is_error": ("event_type = 'error'", "boolean"),
    })


@register("q_fn_math")
def q_fn_math(spark, sf_dir):
    return _family(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], {
        "sqrt_price": ("round(sqrt(l_extendedprice), 6)", "double"),
        "abs_tax": ("abs(l_tax - 0.04)", "double"),
        "ln_qty": ("round(ln(1 + l_quantity), 6)", "double"),
        "floor_k": ("floor(l_extendedprice / 1000)", "long"),
        "ceil_k": ("ceil(l_extendedprice / 1000)", "long"),
        "disc_sq": ("round(power(l_discount, 2), 8)", "double"),
    })


@register("q_fn_string")
def q_fn_string(spark, sf_dir):
    return _family(table(spark, sf_dir, "customer"), ["c_custkey"], {
        "seg_upper": ("upper(c_mktsegment)", "string"),
        "seg_lower": ("lower(c_mktsegment)", "string"),
        "name_digits": ("substring(c_name, 10)", "string"),
        "name_len": ("length(c_name)", "int"),
        "tag": ("concat_ws('-', c_mktsegment, CAST(c_nationkey AS STRING))", "string"),
        "short_name": ("replace(c_name, 'Customer#', 'C')", "string"),
    })


@register("q_fn_date")
def q_fn_date(spark, sf_dir):
    return _family(table(spark, sf_dir, "orders"), ["o_orderkey"], {
        "o_year": ("year(o_orderdate)", "int"),
        "o_month": ("month(o_orderdate)", "int"),
        "o_day": ("dayofmonth(o_orderdate)", "int"),
        "month_start": ("CAST(date_trunc('MONTH', o_orderdate) AS DATE)", "date"),
        "days_since": ("datediff(CAST(o_orderdate AS DATE), DATE'1995-01-01')", "int"),
    })


@register("q_fn_array")
def q_fn_array(spark, sf_dir):
    return _family(table(spark, sf_dir, "embeddings"), ["vec_id"], {
        "dim": ("size(embedding)", "int"),
        "first_x": ("CAST(element_at(embedding, 1) AS DOUBLE)", "double"),
        "max_x": ("CAST(array_max(embedding) AS DOUBLE)", "double"),
        "sq_norm": ("round(aggregate(transform(embedding, x -> CAST(x AS DOUBLE) * CAST(x AS DOUBLE)), "
                    "0D, (acc, y) -> acc + y), 6)", "double"),
        "n_pos": ("size(filter(embedding, x -> x > 0))", "int"),
        "has_big": ("array_contains(transform(embedding, x -> x > 0.25), true)", "boolean"),
    })


@register("q_fn_time")
def q_fn_time(spark, sf_dir):
    return _family(table(spark, sf_dir, "events"), ["event_id"], {
        "day": ("CAST(date_trunc('DAY', ts) AS DATE)", "date"),
        "hour_of_day": ("hour(ts)", "int"),
        "minute": ("minute(ts)", "int"),
        "weekday": ("dayofweek(ts)", "int"),
    })


@register("q_fn_map")
def q_fn_map(spark, sf_dir):
    return _family(table(spark, sf_dir, "events"), ["event_id"], {
        "type_from_map": ("map('type', event_type, 'props', props)['type']", "string"),
        "n_keys": ("size(map_keys(map('type', event_type, 'props', props)))", "int"),
        "props_from_map": ("element_at(map('type', event_type, 'props', props), 'props')", "string"),
    })


@register("q_fn_json")
def q_fn_json(spark, sf_dir):
    return _family(table(spark, sf_dir, "events"), ["event_id"], {
        "k": ("get_json_object(props, '$.k')", "int"),
        "k_struct": ("from_json(props, 'k INT').k", "int"),
        "missing": ("get_json_object(props, '$.absent')", "string"),
    })


# --------------------------------------------------------------------------
# Features and scoring
# --------------------------------------------------------------------------


@register("q_feature_array")
def q_feature_array(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return feature_array(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]).select(
        "l_orderkey", "l_linenumber", "features"
    )


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minimum slice: encode, parse, derive, prune, score."""
    parsed = parse_messages(event_messages(spark, sf_dir), configs.EVENT_SCHEMA)
    model_cfg = dict(configs.EVENT_MODEL, with_identity=True)
    return score(parsed, model_cfg, model=ThresholdRule("value", 50.0))


@register("q_score_rule")
def q_score_rule(spark, sf_dir):
    scored = scored_events(spark, sf_dir)
    return scored.groupBy("event_type", "prediction", "model_name", "model_version").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.round(F.sum("value_k"), 4).alias("sum_value_k"),
    )


@register("q_score_rows")
def q_score_rows(spark, sf_dir):
    return scored_events(spark, sf_dir).select("event_id", "value", "k", "prediction")


@register("q_score_category")
def q_score_category(spark, sf_dir):
    """A model over a text feature and a number: both reach the model in
    their own types (one pandas frame per Arrow batch)."""
    parsed = parse_messages(event_messages(spark, sf_dir), configs.EVENT_SCHEMA)
    cfg = {"features": ["event_type", "value"]}
    scored = score(parsed, cfg, model=CategoryRule("event_type", ["error", "purchase"]))
    return scored.groupBy("event_type", "prediction").agg(F.count(F.lit(1)).alias("n_events"))


def _model_files(spark: SparkSession, name: str, models: dict) -> dict[str, str]:
    """Pickled models as files below the shared folder: ``{key: path}``.
    Every model of one call has the same base name."""
    import pickle

    folder = shared_dir(spark, name)
    return {key: write_file(spark, f"{folder}/{key}/model.pkl", pickle.dumps(model)) for key, model in models.items()}


@register("q_score_file")
def q_score_file(spark, sf_dir):
    """U1 + U2 as a job file has them: a pickled model by its path."""
    path = _model_files(spark, "q_score_file", {"v1": ThresholdRule("value", 75.0)})["v1"]
    events = table(spark, sf_dir, "events")
    return score(events, {"path": path, "features": ["value"]}).select("event_id", "value", "prediction")


@register("q_score_shipped")
def q_score_shipped(spark, sf_dir):
    """Two versions of a model with one file name, copied to the executors."""
    paths = _model_files(spark, "q_score_shipped", {"v1": ThresholdRule("value", 25.0), "v2": ThresholdRule("value", 90.0)})
    out = table(spark, sf_dir, "events")
    for version, path in paths.items():
        out = score(out, {"path": path, "features": ["value"], "ship": True}, output_col=version)
    return out.select("event_id", "v1", "v2")


def _load_cutoff(path: str) -> float:
    with open(path, encoding="utf-8") as fh:
        return float(fh.read())


def _predict_cutoff(cutoff: float, features) -> object:
    return (features["value"] <= cutoff).astype("int32")


@register("q_score_custom")
def q_score_custom(spark, sf_dir):
    """A model flavour of one's own (a cutoff in a text file)."""
    register_loader("cutoff_text", _load_cutoff, _predict_cutoff)
    path = write_file(spark, f"{shared_dir(spark, 'q_score_custom')}/cutoff.txt", b"60.5")
    cfg = {"type": "cutoff_text", "path": path, "features": ["value"]}
    return score(table(spark, sf_dir, "events"), cfg).select("event_id", "prediction")


def _native_model(spark: SparkSession, name: str, rule: str) -> str:
    """A saved ``PipelineModel`` whose only stage is a SQL rule."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer

    stage = SQLTransformer(statement=f"SELECT *, CAST({rule} AS DOUBLE) AS prediction FROM __THIS__")
    return save_model(PipelineModel([stage]), shared_dir(spark, name, "model"))


@register("q_score_native")
def q_score_native(spark, sf_dir):
    """U3 + K9: a saved pipeline, reloaded by path and run in the JVM."""
    path = _native_model(spark, "q_score_native", "CASE WHEN l_quantity > 25 AND l_discount > 0.05 THEN 1 ELSE 0 END")
    cfg = {"type": "spark_mllib", "path": path, "features": ["l_quantity", "l_discount"]}
    scored = score(table(spark, sf_dir, "lineitem"), cfg)
    return scored.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "prediction")


@register("q_assemble")
def q_assemble(spark, sf_dir):
    """Features as an ML vector, shown as an array."""
    from pyspark.ml.functions import vector_to_array

    li = assemble(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_tax", "l_discount"])
    return li.select("l_orderkey", "l_linenumber", vector_to_array("features_vector").alias("features"))


@register("q_job_columns")
def q_job_columns(spark, sf_dir):
    """K8 + U3 by a job file: the native route adds vector columns, the sink
    section names the columns that a CSV file can hold."""
    out = shared_dir(spark, "q_job_columns")
    path = _native_model(spark, "q_job_columns", "CASE WHEN value > 50 AND k > 3 THEN 1 ELSE 0 END")
    cfg = dict(stream_job_config(sf_dir, out), sink={
        "format": "csv", "columns": ["event_id", "value", "prediction"], "options": {"path": f"{out}/data", "header": "true"}})
    cfg["source"]["path"] = f"{sf_dir.rstrip('/')}/events.parquet"
    cfg["model"] = {"type": "spark_mllib", "path": path, "features": ["value", "k"], "handle_invalid": "keep"}
    job.run_batch(spark, cfg)
    return spark.read.schema("event_id long, value double, prediction double").csv(f"{out}/data", header=True)


@register("q_parse_case")
def q_parse_case(spark, sf_dir):
    """Keys that differ only in case are different keys."""
    events = table(spark, sf_dir, "events", spread_rows=True)
    text = F.concat(F.lit('{"v": '), F.col("value"), F.lit(', "V": '), F.col("user_id"), F.lit(', "id": '), F.col("event_id"),
                    F.lit("}"))
    cfg = {"event_id": {"path": "id", "type": "long"}, "small": {"path": "v", "type": "double"},
           "large": {"path": "V", "type": "long"}}
    return parse_messages(events.select(text.alias("value")), cfg)


THRESHOLD_WEIGHTS = {"l_quantity": 0.02, "l_discount": 5.0}
THRESHOLD_BIAS = -0.75


@register("q_score_threshold")
def q_score_threshold(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    cfg = {"features": ["l_quantity", "l_discount"], "threshold": 0.0}
    return score(li, cfg, model=LinearScore(THRESHOLD_WEIGHTS, THRESHOLD_BIAS)).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "prediction"
    )


@register("q_score_double")
def q_score_double(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    cfg = {"features": ["l_quantity", "l_discount"], "result_type": "double"}
    scored = score(li, cfg, model=LinearScore(THRESHOLD_WEIGHTS, THRESHOLD_BIAS))
    return scored.select("l_orderkey", "l_linenumber", F.round("prediction", 6).alias("prediction"))


# --------------------------------------------------------------------------
# Class counts and class filters
# --------------------------------------------------------------------------



@register("q_class_counts")
def q_class_counts(spark, sf_dir):
    return class_counts(table(spark, sf_dir, "lineitem"), "l_returnflag")


@register("q_label_counts")
def q_label_counts(spark, sf_dir):
    return class_counts(table(spark, sf_dir, "labels"), "toxic")


@register("q_class_filter")
def q_class_filter(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"
    )
    features, _ = split_features_label(filter_class(li, "l_returnflag", "R"), "l_returnflag")
    return features


# --------------------------------------------------------------------------
# A1: stratified split
# --------------------------------------------------------------------------

# The original's split (80 % train, seed 42) and the 20 %
# minority share of its high-volume producer.
SPLIT_SEED = 42


@register("q_split")
def q_split(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return stratified_split(labels, "toxic", ["doc_id"], train_percent=80, seed=SPLIT_SEED)


@register("q_hash_split")
def q_hash_split(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    out = hash_split(events, ["event_id"], train_percent=80, seed=SPLIT_SEED)
    return out.groupBy("event_type", "split").agg(F.count(F.lit(1)).alias("n_rows"))


@register("q_split_events")
def q_split_events(spark, sf_dir):
    events = table(spark, sf_dir, "events", spread_rows=True).select("event_id", "event_type", "value")
    split = stratified_split(events, "event_type", ["event_id"], train_percent=80, seed=SPLIT_SEED)
    return split.groupBy("event_type", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 4).alias("sum_value")
    )


# --------------------------------------------------------------------------
# A5: rebalancing
# --------------------------------------------------------------------------

TOXIC_SHARES = {0: 0.8, 1: 0.2}  # fixed value: 20 % minority share (see above)


@register("q_rebalance")
def q_rebalance(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return rebalance(labels, "toxic", TOXIC_SHARES, ["doc_id"], seed=SPLIT_SEED).select(
        "doc_id", "toxic", "copy"
    )


@register("q_rebalance_exact")
def q_rebalance_exact(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return rebalance(labels, "toxic", TOXIC_SHARES, ["doc_id"], seed=SPLIT_SEED, exact=True).select(
        "doc_id", "toxic", "copy"
    )


@register("q_rebalance_counts")
def q_rebalance_counts(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    out = rebalance(labels, "toxic", TOXIC_SHARES, ["doc_id"], seed=SPLIT_SEED)
    return class_counts(out, "toxic")


# --------------------------------------------------------------------------
# A3: evaluation report (labels joined with a rule over documents)
# --------------------------------------------------------------------------

REPORT_MIN_CHARS = 5000


def labelled_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with the rule's prediction from the joined document.

    Labels are first reduced to one row per (doc_id, toxic) with a count
    (partial aggregation map-side), so a document labelled many times is a
    single row on the join's shuffle and can never make a hot key."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id", "toxic").agg(
        F.count(F.lit(1)).alias("n_labels"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    joined = labels.join(docs, "doc_id", "inner")
    return joined.withColumn(
        "prediction", F.when(F.col("n_chars") > REPORT_MIN_CHARS, 1).otherwise(0)
    )


@register("q_report")
def q_report(spark, sf_dir):
    return classification_report(labelled_predictions(spark, sf_dir), "toxic", "prediction",
                                 weight_col="n_labels")


# --------------------------------------------------------------------------
# Script variables in pages, timelines and their means
# --------------------------------------------------------------------------



@register("q_page_vars")
def q_page_vars(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        "page_id",
        script_value(F.col("html"), "t").alias("t_value"),
        call_argument(F.col("html"), "track").try_cast("int").alias("track_arg"),
    )


PAGE_MARK = "<!--page:"


@register("q_page_files")
def q_page_files(spark, sf_dir):
    """S7 + A8: pages saved as documents (a bounded number of pages in each,
    told apart by a mark), read back whole-text and cut into pages.  A page
    without an id has a mark without one; a mark in a page's own text is
    written with a ``;`` more before its colon, which reading takes off."""
    from ..sources.files import read_documents
    from ..streaming.sinks import write_batch

    out = shared_dir(spark, "q_page_files")
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit(PAGE_MARK), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("-->"),
                 F.regexp_replace(F.coalesce("html", F.lit("")), "<!--page(;*):", "<!--page;$1:")).alias("value"))
    write_batch(pages, {"format": "text", "options": {"path": out, "maxRecordsPerFile": 256}})
    saved = read_documents(spark, f"{out}/*.txt")
    parts = saved.select(F.explode(F.split("html", PAGE_MARK)).alias("part")).filter("part <> ''")
    docs = parts.select(F.nullif(F.substring_index("part", "-->", 1), F.lit("")).cast("long").alias("page_id"),
                        F.regexp_replace(F.regexp_replace("part", r"\A-?\d*-->", ""),
                                         "<!--page;(;*):", "<!--page$1:").alias("html"))
    return docs.select(
        "page_id",
        script_value(F.col("html"), "t").alias("t_value"),
        call_argument(F.col("html"), "track").try_cast("int").alias("track_arg"),
    )


@register("q_track_mean")
def q_track_mean(spark, sf_dir):
    pages = q_page_vars(spark, sf_dir)
    return pages.agg(
        F.count("track_arg").alias("n_pages"),
        F.round(F.avg("track_arg"), 6).alias("mean_track"),
    )


TIMELINE_CHUNK = 1024


def event_timeline_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events drawn as statistics pages: every block of ``TIMELINE_CHUNK``
    consecutive rows of a scan partition is one page whose charts v1..v4
    plot value, k, user_id and event_id over time, and whose v5 chart has
    one entry per event keyed by its type.  A page never holds more than
    ``TIMELINE_CHUNK`` rows, whatever the key distribution."""
    # Positions are taken on the file scan itself, whose row order is fixed,
    # so a recomputed task rebuilds the same pages; the id keeps the scan
    # partition in its high bits, so a block never spans partitions and
    # holds at most TIMELINE_CHUNK rows.
    scan = table(spark, sf_dir, "events").withColumn("_pos", F.monotonically_increasing_id())
    events = spread_scan(scan).withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    x = F.date_format("ts", "HH:mm:ss.SSSSSS")

    def chart(y):
        return F.collect_list(F.struct(x.alias("x"), y.alias("y")))

    block = F.floor(F.col("_pos") / TIMELINE_CHUNK).alias("page")
    pages = events.groupBy(block).agg(
        chart(F.col("value")).alias("v1"),
        chart(F.col("k")).alias("v2"),
        chart(F.col("user_id")).alias("v3"),
        chart(F.col("event_id")).alias("v4"),
        F.collect_list(F.create_map(F.lit("x"), x, F.col("event_type"), F.col("value").cast("string"))).alias("v5"),
    )
    body = [F.lit("<html><head><script>")]
    for var in ("v1", "v2", "v3", "v4", "v5"):
        body += [F.lit(f"var {var} = "), unquote_keys(F.to_json(F.col(var))), F.lit(";\n")]
    body.append(F.lit("</script></head><body></body></html>"))
    return pages.select("page", F.concat(*body).alias("html"))


@register("q_timeline_mean")
def q_timeline_mean(spark, sf_dir):
    return timeline_means(event_timeline_pages(spark, sf_dir), decimals=6)


@register("q_operation_mean")
def q_operation_mean(spark, sf_dir):
    return operation_means(event_timeline_pages(spark, sf_dir), decimals=2)


# --------------------------------------------------------------------------
# A10: telemetry-style summary (mean, min, max, percentiles, totals)
# --------------------------------------------------------------------------



@register("q_metric_summary")
def q_metric_summary(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("int")
    )
    out = summarize(events, ["value", "k"], group_cols=["event_type"], percentiles=[0.07, 0.5, 0.55, 0.95, 0.999])
    return out.select(
        "event_type", "metric", "n",
        F.round("mean", 6).alias("mean"), "min", "max",
        F.round("total", 4).alias("total"), "p7", "p50", "p55", "p95", "p99_9",
    )


# --------------------------------------------------------------------------
# The scoring job as a stream over the events files
# --------------------------------------------------------------------------


def stream_job_config(sf_dir: str, out_dir: str, *, sink: dict | None = None) -> dict:
    return {
        "source": {
            "format": "parquet",
            "path": f"{sf_dir.rstrip('/')}/events*.parquet",
            "encode": ["event_id", "ts", "user_id", "event_type", "value", "props"],
        },
        "schema": configs.EVENT_SCHEMA,
        "model": configs.EVENT_MODEL,
        "sink": sink or {
            "format": "parquet",
            "mode": "append",
            "checkpointLocation": f"{out_dir}/_checkpoint",
            "options": {"path": f"{out_dir}/data"},
            "trigger": {"availableNow": True},
        },
    }


def _run_stream(spark, cfg, name):
    query = job.start(spark, cfg, model=ThresholdRule("value", 50.0), query_name=name)
    run_until_done(query)
    return query


def _message_files_config(spark, sf_dir, out) -> dict:
    """A job over the events as message files, with as many files in a
    micro-batch as there are cores.  There are at least twice as many files,
    so the stream takes several batches, and many for a large table."""
    cores = spark.sparkContext.defaultParallelism
    write_message_files(spread_scan(table(spark, sf_dir, "events"), 2 * cores), EVENT_COLUMNS, f"{out}/topic")
    cfg = stream_job_config(sf_dir, out)
    cfg["source"] = {"format": "text", "path": f"{out}/topic", "max_files_per_trigger": cores}
    return cfg


# A message file of q_telemetry_rows holds about so many events.
TELEMETRY_ROWS = 1_000_000


def _telemetry_files(rows: int) -> int:
    """Message files for so many events: several, more for a large table."""
    return 8 + rows // TELEMETRY_ROWS


def _batch_of_event(files: int):
    """The message file of an event: its id modulo their number (null: 0)."""
    return F.coalesce(F.pmod("event_id", F.lit(files)), F.lit(0)).cast("int")


def _logged_stream(spark, cfg) -> DataFrame:
    """Run a stream to its end; the table of all its progress reports."""
    with ProgressLog(spark) as log:
        query = _run_stream(spark, cfg, None)
        log.wait_for_end(query)
        return progress_frame(spark, log.table(query))


@register("q_stream_parquet")
def q_stream_parquet(spark, sf_dir):
    out = shared_dir(spark, "q_stream_parquet")
    cfg = stream_job_config(sf_dir, out)
    _run_stream(spark, cfg, None)
    return spark.read.parquet(f"{out}/data").select("event_id", "value", "k", "prediction")


@register("q_stream_bytes")
def q_stream_bytes(spark, sf_dir):
    """Micro-batches admitted by size, about a fifth of the message
    files' bytes each."""
    out = shared_dir(spark, "q_stream_bytes")
    cfg = _message_files_config(spark, sf_dir, out)
    folder = spark._jvm.org.apache.hadoop.fs.Path(cfg["source"]["path"])
    size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    cfg["source"] = {"format": "text", "path": cfg["source"]["path"], "max_bytes_per_trigger": max(1, size // 5)}
    _run_stream(spark, cfg, None)
    return spark.read.parquet(f"{out}/data").select("event_id", "value", "k", "prediction")


@register("q_stream_restart")
def q_stream_restart(spark, sf_dir):
    """The same query run twice on one checkpoint: the restart finds no new
    input and the sink holds every row exactly once."""
    out = shared_dir(spark, "q_stream_restart")
    cfg = stream_job_config(sf_dir, out)
    _run_stream(spark, cfg, None)
    _run_stream(spark, cfg, None)
    return spark.read.parquet(f"{out}/data").select("event_id", "value", "k", "prediction")


@register("q_stream_trigger")
def q_stream_trigger(spark, sf_dir):
    """K6 with a periodic trigger: the query runs on a processing-time
    schedule until everything available is processed, then is stopped."""
    out = shared_dir(spark, "q_stream_trigger")
    cfg = stream_job_config(sf_dir, out)
    cfg["sink"]["trigger"] = {"processingTime": "1 second"}
    expected = table(spark, sf_dir, "events").count()  # from the file footers
    with ProgressLog(spark) as log:
        query = job.start(spark, cfg, model=ThresholdRule("value", 50.0))
        try:
            log.wait_for_rows(query, expected)
        finally:
            query.stop()
    return spark.read.parquet(f"{out}/data").select("event_id", "value", "k", "prediction")


@register("q_stream_batches")
def q_stream_batches(spark, sf_dir):
    """foreachBatch with the batch writer; each micro-batch replaces its own
    batch_id partition, so a replayed batch is not duplicated."""
    out = shared_dir(spark, "q_stream_batches")
    cfg = stream_job_config(sf_dir, out)
    scored = job.build(spark, cfg, model=ThresholdRule("value", 50.0))
    writer = foreach_batch_writer("parquet", {"path": f"{out}/data"}, idempotent=True)
    sink = {"checkpointLocation": f"{out}/_checkpoint", "trigger": {"availableNow": True}}
    run_until_done(write_stream(scored, sink, foreach=writer))
    return spark.read.parquet(f"{out}/data").select("event_id", "value", "k", "prediction")


@register("q_telemetry")
def q_telemetry(spark, sf_dir):
    """Progress reports of a scoring stream as a telemetry table."""
    out = shared_dir(spark, "q_telemetry")
    return _logged_stream(spark, stream_job_config(sf_dir, out)).select(
        "batch_id", "Timestamp", "Batch_Duration_ms", "Input_Rows",
        "input_rows_per_second", "processed_rows_per_second",
    )


@register("q_telemetry_rows")
def q_telemetry_rows(spark, sf_dir):
    """A9 + A10: batches, rows and median rows of a batch in the telemetry of
    a stream of several batches, over the run and a restart that finds
    nothing new.  Each message file is a batch, and its rows follow from the
    table alone (:func:`_batch_of_event`)."""
    out = shared_dir(spark, "q_telemetry_rows")
    events = table(spark, sf_dir, "events")
    files = _telemetry_files(events.count())  # from the file footers
    write_message_files(events.repartitionById(files, _batch_of_event(files)), EVENT_COLUMNS, f"{out}/topic")
    cfg = stream_job_config(sf_dir, out)
    cfg["source"] = {"format": "text", "path": f"{out}/topic", "max_files_per_trigger": 1}
    with ProgressLog(spark, reports_per_file=2) as log:
        for _ in range(2):
            query = _run_stream(spark, cfg, None)
            log.wait_for_end(query)
        telemetry = progress_frame(spark, log.table(query)).filter(F.col("Input_Rows") > 0)
    return summarize(telemetry, ["Input_Rows"], percentiles=[0.5]).select(
        "metric", "n", "total", "p50", (F.col("n") > 1).alias("several"))


# --------------------------------------------------------------------------
# A1 + A2 + K9 + U3 + A3: train, persist, reload, score, report
# --------------------------------------------------------------------------


ML_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("q_mllib")
def q_mllib(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", *ML_FEATURES,
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("returned"),
    )
    split = stratified_split(li, "returned", ["l_orderkey", "l_linenumber"], seed=SPLIT_SEED)
    # training takes several passes over its rows: they read what was split once
    split = written_table(split.select(*ML_FEATURES, "returned", "split"), "train-split")
    train = split.filter(F.col("split") == "train")
    test = split.filter(F.col("split") == "test")
    model = train_random_forest(train, ML_FEATURES, "returned", num_trees=20, max_depth=5, seed=42)
    path = save_model(model, shared_dir(spark, "q_mllib", "model"))
    scored = score_mllib(test, {"features": ML_FEATURES}, pipeline_model=load_model(path))
    return classification_report(scored, "returned", "prediction")


@register("q_mllib_support")
def q_mllib_support(spark, sf_dir):
    """The counts of the forest's report: exact by the split's quotas."""
    report = q_mllib(spark, sf_dir)
    return report.filter("label IN ('0', '1', 'accuracy')").select("label", "support")


@register("q_forest_rules")
def q_forest_rules(spark, sf_dir):
    """Rows in which the compiled forest and the model's own
    ``transform`` disagree, by class or by any vote."""
    from pyspark.ml.functions import vector_to_array

    li = table(spark, sf_dir, "lineitem").select(*ML_FEATURES, F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("returned"))
    path = save_model(train_random_forest(li, ML_FEATURES, "returned"), shared_dir(spark, "q_forest_rules"))
    own = score_mllib(li, {"features": ML_FEATURES, "path": path}, output_col="own_class")
    both = score_forest(own, forest_from_saved(spark, path), ML_FEATURES, votes_col="votes")
    differs = (F.col("prediction") != F.col("own_class")) | (F.col("votes") != vector_to_array("rawPrediction"))
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(differs).alias("disagree"))


# A booster of three trees in the JSON form of its library: missing values,
# a shared threshold, leaves of either sign.
def _booster_file(objective: str) -> str:
    def tree(left, right, feature, number, default):
        return {"left_children": left, "right_children": right, "split_indices": feature, "split_conditions": number,
                "default_left": default, "split_type": [0] * len(left)}

    trees = [tree([1, 3, -1, -1, -1], [2, 4, -1, -1, -1], [0, 1, 0, 0, 0], [25.0, 0.0625, -0.5, 0.25, 0.75], [1, 0, 0, 0, 0]),
             tree([1, -1, -1], [2, -1, -1], [2, 0, 0], [0.03125, -0.125, 0.5], [0, 0, 0]), tree([-1], [-1], [0], [0.0625], [0])]
    return json.dumps({"learner": {
        "learner_model_param": {"base_score": "5E-1", "num_class": "0", "num_feature": "3"}, "objective": {"name": objective},
        "gradient_booster": {"name": "gbtree", "model": {"trees": trees, "tree_info": [0, 0, 0]}}}, "version": [2, 0, 0]})


@register("q_score_booster")
def q_score_booster(spark, sf_dir):
    """A booster's JSON file as column expressions; every seventh
    quantity is missing."""
    path = write_file(spark, f"{shared_dir(spark, 'q_score_booster')}/model.json", _booster_file("binary:logistic").encode("utf-8"))
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 7 > 0, F.col("l_quantity")).alias("quantity"), "l_discount", "l_tax")
    cfg = {"type": "xgboost_native", "path": path, "features": ["quantity", "l_discount", "l_tax"], "result_type": "double"}
    scored = score(rows, cfg)
    return scored.select("l_orderkey", "l_linenumber", F.round("prediction", 9).alias("score"))


@register("q_csv_infer")
def q_csv_infer(spark, sf_dir):
    """S6 with inferred types, as an exported table without a schema has."""
    from ..sources.files import read_csv_table
    from ..streaming.sinks import write_batch

    out = shared_dir(spark, "q_csv_infer")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    write_batch(li, {"format": "csv", "options": {"path": out, "header": "true"}})
    return read_csv_table(spark, out, infer_schema=True).select(
        F.col("l_orderkey").cast("long").alias("l_orderkey"), "l_linenumber", "l_extendedprice", "l_returnflag")


def _stream_into(spark, sf_dir, fmt: str, **keys) -> DataFrame:
    out = shared_dir(spark, f"q_stream_{fmt}")
    sink = {"format": fmt, "columns": ["event_id", "value", "k", "prediction"], "checkpointLocation": f"{out}/_checkpoint",
            "options": {"path": f"{out}/data", "header": "true"}, "trigger": {"availableNow": True}, **keys}
    _run_stream(spark, stream_job_config(sf_dir, out, sink=sink), None)
    schema = "event_id long, value double, k int, prediction int"
    return spark.read.schema(schema).format(fmt).option("header", "true").load(f"{out}/data").select(
        "event_id", "value", "k", "prediction")


@register("q_stream_json")
def q_stream_json(spark, sf_dir):
    return _stream_into(spark, sf_dir, "json")


@register("q_stream_csv")
def q_stream_csv(spark, sf_dir):
    return _stream_into(spark, sf_dir, "csv")


@register("q_stream_replace")
def q_stream_replace(spark, sf_dir):
    """The idempotent file sink by its section."""
    return _stream_into(spark, sf_dir, "parquet", idempotent=True)


@register("q_csv_table")
def q_csv_table(spark, sf_dir):
    """S6 + K8: a table written as CSV with a header by the batch sink and
    read back with a declared schema (no inference pass)."""
    from ..sources.files import read_csv_table
    from ..streaming.sinks import write_batch

    out = shared_dir(spark, "q_csv_table")
    labels = table(spark, sf_dir, "labels")
    write_batch(labels, {"format": "csv", "options": {"path": out, "header": "true"}})
    return read_csv_table(spark, out, schema=labels.schema)


@register("q_stream_text")
def q_stream_text(spark, sf_dir):
    """Messages as JSON-lines files (the stand-in for a topic): the events
    are written once as message text, then streamed, parsed and scored."""
    out = shared_dir(spark, "q_stream_text")
    write_message_files(table(spark, sf_dir, "events"), EVENT_COLUMNS, f"{out}/topic", mode="overwrite")
    cfg = stream_job_config(sf_dir, out)
    cfg["source"] = {"format": "text", "path": f"{out}/topic"}
    _run_stream(spark, cfg, None)
    return spark.read.parquet(f"{out}/data").select("event_id", "value", "k", "prediction")


@register("q_parse_errors")
def q_parse_errors(spark, sf_dir):
    """Dead-letter view: error events carry an unparsable value, signup
    events a whole message behind a stray leading character (not JSON);
    bad fields are listed, nothing fails."""
    events = table(spark, sf_dir, "events", spread_rows=True)
    value = F.when(F.col("event_type") == "error", F.concat(F.col("value").cast("string"), F.lit("x"))) \
        .otherwise(F.col("value").cast("string"))
    msgs = events.select(message_text([F.col("event_id"), F.col("event_type"), value.alias("value"),
                                       F.col("props")]).alias("_m"), "event_type") \
        .select(F.when(F.col("event_type") == "signup", F.concat(F.lit("#"), F.col("_m")))
                .otherwise(F.col("_m")).alias("value"))
    cfg = {
        "event_id": {"path": "event_id", "type": "long"},
        "event_type": {"path": "event_type", "type": "string"},
        "value": {"path": "value", "type": "double"},
    }
    parsed = parse_messages(msgs, cfg, error_col="errors")
    return parsed.groupBy(F.coalesce("event_type", F.lit("(unparsed)")).alias("event_type")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.array_contains("errors", "value").cast("int")).alias("n_bad_value"),
        F.sum(F.array_contains("errors", "_message").cast("int")).alias("n_bad_message"),
        F.round(F.sum("value"), 4).alias("sum_value"),
    )


@register("q_telemetry_summary")
def q_telemetry_summary(spark, sf_dir):
    """A10 over A9: summary of the batch telemetry of a scoring stream that
    reads the events as message files."""
    out = shared_dir(spark, "q_telemetry_summary")
    cfg = _message_files_config(spark, sf_dir, out)
    tele = _logged_stream(spark, cfg).filter(F.col("Input_Rows") > 0)
    return summarize(tele, ["Batch_Duration_ms", "Input_Rows"])


@register("q_telemetry_operations")
def q_telemetry_operations(spark, sf_dir):
    """A7 from A9: mean duration of each streaming operation over the
    micro-batches of a scoring stream over the events message files."""
    out = shared_dir(spark, "q_telemetry_operations")
    cfg = _message_files_config(spark, sf_dir, out)
    return operation_means_from_progress(_logged_stream(spark, cfg))


@register("q_parse_records")
def q_parse_records(spark, sf_dir):
    """Kafka-shaped records (key + JSON value, as the producer side writes
    them): parse the value and keep the record key next to the columns."""
    events = table(spark, sf_dir, "events", spread_rows=True)
    records = to_kafka_records(events, key="event_id", columns=EVENT_COLUMNS)
    parsed = parse_messages(records, _EVENT_BASE, passthrough=["key"])
    return parsed.select("event_id", "event_type", "value", F.col("key").cast("string").alias("record_key"))
