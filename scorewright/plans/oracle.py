"""DuckDB SQL twins of the registered queries.

Each statement reads the driver's tables (pre-registered views) and
computes the rows its Spark query returns, with the same column names.
"""

from __future__ import annotations

from ..functions.hashing import hash32_sql
from . import catalog

_W = catalog.THRESHOLD_WEIGHTS
_SCORE_SQL = f"(({catalog.THRESHOLD_BIAS} + {_W['l_quantity']} * l_quantity) + {_W['l_discount']} * l_discount)"

SQL: dict[str, str] = {
    "q_encode": """
        SELECT event_id,
               CAST(json_object('event_id', event_id, 'user_id', user_id,
                                'event_type', event_type, 'props', props) AS VARCHAR) AS message
        FROM events""",
    "q_parse": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "q_parse_path": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "q_parse_nested": """
        SELECT event_id, event_type,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               value AS first_value,
               event_type AS body_key
        FROM events""",
    "q_parse_trie": """
        SELECT l_orderkey AS orderkey, l_linenumber AS line, l_quantity AS quantity, l_tax AS tax,
               CAST(NULL AS DOUBLE) AS beyond, l_partkey AS partkey, 'supp ' || l_returnflag AS supplier,
               '[' || l_partkey || ',' || l_suppkey || ']' AS all_keys, '"' || l_linestatus || '"' AS status,
               l_returnflag AS flag, CAST(NULL AS VARCHAR) AS absent
        FROM lineitem""",
    "q_derive": """
        SELECT event_id, ts, user_id, event_type, value,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               value * CAST(json_extract_string(props, '$.k') AS INTEGER) AS value_k
        FROM events""",
    "q_prune": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
               l_returnflag,
               l_extendedprice * (1 - l_discount) AS disc_price,
               (l_extendedprice * (1 - l_discount)) * (1 + l_tax) AS charge,
               CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS is_open,
               CAST(trunc(l_quantity) AS INTEGER) AS qty_int
        FROM lineitem""",
    "q_parse_struct": """
        SELECT CAST(event_id AS DOUBLE) AS event_id, CAST(NULL AS INTEGER) AS k_text,
               value, event_type, CAST(user_id AS DOUBLE) AS user_id, props
        FROM events""",
    "q_fn_arith": """
        SELECT l_orderkey, l_linenumber,
               l_extendedprice * (1 - l_discount) AS disc_price,
               l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge,
               l_quantity * 2 AS qty_x2,
               l_linenumber % 3 AS line_mod,
               l_orderkey // 10 AS order_div
        FROM lineitem""",
    "q_fn_cond": """
        SELECT event_id,
               CASE WHEN value > 100 THEN 1 ELSE 0 END AS big,
               CASE WHEN event_type IN ('click', 'view') THEN 'browse'
                    WHEN event_type = 'purchase' THEN 'buy' ELSE 'other' END AS kind,
               coalesce(CASE WHEN value > 200 THEN NULL ELSE value END, 0.0) AS v_or_zero,
               event_type = 'error' AS is_error
        FROM events""",
    "q_fn_math": """
        SELECT l_orderkey, l_linenumber,
               round(sqrt(l_extendedprice), 6) AS sqrt_price,
               abs(l_tax - 0.04) AS abs_tax,
               round(ln(1 + l_quantity), 6) AS ln_qty,
               CAST(floor(l_extendedprice / 1000) AS BIGINT) AS floor_k,
               CAST(ceil(l_extendedprice / 1000) AS BIGINT) AS ceil_k,
               round(pow(l_discount, 2), 8) AS disc_sq
        FROM lineitem""",
    "q_fn_string": """
        SELECT c_custkey,
               upper(c_mktsegment) AS seg_upper,
               lower(c_mktsegment) AS seg_lower,
               substring(c_name, 10) AS name_digits,
               CAST(length(c_name) AS INTEGER) AS name_len,
               concat_ws('-', c_mktsegment, CAST(c_nationkey AS VARCHAR)) AS tag,
               replace(c_name, 'Customer#', 'C') AS short_name
        FROM customer""",
    "q_fn_date": """
        SELECT o_orderkey,
               CAST(year(o_orderdate) AS INTEGER) AS o_year,
               CAST(month(o_orderdate) AS INTEGER) AS o_month,
               CAST(day(o_orderdate) AS INTEGER) AS o_day,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
               CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days_since
        FROM orders""",
    "q_fn_array": """
        SELECT vec_id,
               CAST(len(embedding) AS INTEGER) AS dim,
               CAST(embedding[1] AS DOUBLE) AS first_x,
               CAST(list_max(embedding) AS DOUBLE) AS max_x,
               round(list_reduce(list_prepend(0.0::DOUBLE,
                     list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))),
                     lambda acc, y: acc + y), 6) AS sq_norm,
               CAST(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS n_pos,
               list_contains(list_transform(embedding, lambda x: x > 0.25), true) AS has_big
        FROM embeddings""",
    "q_fn_time": """
        SELECT event_id,
               CAST(date_trunc('day', ts) AS DATE) AS day,
               CAST(hour(ts) AS INTEGER) AS hour_of_day,
               CAST(minute(ts) AS INTEGER) AS minute,
               CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday
        FROM events""",
    "q_fn_map": """
        SELECT event_id,
               event_type AS type_from_map,
               2 AS n_keys,
               props AS props_from_map
        FROM events""",
    "q_fn_json": """
        SELECT event_id,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_struct,
               CAST(NULL AS VARCHAR) AS missing
        FROM events""",
    "q_feature_array": """
        SELECT l_orderkey, l_linenumber,
               [l_quantity, l_extendedprice, l_discount, l_tax] AS features
        FROM lineitem""",
    "q_score_rule": """
        SELECT event_type,
               CASE WHEN value > 50 THEN 1 ELSE 0 END AS prediction,
               'value_rule' AS model_name, 'v1' AS model_version,
               count(*) AS n_events,
               round(sum(value * CAST(json_extract_string(props, '$.k') AS INTEGER)), 4) AS sum_value_k
        FROM events GROUP BY 1, 2""",
    "q_score_rows": """
        SELECT event_id, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               CASE WHEN value > 50 THEN 1 ELSE 0 END AS prediction
        FROM events""",
    "q_score_threshold": f"""
        SELECT l_orderkey, l_linenumber, l_quantity, l_discount,
               CASE WHEN {_SCORE_SQL} >= 0.0 THEN 1 ELSE 0 END AS prediction
        FROM lineitem""",
    "q_score_double": f"""
        SELECT l_orderkey, l_linenumber, round({_SCORE_SQL}, 6) + 0.0 AS prediction
        FROM lineitem""",
}


_H_DOC = hash32_sql("doc_id", catalog.SPLIT_SEED)
_H_EVENT = hash32_sql("event_id", catalog.SPLIT_SEED)


def _split_sql(source: str, label: str, key: str, h: str, cols: str) -> str:
    return f"""
        SELECT {cols},
               CASE WHEN row_number() OVER (PARTITION BY {label} ORDER BY {h}, {key})
                         <= (count(*) OVER (PARTITION BY {label}) * 80) // 100
                    THEN 'train' ELSE 'test' END AS split
        FROM {source}"""


def _rebalance_sql() -> str:
    shares = catalog.TOXIC_SHARES
    share = " ".join(f"WHEN toxic = {k} THEN CAST({v} AS DOUBLE)" for k, v in shares.items())
    return f"""
        WITH c AS (SELECT toxic AS t, count(*) AS n_c FROM labels GROUP BY toxic),
             w AS (SELECT l.doc_id, l.toxic,
                          CAST(floor((CASE {share} END) * (SELECT count(*) FROM labels) / c.n_c
                                     + {_H_DOC} / 4294967296.0) AS BIGINT) AS copies
                   FROM labels l JOIN c ON l.toxic = c.t)
        SELECT doc_id, toxic, CAST(r.copy AS BIGINT) AS copy
        FROM w, unnest(range(1, copies + 1)) AS r(copy)
        WHERE copies > 0"""


SQL.update({
    "q_class_counts": """
        SELECT l_returnflag, count(*) AS n_rows,
               round(count(*) / sum(count(*)) OVER (), 6) AS share
        FROM lineitem GROUP BY l_returnflag""",
    "q_label_counts": """
        SELECT toxic, count(*) AS n_rows,
               round(count(*) / sum(count(*)) OVER (), 6) AS share
        FROM labels GROUP BY toxic""",
    "q_class_filter": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice
        FROM lineitem WHERE l_returnflag = 'R'""",
    "q_split": _split_sql("labels", "toxic", "doc_id", _H_DOC, "doc_id, quality, toxic"),
    "q_split_events": f"""
        SELECT event_type, split, count(*) AS n_rows, round(sum(value), 4) AS sum_value
        FROM ({_split_sql("events", "event_type", "event_id", _H_EVENT, "event_type, value")})
        GROUP BY 1, 2""",
    "q_rebalance": _rebalance_sql(),
    "q_rebalance_counts": f"""
        SELECT toxic, count(*) AS n_rows,
               round(count(*) / sum(count(*)) OVER (), 6) AS share
        FROM ({_rebalance_sql()}) GROUP BY toxic""",
    "q_report": f"""
        WITH p AS (
            SELECT CAST(l.toxic AS VARCHAR) AS label,
                   CAST(CASE WHEN d.n_chars > {catalog.REPORT_MIN_CHARS} THEN 1 ELSE 0 END AS VARCHAR) AS predicted
            FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
        cls AS (SELECT label FROM p UNION SELECT predicted FROM p),
        s AS (
            SELECT c.label,
                   (SELECT count(*) FROM p WHERE p.label = c.label) AS support,
                   (SELECT count(*) FROM p WHERE p.label = c.label AND p.predicted = c.label) AS tp,
                   (SELECT count(*) FROM p WHERE p.predicted = c.label) AS n_pred
            FROM cls c),
        m AS (
            SELECT label, support,
                   CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
                   CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall,
                   tp
            FROM s),
        f AS (
            SELECT *, CASE WHEN precision + recall > 0
                           THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
            FROM m),
        tot AS (SELECT sum(support) AS n, sum(tp) AS tp FROM f)
        SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall,
               round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM f
        UNION ALL
        SELECT 'accuracy', NULL, NULL, round(tp / n, 6), CAST(n AS BIGINT) FROM tot
        UNION ALL
        SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
               CAST(sum(support) AS BIGINT) FROM f
        UNION ALL
        SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
               round(sum(recall * support) / sum(support), 6),
               round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f""",
})

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

SQL.update({
    "q_page_vars": r"""
        SELECT page_id,
               nullif(regexp_extract(html, '(?s)var t\s*=\s*(.*?);', 1), '') AS t_value,
               TRY_CAST(nullif(regexp_extract(html, 'track\(([^)]*)\)', 1), '') AS INTEGER) AS track_arg
        FROM pages""",
    "q_track_mean": r"""
        SELECT count(t) AS n_pages, round(avg(t), 6) AS mean_track
        FROM (SELECT TRY_CAST(nullif(regexp_extract(html, 'track\(([^)]*)\)', 1), '') AS INTEGER) AS t
              FROM pages)""",
    "q_timeline_mean": f"""
        SELECT 'Input Rate (records/sec)' AS metric, round(avg(value), 6) AS mean, count(value) AS n_points FROM events
        UNION ALL
        SELECT 'Process Rate (records/sec)', round(avg({_K}), 6), count({_K}) FROM events
        UNION ALL
        SELECT 'Input Rows (records/batch)', round(avg(user_id), 6), count(user_id) FROM events
        UNION ALL
        SELECT 'Batch Duration (ms)', round(avg(event_id), 6), count(event_id) FROM events""",
    "q_operation_mean": """
        SELECT event_type AS operation, round(avg(value), 2) AS mean_ms
        FROM events GROUP BY event_type""",
    "q_metric_summary": f"""
        WITH t AS (SELECT event_type, 'value' AS metric, value AS v FROM events
                   UNION ALL
                   SELECT event_type, 'k', CAST({_K} AS DOUBLE) FROM events)
        SELECT event_type, metric, count(v) AS n, round(avg(v), 6) AS mean, min(v) AS min, max(v) AS max,
               round(sum(v), 4) AS total,
               quantile_disc(v, 0.07) AS p7, quantile_disc(v, 0.5) AS p50, quantile_disc(v, 0.55) AS p55,
               quantile_disc(v, 0.95) AS p95, quantile_disc(v, 0.999) AS p99_9
        FROM t GROUP BY event_type, metric""",
})

SQL.update({
    "q_stream_parquet": SQL["q_score_rows"],
    "q_stream_restart": SQL["q_score_rows"],
    "q_stream_batches": SQL["q_score_rows"],
})

SQL["q_stream_text"] = SQL["q_score_rows"]

SQL["q_parse_errors"] = """
    SELECT CASE WHEN event_type = 'signup' THEN '(unparsed)' ELSE event_type END AS event_type,
           count(*) AS n_rows,
           CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS n_bad_value,
           CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS n_bad_message,
           round(sum(CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE value END), 4) AS sum_value
    FROM events GROUP BY 1"""

SQL["q_hash_split"] = f"""
    SELECT event_type, CASE WHEN {_H_EVENT} % 100 < 80 THEN 'train' ELSE 'test' END AS split,
           count(*) AS n_rows
    FROM events GROUP BY 1, 2"""

SQL["q_score_category"] = """
    SELECT event_type, CASE WHEN event_type IN ('error', 'purchase') THEN 1 ELSE 0 END AS prediction,
           count(*) AS n_events
    FROM events GROUP BY 1, 2"""


def _rebalance_exact_sql() -> str:
    shares = catalog.TOXIC_SHARES
    share = " ".join(f"WHEN toxic = {k} THEN CAST({v} AS DOUBLE)" for k, v in shares.items())
    return f"""
        WITH c AS (SELECT toxic AS t, count(*) AS n_c FROM labels GROUP BY toxic),
             r AS (SELECT l.doc_id, l.toxic, c.n_c,
                          CAST(floor((CASE {share} END) * (SELECT count(*) FROM labels) + 0.5) AS BIGINT)
                              AS target,
                          row_number() OVER (PARTITION BY l.toxic ORDER BY {_H_DOC}, l.doc_id) AS rn
                   FROM labels l JOIN c ON l.toxic = c.t),
             w AS (SELECT doc_id, toxic,
                          target // n_c + CASE WHEN rn <= target - (target // n_c) * n_c THEN 1 ELSE 0 END
                              AS copies
                   FROM r)
        SELECT doc_id, toxic, CAST(x.copy AS BIGINT) AS copy
        FROM w, unnest(range(1, copies + 1)) AS x(copy)
        WHERE copies > 0"""


SQL["q_rebalance_exact"] = _rebalance_exact_sql()

SQL["q_csv_table"] = "SELECT doc_id, quality, toxic FROM labels"

SQL["q_page_files"] = SQL["q_page_vars"]

SQL["q_stream_trigger"] = SQL["q_score_rows"]
SQL["q_stream_bytes"] = SQL["q_score_rows"]

SQL["q_parse_records"] = """
    SELECT event_id, event_type, value, CAST(event_id AS VARCHAR) AS record_key FROM events"""

SQL.update({
    "q_stream_json": SQL["q_score_rows"],
    "q_stream_csv": SQL["q_score_rows"],
    "q_stream_replace": SQL["q_score_rows"],
    "q_telemetry_rows": """
        WITH f AS (SELECT 8 + count(*) // 1000000 AS files FROM events),
        b AS (SELECT count(*) AS n FROM events, f GROUP BY coalesce(((event_id % files) + files) % files, 0))
        SELECT 'Input_Rows' AS metric, count(*) AS n, CAST(sum(n) AS DOUBLE) AS total,
               CAST(quantile_disc(n, 0.5) AS DOUBLE) AS p50, count(*) > 1 AS several FROM b""",
    "q_score_file": "SELECT event_id, value, CAST(value > 75 AS INT) AS prediction FROM events",
    "q_forest_rules": "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS disagree FROM lineitem",
    "q_score_booster": """
        SELECT l_orderkey, l_linenumber, round(1 / (1 + exp(-(
            CASE WHEN l_orderkey % 7 = 0 OR l_quantity < 25 THEN CASE WHEN l_discount < 0.0625 THEN 0.25 ELSE 0.75 END ELSE -0.5 END
            + CASE WHEN l_tax < 0.03125 THEN -0.125 ELSE 0.5 END + 0.0625)::DOUBLE)), 9) AS score FROM lineitem""",
    "q_score_shipped": "SELECT event_id, CAST(value > 25 AS INT) AS v1, CAST(value > 90 AS INT) AS v2 FROM events",
    "q_score_custom": "SELECT event_id, CAST(value <= 60.5 AS INT) AS prediction FROM events",
    "q_score_native": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_discount,
               CASE WHEN l_quantity > 25 AND l_discount > 0.05 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
        FROM lineitem""",
    "q_assemble": """
        SELECT l_orderkey, l_linenumber, [l_quantity::DOUBLE, l_tax::DOUBLE, l_discount::DOUBLE] AS features
        FROM lineitem""",
    "q_job_columns": f"""
        SELECT event_id, value, CASE WHEN value > 50 AND {_K} > 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
        FROM events""",
    "q_parse_case": "SELECT event_id, value AS small, user_id AS large FROM events",
    "q_mllib_support": """
        WITH c AS (SELECT CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END AS label, count(*) AS n
                   FROM lineitem GROUP BY 1),
        t AS (SELECT label, n - (n * 80) // 100 AS support FROM c)
        SELECT label, support::BIGINT AS support FROM t
        UNION ALL SELECT 'accuracy', sum(support)::BIGINT FROM t""",
    "q_csv_infer": "SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem",
})
