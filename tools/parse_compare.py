"""Measure the parse and scoring variants on the driver's tables.

usage: python tools/parse_compare.py [sf_dir]

Parse: lineitem rows (11 columns) as JSON messages, read back with
  * one get_json_object per column (``mode="path"``),
  * one shared from_json into a struct of strings + lenient casts (default),
  * one from_json into a typed struct (the older flat form).
Score: the same rule model fed by
  * a struct column (a pandas frame per Arrow batch; what ``score`` does),
  * an array column rebuilt row by row with ``tolist()``.
Each variant is forced with the noop sink, best of three.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Iterator

import pandas as pd

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from pyspark.sql import functions as F

    from scorewright.functions.messages import encode_messages
    from scorewright.operators.parse import parse_messages, parse_struct
    from scorewright.operators.score import ThresholdRule, score
    from scorewright.session import local_session, ship_package, spread_scan

    spark = local_session("parse-compare", cores=8, shuffle_partitions=16)
    li = spread_scan(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    cols = li.columns
    types = dict(li.dtypes)
    msgs = encode_messages(li, cols).cache()
    msgs.count()
    cfg = {c: {"path": c, "type": "timestamp" if types[c] == "timestamp" else types[c]} for c in cols}
    flat = {c: {"bigint": "double", "int": "integer", "timestamp": "string"}.get(types[c], types[c])
            for c in cols}

    def best(df) -> float:
        out = []
        for _ in range(3):
            t0 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            out.append(time.perf_counter() - t0)
        return round(min(out), 3)

    results = {
        "parse_get_json_object_per_column": best(parse_messages(msgs, cfg, mode="path")),
        "parse_one_from_json_strings": best(parse_messages(msgs, cfg)),
        "parse_one_from_json_typed": best(parse_struct(msgs, flat)),
    }

    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    rule = ThresholdRule("l_discount", 0.05)
    results["score_struct_frame"] = best(score(li, {"features": feats}, model=rule))

    ship_package(spark)
    handle = spark.sparkContext.broadcast(rule)

    @F.pandas_udf("int")
    def by_rows(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = handle.value
        for s in it:
            frame = pd.DataFrame(s.tolist(), columns=feats)
            yield pd.Series(model.predict(frame))

    arr = F.array(*[F.col(c).cast("double") for c in feats])
    results["score_array_tolist"] = best(li.withColumn("prediction", by_rows(arr)))
    print(json.dumps({"sf_dir": sf_dir, "rows": li.count(), "seconds": results}))
    spark.stop()


if __name__ == "__main__":
    main()
