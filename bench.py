"""Headline timings at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``.

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries": {name: seconds}, "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def session() -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("boostframe-bench")
             .config("spark.sql.shuffle.partitions", str(max(2 * CPUS, 8)))
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "16g")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bf-bench-ck-"))
    return spark


def main() -> None:
    spark = session()
    from boostframe import fit_model, predict
    from boostframe.operators.dependence import partial_dependence
    from boostframe.operators.evaluate import cross_val_score, grid_search
    from boostframe.operators.explain import explain
    from boostframe.operators.importance import permutation_importance

    li = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    reg = li.select(*[F.col(c).cast("double").alias(c) for c in FEATURES],
                    (F.col("l_quantity") * (1 - F.col("l_discount"))).alias("target"))
    binc = li.select(*[F.col(c).cast("double").alias(c) for c in FEATURES],
                     F.expr("CASE WHEN l_quantity > 25 AND l_discount >= 0.05 THEN 1 ELSE 0 END").alias("target"))
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        out = fn()
        times[name] = round(time.time() - t0, 3)
        return out

    def drain(df):
        return df.agg(F.count(F.lit(1))).first()[0]

    model = timed("fit_10x4", lambda: fit_model(reg, target="target", estimator="xgb_regressor",
                                                 params={"n_estimators": 10, "max_depth": 4}))
    forest = timed("fit_rf_100x6", lambda: fit_model(reg, target="target", estimator="xgb_rf_regressor",
                                                      params={"n_estimators": 100, "max_depth": 6}))
    timed("predict_100_trees", lambda: drain(predict(reg, model=forest)))
    timed("cross_val_score_cv5", lambda: cross_val_score(binc, target="target",
                                                         params={"n_estimators": 10, "max_depth": 4}, cv=5).collect())
    timed("grid_search_2x2_cv3", lambda: grid_search(binc, {"xgb_classifier": {"max_depth": [2, 4],
                                                                              "n_estimators": [5, 10]}},
                                                     target="target", cv=3).collect())
    timed("explain", lambda: drain(explain(reg, model=model)))
    timed("permutation_importance", lambda: permutation_importance(reg, model=model, target="target",
                                                                   n_repeats=2).collect())
    timed("partial_dependence", lambda: partial_dependence(reg, model=model, feature="l_quantity",
                                                           grid_resolution=20).collect())
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else None, "cpus": CPUS}))


if __name__ == "__main__":
    main()
