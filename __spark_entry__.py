"""

Every query reads the given tables at ``sf_dir`` whole. Derived training tables follow FIXTURES.md:
``li_reg`` / ``li_bin`` / ``li_multi`` / ``li_cat`` (lineitem), ``part_cat`` (part), ``doc_lang``
(documents), ``emb_any`` (embeddings), ``ev_stream`` (events). Doubles are rounded to 6 places on both
sides. Model-building queries with an oracle use exact bins and the fixed-point (2^20) gradient sums,
so the SQL reproduces the same sums, gains and leaf values.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from boostframe.session import ensure_session  # noqa: E402

SCALE = 1048576.0
LI_REG_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
LI_ALL_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
STUMP_PARAMS = {"n_estimators": 2, "max_depth": 1}


# ---------------------------------------------------------------------------------------------- inputs

def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def li_reg(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.select(*[F.col(c).cast("double").alias(c) for c in LI_REG_FEATURES],
                     (F.col("l_quantity") * (1 - F.col("l_discount"))).cast("double").alias("target"))


def li_bin(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.select(*[F.col(c).cast("double").alias(c) for c in LI_REG_FEATURES],
                     F.expr("CASE WHEN l_quantity > 25 AND l_discount >= 0.05 THEN 1 ELSE 0 END").alias("target"))


def li_multi(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.select(*[F.col(c).cast("double").alias(c) for c in LI_REG_FEATURES],
                     F.expr("CASE WHEN l_quantity <= 15 THEN 'low' WHEN l_quantity <= 35 THEN 'mid' ELSE 'high' END")
                     .alias("target"))


def li_cat(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.select("l_returnflag", "l_linestatus", F.expr("NULLIF(l_tax, 0.0)").alias("tax"),
                     F.col("l_quantity").cast("double").alias("l_quantity"),
                     F.expr("CAST((l_returnflag = 'R') <> (l_quantity > 25) AS INT)").alias("target"))


def part_cat(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    smallest = p.agg(F.min("p_brand")).first()[0]   # one scalar
    return p.select("p_brand", "p_type", "p_size",
                    ((F.col("p_size") > 25) | (F.col("p_brand") == F.lit(smallest))).cast("int").alias("target"))


def doc_lang(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    return d.select(F.expr("regexp_count(text, '[äöüß]')").cast("double").alias("de_chars"),
                    F.expr("regexp_count(text, '[éèêà]')").cast("double").alias("fr_chars"),
                    F.expr("regexp_count(text, '[ñáíóú]')").cast("double").alias("es_chars"),
                    F.col("n_chars").cast("double").alias("n_chars"), F.col("lang").alias("target"))


def emb_any(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings")
    return e.select(*[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)],
                    F.col("label").alias("target"))


def with_row_id(df: DataFrame, order: list[str], keep: list[str] | None = None) -> DataFrame:
    """``id`` = 0-based position in ``order`` (range-partitioned ranks, no single-task window), and the columns ``keep`` (all
    without it)."""
    from boostframe.plans.ranks import with_rank
    ranked, _, _ = with_rank(df, order, keep=keep)
    return ranked.withColumnRenamed("__rank", "id").drop("__pid")


def _r(c: str, places: int = 6):
    return F.round(F.col(c), places).alias(c)


def _ckdir(spark: SparkSession) -> str:
    d = spark.sparkContext.getCheckpointDir()
    return d.rstrip("/") if d else "models"


# ---------------------------------------------------------------------------------------------- queries

def q_labelled_table(spark, sf_dir):
    from boostframe.sources.datasets import labelled_table
    li = _t(spark, sf_dir, "lineitem")
    return labelled_table(li, LI_REG_FEATURES, "l_returnflag", order_by=LI_ALL_COLS)


def q_labelled_regression(spark, sf_dir):
    from boostframe.sources.datasets import labelled_table
    li = _t(spark, sf_dir, "lineitem")
    return labelled_table(li, ["l_quantity", "l_discount"], "l_extendedprice", order_by=LI_ALL_COLS,
                          task="regression").select("sample_id", "l_quantity", "l_discount", _r("target"))


def q_category_dictionary(spark, sf_dir):
    from boostframe.operators.stages import category_dictionary
    return category_dictionary(li_cat(spark, sf_dir), ["l_returnflag", "l_linestatus", "tax", "l_quantity"])


def q_bin_cuts(spark, sf_dir):
    from boostframe.operators.stages import bin_cuts
    return bin_cuts(li_reg(spark, sf_dir), LI_REG_FEATURES).select("feature", "bin", _r("threshold"))


def q_class_codes(spark, sf_dir):
    from boostframe.operators.stages import class_codes
    return class_codes(li_multi(spark, sf_dir), "target")


def q_root_histogram(spark, sf_dir):
    from boostframe.operators.stages import root_histogram
    return root_histogram(li_reg(spark, sf_dir), "target", "xgb_regressor", STUMP_PARAMS)


def _stump_model(spark, sf_dir):
    from boostframe import fit_model
    return fit_model(li_reg(spark, sf_dir), target="target", estimator="xgb_regressor", params=STUMP_PARAMS)


def _node_cols(df: DataFrame) -> DataFrame:
    return df.select("tree_id", "node_id", "feature", _r("threshold"), "default_left", "left_id", "right_id",
                     _r("gain"), _r("cover"), _r("leaf_value"))


def q_fit_stumps_nodes(spark, sf_dir):
    from boostframe.operators.importance import node_table
    return _node_cols(node_table(spark, model=_stump_model(spark, sf_dir)))


def li_reg_id(spark, sf_dir):
    """``li_reg`` with ``id``, the row's position in the order of all columns."""
    li = with_row_id(_t(spark, sf_dir, "lineitem"), LI_ALL_COLS, LI_REG_FEATURES)
    return li.select("id", *[F.col(c).cast("double").alias(c) for c in LI_REG_FEATURES],
                     (F.col("l_quantity") * (1 - F.col("l_discount"))).cast("double").alias("target"))


def q_predict_stumps(spark, sf_dir):
    from boostframe import predict
    m = _stump_model(spark, sf_dir)
    return predict(li_reg_id(spark, sf_dir), model=m, id="id").select("id", _r("prediction"))


def q_predict_dart_rate0(spark, sf_dir):
    from boostframe import fit_model, predict
    m = fit_model(li_reg(spark, sf_dir), target="target", estimator="xgb_regressor", params={**STUMP_PARAMS, "booster": "dart"})
    return predict(li_reg_id(spark, sf_dir), model=m, id="id").select("id", _r("prediction"))


def q_predict_rf_stumps(spark, sf_dir):
    from boostframe import fit_model, predict
    m = fit_model(li_reg(spark, sf_dir), target="target", estimator="xgb_rf_regressor",
                  params={"n_estimators": 4, "max_depth": 1, "subsample": 1.0, "colsample_bynode": 1.0})
    return predict(li_reg_id(spark, sf_dir), model=m, id="id").select("id", _r("prediction"))


def q_objective_stumps(spark, sf_dir):
    from boostframe import fit_model
    from boostframe.operators.importance import node_table
    out = None
    for objective in ("reg:squarederror", "count:poisson", "reg:gamma", "reg:tweedie", "reg:pseudohubererror",
                      "reg:squaredlogerror"):
        m = fit_model(li_reg(spark, sf_dir), target="target", estimator="xgb_regressor",
                      params={"n_estimators": 1, "max_depth": 1, "objective": objective})
        part = _node_cols(node_table(spark, model=m)).select(F.lit(objective).alias("objective"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def q_fit_large_target(spark, sf_dir):
    """Targets near 5e10: the gradient grid follows their size."""
    from boostframe import fit_model, predict
    big = li_reg(spark, sf_dir).withColumn("target", F.col("target") * 1e9)
    m = fit_model(big, target="target", estimator="xgb_regressor", params=STUMP_PARAMS)
    return (predict(li_reg_id(spark, sf_dir), model=m, id="id")
            .select("id", F.round(F.col("prediction") / 1e9, 6).alias("prediction")))


def q_gblinear_line(spark, sf_dir):
    """A linear model of one column meets the least-squares line."""
    from boostframe import fit_model
    m = fit_model(li_reg(spark, sf_dir).select("l_quantity", "target"), target="target", estimator="xgb_regressor",
                  params={"booster": "gblinear", "n_estimators": 400})
    line = (float(m.meta.linear_weights[0][0]), float(m.meta.base_margin[0] + m.meta.linear_bias[0]))
    return spark.createDataFrame([line], "weight double, bias double").select(_r("weight", 4), _r("bias", 4))


def q_many_categories(spark, sf_dir):
    """A string column with a value per row or so: the code of every row by the dictionary table."""
    from boostframe.operators.stages import feature_codes
    li = li_rows_id(spark, sf_dir, F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string")).alias("item"))
    return feature_codes(li, "item", "id")


def q_exact_bins(spark, sf_dir):
    """``tree_method='exact'``: every distinct value of a continuous column is a cut."""
    from boostframe.operators.stages import exact_cuts
    return exact_cuts(_t(spark, sf_dir, "lineitem"), "l_extendedprice").select("bin", _r("threshold"))


def q_regression_metrics(spark, sf_dir):
    from boostframe import predict
    from boostframe.functions.metrics import score
    m = _stump_model(spark, sf_dir)
    data = li_reg(spark, sf_dir)
    p = predict(data, model=m, id="target").select(F.col("target").alias("y"), F.col("prediction").alias("pred"),
                                                    F.lit(0).alias("g"))
    out = None
    for s in ["r2", "explained_variance", "neg_mean_squared_error", "neg_root_mean_squared_error",
              "neg_mean_absolute_error", "max_error", "neg_mean_absolute_percentage_error"]:
        part = score(p, s, ["g"]).select(F.lit(s).alias("scorer"), F.round("score", 6).alias("score"))
        out = part if out is None else out.unionByName(part)
    return out


def q_feature_importance(spark, sf_dir):
    from boostframe.operators.importance import feature_importance
    m = _stump_model(spark, sf_dir)
    out = None
    for it in ["weight", "gain", "cover", "total_gain", "total_cover"]:
        part = feature_importance(spark, model=m, importance_type=it).select(
            F.lit(it).alias("importance_type"), "feature", F.round("importance", 6).alias("importance"), "rank")
        out = part if out is None else out.unionByName(part)
    return out


def q_partial_dependence(spark, sf_dir):
    from boostframe.operators.dependence import partial_dependence
    m = _stump_model(spark, sf_dir)
    return partial_dependence(li_reg(spark, sf_dir), model=m, feature="l_quantity").select(
        _r("feature_value"), "class", _r("partial_dependence"))


def q_explain(spark, sf_dir):
    from boostframe.operators.explain import explain
    m = _stump_model(spark, sf_dir)
    return explain(li_reg_id(spark, sf_dir), model=m, id="id").select("id", "feature", _r("shap_value"), _r("base_value"))


def _cat_stump(spark, sf_dir):
    from boostframe import fit_model
    return fit_model(li_cat(spark, sf_dir), target="target", estimator="xgb_classifier",
                     params={"n_estimators": 1, "max_depth": 1})


def q_fit_cat_stump_nodes(spark, sf_dir):
    from boostframe.operators.importance import node_table
    nodes = node_table(spark, model=_cat_stump(spark, sf_dir))
    label = F.when(F.col("feature").isNotNull(), F.concat_ws(":", "feature", F.array_join("left_cats", ",")))
    return _node_cols(nodes.withColumn("feature", label))


def q_predict_cat_proba(spark, sf_dir):
    from boostframe import predict
    m = _cat_stump(spark, sf_dir)
    return predict(li_cat(spark, sf_dir), model=m, with_proba=True).select(
        "prediction", _r("proba_0"), _r("proba_1"))


def q_roc_auc(spark, sf_dir):
    from boostframe import predict
    from boostframe.functions.metrics import score
    m = _cat_stump(spark, sf_dir)
    p = predict(li_cat(spark, sf_dir), model=m, id="target", with_proba=True)
    d = p.select(F.col("target").cast("double").alias("y"), F.col("prediction").cast("double").alias("pred"),
                 F.col("proba_0").alias("p0"), F.col("proba_1").alias("p1"), F.lit(0).alias("g"))
    out = None
    for s in ["roc_auc", "accuracy", "balanced_accuracy", "precision", "recall", "f1", "f1_macro",
              "f1_weighted", "neg_log_loss", "roc_auc_ovr", "precision_micro", "recall_micro", "f1_micro", "precision_macro",
              "recall_macro", "precision_weighted", "recall_weighted", "neg_brier_score", "matthews_corrcoef",
              "average_precision"]:
        part = score(d, s, ["g"]).select(F.lit(s).alias("scorer"), F.round("score", 6).alias("score"))
        out = part if out is None else out.unionByName(part)
    return out


def q_folds_stratified(spark, sf_dir):
    from boostframe.operators.stages import assign_folds
    d = with_row_id(_t(spark, sf_dir, "lineitem"), LI_ALL_COLS).select(
        "id", *LI_REG_FEATURES, F.expr("CASE WHEN l_quantity > 25 AND l_discount >= 0.05 THEN 1 ELSE 0 END")
        .alias("target"))
    return assign_folds(d, "target", "id", cv=5, estimator="xgb_classifier")


def q_folds_plain(spark, sf_dir):
    from boostframe.operators.stages import assign_folds
    d = with_row_id(_t(spark, sf_dir, "lineitem"), LI_ALL_COLS).select(
        "id", *LI_REG_FEATURES, (F.col("l_quantity") * (1 - F.col("l_discount"))).alias("target"))
    return assign_folds(d, "target", "id", cv=4, estimator="xgb_regressor")


def q_make_regression(spark, sf_dir):
    """A sample for every order, drawn by its key."""
    from boostframe.sources.datasets import make_regression
    keys = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("long").alias("id"))
    d = make_regression(spark, n_features=3, n_informative=2, noise=0.5, random_state=7, rows=keys)
    return d.select("sample_id", *[_r(c) for c in ["feature_0", "feature_1", "feature_2", "target"]])


def q_model_lifecycle(spark, sf_dir):
    from boostframe import fit
    from boostframe.sources import registry
    root = _ckdir(spark) + "/models"
    fit(li_reg(spark, sf_dir), target="target", model_name="li_reg_stumps", estimator="xgb_regressor",
        params=STUMP_PARAMS, root=root)
    return registry.model_info(spark, "li_reg_stumps", root).select(
        "model_name", "estimator", "task", "target", "n_features", "n_samples", "n_classes")


# ------------------------------------------------------------- rows-only (no SQL equivalent kept)

def q_fit_multiclass(spark, sf_dir):
    from boostframe import fit
    return fit(li_multi(spark, sf_dir), target="target", params={"n_estimators": 5, "max_depth": 3}).drop("model")


def li_rows_id(spark, sf_dir, *columns):
    return with_row_id(_t(spark, sf_dir, "lineitem"), LI_ALL_COLS).select("id", *columns)


def _multi_stumps(spark, sf_dir):
    from boostframe import fit_model
    return fit_model(li_multi(spark, sf_dir), target="target", params={"n_estimators": 1, "max_depth": 1})


def q_predict_multiclass_proba(spark, sf_dir):
    from boostframe import predict
    rows = li_rows_id(spark, sf_dir, *[F.col(c).cast("double").alias(c) for c in LI_REG_FEATURES])
    return predict(rows, model=_multi_stumps(spark, sf_dir), id="id", with_proba=True).select(
        "id", "prediction", _r("proba_high"), _r("proba_low"), _r("proba_mid"))


def q_predict_leaf(spark, sf_dir):
    from boostframe import predict
    rows = li_rows_id(spark, sf_dir, *[F.col(c).cast("double").alias(c) for c in LI_REG_FEATURES])
    return predict(rows, model=_multi_stumps(spark, sf_dir), id="id", pred_leaf=True).select(
        "id", F.concat_ws(",", F.col("leaf").cast("array<string>")).alias("leaves"))


def q_predict_margin(spark, sf_dir):
    from boostframe import predict
    rows = li_rows_id(spark, sf_dir, "l_returnflag", "l_linestatus", F.expr("NULLIF(l_tax, 0.0)").alias("tax"),
                      F.col("l_quantity").cast("double").alias("l_quantity"))
    return predict(rows, model=_cat_stump(spark, sf_dir), id="id", output_margin=True).select("id", _r("margin"))


def q_registry(spark, sf_dir):
    """Two models saved, one dropped (and dropped again): what the registry lists."""
    from boostframe.sources import registry
    root, m = f"{_ckdir(spark)}/registry-{uuid.uuid4().hex}", _stump_model(spark, sf_dir)
    for name in ("kept", "other"):
        registry.save(spark, m, name, root)
    gone = [registry.drop_model(spark, "other", root).first()["dropped"] for _ in range(2)]
    return registry.list_models(spark, root).select("model_name", "task", "n_samples", F.lit(gone[0]).alias("dropped_other"),
                                                    F.lit(gone[1]).alias("dropped_again"))


def q_fit_categorical_depth2(spark, sf_dir):
    from boostframe import fit
    return fit(li_cat(spark, sf_dir), target="target", params={"n_estimators": 5, "max_depth": 2}).drop("model")


def q_fit_part_cat(spark, sf_dir):
    from boostframe import fit
    return fit(part_cat(spark, sf_dir), target="target", params={"n_estimators": 5, "max_depth": 3}).drop("model")


def q_fit_doc_lang(spark, sf_dir):
    from boostframe import fit
    return fit(doc_lang(spark, sf_dir), target="target", params={"n_estimators": 10, "max_depth": 3}).drop("model")


def q_fit_emb_any(spark, sf_dir):
    from boostframe import fit
    return fit(emb_any(spark, sf_dir), target="target", params={"n_estimators": 3, "max_depth": 3}).drop("model")


def q_cross_val_predict(spark, sf_dir):
    from boostframe.operators.evaluate import cross_val_predict
    d = with_row_id(_t(spark, sf_dir, "lineitem"), LI_ALL_COLS).select(
        "id", *[F.col(c).cast("double").alias(c) for c in LI_REG_FEATURES],
        F.expr("CASE WHEN l_quantity > 25 AND l_discount >= 0.05 THEN 1 ELSE 0 END").alias("target"))
    return cross_val_predict(d, target="target", id="id", params=STUMP_PARAMS, cv=3)


def q_cross_val_score(spark, sf_dir):
    from boostframe.operators.evaluate import cross_val_score
    return cross_val_score(li_reg_id(spark, sf_dir), target="target", estimator="xgb_regressor", id="id",
                           params=STUMP_PARAMS, cv=3).select("fold", _r("score"))


def _board(df: DataFrame) -> DataFrame:
    return df.select("estimator", "params", _r("mean_test_score"), _r("std_test_score"), "rank")


def q_grid_search(spark, sf_dir):
    from boostframe.operators.evaluate import grid_search
    return _board(grid_search(li_reg_id(spark, sf_dir), {"xgb_regressor": {
        "learning_rate": [0.1, 0.3], "max_depth": [1], "n_estimators": [1, 2]}}, target="target", id="id", cv=3))


def q_randomized_search(spark, sf_dir):
    """Three of four combinations, drawn with seed 1."""
    from boostframe.operators.evaluate import randomized_search
    return _board(randomized_search(li_reg_id(spark, sf_dir), {"xgb_regressor": {
        "learning_rate": [0.1, 0.3], "max_depth": [1], "n_estimators": [1, 2]}}, target="target", id="id", n_iter=3, cv=3,
        random_state=1))


def q_permutation_importance(spark, sf_dir):
    from boostframe.operators.importance import permutation_importance
    m = _stump_model(spark, sf_dir)
    return permutation_importance(li_reg_id(spark, sf_dir), model=m, target="target", id="id", n_repeats=2).select(
        "feature", (F.round("importance_mean", 6) + 0.0).alias("importance_mean"),
        (F.round("importance_std", 6) + 0.0).alias("importance_std"), "rank")


def q_fit_rf(spark, sf_dir):
    from boostframe import fit_xgb_rf_regressor
    return fit_xgb_rf_regressor(li_reg(spark, sf_dir), target="target", n_estimators=8, max_depth=3).drop("model")


def q_fit_dart(spark, sf_dir):
    from boostframe import fit
    return fit(li_reg(spark, sf_dir), target="target", estimator="xgb_regressor",
               params={"n_estimators": 4, "max_depth": 2, "booster": "dart", "rate_drop": 0.3}).drop("model")


def q_fit_gblinear(spark, sf_dir):
    from boostframe import fit
    return fit(li_reg(spark, sf_dir), target="target", estimator="xgb_regressor",
               params={"n_estimators": 5, "booster": "gblinear"}).drop("model")


def q_fit_typed_classifier(spark, sf_dir):
    from boostframe import fit_xgb_classifier
    return fit_xgb_classifier(li_bin(spark, sf_dir), target="target", n_estimators=4, max_depth=3,
                              subsample=0.8, colsample_bytree=0.75, learning_rate=0.2).drop("model")


def q_stream_predict(spark, sf_dir):
    """A model of ``value`` by event type and user, fitted on the batch table, scores the same table as a file stream."""
    from boostframe import fit_model
    from boostframe.streaming.stream import score_files_once
    ev = _t(spark, sf_dir, "events").select("event_type", "user_id", F.col("value").cast("double").alias("target"))
    model = fit_model(ev, target="target", estimator="xgb_regressor", params={"n_estimators": 3, "max_depth": 2})
    scored = score_files_once(spark, f"{sf_dir}/events.parquet", model, "event_id", _ckdir(spark))
    return scored.select("event_id", _r("prediction"))


# ------------------------------------------------------------- deeper trees: whole node tables

def _tree_cols(df: DataFrame) -> DataFrame:
    cats = F.when(F.col("left_cats").isNotNull(), F.array_join(F.sort_array("left_cats"), ","))
    return df.select("tree_id", "node_id", "feature", _r("threshold"), cats.alias("left_cats"), "default_left", "left_id",
                     "right_id", _r("gain"), _r("cover"), _r("leaf_value"))


def _tree_nodes(spark, data, estimator, **params):
    from boostframe import fit_model
    from boostframe.operators.importance import node_table
    return _tree_cols(node_table(spark, model=fit_model(data, target="target", estimator=estimator, params=params)))


def li_missing(spark, sf_dir):
    """Numeric columns with missing values and a target that depends on them."""
    li = _t(spark, sf_dir, "lineitem")
    return li.select(F.expr("CAST(NULLIF(l_tax, 0.03) AS DOUBLE)").alias("tax"),
                     F.expr("CAST(CASE WHEN l_linenumber = 4 THEN NULL ELSE l_quantity END AS DOUBLE)").alias("quantity"),
                     F.col("l_discount").cast("double").alias("discount"),
                     F.expr("CAST((l_quantity > 30 AND l_discount < 0.05) OR l_tax = 0.03 AS INT)").alias("target"))


def part_size(spark, sf_dir):
    """String columns with many values and a numeric target that depends on them."""
    return _t(spark, sf_dir, "part").select(
        "p_brand", "p_type", F.col("p_size").cast("double").alias("p_size"),
        F.expr("CAST(p_size + 3 * length(p_type) + 10 * CAST(substr(p_brand, -1) AS INT) AS DOUBLE)").alias("target"))


def q_fit_depth3_nodes(spark, sf_dir):
    return _tree_nodes(spark, li_reg(spark, sf_dir), "xgb_regressor", n_estimators=2, max_depth=3)


def q_fit_missing_nodes(spark, sf_dir):
    return _tree_nodes(spark, li_missing(spark, sf_dir), "xgb_classifier", n_estimators=2, max_depth=3)


def q_fit_category_nodes(spark, sf_dir):
    return _tree_nodes(spark, part_size(spark, sf_dir), "xgb_regressor", n_estimators=2, max_depth=3)


def q_fit_softmax_nodes(spark, sf_dir):
    """The first round of three classes: a tree of depth 3 each."""
    return _tree_nodes(spark, li_multi(spark, sf_dir), "xgb_classifier", n_estimators=1, max_depth=3)


def q_fit_poisson_price(spark, sf_dir):
    """Counts far beyond the ordinary grid: prices under a logarithmic link."""
    li = _t(spark, sf_dir, "lineitem")
    data = li.select(F.col("l_quantity").cast("double"), F.col("l_tax").cast("double"), F.col("l_extendedprice").cast("double").alias("target"))
    return _tree_nodes(spark, data, "xgb_regressor", n_estimators=2, max_depth=2, objective="count:poisson")


MONOTONE = {"l_quantity": 1, "l_discount": -1, "l_linenumber": 1}
GROUPS = [["l_quantity", "l_tax"], ["l_discount", "l_linenumber"]]


def li_bumpy(spark, sf_dir):
    """A target that falls where the constraint of `MONOTONE` wants it to rise."""
    li = _t(spark, sf_dir, "lineitem")
    return li.select(*[F.col(c).cast("double").alias(c) for c in LI_REG_FEATURES],
                     F.expr("CAST(l_quantity * (1 - l_discount) - CASE WHEN l_quantity > 30 THEN 25 ELSE 0 END + l_tax * l_linenumber AS DOUBLE)")
                     .alias("target"))


def q_fit_monotone_nodes(spark, sf_dir):
    return _tree_nodes(spark, li_bumpy(spark, sf_dir), "xgb_regressor", n_estimators=2, max_depth=3, monotone_constraints=MONOTONE)


def q_fit_interaction_nodes(spark, sf_dir):
    return _tree_nodes(spark, li_bumpy(spark, sf_dir), "xgb_regressor", n_estimators=2, max_depth=3, interaction_constraints=GROUPS)


def q_fit_absolute_nodes(spark, sf_dir):
    """Leaves are medians of the residuals."""
    return _tree_nodes(spark, li_bumpy(spark, sf_dir), "xgb_regressor", n_estimators=2, max_depth=2, objective="reg:absoluteerror")


def q_fit_quantile_nodes(spark, sf_dir):
    """Leaves are 0.9 quantiles of the residuals."""
    return _tree_nodes(spark, li_bumpy(spark, sf_dir), "xgb_regressor", n_estimators=2, max_depth=2, objective="reg:quantileerror",
                       quantile_alpha=0.9)


def q_fit_wide_nodes(spark, sf_dir):
    """A string feature with thousands of values beside one whose name holds signs: dictionaries as tables."""
    li = _t(spark, sf_dir, "lineitem")
    data = li.select(F.concat(F.lit("k"), (F.col("l_orderkey") % 5000).cast("string")).alias("key.of order"),
                     F.col("l_quantity").cast("double").alias("__t"),
                     F.expr("CAST(l_quantity + 40 * ((l_orderkey % 5000) % 7) AS DOUBLE)").alias("target"))
    return _tree_nodes(spark, data, "xgb_regressor", n_estimators=2, max_depth=3)


def q_fit_exact_nodes(spark, sf_dir):
    """``tree_method='exact'`` on a column with a value per row or so."""
    li = _t(spark, sf_dir, "lineitem")
    data = li.select(F.col("l_extendedprice").cast("double"), F.col("l_discount").cast("double"),
                     F.expr("CAST(l_quantity * (1 - l_discount) AS DOUBLE)").alias("target"))
    return _tree_nodes(spark, data, "xgb_regressor", n_estimators=2, max_depth=3, tree_method="exact")


def q_cross_val_wide(spark, sf_dir):
    """A column with far more values than bins: every fold's models are cut at the quantiles of their own rows."""
    from boostframe.operators.evaluate import cross_val_score
    d = with_row_id(_t(spark, sf_dir, "lineitem"), LI_ALL_COLS).select(
        "id", F.col("l_extendedprice").cast("double"), F.col("l_discount").cast("double"),
        (F.col("l_quantity") * (1 - F.col("l_discount"))).cast("double").alias("target"))
    return cross_val_score(d, target="target", estimator="xgb_regressor", id="id", cv=3,
                           params={"n_estimators": 2, "max_depth": 2, "max_bin": 16}).select("fold", _r("score"))


def _sql_session(spark, sf_dir):
    """The stump model under a name that no other run has, and the table functions over it."""
    from boostframe.sources import registry
    from boostframe.sources.sqlfunctions import register_functions
    root, m = f"{_ckdir(spark)}/sql-{uuid.uuid4().hex}", _stump_model(spark, sf_dir)
    registry.save(spark, m, "stumps", root)
    register_functions(spark, ["stumps"], root)


def q_sql_predict(spark, sf_dir):
    """The model called from SQL, on the table's partitions as they are."""
    _sql_session(spark, sf_dir)
    li_reg_id(spark, sf_dir).createOrReplaceTempView("li_reg_rows")
    return spark.sql("SELECT id, round(prediction, 6) AS prediction FROM predict(TABLE(li_reg_rows), model_name => 'stumps', id => 'id')")


def q_sql_explain(spark, sf_dir):
    _sql_session(spark, sf_dir)
    li_reg_id(spark, sf_dir).createOrReplaceTempView("li_reg_rows")
    return spark.sql("""SELECT id, feature, round(shap_value, 6) AS shap_value, round(base_value, 6) AS base_value
                        FROM explain(TABLE(li_reg_rows), model_name => 'stumps', id => 'id')""")


def q_sql_importance(spark, sf_dir):
    _sql_session(spark, sf_dir)
    return spark.sql(" UNION ALL ".join(
        f"SELECT '{kind}' AS importance_type, feature, round(importance, 6) AS importance, rank "
        f"FROM feature_importance(model_name => 'stumps', importance_type => '{kind}')"
        for kind in ("weight", "gain", "cover", "total_gain", "total_cover")))


def q_fit_approx_nodes(spark, sf_dir):
    """``tree_method='approx'`` with fewer bins than values: the second tree's cuts are weighted anew."""
    li = _t(spark, sf_dir, "lineitem")
    data = li.select(F.col("l_quantity").cast("double"), F.col("l_discount").cast("double"),
                     F.expr("CAST(l_quantity > 37 AND l_discount >= 0.03 AS INT)").alias("target"))
    return _tree_nodes(spark, data, "xgb_classifier", n_estimators=2, max_depth=2, max_bin=12, tree_method="approx")


def q_early_stopping(spark, sf_dir):
    """The metric of rows that are only evaluated, after every round, and the rounds that are kept."""
    from boostframe import fit_model
    li = _t(spark, sf_dir, "lineitem")
    data = li.select(*[F.col(c).cast("double").alias(c) for c in LI_REG_FEATURES], (F.col("l_orderkey") % 5 == 0).alias("held"),
                     F.expr("CAST(l_quantity * (1 - l_discount) + 20 * ((l_partkey % 7) - 3) AS DOUBLE)").alias("target"))
    m = fit_model(data, target="target", estimator="xgb_regressor", validation="held",
                  params={"n_estimators": 9, "max_depth": 2, "learning_rate": 0.9, "early_stopping_rounds": 2})
    rows = [(i + 1, float(v), i + 1 == m.meta.best_round, m.n_trees) for i, v in enumerate(m.meta.eval_scores)]
    return spark.createDataFrame(rows, "round int, score double, best boolean, kept int").withColumn("score", F.round("score", 4))


def q_median_error(spark, sf_dir):
    """Exact median of the absolute error per ship mode-like group: the scorer by line status."""
    from boostframe.functions.metrics import score
    li = _t(spark, sf_dir, "lineitem").select("l_linestatus", F.col("l_extendedprice").cast("double").alias("y"),
                                              (F.col("l_quantity") * 1500).cast("double").alias("pred"))
    return score(li, "neg_median_absolute_error", ["l_linestatus"]).select("l_linestatus", _r("score"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "labelled_table": q_labelled_table,
    "labelled_regression": q_labelled_regression,
    "category_dictionary": q_category_dictionary,
    "bin_cuts": q_bin_cuts,
    "class_codes": q_class_codes,
    "root_histogram": q_root_histogram,
    "fit_stumps_nodes": q_fit_stumps_nodes,
    "predict_stumps": q_predict_stumps,
    "regression_metrics": q_regression_metrics,
    "feature_importance": q_feature_importance,
    "partial_dependence": q_partial_dependence,
    "explain": q_explain,
    "fit_cat_stump_nodes": q_fit_cat_stump_nodes,
    "predict_cat_proba": q_predict_cat_proba,
    "classification_metrics": q_roc_auc,
    "folds_stratified": q_folds_stratified,
    "folds_plain": q_folds_plain,
    "make_regression": q_make_regression,
    "model_lifecycle": q_model_lifecycle,
    "fit_multiclass": q_fit_multiclass,
    "predict_multiclass_proba": q_predict_multiclass_proba,
    "predict_leaf": q_predict_leaf,
    "fit_categorical_depth2": q_fit_categorical_depth2,
    "fit_part_cat": q_fit_part_cat,
    "fit_doc_lang": q_fit_doc_lang,
    "fit_emb_any": q_fit_emb_any,
    "cross_val_predict": q_cross_val_predict,
    "cross_val_score": q_cross_val_score,
    "grid_search": q_grid_search,
    "randomized_search": q_randomized_search,
    "permutation_importance": q_permutation_importance,
    "fit_rf": q_fit_rf,
    "fit_dart": q_fit_dart,
    "fit_gblinear": q_fit_gblinear,
    "fit_typed_classifier": q_fit_typed_classifier,
    "stream_predict": q_stream_predict,
    "predict_dart_rate0": q_predict_dart_rate0,
    "predict_rf_stumps": q_predict_rf_stumps,
    "objective_stumps": q_objective_stumps,
    "fit_large_target": q_fit_large_target,
    "gblinear_line": q_gblinear_line,
    "many_categories": q_many_categories,
    "exact_bins": q_exact_bins,
    "predict_margin": q_predict_margin,
    "registry": q_registry,
    "fit_depth3_nodes": q_fit_depth3_nodes,
    "fit_missing_nodes": q_fit_missing_nodes,
    "fit_category_nodes": q_fit_category_nodes,
    "fit_softmax_nodes": q_fit_softmax_nodes,
    "fit_poisson_price": q_fit_poisson_price,
    "fit_monotone_nodes": q_fit_monotone_nodes,
    "fit_interaction_nodes": q_fit_interaction_nodes,
    "fit_absolute_nodes": q_fit_absolute_nodes,
    "fit_quantile_nodes": q_fit_quantile_nodes,
    "median_error": q_median_error,
    "early_stopping": q_early_stopping,
    "fit_approx_nodes": q_fit_approx_nodes,
    "sql_predict": q_sql_predict,
    "sql_explain": q_sql_explain,
    "sql_importance": q_sql_importance,
    "cross_val_wide": q_cross_val_wide,
    "fit_wide_nodes": q_fit_wide_nodes,
    "fit_exact_nodes": q_fit_exact_nodes,
}


def _wrap(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_session(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    return run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: fit boosted stumps on li_reg (sf0.001) and return the mean squared error of the
    predictions per l_returnflag."""
    ensure_session(spark)
    sf_dir = "/root/testdata/sf0.001"
    from boostframe import fit_model, predict
    li = _t(spark, sf_dir, "lineitem")
    data = li.select("l_returnflag", *[F.col(c).cast("double").alias(c) for c in LI_REG_FEATURES],
                     (F.col("l_quantity") * (1 - F.col("l_discount"))).alias("target"))
    m = fit_model(data.drop("l_returnflag"), target="target", estimator="xgb_regressor",
                  params={"n_estimators": 5, "max_depth": 3})
    # predict passes the id through unchanged, so a struct id carries the group key and the truth
    keyed = data.select(F.struct("l_returnflag", "target").alias("k"), *LI_REG_FEATURES)
    paired = predict(keyed, model=m, id="k")
    return (paired.groupBy(F.col("k.l_returnflag").alias("l_returnflag"))
            .agg(F.avg((F.col("k.target") - F.col("prediction")) ** 2).alias("mse"),
                 F.count(F.lit(1)).alias("n"))
            .orderBy("l_returnflag"))


def _corpus_queries() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the ``llm`` subpackage and of the pipeline over it; none where they are not installed."""
    try:
        from boostframe.llm.queries import ORACLE_SQL, QUERIES as corpus
    except ImportError:            # the subpackage, or a library that only it needs, is not installed
        return {}, {}
    found, sql = dict(corpus), dict(ORACLE_SQL)
    try:
        import corpus_pipeline
    except ImportError:
        return found, sql
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _wrap(v) for k, v in {**QUERIES, **_corpus_queries()[0]}.items()}


def oracle_sql() -> dict[str, str]:
    from sql_oracles import sql_for
    return {**sql_for(), **_corpus_queries()[1]}
