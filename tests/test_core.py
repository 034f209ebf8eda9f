"""Unit and property tests modelled on the reference's own test strategy: shapes, encodings, error
phrases, round-trips, defaults, and the pinned properties (accuracy > 0.9, probabilities sum to 1,
string labels stay strings, SHAP additivity, leaf-list length, one best model per leaderboard)."""

from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

import boostframe as bf
from boostframe import params as P
from boostframe.functions import shap as S
from boostframe.functions.kernel import build_forest, margins
from boostframe.model import Model
from boostframe.operators.dependence import partial_dependence
from boostframe.operators.evaluate import (cross_val_predict, cross_val_score, expand_grid, grid_search,
                                           randomized_search)
from boostframe.operators.explain import explain
from boostframe.operators.importance import feature_importance, permutation_importance
from boostframe.sources.datasets import make_classification, make_regression, normalize_names
from boostframe.sources import registry

from .conftest import SF

FEATS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@pytest.fixture(scope="module")
def li(spark):
    return spark.read.parquet(f"{SF}/lineitem.parquet")


@pytest.fixture(scope="module")
def li_multi(li):
    return li.select(*[F.col(c).cast("double").alias(c) for c in FEATS],
                     F.expr("CASE WHEN l_quantity <= 15 THEN 'low' WHEN l_quantity <= 35 THEN 'mid' ELSE 'high' END")
                     .alias("target"))


@pytest.fixture(scope="module")
def li_reg(li):
    return li.select(*[F.col(c).cast("double").alias(c) for c in FEATS],
                     (F.col("l_quantity") * (1 - F.col("l_discount"))).alias("target"))


@pytest.fixture(scope="module")
def cattrain(spark):
    """Labels that follow from the colour alone, with scores missing in every fifth row."""
    colors = ["amber", "teal", "red", "teal", "amber", "red"]
    rows = [(i, colors[i % 6], None if i % 5 == 2 else i * 0.75, int(colors[i % 6] != "red")) for i in range(24)]
    return spark.createDataFrame(rows, "id int, color string, score double, target int")


# ---------------------------------------------------------------- parameters and names

def test_params_defaults_and_errors():
    task, p = P.resolve("xgb_classifier", "")
    assert task == "classification" and p["n_estimators"] == 100 and p["max_depth"] == 6
    with pytest.raises(ValueError, match="unknown hyperparameter"):
        P.resolve("xgb_classifier", '{"bogus": 1}')
    with pytest.raises(ValueError, match="unknown estimator"):
        P.resolve("nope", "")
    with pytest.raises(ValueError, match="JSON object"):
        P.resolve("xgb_regressor", "[1, 2]")
    _, rf = P.resolve("xgb_rf_regressor", "")
    assert rf["learning_rate"] == 1.0 and rf["subsample"] == 0.8 and P.training_shape("xgb_rf_regressor", rf) == (1, 100)


def test_typed_default_equals_bare():
    typed = P.typed_params()
    _, a = P.resolve("xgb_classifier", typed)
    _, b = P.resolve("xgb_classifier", "")
    assert a == b


def test_normalize_names():
    assert normalize_names(["Sepal Length (cm)", "sepal length cm", "1abc", "", "A-B"]) == \
        ["sepal_length_cm", "sepal_length_cm_2", "f_1abc", "feature", "a_b"]


def test_expand_grid_order():
    combos = expand_grid({"max_depth": [3, 5], "learning_rate": [0.1, 0.2], "objective": [""]})
    assert combos == [{"learning_rate": 0.1, "max_depth": 3}, {"learning_rate": 0.1, "max_depth": 5},
                      {"learning_rate": 0.2, "max_depth": 3}, {"learning_rate": 0.2, "max_depth": 5}]
    assert expand_grid({}) == [{}]


def test_registry_name_rule():
    for bad in ["", "../x", "a/b", "-x", "a..b"]:
        with pytest.raises(ValueError):
            registry.validate_name(bad)
    assert registry.validate_name("iris_clf.v1-2") == "iris_clf.v1-2"


# ---------------------------------------------------------------- fit / predict

def test_fit_predict_multiclass_string_labels(spark, li_multi):
    out = bf.fit(li_multi, target="target", params={"n_estimators": 5, "max_depth": 3}).first()
    assert out["task"] == "classification" and out["n_classes"] == 3 and out["train_score"] > 0.9
    m = Model.from_bytes(out["model"])
    pred = bf.predict(li_multi, model=out["model"], with_proba=True)
    assert dict(pred.dtypes)["prediction"] == "string"
    assert pred.columns == ["prediction", "proba_high", "proba_low", "proba_mid"]
    s = pred.select((F.col("proba_high") + F.col("proba_low") + F.col("proba_mid") - 1).alias("d"))
    assert s.agg(F.max(F.abs("d"))).first()[0] < 1e-6
    leaves = bf.predict(li_multi, model=m, pred_leaf=True).first()["leaf"]
    assert len(leaves) == 5 * 3


def test_reordered_columns_and_missing_feature(spark, li_reg):
    m = bf.fit_model(li_reg, target="target", estimator="xgb_regressor", params={"n_estimators": 2, "max_depth": 2})
    shuffled = li_reg.select("l_tax", "target", "l_linenumber", "l_quantity", "l_discount", F.lit(1).alias("extra"))
    assert bf.predict(shuffled, model=m).count() == li_reg.count()
    with pytest.raises(ValueError, match="not present in the input"):
        bf.predict(li_reg.drop("l_tax"), model=m)
    with pytest.raises(ValueError, match="mutually exclusive"):
        bf.predict(li_reg, model=m, with_proba=True, output_margin=True)


def test_refuse_timestamp_and_free_text(spark, li):
    with pytest.raises(ValueError, match="neither numeric nor a categorical"):
        bf.fit(li.select("l_quantity", "l_shipdate", "l_returnflag"), target="l_returnflag")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    if docs.select("text").distinct().count() > 1100:
        with pytest.raises(ValueError, match="free-text"):
            bf.fit(docs.select("text", "lang"), target="lang")


def test_errors_before_jobs(spark, li_reg):
    with pytest.raises(ValueError, match="requires 'target'"):
        bf.fit(li_reg, estimator="xgb_regressor")
    with pytest.raises(ValueError, match="not found"):
        bf.fit(li_reg, target="nope", estimator="xgb_regressor")
    with pytest.raises(ValueError, match="either 'model_name' or 'model'"):
        bf.predict(li_reg)
    with pytest.raises(ValueError, match="no rows"):
        bf.fit(li_reg.where("1 = 0"), target="target", estimator="xgb_regressor")


def test_categorical_missing_unseen(spark, cattrain):
    out = bf.fit(cattrain, target="target", id="id", params={"n_estimators": 10, "max_depth": 2}).first()
    assert out["features"] == ["color", "score"] and out["train_score"] == 1.0
    score_rows = spark.createDataFrame([(99, "PURPLE", 3.0), (98, "red", None)], "id int, color string, score double")
    pred = bf.predict(score_rows, model=out["model"], id="id").orderBy("id").collect()
    assert [r["id"] for r in pred] == [98, 99]
    assert pred[0]["prediction"] == 0


def test_registry_lifecycle(spark, li_reg, tmp_path):
    root = str(tmp_path / "models")
    assert registry.list_models(spark, root).count() == 0
    bf.fit(li_reg, target="target", estimator="xgb_regressor", model_name="m1", params={"n_estimators": 2}, root=root)
    info = registry.model_info(spark, "m1", root).first()
    assert info["model_name"] == "m1" and info["n_features"] == 4 and info["n_classes"] is None
    assert registry.model_info(spark, "absent", root).count() == 0
    by_name = bf.predict(li_reg, model_name="m1", root=root).count()
    assert by_name == li_reg.count()
    assert registry.drop_model(spark, "m1", root).first()["dropped"] is True
    assert registry.drop_model(spark, "m1", root).first()["dropped"] is False


def test_bad_model_value():
    with pytest.raises(ValueError, match="not a model value"):
        Model.from_bytes(b"xyz")


# ---------------------------------------------------------------- evaluation and search

def test_cross_validation(spark, li_reg, li_multi):
    cvs = cross_val_score(li_reg, target="target", estimator="xgb_regressor", params={"n_estimators": 3}, cv=3)
    rows = cvs.collect()
    assert [r["fold"] for r in rows] == [0, 1, 2] and all(r["score"] > 0.5 for r in rows)
    cvp = cross_val_predict(li_multi, target="target", params={"n_estimators": 3, "max_depth": 3}, cv=3)
    assert cvp.count() == li_multi.count() and dict(cvp.dtypes)["prediction"] == "string"
    assert cross_val_predict(li_multi.where("1 = 0"), target="target").count() == 0
    with pytest.raises(ValueError, match="unknown scoring"):
        cross_val_score(li_reg, target="target", estimator="xgb_regressor", scoring="nope")


def test_grid_and_randomized_search(spark, li_reg):
    lb = grid_search(li_reg, {"xgb_regressor": {"max_depth": [1, 2], "n_estimators": [2, 3]}}, target="target", cv=3)
    rows = lb.collect()
    assert len(rows) == 4 and sum(r["model"] is not None for r in rows) == 1
    best = [r for r in rows if r["model"] is not None][0]
    assert best["rank"] == 1
    rs = randomized_search(li_reg, {"xgb_regressor": {"max_depth": [1, 2], "n_estimators": [2]}}, target="target",
                           n_iter=10, cv=3)
    assert rs.count() == 2   # n_iter is capped at the grid size


# ---------------------------------------------------------------- interpretation

def test_importance_and_dependence(spark, li_reg):
    m = bf.fit_model(li_reg, target="target", estimator="xgb_regressor", params={"n_estimators": 3, "max_depth": 2})
    for it in ["weight", "gain", "cover", "total_gain", "total_cover"]:
        fi = feature_importance(spark, model=m, importance_type=it).collect()
        assert [r["rank"] for r in fi] == [1, 2, 3, 4]
    assert feature_importance(spark, model=m).first()["feature"] == "l_quantity"
    with pytest.raises(ValueError, match="invalid importance_type"):
        feature_importance(spark, model=m, importance_type="nope")
    pdp = partial_dependence(li_reg, model=m, feature="l_quantity", grid_resolution=20).collect()
    assert len(pdp) == 20 and all(r["class"] is None for r in pdp)
    pi = permutation_importance(li_reg, model=m, target="target", n_repeats=2).collect()
    assert pi[0]["feature"] == "l_quantity" and pi[0]["rank"] == 1


def test_shap_additivity(spark, li_multi):
    m = bf.fit_model(li_multi, target="target", params={"n_estimators": 3, "max_depth": 3})
    small = li_multi.limit(200)
    ex = explain(small.withColumn("rid", F.monotonically_increasing_id()), model=m, id="rid")
    sums = ex.groupBy("rid", "class").agg(F.sum("shap_value").alias("s"), F.first("base_value").alias("b"))
    margins_df = bf.predict(small.withColumn("rid", F.monotonically_increasing_id()), model=m, id="rid",
                            output_margin=True)
    assert "class" in ex.columns and sums.count() == 200 * 3
    # per-class additivity against the model's own margins
    pdf = small.toPandas()
    from boostframe.operators.predict import Scorer
    import pyarrow as pa
    sc = Scorer(m)
    M = sc.margins(sc.matrix(pa.RecordBatch.from_pandas(pdf, preserve_index=False)))
    got = sums.orderBy("rid", "class").toPandas()
    assert np.max(np.abs(got["s"].values + got["b"].values - M.ravel())) < 1e-6
    assert margins_df.count() == 200


def test_tree_shap_matches_brute_force():
    # a depth-2 tree over 3 features; Shapley values by enumerating coalitions with cover weighting
    tree = {"feat": [0, 1, -1, -1, 2, -1, -1][:0] or [0, 1, 2, -1, -1, -1, -1],
            "thr": [0.5, 0.5, 0.5, 0, 0, 0, 0], "dleft": [True] * 7,
            "left": [1, 3, 5, -1, -1, -1, -1], "right": [2, 4, 6, -1, -1, -1, -1],
            "value": [0, 0, 0, 1.0, 2.0, 4.0, 8.0], "cats": [None] * 7}
    cover = np.array([10.0, 6.0, 4.0, 2.0, 4.0, 3.0, 1.0])
    fr = build_forest([tree], [0], [1.0])
    X = np.array([[0.0, 1.0, 1.0], [1.0, 0.0, 0.0], [1.0, 1.0, 0.0]])

    def cond_exp(x, known):
        def rec(node):
            f = fr.feat[node]
            if f < 0:
                return fr.value[node]
            if f in known:
                return rec(fr.left[node] if x[f] < fr.thr[node] else fr.right[node])
            l, r = fr.left[node], fr.right[node]
            return (cover[l] * rec(l) + cover[r] * rec(r)) / cover[node]
        return rec(0)

    for x in X:
        phi = np.zeros((1, 3))
        S.tree_shap(fr, cover, x[None, :], 0, phi)
        from math import factorial
        for i in range(3):
            others = [j for j in range(3) if j != i]
            v = 0.0
            for k in range(3):
                for sub in itertools.combinations(others, k):
                    w = factorial(len(sub)) * factorial(3 - len(sub) - 1) / factorial(3)
                    v += w * (cond_exp(x, set(sub) | {i}) - cond_exp(x, set(sub)))
            assert abs(phi[0, i] - v) < 1e-9
        assert abs(phi.sum() + S.expected_value(fr, cover, 0) - margins(fr, x[None, :], np.zeros(1), 1)[0, 0]) < 1e-9


# ---------------------------------------------------------------- sources

def test_generators(spark):
    mc = make_classification(spark, n_samples=200, n_features=6, n_classes=4)
    assert mc.columns == ["sample_id"] + [f"feature_{i}" for i in range(6)] + ["target"]
    assert sorted(r[0] for r in mc.select("target").distinct().collect()) == [0, 1, 2, 3]
    mr = make_regression(spark, n_samples=120, n_features=5)
    assert mr.count() == 120 and dict(mr.dtypes)["target"] == "double"
    # partition-independent
    a = make_regression(spark, 50, 3).toPandas()
    b = make_regression(spark, 50, 3).repartition(7).orderBy("sample_id").toPandas()
    assert np.allclose(a.values, b.values)


def test_gblinear_and_rf_and_dart(spark, li_reg):
    lin = bf.fit(li_reg, target="target", estimator="xgb_regressor",
                 params={"booster": "gblinear", "n_estimators": 5}).first()
    assert lin["train_score"] > 0.3   # 5 coordinate-descent rounds: learning, not converged
    assert bf.predict(li_reg, model=lin["model"]).count() == li_reg.count()
    rf = bf.fit_xgb_rf_regressor(li_reg, target="target", n_estimators=10, max_depth=3).first()
    assert Model.from_bytes(rf["model"]).n_trees == 10
    dart = bf.fit(li_reg, target="target", estimator="xgb_regressor",
                  params={"booster": "dart", "n_estimators": 3, "max_depth": 2}).first()
    assert dart["train_score"] > 0.5


def test_dart_weights_consistent_with_state(spark, li_reg):
    from boostframe.functions.metrics import score
    m = bf.fit_model(li_reg, target="target", estimator="xgb_regressor",
                     params={"booster": "dart", "n_estimators": 6, "max_depth": 2, "rate_drop": 0.5})
    assert any(abs(w - 1.0) > 1e-12 for w in m.tree_weight)     # some trees were re-weighted
    p = bf.predict(li_reg, model=m, id="target").select(F.col("target").alias("y"), F.col("prediction").alias("pred"),
                                                          F.lit(0).alias("g"))
    r2 = score(p, "r2", ["g"]).first()["score"]
    assert abs(r2 - m.meta.train_score) < 1e-9
