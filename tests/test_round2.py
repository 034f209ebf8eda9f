"""Rows without an id, large targets, linear models, growth, scorers, grids, streams and names."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import boostframe as bf
from boostframe.functions import metrics as MX
from boostframe.operators.evaluate import cross_val_score, expand_grid
from boostframe.operators.explain import explain
from boostframe.operators.importance import node_table
from boostframe.sources import registry, views
from tests.conftest import spark  # noqa: F401


def scores(df):
    return [r["score"] for r in df.orderBy("fold").collect()]


def test_equal_rows_score_as_with_an_id(spark):  # noqa: F811
    rows = spark.range(900).select("id", (F.col("id") % 9).cast("double").alias("x"), (F.col("id") % 9 % 2).alias("y"))
    options = dict(target="y", params={"n_estimators": 4, "max_depth": 4}, cv=3)
    with_id = scores(cross_val_score(rows, id="id", **options))
    without = scores(cross_val_score(rows.drop("id"), **options))
    assert min(with_id) == 1.0 and min(without) == 1.0
    flat = rows.drop("id").withColumn("y", F.col("x") * 2)
    assert min(scores(cross_val_score(flat, target="y", estimator="xgb_regressor", cv=3,
                                          params={"n_estimators": 5, "max_depth": 4, "learning_rate": 0.8}))) > 0.9


def test_equal_rows_are_sampled_one_by_one(spark):  # noqa: F811
    rows = spark.range(4000).select((F.col("id") % 2).cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("y"))
    m = bf.fit_model(rows, target="y", estimator="xgb_regressor", params={"n_estimators": 6, "max_depth": 1, "subsample": 0.5})
    covers = [r["cover"] for r in node_table(spark, model=m).where("node_id = 0").collect()]
    assert len(covers) == 6 and all(1700 < c < 2300 for c in covers) and len(set(covers)) > 1
    again = bf.fit_model(rows.repartition(3), target="y", estimator="xgb_regressor",
                         params={"n_estimators": 6, "max_depth": 1, "subsample": 0.5})
    assert again.nodes["leaf_value"] == m.nodes["leaf_value"]


@pytest.mark.parametrize("factor", [1e-9, 1.0, 1e9, 1e11])
def test_targets_of_any_size(spark, factor):  # noqa: F811
    rows = spark.range(3000).select((F.col("id") % 50).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("z"),
                                    ((F.col("id") % 50 + F.col("id") % 7) * factor).alias("y"))
    m = bf.fit_model(rows, target="y", estimator="xgb_regressor",
                     params={"n_estimators": 6, "max_depth": 3, "learning_rate": 0.8, "min_child_weight": 0.0})
    if factor >= 1:
        assert m.meta.train_score > 0.97
    else:                                    # the least gain of a split is a fixed number, as in the library: nothing to split
        assert np.isfinite(m.meta.train_score)


def test_linear_model_of_equal_columns_converges(spark):  # noqa: F811
    x = F.col("id").cast("double") / 100
    rows = spark.range(400).select(*[x.alias(f"x{j}") for j in range(20)], (3 * x - 2).alias("y"), F.col("id"))
    m = bf.fit_model(rows, target="y", id="id", estimator="xgb_regressor", params={"booster": "gblinear", "n_estimators": 60})
    assert m.meta.train_score > 0.99
    parts = explain(rows, model=m, id="id").groupBy("id").agg((F.sum("shap_value") + F.first("base_value")).alias("v"))
    both = parts.join(bf.predict(rows, model=m, id="id"), "id").agg(F.max(F.abs(F.col("v") - F.col("prediction")))).first()[0]
    assert both < 1e-9
    short = bf.fit_xgb_regressor(rows.drop("id"), target="y", booster="gblinear").first()
    assert short["train_score"] > 0.99                                   # typed fit takes the linear defaults


@pytest.mark.parametrize("objective", ["count:poisson", "reg:gamma", "reg:tweedie", "reg:pseudohubererror", "reg:squaredlogerror"])
def test_objectives_learn(spark, objective):  # noqa: F811
    rows = spark.range(2000).select((F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 20 % 5 + 1.0).alias("y"))
    fast = objective in ("count:poisson", "reg:gamma", "reg:tweedie")         # the others overshoot at a high rate
    params = {"n_estimators": 7, "max_depth": 5, "learning_rate": 0.8} if fast else {"n_estimators": 60, "max_depth": 4}
    m = bf.fit_model(rows, target="y", estimator="xgb_regressor", params={**params, "objective": objective})
    assert m.meta.train_score > 0.9
    with pytest.raises(ValueError, match="not defined"):
        bf.fit_model(rows.withColumn("y", F.col("y") - 9), target="y", estimator="xgb_regressor",
                     params={"objective": "reg:gamma"})


def test_best_first_growth_differs_and_respects_its_limit(spark):  # noqa: F811
    x = F.col("id") % 64
    rows = spark.range(6400).select(x.cast("double").alias("x"), F.when(x < 32, x * x).otherwise(F.lit(-500.0)).alias("y"))
    trees = {}
    for policy in ("depthwise", "lossguide"):
        m = bf.fit_model(rows, target="y", estimator="xgb_regressor",
                         params={"n_estimators": 1, "max_depth": 0, "max_leaves": 6, "grow_policy": policy})
        leaves = node_table(spark, model=m).where("feature IS NULL").count()
        assert leaves == 6
        trees[policy] = m.meta.train_score
    assert trees["lossguide"] >= trees["depthwise"]


def test_scorers(spark):  # noqa: F811
    rng = np.random.default_rng(0)
    y, p = rng.integers(0, 2, 400), rng.random(400).round(2)
    frame = spark.createDataFrame([(float(a), float(b > 0.5), float(1 - b), float(b), 0) for a, b in zip(y, p)],
                                  "y double, pred double, p0 double, p1 double, g int")
    got = {s: MX.score(frame, s, ["g"]).first()["score"] for s in
           ("average_precision", "neg_brier_score", "matthews_corrcoef", "roc_auc", "roc_auc_ovr")}
    order = sorted(set(p), reverse=True)
    hits, seen, ap, last = 0, 0, 0.0, 0.0
    for v in order:
        hits += int(y[p == v].sum())
        seen += int((p == v).sum())
        ap += (hits / y.sum() - last) * hits / seen
        last = hits / y.sum()
    pos, neg = p[y == 1], p[y == 0]
    auc = ((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean())
    assert got["average_precision"] == pytest.approx(ap) and got["roc_auc"] == pytest.approx(auc)
    assert got["roc_auc_ovr"] == pytest.approx(auc)
    assert got["neg_brier_score"] == pytest.approx(-((p - y) ** 2).mean())
    assert got["matthews_corrcoef"] == pytest.approx(np.corrcoef(y, p > 0.5)[0, 1])
    far = spark.createDataFrame([(1e9 + i, 1e9 + i + (i % 2) - 0.5, 0) for i in range(4)], "y double, pred double, g int")
    assert MX.score(far, "r2", ["g"]).first()["score"] == pytest.approx(0.8)
    with pytest.raises(ValueError, match="two classes"):
        MX.check_classes("roc_auc", ["a", "b", "c"])
    with pytest.raises(ValueError, match="regression"):
        MX.check_scoring("accuracy", "regression")


def test_grids():
    assert expand_grid({"objective": ["", "binary:logistic"]}) == [{"objective": "binary:logistic"}]
    assert expand_grid({"max_depth": [], "n_estimators": [2, 4]}) == [{"n_estimators": 2}, {"n_estimators": 4}]
    assert expand_grid({"max_depth": None, "objective": [""]}) == [{}] and expand_grid({}) == [{}]


def test_forest_keeps_the_values_it_is_given(spark):  # noqa: F811
    rows = spark.range(600).select((F.col("id") % 6).cast("double").alias("x"), (F.col("id") % 6).cast("double").alias("y"))
    blob = bf.fit_xgb_rf_regressor(rows, target="y", n_estimators=2, subsample=1.0, learning_rate=0.3).first()["model"]
    params = bf.Model.from_bytes(blob).meta.params
    assert params["subsample"] == 1.0 and params["learning_rate"] == 0.3 and params["colsample_bynode"] == 0.8


@pytest.mark.parametrize("name,good", [("iris_clf-1.2", True), ("abc\n", False), ("", False), ("../etc", False), ("a/b", False),
                                       (".hidden", False), ("with space", False), ("a..b", False)])
def test_names(name, good):
    if good:
        assert registry.validate_name(name) == name
    else:
        with pytest.raises(ValueError):
            registry.validate_name(name)


def test_all_null_labels(spark):  # noqa: F811
    rows = spark.range(10).select(F.col("id").cast("double").alias("x"), F.lit(None).cast("string").alias("y"))
    with pytest.raises(ValueError, match="no usable"):
        bf.fit_model(rows, target="y")


def test_streams_do_not_meet(spark, tmp_path):  # noqa: F811
    from boostframe.streaming.stream import score_files_once
    rows = spark.range(200).select("id", (F.col("id") % 10).cast("double").alias("x"))
    rows.write.parquet(str(tmp_path / "in"))
    rows.coalesce(1).write.parquet(str(tmp_path / "other"))
    for sign in (1.0, -7.0):
        m = bf.fit_model(rows.select("x", (F.col("x") * sign).alias("y")), target="y", estimator="xgb_regressor",
                         params={"n_estimators": 3})
        for folder in ("in", "other"):
            got = score_files_once(spark, str(tmp_path / folder), m, "id", str(tmp_path / "work"))
            want = bf.predict(rows, model=m, id="id")
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_views(spark, tmp_path):  # noqa: F811
    rows = spark.range(60).select((F.col("id") % 6).cast("double").alias("x"), (F.col("id") % 6).cast("double").alias("y"))
    for n in (2, 3):                                                   # the second model takes the first one's place
        bf.fit(rows, target="y", model_name="m.1", estimator="xgb_regressor", params={"n_estimators": n}, root=str(tmp_path))
    views.register_views(spark, str(tmp_path))
    assert [r["model_name"] for r in spark.sql("SELECT model_name FROM list_models").collect()] == ["m.1"]
    views.publish(bf.predict(rows, model_name="m.1", root=str(tmp_path)), "scored")
    assert spark.sql("SELECT count(*) FROM scored").first()[0] == 60


@pytest.mark.parametrize("booster", ["gbtree", "dart"])
def test_margins_between_rewrites_are_those_of_the_model(spark, booster):  # noqa: F811
    """25 rounds cross two checkpoints; the state's last margins must be what the stored trees give."""
    rows = spark.range(500).select((F.col("id") % 25).cast("double").alias("x"), (F.col("id") % 4).cast("double").alias("z"),
                                   ((F.col("id") % 25) * (F.col("id") % 4)).cast("double").alias("y"))
    m = bf.fit_model(rows, target="y", estimator="xgb_regressor",
                     params={"n_estimators": 25, "max_depth": 2, "booster": booster, "rate_drop": 0.2})
    both = bf.predict(rows, model=m, id="y")
    sse, sst = both.agg(F.sum((F.col("y") - F.col("prediction")) ** 2), F.var_pop("y") * F.count(F.lit(1))).first()
    assert m.meta.train_score == pytest.approx(1 - sse / sst, abs=1e-9)
