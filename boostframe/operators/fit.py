"""``fit`` and the typed ``fit_xgb_*`` functions."""

from __future__ import annotations

import math
from typing import Any

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.kernel import FIXED_SCALE, scale_for
from ..model import Model, ModelMeta, now_utc
from ..plans.binning import look_up
from ..plans.train import ModelSpec, train
from ..schemas import CLASSIFICATION, FIT_SCHEMA, label_type_for
from ..sources import registry
from .common import (Prepared, base_margin, code_column, objective_for, order_centres, prepare, target_sums,
                     value_column, with_margins)
from .linear import train_linear


def make_specs(prep: Prepared, estimator: str, plist: list[dict], folds: list[int] | None) -> list[ModelSpec]:
    """One spec per (params, fold); fold -1 = all rows."""
    stats = prep.stats
    n_classes = len(stats.classes) if stats.classes is not None else None
    sums = target_sums(prep) if folds and folds != [-1] else None
    categorical = [f.categorical for f in stats.features]
    specs = []
    for p in plist:
        objective, k = objective_for(stats.task, n_classes, p)
        rounds, parallel = P.training_shape(estimator, p)
        signs = P.monotone_signs(p, stats.names, categorical)
        quantile = P.order_quantile(objective, p)
        watched = p["early_stopping_rounds"] is not None or "__val" in prep.state.columns
        metric = P.eval_metric(objective, p) if watched and p["booster"] == "gbtree" else None
        centres = order_centres(prep, quantile, folds or [-1]) if quantile is not None and p["base_score"] is None else None
        for f in (folds or [-1]):
            if f < 0:
                n = stats.n_rows
                if stats.task == CLASSIFICATION:
                    ys = float(stats.class_counts[1]) if len(stats.class_counts) > 1 else 0.0
                else:
                    ys = stats.y_sum
            else:
                n = sum(v[0] for fk, v in sums.items() if fk != f)
                ys = sum(v[1] for fk, v in sums.items() if fk != f)
            base = base_margin(objective, k, p, ys, n) if centres is None else np.array([centres[f]])
            specs.append(ModelSpec(p, rounds, parallel, objective, k, base, test_fold=f, n_train=n,
                                   seed=int(p["random_state"]), g_scale=_gradient_scale(stats, objective, base),
                                   h_scale=_curvature_scale(stats, objective, p),
                                   monotone=None if signs is None else np.array(signs),
                                   groups=P.interaction_groups(p, stats.names), leaf_quantile=quantile,
                                   metric=metric, metric_scale=_metric_scale(stats, metric)))
    return specs


def _gradient_scale(stats, objective: str, base: np.ndarray) -> float:
    """Fixed-point scale of the gradients: they stay within the spread of the target around the starting margin where the
    loss is squared or its mean has a logarithmic link; elsewhere they are ordinary numbers."""
    if stats.task == CLASSIFICATION or objective not in ("reg:squarederror", "count:poisson", "reg:tweedie"):
        return FIXED_SCALE
    centre = float(base[0]) if objective == "reg:squarederror" else 0.0
    return scale_for(max(abs(stats.y_max - centre), abs(stats.y_min - centre), stats.y_max - stats.y_min))


def _curvature_scale(stats, objective: str, p: dict) -> float:
    """Fixed-point scale of the second derivatives: Poisson's are as large as the target, the others ordinary numbers."""
    if stats.task == CLASSIFICATION or objective != "count:poisson":
        return FIXED_SCALE
    return scale_for(stats.y_max * math.exp(p["max_delta_step"] or 0.7))


def _metric_scale(stats, metric: str | None) -> float:
    """Fixed-point scale of the sums of an evaluation metric."""
    if metric not in ("rmse", "mae"):
        return FIXED_SCALE
    spread = max(abs(stats.y_max), abs(stats.y_min), stats.y_max - stats.y_min)
    return min(FIXED_SCALE, scale_for(spread * spread if metric == "rmse" else spread))


def train_specs(prep: Prepared, specs: list[ModelSpec]):
    """Train (tree or linear boosters) and return ``(per-model results, final state, cleanup)``."""
    state = with_margins(prep, specs)
    if specs[0].params["booster"] == "gblinear":
        result, final, cleanup = train_linear(state, prep.stats, specs, prep.has_fold)
    else:
        result, final, cleanup = train(state, prep.stats, specs, prep.has_fold)

    def release() -> None:
        cleanup()
        state.unpersist()
        for d in prep.release:
            d.unpersist()

    return result, final, release


def margin_cols(specs: list[ModelSpec], mi: int) -> list[str]:
    start = sum(s.n_groups for s in specs[:mi])
    return [f"__m{start + k}" for k in range(specs[mi].n_groups)]


def in_sample_score(final: DataFrame, spec: ModelSpec, cols: list[str], task: str, y_mean: float) -> float:
    ms = [F.col(c) for c in cols]
    final = final.where("NOT __val") if "__val" in final.columns else final
    if task == CLASSIFICATION:
        code = code_column(ms, spec.objective)
        row = final.agg(F.avg((code.cast("double") == F.col("__y")).cast("double")).alias("acc")).first()
        return float(row["acc"])
    value = value_column(ms[0], spec.objective)
    row = final.agg(F.sum((F.col("__y") - value) ** 2).alias("sse"),
                    F.sum((F.col("__y") - F.lit(y_mean)) ** 2).alias("sst")).first()
    sse, sst = float(row["sse"]), float(row["sst"])
    if sst == 0.0:
        return 1.0 if sse == 0.0 else 0.0
    return 1.0 - sse / sst


def build_model(prep: Prepared, estimator: str, target: str, p: dict, spec: ModelSpec, result: Any,
                train_score: float | None, name: str = "") -> Model:
    stats = prep.stats
    infos = stats.features if p["booster"] == "gblinear" else look_up(stats, result)
    meta = ModelMeta(
        name=name, estimator=estimator, task=stats.task, target=target, feature_names=stats.names,
        params={k: v for k, v in p.items()},
        categorical=[f.categorical for f in stats.features],
        categories=[f.model_categories() for f in infos], open_dictionary=[f.categorical and f.wide is not None for f in infos],
        classes=stats.classes, label_type=label_type_for(stats.target_type).simpleString()
        if stats.classes is not None else "double",
        n_samples=stats.n_rows, n_features=len(stats.features), train_score=train_score,
        created_at=now_utc(), objective=spec.objective, n_groups=spec.n_groups,
        base_margin=[float(v) for v in spec.base], booster=p["booster"], eval_metric=spec.metric,
        eval_scores=spec.history or None, best_round=spec.best_round)
    if p["booster"] == "gblinear":
        meta.linear_weights, meta.linear_bias = result
        return Model(meta, Model.empty_nodes(), [], [])
    return Model.from_growers(meta, result, infos)


def fit_model(df: DataFrame, target: str = "", estimator: str = "xgb_classifier", id: str = "",
              params: str | dict | None = "", model_name: str = "", root: str | None = None, validation: str = "") -> Model:
    """Train one model on all rows of ``df``; store it when ``model_name`` is given.

    Rows where the column ``validation`` is true are not learned from; the model's ``eval_scores`` hold their
    ``eval_metric`` after every round, and with ``early_stopping_rounds`` training ends when it has not fallen for so many
    rounds and the model keeps the rounds up to the best one.
    """
    task, p = P.resolve(estimator, params)
    if not target:
        raise ValueError("fit requires 'target' (the label column name)")
    if model_name:
        registry.validate_name(model_name)
    prep = prepare(df, target, id, task, p, validation=validation)
    specs = make_specs(prep, estimator, [p], None)
    results, final, release = train_specs(prep, specs)
    try:
        y_mean = prep.stats.y_sum / prep.stats.n_rows
        score = in_sample_score(final, specs[0], margin_cols(specs, 0), task, y_mean)
    finally:
        release()
    model = build_model(prep, estimator, target, p, specs[0], results[0], score, model_name)
    if model_name:
        registry.save(df.sparkSession, model, model_name, root)
    return model


def summary_frame(spark, model: Model) -> DataFrame:
    m = model.meta
    row = (m.name or "", m.estimator, m.task, int(m.n_samples), int(m.n_features),
           len(m.classes) if m.classes is not None and m.task == CLASSIFICATION else None,
           m.train_score, list(m.feature_names), bytearray(model.to_bytes()))
    return spark.createDataFrame([row], FIT_SCHEMA)


def fit(df: DataFrame, target: str = "", model_name: str = "", estimator: str = "xgb_classifier",
        id: str = "", params: str | dict | None = "", root: str | None = None, validation: str = "") -> DataFrame:
    """One summary row: model_name, estimator, task, n_samples, n_features, n_classes, train_score,
    features, model (BINARY)."""
    model = fit_model(df, target, estimator, id, params, model_name, root, validation)
    return summary_frame(df.sparkSession, model)


def _typed(estimator: str):
    def fit_typed(df: DataFrame, target: str = "", model_name: str = "", id: str = "",
                  root: str | None = None, **hyper: Any) -> DataFrame:
        p = P.typed_params(**hyper)
        # presets of the estimator (random forest) or booster (linear) stand where the caller gave no value
        p = {k: v for k, v in p.items() if k in hyper or not (
            (k in P.RF_OVERRIDES and estimator.startswith("xgb_rf")) or (k in P.LINEAR_DEFAULTS and p.get("booster") == "gblinear"))}
        return fit(df, target=target, model_name=model_name, estimator=estimator, id=id, params=p, root=root)

    fit_typed.__name__ = f"fit_{estimator}"
    fit_typed.__doc__ = (f"Typed fit for {estimator!r}: " + ", ".join(f"{k}={v!r}"
                                                                      for k, v in P.TYPED_PARAMS.items()))
    return fit_typed


fit_xgb_classifier = _typed("xgb_classifier")
fit_xgb_regressor = _typed("xgb_regressor")
fit_xgb_rf_classifier = _typed("xgb_rf_classifier")
fit_xgb_rf_regressor = _typed("xgb_rf_regressor")

__all__ = ["fit", "fit_model", "fit_xgb_classifier", "fit_xgb_regressor", "fit_xgb_rf_classifier",
           "fit_xgb_rf_regressor"]
