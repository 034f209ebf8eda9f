"""Cross-validation and hyperparameter search.

Folds are a column of the binned table (stratified for classifiers, contiguous blocks for regressors,
in order of ``id`` then row hash). Every (combination, fold) model is a *dimension of the data*: all
of them grow in the same histogram passes, and each row's out-of-fold prediction is read from its own
fold's margin columns at the end — no per-fold job loop and no separate scoring pass.
"""

from __future__ import annotations

import itertools
import json
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import metrics as MX
from ..schemas import CLASSIFICATION, CV_SCORE_SCHEMA, SEARCH_SCHEMA, label_type_for
from ..sources import registry
from .common import check_target_range, code_column, decode_column, materialise, prepare, proba_columns, value_column
from .fit import build_model, make_specs, train_specs

MAX_MODELS_PER_PASS = 64


def _oof_margins(specs: list, first_model: int, cv: int) -> list[Column]:
    """Margins of each row taken from the model that did not see the row's fold."""
    k = specs[first_model].n_groups
    starts = np.concatenate([[0], np.cumsum([s.n_groups for s in specs])]).astype(int)
    cols = []
    for g in range(k):
        expr = None
        for f in range(cv):
            c = F.col(f"__m{starts[first_model + f] + g}")
            expr = F.when(F.col("__fold") == f, c) if expr is None else expr.when(F.col("__fold") == f, c)
        cols.append(expr)
    return cols


def _cv_run(df: DataFrame, target: str, estimator: str, id_col: str, plist: list[dict], cv: int):
    task = P.check_estimator(estimator)
    if not target:
        raise ValueError("cross-validation requires 'target' (the label column name)")
    prep = prepare(df, target, id_col, task, plist[0], cv=cv)
    specs = make_specs(prep, estimator, plist, list(range(cv)))
    return task, prep, specs


def cross_val_predict(df: DataFrame, target: str = "", estimator: str = "xgb_classifier", id: str = "",
                      params: str | dict | None = "", cv: int = 5) -> DataFrame:
    """One out-of-fold prediction per row (``[id] + prediction``); empty input → empty output."""
    task, p = P.resolve(estimator, params)
    if not target:
        raise ValueError("cross_val_predict requires 'target' (the label column name)")
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found in input; columns: {', '.join(df.columns)}")
    label_t = label_type_for(df.schema[target].dataType) if task == CLASSIFICATION else None
    id_field = [df.schema[id]] if id else []
    if df.isEmpty():
        from pyspark.sql import types as T
        pf = T.StructField("prediction", label_t if task == CLASSIFICATION else T.DoubleType(), False)
        return df.sparkSession.createDataFrame([], T.StructType(id_field + [pf]))
    _, prep, specs = _cv_run(df, target, estimator, id, [p], cv)
    results, final, release = train_specs(prep, specs)
    ms = _oof_margins(specs, 0, cv)
    if task == CLASSIFICATION:
        pred = decode_column(code_column(ms, specs[0].objective), prep.stats.classes, label_t)
    else:
        pred = value_column(ms[0], specs[0].objective)
    out = final.select(*([F.col("__id").alias(id)] if id else []), pred.alias("prediction"))
    # materialise before the training state is released
    cached = materialise(out)
    release()
    return cached


def _fold_scores(final: DataFrame, prep, specs: list, combos: int, cv: int, scoring: str) -> np.ndarray:
    """Score matrix [combos, folds] from the out-of-fold margins (one grouped aggregation)."""
    task = prep.stats.task
    k = specs[0].n_groups
    parts = []
    for c in range(combos):
        ms = _oof_margins(specs, c * cv, cv)
        fields = [F.lit(c).alias("combo"), F.col("__fold").alias("fold"), F.col("__y").alias("y")]
        if task == CLASSIFICATION:
            fields.append(code_column(ms, specs[c * cv].objective).cast("double").alias("pred"))
            if MX.needs_proba(scoring):
                pr = proba_columns(ms, specs[c * cv].objective)
                fields += [v.alias(f"p{j}") for j, v in enumerate(pr)]
        else:
            fields.append(value_column(ms[0], specs[c * cv].objective).alias("pred"))
        parts.append(F.struct(*fields))
    long = final.select(F.explode(F.array(*parts)).alias("r")).select("r.*")
    n_cls = len(prep.stats.classes) if prep.stats.classes else 2
    scores = MX.score(long, scoring, ["combo", "fold"], max(k, n_cls) if task == CLASSIFICATION else 2)
    out = np.full((combos, cv), np.nan)
    for r in scores.collect():
        out[int(r["combo"]), int(r["fold"])] = r["score"]
    return out


def cross_val_score(df: DataFrame, target: str = "", estimator: str = "xgb_classifier", id: str = "",
                    params: str | dict | None = "", cv: int = 5, scoring: str = "") -> DataFrame:
    """``(fold, score)`` per held-out fold; empty input → error."""
    task, p = P.resolve(estimator, params)
    scoring = MX.check_scoring(scoring, task)
    _, prep, specs = _cv_run(df, target, estimator, id, [p], cv)
    MX.check_classes(scoring, prep.stats.classes)
    _, final, release = train_specs(prep, specs)
    try:
        s = _fold_scores(final, prep, specs, 1, cv, scoring)[0]
    finally:
        release()
    return df.sparkSession.createDataFrame([(f, float(s[f])) for f in range(cv)], CV_SCORE_SCHEMA)


# ------------------------------------------------------------------ search


def parse_grid(estimator: Any) -> tuple[str, dict[str, list]]:
    """``{"xgb_classifier": {"max_depth": [3, 5]}}`` or ``("xgb_classifier", {...})`` → (name, grid)."""
    if isinstance(estimator, str):
        return estimator, {}
    if isinstance(estimator, tuple) and len(estimator) == 2:
        name, grid = estimator
    elif isinstance(estimator, dict) and len(estimator) == 1:
        name, grid = next(iter(estimator.items()))
    else:
        raise ValueError("estimator must be a single {estimator_name: {param: [values]}} entry")
    P.check_estimator(name)
    grid = dict(grid or {})
    for k, v in grid.items():
        if v is not None and not isinstance(v, (list, tuple)):
            raise ValueError(f"grid values for {k!r} must be a list")
    return name, grid


def expand_grid(grid: dict[str, list | None]) -> list[dict]:
    """All combinations, keys sorted, the last varying fastest. A parameter without a list, with an empty one or only with
    "" for objective or booster keeps its default and is not searched; single "" values there are left out."""
    def usable(key: str) -> list:
        return [v for v in grid[key] or () if not (key in ("objective", "booster") and v in (None, ""))]

    axes = [[(key, v) for v in usable(key)] for key in sorted(grid) if usable(key)]
    return [dict(choice) for choice in itertools.product(*axes)]


def _search(df: DataFrame, combos: list[dict], estimator: str, target: str, id_col: str, cv: int,
            scoring: str, model_name: str, root: str | None) -> DataFrame:
    task = P.check_estimator(estimator)
    if not target:
        raise ValueError("search requires 'target' (the label column name)")
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found in input; columns: {', '.join(df.columns)}")
    scoring = MX.check_scoring(scoring, task)
    if model_name:
        registry.validate_name(model_name)
    resolved = [P.resolve(estimator, c)[1] for c in combos]
    # combinations sharing the binning (and booster kind) train together, in batches of models
    groups: dict = {}
    for i, p in enumerate(resolved):
        groups.setdefault((p["max_bin"], p["tree_method"], p["booster"] == "gblinear"), []).append(i)
    scores = np.full((len(combos), cv), np.nan)
    kept: dict = {}                       # combination → rounds that its folds kept under early stopping
    stats = None
    for _, idx in groups.items():
        prep = prepare(df, target, id_col, task, resolved[idx[0]], cv=cv, keep_id=False)
        MX.check_classes(scoring, prep.stats.classes)
        for i in idx[1:]:
            if task != CLASSIFICATION:
                check_target_range(resolved[i].get("objective"), prep.stats.y_min, prep.stats.y_max)
        per = max(1, MAX_MODELS_PER_PASS // cv)
        try:
            for b in range(0, len(idx), per):
                chunk = idx[b:b + per]
                plist = [resolved[i] for i in chunk]
                specs = make_specs(prep, estimator, plist, list(range(cv)))
                state_prep = prep
                _, final, release = _train_keep_prep(state_prep, specs)
                try:
                    s = _fold_scores(final, prep, specs, len(chunk), cv, scoring)
                finally:
                    release()
                scores[chunk] = s
                for n, i in enumerate(chunk):
                    kept[i] = [specs[n * cv + f].best_round for f in range(cv)]
        finally:
            for d in prep.release:
                d.unpersist()
        stats = prep.whole
    means = scores.mean(axis=1)
    stds = scores.std(axis=1)
    order_key = np.where(np.isnan(means), -np.inf, means)
    ranks = [1 + int(np.sum(order_key > v)) for v in order_key]
    best = int(np.argmax(order_key))
    # refit the best combination on every row; its stored score is the CV mean
    p_best = resolved[best]
    if p_best["early_stopping_rounds"] is not None:       # all rows are learned from now, for as many rounds as the folds kept
        p_best = {**p_best, "early_stopping_rounds": None, "n_estimators": max(1, round(sum(kept[best]) / cv))}
    prep = prepare(df, target, id_col, task, p_best, stats=stats if groups and len(groups) == 1 else None, keep_id=False)
    specs = make_specs(prep, estimator, [p_best], None)
    results, _, release = train_specs(prep, specs)
    release()
    model = build_model(prep, estimator, target, p_best, specs[0], results[0], float(means[best]), model_name)
    if model_name:
        registry.save(df.sparkSession, model, model_name, root)
    blob = bytearray(model.to_bytes())
    rows = [(estimator, json.dumps(combos[i], sort_keys=True), float(means[i]), float(stds[i]), int(ranks[i]),
             blob if i == best else None) for i in range(len(combos))]
    return df.sparkSession.createDataFrame(rows, SEARCH_SCHEMA)


def _train_keep_prep(prep, specs):
    """Train without releasing the shared fold layout (released once per binning group)."""
    saved = prep.release
    prep.release = []
    try:
        return train_specs(prep, specs)
    finally:
        prep.release = saved


def grid_search(df: DataFrame, estimator: Any = "xgb_classifier", target: str = "", id: str = "", cv: int = 5,
                scoring: str = "", model_name: str = "", root: str | None = None) -> DataFrame:
    """Leaderboard ``estimator, params, mean_test_score, std_test_score, rank, model`` (model on the best row)."""
    name, grid = parse_grid(estimator)
    return _search(df, expand_grid(grid), name, target, id, cv, scoring, model_name, root)


def randomized_search(df: DataFrame, estimator: Any = "xgb_classifier", target: str = "", id: str = "",
                      n_iter: int = 10, cv: int = 5, scoring: str = "", random_state: int = 0,
                      model_name: str = "", root: str | None = None) -> DataFrame:
    """``min(n_iter, grid size)`` distinct combinations drawn without replacement (seeded)."""
    if n_iter < 1:
        raise ValueError("n_iter must be >= 1")
    name, grid = parse_grid(estimator)
    combos = expand_grid(grid)
    n = min(n_iter, len(combos))
    pick = np.random.RandomState(random_state & 0x7FFFFFFF).choice(len(combos), size=n, replace=False)
    return _search(df, [combos[i] for i in pick], name, target, id, cv, scoring, model_name, root)
