"""Shared pieces of the operators: model resolution, training preparation, prediction expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.kernel import LOG_LINK
from ..model import Model
from ..plans import ranks
from ..plans.binning import DataStats, binned_table, collect_stats, fold_local, materialise, sum_value, table_inputs, target_sum  # noqa: F401
from ..plans.features import feature_columns, quoted
from ..plans.quantiles import group_quantiles
from ..plans.train import ModelSpec
from ..schemas import CLASSIFICATION
from ..sources import registry


#: Below this many rows the binned table is dealt over all cores: its file splits may be fewer. The result is the same.
SPREAD_ROWS = 5_000_000


def resolve_model(spark: SparkSession, model_name: str = "", model: Any = None, prefer: str = "name",
                  root: str | None = None) -> Model:
    """A model from the registry name or from a value (bytes / Model). ``prefer`` decides when both."""
    has_value = model is not None and (not isinstance(model, (bytes, bytearray)) or len(model) > 0)
    if not model_name and not has_value:
        raise ValueError("either 'model_name' or 'model' must be given")
    use_name = bool(model_name) and (prefer == "name" or not has_value)
    if use_name:
        return registry.load(spark, model_name, root)
    if isinstance(model, Model):
        return model
    return Model.from_bytes(model)


def objective_for(task: str, n_classes: int | None, params: dict) -> tuple[str, int]:
    """(objective, number of output groups)."""
    obj = params.get("objective")
    if task != CLASSIFICATION:
        return obj or "reg:squarederror", 1
    k = n_classes or 1
    if obj is None:
        return ("binary:logistic", 1) if k <= 2 else ("multi:softprob", k)
    if obj.startswith("binary:"):
        if k > 2:
            raise ValueError(f"objective {obj!r} needs at most 2 classes, the target has {k}")
        return obj, 1
    return obj, max(k, 2)


def base_margin(objective: str, n_groups: int, params: dict, y_sum: float, n: int) -> np.ndarray:
    """Starting margin: mean target (its logarithm or log-odds under such a link), 0 per class or for hinge."""
    bs = params.get("base_score")
    if objective.startswith("multi:") or objective == "binary:hinge":
        return np.full(n_groups, bs if bs is not None else 0.0)
    mean = bs if bs is not None else (y_sum / n if n else 0.0)
    if objective.startswith("binary:") or objective == "reg:logistic":
        return np.array([math.log(mean / (1.0 - mean)) if 0.0 < mean < 1.0 else 0.0])
    if objective in LOG_LINK:
        return np.array([math.log(mean) if mean > 0 else 0.0])
    return np.array([mean])


#: Ranges of the target that an objective is defined on.
_TARGETS = {"reg:logistic": (0.0, 1.0, True), "count:poisson": (0.0, math.inf, True), "reg:tweedie": (0.0, math.inf, True),
            "reg:gamma": (0.0, math.inf, False), "reg:squaredlogerror": (-1.0, math.inf, False)}


def check_target_range(objective: str | None, low: float, high: float) -> None:
    lo, hi, closed = _TARGETS.get(objective or "", (-math.inf, math.inf, True))
    if low < lo or high > hi or (low == lo and not closed and lo > -math.inf):
        raise ValueError(f"objective {objective!r} is not defined for targets from {low} to {high}")


def value_column(margin: Column, objective: str) -> Column:
    """A regression margin in the units of the target."""
    if objective in LOG_LINK:
        return F.exp(margin)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)) if objective == "reg:logistic" else margin


@dataclass
class Prepared:
    stats: DataStats
    state: DataFrame           # persisted: __rid, __y, [__id], __b*, [__fold], __m*
    has_fold: bool
    release: list              # persisted frames to unpersist at the end
    whole: DataStats | None = None      # statistics of all rows, where ``stats`` are those of folds


def prepare(df: DataFrame, target: str, id_col: str, task: str, params: dict, cv: int | None = None,
            stats: DataStats | None = None, validation: str = "", keep_id: bool = True) -> Prepared:
    """Statistics + binned table (+ fold column); margins are added by ``with_margins``. Rows where the column
    ``validation`` is true are only evaluated: they have no part in statistics and trees. Without ``keep_id`` the id only
    orders the rows that folds are dealt from."""
    if not target:
        raise ValueError("fit requires 'target' (the label column name)")
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found in input; columns: {', '.join(df.columns)}")
    if id_col and id_col not in df.columns:
        raise ValueError(f"id column {id_col!r} not found in input; columns: {', '.join(df.columns)}")
    if validation and validation not in df.columns:
        raise ValueError(f"validation column {validation!r} not found in input; columns: {', '.join(df.columns)}")
    if params.get("early_stopping_rounds") and not validation and cv is None:
        raise ValueError("early_stopping_rounds needs 'validation', the column of the rows to evaluate")
    if validation:
        df = df.withColumn(validation, F.coalesce(quoted(validation).cast("boolean"), F.lit(False)))
        learned = df.where(~quoted(validation))
        features = [c for c in feature_columns(df, target, id_col) if c != validation]
        stats = collect_stats(learned, target, id_col, task, params["max_bin"], params["tree_method"], features)
    if stats is None:
        method = "hist" if params.get("booster") == "gblinear" else params["tree_method"]      # linear models have no bins
        stats = collect_stats(df, target, id_col, task, params["max_bin"], method)
    if task != CLASSIFICATION:
        check_target_range(params.get("objective"), stats.y_min, stats.y_max)
    has_fold, linear = cv is not None, params.get("booster") == "gblinear"
    inputs = table_inputs(df, stats, id_col, validation)
    release = []
    order = (["__id"] if id_col else []) + ["__rid"]
    keep = [c for c in inputs.columns if c != "__id" or keep_id]
    # rows are ranked before they are encoded: the ranking reads them twice
    if has_fold:
        if cv < 2:
            raise ValueError(f"cv must be at least 2, got {cv}")
        if cv > stats.n_rows:
            raise ValueError(f"cv={cv} is greater than the number of rows ({stats.n_rows})")
        if task == CLASSIFICATION and all(c < cv for c in stats.class_counts):
            raise ValueError(f"cv={cv} cannot be greater than the number of members in each class")
        ranked, info, layout = ranks.with_rank(inputs, order, "__t" if task == CLASSIFICATION else None, keep=keep)
        release.append(layout)
        if not id_col:
            # without an id the rows have no order of their own: equal ones lie side by side in the ranking, so they
            # are dealt to the folds in turn, which gives every fold the size it has with an id
            start = F.lit(0)
            if task == CLASSIFICATION:
                start = F.coalesce(*[F.when(F.col("__t") == F.lit(g), F.lit(n)) for g, n in ranks.class_starts(info).items()])
            fold_col = (start + F.col("__rank")) % cv
        elif task == CLASSIFICATION:
            bounds = ranks.stratified_bounds(info, cv)
            cases = None
            for g, b in bounds.items():
                fold = _fold_expr(F.col("__rank"), b)
                cases = (F.when(F.col("__t") == F.lit(g), fold) if cases is None
                         else cases.when(F.col("__t") == F.lit(g), fold))
            fold_col = cases.otherwise(F.lit(0))
        else:
            fold_col = _fold_expr(F.col("__rank"), ranks.plain_bounds(stats.n_rows, cv))
        inputs = ranked.withColumn("__fold", fold_col.cast("int"))
    elif params.get("subsample", 1.0) < 1.0 and not linear:
        inputs, _, layout = ranks.with_rank(inputs, order, keep=keep)
        release.append(layout)
    if release:       # equal rows get numbers of their own, so each is sampled for itself
        inputs = inputs.withColumn("__rid", F.xxhash64("__rid", "__rank")).drop("__rank", "__pid")
    if not keep_id:
        inputs = inputs.drop("__id")
    binned = binned_table(inputs, stats, keep_raw=linear, keep_sketched=not linear and (has_fold or params["tree_method"] == "approx"))
    if has_fold and not linear:
        binned, local = fold_local(binned, stats, cv, params["max_bin"], params["tree_method"] == "approx")
        return Prepared(local, binned, has_fold, release, stats)
    return Prepared(stats, binned, has_fold, release, stats)


def _fold_expr(rank: Column, bounds: np.ndarray) -> Column:
    """Index of the first bound exceeding ``rank``."""
    expr = F.lit(len(bounds) - 1)
    for f in range(len(bounds) - 2, -1, -1):
        expr = F.when(rank < F.lit(int(bounds[f])), F.lit(f)).otherwise(expr)
    return expr


def with_margins(prep: Prepared, specs: list[ModelSpec]) -> DataFrame:
    """Add the starting margins (one column per model × group) and persist the training state."""
    cols = []
    j = 0
    for s in specs:
        for k in range(s.n_groups):
            cols.append(F.lit(float(s.base[k])).alias(f"__m{j}"))
            j += 1
    state = prep.state.select("*", *cols)
    # every core should hold a slice of the state, also of an input with few file splits
    if prep.stats.n_rows < SPREAD_ROWS and not prep.release:
        state = state.repartition(state.sparkSession.sparkContext.defaultParallelism)
    return state.persist(StorageLevel.MEMORY_AND_DISK)


def target_sums(prep: Prepared) -> dict:
    """Per fold (or -1 for all rows): (rows, Σy)."""
    if not prep.has_fold:
        return {-1: (prep.stats.n_rows, prep.stats.y_sum)}
    rows = prep.state.groupBy("__fold").agg(F.count(F.lit(1)).alias("n"), target_sum(F.col("__y")).alias("s")).collect()
    return {int(r["__fold"]): (int(r["n"]), sum_value(r["s"])) for r in rows}


def order_centres(prep: Prepared, prob: float, folds: list[int]) -> dict[int, float]:
    """The ``prob`` quantile of the target of all rows (fold -1) or of those outside each fold."""
    outside = F.array(*[F.lit(f) if f < 0 else F.when(F.col("__fold") != f, F.lit(f)) for f in folds])
    rows = prep.state.where("NOT __val") if "__val" in prep.state.columns else prep.state
    got = group_quantiles(rows.select(F.explode(outside).alias("g"), F.col("__y").alias("v")).where("g IS NOT NULL"), [prob])
    return {f: got[f][0] if f in got else 0.0 for f in folds}


# ------------------------------------------------------------------ prediction expressions

def proba_columns(margins: list[Column], objective: str) -> list[Column]:
    """Class probabilities from margin columns (JVM-side expressions)."""
    if objective == "binary:hinge":
        p1 = (margins[0] > 0).cast("double")
        return [F.lit(1.0) - p1, p1]
    if objective.startswith("binary:"):
        p1 = F.lit(1.0) / (F.lit(1.0) + F.exp(-margins[0]))
        return [F.lit(1.0) - p1, p1]
    if objective.startswith("multi:"):
        mx = F.greatest(*margins) if len(margins) > 1 else margins[0]
        ex = [F.exp(m - mx) for m in margins]
        tot = ex[0]
        for e in ex[1:]:
            tot = tot + e
        return [e / tot for e in ex]
    return []


def code_column(margins: list[Column], objective: str) -> Column:
    """Predicted class code: margin > 0 (binary) or the first arg-max (multiclass)."""
    if objective.startswith("binary:"):
        return F.when(margins[0] > 0, F.lit(1)).otherwise(F.lit(0))
    mx = F.greatest(*margins) if len(margins) > 1 else margins[0]
    return F.coalesce(*[F.when(m == mx, F.lit(k)) for k, m in enumerate(margins)])


def decode_column(code: Column, classes: list, label_type: T.DataType) -> Column:
    arr = F.array(*[F.lit(c) for c in classes])
    return F.element_at(arr, code + F.lit(1)).cast(label_type)


def proba_names(classes: list) -> list[str]:
    return [f"proba_{c}" for c in classes]
