"""Scorers as grouped DataFrame aggregations (JVM-side).

Input columns: ``group`` columns, ``y`` (class code or target, DOUBLE), ``pred`` (class code or value,
DOUBLE) and, for probability scorers, ``p0..p{K-1}``. Output: ``group`` columns + ``score``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CLASSIFICATION

# Scorer names.
CLASSIFICATION_SCORERS = ["accuracy", "balanced_accuracy", "precision", "recall", "f1", "precision_macro",
                          "precision_micro", "precision_weighted", "recall_macro", "recall_micro",
                          "recall_weighted", "f1_macro", "f1_micro", "f1_weighted", "roc_auc", "roc_auc_ovr",
                          "average_precision", "neg_brier_score", "matthews_corrcoef", "neg_log_loss"]
REGRESSION_SCORERS = ["r2", "explained_variance", "neg_mean_squared_error", "neg_root_mean_squared_error",
                      "neg_mean_absolute_error", "neg_median_absolute_error", "neg_mean_absolute_percentage_error",
                      "max_error"]
PROBA_SCORERS = {"roc_auc", "roc_auc_ovr", "average_precision", "neg_brier_score", "neg_log_loss"}
BINARY_SCORERS = {"precision", "recall", "f1", "roc_auc", "average_precision", "neg_brier_score"}
_EPS = float(np.finfo(np.float64).eps)


def check_scoring(scoring: str, task: str) -> str:
    """'' → the task's default scorer; a name of the other task or of none → error listing the valid ones."""
    if not scoring:
        return "accuracy" if task == CLASSIFICATION else "r2"
    valid = CLASSIFICATION_SCORERS if task == CLASSIFICATION else REGRESSION_SCORERS
    if scoring in valid:
        return scoring
    if scoring in CLASSIFICATION_SCORERS + REGRESSION_SCORERS:
        raise ValueError(f"scoring {scoring!r} does not fit a {task} target; valid scorers: {', '.join(valid)}")
    raise ValueError(f"unknown scoring {scoring!r}; valid scorers: {', '.join(valid)}")


def check_classes(scoring: str, classes: list | None) -> None:
    if scoring in BINARY_SCORERS and len(classes or ()) != 2:
        raise ValueError(f"scoring {scoring!r} is defined for two classes, the target has {len(classes or ())}; "
                         f"take an averaged scorer such as 'f1_macro' or 'roc_auc_ovr'")


def needs_proba(scoring: str) -> bool:
    return scoring in PROBA_SCORERS


def score(df: DataFrame, scoring: str, group: list[str], n_classes: int = 2) -> DataFrame:
    y, pred = F.col("y"), F.col("pred")
    g = [F.col(c) for c in group]
    if scoring == "accuracy":
        return df.groupBy(*g).agg(F.avg((y == pred).cast("double")).alias("score"))
    if scoring == "balanced_accuracy":
        per = df.groupBy(*g, y.alias("c")).agg(F.avg((y == pred).cast("double")).alias("r"))
        return per.groupBy(*g).agg(F.avg("r").alias("score"))
    if scoring in ("precision", "recall", "f1"):
        return _binary_prf(df, scoring, g)
    if scoring.split("_")[0] in ("precision", "recall", "f1"):
        metric, avg = scoring.split("_")
        return _multi_prf(df, metric, avg, group)
    if scoring == "matthews_corrcoef":
        return _matthews(df, group)
    if scoring == "roc_auc":
        return roc_auc(df, group)
    if scoring == "average_precision":
        return average_precision(df, group)
    if scoring == "neg_brier_score":
        return df.groupBy(*g).agg((-F.avg((F.col("p1") - (y == 1).cast("double")) ** 2)).alias("score"))
    if scoring == "roc_auc_ovr":
        each = F.explode(F.array(*[F.struct(F.lit(j).alias("__class"), (y == j).cast("double").alias("y"),
                                            F.col(f"p{j}").alias("p1")) for j in range(max(n_classes, 2))]))
        per = roc_auc(df.select(*g, each.alias("e")).select(*g, "e.*"), [*group, "__class"])
        return per.groupBy(*g).agg(F.avg("score").alias("score"))
    if scoring == "neg_log_loss":
        k = max(n_classes, 2)
        ps = [F.col(f"p{j}") for j in range(k)]
        tot = ps[0]
        for p in ps[1:]:
            tot = tot + p
        py = F.coalesce(*[F.when(y == F.lit(float(j)), ps[j]) for j in range(k)], F.lit(0.0))
        clipped = F.least(F.greatest(py / tot, F.lit(_EPS)), F.lit(1.0 - _EPS))
        return df.groupBy(*g).agg((-F.avg(-F.log(clipped))).alias("score"))
    e = y - pred
    if scoring == "r2":
        a = df.groupBy(*g).agg(F.sum(e * e).alias("sse"), (F.var_pop(y) * F.count(F.lit(1))).alias("sst"))
        return a.select(*g, F.when(F.col("sst") <= 0, F.when(F.col("sse") == 0, 1.0).otherwise(0.0))
                        .otherwise(F.lit(1.0) - F.col("sse") / F.col("sst")).alias("score"))
    if scoring == "explained_variance":
        a = df.groupBy(*g).agg(F.var_pop(e).alias("ve"), F.var_pop(y).alias("vy"))
        return a.select(*g, F.when(F.col("vy") <= 0, F.when(F.col("ve") == 0, 1.0).otherwise(0.0))
                        .otherwise(F.lit(1.0) - F.col("ve") / F.col("vy")).alias("score"))
    if scoring == "neg_mean_squared_error":
        return df.groupBy(*g).agg((-F.avg(e * e)).alias("score"))
    if scoring == "neg_root_mean_squared_error":
        return df.groupBy(*g).agg((-F.sqrt(F.avg(e * e))).alias("score"))
    if scoring == "neg_mean_absolute_error":
        return df.groupBy(*g).agg((-F.avg(F.abs(e))).alias("score"))
    if scoring == "neg_median_absolute_error":
        return _negative_medians(df.select(*g, F.abs(e).alias("v")), group)
    if scoring == "neg_mean_absolute_percentage_error":
        return df.groupBy(*g).agg((-F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(_EPS)))).alias("score"))
    if scoring == "max_error":
        return df.groupBy(*g).agg((-F.max(F.abs(e))).alias("score"))
    raise ValueError(f"unknown scoring {scoring!r}")


#: Scorers that are means over rows: what a row adds.
ADDITIVE = {
    "accuracy": lambda y, p: (y == p).astype(float),
    "r2": lambda y, p: (y - p) ** 2,
    "neg_mean_squared_error": lambda y, p: (y - p) ** 2,
    "neg_root_mean_squared_error": lambda y, p: (y - p) ** 2,
    "neg_mean_absolute_error": lambda y, p: np.abs(y - p),
}


def from_sums(scoring: str, total: float, n: int, spread: float) -> float:
    """The score from the sum of `ADDITIVE` over ``n`` rows; ``spread``: the targets' squared distances from their mean."""
    if scoring == "accuracy":
        return total / n
    if scoring == "r2":
        return 1.0 - total / spread if spread > 0 else float(total == 0)
    return -float(np.sqrt(total / n)) if scoring == "neg_root_mean_squared_error" else -total / n


def _negative_medians(df: DataFrame, group: list[str]) -> DataFrame:
    """Minus the exact median of ``v`` per group (groups are few: folds and combinations)."""
    from ..plans.quantiles import group_quantiles
    spark, kinds = df.sparkSession, [df.schema[c] for c in group]
    names = [tuple(r) for r in df.select(*group).distinct().collect()]
    named = spark.createDataFrame([(*n, i) for i, n in enumerate(names)], T.StructType([*kinds, T.StructField("__g", T.LongType())]))
    same = [df[c].eqNullSafe(named[c]) for c in group]
    rows = df.join(F.broadcast(named), same).select(named["__g"].alias("g"), "v")
    medians = group_quantiles(rows, [0.5])
    return spark.createDataFrame([(*n, -medians[i][0] if i in medians else None) for i, n in enumerate(names)],
                                 T.StructType([*kinds, T.StructField("score", T.DoubleType())]))


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _binary_prf(df: DataFrame, metric: str, g: list[Column]) -> DataFrame:
    y, pred = F.col("y"), F.col("pred")
    a = df.groupBy(*g).agg(F.sum(((y == 1) & (pred == 1)).cast("long")).alias("tp"),
                           F.sum(((y != 1) & (pred == 1)).cast("long")).alias("fp"),
                           F.sum(((y == 1) & (pred != 1)).cast("long")).alias("fn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    expr = {"precision": _safe_div(tp, tp + fp), "recall": _safe_div(tp, tp + fn),
            "f1": _safe_div(2 * tp, 2 * tp + fp + fn)}[metric]
    return a.select(*g, expr.cast("double").alias("score"))


def _multi_prf(df: DataFrame, metric: str, avg: str, group: list[str]) -> DataFrame:
    g = [F.col(c) for c in group]
    y, pred = F.col("y"), F.col("pred")
    # per class: tp, fp, fn (classes = labels seen in y or pred), all from one count of the pairs
    pairs = df.groupBy(*g, y.alias("y"), pred.alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(y == pred, F.col("n")).otherwise(0)
    ends = F.explode(F.array(F.struct(y.alias("c"), F.col("n").alias("support"), F.lit(0).cast("long").alias("npred"), hit.cast("long").alias("tp")),
                             F.struct(pred.alias("c"), F.lit(0).cast("long").alias("support"), F.col("n").alias("npred"), F.lit(0).cast("long").alias("tp"))))
    per = (pairs.select(*g, ends.alias("e")).groupBy(*g, F.col("e.c").alias("c"))
           .agg(F.sum("e.support").alias("support"), F.sum("e.npred").alias("npred"), F.sum("e.tp").alias("tp")))
    tp, sup, npred = F.col("tp"), F.col("support"), F.col("npred")
    fp, fn = npred - tp, sup - tp
    if avg == "micro":
        a = per.groupBy(*g).agg(F.sum(tp).alias("tp"), F.sum(fp).alias("fp"), F.sum(fn).alias("fn"))
        t, p_, n_ = F.col("tp"), F.col("fp"), F.col("fn")
        expr = {"precision": _safe_div(t, t + p_), "recall": _safe_div(t, t + n_),
                "f1": _safe_div(2 * t, 2 * t + p_ + n_)}[metric]
        return a.select(*g, expr.cast("double").alias("score"))
    val = {"precision": _safe_div(tp, npred), "recall": _safe_div(tp, sup),
           "f1": _safe_div(2 * tp, 2 * tp + fp + fn)}[metric]
    per = per.select(*g, val.alias("v"), sup.alias("s"))
    if avg == "macro":
        return per.groupBy(*g).agg(F.avg("v").alias("score"))
    return per.groupBy(*g).agg(_safe_div(F.sum(F.col("v") * F.col("s")), F.sum("s")).alias("score"))


def _matthews(df: DataFrame, group: list[str]) -> DataFrame:
    """Correlation of true and predicted classes, from the counts of the pairs."""
    g = [F.col(c) for c in group]
    pairs = df.groupBy(*g, "y", "pred").agg(F.count(F.lit(1)).cast("double").alias("n"))
    ends = F.explode(F.array(F.struct(F.col("y").alias("c"), F.col("n").alias("t"), F.lit(0.0).alias("p")),
                             F.struct(F.col("pred").alias("c"), F.lit(0.0).alias("t"), F.col("n").alias("p"))))
    per = (pairs.select(*g, F.when(F.col("y") == F.col("pred"), F.col("n") / 2).otherwise(0.0).alias("hit"), ends.alias("e"))
           .groupBy(*g, F.col("e.c").alias("c")).agg(F.sum("e.t").alias("t"), F.sum("e.p").alias("p"), F.sum("hit").alias("hit")))
    a = per.groupBy(*g).agg(F.sum("hit").alias("c"), F.sum("t").alias("s"), F.sum(F.col("t") * F.col("p")).alias("tp"),
                            F.sum(F.col("t") ** 2).alias("tt"), F.sum(F.col("p") ** 2).alias("pp"))
    below = F.sqrt((F.col("s") ** 2 - F.col("pp")) * (F.col("s") ** 2 - F.col("tt")))
    return a.select(*g, F.when(below > 0, (F.col("c") * F.col("s") - F.col("tp")) / below).otherwise(F.lit(0.0)).alias("score"))


def _by_score(df: DataFrame, group: list[str], highest_first: bool) -> DataFrame:
    """Positives and negatives per distinct score; ``rank`` orders them."""
    at = -F.col("p1") if highest_first else F.col("p1")
    return df.groupBy(*[F.col(c) for c in group], at.alias("rank")).agg(
        F.sum((F.col("y") == 1).cast("long")).alias("pos"), F.sum((F.col("y") != 1).cast("long")).alias("neg"))


def _finished(scores: DataFrame, layout: DataFrame) -> DataFrame:
    """The scores, a row per group, computed now, so the layout they come from can go."""
    rows, schema = scores.collect(), scores.schema
    layout.unpersist()
    return scores.sparkSession.createDataFrame(rows, schema)


def roc_auc(df: DataFrame, group: list[str]) -> DataFrame:
    """Binary ROC AUC by rank sums with averaged ties: Σ over positives of (#neg below + ½ #neg equal),
    over #pos·#neg. Counts are first aggregated per distinct score; the running count of negatives is
    a distributed cumulative sum (range-partitioned), so no group is held in one task."""
    g = [F.col(c) for c in group]
    cum, layout = cumulative_sums(_by_score(df, group, False), group, "rank", ["neg"])
    a = cum.groupBy(*g).agg(
        F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") * 0.5)).alias("u"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return _finished(a.select(*g, F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("u") / (F.col("P") * F.col("N")))
                              .otherwise(F.lit(float("nan"))).alias("score")), layout)


def average_precision(df: DataFrame, group: list[str]) -> DataFrame:
    """Σ over distinct scores, highest first, of the recall gained times the precision reached."""
    g = [F.col(c) for c in group]
    cum, layout = cumulative_sums(_by_score(df, group, True), group, "rank", ["pos", "neg"])
    upto = F.col("pos_before") + F.col("pos")
    a = cum.groupBy(*g).agg(F.sum(F.col("pos") * upto / (upto + F.col("neg_before") + F.col("neg"))).alias("u"),
                            F.sum("pos").alias("P"))
    return _finished(a.select(*g, F.when(F.col("P") > 0, F.col("u") / F.col("P")).otherwise(F.lit(0.0)).alias("score")), layout)


def cumulative_sums(df: DataFrame, group: list[str], order: str, values: list[str]):
    """``<value>_before`` = Σ ``value`` over earlier rows (by ``order``) of the same group, exclusive, for each of
    ``values``; and the persisted layout. The driver sees a row per (partition, group)."""
    key = group + [order]
    gk = F.to_json(F.struct(*[F.col(c) for c in group])) if group else F.lit("")
    layout = (df.withColumn("__gk", gk).repartitionByRange(*[F.col(c) for c in key]).sortWithinPartitions(*key)
              .withColumn("__pid", F.spark_partition_id()).persist(StorageLevel.MEMORY_AND_DISK))
    tot = layout.groupBy("__pid", "__gk").agg(*[F.sum(v).alias(v) for v in values]).collect()
    keys = {k: i for i, k in enumerate(sorted({r["__gk"] for r in tot}))}
    sums = np.zeros((max([r["__pid"] for r in tot] + [0]) + 1, max(len(keys), 1), len(values)))
    for r in tot:
        sums[r["__pid"], keys[r["__gk"]]] = [r[v] for v in values]
    before = np.cumsum(sums, axis=0) - sums
    schema = T.StructType([*layout.schema.fields, *(T.StructField(f"{v}_before", T.DoubleType(), False) for v in values)])

    def kernel(batches):
        running = None
        for b in batches:
            if b.num_rows == 0:
                continue
            if running is None:
                running = before[int(b.column("__pid")[0].as_py())].copy()
            coded = b.column("__gk").dictionary_encode()
            place = np.array([keys[k] for k in coded.dictionary.to_pylist()])
            at = coded.indices.to_numpy()
            add = np.stack([b.column(v).to_numpy(zero_copy_only=False).astype(np.float64) for v in values], 1)
            out = np.empty_like(add)
            for k, p in enumerate(place):
                mine = np.flatnonzero(at == k)
                upto = np.cumsum(add[mine], axis=0)
                out[mine] = running[p] + upto - add[mine]
                running[p] += upto[-1]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(out[:, j]) for j in range(len(values)))],
                                             names=[*b.schema.names, *(f"{v}_before" for v in values)])

    return layout.mapInArrow(kernel, schema).drop("__pid", "__gk"), layout
