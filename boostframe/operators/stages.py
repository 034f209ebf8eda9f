"""Intermediate stages of training as DataFrames: category dictionaries, bin cuts, class codes, the
first histogram pass and fold assignment. Useful to inspect a fit and to check it against SQL."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..plans import splits
from ..plans import train as TR
from ..plans.binning import collect_stats, dictionary_table
from ..plans.features import categorical_mask, quoted
from ..plans.ranks import with_rank
from .common import materialise, prepare, with_margins
from .fit import make_specs


def category_dictionary(df: DataFrame, features: list[str]) -> DataFrame:
    """``(feature, code, category)``: sorted distinct non-NULL strings per categorical column, numbered by the distributed
    ranking, so no column's values meet in one task."""
    cat = categorical_mask(df, features)
    parts = [F.struct(F.lit(f).alias("feature"), quoted(f).cast("string").alias("category"))
             for f, c in zip(features, cat) if c]
    if not parts:
        return df.sparkSession.createDataFrame([], "feature string, code int, category string")
    d = (df.select(F.explode(F.array(*parts)).alias("p")).select("p.*")
         .where(F.col("category").isNotNull()).distinct())
    ranked, _, _ = with_rank(d, ["feature", "category"], "feature")
    return ranked.select("feature", F.col("__rank").cast("int").alias("code"), "category")


def bin_cuts(df: DataFrame, features: list[str], max_bin: int = 256, target: str | None = None) -> DataFrame:
    """``(feature, bin, threshold)``: x < threshold ⇔ bin ≤ ``bin`` for every numeric feature."""
    tgt = target or features[0]
    stats = collect_stats(df.select(*map(quoted, dict.fromkeys(features + [tgt]))), tgt, "", "regression", max_bin,
                          features=features)
    rows = []
    for info in stats.features:
        if not info.categorical:
            rows += [(info.name, b, float(v)) for b, v in enumerate(info.cuts)]
    return df.sparkSession.createDataFrame(rows, "feature string, bin int, threshold double")


def exact_cuts(df: DataFrame, feature: str) -> DataFrame:
    """``(bin, threshold)`` under ``tree_method="exact"``: every distinct value but the least is a cut, numbered by the
    distributed ranking."""
    values = dictionary_table(df, feature, categorical=False)
    return values.where("code > 0").select((F.col("code") - 1).alias("bin"), F.col("value").alias("threshold"))


def feature_codes(df: DataFrame, feature: str, id: str) -> DataFrame:
    """``(id, code)``: the code of every row's value in the feature's sorted dictionary, joined from the table; -1 = missing."""
    categorical = categorical_mask(df, [feature])[0]
    table = dictionary_table(df, feature, categorical)
    rows = df.select(quoted(id).alias("id"), quoted(feature).cast("string" if categorical else "double").alias("value"))
    return rows.join(table, "value", "left").select("id", F.coalesce("code", F.lit(-1)).alias("code"))


def class_codes(df: DataFrame, target: str) -> DataFrame:
    """``(label, code, n)``: sorted labels and their counts (the target encoding)."""
    counts = df.groupBy(quoted(target).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    ranked, _, _ = with_rank(counts, ["label"])
    return ranked.select(F.col("label").cast("string").alias("label"), F.col("__rank").cast("int").alias("code"), "n")


def root_histogram(df: DataFrame, target: str, estimator: str = "xgb_regressor", params: str | dict = "",
                   id: str = "") -> DataFrame:
    """First histogram pass of a fit: ``(feature, bin, sum_g, sum_h, n)`` with fixed-point (2^20)
    gradient sums; ``bin`` = number of bins is the missing bin."""
    task, p = P.resolve(estimator, params)
    prep = prepare(df, target, id, task, p)
    specs = make_specs(prep, estimator, [p], None)
    state = with_margins(prep, specs)
    try:
        n_feat, n_margin = len(prep.stats.features), specs[0].n_groups
        growers = [TR.Grower(0, k, 0, np.ones(n_feat, dtype=bool)) for k in range(n_margin)]
        for gr in growers:
            gr.add(0.0, 0.0, 0, 0)
        tree_ctx = [(k, -1, 1.0, (0, 0, 0, 0)) for k in range(n_margin)]
        models_ctx = [(specs[0].objective, n_margin, 0, TR.gradient_options(p), specs[0].g_scale, specs[0].h_scale)]
        partials = TR.level_partials(TR.pack_state(state), prep.stats, growers, [(k, 0) for k in range(n_margin)], tree_ctx, models_ctx,
                                     specs[0].base, False)
        cells = partials.mapInArrow(splits.unpack_partials, "slot int, feature int, bin int, g long, h long, n long")
        names = F.array(*[F.lit(info.name) for info in prep.stats.features])
        exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).cast("long")
        return materialise(cells.where("slot = 0").groupBy(names[F.col("feature")].alias("feature"), "bin")
                           .agg(exact("g").alias("sum_g"), exact("h").alias("sum_h"), F.sum("n").alias("n")))
    finally:
        state.unpersist()


def assign_folds(df: DataFrame, target: str, id: str, cv: int = 5, estimator: str = "xgb_classifier"
                 ) -> DataFrame:
    """``(id, fold)``: stratified folds for classifiers, contiguous blocks for regressors, in id order."""
    task, p = P.resolve(estimator, "")
    prep = prepare(df, target, id, task, p, cv=cv)
    out = prep.state.select(F.col("__id").alias(id), F.col("__fold").cast("int").alias("fold"))
    return out


__all__ = ["category_dictionary", "bin_cuts", "exact_cuts", "feature_codes", "class_codes", "root_histogram", "assign_folds"]
