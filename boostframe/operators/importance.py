"""``feature_importance`` (from the node table) and ``permutation_importance`` (distributed shuffles)."""

from __future__ import annotations

from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import metrics as MX
from ..plans import ranks
from ..plans.features import positional, quoted, require_features
from ..schemas import CLASSIFICATION, IMPORTANCE_SCHEMA, NODE_SCHEMA, PERM_SCHEMA
from .common import resolve_model
from .predict import Scorer, _broadcast

IMPORTANCE_TYPES = ("weight", "gain", "cover", "total_gain", "total_cover")


def node_table(spark: SparkSession, model_name: str = "", model: Any = None,
               root: str | None = None) -> DataFrame:
    m = resolve_model(spark, model_name, model, prefer="value", root=root)
    return spark.createDataFrame(m.node_rows(), NODE_SCHEMA)


def importance_from_nodes(nodes: DataFrame, features: list[str], importance_type: str) -> DataFrame:
    """Per feature over all split nodes: count, mean/total gain, mean/total cover; unused features 0;
    ranked by importance (ties keep feature order)."""
    if importance_type not in IMPORTANCE_TYPES:
        raise ValueError(f"invalid importance_type {importance_type!r}; choose one of: "
                         f"{', '.join(sorted(IMPORTANCE_TYPES))}")
    value = {"weight": F.count(F.lit(1)).cast("double"), "gain": F.avg("gain"), "cover": F.avg("cover"),
             "total_gain": F.sum("gain"), "total_cover": F.sum("cover")}[importance_type]
    spark = nodes.sparkSession
    feats = spark.createDataFrame([(f, i) for i, f in enumerate(features)], "feature string, pos int")
    per = nodes.where(F.col("feature").isNotNull()).groupBy("feature").agg(value.alias("importance"))
    joined = F.broadcast(feats).join(per, "feature", "left")   # the feature list is model-sized
    imp = F.coalesce(F.col("importance"), F.lit(0.0))
    w = Window.orderBy(imp.desc(), F.col("pos"))
    out = joined.select("feature", imp.alias("importance"), F.row_number().over(w).cast("int").alias("rank"))
    return out.orderBy("rank")


def feature_importance(spark: SparkSession, model_name: str = "", model: Any = None,
                       importance_type: str = "gain", root: str | None = None) -> DataFrame:
    m = resolve_model(spark, model_name, model, prefer="value", root=root)
    if m.meta.booster == "gblinear":
        raise ValueError("feature_importance needs a tree booster; this model is gblinear")
    nodes = spark.createDataFrame(m.node_rows(), NODE_SCHEMA)
    out = importance_from_nodes(nodes, m.meta.feature_names, importance_type)
    return out.select(*[F.col(f.name).cast(f.dataType) for f in IMPORTANCE_SCHEMA.fields])


def permutation_importance(df: DataFrame, model_name: str = "", model: Any = None, target: str = "",
                           n_repeats: int = 5, scoring: str = "", random_state: int = 0,
                           id: str = "", root: str | None = None) -> DataFrame:
    """Baseline score − score with one feature's values permuted across rows, per (feature, repeat).

    Rows get a global rank r (range-partitioned, no single-task window). In repeat k the permutation is
    r → (a·r + b) mod n with a coprime to n, drawn from ``random_state`` and shared by the features: one
    shuffle join on (repeat, rank) brings every row its donor's feature values, and the features take
    turns inside the Arrow pass that scores them. Labels unknown to the model count as wrong (code -1)."""
    spark = df.sparkSession
    m = resolve_model(spark, model_name, model, prefer="value", root=root)
    if not target:
        raise ValueError("permutation_importance requires 'target' (the label column name)")
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found in input; columns: {', '.join(df.columns)}")
    if n_repeats < 1:
        raise ValueError("n_repeats must be >= 1")
    feats = m.meta.feature_names
    require_features(df, feats)
    task = m.meta.task
    scoring = MX.check_scoring(scoring, task)
    MX.check_classes(scoring, m.meta.classes) if task == CLASSIFICATION else None
    base = df.select(*positional(feats), quoted(target).alias("__t"),
                     F.xxhash64(*[quoted(c) for c in df.columns]).alias("__rid"),
                     *([quoted(id).alias("__id")] if id else []))
    order = (["__id"] if id else []) + ["__rid"]
    ranked, info, layout = ranks.with_rank(base, order)
    n = info.totals[0] if info.totals else 0
    if n == 0:
        layout.unpersist()
        raise ValueError("permutation_importance received no rows")
    rng = np.random.RandomState(random_state & 0x7FFFFFFF)
    moves = []
    for _ in range(n_repeats):
        a = _prime_from(int(rng.randint(1 << 16, 1 << 20)))       # 20 bits: rank * a stays a BIGINT up to 2^43 rows
        while n % a == 0:
            a = _prime_from(a + 1)
        moves.append((a, int(rng.randint(0, 1 << 20))))
    every = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), ((F.col("__rank") * F.lit(a) + F.lit(b)) % F.lit(n)).alias("dst"))
                                for k, (a, b) in enumerate(moves)]))
    donor = (ranked.select(every.alias("to"), *[F.col(f"f{j}").alias(f"__d{j}") for j in range(len(feats))])
             .select("to.*", *[f"__d{j}" for j in range(len(feats))]))
    recv = ranked.select(*[f"f{j}" for j in range(len(feats))], "__t", "__rank", F.explode(F.array(*[F.lit(k) for k in range(n_repeats)])).alias("k"))
    joined = (recv.join(donor.withColumnRenamed("k", "__k"), (F.col("k") == F.col("__k")) & (F.col("__rank") == F.col("dst")))
              .drop("__k", "dst", "__rank"))
    pairs = [(j, k) for j in range(len(feats)) for k in range(n_repeats)]
    scorer = _broadcast(spark, Scorer(m))
    classes = m.meta.classes
    is_cls = task == CLASSIFICATION
    n_out = len(classes) if is_cls and classes else 1
    score_schema = T.StructType([T.StructField("pair", T.IntegerType()), T.StructField("y", T.DoubleType()),
                                 T.StructField("pred", T.DoubleType())] +
                                [T.StructField(f"p{j}", T.DoubleType()) for j in range(n_out if is_cls else 0)])

    out_schema = _arrow(score_schema)

    def scored_rows(sc: Scorer, X: np.ndarray, target_column, pair: np.ndarray) -> pa.RecordBatch:
        M = sc.margins(X)
        if is_cls:
            y = pc.index_in(target_column, value_set=pa.array(classes, type=target_column.type))
            y = y.to_numpy(zero_copy_only=False).astype(np.float64)
            values = [np.where(np.isnan(y), -1.0, y), sc.codes(M).astype(np.float64), *sc.proba(M).T]
        else:
            values = [target_column.cast(pa.float64()).to_numpy(zero_copy_only=False), sc.values(M)]
        return pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int32)), *(pa.array(v) for v in values)], schema=out_schema)

    def kernel(batches):
        sc: Scorer = scorer.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            X = sc.matrix(batch)
            lent = batch.select([f"__d{j}" for j in range(len(feats))])
            D = sc.matrix(pa.RecordBatch.from_arrays(lent.columns, names=[f"f{j}" for j in range(len(feats))]))
            k = batch.column("k").to_numpy(zero_copy_only=False)
            for j in range(len(feats)):
                own = X[:, j].copy()
                X[:, j] = D[:, j]
                yield scored_rows(sc, X, batch.column("__t"), j * n_repeats + k)
                X[:, j] = own

    def base_kernel(batches):
        sc: Scorer = scorer.value
        for batch in batches:
            if batch.num_rows:
                yield scored_rows(sc, sc.matrix(batch), batch.column("__t"), np.full(batch.num_rows, -1))

    def sums_kernel(batches):
        """Where a score is a mean over rows, a task sends its sums, not the scored rows."""
        sc: Scorer = scorer.value
        total, count = np.zeros((len(feats), n_repeats)), np.zeros(n_repeats, np.int64)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            X = sc.matrix(batch)
            lent = batch.select([f"__d{j}" for j in range(len(feats))])
            D = sc.matrix(pa.RecordBatch.from_arrays(lent.columns, names=[f"f{j}" for j in range(len(feats))]))
            k = batch.column("k").to_numpy(zero_copy_only=False)
            count += np.bincount(k, minlength=n_repeats)
            for j in range(len(feats)):
                own = X[:, j].copy()
                X[:, j] = D[:, j]
                rows = scored_rows(sc, X, batch.column("__t"), k)
                y, pred = rows.column(1).to_numpy(), rows.column(2).to_numpy()
                total[j] += np.bincount(k, weights=MX.ADDITIVE[scoring](y, pred), minlength=n_repeats)
                X[:, j] = own
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel()),
                                          pa.array(np.tile(count, len(feats)))], names=["pair", "s", "n"])

    base_scored = ranked.mapInArrow(base_kernel, score_schema)
    base_score = float(MX.score(base_scored, scoring, ["pair"], n_out).collect()[0]["score"])
    if scoring in MX.ADDITIVE:
        spread = float(base_scored.agg(F.var_pop("y") * F.count(F.lit(1))).first()[0])
        sums = joined.mapInArrow(sums_kernel, "pair int, s double, n long").groupBy("pair").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        per_pair = {int(r["pair"]): MX.from_sums(scoring, float(r["s"]), int(r["n"]), spread) for r in sums.collect()}
    else:
        permuted = MX.score(joined.mapInArrow(kernel, score_schema), scoring, ["pair"], n_out)
        per_pair = {int(r["pair"]): float(r["score"]) for r in permuted.collect()}
    layout.unpersist()
    rows = []
    for j, name in enumerate(feats):
        drops = np.array([base_score - per_pair.get(pid, np.nan) for pid, p in enumerate(pairs) if p[0] == j])
        rows.append((name, float(np.mean(drops)), float(np.std(drops))))
    order_idx = sorted(range(len(rows)), key=lambda i: -round(rows[i][1], 12))  # stable: ties, up to rounding, keep feature order
    out = [(rows[i][0], rows[i][1], rows[i][2], r + 1) for r, i in enumerate(order_idx)]
    return spark.createDataFrame(out, PERM_SCHEMA)


def _prime_from(n: int) -> int:
    """The smallest prime at or above ``n``."""
    while any(n % d == 0 for d in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)
