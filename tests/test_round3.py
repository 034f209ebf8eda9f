"""Split choice in tasks, exact order statistics, constraints, order-statistic objectives, dictionaries as tables, any names."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from boostframe import fit_model, predict
from boostframe import params as P
from boostframe.operators.dependence import partial_dependence
from boostframe.operators.evaluate import cross_val_score
from boostframe.operators.explain import explain
from boostframe.operators.importance import permutation_importance
from boostframe.plans import binning, quantiles, splits
from tests.conftest import spark  # noqa: F401


# ------------------------------------------------------------------------------------------------ split choice

@pytest.mark.parametrize("dense", [splits.DENSE_CELLS, 10])
def test_partial_sums_are_exact(monkeypatch, dense):
    monkeypatch.setattr(splits, "DENSE_CELLS", dense)
    monkeypatch.setattr(splits, "SPARSE_CELLS", 150)
    rng = np.random.default_rng(0)
    sums, want = splits.PartialSums(600), np.zeros((3, 600), np.int64)
    got = np.zeros((3, 600), np.int64)
    for size in (5, 4000, 40, 300, 1):
        keys, g, h = rng.integers(0, 600, size), rng.integers(-2 ** 35, 2 ** 35, size).astype(float), rng.integers(0, 99, size).astype(float)
        sums.add(keys, g, h)
        for row, values in zip(want, (g, h, np.ones(size))):
            np.add.at(row, keys, values.astype(np.int64))
        if sums.full:
            cells, values = sums.take()
            got[:, cells] += values
    cells, values = sums.take()
    got[:, cells] += values
    assert (got == want).all()


def brute_splits(search, feature, slot, G, H, N):
    """Best (gain, bin, side) of a numeric feature by trying all."""
    p, best = search.params[0], None
    for b in range(int(search.n_bins[feature]) - 1):
        for side in (0, 1):
            take = np.r_[0:b + 1, [-1]] if side == 0 else np.r_[0:b + 1]
            l, t = [x[take].sum() for x in (G, H, N)], [x.sum() for x in (G, H, N)]
            r = [a - c for a, c in zip(t, l)]
            if min(l[1], r[1]) < p["min_child_weight"] or min(l[2], r[2]) <= 0:
                continue
            gain = l[0] ** 2 / (l[1] + 1) + r[0] ** 2 / (r[1] + 1) - t[0] ** 2 / (t[1] + 1)
            if gain > splits.RT_EPS and (best is None or gain > best[0]):
                best = gain, b, side
    return best


def test_splits_do_not_depend_on_batches(monkeypatch):
    monkeypatch.setattr(splits, "BLOCK_CELLS", 30)
    rng = np.random.default_rng(1)
    n_bins, slots = np.array([6, 9, 3]), 7
    offsets = np.concatenate([[0], np.cumsum(n_bins + 1)[:-1]])
    total = int((n_bins + 1).sum())
    p = P.resolve("xgb_regressor", "")[1]
    search = splits.Search(n_bins, np.zeros(3, bool), [p], np.zeros(slots, int), np.full(slots, 2.0 ** 20), np.full(slots, 2.0 ** 20),
                           np.ones((slots, 3), bool), np.full(slots, -np.inf), np.full(slots, np.inf), [None])
    parts, truth = [], np.zeros((3, slots * total), np.int64)
    for _ in range(5):
        one = splits.PartialSums(slots * total)
        keys = rng.integers(0, slots * total, 400)
        one.add(keys, rng.normal(0, 2 ** 21, 400).round(), np.full(400, 2.0 ** 20))
        cells, sums = one.take()
        truth[:, cells] += sums
        parts.append(splits.partial_batch(cells, sums, offsets, total))
    whole = pa.Table.from_batches(parts).sort_by([("feature", "ascending"), ("slot", "ascending")]).combine_chunks()
    results = []
    for size in (1000, 7, 1):
        batches = [b for b in whole.to_batches(max_chunksize=size)]
        out = {r["slot"]: r for b in splits.split_kernel(search)(iter(batches)) for r in b.to_pylist()}
        results.append(out)
    assert results[0] == results[1] == results[2]
    for s, row in results[0].items():
        options = []
        for f in range(3):
            at = s * total + offsets[f]
            G, H, N = (truth[i, at:at + n_bins[f] + 1].astype(float) / (2 ** 20 if i < 2 else 1) for i in range(3))
            found = brute_splits(search, f, s, G, H, N)
            if found:
                options.append((found[0], -f, found[1], found[2]))
        best = max(options, key=lambda o: o[:2])
        assert (row["minus_feature"], row["split_bin"], 0 if row["default_left"] else 1) == best[1:]
        assert row["gain"] == pytest.approx(best[0])


# ------------------------------------------------------------------------------------------------ order statistics

def test_order_statistics_are_exact(spark):  # noqa: F811
    rng = np.random.default_rng(3)
    groups = {5: rng.normal(size=997), -2: np.round(rng.normal(size=500), 1), 9: np.array([3.5]), 11: np.r_[-0.0, 0.0, 0.0, -1e-300, 1e300, -1e300],
              12: np.full(400, -7.25)}
    rows = [(int(g), float(v)) for g, vs in groups.items() for v in vs] + [(5, float("nan")), (9, None), (77, None)]
    frame = spark.createDataFrame(rows, "g long, v double").repartition(5)
    got = quantiles.group_quantiles(frame, [0.0, 0.05, 0.5, 0.9, 1.0])
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert got[g] == pytest.approx(np.quantile(values, [0.0, 0.05, 0.5, 0.9, 1.0]).tolist(), rel=1e-12, abs=1e-12)
    keys = quantiles.to_keys(np.array([-np.inf, -1.5, -1e-320, 0.0, 2.0, np.inf]))
    assert (np.diff(keys.astype(object)) > 0).all() and quantiles.from_keys(keys)[1] == -1.5
    assert quantiles.group_quantiles(frame.limit(0), [0.5]) == {}


def test_leaves_of_absolute_and_quantile_error(spark):  # noqa: F811
    rows = spark.range(3000).select((F.col("id") % 6).cast("double").alias("x"), ((F.col("id") * 7919 % 1000) / 7 + F.col("id") % 6 * 50).alias("y"))
    data = rows.toPandas()
    for objective, prob, extra in (("reg:absoluteerror", 0.5, {}), ("reg:quantileerror", 0.8, {"quantile_alpha": 0.8})):
        m = fit_model(rows, target="y", estimator="xgb_regressor",
                      params={"n_estimators": 1, "max_depth": 3, "learning_rate": 1.0, "objective": objective, **extra})
        got = predict(rows, model=m, id="x").toPandas()
        leaf = got.groupby("x")["prediction"].first()
        groups = data.assign(leaf=data["x"].map(leaf)).groupby("leaf")["y"].quantile(prob)
        assert len(groups) > 1
        assert np.allclose(groups.index.to_numpy(), groups.to_numpy())
    scores = cross_val_score(rows.withColumn("k", F.monotonically_increasing_id()), target="y", id="k", estimator="xgb_regressor", cv=3,
                             params={"n_estimators": 2, "max_depth": 2, "objective": "reg:absoluteerror"}, scoring="neg_median_absolute_error").collect()
    assert len(scores) == 3 and all(r["score"] < 0 for r in scores)
    with pytest.raises(ValueError, match="tree booster"):
        fit_model(rows, target="y", estimator="xgb_regressor", params={"booster": "gblinear", "objective": "reg:absoluteerror"})
    with pytest.raises(ValueError, match="quantile_alpha"):
        P.resolve("xgb_regressor", {"quantile_alpha": 1.0})


# ------------------------------------------------------------------------------------------------ constraints

def wavy(spark):  # noqa: F811
    return spark.range(4000).select((F.col("id") % 20).cast("double").alias("a"), (F.col("id") % 13).cast("double").alias("b"),
                                    (F.col("id") % 7).cast("double").alias("c"),
                                    (F.sin(F.col("id") % 20) * 5 + (F.col("id") % 20) - (F.col("id") % 13) * (F.col("id") % 7) / 4
                                     + F.cos(F.col("id") % 13) * 3).alias("y"))


@pytest.mark.parametrize("given", [{"a": 1, "b": -1}, [1, -1], "(1,-1,0)", '{"a": 1, "b": -1}'])
def test_monotone_constraints(spark, given):  # noqa: F811
    rows = wavy(spark)
    m = fit_model(rows, target="y", estimator="xgb_regressor", params={"n_estimators": 6, "max_depth": 3, "monotone_constraints": given})
    grid = spark.range(20 * 13 * 7).select((F.col("id") % 20).cast("double").alias("a"), (F.floor(F.col("id") / 20) % 13).cast("double").alias("b"),
                                           F.floor(F.col("id") / 260).cast("double").alias("c"), F.col("id"))
    value = np.array([r["prediction"] for r in predict(grid, model=m, id="id").orderBy("id").collect()]).reshape(7, 13, 20)
    assert (np.diff(value, axis=2) >= -1e-9).all() and (np.diff(value, axis=1) <= 1e-9).all()
    assert (np.diff(value, axis=0) < 0).any() and (np.diff(value, axis=2) > 0).any()


def test_interaction_constraints(spark):  # noqa: F811
    m = fit_model(wavy(spark), target="y", estimator="xgb_regressor",
                  params={"n_estimators": 8, "max_depth": 4, "interaction_constraints": [["a"], ["b", "c"]]})
    nodes = m.node_frame()
    mixed = []
    for _, tree in nodes.groupby("tree_id"):
        tree = tree.set_index("node_id")
        paths = [(0, frozenset())]
        while paths:
            n, seen = paths.pop()
            row = tree.loc[n]
            if row["feature"] is not None:
                seen = seen | {row["feature"]}
                paths += [(int(row["left_id"]), seen), (int(row["right_id"]), seen)]
            else:
                assert seen <= {"a"} or seen <= {"b", "c"}
                mixed.append(seen)
    assert frozenset("bc") in mixed and frozenset("a") in mixed


def test_constraints_are_checked(spark):  # noqa: F811
    rows = wavy(spark)
    for params, message in (({"monotone_constraints": {"nope": 1}}, "no features"), ({"monotone_constraints": [2]}, "-1, 0 or 1"),
                            ({"interaction_constraints": [["a", "nope"]]}, "no features"),
                            ({"booster": "gblinear", "monotone_constraints": [1]}, "tree booster")):
        with pytest.raises(ValueError, match=message):
            fit_model(rows, target="y", estimator="xgb_regressor", params={"n_estimators": 1, **params})
    words = rows.withColumn("a", F.col("a").cast("string"))
    with pytest.raises(ValueError, match="no order"):
        fit_model(words, target="y", estimator="xgb_regressor", params={"n_estimators": 1, "monotone_constraints": {"a": 1}})


# ------------------------------------------------------------------------------------------------ names, targets, dictionaries

def test_columns_of_any_name(spark):  # noqa: F811
    odd = ["a.b", "__t", "__rid", "f1", "`tick`", "__bins", "__fold"]
    rows = wavy(spark).select(*[((F.col("a") * (i + 1)) % 11).alias(n) for i, n in enumerate(odd)], F.col("y").alias("the.target"),
                              F.monotonically_increasing_id().alias("my.id"))
    plain = rows.toDF(*[f"c{i}" for i in range(len(odd))], "y", "id")
    params = {"n_estimators": 3, "max_depth": 3}
    m = fit_model(rows, target="the.target", id="my.id", estimator="xgb_regressor", params=params)
    w = fit_model(plain, target="y", id="id", estimator="xgb_regressor", params=params)
    got, want = (sorted(map(tuple, predict(d, model=x, id=i).collect())) for d, x, i in ((rows, m, "my.id"), (plain, w, "id")))
    assert got == want
    assert explain(rows, model=m, id="my.id").where("feature = 'a.b'").count() == 4000
    assert {r["feature"] for r in permutation_importance(rows, model=m, target="the.target", id="my.id", n_repeats=1).collect()} == set(odd)
    assert partial_dependence(rows, model=m, feature="a.b").count() == 11
    one, two = (cross_val_score(d, target=t, id=i, estimator="xgb_regressor", params=params, cv=2).collect() for d, t, i in
                ((rows, "the.target", "my.id"), (plain, "y", "id")))
    assert [r["score"] for r in one] == pytest.approx([r["score"] for r in two], rel=1e-9)


def test_targets_that_are_no_numbers_are_named(spark):  # noqa: F811
    rows = spark.createDataFrame([(1.0, 2.0), (2.0, float("nan")), (3.0, float("inf"))], "x double, y double")
    with pytest.raises(ValueError, match="'y' holds 2 values that are NaN or infinite"):
        fit_model(rows, target="y", estimator="xgb_regressor", params={"n_estimators": 1})


def test_wide_dictionaries_match_whole_ones(spark, monkeypatch):  # noqa: F811
    rows = spark.range(4000).select(F.when(F.col("id") % 50 != 7, F.concat(F.lit("v"), (F.col("id") * 37 % 300).cast("string"))).alias("s"),
                                    F.when(F.col("id") % 9 != 0, ((F.col("id") * 13) % 700) / 4).alias("x"), (F.col("id") % 5).cast("double").alias("z"),
                                    ((F.col("id") * 37 % 300) % 11 + (F.col("id") * 13) % 700 / 50).alias("y"), F.col("id"))
    params = {"n_estimators": 4, "max_depth": 4, "tree_method": "exact", "max_cat_threshold": 20}
    whole = fit_model(rows, target="y", id="id", estimator="xgb_regressor", params=params)
    want = sorted(map(tuple, predict(rows, model=whole, id="id").collect()))
    monkeypatch.setattr(binning, "DICTIONARY", 100)
    wide = fit_model(rows, target="y", id="id", estimator="xgb_regressor", params=params)
    assert wide.meta.open_dictionary == [True, False, False] and len(wide.meta.categories[0]) < 300
    assert sorted(map(tuple, predict(rows, model=wide, id="id").collect())) == want
    again = type(wide).from_bytes(wide.to_bytes())
    assert sorted(map(tuple, predict(rows, model=again, id="id").collect())) == want
    assert max(len(c) for c in wide.nodes["left_cats"] if c is not None) <= 20


def test_poisson_of_large_counts(spark):  # noqa: F811
    rows = spark.range(500).select((F.col("id") % 10).cast("double").alias("x"), ((F.col("id") % 10) * 90_000 + 20_000).cast("double").alias("y"))
    m = fit_model(rows, target="y", estimator="xgb_regressor", params={"n_estimators": 60, "max_depth": 4, "objective": "count:poisson"})
    off = predict(rows, model=m, id="y").select((F.abs(F.col("prediction") / F.col("y") - 1)).alias("d")).agg(F.max("d")).first()[0]
    assert off < 0.1


# ------------------------------------------------------------------------------------------------ bins of each fold

def test_many_order_statistics(spark):  # noqa: F811
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=900), np.round(rng.normal(size=900), 1)
    frame = spark.createDataFrame(list(zip(a.tolist(), b.tolist())), "a double, b double").repartition(4)
    ranks = [np.array([0, 1, 450, 899]), np.arange(0, 900, 37), np.empty(0, np.int64)]

    def groups(batch):
        x, y = (batch.column(i).to_numpy() for i in (0, 1))
        yield 0, x[:len(x) // 2]
        yield 0, x[len(x) // 2:]
        yield 1, y
        yield 2, x

    got = quantiles.many_order_statistics(frame, groups, ranks)
    assert (got[0] == np.sort(a)[ranks[0]]).all() and (got[1] == np.sort(b)[ranks[1]]).all() and len(got[2]) == 0


def test_held_out_rows_have_no_say_in_the_bins(spark):  # noqa: F811
    """Fold 0's models do not change when its rows' features do; categories that only the fold holds are missing to them."""
    from boostframe.operators.common import prepare
    from boostframe.operators.evaluate import cross_val_predict
    rows = spark.range(900).select("id", ((F.col("id") * 7919 % 997) / 10).alias("x"), (F.col("id") % 5).cast("double").alias("z"),
                                   F.concat(F.lit("k"), (F.col("id") % 3).cast("string")).alias("s"),
                                   ((F.col("id") * 7919 % 997) / 40 + F.col("id") % 3).alias("y"))
    odd = rows.withColumn("x", F.when(F.col("id") < 300, F.col("x") * 1000 - 5e4).otherwise(F.col("x"))) \
              .withColumn("s", F.when(F.col("id") < 300, F.concat(F.lit("only"), "s")).otherwise(F.col("s"))) \
              .withColumn("z", F.when(F.col("id") < 300, F.col("z") + 0.5).otherwise(F.col("z")))
    params = P.resolve("xgb_regressor", {"max_bin": 8})[1]
    plain, other = (prepare(d, "y", "id", "regression", params, cv=3).stats for d in (rows, odd))
    cuts = []
    for stats in (plain, other):
        x = stats.names.index("x")
        m = stats.fold_maps[0][x]
        steps = np.flatnonzero(np.diff(m)) if m is not None else np.arange(len(stats.features[x].cuts))
        cuts.append(stats.features[x].cuts[steps].tolist())
    assert cuts[0] == cuts[1] and len(cuts[0]) == 7
    s = other.names.index("s")
    lost = [c for c, code in zip(other.features[s].categories, other.fold_maps[0][s]) if code < 0]
    assert lost == ["onlyk0", "onlyk1", "onlyk2"] and other.fold_maps[1][s] is None
    got = {r["id"]: r["prediction"] for r in cross_val_predict(odd, target="y", id="id", estimator="xgb_regressor", cv=3,
                                                              params={"max_bin": 8, "n_estimators": 3, "max_depth": 3}).collect()}
    assert len(got) == 900 and np.isfinite(list(got.values())).all()
    assert len({round(got[i], 9) for i in range(300)}) > 1


# ------------------------------------------------------------------------------------------------ SQL table functions

def test_table_functions(spark, tmp_path):  # noqa: F811
    from boostframe.operators.importance import feature_importance
    from boostframe.sources import registry
    from boostframe.sources.sqlfunctions import register_functions
    rows = spark.range(6000).select("id", F.when(F.col("id") % 11 != 0, (F.col("id") % 17).cast("decimal(10,2)")).alias("x"), (F.col("id") % 3 == 0).alias("b"),
                                    F.when(F.col("id") % 7 != 0, F.concat(F.lit("s"), (F.col("id") % 4).cast("string"))).alias("s"),
                                    F.concat(F.lit("c"), (F.col("id") % 17 / 6).cast("int").cast("string")).alias("y"))
    m = fit_model(rows, target="y", id="id", params={"n_estimators": 3, "max_depth": 3})
    registry.save(spark, m, "kind", str(tmp_path))
    register_functions(spark, root=str(tmp_path))
    rows.repartition(5).createOrReplaceTempView("rows_to_score")
    for options, given in (("", {}), (", with_proba => true", {"with_proba": True}), (", output_margin => true", {"output_margin": True}),
                           (", pred_leaf => true", {"pred_leaf": True})):
        got = spark.sql(f"SELECT * FROM predict(TABLE(rows_to_score), model_name => 'kind', id => 'id'{options})")
        want = predict(rows, model=m, id="id", **given)
        assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
        a, b = (sorted((r["id"], *[str(round(v, 9) if isinstance(v, float) else v) for v in r]) for r in d.collect()) for d in (got, want))
        assert a == b
    plan = spark.sql("SELECT * FROM predict(TABLE(rows_to_score), model_name => 'kind')")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    spark.sql("DECLARE OR REPLACE VARIABLE a_model BINARY")
    spark.createDataFrame([(bytearray(m.to_bytes()),)], "model binary").createOrReplaceTempView("a_model_row")
    spark.sql("SET VAR a_model = (SELECT model FROM a_model_row)")
    got = spark.sql("SELECT * FROM explain(TABLE(SELECT * FROM rows_to_score WHERE id < 50), model => a_model, id => 'id')")
    want = explain(rows.where("id < 50"), model=m, id="id")
    key = lambda d: sorted((r["id"], r["class"], r["feature"], round(r["shap_value"], 9), round(r["base_value"], 9)) for r in d.collect())
    assert got.columns == want.columns and key(got) == key(want)
    for kind in ("weight", "cover", "total_gain"):
        got = spark.sql(f"SELECT * FROM feature_importance(model_name => 'kind', importance_type => '{kind}')").collect()
        want = feature_importance(spark, model=m, importance_type=kind).collect()
        assert [(r[0], round(r[1], 9), r[2]) for r in got] == [(r[0], round(r[1], 9), r[2]) for r in want]
    for call, message in (("predict(TABLE(rows_to_score))", "either 'model_name' or 'model'"), ("predict(TABLE(rows_to_score), model_name => 'gone')", "not found"),
                          ("predict(TABLE(SELECT id FROM rows_to_score), model_name => 'kind')", "not present"),
                          ("predict(TABLE(rows_to_score), model_name => 'kind', with_proba => true, pred_leaf => true)", "mutually exclusive")):
        with pytest.raises(Exception, match=message):
            spark.sql(f"SELECT * FROM {call}").collect()


# ------------------------------------------------------------------------------------------------ approx

def test_weighted_summaries_keep_ranks():
    from boostframe.plans import summaries
    rng = np.random.default_rng(2)
    points = 200
    blocks = [(np.round(rng.gamma(2.0, 30.0, n), 2), rng.exponential(size=n) ** 3) for n in (5000, 40_000, 17, 9000)]
    parts = [summaries.compress(*summaries.merge([b]), points) for b in blocks]
    value, weight = summaries.compress(*summaries.merge(parts), points)
    assert len(value) <= points + 1 and weight.sum() == pytest.approx(sum(w.sum() for _, w in blocks))
    v, w = np.concatenate([b[0] for b in blocks]), np.concatenate([b[1] for b in blocks])
    order = np.argsort(v, kind="stable")
    upto, total = np.cumsum(w[order]), w.sum()
    for i, cut in zip(range(1, 16), summaries.cut_points(value, weight, 16)):
        at = np.searchsorted(v[order], cut, side="left")
        below, through = (upto[at - 1] if at else 0.0), upto[np.searchsorted(v[order], cut, side="right") - 1]
        assert below - 4 / points * total <= i / 16 * total <= through + 4 / points * total
    exact = summaries.cut_points(*summaries.merge(blocks), 16)
    assert (summaries.cut_points(*summaries.merge([summaries.merge([b]) for b in blocks]), 16) == exact).all()


def test_approx_takes_its_cuts_anew(spark):  # noqa: F811
    from boostframe.operators.evaluate import cross_val_predict
    rows = spark.range(3000).select("id", ((F.col("id") * 7919 % 2999) / 30).alias("x"), (F.col("id") % 4).cast("double").alias("z"),
                                    F.expr("CAST((id * 7919 % 2999) / 30 > 71 AND id % 4 > 0 AS INT)").alias("y"))
    params = {"n_estimators": 4, "max_depth": 2, "max_bin": 8}
    models = {m: fit_model(rows, target="y", id="id", params={**params, "tree_method": m}) for m in ("hist", "approx")}
    nodes = {m: model.node_frame() for m, model in models.items()}
    cuts = {m: [set(t.loc[t["feature"] == "x", "threshold"]) for _, t in n.groupby("tree_id")] for m, n in nodes.items()}
    assert set.union(*cuts["approx"]) - set.union(*cuts["hist"])            # weighted cuts gather where the model is unsure
    loss = {}
    for m, model in models.items():
        p = predict(rows, model=model, id="id", with_proba=True).join(rows, "id")
        loss[m] = p.agg(F.avg(-F.log(F.when(F.col("y") == 1, F.col("proba_1")).otherwise(F.col("proba_0"))))).first()[0]
    assert loss["approx"] < loss["hist"]
    # the training state and the stored model agree: in-sample accuracy from both
    model = models["approx"]
    hit = predict(rows, model=model, id="id").join(rows, "id").agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
    assert model.meta.train_score == pytest.approx(hit)
    folds = cross_val_predict(rows, target="y", id="id", params={**params, "tree_method": "approx"}, cv=3)
    assert folds.count() == 3000 and folds.join(rows, "id").where("prediction = y").count() > 2500


# ------------------------------------------------------------------------------------------------ early stopping

def test_early_stopping(spark):  # noqa: F811
    from boostframe.operators.evaluate import cross_val_predict, grid_search
    rows = spark.range(2000).select("id", (F.col("id") * 7919 % 1999 / 20).alias("x"), (F.col("id") % 13).cast("double").alias("z"),
                                    (F.col("id") % 4 == 1).alias("held"),
                                    F.when(F.col("id") * 31 % 17 > 4, F.when(F.col("id") * 7919 % 1999 > 900, "a").otherwise("b"))
                                    .otherwise(F.when(F.col("id") % 2 == 0, "a").otherwise("b")).alias("y"))
    params = {"n_estimators": 25, "max_depth": 5, "learning_rate": 0.8, "early_stopping_rounds": 3}
    m = fit_model(rows, target="y", id="id", validation="held", params=params)
    scores = m.meta.eval_scores
    assert m.meta.best_round == 1 + int(np.argmin(scores)) == m.n_trees and len(scores) == m.meta.best_round + 3 < 25
    assert m.meta.eval_metric == "logloss" and "held" not in m.meta.feature_names and m.meta.n_samples == 1500
    learned = rows.where("NOT held").drop("held")
    for r in (1, m.meta.best_round):                       # the same trees as a fit on the learned rows, with the same loss
        w = fit_model(learned, target="y", id="id", params={"n_estimators": r, "max_depth": 5, "learning_rate": 0.8})
        p = predict(rows.where("held"), model=w, id="id", with_proba=True).join(rows, "id")
        loss = p.agg(F.avg(-F.log(F.when(F.col("y") == "b", F.col("proba_b")).otherwise(F.col("proba_a"))))).first()[0]
        assert scores[r - 1] == pytest.approx(loss, abs=1e-5)
    assert w.node_frame().equals(m.node_frame())
    assert m.meta.train_score == pytest.approx(w.meta.train_score)
    watched = fit_model(rows, target="y", id="id", validation="held", params={"n_estimators": 4, "max_depth": 2, "eval_metric": "error"})
    assert len(watched.meta.eval_scores) == watched.n_trees == 4
    odd = rows.withColumn("y", F.when(F.col("held") & (F.col("id") % 3 == 0), "never learned").otherwise(F.col("y")))
    assert len(fit_model(odd, target="y", id="id", validation="held", params={"n_estimators": 2, "max_depth": 2}).meta.eval_scores) == 2
    folds = cross_val_predict(rows.drop("held"), target="y", id="id", params=params, cv=3)
    assert folds.count() == 2000
    board = grid_search(rows.drop("held"), {"xgb_classifier": {"early_stopping_rounds": [2], "learning_rate": [0.8], "max_depth": [5], "n_estimators": [12]}},
                        target="y", id="id", cv=2).collect()
    from boostframe.model import Model
    assert 1 <= Model.from_bytes(board[0]["model"]).n_trees < 12
    for given, message in (({"early_stopping_rounds": 2}, "needs 'validation'"), ({"early_stopping_rounds": 0}, ">= 1"),
                           ({"early_stopping_rounds": 2, "booster": "dart"}, "booster gbtree")):
        with pytest.raises(ValueError, match=message):
            fit_model(rows.drop("held"), target="y", params={"n_estimators": 1, **given})
    with pytest.raises(ValueError, match="does not fit"):
        fit_model(rows, target="y", validation="held", params={"n_estimators": 1, "eval_metric": "rmse"})
