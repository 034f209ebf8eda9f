"""What a task holds and does beyond its rows."""

import pyarrow as pa
from pyspark.sql import functions as F

from boostframe import fit_model
from boostframe.memory import BATCH_BYTES, bound_batches
from boostframe.plans.train import pack_state


def _sizes(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])


def test_packed_state_reaches_python_a_few_blocks_at_a_time(spark):
    """A partition of many blocks is read in batches of bounded bytes, whatever its size."""
    rows = spark.range(0, 400_000, 1, 1)
    fit_model(rows.limit(50).select("id", F.col("id").cast("double").alias("target")), target="target", estimator="xgb_regressor",
              params={"n_estimators": 1, "max_depth": 1})
    state = rows.select(F.col("id").alias("__rid"), *[F.rand(i).alias(f"__m{i}") for i in range(4)])
    got = pack_state(state).mapInArrow(_sizes, "n long, size long").collect()
    block = 10_000 * 5 * 8
    assert len(got) > 1 and max(r["size"] for r in got) <= BATCH_BYTES + 2 * block


def test_a_smaller_limit_of_the_session_stays(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "1m")
        bound_batches(spark)
        assert spark.conf.get(key) in ("1m", str(1 << 20), "1048576b")
    finally:
        spark.conf.set(key, before)


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_are_numbered_without_python(spark):
    """Ranks, also within groups, are column expressions, and equal to those of a sort of all rows."""
    from boostframe.plans.ranks import with_rank
    rows = [(k % 7, "abc"[k % 3], k % 4) for k in range(300)]
    df = spark.createDataFrame(rows, "x int, g string, z int").repartition(5)
    whole, _, a = with_rank(df, ["x", "z"])
    assert "MapInArrow" not in _plan(whole)
    got = sorted((r["__rank"], r["x"], r["z"]) for r in whole.collect())
    assert [g[0] for g in got] == list(range(300)) and [g[1:] for g in got] == sorted((x, z) for x, _, z in rows)
    grouped, info, b = with_rank(df, ["x", "z"], "g")
    assert "MapInArrow" not in _plan(grouped) and info.totals == [100, 100, 100]
    for g in "abc":
        got = sorted((r["__rank"], r["x"], r["z"]) for r in grouped.where(F.col("g") == g).collect())
        assert [v[0] for v in got] == list(range(100)) and [v[1:] for v in got] == sorted((x, z) for x, h, z in rows if h == g)
    a.unpersist(), b.unpersist()


def test_folds_are_dealt_without_encoding_the_rows_before(spark):
    """The ranking that folds come from reads the input as it is: features are encoded once, after it."""
    from boostframe.operators.common import prepare
    from boostframe.params import resolve
    df = spark.createDataFrame([(i, float(i % 9), float(i % 5)) for i in range(200)], "id long, x double, target double")
    task, p = resolve("xgb_regressor", "")
    prep = prepare(df, "target", "id", task, p, cv=4)
    assert not any("MapInArrow" in d._jdf.queryExecution().withCachedData().toString() or "MapInArrow" in d._jdf.queryExecution().analyzed().toString()
                   for d in prep.release)
    for d in prep.release:
        d.unpersist()


def _regression(spark):
    rows = [(i, float(i % 9), float(i * 7 % 5), float(i % 9 + i * 7 % 5)) for i in range(300)]
    return spark.createDataFrame(rows, "id long, x double, z double, target double")


def test_search_stores_no_margins_before_trees_are_written(spark, monkeypatch):
    """A pass over rows that no written tree has moved needs no margin of any model: they are the starting ones."""
    from boostframe.operators.evaluate import grid_search
    from boostframe.plans import train as TR
    seen, pack = [], TR.pack_state
    monkeypatch.setattr(TR, "pack_state", lambda state: seen.append(state.columns) or pack(state))
    grid_search(_regression(spark), {"xgb_regressor": {"learning_rate": [0.1, 0.3], "max_depth": [1, 2], "n_estimators": [2]}},
                target="target", id="id", cv=3)
    assert [sorted(c) for c in seen] == [["__bins", "__fold", "__y"], ["__bins", "__y"]]


def test_margins_stored_or_added_when_read_are_the_same(spark, monkeypatch):
    from boostframe.operators.evaluate import cross_val_predict, grid_search
    from boostframe.plans import train as TR
    df = _regression(spark)
    grid = {"xgb_regressor": {"learning_rate": [0.3], "max_depth": [2], "n_estimators": [1, 4], "subsample": [0.7, 1.0]}}
    found = []
    for at_most in (1, 1000):
        monkeypatch.setattr(TR, "PENDING_TREES", at_most)
        board = grid_search(df, grid, target="target", id="id", cv=3).collect()
        out = cross_val_predict(df, target="target", estimator="xgb_regressor", id="id", cv=3, params={"n_estimators": 4, "max_depth": 2})
        model = fit_model(df, target="target", estimator="xgb_regressor", id="id", params={"n_estimators": 4, "max_depth": 2, "booster": "dart", "rate_drop": 0.5})
        found.append(([tuple(r[:5]) for r in board], sorted(map(tuple, out.collect())), model.meta.train_score))
    assert found[0] == found[1] and len(found[0][1]) == 300


def test_a_large_training_state_is_kept_off_the_heap():
    from boostframe.memory import DISK_ROWS, storage
    assert storage(DISK_ROWS - 1).useMemory and not storage(DISK_ROWS).useMemory and storage(DISK_ROWS).useDisk


def test_the_layout_of_a_ranking_is_on_disk_and_has_what_is_needed(spark):
    from boostframe.plans.ranks import with_rank
    df = spark.createDataFrame([(k * 7 % 50, "ab"[k % 2], float(k)) for k in range(50)], "x int, g string, v double").repartition(3)
    want = sorted((k * 7 % 50, float(k)) for k in range(50))
    ranked, _, layout = with_rank(df, ["x"], keep=["v"])
    assert layout.columns == ["v", "__pid", "__pos"] and layout.storageLevel.useDisk and not layout.storageLevel.useMemory
    assert [r["v"] for r in ranked.orderBy("__rank").collect()] == [v for _, v in want]
    grouped, info, other = with_rank(df, ["x"], "g", keep=["v"])
    assert info.totals == [25, 25] and info.first == [(min(x for x, v in want if v % 2 == i),) for i in (0, 1)]
    for i, g in enumerate("ab"):
        assert [r["v"] for r in grouped.where(F.col("g") == g).orderBy("__rank").collect()] == [v for _, v in want if v % 2 == i]
    layout.unpersist(), other.unpersist()


def test_randomized_search_trains_on_bins_and_targets_alone(spark, monkeypatch):
    """Neither ids nor row hashes go through the passes of a search that samples no rows; scores are those of the grid."""
    from boostframe.operators.evaluate import grid_search, randomized_search
    from boostframe.plans import train as TR
    df = _regression(spark).withColumn("target", F.when(F.col("target") > 6, "high").otherwise("low"))
    seen, pack = [], TR.pack_state
    monkeypatch.setattr(TR, "pack_state", lambda state: seen.append(state.columns) or pack(state))
    grid = {"xgb_classifier": {"learning_rate": [0.1, 0.9], "max_depth": [1], "n_estimators": [1, 2]}}
    drawn = randomized_search(df, grid, target="target", id="id", n_iter=3, cv=3, random_state=1).collect()
    assert [sorted(c) for c in seen] == [["__bins", "__fold", "__y"], ["__bins", "__y"]]
    whole = {r["params"]: r["mean_test_score"] for r in grid_search(df, grid, target="target", id="id", cv=3).collect()}
    assert len(drawn) == 3 and all(whole[r["params"]] == r["mean_test_score"] for r in drawn)
