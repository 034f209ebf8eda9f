"""Training statistics and the binned table.

One aggregation checks the target, one pass finds the exact distinct values of every feature that has few of them: at
most ``max_bin`` numbers, ``DICTIONARY`` strings (each task gives up on a column at the first value beyond). Quantile
sketches follow for the other numbers. String columns beyond, and under ``tree_method="exact"`` numbers beyond, get a
dictionary that is a table: their distinct values with the codes of a distributed ranking, joined back to the rows. Of it
the driver sees only the values that a split uses in the end (`look_up`). A ``mapInArrow`` turns every feature into a bin
code (-1 = missing).
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.kernel import FIXED_SCALE
from ..memory import releasing
from ..schemas import CLASSIFICATION
from .features import categorical_mask, feature_columns, positional, quoted
from .quantiles import many_order_statistics
from .ranks import with_rank

DICTIONARY = 4096         # values of a dictionary that a model holds whole; beyond, dictionaries are tables
_QUANTILE_GROUP = 16      # quantile sketches per aggregation job (bounds task memory on wide tables)


@dataclass
class FeatureInfo:
    name: str
    categorical: bool
    cuts: np.ndarray | None = None          # numeric: x < cuts[b] ⇔ bin ≤ b
    categories: list[str] | None = None     # categorical: sorted dictionary, code = index
    sketched: bool = False                  # numeric: cuts are quantiles, not all values
    wide: int | None = None                 # number of values, if the dictionary is a table
    open: bool = False                      # ``categories`` are those that splits name; others are ordinary, not missing
    used: dict | None = None                # wide: code → value of the codes that splits use

    @property
    def n_bins(self) -> int:
        if self.wide is not None:
            return max(self.wide, 1)
        if self.categorical:
            return max(len(self.categories or []), 1)
        return len(self.cuts) + 1

    def threshold(self, split_bin: int) -> float:
        return float(self.used[split_bin + 1] if self.wide is not None else self.cuts[split_bin])

    def model_categories(self) -> list[str] | None:
        if not self.categorical:
            return None
        return sorted(self.used.values()) if self.wide is not None else self.categories

    def model_codes(self, codes: list[int]) -> list[int]:
        """Codes of the model's dictionary for those of the bins."""
        if self.wide is None:
            return list(codes)
        place = {v: i for i, v in enumerate(sorted(self.used.values()))}
        return sorted(place[self.used[c]] for c in codes)


@dataclass
class DataStats:
    features: list[FeatureInfo]
    task: str
    target: str
    target_type: T.DataType
    classes: list[Any] | None
    class_counts: list[int] | None
    n_rows: int
    y_sum: float = 0.0
    y_min: float | None = None
    y_max: float | None = None
    tables: dict | None = None          # position of a wide feature → its dictionary (value, code)
    fold_maps: list | None = None       # per fold and feature: bin code → code for the models that don't see the fold

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.features]


def target_sum(y: Column) -> Column:
    """Sum of a target, exact (and so the same under any partitioning) for values below 2^40, as a fixed-point integer."""
    small = F.when(F.abs(y) < float(1 << 40), F.floor(y * F.lit(FIXED_SCALE) + F.lit(0.5)))
    return F.struct(F.sum(small.cast("decimal(38,0)")).alias("fixed"), F.sum(y).alias("plain"),
                    F.max(F.abs(y)).alias("largest"))


def sum_value(row) -> float:
    """The value of `target_sum`; targets too large or too small for the grid take the plain sum."""
    if row["largest"] is None:
        return 0.0
    return float(row["fixed"]) / FIXED_SCALE if 2.0 ** -4 <= row["largest"] < 2.0 ** 40 else float(row["plain"])


def distinct_values(df: DataFrame, feats: list[str], cat: list[bool], limit: int) -> list[list | None]:
    """Distinct values of every feature without missing ones; None for a numeric one with more than ``limit`` and for a
    string one with more than DICTIONARY."""
    limits = [DICTIONARY if c else limit for c in cat]
    cols = df.select(*[quoted(f).cast("string" if c else "double").alias(f"c{j}") for j, (f, c) in enumerate(zip(feats, cat))])

    def kernel(batches):
        seen: list = [set() if c else np.empty(0) for c in cat]
        for batch in batches:
            for j, c in enumerate(cat):
                if seen[j] is None:
                    continue
                if c:
                    seen[j].update(v for v in pc.unique(batch.column(j)).to_pylist() if v is not None)
                else:
                    v = batch.column(j).to_numpy(zero_copy_only=False)
                    seen[j] = np.union1d(seen[j], v[~np.isnan(v)])
                if len(seen[j]) > limits[j]:
                    seen[j] = None
        for j, c in enumerate(cat):
            values = [] if seen[j] is None else list(seen[j])
            none = pa.nulls(len(values) + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(values) + 1, j, np.int32)),
                 none.cast(pa.float64()) if c else pa.array([None, *values], pa.float64()),
                 pa.array([None, *values], pa.string()) if c else none.cast(pa.string()),
                 pa.array([seen[j] is None] + [False] * len(values))], ["f", "d", "s", "over"])

    found = cols.mapInArrow(releasing(kernel), "f int, d double, s string, over boolean").distinct()
    over = found.where("over").select("f").distinct()
    kept = (found.where("NOT over AND (d IS NOT NULL OR s IS NOT NULL)")
            .join(F.broadcast(over), "f", "left_anti")).toArrow()         # at most one row per feature in `over`
    f = kept.column("f").to_numpy()
    d, s = kept.column("d").to_numpy(zero_copy_only=False), kept.column("s").to_pylist()
    too_many = {r["f"] for r in over.collect()}
    out: list[list | None] = []
    for j, c in enumerate(cat):
        mine = np.flatnonzero(f == j)
        values = [s[i] for i in mine] if c else list(d[mine])
        out.append(None if j in too_many or len(values) > limits[j] else sorted(values))
    return out


def collect_stats(df: DataFrame, target: str, id_col: str, task: str, max_bin: int = 256,
                  tree_method: str = "hist", features: list[str] | None = None) -> DataStats:
    feats = features if features is not None else feature_columns(df, target, id_col)
    if not feats:
        raise ValueError("no feature columns: the input needs at least one column besides target and id")
    cat = categorical_mask(df, feats)
    fields = {f.name: f.dataType for f in df.schema.fields}
    target_type = fields[target]
    if task != CLASSIFICATION and not isinstance(target_type, (T.ByteType, T.ShortType, T.IntegerType,
                                                               T.LongType, T.FloatType, T.DoubleType,
                                                               T.DecimalType, T.BooleanType)):
        raise ValueError(f"regression target {target!r} must be numeric, got {target_type.simpleString()}")
    aggs: list[Column] = [F.count(F.lit(1)).alias("n"), F.count(quoted(target)).alias("n_target")]
    if task != CLASSIFICATION:
        yv = quoted(target).cast("double")
        aggs += [F.count(F.when(F.isnan(yv) | (F.abs(yv) == float("inf")), 1)).alias("n_odd"), target_sum(yv).alias("y"), F.min(yv).alias("y_min"), F.max(yv).alias("y_max")]
    row = df.agg(*aggs).first().asDict()
    n = int(row["n"])
    if n == 0:
        raise ValueError("received no rows to fit on")
    if int(row["n_target"]) == 0 and task == CLASSIFICATION:
        raise ValueError(f"target {target!r} has no usable labels: all of them are NULL")
    if int(row["n_target"]) < n:
        raise ValueError(f"{task} target {target!r} contains NULL labels; leave those rows out or fill them in first")
    if task != CLASSIFICATION and int(row["n_odd"]):
        raise ValueError(f"regression target {target!r} holds {row['n_odd']} values that are NaN or infinite; leave those rows out")

    values = distinct_values(df, feats, cat, DICTIONARY if tree_method == "exact" else max_bin)
    tables = {i: dictionary_table(df, feats[i], cat[i]) for i, v in enumerate(values)
              if v is None and (cat[i] or tree_method == "exact")}
    wide = [i for i, v in enumerate(values) if v is None and i not in tables]
    cut_points = [i / max_bin for i in range(1, max_bin)]
    quantiles: dict[int, list] = {}
    for q0 in range(0, len(wide), _QUANTILE_GROUP):
        group = wide[q0:q0 + _QUANTILE_GROUP]
        got = df.agg(*[F.percentile_approx(F.nanvl(quoted(feats[i]).cast("double"), F.lit(None).cast("double")), cut_points,
                                           max(1000, 8 * max_bin)).alias(f"q{i}") for i in group]).first()
        quantiles.update({i: got[f"q{i}"] for i in group})

    infos: list[FeatureInfo] = []
    for i, (name, c) in enumerate(zip(feats, cat)):
        if i in tables:
            infos.append(FeatureInfo(name, c, wide=tables[i].count()))
        elif c:
            infos.append(FeatureInfo(name, True, categories=values[i]))
        else:
            cuts = np.asarray(values[i][1:] if values[i] is not None else quantiles[i], dtype=np.float64)
            infos.append(FeatureInfo(name, False, cuts=np.unique(cuts), sketched=values[i] is None))

    classes = counts = None
    if task == CLASSIFICATION:
        crow = df.groupBy(quoted(target).alias("label")).agg(F.count(F.lit(1)).alias("c")).toArrow()
        pairs = sorted(zip(crow.column("label").to_pylist(), crow.column("c").to_pylist()), key=lambda t: t[0])
        classes = [p[0] for p in pairs]
        counts = [int(p[1]) for p in pairs]
    stats = DataStats(infos, task, target, target_type, classes, counts, n, tables=tables)
    if task != CLASSIFICATION:
        stats.y_sum = sum_value(row["y"])
        stats.y_min, stats.y_max = row["y_min"], row["y_max"]
    return stats


def dictionary_table(df: DataFrame, feature: str, categorical: bool) -> DataFrame:
    """(value, code) of the distinct values of a feature in order, by the distributed ranking; missing ones have none."""
    value = quoted(feature).cast("string" if categorical else "double").alias("value")
    values = df.select(value).where("value IS NOT NULL" if categorical else "value IS NOT NULL AND NOT isnan(value)").distinct()
    ranked, _, layout = with_rank(values, ["value"])
    table = materialise(ranked.select("value", F.col("__rank").cast("long").alias("code")))
    layout.unpersist()
    return table


def materialise(df: DataFrame) -> DataFrame:
    """Write a result to the session's checkpoint directory, so that what it came from can be released."""
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return df.checkpoint(eager=True)


def look_up(stats: DataStats, trees: list) -> list[FeatureInfo]:
    """The features, wide ones with the values of the codes that splits of ``trees`` use."""
    infos = list(stats.features)
    for f, table in (stats.tables or {}).items():
        codes: set[int] = set()
        for grower, _ in trees:
            for feature, split_bin, cats in zip(grower.feat, grower.split_bin, grower.cats):
                if feature == f:
                    codes.update([split_bin + 1] if cats is None else cats)
        asked = table.sparkSession.createDataFrame([(int(c),) for c in sorted(codes)], "code long")
        found = table.join(F.broadcast(asked), "code").collect()            # as many rows as splits name values
        infos[f] = replace(infos[f], used={int(r["code"]): r["value"] for r in found})
    return infos


def encode_features(batch: pa.RecordBatch, infos: list[FeatureInfo], value_space: bool) -> np.ndarray:
    """Feature matrix ``[rows, F]`` as float64: numeric values (NaN = missing) or, with
    ``value_space=False``, bin codes (-1 = missing); categories are dictionary codes (NaN if unseen/NULL)."""
    n = batch.num_rows
    X = np.empty((n, len(infos)), dtype=np.float64)
    for j, info in enumerate(infos):
        col = batch.column(f"f{j}")
        if info.wide is not None:                      # joined to its dictionary: the code, or the number itself
            v = col.to_numpy(zero_copy_only=False).astype(np.float64)
            if not value_space:
                v = np.where(np.isnan(v), -1.0, v)
        elif info.categorical:
            codes = pc.index_in(col.cast(pa.string()), value_set=pa.array(info.categories or [], pa.string()))
            v = codes.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls → NaN
            if info.open:                              # a value that no split names
                v = np.where(np.isnan(v) & col.is_valid().to_numpy(zero_copy_only=False), float(len(info.categories)), v)
            if not value_space:
                v = np.where(np.isnan(v), -1.0, v)
        else:
            if pa.types.is_decimal(col.type) or pa.types.is_boolean(col.type):
                col = col.cast(pa.float64())
            v = col.to_numpy(zero_copy_only=False).astype(np.float64)
            if not value_space:
                b = np.searchsorted(info.cuts, v, side="right").astype(np.float64)
                v = np.where(np.isnan(v), -1.0, b)
        X[:, j] = v
    return X


BINS_COL = "__bins"


def code_type(infos: list[FeatureInfo]) -> str:
    """Type of a bin code: two bytes unless a feature has more bins than they count."""
    return "<i2" if max((i.n_bins for i in infos), default=0) < 1 << 15 else "<i4"


def pack_bins(X: np.ndarray, kind: str = "<i2") -> pa.Array:
    """Bin codes ``[rows, F]`` → one BINARY value per row (F little-endian codes): the cached state
    then converts one column per row to Arrow instead of F."""
    n, f = X.shape
    data = np.ascontiguousarray(X.astype(kind))
    width = data.itemsize * f
    offsets = (np.arange(n + 1) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def unpack_bins(col: pa.Array, n_feat: int, kind: str = "<i2") -> np.ndarray:
    """Inverse of ``pack_bins`` → codes ``[rows, F]``."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], dtype=np.int32, count=col.offset + n + 1)[col.offset:]
    raw = np.frombuffer(bufs[2], dtype=np.uint8)[offs[0]:offs[-1]]
    return raw.view(kind).reshape(n, n_feat)


def fold_local(binned: DataFrame, stats: DataStats, folds: int, max_bin: int, approx: bool = False) -> tuple[DataFrame, DataStats]:
    """The binned table and statistics of cross-validation: each fold's models get bins of the rows outside the fold only.

    Sketched features are cut at the ``max_bin`` quantiles of those rows (exact ranks); their codes become places among
    the cuts of all folds. Other features have the values that occur outside the fold: a number between two of them falls
    to the lower one, a category that is none of them is missing. Both are a small map per fold and feature from a row's
    code to the code that the fold's models see, so the rows are stored once. Dictionaries that are tables serve all folds. With
    ``approx`` sketched features are left as they are: training cuts them anew every round.
    """
    infos = list(stats.features)
    sketched = [j for j, i in enumerate(infos) if i.sketched and not approx]
    cuts: dict = {}
    if sketched:
        def outside(batch):
            fold = batch.column(0).to_numpy(zero_copy_only=False)
            for p, _ in enumerate(sketched):
                value = batch.column(1 + p).to_numpy(zero_copy_only=False)
                for k in range(folds):
                    yield p * folds + k, value[fold != k]

        held = [F.count(F.when((F.col("__fold") != k) & ~F.isnan(F.col(f"__w{j}")), 1)) for j in sketched for k in range(folds)]
        counts = list(binned.agg(*[c.alias(f"n{i}") for i, c in enumerate(held)]).first())
        ranks = [np.unique(np.arange(1, max_bin) * int(n) // max_bin) if n else np.empty(0, np.int64) for n in counts]
        values = many_order_statistics(binned.select("__fold", *[f"__w{j}" for j in sketched]), outside, ranks)
        for p, j in enumerate(sketched):
            mine = [np.unique(values[p * folds + k]) for k in range(folds)]
            infos[j] = replace(infos[j], cuts=np.unique(np.concatenate(mine)))
            cuts.update({(k, j): mine[k] for k in range(folds)})
        old, new, n_feat = code_type(stats.features), code_type(infos), len(infos)

        def recode(batches):
            for batch in batches:
                names = batch.schema.names
                X = unpack_bins(batch.column(names.index(BINS_COL)), n_feat, old).astype(np.float64)
                for j in sketched:
                    value = batch.column(names.index(f"__w{j}")).to_numpy(zero_copy_only=False)
                    X[:, j] = np.where(np.isnan(value), -1.0, np.searchsorted(infos[j].cuts, value, side="right"))
                left = [n for n in names if not n.startswith("__w")]
                yield pa.RecordBatch.from_arrays([pack_bins(X, new) if n == BINS_COL else batch.column(names.index(n)) for n in left], names=left)

        kept = T.StructType([f for f in binned.schema if not f.name.startswith("__w")])
        binned = binned.mapInArrow(releasing(recode), kept)
    n_bins = np.array([0 if i.wide is not None else i.n_bins for i in infos])
    start = np.concatenate([[0], np.cumsum(n_bins)])
    kind, n_feat, size = code_type(infos), len(infos), int(start[-1])

    def present(batches):
        seen = np.zeros((folds, size), bool)
        for batch in batches:
            X = unpack_bins(batch.column(1), n_feat, kind)
            fold = batch.column(0).to_numpy(zero_copy_only=False)
            for j in range(n_feat):
                known = (X[:, j] >= 0) & (n_bins[j] > 0)
                seen[fold[known], start[j] + X[known, j]] = True
        fold, cell = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(fold.astype(np.int32)), pa.array(cell.astype(np.int32))], names=["fold", "cell"])

    found = binned.select("__fold", BINS_COL).mapInArrow(releasing(present), "fold int, cell int").distinct().toArrow()    # folds × bins at most
    seen = np.zeros((folds, size), bool)
    seen[found.column("fold").to_numpy(), found.column("cell").to_numpy()] = True
    maps: list = []
    for k in range(folds):
        others = seen[np.arange(folds) != k].any(0)
        row: list = []
        for j, info in enumerate(infos):
            mine = others[start[j]:start[j + 1]]
            if info.wide is not None:
                row.append(None)
            elif info.sketched and approx:
                row.append(None)
            elif info.sketched:
                row.append(np.concatenate([[0], np.searchsorted(cuts[k, j], info.cuts, side="right")]))
            elif mine.all() or not len(mine):
                row.append(None)
            elif info.categorical:
                row.append(np.where(mine, np.arange(len(mine)), -1))
            else:
                row.append(np.maximum(np.cumsum(mine) - 1, 0))
        maps.append(row)
    same = all(m is None for row in maps for m in row)
    return binned, replace(stats, features=infos, fold_maps=None if same else maps)


def table_inputs(df: DataFrame, stats: DataStats, id_col: str = "", validation: str = "") -> DataFrame:
    """What `binned_table` encodes: ``__rid`` (row hash, partitioning-independent), ``__t`` (the target as it is), ``[__id]``,
    ``[__val]`` and the features by position, wide ones as codes of their dictionary."""
    infos = stats.features
    carried = [("__id", id_col)] * bool(id_col) + [("__val", validation)] * bool(validation)
    inp = df.select(F.xxhash64(*[quoted(c) for c in df.columns]).alias("__rid"),
                    quoted(stats.target).alias("__t"),
                    *[quoted(c).cast("boolean").alias(n) if n == "__val" else quoted(c).alias(n) for n, c in carried],
                    *positional(stats.names))
    for j, table in (stats.tables or {}).items():
        value = F.col(f"f{j}").cast("string" if infos[j].categorical else "double")
        inp = (inp.withColumn(f"f{j}", value).join(table.select(F.col("value").alias("__v"), F.col("code").alias("__c")),
                                                   F.col(f"f{j}") == F.col("__v"), "left")
               .drop(f"f{j}", "__v").withColumnRenamed("__c", f"f{j}"))
    return inp.select("__rid", "__t", *[n for n, _ in carried], *[f"f{j}" for j in range(len(infos))])


def binned_table(inp: DataFrame, stats: DataStats, keep_raw: bool = False, keep_sketched: bool = False) -> DataFrame:
    """``__rid``, ``__y`` (target or class code), ``[__id]``, ``[__val]``, ``[__fold]``, ``__bins`` (packed bin codes) of
    `table_inputs`; with ``keep_sketched`` also ``__w{j}``, the numbers of sketched features. No shuffle. ``__val`` marks
    rows that are only evaluated."""
    infos = stats.features
    carried = [n for n in ("__id", "__val", "__fold") if n in inp.columns]
    kept = [j for j, i in enumerate(infos) if i.sketched and keep_sketched]
    classes = stats.classes
    kind = code_type(infos)
    inp = inp.select("__rid", "__t", *carried, *[f"f{j}" for j in range(len(infos))])
    id_field = [T.StructField(n, inp.schema[n].dataType, True) for n in carried]
    out_schema = T.StructType([T.StructField("__rid", T.LongType(), False),
                               T.StructField("__y", T.DoubleType(), False)] + id_field +
                              [T.StructField(BINS_COL, T.BinaryType(), False)] +
                              ([T.StructField(f"__x{j}", T.DoubleType(), False) for j in range(len(infos))]
                               if keep_raw else []) + [T.StructField(f"__w{j}", T.DoubleType(), False) for j in kept])

    def kernel(batches):
        value_set = None
        for batch in batches:
            t = batch.column("__t")
            if classes is not None:
                if value_set is None:
                    value_set = pa.array(classes, type=t.type)
                y = pc.index_in(t, value_set=value_set).to_numpy(zero_copy_only=False).astype(np.float64)
            else:
                y = t.cast(pa.float64()).to_numpy(zero_copy_only=False)
            X = encode_features(batch, infos, value_space=False)
            cols = [batch.column("__rid"), pa.array(y, pa.float64())]
            cols += [batch.column(n) for n in carried]
            cols.append(pack_bins(X, kind))
            if keep_raw:
                R = encode_features(batch, infos, value_space=True)
                cols += [pa.array(R[:, j], pa.float64()) for j in range(len(infos))]
            elif kept:
                R = encode_features(batch, infos, value_space=True)
            cols += [pa.array(R[:, j], pa.float64()) for j in kept]
            yield pa.RecordBatch.from_arrays(cols, schema=pa.schema(
                [pa.field("__rid", pa.int64(), False), pa.field("__y", pa.float64(), False)]
                + [pa.field(n, batch.column(n).type) for n in carried]
                + [pa.field(BINS_COL, pa.binary(), False)]
                + ([pa.field(f"__x{j}", pa.float64(), False) for j in range(len(infos))] if keep_raw else [])
                + [pa.field(f"__w{j}", pa.float64(), False) for j in kept]))

    return inp.mapInArrow(releasing(kernel), out_schema)
