"""The fitted model: metadata + a node table (value space), as a BINARY value or plain rows."""

from __future__ import annotations

import datetime as _dt
import gzip
import json
import warnings
from dataclasses import asdict, dataclass, field
from typing import Any

import numpy as np
import pandas as pd

from .functions import kernel as K
from .plans.binning import FeatureInfo

FORMAT_VERSION = "1"
_MAGIC = b"BFM1"


@dataclass
class ModelMeta:
    """What a node table needs to be applied: how inputs are read, how margins become answers, and where it comes from."""
    # inputs: one entry per feature, in the order of the node table's feature_idx
    feature_names: list[str]
    categorical: list[bool] | None = None
    categories: list[list[str] | None] | None = None     # dictionaries of the string features
    open_dictionary: list[bool] | None = None             # of these, which hold only the values that splits name
    # answers
    task: str = "regression"
    objective: str = "reg:squarederror"
    n_groups: int = 1
    base_margin: list[float] = field(default_factory=lambda: [0.0])
    classes: list[Any] | None = None
    label_type: str = "bigint"
    # booster
    booster: str = "gbtree"
    linear_weights: list[list[float]] | None = None       # gblinear: [feature][group]
    linear_bias: list[float] | None = None
    params: dict[str, Any] = field(default_factory=dict)
    # origin
    name: str = ""
    estimator: str = ""
    target: str = ""
    n_samples: int = 0
    n_features: int = 0
    train_score: float | None = None
    eval_metric: str | None = None                        # of the rows that were only evaluated, after every round
    eval_scores: list[float] | None = None
    best_round: int | None = None                         # rounds that are kept
    created_at: str = ""
    format_version: str = FORMAT_VERSION


def decode_meta(stored: dict[str, Any]) -> ModelMeta:
    """Metadata written by this or another format version: entries this one doesn't know are left out."""
    meta = ModelMeta(stored["feature_names"])
    for key in vars(meta).keys() & stored.keys():
        setattr(meta, key, stored[key])
    return meta


# node table columns (per node)
NODE_COLS = ["tree_id", "class_id", "node_id", "feature_idx", "threshold", "left_cats", "default_left",
             "left_id", "right_id", "gain", "cover", "leaf_value"]


@dataclass
class Model:
    meta: ModelMeta
    nodes: dict[str, list]          # NODE_COLS → lists; left_cats holds category codes (or None)
    tree_weight: list[float]
    tree_class: list[int]

    # ------------------------------------------------------------------ construction
    @staticmethod
    def empty_nodes() -> dict[str, list]:
        return {c: [] for c in NODE_COLS}

    @classmethod
    def from_growers(cls, meta: ModelMeta, trees: list, infos: list[FeatureInfo]) -> Model:
        nodes = cls.empty_nodes()
        weights, klass = [], []
        for t, (g, w) in enumerate(trees):
            weights.append(float(w))
            klass.append(int(g.group))
            for i in range(len(g.feat)):
                f = g.feat[i]
                nodes["tree_id"].append(t)
                nodes["class_id"].append(int(g.group))
                nodes["node_id"].append(i)
                nodes["feature_idx"].append(int(f))
                if f >= 0 and not infos[f].categorical:
                    nodes["threshold"].append(float(g.cuts[f][g.split_bin[i]]) if f in g.cuts else infos[f].threshold(g.split_bin[i]))
                else:
                    nodes["threshold"].append(None)
                nodes["left_cats"].append(infos[f].model_codes(g.cats[i]) if (f >= 0 and g.cats[i] is not None) else None)
                nodes["default_left"].append(bool(g.dleft[i]) if f >= 0 else None)
                nodes["left_id"].append(int(g.left[i]) if f >= 0 else None)
                nodes["right_id"].append(int(g.right[i]) if f >= 0 else None)
                nodes["gain"].append(float(g.gain[i]) if f >= 0 else None)
                nodes["cover"].append(float(g.H[i]))
                nodes["leaf_value"].append(float(g.value[i]) if f < 0 else None)
        return cls(meta, nodes, weights, klass)

    # ------------------------------------------------------------------ views
    @property
    def n_trees(self) -> int:
        return len(self.tree_weight)

    def feature_infos(self) -> list[FeatureInfo]:
        cat = self.meta.categorical or [False] * len(self.meta.feature_names)
        cats = self.meta.categories or [None] * len(self.meta.feature_names)
        opened = self.meta.open_dictionary or [False] * len(self.meta.feature_names)
        return [FeatureInfo(n, bool(c), categories=cs, open=bool(o)) for n, c, cs, o in zip(self.meta.feature_names, cat, cats, opened)]

    def forest(self) -> K.Forest:
        """Flattened trees for the scoring kernels (value-space thresholds, category codes)."""
        trees = []
        nd = self.nodes
        starts = _tree_starts(nd["tree_id"], self.n_trees)
        for t in range(self.n_trees):
            a, b = starts[t], starts[t + 1]
            feat = nd["feature_idx"][a:b]
            trees.append({
                "feat": feat,
                "thr": [v if v is not None else 0.0 for v in nd["threshold"][a:b]],
                "dleft": [bool(v) if v is not None else True for v in nd["default_left"][a:b]],
                "left": [v if v is not None else -1 for v in nd["left_id"][a:b]],
                "right": [v if v is not None else -1 for v in nd["right_id"][a:b]],
                "value": [v if v is not None else 0.0 for v in nd["leaf_value"][a:b]],
                "cats": nd["left_cats"][a:b],
            })
        return K.build_forest(trees, self.tree_class, self.tree_weight)

    def node_frame(self) -> pd.DataFrame:
        """Node table with feature names and category labels (the user-facing form)."""
        names = self.meta.feature_names
        cats = self.meta.categories or [None] * len(names)
        nd = self.nodes
        rows = {
            "tree_id": nd["tree_id"], "class_id": nd["class_id"], "node_id": nd["node_id"],
            "feature": [names[f] if f >= 0 else None for f in nd["feature_idx"]],
            "threshold": nd["threshold"],
            "left_cats": [[cats[f][c] for c in lc] if lc is not None else None
                          for f, lc in zip(nd["feature_idx"], nd["left_cats"])],
            "default_left": nd["default_left"], "left_id": nd["left_id"], "right_id": nd["right_id"],
            "gain": nd["gain"], "cover": nd["cover"], "leaf_value": nd["leaf_value"],
            "tree_weight": [self.tree_weight[t] for t in nd["tree_id"]],
        }
        return pd.DataFrame(rows)

    def node_rows(self) -> list[tuple]:
        """Node table rows in ``NODE_SCHEMA`` order (for ``spark.createDataFrame``)."""
        f = self.node_frame()
        out = []
        for r in zip(*[f[c].tolist() for c in f.columns]):
            out.append(tuple(None if (isinstance(v, float) and v != v and i not in (4, 9, 10, 11)) else v
                             for i, v in enumerate(r)))
        return [_fix_row(r) for r in out]

    # ------------------------------------------------------------------ value codec
    def to_bytes(self) -> bytes:
        payload = {"meta": asdict(self.meta), "nodes": self.nodes, "tree_weight": self.tree_weight,
                   "tree_class": self.tree_class}
        raw = json.dumps(payload, default=_json_default, separators=(",", ":")).encode()
        return _MAGIC + gzip.compress(raw, compresslevel=6)

    @classmethod
    def from_bytes(cls, blob: bytes | bytearray | memoryview) -> Model:
        if blob is None:
            raise ValueError("model value is NULL")
        blob = bytes(blob)
        if len(blob) < 8 or not blob.startswith(_MAGIC):
            raise ValueError("not a model value: missing header (too short or truncated)")
        try:
            payload = json.loads(gzip.decompress(blob[4:]))
        except Exception as exc:  # truncated / corrupt
            raise ValueError(f"corrupt model value: {exc}") from exc
        meta = decode_meta(payload["meta"])
        if meta.format_version != FORMAT_VERSION:
            warnings.warn(f"model was written with format {meta.format_version}, this build reads "
                          f"{FORMAT_VERSION}; predictions may differ", stacklevel=2)
        return cls(meta, payload["nodes"], payload["tree_weight"], payload["tree_class"])


def _fix_row(r: tuple) -> tuple:
    ints = (0, 1, 2, 7, 8)
    out = list(r)
    for i in ints:
        v = out[i]
        out[i] = None if v is None or (isinstance(v, float) and v != v) else int(v)
    for i in (4, 9, 11):
        v = out[i]
        out[i] = None if v is None or (isinstance(v, float) and v != v) else float(v)
    out[6] = None if out[6] is None or (isinstance(out[6], float) and out[6] != out[6]) else bool(out[6])
    out[10] = float(out[10])
    out[12] = float(out[12])
    return tuple(out)


def _tree_starts(tree_ids: list[int], n_trees: int) -> list[int]:
    arr = np.asarray(tree_ids, dtype=np.int64)
    counts = np.bincount(arr, minlength=n_trees) if arr.size else np.zeros(n_trees, dtype=np.int64)
    return [0] + np.cumsum(counts).tolist()


def _json_default(v: Any) -> Any:
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (np.floating,)):
        return float(v)
    if isinstance(v, np.bool_):
        return bool(v)
    if isinstance(v, (_dt.date, _dt.datetime)):
        return v.isoformat()
    if isinstance(v, np.ndarray):
        return v.tolist()
    return str(v)


def now_utc() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
