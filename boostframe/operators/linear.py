"""``booster='gblinear'``: cyclic coordinate descent on a linear margin.

A round needs, for every (model, group), the weighted Gram matrix of the features and a constant and
the gradient along them; one pass over the rows sums both, (features + 1)² numbers. On these the driver
takes the bias step and then one step per feature, each seeing the effect of those before it, so equal
or correlated columns share the work instead of overshooting together. Under squared error the Gram
matrix never changes and the gradient follows from it, so a single pass serves all rounds. Missing
values contribute nothing. Penalties are scaled by the number of training rows (of the fold's model).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import kernel as K
from ..plans.binning import DataStats
from ..plans.train import gradient_options


def raw_column_names(n: int) -> list[str]:
    return [f"__x{j}" for j in range(n)]


def _arrays(batch: pa.RecordBatch, n_feat: int, n_margin: int, has_fold: bool):
    names = batch.schema.names
    X = np.column_stack([batch.column(names.index(c)).to_numpy(zero_copy_only=False)
                         for c in raw_column_names(n_feat)]).astype(np.float64)
    M = np.column_stack([batch.column(names.index(f"__m{j}")).to_numpy(zero_copy_only=False)
                         for j in range(n_margin)]).astype(np.float64)
    y = batch.column(names.index("__y")).to_numpy(zero_copy_only=False)
    fold = batch.column(names.index("__fold")).to_numpy(zero_copy_only=False) if has_fold else None
    return X, M, y, fold


def _coord_delta(G, H, w, alpha, lam):
    if H < 1e-5:
        return 0.0
    g2 = G + lam * w
    h2 = H + lam
    if w - g2 / h2 >= 0:
        return max(-(g2 + alpha) / h2, -w)
    return min(-(g2 - alpha) / h2, -w)


def train_linear(state: DataFrame, stats: DataStats, specs: list, has_fold: bool):
    if any(f.categorical for f in stats.features):
        raise ValueError("booster 'gblinear' supports numeric features only; drop or encode string columns")
    n_feat = len(stats.features)
    n_margin = sum(s.n_groups for s in specs)
    col0 = np.concatenate([[0], np.cumsum([s.n_groups for s in specs])[:-1]]).astype(int)
    W = [np.zeros((n_feat, s.n_groups)) for s in specs]
    Bias = [np.zeros(s.n_groups) for s in specs]
    models_ctx = [(s.objective, s.n_groups, int(col0[i]), gradient_options(s.params), s.test_fold)
                  for i, s in enumerate(specs)]
    width = n_feat + 1

    def sums(state: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Gram matrices and gradients of all margin columns; the constant is feature 0."""
        def kernel(batches):
            gram, grad = np.zeros((n_margin, width, width)), np.zeros((n_margin, width))
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                X, M, y, fold = _arrays(batch, n_feat, n_margin, has_fold)
                X = np.concatenate([np.ones((len(X), 1)), np.nan_to_num(X, nan=0.0)], 1)
                for obj, kk, c0, options, tf in models_ctx:
                    g, h = K.gradients(obj, M[:, c0:c0 + kk], y, *options)
                    rows = slice(None) if tf < 0 else fold != tf
                    for k in range(kk):
                        gram[c0 + k] += (X[rows] * h[rows, k:k + 1]).T @ X[rows]
                        grad[c0 + k] += g[rows, k] @ X[rows]
            cells = np.concatenate([gram.reshape(n_margin, -1), grad], 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(n_margin, dtype=np.int64), cells.shape[1])),
                                              pa.array(np.tile(np.arange(cells.shape[1], dtype=np.int64), n_margin)),
                                              pa.array(cells.ravel())], names=["c", "cell", "v"])

        got = (state.mapInArrow(kernel, "c long, cell long, v double").groupBy("c", "cell").agg(F.sum("v").alias("v"))).toArrow()
        cells = np.zeros((n_margin, width * width + width))
        cells[got.column("c").to_numpy(), got.column("cell").to_numpy()] = got.column("v").to_numpy()
        return cells[:, :width * width].reshape(n_margin, width, width), cells[:, width * width:]

    def moved(state: DataFrame, dW: np.ndarray, dB: np.ndarray) -> DataFrame:
        def kernel(batches):
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                X, M, _, _ = _arrays(batch, n_feat, n_margin, has_fold)
                M = M + dB[None, :] + np.nan_to_num(X, nan=0.0) @ dW
                cols, names = list(batch.columns), batch.schema.names
                for j in range(n_margin):
                    cols[names.index(f"__m{j}")] = pa.array(M[:, j], pa.float64())
                yield pa.RecordBatch.from_arrays(cols, names=names)
        return state.mapInArrow(kernel, state.schema)

    constant = all(s.objective == "reg:squarederror" for s in specs)
    gram = grad = None
    dW, dB = np.zeros((n_feat, n_margin)), np.zeros(n_margin)
    state0 = state
    for rnd in range(max(s.rounds for s in specs)):
        if gram is None or not constant:
            gram, grad = sums(moved(state0, dW, dB) if rnd else state0)       # margins follow from the weights alone
        for mi, s in enumerate(specs):
            if rnd >= s.rounds:
                continue
            eta, n_train = s.params["learning_rate"], float(s.n_train or stats.n_rows)
            lam, alpha = s.params["reg_lambda"] * n_train, s.params["reg_alpha"] * n_train
            for k in range(s.n_groups):
                c = col0[mi] + k
                A, b = gram[c], grad[c]
                step = eta * (-b[0] / A[0, 0]) if A[0, 0] > 0 else 0.0
                Bias[mi][k] += step
                dB[c] += step
                b += step * A[:, 0]
                for j in range(n_feat):
                    step = eta * _coord_delta(b[j + 1], A[j + 1, j + 1], W[mi][j, k], alpha, lam)
                    W[mi][j, k] += step
                    dW[j, c] += step
                    b += step * A[:, j + 1]
    state = moved(state0, dW, dB)

    def cleanup() -> None:
        """Nothing is held beyond the state that came in."""

    results = [([list(map(float, W[mi][j])) for j in range(n_feat)], list(map(float, Bias[mi])))
               for mi in range(len(specs))]
    return results, state, cleanup
