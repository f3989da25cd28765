"""Many penalised logistic regressions on one table in shared passes.

Cross-validation over F folds and V parameter values has F·V fits of the same
rows. One pass over the rows takes the current weights of every fit that is
not done and returns its loss, gradient and Hessian, summed over the rows
outside its fold; the driver, which holds only these sums (44 numbers a fit for eight
features), makes a Newton step for each fit. All fits advance together, so the
number of passes is that of the slowest fit, some ten, not the sum over fits.

Objective: Σ log-loss + ‖w‖²/(2C), or + ‖w‖₁/C, the intercept not penalised.
L1 steps minimise the same quadratic model plus the penalty by coordinate
descent (proximal Newton). Steps are halved until the objective falls.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

X, Y, FOLD = "_x", "_y", "_fold"
# Rows whose margins for all fits are held at once by a task.
CHUNK = 4096
# Above so many features the Hessians of all fits are too large a sum to share.
MAX_SHARED_FEATURES = 64
STEP_TOL = 1e-10     # a fit is done when its Newton step is this small
MAX_HALVINGS = 40


@dataclass
class Fit:
    """One regression: leave out ``fold`` (None: no row), strength ``1/c``, at most ``max_iter`` Newton steps."""

    c: float
    fold: int | None = None
    penalty: str = "l2"
    max_iter: int = 100
    weights: np.ndarray = field(default=None, repr=False)     # the features', then the intercept
    steps: int = 0
    at_step: dict[int, np.ndarray] = field(default_factory=dict, repr=False)
    done: bool = False
    _state: tuple | None = field(default=None, repr=False)   # objective, gradient, Hessian at ``weights``
    _try: tuple | None = field(default=None, repr=False)     # direction, step length, expected fall

    def penalty_of(self, w: np.ndarray) -> float:
        v = w[:-1]
        return float(np.abs(v).sum() / self.c if self.penalty == "l1" else v @ v / (2 * self.c))

    def direction(self) -> tuple[np.ndarray, float]:
        """The Newton direction from the last accepted weights, and how much the model says the objective falls."""
        _, grad, hess = self._state
        w, ridge = self.weights, 1e-12 * max(1.0, float(np.trace(hess)))
        hess = hess + ridge * np.eye(len(w))
        if self.penalty == "l2":
            grad = grad + np.append(w[:-1] / self.c, 0.0)
            hess = hess + np.diag(np.append(np.full(len(w) - 1, 1 / self.c), 0.0))
            d = -np.linalg.solve(hess, grad)
            return d, float(grad @ d)
        d, hd, lam = np.zeros(len(w)), np.zeros(len(w)), 1 / self.c
        for _ in range(1000):
            moved = 0.0
            for j in range(len(w)):
                a, b, now = hess[j, j], grad[j] + hd[j], w[j] + d[j]
                if j == len(w) - 1:
                    z = -b / a
                else:
                    u = now - b / a
                    z = np.sign(u) * max(abs(u) - lam / a, 0.0) - now
                if z:
                    d[j] += z
                    hd += hess[:, j] * z
                    moved = max(moved, abs(z))
            if moved < 1e-13:
                break
        return d, float(grad @ d) + self.penalty_of(w + d) - self.penalty_of(w)

    def candidate(self) -> np.ndarray:
        return self.weights if self._try is None else self.weights + self._try[1] * self._try[0]

    def take(self, loss: float, grad: np.ndarray, hess: np.ndarray) -> None:
        """Sums at ``candidate``: accept it and look on, or halve the step."""
        w = self.candidate()
        value = loss + self.penalty_of(w)
        if self._try is not None:
            d, t, fall = self._try
            before = self._state[0]
            if value > before + 1e-4 * t * fall + 1e-12 * abs(before):
                if t < 0.5 ** MAX_HALVINGS:
                    self.done = True
                else:
                    self._try = d, t / 2, fall
                return
            self.steps += 1
        self.weights, self._state, self._try = w, (value, grad, hess), None
        self.at_step[self.steps] = w
        d, fall = self.direction()
        if np.abs(d).max() <= STEP_TOL * (1 + np.abs(w).max()) or self.steps >= self.max_iter:
            self.done = True
        else:
            self._try = d, 1.0, fall

    def weights_after(self, max_iter: int) -> np.ndarray:
        """The weights that a fit stopped after ``max_iter`` steps has."""
        return self.at_step[min(max_iter, self.steps)]


def _batches(batches: Iterator[pa.RecordBatch], d: int):
    """(rows × (d + 1) with a column of ones, labels, folds), a chunk of rows at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x = batch.column(X).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        x = np.hstack([x, np.ones((len(x), 1))])
        y = batch.column(Y).to_numpy(zero_copy_only=False)
        fold = batch.column(FOLD).to_numpy(zero_copy_only=False)
        for i in range(0, len(x), CHUNK):
            yield x[i:i + CHUNK], y[i:i + CHUNK], fold[i:i + CHUNK]


def _summed(rows: DataFrame, one, n_fits: int, width: int) -> np.ndarray:
    """n_fits × width: per fit the sum over all rows of what ``one`` makes of a chunk; partial sums are added by Spark."""
    def run(batches):
        total = np.zeros((n_fits, width))
        for chunk in one(batches):
            total += chunk
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["at", "v"])

    found = rows.mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()   # n_fits × width rows at most
    out = np.zeros(n_fits * width)
    out[found["at"].to_numpy()] = found["v"].to_numpy()
    return out.reshape(n_fits, width)


def newton_fits(rows: DataFrame, fits: Sequence[Fit], d: int) -> int:
    """Run all ``fits`` to their end on ``rows`` (_x array<double> of ``d``, _y, _fold); returns the number of passes.

    ``rows`` is read once a pass and should be cached or written. A fit whose
    rows are of one class has no finite intercept; it stops at ``max_iter`` steps.
    """
    for f in fits:
        f.weights = np.zeros(d + 1)
    up = np.triu_indices(d + 1)
    passes = 0
    while active := [f for f in fits if not f.done]:
        w = np.array([f.candidate() for f in active])
        out_of = np.array([-1 if f.fold is None else f.fold for f in active])

        def one(batches, w=w, out_of=out_of):
            for x, y, fold in _batches(batches, d):
                z = x @ w.T
                inside = fold[:, None] != out_of
                e = np.exp(-np.abs(z))
                p = np.where(z >= 0, 1.0, e) / (1.0 + e)
                loss = ((np.maximum(z, 0) + np.log1p(e) - y[:, None] * z) * inside).sum(0)
                grad = ((p - y[:, None]) * inside).T @ x
                hess = (e / (1.0 + e) ** 2 * inside).T @ (x[:, up[0]] * x[:, up[1]])
                yield np.hstack([loss[:, None], grad, hess])

        sums = _summed(rows, one, len(active), 1 + (d + 1) + len(up[0]))
        passes += 1
        for f, s in zip(active, sums):
            hess = np.zeros((d + 1, d + 1))
            hess[up] = s[d + 2:]
            f.take(float(s[0]), s[1:d + 2], hess + np.triu(hess, 1).T)
    return passes


def held_out_hits(rows: DataFrame, weights: Sequence[np.ndarray], folds: Sequence[int], d: int) -> np.ndarray:
    """Per weight vector (rows of its own fold, and how many of these it classifies rightly), in one pass."""
    w, own = np.array(weights), np.array(folds)

    def one(batches):
        for x, y, fold in _batches(batches, d):
            inside = fold[:, None] == own
            yield np.column_stack([inside.sum(0), (((x @ w.T > 0) == (y[:, None] > 0.5)) & inside).sum(0)]).astype(float)

    return _summed(rows, one, len(w), 2)


def residuals(rows: DataFrame, fits: Sequence[Fit], d: int) -> np.ndarray:
    """How far each fit is from its optimum: the largest (sub)gradient entry at its weights over its number of rows."""
    w = np.array([f.weights for f in fits])
    out_of = np.array([-1 if f.fold is None else f.fold for f in fits])

    def one(batches):
        for x, y, fold in _batches(batches, d):
            inside = fold[:, None] != out_of
            z = x @ w.T
            e = np.exp(-np.abs(z))
            p = np.where(z >= 0, 1.0, e) / (1.0 + e)
            yield np.hstack([inside.sum(0)[:, None].astype(float), ((p - y[:, None]) * inside).T @ x])

    sums = _summed(rows, one, len(fits), d + 2)
    out = []
    for f, s in zip(fits, sums):
        g, v = s[1:], f.weights[:-1]
        if f.penalty == "l2":
            bad = np.append(g[:-1] + v / f.c, g[-1])
        else:
            slack = np.where(v != 0, np.abs(g[:-1] + np.sign(v) / f.c), np.maximum(np.abs(g[:-1]) - 1 / f.c, 0))
            bad = np.append(slack, g[-1])
        out.append((s[0], np.abs(bad).max() / max(s[0], 1.0)))
    return np.array(out).reshape(-1, 2)
