"""Logistic regression by maximum likelihood, with cluster-robust errors, on Spark.

Rows never leave the executors. They are first collapsed to distinct (inputs, outcomes, cluster)
cells with counts. Each Newton step is then one pass over the cells for *all* models that still
move: a task turns an Arrow batch into two matrix products and returns sums, and the driver solves
one small system per model. What reaches the driver is bounded by models x terms squared.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.stats.intervals import Z95

__all__ = [
    "Fit", "FitFailed", "Model", "average_marginal_effect", "factor", "fit_logit", "fit_logits",
    "marginal_effects", "number", "odds_ratios", "vif",
]

INTERCEPT = "Intercept"
MAX_STEPS, TOLERANCE = 35, 1e-8
_CHUNK = 2048
_CHUNK_CELLS = 1 << 21  # rows x models handled at once
_WORK_PER_TASK = 200_000  # cells x models


class FitFailed(RuntimeError):
    """The model has missing inputs, cannot be solved, or does not converge."""


def number(name: str, column: Column | str | None = None) -> dict[str, Column]:
    """L3. A numeric or 0/1 input under its own name."""
    c = F.col(name) if column is None else F.col(column) if isinstance(column, str) else column
    return {name: c.cast("double")}


def factor(col: str, levels: Sequence, base) -> dict[str, Column]:
    """L3. One indicator per level except the base. The levels are given, so term names never move; a value that is none of them fails the fit."""
    unlisted = F.raise_error(F.concat(F.lit(f"{col}: not a listed level: "), F.col(col).cast("string"))).cast("double")
    return {f"{col}[{v}]": F.when(F.col(col).isin(*levels), (F.col(col) == F.lit(v)).cast("double")).when(F.col(col).isNotNull(), unlisted)
            for v in levels if v != base}


@dataclass(frozen=True)
class Model:
    """One model: which terms (of the shared design), which outcome, which rows, which clusters."""

    name: str
    terms: tuple[str, ...]
    outcome: Column
    rows: Column | None = None
    cluster: str | None = None


@dataclass
class Fit:
    """A fitted model. ``cov`` is cluster-robust when the model names a cluster."""

    name: str
    terms: tuple[str, ...]
    params: np.ndarray
    cov: np.ndarray
    n: float
    hits: float
    steps: int
    converged: bool
    clusters: int = 0
    extra: dict = field(default_factory=dict)

    def at(self, term: str) -> float:
        return float(self.params[self.terms.index(term)])


# ---- passes over the cells -----------------------------------------------------

def _matrix(batch: pa.RecordBatch, col: str, width: int) -> np.ndarray:
    return batch.column(col).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def _chunks(batches: Iterator[pa.RecordBatch], k: int, ny: int, nw: int, draw: Callable[[pa.RecordBatch], np.ndarray] | None = None, models: int = 1):
    """(X, Y, W, batch slice) in pieces small enough that rows x models stays in memory. ``draw`` makes the weights of a slice instead of column w."""
    rows = max(1, min(_CHUNK, _CHUNK_CELLS // models))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            n = part.column("n").to_numpy(zero_copy_only=False).astype(float)[:, None]
            yield _matrix(part, "x", k), _matrix(part, "y", ny), (draw(part) if draw else _matrix(part, "w", nw)) * n, part


def _sums(cells: DataFrame, per_batch, width: int, models: int) -> np.ndarray:
    """Add up a (models x width) matrix over all cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = per_batch(batches)
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(models), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["m", "s"])

    parts = cells.mapInArrow(run, "m INT, s ARRAY<DOUBLE>")
    rows = (parts.select("m", F.posexplode("s").alias("i", "v")).groupBy("m", "i").agg(F.sum("v").alias("v")).collect())
    out = np.zeros((models, width))
    for r in rows:
        out[r["m"], r["i"]] = r["v"]
    return out


def _probability(x: np.ndarray, beta: np.ndarray) -> np.ndarray:
    eta = np.clip(x @ beta.T, -500, 500)
    return 1.0 / (1.0 + np.exp(-eta))


@dataclass
class _Cells:
    df: DataFrame
    k: int
    ny: int
    nw: int
    y_of: np.ndarray  # model -> outcome
    w_of: np.ndarray  # model -> weight
    draw: Callable[[pa.RecordBatch], np.ndarray] | None = None

    def step(self, beta: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Gradient, upper Hessian, weight and hits per active model."""
        k, ny, nw, draw = self.k, self.ny, self.nw, self.draw
        y_of, w_of, b = self.y_of[active], self.w_of[active], beta[active]
        iu, ju = np.triu_indices(k)
        width = k + len(iu) + 2

        def per_batch(batches):
            total = None
            for x, y, w, _ in _chunks(batches, k, ny, nw, draw, len(b)):
                yy, ww = y[:, y_of], w[:, w_of]
                p = _probability(x, b)
                grad = (ww * (yy - p)).T @ x
                hess = (ww * p * (1 - p)).T @ (x[:, iu] * x[:, ju])
                piece = np.hstack([grad, hess, ww.sum(0)[:, None], (ww * yy).sum(0)[:, None]])
                total = piece if total is None else total + piece
            return total

        return _sums(self.df, per_batch, width, len(active))

    def meat(self, beta: np.ndarray, models: np.ndarray, cluster: str) -> tuple[np.ndarray, np.ndarray]:
        """Sum of outer products of per-cluster scores, and the number of clusters, per model."""
        k, ny, nw = self.k, self.ny, self.nw
        y_of, w_of, b = self.y_of[models], self.w_of[models], beta[models]
        iu, ju = np.triu_indices(k)

        def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x, y, w, part in _chunks(batches, k, ny, nw):
                ww = w[:, w_of]
                resid = ww * (y[:, y_of] - _probability(x, b))
                encoded = part.column(cluster).dictionary_encode()
                codes, names = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary
                for m in range(len(models)):
                    s = np.zeros((len(names), k))
                    np.add.at(s, codes, resid[:, m:m + 1] * x)
                    used = np.zeros(len(names))
                    np.add.at(used, codes, ww[:, m])
                    keep = np.flatnonzero(used > 0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keep), m), pa.int32()), names.take(pa.array(keep)).cast(pa.string()),
                         pa.array(list(s[keep]), pa.list_(pa.float64()))], ["m", "c", "s"])

        per_cluster = (
            self.df.mapInArrow(scores, "m INT, c STRING, s ARRAY<DOUBLE>").groupBy("m", "c")
            .agg(*[F.sum(F.get("s", F.lit(i))).alias(f"s{i}") for i in range(k)])
            .select("m", F.array(*[f"s{i}" for i in range(k)]).alias("s")))
        n_models = len(models)

        def outer(batches: Iterator[pa.RecordBatch]):
            total = None
            for batch in batches:
                s = _matrix(batch, "s", k)
                m = batch.column("m").to_numpy(zero_copy_only=False)
                piece = np.zeros((n_models, len(iu) + 1))
                np.add.at(piece, m, np.hstack([s[:, iu] * s[:, ju], np.ones((len(s), 1))]))
                total = piece if total is None else total + piece
            return total

        flat = _sums(per_cluster, outer, len(iu) + 1, n_models)
        return np.stack([_square(r[:-1], k) for r in flat]), flat[:, -1]


def _square(upper: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros((k, k))
    out[np.triu_indices(k)] = upper
    return out + np.triu(out, 1).T


def _prepare(df: DataFrame, terms: dict[str, Column], models: Sequence[Model], weights: str | None,
             keep: Sequence[str] = (), n_weights: int = 0) -> tuple[_Cells, list[str]]:
    """Collapse rows to counted cells. Refuses missing inputs in any row a model uses."""
    names = [INTERCEPT, *terms]
    outcomes: dict[str, Column] = {}
    for m in models:
        outcomes.setdefault(str(m.outcome), m.outcome)
    y_names = list(outcomes)
    inclusion: dict[str, Column] = {}
    for m in models:
        inclusion.setdefault(str(m.rows), F.lit(True) if m.rows is None else F.coalesce(m.rows, F.lit(False)))
    w_names = list(inclusion)
    clusters = list(dict.fromkeys([*keep, *[m.cluster for m in models if m.cluster]]))

    rows = df.select(
        *[F.col(c).cast("string").alias(c) for c in clusters], *([weights] if weights else []),
        *[terms[t].alias(f"_x{i}") for i, t in enumerate(terms)],
        *[outcomes[y].cast("double").alias(f"_y{i}") for i, y in enumerate(y_names)],
        *[inclusion[w].alias(f"_w{i}") for i, w in enumerate(w_names)])
    missing = []
    for m in models:
        needed = [F.col(f"_x{list(terms).index(t)}") for t in m.terms if t != INTERCEPT]
        gap = F.col(f"_y{y_names.index(str(m.outcome))}").isNull()
        for c in needed:
            gap = gap | c.isNull()
        missing.append(F.count_if(gap & F.col(f"_w{w_names.index(str(m.rows))}")))
    x = F.array(F.lit(1.0), *[F.coalesce(F.col(f"_x{i}"), F.lit(0.0)) for i in range(len(terms))])
    y = F.array(*[F.coalesce(F.col(f"_y{i}"), F.lit(0.0)) for i in range(len(y_names))])
    w = F.array(*[F.col(f"_w{i}").cast("double") for i in range(len(w_names))])
    found = rows.agg(*[c.alias(f"m{i}") for i, c in enumerate(missing)]).first()
    bad = [m.name for i, m in enumerate(models) if found[i]]
    if bad:
        raise FitFailed(f"missing inputs in: {', '.join(bad)}")

    used = rows.where(F.array_max(w) > 0)
    cells = used.groupBy(x.alias("x"), y.alias("y"), w.alias("w"), *clusters).agg(F.count(F.lit(1)).alias("n"))
    k = len(names)
    return _Cells(cells, k, len(y_names), len(w_names),
                  np.array([y_names.index(str(m.outcome)) for m in models]),
                  np.array([w_names.index(str(m.rows)) for m in models])), names


def _kept(df: DataFrame, models: int) -> tuple[DataFrame, DataFrame]:
    """(persisted cells, the same cells in tasks worth starting): the passes read them many times."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    tasks = math.ceil(kept.count() * models / _WORK_PER_TASK)
    return kept, kept.coalesce(max(1, tasks))


def _newton(cells, masks: list[np.ndarray], start: np.ndarray | None = None) -> tuple[np.ndarray, list, np.ndarray, np.ndarray, np.ndarray]:
    """Newton steps for all models together. Returns betas, inverse Hessians, steps, converged, (n, hits)."""
    j, k = len(masks), cells.k
    beta, steps = np.zeros((j, k)) if start is None else start.copy(), np.zeros(j, int)
    converged, failed = np.zeros(j, bool), np.zeros(j, bool)
    inverse: list = [None] * j
    totals = np.zeros((j, 2))
    for _ in range(MAX_STEPS + 1):
        active = np.flatnonzero(~converged & ~failed)
        if not len(active):
            break
        stats = cells.step(beta, active)
        for row, m in zip(stats, active):
            mask = masks[m]
            hess = _square(row[k:-2], k)[np.ix_(mask, mask)]
            totals[m] = row[-2:]
            try:
                inverse[m] = np.linalg.inv(hess)
                move = inverse[m] @ row[:k][mask]
            except np.linalg.LinAlgError:
                failed[m] = True
                continue
            if not np.all(np.isfinite(move)) or np.linalg.cond(hess) > 1e15:
                failed[m] = True
                continue
            beta[m, mask] += move
            steps[m] += 1
            converged[m] = np.max(np.abs(move)) <= TOLERANCE
    return beta, inverse, steps, converged & ~failed, totals


def fit_logits(df: DataFrame, terms: dict[str, Column], models: Sequence[Model], strict: bool = True) -> list[Fit]:
    """L5, L6, L13. Fit all models in shared passes; clustered covariance where a model names a cluster.

    ``terms`` is the union of the inputs of all models. With ``strict`` a model that cannot be fitted
    stops the run; otherwise it comes back with ``converged`` false.
    """
    cells, names = _prepare(df, terms, models, None)
    kept, cells.df = _kept(cells.df, len(models))
    try:
        masks = [np.array([0, *[names.index(t) for t in m.terms]]) for m in models]
        beta, inverse, steps, converged, totals = _newton(cells, masks)
        if strict and not converged.all():
            raise FitFailed("no fit for: " + ", ".join(m.name for m, ok in zip(models, converged) if not ok))
        fits = [Fit(m.name, (INTERCEPT, *m.terms), beta[i, masks[i]], inverse[i], float(totals[i, 0]),
                    float(totals[i, 1]), int(steps[i]), bool(converged[i])) for i, m in enumerate(models)]
        for cluster in dict.fromkeys(m.cluster for m in models if m.cluster):
            chosen = np.array([i for i, m in enumerate(models) if m.cluster == cluster and converged[i]])
            if not len(chosen):
                continue
            meat, groups = cells.meat(beta, chosen, cluster)
            for i, b, g in zip(chosen, meat, groups):
                f, mask = fits[i], masks[i]
                size = (g / (g - 1)) * ((f.n - 1) / (f.n - len(mask)))
                f.cov = size * f.cov @ b[np.ix_(mask, mask)] @ f.cov
                f.clusters = int(g)
        return fits
    finally:
        kept.unpersist()


def fit_logit(df: DataFrame, terms: dict[str, Column], outcome: Column | str, cluster: str | None = None) -> Fit:
    """L5, L6. One model over all rows."""
    y = F.col(outcome) if isinstance(outcome, str) else outcome
    return fit_logits(df, terms, [Model("model", tuple(terms), y, None, cluster)])[0]


def odds_ratios(fit: Fit, terms: Sequence[str] | None = None) -> list[dict]:
    """L7. Odds ratio, 95% interval and p-value per term."""
    out = []
    for t in terms or [t for t in fit.terms if t != INTERCEPT]:
        i = fit.terms.index(t)
        b, se = float(fit.params[i]), math.sqrt(fit.cov[i, i])
        out.append({"term": t, "odds_ratio": math.exp(b), "ci_low": math.exp(b - Z95 * se),
                    "ci_high": math.exp(b + Z95 * se), "p_value": math.erfc(abs(b / se) / math.sqrt(2))})
    return out


def marginal_effects(df: DataFrame, terms: dict[str, Column], asked: Sequence[tuple[Fit, str, Sequence[str]]],
                     rows: Sequence[Column | None] | None = None) -> list[dict]:
    """L8. Average marginal effects of many models in one pass: (fit, 0/1 input, other inputs held at 0) each.

    The effect is the mean change in probability when the input goes from 0 to 1 over the rows of the model, with a delta-method interval.
    For a level of a factor the other levels are held at 0, so the comparison is with the base. Tasks add up one probability change
    and one gradient per model; the driver gets models x terms sums.
    """
    rows = rows or [None] * len(asked)
    models = [Model(f"{f.name} {dummy}", tuple(t for t in f.terms if t != INTERCEPT), F.lit(0.0), r) for (f, dummy, _), r in zip(asked, rows)]
    used = {t: terms[t] for m in models for t in m.terms}
    cells, names = _prepare(df, used, models, None)
    k, j, nw, w_of = cells.k, len(models), cells.nw, cells.w_of
    beta, switch, held = np.zeros((j, k)), np.zeros((j, k), bool), np.zeros((j, k), bool)
    for m, (fit, dummy, others) in enumerate(asked):
        beta[m, [names.index(t) for t in fit.terms]] = fit.params
        switch[m, names.index(dummy)] = True
        held[m, [names.index(t) for t in (dummy, *others)]] = True
    # Off: the held inputs are 0, whatever the row says. On: the switched one is 1 on top of that.
    rest, jump = np.where(held, 0.0, beta), beta[switch]

    def per_batch(batches):
        total = None
        for x, _, w, _ in _chunks(batches, k, 1, nw, models=j):
            ww = w[:, w_of]
            eta = x @ rest.T
            p0 = 1.0 / (1.0 + np.exp(-np.clip(eta, -500, 500)))
            p1 = 1.0 / (1.0 + np.exp(-np.clip(eta + jump, -500, 500)))
            s1, s0 = ww * p1 * (1 - p1), ww * p0 * (1 - p0)
            slope = np.where(held, 0.0, (s1 - s0).T @ x) + np.where(switch, s1.sum(0)[:, None], 0.0)
            piece = np.hstack([slope, (ww * (p1 - p0)).sum(0)[:, None], ww.sum(0)[:, None]])
            total = piece if total is None else total + piece
        return total

    out = []
    for (fit, dummy, _), sums in zip(asked, _sums(cells.df, per_batch, k + 2, j)):
        gradient, effect = sums[[names.index(t) for t in fit.terms]] / sums[-1], float(sums[k] / sums[-1])
        se = math.sqrt(float(gradient @ fit.cov @ gradient))
        out.append({"term": dummy, "effect": effect, "se": se, "ci_low": effect - Z95 * se, "ci_high": effect + Z95 * se})
    return out


def average_marginal_effect(df: DataFrame, terms: dict[str, Column], fit: Fit, dummy: str,
                            rows: Column | None = None) -> dict:
    """L8. The average marginal effect of one input of one model."""
    return marginal_effects(df, terms, [(fit, dummy, ())], [rows])[0]


def vif(df: DataFrame, terms: dict[str, Column]) -> dict[str, float]:
    """L4. Variance inflation per input: the diagonal of the inverse correlation matrix, from one Gram matrix."""
    model = Model("vif", tuple(terms), F.lit(0.0))
    cells, names = _prepare(df, terms, [model], None)
    k = cells.k
    iu, ju = np.triu_indices(k)

    def per_batch(batches):
        total = None
        for x, _, w, _ in _chunks(batches, k, 1, 1):
            piece = w.T @ (x[:, iu] * x[:, ju])
            total = piece if total is None else total + piece
        return total

    gram = _square(_sums(cells.df, per_batch, len(iu), 1)[0], k)
    n = gram[0, 0]
    cov = gram[1:, 1:] / n - np.outer(gram[0, 1:], gram[0, 1:]) / n**2
    scale = np.sqrt(np.diag(cov))
    inverse = np.linalg.inv(cov / np.outer(scale, scale))
    return dict(zip(names[1:], np.diag(inverse).tolist()))
