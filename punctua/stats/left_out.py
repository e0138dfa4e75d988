"""L14. Refits without one batch each, all batches in the same passes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.session import scratch
from punctua.stats.logit import INTERCEPT, Model, _Cells, _chunks, _newton, _prepare, _sums

__all__ = ["leave_out_fits"]

BATCHES = 512  # batches refitted together; what the driver holds is this many times models x terms squared


@dataclass
class _LeftOut:
    """Sums over all rows minus the sums over a model's own batch: two passes a step, however many batches there are."""

    whole: _Cells
    own: DataFrame  # cells of the batches in hand, with the batch's number ``b``
    models: int

    @property
    def k(self) -> int:
        return self.whole.k

    def step(self, beta: np.ndarray, active: np.ndarray) -> np.ndarray:
        k, ny, nw, models = self.whole.k, self.whole.ny, self.whole.nw, self.models
        y_of, w_of = self.whole.y_of[:models], self.whole.w_of[:models]
        place = np.full(len(beta), -1)
        place[active] = np.arange(len(active))
        iu, ju = np.triu_indices(k)

        def per_batch(batches: Iterator[pa.RecordBatch]):
            total = np.zeros((len(active), k + len(iu) + 2))
            for x, y, w, part in _chunks(batches, k, ny, nw):
                b = part.column("b").to_numpy(zero_copy_only=False)
                for m in range(models):
                    j = b * models + m
                    p = 1.0 / (1.0 + np.exp(-np.clip((x * beta[j]).sum(1), -500, 500)))
                    ww, yy = w[:, w_of[m]], y[:, y_of[m]]
                    piece = np.hstack([(ww * (yy - p))[:, None] * x, (ww * p * (1 - p))[:, None] * (x[:, iu] * x[:, ju]), ww[:, None], (ww * yy)[:, None]])
                    used = place[j] >= 0
                    np.add.at(total, place[j][used], piece[used])
            return total

        return self.whole.step(beta, active) - _sums(self.own, per_batch, k + len(iu) + 2, len(active))


def leave_out_fits(df: DataFrame, terms: dict[str, Column], models: Sequence[Model], batch: str) -> DataFrame:
    """L14. (batch, model, term, odds_ratio, rows, late): every model refitted to convergence without each batch in turn.

    Rows collapse to cells once per batch and once over all batches. A Newton step takes the sums of all cells at every batch's own coefficients and
    subtracts those of the batch's own cells, which are read with the coefficients of their batch only. Batches are numbered by Spark and refitted ``BATCHES`` at
    a time; their names never reach the driver. ``odds_ratio`` is NULL where the rest cannot be fitted. Rows without a batch are left out by no refit.
    """
    spark, m = df.sparkSession, len(models)
    base, names = _prepare(df, terms, models, None, keep=[batch])
    cells = scratch(base.df.withColumnRenamed(batch, "_batch"), "left-out-cells")
    numbers = cells.select("_batch").where("_batch is not null").distinct().withColumn("b", F.row_number().over(Window.orderBy("_batch")) - 1)
    numbers = scratch(numbers, "left-out-batches")  # one row for each batch
    whole = scratch(cells.groupBy("x", "y", "w").agg(F.sum("n").alias("n")), "left-out-whole")
    own = scratch(cells.join(numbers, "_batch").drop("_batch"), "left-out-own")
    masks = [np.array([0, *[names.index(t) for t in model.terms]]) for model in models]
    main, _, _, fitted, _ = _newton(_Cells(whole, base.k, base.ny, base.nw, base.y_of, base.w_of), masks)
    count, out = numbers.count(), []
    for low in range(0, count, BATCHES):
        n = min(BATCHES, count - low)
        here = own.where(F.col("b").between(low, low + n - 1)).withColumn("b", F.col("b") - low)
        rest = _Cells(whole, base.k, base.ny, base.nw, np.tile(base.y_of, n), np.tile(base.w_of, n))
        start = np.where(fitted[:, None], main, 0.0)
        beta, _, _, converged, totals = _newton(_LeftOut(rest, here, m), masks * n, np.tile(start, (n, 1)))
        for j in range(n * m):
            model = models[j % m]
            out += [(low + j // m, model.name, t, float(np.exp(beta[j, names.index(t)])) if converged[j] else None, float(totals[j, 0]), float(totals[j, 1]))
                    for t in model.terms if t != INTERCEPT]
    found = spark.createDataFrame(out, "b INT, model STRING, term STRING, odds_ratio DOUBLE, rows DOUBLE, late DOUBLE")
    return found.join(numbers, "b").select(F.col("_batch").alias(batch), "model", "term", "odds_ratio", "rows", "late")
