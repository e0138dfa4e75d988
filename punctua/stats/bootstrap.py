"""Stratified cluster bootstrap: every repetition redraws each stratum's batches, and all are refitted together.

Draws are a function of (seed, repetition, stratum, draw) alone, so any task can work out the weight of any batch in any
repetition: cells carry two small numbers, and no table of weights is built, joined or shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.stats.logit import Model, _Cells, _kept, _newton, _prepare

__all__ = ["batch_draws", "cluster_bootstrap", "draw_interval", "draws_frame", "number_batches"]

#: Shifts and factors of a 32-bit mixing function; products stay below 2^63, so SQL integers can do it too
MIX = ((16, 0x21F0AAAD), (15, 0x735A2D97))
LAST_SHIFT, MASK = 15, 0xFFFFFFFF
_REPS_AT_ONCE = 64


def mixed(x):
    """The mixing function over numbers, arrays or columns below 2^32."""
    column = isinstance(x, Column)
    for shift, factor in MIX:
        x = (x.bitwiseXOR(F.shiftright(x, shift)) * F.lit(factor)).bitwiseAND(F.lit(MASK)) if column else ((x ^ (x >> shift)) * factor) & MASK
    return x.bitwiseXOR(F.shiftright(x, LAST_SHIFT)) if column else x ^ (x >> LAST_SHIFT)


def number_batches(df: DataFrame, stratum: str, batch: str) -> DataFrame:
    """(stratum, batch, _s, _i, _size): strata by rank, batches by rank in their stratum. One row for each batch."""
    batches = df.select(F.col(stratum).cast("string").alias("_stratum"), F.col(batch).cast("string").alias("_batch")).where("_batch is not null").distinct()
    strata = batches.select(F.col("_stratum").alias("_name")).distinct().withColumn("_s", (F.row_number().over(Window.orderBy("_name")) - 1).cast("long"))
    named = batches.join(strata, F.col("_stratum").eqNullSafe(F.col("_name"))).drop("_name")
    mine = Window.partitionBy("_s")
    return named.withColumns({"_i": F.row_number().over(mine.orderBy("_batch")) - 1, "_size": F.count(F.lit(1)).over(mine)})


def batch_draws(df: DataFrame, stratum: str, batch: str, reps: int, seed: int) -> DataFrame:
    """L10. (stratum, batch, rep, n): how often each repetition drew the batch, without the zeros.

    Each stratum draws as many batches as it has, with replacement. This is the table that
    :func:`cluster_bootstrap` never builds: its tasks work the same numbers out as they need them.
    """
    numbered = number_batches(df, stratum, batch)
    pick = mixed(mixed(mixed(F.col("rep").bitwiseXOR(F.lit(mixed(seed)))).bitwiseXOR(F.col("_s"))).bitwiseXOR(F.col("_i").cast("long"))) % F.col("_size")
    drawn = (numbered.withColumn("rep", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(reps - 1).cast("long"))))
             .select("_s", "rep", pick.alias("_i")).groupBy("_s", "_i", "rep").agg(F.count(F.lit(1)).alias("n")))
    return drawn.join(numbered, ["_s", "_i"]).select(F.col("_stratum").alias(stratum), F.col("_batch").alias(batch), F.col("rep").cast("int").alias("rep"), "n")


def _drawer(sizes: list[int], reps: int, seed: int) -> Callable[[pa.RecordBatch], np.ndarray]:
    """A function from cells with ``_s`` and ``_i`` to their weights in every repetition."""
    first = mixed(seed)

    def weights(s: int, wanted: np.ndarray) -> np.ndarray:
        size, out = sizes[s], np.empty((reps, len(wanted)))
        draws = np.arange(size, dtype=np.int64)
        for low in range(0, reps, _REPS_AT_ONCE):
            rep = np.arange(low, min(low + _REPS_AT_ONCE, reps), dtype=np.int64)
            picks = mixed(mixed(mixed(rep ^ first) ^ s)[:, None] ^ draws) % size
            counts = np.bincount((picks + (np.arange(len(rep)) * size)[:, None]).ravel(), minlength=len(rep) * size)
            out[low:low + len(rep)] = counts.reshape(len(rep), size)[:, wanted]
        return out

    def draw(part: pa.RecordBatch) -> np.ndarray:
        s, i = part.column("_s").to_numpy(zero_copy_only=False), part.column("_i").to_numpy(zero_copy_only=False)
        out = np.empty((len(s), reps))
        for one in np.unique(s):
            rows = np.flatnonzero(s == one)
            wanted, where = np.unique(i[rows], return_inverse=True)
            out[rows] = weights(int(one), wanted).T[where]
        return out

    return draw


def cluster_bootstrap(df: DataFrame, terms: dict[str, Column], outcome: Column, specs: dict[str, Sequence[str]],
                      stratum: str, batch: str, reps: int = 999, seed: int = 2026) -> dict:
    """L10. Coefficients of every spec in every repetition.

    A repetition counts as failed, for all specs, if any of them cannot be fitted on its draw. Returns
    ``draws`` (one dict per spec and kept repetition), ``failed``, and ``reliable`` (under 5% failed). A batch belongs to one stratum.
    """
    models = [Model(name, tuple(t), outcome) for name, t in specs.items()]
    base, names = _prepare(df, terms, models, None, keep=[batch])
    numbered = number_batches(df, stratum, batch).withColumnRenamed("_batch", batch).select(batch, "_s", "_i", "_size")
    sizes = [r["_size"] for r in numbered.groupBy("_s").agg(F.max("_size").alias("_size")).orderBy("_s").collect()]  # one number for each stratum
    m = len(models)
    kept, cells = _kept(base.df.drop("w").join(numbered.drop("_size"), batch).sort("_s", "_i"), m * reps)
    try:
        drawn = _Cells(cells, base.k, base.ny, reps, np.repeat(base.y_of, reps), np.tile(np.arange(reps), m), _drawer(sizes, reps, seed))
        masks = [np.array([0, *[names.index(t) for t in model.terms]]) for model in models for _ in range(reps)]
        beta, _, _, converged, _ = _newton(drawn, masks)
    finally:
        kept.unpersist()
    ok = converged.reshape(m, reps).all(axis=0)
    draws = [
        {"spec": model.name, "rep": int(r),
         **{t: float(beta[i * reps + r, names.index(t)]) for t in ("Intercept", *model.terms)}}
        for i, model in enumerate(models) for r in np.flatnonzero(ok)]
    failed = int(reps - ok.sum())
    return {"draws": draws, "failed": failed, "reps": reps, "reliable": failed < 0.05 * reps}


def draws_frame(df: DataFrame, result: dict) -> DataFrame:
    """The draws as (spec, term, rep, odds_ratio) rows: one per repetition and term."""
    rows = [(d["spec"], t, d["rep"], float(np.exp(v))) for d in result["draws"] for t, v in d.items()
            if t not in ("spec", "rep", "Intercept")]
    return df.sparkSession.createDataFrame(rows, "spec STRING, term STRING, rep INT, odds_ratio DOUBLE")


def draw_interval(result: dict, spec: str, term: str, level: float = 0.95) -> tuple[float, float]:
    """L11. The middle share of one term's odds ratios. There is one draw per repetition."""
    values = np.exp([d[term] for d in result["draws"] if d["spec"] == spec])
    tail = (1 - level) / 2
    return tuple(float(q) for q in np.quantile(values, [tail, 1 - tail]))
