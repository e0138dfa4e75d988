"""Quality rules with risk-controlled cutoffs (DataFrame operations only)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.llm.common import let, staged, words

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
#: Rule: the measure (higher is worse) and its cutoffs from lenient to strict.
RULES = {
    "symbols": ("n_symbols / word_chars", (0.8, 0.5, 0.3, 0.2, 0.1, 0.05)),
    "repeats": ("n_repeat_words / n_words", (0.25, 0.2, 0.15, 0.1, 0.05)),
    "lines": ("n_dup_lines / n_lines", (0.8, 0.5, 0.3, 0.2, 0.1)),
    "long_words": ("word_chars / n_words", (40.0, 20.0, 15.0, 12.0, 10.0)),
}


def _repeat_words(tokens: Column) -> Column:
    """Words that lie in an 8-word window found twice or more."""
    hashes = F.transform(F.sequence(F.lit(1), F.size(tokens) - WINDOW + 1), lambda i: F.xxhash64(F.slice(tokens, i, WINDOW)))

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return let(placed, lambda s: let(
            F.sort_array(F.transform(
                F.filter(s, lambda e, j: (e["x"] == F.get(s, j - 1)["x"]) | (e["x"] == F.get(s, j + 1)["x"])), lambda e: e["i"])),
            lambda at: F.aggregate(
                F.transform(at, lambda p, j: F.least(F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))),
                F.lit(0), lambda total, x: total + x)))

    repeated = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))
    return F.when(F.size(tokens) > WINDOW, repeated).otherwise(0).cast("bigint")


def measure(docs: DataFrame, *keep: str) -> DataFrame:
    """``doc_id``, ``keep`` and the counts ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words``.

    Each row is measured on its own, without a shuffle; work on a text is n log n in its words. Null texts count 0.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = let(words(text), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"), F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        _repeat_words(w).alias("n_repeat_words")))
    line_counts = let(lines, lambda x: F.struct(
        F.size(x).cast("bigint").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines")))
    return docs.select("doc_id", *keep, counts.alias("c"), line_counts.alias("l"),
                       F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols")).select(
        "doc_id", *keep, "c.*", "l.*", "n_symbols")


def _log_gamma(x: Column) -> Column:
    """Stirling's series at ``x + 8``, carried back to ``x`` (x >= 1)."""
    z = x + 8.0
    series = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * F.pow(z, F.lit(3.0))) + 1 / (1260 * F.pow(z, F.lit(5.0)))
    for i in range(8):
        series = series - F.log(x + float(i))
    return series


def binomial_tail(k: Column, n: Column, risk: float) -> Column:
    """Exact ``P(X <= k)`` for ``X ~ Binomial(n, risk)``; 1 where ``k`` is at the mean or above (no evidence there).

    Below the mean the terms fall from ``k`` down, and all that matter lie within a few standard deviations.
    """
    k, n = k.cast("double"), n.cast("double")
    top = (_log_gamma(n + 1.0) - _log_gamma(k + 1.0) - _log_gamma(n - k + 1.0)
           + k * math.log(risk) + (n - k) * math.log1p(-risk))
    steps = F.least(k, F.ceil(20 * F.sqrt(n * risk)) + 60).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def down(s: Column, j: Column) -> Column:
        i = k - j + 1.0
        term = s["term"] * i * (1 - risk) / ((n - i + 1.0) * risk)
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))

    indices = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
    return F.when(k >= n * risk, 1.0).otherwise(F.exp(top) * F.aggregate(indices, start, down)["sum"])


def _value(rule: str) -> Column:
    above, below = RULES[rule][0].split(" / ")
    return F.when(F.col(below) > 0, F.col(above) / F.col(below)).otherwise(0.0)


def choose_cutoffs(labelled: DataFrame, risk: float, error: float) -> DataFrame:
    """``stratum, rule, cutoff, n_good, n_lost, p_value``: the strictest cutoff that is safe, per stratum and rule.

    ``labelled`` has ``stratum, quality`` and the measures. A cutoff is safe if the hypothesis that it rejects more than
    ``risk / rules`` of the good documents is refuted by the exact binomial tail. Cutoffs are tested from lenient to
    strict and the first failure ends it, so a stratum and rule need no further correction (fixed sequence);
    ``error`` is divided by the number of strata times rules (Bonferroni). With probability ``1 - error`` no
    stratum loses more than ``risk`` of its good documents. Pairs without a safe cutoff have no row.
    """
    tried = F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(i).alias("step"), F.lit(float(c)).alias("cutoff"), (_value(rule) > c).alias("lost"))
        for rule, (_, cutoffs) in RULES.items() for i, c in enumerate(cutoffs)]))
    counts = (labelled.where("quality = 1").select("stratum", tried.alias("t")).select("stratum", "t.*")
              .groupBy("stratum", "rule", "step", "cutoff")
              .agg(F.count(F.lit(1)).alias("n_good"), F.sum(F.col("lost").cast("bigint")).alias("n_lost")))
    strata = labelled.where("quality = 1").agg(F.count_distinct(F.struct("stratum")).alias("strata")).scalar()
    level = F.lit(error / len(RULES)) / strata
    order = Window.partitionBy("stratum", "rule").orderBy("step")
    tested = (counts.withColumn("p_value", binomial_tail(F.col("n_lost"), F.col("n_good"), risk / len(RULES)))
              .withColumn("safe", F.min(F.col("p_value") <= level).over(order)).where("safe"))
    last = F.row_number().over(Window.partitionBy("stratum", "rule").orderBy(F.desc("step")))
    return tested.withColumn("last", last).where("last = 1").select("stratum", "rule", "cutoff", "n_good", "n_lost", "p_value")


def judge_quality(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.05, error: float = 0.05) -> DataFrame:
    """Counts and verdict per document: ``doc_id``, the counts, ``base_failed, stratum, rejected_by, kept``.

    ``base_failed``: under 20 words, or over 30 % of words in repeated windows. Other documents are rejected if a measure
    of :data:`RULES` is above the cutoff of their stratum (:func:`choose_cutoffs`). All labelled rows serve as holdout, as the
    measures themselves are not learnt. A stratum without enough labels gets no cutoff and rejects nothing.

    A null text counts 0 and fails the base; a null stratum is a stratum of its own; of contradictory labels the
    lower quality counts; repeated rows are judged alike. Without labels only the base rules apply; an empty table gives no rows.
    """
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    measured = staged(measure(docs.select("doc_id", "text", F.col(stratum).alias("stratum")), "stratum")
                      .withColumn("base_failed", base), "quality-measures")
    marks = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    cutoffs = staged(choose_cutoffs(measured.where("not base_failed").join(marks, "doc_id"), risk, error)
                     .groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")), "quality-cutoffs")
    broken = [F.when(_value(rule) > F.element_at("cutoffs", F.lit(rule)), F.lit(rule)) for rule in RULES]
    judged = (measured.alias("m").join(cutoffs.alias("c"), F.col("m.stratum").eqNullSafe(F.col("c.stratum")), "left")
              .select("m.*", "c.cutoffs").withColumn("rejected_by", F.concat_ws(",", *broken)))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rejected_by") == "")).drop("cutoffs")
