"""Toxic passages: maximal scoring segments over token log-odds, with extreme-value calibration."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.llm.batches import pieces, word_codes
from punctua.llm.common import staged

SAMPLE = 10_000  # labelled documents of either label that the log-odds are fitted on; calibration uses all
BUCKETS = 1 << 21  # hashed tokens; the model is at most one number for each, whatever the corpus
PRIOR = 1.0  # weight of the Dirichlet prior, as a share of the toxic tokens
CLEAR, EFFECT = 2.5, 1.0  # a log-odds counts if it is over EFFECT by CLEAR standard errors; mild ones follow topic and language
STEMS = (4, 5, 6, 7, 8)  # leading bytes that count as tokens of their own, so that inflected forms share evidence
DRIFT = 0.05  # cost of a token, so that a segment pays for its length
SIGNIFICANT = 0.01
_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[65:91] += 32
_CLEAN[[b for b in range(128) if not chr(b).isalnum()]] = 32


def token_buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(offsets, codes, buckets)``: every token as a row of ``buckets``, which has the token's and its stems' hash buckets.

    Tokens are runs of ASCII letters, digits and any non-ASCII characters, A-Z lower-cased.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    raw = _CLEAN[np.frombuffer(texts.buffers()[2] or b"", np.uint8)]
    plain = pa.Array.from_buffers(pa.large_string(), len(texts), [None, texts.buffers()[1], pa.py_buffer(raw)])
    offsets, codes, vocabulary = word_codes(plain)
    hashed = (xxhash.xxh3_64_intdigest(w[:n]) for w in vocabulary for n in (len(w), *(min(n, len(w)) for n in STEMS)))
    width = 1 + len(STEMS)
    return offsets, codes, (np.fromiter(hashed, np.uint64, len(vocabulary) * width) % np.uint64(BUCKETS)).astype(np.int64).reshape(-1, width)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)`` of one sequence (Ruzzo and Tompa), in time linear in its length.

    Only runs of positive tokens are visited one by one; the sums between them come from one cumulative sum.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[list] = []  # start, end, sum before, sum after, index of the nearest earlier segment with a lower sum before
    for i in positive.tolist():
        start, before, after = i, total[i], total[i + 1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= after:
                found.append([start, i + 1, before, after, j])
                break
            start, before = found[j][0], found[j][2]
            del found[j:]
    return [(s, e, float(b - a)) for s, e, a, b, _ in found]


def _remainder(by: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % by


def held_out() -> Column:
    return F.coalesce(_remainder(5) == 0, F.lit(False))


def token_log_odds(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray, float, float]:
    """Token buckets with a clear log-odds, these log-odds, and the fit of the background: ``(buckets, log_odds, rate, drift)``.

    ``labelled`` has ``text, toxic``. A token counts once in each document that has it, so one document cannot outvote the others; Spark sums the counts. The prior of a token is its share of all
    tokens, times ``PRIOR`` times the number of toxic tokens. Only clearly toxic log-odds (:data:`CLEAR`, :data:`EFFECT`) are kept; any other token costs :data:`DRIFT`. ``rate`` solves ``E exp(rate * s) = 1`` over the tokens of clean documents.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            offsets, codes, buckets = token_buckets(part["text"])
            document = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            document, codes = np.divmod(np.unique(document * max(len(buckets), 1) + codes), max(len(buckets), 1))
            toxic = (part["toxic"].to_numpy(zero_copy_only=False) == 1)[document]
            hits, all_hits = np.bincount(codes, toxic, len(buckets)), np.bincount(codes, minlength=len(buckets))
            once = np.ones(buckets.shape, bool)  # a stem as long as the token is the token itself
            for i in range(1, buckets.shape[1]):
                once[:, i] = (buckets[:, i, None] != buckets[:, :i]).all(1)
            kinds, place = np.unique(buckets[once], return_inverse=True)
            row = np.nonzero(once)[0]
            n_toxic = np.bincount(place, hits[row], len(kinds)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(n_toxic), pa.array(np.bincount(place, all_hits[row], len(kinds)).astype(np.int64) - n_toxic)],
                                             names=["bucket", "toxic", "clean"])

    counts = staged(labelled.select("text", "toxic").mapInArrow(count, "bucket bigint, toxic bigint, clean bigint")
                    .groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "toxic-counts")
    n_toxic, n_clean = counts.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum("clean"), F.lit(0))).first()
    if not n_toxic or not n_clean:
        return np.empty(0, np.int64), np.empty(0), 1.0, DRIFT
    weight = PRIOR * n_toxic
    prior = weight * (F.col("toxic") + F.col("clean")) / float(n_toxic + n_clean)
    a, b = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(a / (n_toxic + weight - a)) - F.log(b / (n_clean + weight - b))
    clear = (counts.select("bucket", "clean", odds.alias("odds"), F.sqrt(1 / a + 1 / b).alias("error"))
             .where(F.col("odds") - CLEAR * F.col("error") >= EFFECT).toPandas().sort_values("bucket"))  # at most BUCKETS rows
    share = np.append(clear["clean"], max(n_clean - clear["clean"].sum(), 1)) / n_clean
    score = np.append(clear["odds"], 0.0) - DRIFT
    low, high = 0.0, 64.0
    for _ in range(60):  # the sum falls from 1 at 0, then rises for good if any score is positive
        rate = (low + high) / 2
        low, high = (rate, high) if (share * np.exp(np.minimum(rate * score, 700))).sum() < 1 else (low, rate)
    return clear["bucket"].to_numpy(), clear["odds"].to_numpy(), rate, DRIFT


def find_segments(docs: DataFrame, buckets: np.ndarray, log_odds: np.ndarray, drift: float) -> DataFrame:
    """``doc_id, n_tokens, segments``: every maximal scoring segment of every whole text, as ``(start, end, score)`` in tokens."""
    kind = "struct<start:bigint,end:bigint,score:double>"
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(BUCKETS)
        table[buckets] = log_odds
        for part in pieces(batches):
            offsets, codes, features = token_buckets(part["text"])
            scores = table[features].max(1, initial=0.0)[codes] - drift
            rows = [[{"start": s, "end": e, "score": x} for s, e, x in maximal_segments(scores[a:b])] for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(np.diff(offsets)), pa.array(rows, arrow)], names=["doc_id", "n_tokens", "segments"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(search, f"doc_id bigint, n_tokens bigint, segments array<{kind}>")


def _logistic(bins: list[tuple[float, float, float]]) -> tuple[float, float]:
    """Slope and intercept of a logistic fit with a weak ridge; rows are ``(x, positives, negatives)``."""
    x, yes, no = (np.array(v, float) for v in zip(*bins))
    design, beta = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        weight = (yes + no) * p * (1 - p)
        step = np.linalg.solve(design.T @ (design * weight[:, None]) + 1e-3 * np.eye(2), design.T @ (yes - (yes + no) * p) - 1e-3 * beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_tokens, top, passages`` for every document.

    Labels count only for ids with ``crc32(doc_id) mod 5 <> 0``. Token log-odds come from at most ``sample`` documents of either label, those with
    the lowest hashes of ids, so only a bounded list of ids meets the texts. A text's
    best segment ``S`` among ``n`` tokens is an extreme value: ``K n exp(-rate S)`` segments as good are expected by chance, with ``K``
    from the mean of clean documents (Gumbel). The score is a logistic fit of the label on the logarithm of that number;
    ``passages`` are the segments with an expectation up to :data:`SIGNIFICANT`.

    A null or empty text has no segment and gets the score of such texts. A null id has no label and is not held out. Of contradictory labels the higher counts;
    labels of repeated rows count once for each row. Without labels of both kinds all scores are 0 (or 1 if all are toxic).
    """
    marks = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(_remainder(5) != 0)
    marks = staged(marks, "toxic-labels")
    drawn = [marks.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for kind in (0, 1)]
    drawn = staged(drawn[0].union(drawn[1]), "toxic-sample")
    train = docs.select("doc_id", "text").where(_remainder(5) != 0).join(drawn, "doc_id").select("text", "toxic")
    buckets, odds, rate, drift = token_log_odds(train)
    top = F.coalesce(F.array_max(F.transform("segments", lambda s: s["score"])), F.lit(0.0))
    found = staged(find_segments(docs, buckets, odds, drift).withColumn("top", top), "toxic-segments")
    length = F.log(F.greatest("n_tokens", F.lit(1)))
    known = found.join(marks, "doc_id")
    mean = known.where("toxic = 0").agg(F.avg(rate * F.col("top") - length)).first()[0]
    log_k = (mean or 0.0) - 0.5772156649
    surprise = rate * F.col("top") - length - log_k  # minus the log of the expected number
    bins = [tuple(r) for r in known.groupBy(F.least(F.greatest(F.round(surprise * 4), F.lit(-400)), F.lit(400)).alias("x"))
            .agg(F.sum(F.col("toxic").cast("double")), F.sum((1 - F.col("toxic")).cast("double"))).collect()]  # at most 801 rows
    if bins and 0 < sum(b[1] for b in bins) and 0 < sum(b[2] for b in bins):
        slope, intercept = _logistic([(x / 4, yes, no) for x, yes, no in sorted(bins)])
    else:
        slope, intercept = 0.0, 40.0 if bins and bins[0][1] else -40.0
    clipped = F.least(F.greatest(surprise, F.lit(-100.0)), F.lit(100.0))
    score = 1 / (1 + F.exp(-(slope * clipped + intercept)))
    passages = F.filter("segments", lambda s: rate * s["score"] - length - log_k >= -math.log(SIGNIFICANT))
    return found.select("doc_id", held_out().alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), "n_tokens", "top", passages.alias("passages"))
