"""Language identification with a blended-spectrum string kernel, Nyström landmarks and kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctua.llm.batches import pieces
from punctua.llm.common import staged

UNKNOWN = "und"
GRAMS = 3  # byte n-grams of length 1 to GRAMS
SPACE_BITS = 18
SAMPLE = 1200  # labelled documents that the model is fitted on, all languages together
LANDMARKS = 400
RIDGE = 0.05
LEAST = 0.35  # score under which no language claims a text; one of two equal claims has 0.5, and so has a text of which no n-gram is known
KNOWN, CLEAR = 0.9, 0.12  # a text with a smaller share of known n-grams and a smaller margin between its two best scores is in no learned language


def present_grams(texts: pa.Array) -> Iterator[np.ndarray]:
    """Indices of the byte n-grams that occur in each whole text, A-Z lower-cased (presence: each once)."""
    texts = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    seen = np.zeros(1 << SPACE_BITS, bool)
    for text in texts:
        raw = np.frombuffer(text.as_buffer(), np.uint8).astype(np.uint32)
        code = np.zeros(len(raw) + 1, np.uint32)
        for n in range(1, GRAMS + 1):
            code = code[:-1] * np.uint32(256) + raw[n - 1:]
            if len(code):
                seen[((code + np.uint32(n << 28)) * np.uint32(2654435761)) >> np.uint32(32 - SPACE_BITS)] = True
        present = np.flatnonzero(seen)
        seen[present] = False
        yield present


class KernelModel:
    """One-versus-rest kernel ridge regression on Nyström features.

    The kernel of two texts is the number of n-grams present in both, divided by the root of the product of their numbers. Features are
    ``K(x, Z) K(Z, Z)^-1/2`` for landmarks ``Z``. As the kernel is an inner product of presence vectors, landmarks and weights
    fold into one matrix (n-gram x language), and scoring a batch is one product of its presence rows with it.
    """

    def __init__(self, grams: list[np.ndarray], langs: list[str]):
        self.langs = sorted(set(langs))
        count = np.bincount(np.concatenate(grams), minlength=1 << SPACE_BITS)
        self.known = count > 1  # in two documents of the sample or more
        usual = [np.mean(count[g] > 2) for g in grams if len(g)]  # share of a document that two others know
        self.least_known = min(KNOWN, float(np.quantile(usual, 0.01))) if usual else 0.0
        used = np.unique(np.concatenate(grams))
        place = np.zeros(1 << SPACE_BITS, np.int32)
        place[used] = np.arange(len(used))
        x = np.zeros((len(grams), len(used)), np.float32)
        for row, present in zip(x, grams):
            row[place[present]] = 1 / np.sqrt(max(len(present), 1))
        z = x[:: max(1, -(-len(x) // LANDMARKS))]
        values, vectors = np.linalg.eigh((z @ z.T).astype(np.float64))
        keep = values > 1e-6 * values[-1]
        root = vectors[:, keep] / np.sqrt(values[keep]) @ vectors[:, keep].T
        features = (x @ z.T).astype(np.float64) @ root
        target = np.where(np.array(langs)[:, None] == np.array(self.langs)[None, :], 1.0, -1.0)
        share = np.array([langs.count(v) for v in langs], float)  # each language weighs the same
        weighted = features * (len(langs) / len(self.langs) / share)[:, None]
        solved = np.linalg.solve(weighted.T @ features + RIDGE * np.eye(features.shape[1]), weighted.T @ target)
        self.matrix = np.zeros((1 << SPACE_BITS, len(self.langs)), np.float32)
        self.matrix[used] = z.T @ (root @ solved)

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Per text and language a score from 0 to 1."""
        return self._scores(list(present_grams(texts)))

    def judged(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The scores, and whether each text is in a learned language: most of its n-grams are known, or one language is clearly ahead."""
        rows = list(present_grams(texts))
        scores = self._scores(rows)
        share = np.array([self.known[r].mean() if len(r) else 0.0 for r in rows])
        best = np.sort(scores, 1)
        margin = best[:, -1] - best[:, -2] if len(self.langs) > 1 else np.zeros(len(rows))
        return scores, (share >= self.least_known) | (margin >= CLEAR)

    def _scores(self, rows: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(r) for r in rows])
        out = np.zeros((len(rows), len(self.langs)), np.float32)
        full = sizes > 0
        if full.any():
            starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            out[full] = np.add.reduceat(self.matrix[np.concatenate(rows)], starts, axis=0) / np.sqrt(sizes[full])[:, None]
        return np.clip((out + 1) / 2, 0, 1)


def _remainder(by: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % by


def fit_languages(docs: DataFrame, sample: int = SAMPLE) -> KernelModel | None:
    """The model of at most ``sample`` documents with text and language, the same number per language as far as there are so many.

    Held-out documents (``crc32(doc_id) mod 3 = 1``) and null ids are not used. The sample is the lowest hashes of ids, so a rerun
    draws the same; what reaches the driver is its n-gram indices, at most ``2^18`` a document. None without labelled rows.
    """
    usable = docs.where("lang is not null and text is not null and doc_id is not null").where(_remainder(3) != 1)
    kinds = usable.select("lang").distinct().count()
    if not kinds:
        return None
    order = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    drawn = staged(usable.select("doc_id", "lang").withColumn("turn", order).where(F.col("turn") <= max(1, sample // kinds)).drop("turn").distinct(), "lang-sample")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            rows = [r.astype(np.int32).tobytes() for r in present_grams(part["text"])]
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["lang"], pa.array(rows, pa.binary())], names=["doc_id", "lang", "grams"])

    picked = (usable.select("doc_id", "lang", "text").join(drawn, ["doc_id", "lang"], "left_semi").select("doc_id", "lang", "text")
              .mapInArrow(grams, "doc_id bigint, lang string, grams binary").toPandas().sort_values(["doc_id", "lang", "grams"]))
    order = np.argsort(pd.util.hash_array(picked["doc_id"].to_numpy()), kind="stable")  # landmarks are every n-th of this order
    picked = picked.iloc[order]
    return KernelModel([np.frombuffer(g, np.int32) for g in picked["grams"]], list(picked["lang"]))


def identify_language(docs: DataFrame, model: KernelModel | None = None, keep: tuple[str, ...] = (), learned: bool = False) -> DataFrame:
    """Language of every whole text: ``doc_id, lang_pred, score``, and the columns ``keep``.

    Fitted on ``docs`` itself if no model is given (:func:`fit_languages`). ``und`` with score 0 where the text is null or has no
    letter, or if there is nothing to learn from; ties go to the first language in code point order. Each row is scored on its own:
    repeated rows agree, a null id is kept. ``learned``: also ``und`` with score 0 where a text is in none of the learned languages (:meth:`KernelModel.judged`).
    """
    model = model or fit_languages(docs)
    fields = [docs.schema[c] for c in keep]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letter"),
                       *[F.col(c).alias(f"_{c}") for c in keep])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            letter = part["_letter"].to_numpy(zero_copy_only=False)
            if model is None:
                best, top = np.full(len(letter), UNKNOWN, object), np.zeros(len(letter))
            else:
                if learned:
                    values, inside = model.judged(part["text"])
                    letter = letter & inside
                else:
                    values = model.scores(part["text"])
                best = np.where(letter, np.array(model.langs, object)[values.argmax(1)], UNKNOWN)
                top = np.where(letter, values.max(1), 0.0)
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(best, pa.string()), pa.array(top, pa.float64()), *[part[f"_{c}"] for c in keep]],
                                             names=["doc_id", "lang_pred", "score", *keep])

    return rows.mapInArrow(score, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()),
                                                T.StructField("score", T.DoubleType()), *fields]))


def keep_identified(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """``docs`` without the documents that no language claims: without text or letter, in no learned language, or with a score under ``least``.

    Where there is nothing to learn a language from, texts with a letter stay.
    """
    model = fit_languages(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    row = docs.select("doc_id", "text", F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    found = identify_language(row, model, ("row",), True).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return found.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def held_out() -> Column:
    return F.coalesce(_remainder(3) == 1, F.lit(False))
