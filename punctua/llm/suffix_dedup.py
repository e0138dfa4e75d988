"""Remove byte strings that occur earlier in the corpus: bucket-pointer refinement of suffix buckets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.llm.batches import GOLDEN, mix64, pieces
from punctua.llm.repeats import NO_ID, covered, earlier_windows, with_body, with_windows

LENGTH, GRAM = 100, 32
FIRST = 8  # bytes of the initial buckets
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * GOLDEN)


def byte_symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return offsets - offsets[0], _BYTE[raw], raw


def refine_buckets(text: np.ndarray, offsets: np.ndarray, depth: int) -> np.ndarray:
    """Bucket of every position by its next ``depth`` bytes; -1 where these bytes occur once, or a string ends before.

    Initial buckets are the q-grams themselves, in order. A bucket is refined by sorting its positions on the bucket
    identifiers that the positions ``d`` bytes later have by now, which makes it a bucket by ``2 d`` bytes; the new identifiers serve the
    next refinement. Positions alone in a bucket are settled, as is one whose later position is settled: both drop out.
    """
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(text))
    bucket = np.full(len(text), -1)

    def regroup(at: np.ndarray, key: np.ndarray) -> None:
        _, place, size = np.unique(key, return_inverse=True, return_counts=True)
        bucket[:] = -1
        bucket[at] = np.where(size[place] > 1, place, -1)

    d = min(FIRST, depth)
    at = np.flatnonzero(left >= d)
    key = np.zeros(len(at), np.uint64)
    for i in range(d):
        key = (key << np.uint64(8)) | text[at + i]
    regroup(at, key)
    while d < depth:
        step = min(d, depth - d)
        at = at[(left[at] >= d + step) & (bucket[at] >= 0)]
        at = at[bucket[at + step] >= 0]
        regroup(at, bucket[at] * (len(text) + 1) + bucket[at + step])
        d += step
    return bucket


def bucket_index(contexts: np.ndarray, offsets: np.ndarray, heads: np.ndarray, k: int) -> np.ndarray:
    """For contexts in order of occurrence: where each window of ``k`` bytes starts first."""
    counts = np.diff(offsets) - k + 1
    windows = np.arange(counts.sum()) + np.repeat(offsets[:-1] - (np.cumsum(counts) - counts), counts)
    bucket = refine_buckets(contexts, offsets, k)[windows]
    first = np.full(len(contexts) + 1, len(contexts))
    np.minimum.at(first, bucket, windows)  # windows in no bucket (-1) meet in the spare last place
    return np.where(bucket >= 0, first[bucket], windows)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Each document without the bytes covered by a ``length``-byte string that also starts earlier.

    Earlier: in a document with a smaller id, or in the same one further left; strings are compared on the input and
    never cross documents. Result: ``doc_id, n_bytes, n_removed, spans, kept`` with ``spans`` the maximal removed runs as
    ``(start, end)`` and ``kept`` the remaining bytes (binary, as a cut may split a character).

    A null or empty text has no bytes. Rows that repeat an id and text count as one document and get equal results; differing texts under one id are
    documents of their own, compared with others but not with each other. A null id comes before all others. An empty table gives no rows.
    """
    rows = with_body(docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"), "text"))
    found = with_windows(rows, earlier_windows(rows, byte_symbols, bucket_index, np.uint8, length, gram))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            offsets, _, raw = byte_symbols(part["text"])
            removed, spans, kept = [], [], []
            for a, b, low, high in zip(offsets[:-1], offsets[1:], part["low"], part["high"]):
                if not low.is_valid:
                    removed.append(0), spans.append([]), kept.append(raw[a:b].tobytes())
                    continue
                gone = covered(low.values.to_numpy(), high.values.to_numpy(), length, b - a)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))).reshape(-1, 2)
                removed.append(int(gone.sum()))
                spans.append([{"start": s, "end": e} for s, e in edges.tolist()])
                kept.append(raw[a:b][~gone].tobytes())
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
                                             names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return found.mapInArrow(remove, "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept binary").withColumn(
        "doc_id", F.nullif("doc_id", F.lit(NO_ID)))
