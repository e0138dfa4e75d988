"""Remove word sequences that occur earlier in the corpus: backward search in compressed FM-indexes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctua.llm.batches import pieces, split_words, word_hashes
from punctua.llm.repeats import NO_ID, covered, earlier_windows, with_body, with_windows

LENGTH, GRAM = 20, 5


def word_symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    offsets, hashes = word_hashes(texts)
    return offsets, hashes, hashes


class Bits:
    """A bit vector packed into 64-bit words, with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[:len(packed)] = packed
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]]).astype(np.int32)
        self.zeros = len(bits) - int(bits.sum())

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before position ``i``."""
        word = i >> 6
        below = self.words[word] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below).astype(np.int64)


class FMIndex:
    """Self-index of short strings over integers: Burrows-Wheeler transform in a wavelet matrix.

    Suffixes are sorted to ``depth`` symbols, which settles all searches for shorter patterns.
    """

    def __init__(self, text: np.ndarray, offsets: np.ndarray, depth: int):
        sizes = np.diff(offsets)
        self.alphabet, codes = np.unique(text, return_inverse=True)
        strings = np.repeat(np.arange(len(sizes)), sizes + 1)
        joined = np.zeros(len(text) + len(sizes), np.int64)  # 0 ends a string
        joined[np.arange(len(text)) + np.repeat(np.arange(len(sizes)), sizes)] = codes + 1
        rank, reach = joined, 1
        while reach < depth:
            later = np.zeros_like(rank)
            later[:-reach] = rank[reach:]
            _, rank = np.unique(rank * (rank.max() + len(rank) + 1) + later, return_inverse=True)
            reach *= 2
        order = np.argsort(rank, kind="stable")
        self.start = order - strings[order]  # where in the text each suffix starts, in suffix order
        self.size = len(joined)
        last, self.levels = joined[order - 1], []
        for bit in reversed(range(max(int(joined.max()).bit_length(), 1))):
            bits = (last >> bit) & 1 == 1
            self.levels.append((bit, Bits(bits)))
            last = np.concatenate([last[~bits], last[bits]])
        symbols = np.arange(len(self.alphabet) + 1)
        self.smaller = np.searchsorted(np.sort(joined), symbols)
        self.origin = self._down(symbols, np.zeros_like(symbols))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for bit, bits in self.levels:
            ones = bits.ones(i)
            i = np.where((symbol >> bit) & 1 == 1, bits.zeros + ones, i - ones)
        return i

    def extend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """One step of backward search for a bound ``i`` of an interval."""
        return self.smaller[symbol] + self._down(symbol, i) - self.origin[symbol]

    def search(self, codes: np.ndarray, ends: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(which, low, high)``: streamed positions ``ends`` of ``codes`` whose matching statistic (the longest match that ends there, seen
        from right to left) reaches ``k`` in two or more places, and the suffix interval of that match."""
        which = np.arange(len(ends))
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.size)
        for back in range(k):
            symbol = codes[ends[which] - 1 - back]
            low, high = self.extend(symbol, low), self.extend(symbol, high)
            alive = high - low > 1
            which, low, high = which[alive], low[alive], high[alive]
        return which, low, high


def fm_windows(contexts: np.ndarray, offsets: np.ndarray, heads: np.ndarray, k: int) -> np.ndarray:
    """For contexts in order of occurrence: where each window of ``k`` words starts first."""
    index = FMIndex(contexts, offsets, k + 1)
    codes = np.searchsorted(index.alphabet, contexts) + 1
    counts = np.diff(offsets) - k + 1
    ends = np.arange(counts.sum()) + np.repeat(offsets[:-1] - (np.cumsum(counts) - counts), counts) + k
    which, low, high = index.search(codes, ends, k)
    earliest = ends - k
    if len(which):
        start, place = np.unique(low, return_inverse=True)
        stop = np.zeros(len(start), np.int64)
        stop[place] = high
        bounds = np.stack([start, stop], 1).ravel()
        first = np.minimum.reduceat(np.append(index.start, len(contexts)), bounds)[::2]
        earliest[which] = first[place]
    return earliest


def remove_repeated_passages(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Each document without the words covered by a window of ``length`` words that also starts earlier.

    Earlier: in a document with a smaller id, or in the same one further left; windows are compared on the input and
    never cross documents. Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Result: ``doc_id, n_words, n_removed, kept`` with ``kept`` the remaining words joined by one space.

    Contexts are dealt to shards by content; each shard builds its index and streams its documents' contexts through it (:class:`FMIndex`).
    A text without words, or null, keeps an empty text. Rows that repeat an id and text count as one document and get equal results; differing texts under one id are
    documents of their own, compared with others but not with each other. A null id comes before all others. An empty table gives no rows.
    """
    rows = with_body(docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"), "text"))
    return _remove(with_windows(rows, earlier_windows(rows, word_symbols, fm_windows, np.uint64, length, gram)), length)


def _remove(found: DataFrame, length: int, untouched: bool = False, *keep: str) -> DataFrame:
    """``untouched``: a text of which nothing is removed is returned as it was."""
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
              T.StructField("kept", T.StringType()), *[found.schema[c] for c in keep]]

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            offsets, flat = split_words(part["text"])
            gone = np.zeros(len(flat), bool)
            for a, b, low, high in zip(offsets[:-1], offsets[1:], part["low"], part["high"]):
                if low.is_valid:
                    gone[a:b] = covered(low.values.to_numpy(), high.values.to_numpy(), length, b - a)
            before = np.concatenate([[0], np.cumsum(~gone)])[offsets]
            left = flat.filter(pa.array(~gone)).cast(pa.string())
            kept = pc.binary_join(pa.ListArray.from_arrays(pa.array(before, pa.int32()), left), " ")
            n = np.diff(offsets)
            if untouched:
                kept = pc.if_else(pa.array(n == np.diff(before)), part["text"], kept)
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(n), pa.array(n - np.diff(before)), kept, *[part[c] for c in keep]],
                                             names=["doc_id", "n_words", "n_removed", "kept", *keep])

    return found.mapInArrow(remove, T.StructType(fields)).withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def strip_passages(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeated passages removed from the texts; documents of which no word is left go.

    Texts without a repeated passage stay as they are, in the others the remaining words are joined by one space. ``n_chars``, if there is one, follows the text.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = with_body(docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"), "text",
                                 F.struct(F.lit(True).alias("present"), *[docs[c] for c in others]).alias("others")))
    windows = earlier_windows(rows.select("doc_id", "body", "text"), word_symbols, fm_windows, np.uint64, length, gram)
    left = _remove(with_windows(rows, windows), length, True, "others").where("n_removed = 0 or n_removed < n_words")
    changed = F.col("n_removed") > 0
    columns = {c: F.col("others")[c] for c in others} | {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": F.col("kept")}
    if "n_chars" in others:
        columns["n_chars"] = F.when(changed, F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    return left.select(*[columns[c].alias(c) for c in docs.columns])
