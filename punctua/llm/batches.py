"""Word and byte handling on Arrow batches, vectorised. Used inside Spark tasks only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PIECE_BYTES = 4 << 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``most`` bytes in each; a longer single text stays whole.

    The pieces are copies: some Arrow kernels misread large strings whose offsets do not start at 0.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(lengths) // most
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), len(lengths)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                rows = pa.array(np.arange(a, b))
                yield pa.RecordBatch.from_arrays([c.take(rows) for c in batch.columns], names=batch.schema.names)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, pa.Array]:
    """``(offsets, words)``: the ASCII-whitespace words of all texts in a row; text ``i`` has ``words[offsets[i]:offsets[i + 1]]``."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat, ends = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    full = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return before[ends], flat.filter(full)


def word_codes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """``(offsets, codes, vocabulary)``: every word as a place in the batch's distinct words."""
    offsets, flat = split_words(texts, lower)
    codes = flat.dictionary_encode()
    return offsets, codes.indices.to_numpy(), codes.dictionary.cast(pa.large_binary()).to_pylist()


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, hashes)``: a 64-bit hash of every word; each distinct word of the batch is hashed once."""
    offsets, codes, vocabulary = word_codes(texts, lower)
    table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in vocabulary), np.uint64, len(vocabulary))
    return offsets, table[codes] if len(vocabulary) else np.empty(0, np.uint64)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
