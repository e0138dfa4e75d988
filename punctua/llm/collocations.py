"""Phrase collocations by top-order marginalisation: only the longest windows are counted, ROLLUP sums their prefixes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.llm.batches import GOLDEN, mix64, pieces, split_words
from punctua.llm.common import staged

LEAST = 30  # occurrences of a candidate
ORDER = 4  # words of the longest phrase
COVERED = 80  # percent of a phrase's occurrences inside one longer candidate that drop it
TOP = 2000  # phrases reported for each language
UNKNOWN = "und"
PIECE = 6 << 20  # bytes of text counted at once
RANGES = 1 << 12  # most ranges into which the count buckets are dealt
RANGE_BITS = (18, 24)  # buckets of a range, as powers of two: as few as make sense, as many as a task holds
MAP_BITS = 27  # most bits of a map of frequent phrases (16 MB), whatever the corpus
_CUTS = b".,;:!?\n\x0b\x0c\r"
_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[65:91] += 32
_TABLE[list(_CUTS)] = 32
_IS_CUT = np.zeros(256, bool)
_IS_CUT[list(_CUTS)] = True
_IS_GAP = _IS_CUT.copy()
_IS_GAP[[9, 32]] = True


def linked_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """``(doc, words, linked)``: A-Z lower-cased words of all texts, the text of each, and whether the next word follows in the same piece."""
    texts = texts.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(_TABLE[raw]))
    offsets, words = split_words(plain)
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    is_word = ~_IS_GAP[raw]
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1]
    begins[ends[:-1][ends[:-1] < len(raw)]] |= is_word[ends[:-1][ends[:-1] < len(raw)]]
    piece = np.cumsum(_IS_CUT[raw])[begins]
    linked = np.zeros(len(doc), bool)
    if len(doc):
        linked[:-1] = (doc[1:] == doc[:-1]) & (piece[1:] == piece[:-1])
    return doc, words, linked


@dataclass
class FrequentMap:
    """Bits of hashed phrases: ``spread`` high bits of a hash name a range, the ``width`` next ones a bucket, of which the last ``folded`` name a bit."""

    bits: np.ndarray
    spread: int
    width: int
    folded: int

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        part = hashes >> np.uint64(64 - self.spread) if self.spread else np.zeros(len(hashes), np.uint64)
        at = (part << np.uint64(self.folded)) | ((hashes >> np.uint64(64 - self.spread - self.width)) & np.uint64((1 << self.folded) - 1))
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


class _Words:
    """The words of a batch as places in its vocabulary, and the hashes of the phrases that start at each of them."""

    def __init__(self, batch: pa.RecordBatch):
        doc, words, self.linked = linked_words(batch["text"])
        langs = batch["lang"].dictionary_encode()
        coded = words.dictionary_encode()
        self.langs, self.vocabulary = langs.dictionary.to_pylist(), coded.dictionary
        self.code, self.lang = coded.indices.to_numpy().astype(np.int64), langs.indices.to_numpy()[doc].astype(np.int64)
        seeds = np.fromiter((xxhash.xxh3_64_intdigest(x.encode()) for x in self.langs), np.uint64, len(self.langs))
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in coded.dictionary.cast(pa.large_binary()).to_pylist()), np.uint64, len(coded.dictionary))
        self.own = hashes[self.code] if len(hashes) else np.empty(0, np.uint64)
        self.seed = seeds[self.lang] if len(seeds) else self.own

    def phrases(self, most: int, maps: dict[int, FrequentMap]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(k, alive, hashes)`` for k = 1 .. ``most``: where phrases of k words start that may be frequent, and the hashes of those.

        Both phrases of k - 1 words inside must be alive, and the phrase itself be in the map of its length, where there is one.
        """
        n, alive, before = len(self.own), None, None
        for k in range(1, most + 1):
            if k == 1:
                at, h = np.arange(n), mix64(self.own + self.seed)
            else:
                both = alive[:-1] & alive[1:] & self.linked[:-1] if k == 2 else alive[:-1] & alive[1:]
                at = np.flatnonzero(both)
                h = mix64(before[at] * GOLDEN + self.own[at + k - 1])
            if k in maps:
                fine = maps[k].holds(h)
                at, h = at[fine], h[fine]
            alive, before = np.zeros(n, bool), np.zeros(n, np.uint64)
            alive[at], before[at] = True, h
            yield k, alive, h


def _counted(batches: Iterator[pa.RecordBatch], ranges: int, bits: int, sizes: range, known) -> Iterator[pa.RecordBatch]:
    """Counts of hashed phrases of some lengths: ``part, entries`` with one row per piece of text and range; an entry is a bucket and a count up to 255."""
    shift = 64 - (ranges.bit_length() - 1) - bits
    for batch in pieces(batches, most=PIECE):
        hashes = [h for k, _, h in _Words(batch).phrases(sizes[-1], known.value) if k in sizes]
        keys, n = np.unique(np.concatenate(hashes) >> np.uint64(shift), return_counts=True)
        part = (keys >> np.uint64(bits)).astype(np.int64)
        entries = ((keys & np.uint64((1 << bits) - 1)).astype(np.uint32) << np.uint32(8)) | np.minimum(n, 255).astype(np.uint32)
        edges = np.searchsorted(part, np.arange(ranges + 1))
        full = np.flatnonzero(np.diff(edges))
        data = pa.BinaryArray.from_buffers(pa.binary(), len(full), [None, pa.py_buffer((4 * np.append(edges[full], edges[-1])).astype(np.int32)), pa.py_buffer(entries)])
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), data], names=["part", "entries"])


def _frequent(batches: Iterator[pa.RecordBatch], bits: int, folded: int, least: int) -> Iterator[pa.RecordBatch]:
    """``part, bits``: of each range, which buckets count ``least`` or more, folded to ``1 << folded`` bits. Rows come in order of range."""
    now, counts = None, None

    def row():
        kept = (counts >= least).reshape(-1, 1 << folded).any(axis=0)
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(kept, bitorder="little").tobytes()])], names=["part", "bits"])

    for batch in batches:
        for part, entries in zip(batch["part"].to_pylist(), batch["entries"]):
            if part != now:
                if now is not None:
                    yield row()
                now, counts = part, np.zeros(1 << bits, np.uint32)
            x = np.frombuffer(entries.as_buffer(), np.uint32)
            at = x >> np.uint32(8)  # no bucket twice in a row
            counts[at] = np.minimum(counts[at] + (x & np.uint32(255)), 1 << 30)
    if now is not None:
        yield row()


def frequent_phrases(docs: DataFrame, least: int, sizes: range, known) -> FrequentMap:
    """A map of hashed phrases that leaves out only some that occur less than ``least`` times.

    Phrases of the given lengths that the maps ``known`` of shorter ones let through are counted in as many hash buckets as the corpus has words, so a
    bucket holds about one rare phrase. The map has one bit per bucket, folded to at most ``1 << MAP_BITS`` bits; sharing a bit lets
    more phrases through, never fewer.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = max(int(size // 4).bit_length(), RANGE_BITS[0])
    spread = min(wanted - RANGE_BITS[0], RANGES.bit_length() - 1)
    bits, ranges = min(wanted - spread, RANGE_BITS[1]), 1 << spread
    folded = min(bits, MAP_BITS - spread)
    counted = docs.mapInArrow(partial(_counted, ranges=ranges, bits=bits, sizes=sizes, known=known), "part int, entries binary")
    rows = (counted.repartition("part").sortWithinPartitions("part")
            .mapInArrow(partial(_frequent, bits=bits, folded=folded, least=least), "part int, bits binary").collect())
    out = np.zeros((ranges, 1 << max(folded - 3, 0)), np.uint8)
    for part, data in rows:
        out[part] = np.frombuffer(data, np.uint8)
    return FrequentMap(out.ravel(), spread, bits, folded)


def _windows(batches: Iterator[pa.RecordBatch], known, order: int) -> Iterator[pa.RecordBatch]:
    """``lang, w1..wN, c``: windows counted per piece of text, cut (and padded) where a piece ends or a phrase is not in its map.

    A word that is not in the map is counted as a window without words.
    """
    for batch in pieces(batches, most=PIECE):
        w = _Words(batch)
        n, v = len(w.code), len(w.vocabulary)
        code = np.concatenate([w.code, np.zeros(order, np.int64)])
        # one column after another: rows with equal columns so far share a group
        for k, alive, _ in w.phrases(order, known.value):
            if k == 1:
                first, start = alive, np.flatnonzero(alive)
                groups, group = np.unique(w.lang[start] * v + w.code[start], return_inverse=True)
                columns = [groups // max(v, 1), groups % max(v, 1)]
                continue
            nxt = np.where(alive[start], code[start + k - 1] + 1, 0)
            groups, group = np.unique(group * (v + 1) + nxt, return_inverse=True)
            columns = [c[groups // (v + 1)] for c in columns] + [groups % (v + 1) - 1]
        counts = np.bincount(group, minlength=len(columns[0]))
        rare = np.bincount(w.lang[~first], minlength=len(w.langs))
        other = np.flatnonzero(rare)
        names = pa.array(w.langs, pa.string()).take(pa.array(np.concatenate([columns[0], other])))
        texts = w.vocabulary.cast(pa.string())
        out = [names]
        for c in columns[1:]:
            c = np.concatenate([c, np.full(len(other), -1)])
            out.append(texts.take(pa.array(c, mask=c < 0)))
        out.append(pa.array(np.concatenate([counts, rare[other]]).astype(np.int64)))
        yield pa.RecordBatch.from_arrays(out, names=["lang", *[f"w{i + 1}" for i in range(order)], "c"])


def count_phrases(docs: DataFrame, least: int = LEAST, order: int = ORDER) -> DataFrame:
    """``lang, words, phrase, f``: every phrase of up to ``order`` words that occurs ``least`` times in its language, and per language a row
    with ``words`` 0 and the number of all words.

    Only windows of ``order`` words, padded at the end of a piece, are counted; ``ROLLUP`` sums their shorter prefixes. Windows are
    cut before a word that would make a phrase of less than ``least`` occurrences, which no counted phrase holds.
    """
    docs = docs.select("text", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang")).where("text is not null")
    share, maps = docs.sparkSession.sparkContext.broadcast, {}
    for sizes in (range(1, 3), range(3, order + 1)):
        if sizes:
            maps = maps | dict.fromkeys(sizes, frequent_phrases(docs, least, sizes, share(maps)))
    known = share(maps)
    names = [f"w{i + 1}" for i in range(order)]
    windows = docs.mapInArrow(partial(_windows, known=known, order=order), f"lang string, {', '.join(f'{x} string' for x in names)}, c bigint")
    windows = windows.groupBy("lang", *names).agg(F.sum("c").alias("c"))  # far fewer rows than ROLLUP would make of each piece's
    summed = windows.rollup("lang", *names).agg(F.sum("c").alias("f"), F.grouping_id().alias("level"))
    words = F.lit(order) - F.bit_count("level")  # the level has one bit for each column summed over
    last = reduce(lambda rest, k: F.when(F.col("words") == k, F.col(f"w{k}").isNotNull()).otherwise(rest), range(1, order + 1), F.lit(True))
    return (summed.withColumn("words", words).where((F.col("words") >= 0) & last & ((F.col("words") == 0) | (F.col("f") >= least)))
            .select("lang", "words", F.concat_ws(" ", *names).alias("phrase"), "f"))


def _slice(tokens: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(tokens, start, length), " ")


def mine_collocations(docs: DataFrame, least: int = LEAST, order: int = ORDER, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """The best phrases of every language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and into words at blanks and tabs. Candidates are phrases of two to ``order``
    words that occur ``least`` times or more (``a``, overlaps included). Cut after its first words a candidate has parts that
    occur ``l`` and ``r`` times; its score is the least ``floor(2000000 a / (l + r))`` over its cuts, ties to the shorter first part. A candidate is dropped if
    ``covered`` percent of its occurrences or more equal those of a longer candidate that contains it. ``n``: words of the language.

    Null texts have no words, a null language counts as ``und``; empty texts and tables give no rows. Repeated rows count
    each time. Numbers are exact (decimal arithmetic). Ties go to the larger ``a``, then to the phrase first in byte order.
    """
    phrases = staged(count_phrases(docs, least, order), "phrases")
    found = phrases.where("words >= 2").withColumn("t", F.split("phrase", " "))
    k, t, m = F.col("k"), F.col("t"), F.col("words")
    cuts = (found.select("lang", "phrase", F.col("f").alias("a"), "t", "words", F.explode(F.sequence(F.lit(1), m - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", _slice(t, F.lit(1), k).alias("head"), _slice(t, k + 1, m - k).alias("tail")))
    part = phrases.where("words >= 1")
    scored = (cuts.join(part.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
              .join(part.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
              .withColumn("score", F.expr("cast((cast(2000000 as decimal(8,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as bigint)"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("least")))
    inner = (found.where("words >= 3").select("lang", "f", "t", "words", F.explode(F.sequence(F.lit(2), m - 1)).alias("k"))
             .select("lang", "f", "t", "k", F.explode(F.sequence(F.lit(1), m - k + 1)).alias("at"))
             .groupBy("lang", _slice(t, F.col("at"), k).alias("phrase")).agg(F.max("f").alias("longer")))
    kept = (scored.join(inner, ["lang", "phrase"], "left")
            .where(f"longer is null or cast(100 as decimal(3,0)) * cast(longer as decimal(20,0)) < cast({covered} as decimal(3,0)) * cast(a as decimal(20,0))"))
    total = phrases.where("words = 0").select("lang", F.col("f").alias("n"))
    best = "row_number() over (partition by lang{} order by least.score desc, a desc, phrase)"
    spread = kept.withColumn("rank", F.expr(best.format(", pmod(xxhash64(phrase), 64)"))).where(F.col("rank") <= top)
    return (spread.withColumn("rank", F.expr(f"cast({best.format('')} as bigint)")).where(F.col("rank") <= top).join(total, "lang")
            .select("lang", "rank", "phrase", "a", "least.l", "least.r", "n", "least.score"))
