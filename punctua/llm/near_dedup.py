"""Near-duplicate documents with HyperMinHash registers, banding, and exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.llm.batches import GOLDEN, mix64, pieces, signed, word_hashes
from punctua.llm.common import staged
from punctua.llm.graph import components

BANDS, ROWS = 72, 8  # at the threshold of 0.8 a pair shares no band with probability 2e-6
REGISTERS = BANDS * ROWS
HEAD = 192  # registers that the estimate of a single pair reads
SLACK = 0.25  # an estimate from them that is this far below the threshold is over 7 standard errors off
FULL_SLACK = 0.12  # the same for an estimate from all registers
PARITY = 2048  # bits, each the parity of the shingles that fall on it
STRAYS, MEMBERS = 256, 1024  # rows of a block
_PRIORITY = mix64(np.arange(1, REGISTERS * REGISTERS + 1, dtype=np.uint64) * GOLDEN).reshape(REGISTERS, REGISTERS)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text: ``width`` words, or the whole sequence if it has fewer; empty without words."""
    offsets, hashes = word_hashes(texts, lower=True)
    for a, b in zip(offsets[:-1], offsets[1:]):
        n = max(b - a - width + 1, 1)
        value = np.zeros(n if b > a else 0, np.uint64)
        for i in range(min(width, b - a)):
            value = mix64(value * GOLDEN + hashes[a + i:a + i + n] + np.uint64(1))
        yield np.unique(value)


def registers(values: np.ndarray) -> np.ndarray:
    """One byte per bucket for a non-empty set: leading zeros of the bucket's least hash (4 bits) and its next 4 bits.

    An empty bucket copies the full one that comes first in its own fixed order, so also small sets fill all buckets, and two
    sets agree in a bucket with the probability of their Jaccard similarity.
    """
    least = np.zeros(REGISTERS, np.uint64)
    bucket = (values % np.uint64(REGISTERS)).astype(np.int64)
    full = np.zeros(REGISTERS, bool)
    full[bucket] = True
    least[bucket[::-1]] = values[::-1]  # ascending, so the least is written last
    empty, there = np.flatnonzero(~full), np.flatnonzero(full)
    if len(empty):
        least[empty] = least[there[_PRIORITY[np.ix_(empty, there)].argmin(1)]]
    part, exponent = np.frexp(least.astype(np.float64))
    zeros = np.minimum(64 - exponent, 15)
    return (zeros * 16 + np.minimum((part * 2 - 1) * 16, 15).astype(np.int64) % 16).astype(np.uint8)


def parity(values: np.ndarray) -> np.ndarray:
    """Bits that tell sets apart: two sets differ in at least as many shingles as bits."""
    return np.packbits(np.bincount(((values >> np.uint64(20)) % np.uint64(PARITY)).astype(np.int64), minlength=PARITY).astype(np.uint8) & 1)


def may_reach(percent: int, n_a: np.ndarray, n_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the parity bits leave room for the threshold; never false for a pair that reaches it."""
    apart = np.bitwise_count(a ^ b).sum(1, dtype=np.int64)
    return 100 * (n_a + n_b - apart) >= percent * (n_a + n_b + apart)


def collision_rate(n: np.ndarray) -> np.ndarray:
    """How often registers of unrelated sets of about ``n`` shingles agree by chance."""
    zeros = np.arange(16)
    low = np.where(zeros == 15, 0.0, 0.5 ** (zeros + 1))
    edges = (low[:, None] + (0.5 ** zeros - low)[:, None] * np.arange(17) / 16)
    draws = np.maximum(np.asarray(n, float) / REGISTERS, 1.0)[:, None, None]
    mass = (1 - edges[None, :, :-1]) ** draws - (1 - edges[None, :, 1:]) ** draws
    return (mass ** 2).sum((1, 2))


def _sign(width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("registers", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            sizes, keys, regs = [], [], []
            for values in shingle_sets(part["text"], width):
                sizes.append(len(values))
                keys.append(xxhash.xxh3_128_digest(values.tobytes()))
                regs.append(registers(values).tobytes() + parity(values).tobytes() if len(values) else None)
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(regs, pa.binary())], schema=schema)

    return run


def _set_rows(width: int):
    """The sets of members from texts of their documents; a text with another set than the member's is passed over."""
    schema = pa.schema([("doc", pa.int64()), ("values", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            sets = [v.tobytes() for v in shingle_sets(part["text"], width)]
            own = pa.array([xxhash.xxh3_128_digest(v) == key for v, key in zip(sets, part["set_key"].to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([part["doc"], pa.array(sets, pa.binary())], schema=schema).filter(own)

    return run


def _estimate(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pairs in batches:
            if len(pairs):
                a, b = (np.frombuffer(b"".join(pairs[c]), np.uint8).reshape(len(pairs), -1) for c in ("head_a", "head_b"))
                n_a, n_b = pairs["n_a"].to_numpy(), pairs["n_b"].to_numpy()
                chance = collision_rate(np.minimum(n_a, n_b))
                jaccard = ((a[:, :HEAD] == b[:, :HEAD]).mean(1) - chance) / (1 - chance)
                fits = may_reach(percent, n_a, n_b, a[:, HEAD:], b[:, HEAD:])
                yield pairs.loc[fits & (jaccard >= percent / 100 - SLACK), ["a", "b"]]

    return run


def _stray_pairs(percent: int):
    """Blocks of one band, rows in order of the block: pairs of a stray and a member of another component that may be linked.

    A pair that shares several bands is looked at in the first of them. A block is held at a time, and only likely pairs leave it.
    """

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        both = np.frombuffer(b"".join(rows["registers"]), np.uint8).reshape(len(rows), -1)
        regs, bits = np.ascontiguousarray(both[:, :REGISTERS]), both[:, REGISTERS:]
        doc, component, n = (rows[c].to_numpy() for c in ("doc", "component", "n_shingles"))
        strays, members = (np.flatnonzero(rows[c].to_numpy()) for c in ("as_stray", "as_member"))
        stray = rows["stray"].to_numpy()
        keys = regs.view(np.uint64)
        out = []
        for x in strays:
            y = members[(component[members] != component[x]) & (~stray[members] | (doc[members] > doc[x]))]
            y = y[100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x])]
            y = y[may_reach(percent, n[y], n[x], bits[y], bits[x:x + 1])]
            y = y[(keys[y] == keys[x]).argmax(1) == rows["at"].iloc[0]]
            if len(y):
                chance = collision_rate(n[x:x + 1])[0]
                jaccard = ((regs[y] == regs[x]).mean(1) - chance) / (1 - chance)
                y = y[jaccard >= percent / 100 - FULL_SLACK]
                out.append(np.stack([np.minimum(doc[y], doc[x]), np.maximum(doc[y], doc[x])], 1))
        return pd.DataFrame(np.concatenate([np.empty((0, 2), np.int64), *out]), columns=["a", "b"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for rows in batches:
            rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
            block = rows[["band", "s", "t"]]
            starts = np.flatnonzero((block != block.shift()).any(axis=1))
            for a, b in zip(starts[:-1], starts[1:]):
                yield compare(rows.iloc[a:b].reset_index(drop=True))
            held = rows.iloc[starts[-1]:].reset_index(drop=True) if len(rows) else None
        if held is not None:
            yield compare(held)

    return run


def _confirm(percent: int):
    """Rows of one (center, deal) follow each other, the center's set first; only that one set is held."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        center, base = None, None
        for rows in batches:
            out = []
            for at, member, blob in zip(rows["a"], rows["b"], rows["values"]):
                values = np.frombuffer(blob, np.uint64)
                if at == member:
                    center, base = at, values
                    continue
                assert center == at
                # both sorted: count of values found in base
                spot = np.minimum(np.searchsorted(base, values), len(base) - 1)
                common = int((base[spot] == values).sum())
                if 100 * common >= percent * (len(base) + len(values) - common):
                    out.append((at, member))
            yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return run


class _Members:
    """One row per distinct shingle set under a number of its own (``doc``), and what confirms links between them."""

    def __init__(self, docs: DataFrame, rows: DataFrame, width: int, percent: int):
        self.docs, self.rows, self.width, self.percent = docs, rows, width, percent

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` whose sizes and estimated similarity allow a link."""
        side = [self.rows.select(F.col("doc").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.concat(F.substring("registers", 1, HEAD), F.substring("registers", REGISTERS + 1, PARITY // 8)).alias(f"head_{c}"))
                for c in "ab"]
        near = pairs.join(side[0], "a").join(side[1], "b").where(
            100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b"))
        return near.select("a", "b", "head_a", "head_b", "n_a", "n_b").mapInPandas(_estimate(self.percent), "a bigint, b bigint")

    def strays(self, bands: DataFrame, component: DataFrame) -> DataFrame:
        """Likely pairs between components that share a band.

        In each band with several components, the documents outside its largest one are the query set. They meet all its documents in
        blocks of about ``STRAYS`` by ``MEMBERS`` rows.
        """
        placed = bands.join(component, bands["doc"] == component["node"], "left").select(
            "band", "at", "doc", F.coalesce("component", "doc").alias("component"))
        mixed = (placed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
                 .groupBy("band").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max_by("component", F.struct("n", "component")).alias("main"))
                 .where("most < n"))
        drawn = F.xxhash64("doc")
        s_blocks, t_blocks = F.ceil((F.col("n") - F.col("most")) / F.lit(STRAYS)), F.ceil(F.col("n") / F.lit(MEMBERS))
        rows = staged(placed.join(mixed, "band").select(
            "band", "at", "doc", "component", (F.col("component") != F.col("main")).alias("stray"), s_blocks.alias("s_blocks"), t_blocks.alias("t_blocks"),
            F.pmod(drawn, s_blocks).alias("own_s"), F.pmod(F.shiftrightunsigned(drawn, 32), t_blocks).alias("own_t")), "near-open")

        def dealt(blocks: str) -> Column:
            return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

        kept = ["band", "at", "doc", "component", "stray"]
        as_member = rows.select(*kept, dealt("s_blocks").alias("s"), F.col("own_t").alias("t"), F.lit(False).alias("as_stray"), F.lit(True).alias("as_member"))
        as_stray = rows.where("stray").select(*kept, F.col("own_s").alias("s"), dealt("t_blocks").alias("t"), F.lit(True).alias("as_stray"), F.lit(False).alias("as_member"))
        dealt_rows = as_member.union(as_stray).join(self.rows.select("doc", "n_shingles", "registers"), "doc")
        return (dealt_rows.repartition("band", "s", "t").sortWithinPartitions("band", "s", "t")
                .mapInPandas(_stray_pairs(self.percent), "a bigint, b bigint").distinct())

    def confirm(self, likely: DataFrame, name: str) -> DataFrame:
        """The pairs ``(a, b)`` with ``a <> b`` whose Jaccard similarity on the full sets reaches the threshold."""
        likely = staged(likely, f"{name}-likely")
        ends = staged(likely.select(F.col("a").alias("doc")).union(likely.select("b")).distinct(), f"{name}-ends")
        asked = self.rows.join(ends, "doc").select("doc", "doc_id", "set_key")
        sets = staged(self.docs.join(asked, "doc_id").select("doc", "set_key", "text").mapInArrow(_set_rows(self.width), "doc bigint, values binary")
                      .groupBy("doc").agg(F.max("values").alias("values")), f"{name}-sets")
        deal = F.pmod(F.xxhash64("b"), F.lit(64))  # a center with many members is dealt over tasks
        members = likely.join(sets, likely["b"] == sets["doc"]).select("a", "b", deal.alias("deal"), "values")
        centers = likely.select("a", deal.alias("deal")).distinct().join(sets, F.col("a") == F.col("doc")).select("a", F.col("a").alias("b"), "deal", "values")
        rows = centers.union(members).repartition("a", "deal").sortWithinPartitions("a", "deal", F.col("a") != F.col("b"))
        return staged(rows.select("a", "b", "values").mapInPandas(_confirm(self.percent), "a bigint, b bigint"), f"{name}-links")


def _band_keys() -> Column:
    return F.posexplode(F.array(*[F.xxhash64(F.lit(i), F.substring("registers", i * ROWS + 1, ROWS)) for i in range(BANDS)])).alias("at", "band")


def near_groups(docs: DataFrame, width: int = 2, percent: int = 80) -> DataFrame:
    """Groups of near-duplicates: ``doc_id, n_shingles, component_id, kept``, one row per document.

    Two documents are linked if their sets of ``width``-word shingles (A-Z lower-cased) have a Jaccard similarity of
    at least ``percent`` percent; ``component_id`` is the smallest id reachable over links.

    1. Documents with one set are one member, numbered by its set. Compressed registers are banded; members that share
       a band are candidates.
    2. Every member of a band meets the band's smallest member. Where a band then still holds several components, the documents outside
       the largest meet all its documents, in blocks. Pairs inside one component need no test, so a
       group of copies costs links in proportion to its members, and no candidate goes untested if it could join two components.
    3. Candidates pass a bound from parity bits and the collision-corrected estimate, and are confirmed on the full sets.

    Documents without words (or with null text) are empty and linked with nothing. Rows that repeat a ``doc_id`` with one
    text get equal rows; differing texts under one id are linked through that id. A null id is its own class: it is returned with
    ``component_id`` null and ``kept`` true. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed_docs = staged(docs.mapInArrow(_sign(width), "doc_id bigint, n_shingles bigint, set_key binary, registers binary"), "near-signed")
    usable = signed_docs.where("n_shingles > 0 and doc_id is not null")
    members = usable.groupBy("set_key").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"))
    members = staged(members.withColumn("doc", F.monotonically_increasing_id()), "near-members")  # the numbers are fixed by being written
    sets = _Members(docs.where("doc_id is not null"), members, width, percent)

    keyed = members.select("doc", _band_keys())
    shared = keyed.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("doc").alias("pivot")).where("size > 1").drop("size")
    bands = staged(keyed.join(shared, "band"), "near-bands")
    stars = bands.where("doc <> pivot").select(F.col("pivot").alias("a"), F.col("doc").alias("b")).distinct()
    links = sets.confirm(sets.likely(stars), "near-star")
    links = links.union(sets.confirm(sets.strays(bands, components(links)), "near-stray"))

    first = [members.select(F.col("doc").alias(c), F.col("doc_id").alias(f"id_{c}")) for c in "ab"]
    between = links.join(first[0], "a").join(first[1], "b").select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    same_set = usable.select(F.col("doc_id").alias("b"), "set_key").join(members.select("set_key", F.col("doc_id").alias("a")), "set_key").select("a", "b")
    component = components(between.union(same_set))
    found = signed_docs.join(component, signed_docs["doc_id"] == component["node"], "left")
    smallest = F.coalesce("component", "doc_id")
    return found.select("doc_id", "n_shingles", smallest.alias("component_id"), F.coalesce(F.col("doc_id") == smallest, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each near-duplicate group; rows that repeat an id stay or go together."""
    dropped = staged(near_groups(docs, width, percent).where("not kept").select("doc_id").distinct(), "near-dropped")
    return docs.join(dropped, docs["doc_id"] == dropped["doc_id"], "left_anti")
