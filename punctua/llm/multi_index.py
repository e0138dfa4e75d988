"""Nearest vectors by an inverted multi-index: both halves of a vector are quantised, cells are pairs of centroids."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctua.llm.common import staged

CENTROIDS = 64  # per half
SAMPLE = 20_000  # vectors from which centroids are learnt
ROUNDS = 10
RECALL = 0.95  # share of true neighbours that the depth of search has to reach on the sampled queries
CALIBRATE = 256  # queries searched by brute force to set the depth
SHARD = 8192  # vectors of a block
QUERIES = 32_768  # queries of a block
_CHUNK = 1024
_SCHEMA = "query_id long, rank int, vec_id long, score double"


@dataclass
class MultiIndex:
    """``entries`` (``vec_id, vector, cell``) are written; the rest is bounded: two codebooks and one number for each cell."""

    entries: DataFrame
    first: np.ndarray
    second: np.ndarray
    sizes: np.ndarray  # vectors of each cell, one row for each centroid of the first half

    def scores(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.first.shape[1]
        return vectors[:, :half] @ self.first.T, vectors[:, half:] @ self.second.T


def _matrix(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.empty((0, 0))
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmax(points @ centres.T - 0.5 * (centres * centres).sum(1), axis=1)


def _codebook(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` centres by Lloyd's method; a centre that loses its points stays where it is."""
    if not points.shape[1]:
        return np.zeros((1, 0))
    distinct = np.unique(points, axis=0)
    centres = distinct[np.random.default_rng(seed).permutation(len(distinct))[:k]].copy()
    for _ in range(ROUNDS):
        own = _nearest(points, centres)
        n = np.bincount(own, minlength=len(centres))
        sums = np.stack([np.bincount(own, points[:, j], len(centres)) for j in range(points.shape[1])], axis=1)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _cells(batches: Iterator[pa.RecordBatch], first: np.ndarray, second: np.ndarray) -> Iterator[pa.RecordBatch]:
    half = first.shape[1]
    for batch in batches:
        x = _matrix(batch["vector"])
        cell = _nearest(x[:, :half], first) * len(second) + _nearest(x[:, half:], second) if len(x) else np.empty(0)
        yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["vector"], pa.array(cell.astype(np.int32))], names=["vec_id", "vector", "cell"])


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` of the rows that take part: id and vector are there, all components are finite and some is not 0, and the length is the commonest."""
    v = F.col("embedding")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & v.isNotNull() & fine).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector"))
    common = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vector") == (common["d"] if common else 0))


def build_index(vectors: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE, seed: int = 7) -> MultiIndex | None:
    """The index over all usable rows of ``vectors`` (``vec_id, embedding``); None if there are none.

    Centroids are learnt from at most ``sample`` vectors, those whose ids hash lowest; every vector is filed.
    """
    rows = usable(vectors)
    n = rows.count()
    if not n:
        return None
    order = F.xxhash64("vec_id", F.lit(seed))
    share = min(1.0, 2 * sample / n)
    drawn = rows.where(order <= min(2**63 - 1, int((share - 0.5) * 2**64))).orderBy(order, "vec_id").limit(sample).toArrow()
    x = _matrix(drawn["vector"].combine_chunks()) if len(drawn) else _matrix(rows.limit(1).toArrow()["vector"].combine_chunks())
    half = x.shape[1] // 2
    first, second = _codebook(x[:, :half], centroids, seed), _codebook(x[:, half:], centroids, seed + 1)
    kind = rows.schema["vector"].dataType.simpleString()
    entries = staged(rows.mapInArrow(partial(_cells, first=first, second=second), f"vec_id long, vector {kind}, cell int"), "multi-index")
    sizes = np.zeros(len(first) * len(second), np.int64)
    for cell, count in entries.groupBy("cell").count().collect():  # at most centroids squared
        sizes[cell] = count
    return MultiIndex(entries, first, second, sizes.reshape(len(first), len(second)))


def traverse(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, depth: float) -> list[int]:
    """Cells in descending order of ``a[i] + b[j]`` until they hold ``depth`` vectors.

    A heap has the best pair not taken yet of each centroid ``i`` that has been reached.
    """
    i_of, j_of = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
    sa, sb = (-a[i_of]).tolist(), (-b[j_of]).tolist()
    held = sizes[np.ix_(i_of, j_of)].tolist()
    names = (i_of[:, None] * len(b) + j_of).tolist()
    heap, got, cells, m, n = [(sa[0] + sb[0], 0, 0)], 0, [], len(sa), len(sb)
    while heap and got < depth:
        _, i, j = heap[0]
        if j + 1 < n:
            heapq.heapreplace(heap, (sa[i] + sb[j + 1], i, j + 1))
        else:
            heapq.heappop(heap)
        if j == 0 and i + 1 < m:
            heapq.heappush(heap, (sa[i + 1] + sb[0], i + 1, 0))
        if held[i][j]:
            got += held[i][j]
            cells.append(names[i][j])
    return cells


def _exact(queries: np.ndarray, vectors: np.ndarray, qs: np.ndarray, vs: np.ndarray) -> np.ndarray:
    """Inner products of pairs, each summed in the same order wherever it is computed."""
    out = np.empty(len(qs))
    for at in range(0, len(qs), 1 << 16):
        part = slice(at, at + (1 << 16))
        out[part] = np.add.reduce(queries[qs[part]] * vectors[vs[part]], axis=1)
    return out


def _best(queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, ids: np.ndarray, allowed, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, vec_id, score)``: the ``k`` best rows of a block for every query, ties to the smaller id, without rows that have the query's id.

    Equal vectors are scored once, each with its ``k + 1`` smallest ids. ``allowed(queries, distinct vector of each row)`` gives approximate scores, minus infinity
    for what a query does not reach.
    """
    distinct, place = np.unique(vectors, axis=0, return_inverse=True)
    place = place.ravel()
    order = np.lexsort((ids, place))
    by, sorted_ids = place[order], ids[order]
    same_id = np.unique(ids, return_counts=True)[1].max(initial=1)
    fresh = np.ones(len(by), bool)
    fresh[1:] = (by[1:] != by[:-1]) | (sorted_ids[1:] != sorted_ids[:-1])  # a repeated row counts once
    by, sorted_ids = by[fresh], sorted_ids[fresh]
    begins = np.searchsorted(by, np.arange(len(distinct)))
    nth = np.arange(len(by)) - begins[by]
    by, sorted_ids = by[nth <= k], sorted_ids[nth <= k]
    begins = np.searchsorted(by, np.arange(len(distinct) + 1))
    slack = 1e-9 * np.sqrt((distinct * distinct).sum(1).max(initial=0))
    out = []
    for at in range(0, len(queries), _CHUNK):
        q = queries[at:at + _CHUNK]
        scores = allowed(at, q, distinct, place)
        if not scores.size:
            continue
        most = min(k + same_id, scores.shape[1])
        bound = -np.partition(-scores, most - 1, axis=1)[:, most - 1] - slack * np.sqrt((q * q).sum(1))
        qs, vs = np.nonzero((scores >= bound[:, None]) & (scores > -np.inf))
        exact = _exact(q, distinct, qs, vs)
        copies = (begins[1:] - begins[:-1])[vs]
        pair = np.repeat(np.arange(len(qs)), copies)
        found = sorted_ids[begins[vs][pair] + np.arange(len(pair)) - np.repeat(np.cumsum(copies) - copies, copies)]
        qs, exact = qs[pair], exact[pair]
        other = found != own[at + qs]
        qs, exact, found = qs[other], exact[other], found[other]
        rank = np.lexsort((found, -exact, qs))
        qs, exact, found = qs[rank], exact[rank], found[rank]
        ranked = np.arange(len(qs)) - np.searchsorted(qs, qs)
        out.append((at + qs[ranked < k], found[ranked < k], exact[ranked < k]))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def _truth(batches: Iterator[pa.RecordBatch], queries: np.ndarray, own: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """For a few queries the ``k`` best rows of each batch with their cells: ``query, score, cell``."""
    for batch in batches:
        x, ids = _matrix(batch["vector"]), batch["vec_id"].to_numpy()
        if not len(x):
            continue
        scores = queries @ x.T
        scores[own[:, None] == ids] = -np.inf
        most = min(k, len(x))
        best = np.argpartition(-scores, most - 1, axis=1)[:, :most]
        got = np.take_along_axis(scores, best, axis=1)
        cells = batch["cell"].to_numpy()[best]
        query = np.repeat(np.arange(len(queries)), most)
        full = np.isfinite(got.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(query[full].astype(np.int32)), pa.array(got.ravel()[full]), pa.array(cells.ravel()[full])], names=["query", "score", "cell"])


def search_depth(index: MultiIndex, queries: DataFrame, k: int, recall: float = RECALL, calibrate: int = CALIBRATE) -> int:
    """How many vectors a query has to reach so that ``recall`` of the true neighbours of a sample of queries lie among them.

    The sample is the ``calibrate`` queries whose ids hash lowest; they are compared with every row. The depth grows with the table as the true
    neighbours ask for.
    """
    drawn = queries.orderBy(F.xxhash64("query_id", F.lit(11)), "query_id").limit(calibrate).toArrow()
    if not len(drawn):
        return 1
    x, own = _matrix(drawn["vector"].combine_chunks()), drawn["query_id"].to_numpy()
    near = index.entries.mapInArrow(partial(_truth, queries=x, own=own, k=k), "query int, score double, cell int")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "cell")
    true = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query", "cell").toArrow()
    a, b = index.scores(x)
    flat, needed = index.sizes.ravel(), []
    cells_of = pd.DataFrame({"q": true["query"].to_numpy(), "c": true["cell"].to_numpy()}).groupby("q")["c"]
    for q, cells in cells_of:
        order = traverse(a[q], b[q], index.sizes, np.inf)
        before = dict(zip(order, np.concatenate([[0], np.cumsum(flat[order])])))
        needed += [before[c] + 1 for c in cells]
    return int(np.quantile(needed, recall, method="higher")) if needed else 1


def _probes(batches: Iterator[pa.RecordBatch], index_parts, depth: int, shard_of: np.ndarray, salts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Queries dealt to the shards of the cells they reach: ``shard, salt, query_id, vector, cells``."""
    first, second, sizes = index_parts
    index = MultiIndex(None, first, second, sizes)
    for batch in batches:
        x = _matrix(batch["vector"])
        if not len(x):
            continue
        a, b = index.scores(x)
        rows, shards, salt, cells = [], [], [], []
        for q in range(len(x)):
            reached = np.sort(np.array(traverse(a[q], b[q], sizes, depth), np.int64))
            own = shard_of[reached]
            cut = np.flatnonzero(np.diff(own, prepend=-1))
            for shard, part in zip(own[cut], np.split(reached, cut[1:])):
                for s in range(salts[shard]):
                    rows.append(q), shards.append(shard), salt.append(s), cells.append(part.astype(np.int32))
        taken = batch.take(pa.array(rows, pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(salt, pa.int32()), taken["query_id"], taken["vector"], pa.array(cells, pa.list_(pa.int32()))],
                                         names=["shard", "salt", "query_id", "vector", "cells"])


def _rerank(entries: pa.Table, probes: pa.Table, k: int) -> pa.Table:
    """The ``k`` best entries of a block for each probe, among the cells that the probe reaches, by the inner product of the vectors themselves."""
    names = ["query_id", "twin", "vec_id", "score"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
    if not len(entries) or not len(probes):
        return pa.table([pa.array([], t) for t in kinds], names=names)
    x, ids, cells = _matrix(entries["vector"].combine_chunks()), entries["vec_id"].to_numpy(), entries["cell"].to_numpy()
    q, own = _matrix(probes["vector"].combine_chunks()), probes["query_id"].to_numpy()
    lists = probes["cells"].combine_chunks()
    reached, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()

    def allowed(at, chunk, distinct, place):
        scores = np.full((len(chunk), len(distinct)), -np.inf)
        asked = reached[offsets[at]:offsets[at + len(chunk)]]
        who = np.repeat(np.arange(len(chunk)), np.diff(offsets[at:at + len(chunk) + 1]))
        order = np.argsort(asked, kind="stable")
        asked, who = asked[order], who[order]
        for cell in np.unique(cells):
            low, high = np.searchsorted(asked, [cell, cell + 1])
            if low < high:
                columns = np.unique(place[cells == cell])
                scores[np.ix_(who[low:high], columns)] = chunk[who[low:high]] @ distinct[columns].T
        return scores

    qs, found, exact = _best(q, own, x, ids, allowed, k)
    return pa.table([pa.array(own[qs]), pa.array(probes["twin"].to_numpy()[qs]), pa.array(found), pa.array(exact)], names=names)


def search(index: MultiIndex | None, queries: DataFrame, k: int = 20, recall: float = RECALL) -> DataFrame:
    """The ``k`` best found vectors of every row of ``queries`` (``query_id, vector``): ``query_id, rank, vec_id, score``.

    Nearness is the inner product, in double precision; ties go to the smaller id. A query reaches cells by descending summed score of their two
    centroids until they hold as many vectors as :func:`search_depth` asks for, and at least ``k``; all vectors of those cells are compared
    with it. Vectors and queries meet in blocks of one shard of cells; a cell of any size is split over several blocks.

    Rows with the query's id are never its neighbours. Repeated rows count once; of different vectors under one id each is a candidate, and
    each a query with a list of its own. If fewer than ``k`` other rows exist, all are returned. No usable row gives no rows.
    """
    spark = queries.sparkSession
    if index is None:
        return spark.createDataFrame([], _SCHEMA)
    queries = staged(queries.dropDuplicates(["query_id", "vector"]).withColumn("twin", F.xxhash64("vector")), "multi-queries")
    twins = index.entries.groupBy("vec_id").count().agg(F.max("count")).first()[0]
    depth = max(search_depth(index, queries, k, recall), (k + 1) * twins)
    flat = index.sizes.ravel()
    shard_of, salts, filled = np.zeros(len(flat), np.int64), [1], 0
    for cell, size in enumerate(flat):  # one number for each pair of centroids
        if filled and filled + size > SHARD:
            salts.append(1)
            filled = 0
        shard_of[cell] = len(salts) - 1
        filled += size
        salts[-1] = max(1, -(-filled // SHARD))
    salts = np.array(salts)
    kind = queries.schema["vector"].dataType.simpleString()
    parts = (index.first, index.second, index.sizes)
    probes = queries.repartition("query_id").mapInArrow(partial(_probes, index_parts=parts, depth=depth, shard_of=shard_of, salts=salts),
                                                        f"shard int, salt int, query_id long, vector {kind}, cells array<int>")
    probes = staged(probes.withColumn("twin", F.xxhash64("vector")), "multi-probes")
    blocks = probes.groupBy("shard", "salt").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("blocks"))
    shards = spark.createDataFrame(pd.DataFrame({"cell": np.arange(len(flat)), "shard": shard_of, "salts": salts[shard_of]}), "cell int, shard int, salts int")
    filed = (index.entries.join(F.broadcast(shards), "cell").withColumn("salt", F.pmod(F.xxhash64("vec_id", "vector"), "salts").cast("int"))
             .join(blocks, ["shard", "salt"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("shard", "salt", "block", "vec_id", "vector", "cell"))
    asked = (probes.join(blocks, ["shard", "salt"]).withColumn("block", F.pmod(F.xxhash64("query_id", "twin"), "blocks").cast("int"))
             .select("shard", "salt", "block", "query_id", "vector", "cells", "twin"))
    keys = ["shard", "salt", "block"]
    found = filed.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(partial(_rerank, k=k), "query_id long, twin long, vec_id long, score double")
    best = Window.partitionBy("query_id", "twin").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_vectors(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """:func:`search` over ``vectors`` (``vec_id, embedding``) for the rows whose id ``every`` divides.

    Rows whose id or vector is null, and vectors that are zero, hold a null or non-finite component or have another length than most, take no part.
    """
    index = build_index(vectors)
    if index is None:
        return search(None, vectors)
    return search(index, index.entries.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector"), k)
