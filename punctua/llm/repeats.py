"""Windows of symbols that also start earlier in a corpus: routing by content, shared by the two substring operators.

A window of ``k`` symbols is routed by its anchor: the leftmost smallest hash among its ``q``-grams. Equal windows have equal anchors at the same
place, wherever they occur, so only occurrences of one anchor hash have to be compared. Consecutive windows share an anchor, so an
anchor and its run of windows (about ``(k - q) / 2`` of them) travel as one row of five numbers. One of them, ``body``, is the hash of the text:
a document is an id and a text, so what is found in one text of an id is not cut from another, and texts of one id are not compared.

1. :func:`_route`: anchors of every document. Per anchor hash, runs whose whole text is equal are copies of their first occurrence.
2. Anchors with several different runs are *open*: their contexts (the text of the run) are cut out and brought together.
   An index over these contexts (given by the operator) says which windows occur in an earlier context.
3. Anchors with over ``HOT`` different contexts are not brought together: their windows are dealt one by one by the hash of the window.

Rows of a key are compared while they stream by in order, so memory does not grow with the copies of a text, and each task first removes
the copies it can see itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.llm.batches import GOLDEN, mix64, pieces, signed
from punctua.llm.common import staged

BLOCK_BITS = 22  # symbols handled at once; longer texts are cut into blocks that overlap by k - 1
HOT = 2000  # contexts of one anchor hash beyond which its windows are dealt one by one
SHARD = 8000  # contexts of one index
NO_ID = -(1 << 63)  # stands for a null id
_BASE = 0x9E6C63D0676A9A99
_RUN, _FLAG = 10, 1 << 20  # bits of each offset in a packed place; mark of a copy

#: Symbols of texts: ``(offsets, hashed values, raw values)``
Symbols = Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]
#: ``(contexts, offsets, heads, k) -> windows``: for contexts in order of occurrence, where in ``contexts`` each window occurs first
Index = Callable[[np.ndarray, np.ndarray, np.ndarray, int], np.ndarray]


def grams(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` values, by doubling."""
    size, level, done, out = 1, values, 0, None
    while True:
        if n & size:  # append the part of this size behind what is there
            part = level[done:]
            power = np.uint64(pow(_BASE, size, 1 << 64))
            out = part if out is None else out[:len(part)] * power + part
            done += size
        if done == n:
            return mix64(out[:max(len(values) - n + 1, 0)])
        level = level[:max(len(level) - size, 0)] * np.uint64(pow(_BASE, size, 1 << 64)) + level[size:]
        size *= 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every run of ``width`` values, in linear time."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` for ``counts[i]`` values each."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def _runs(values: np.ndarray, offsets: np.ndarray, k: int, q: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of anchor runs ``(document, anchor, first window, last window, anchor hash, hash of the run)``, places counted in the document."""
    most = 1 << BLOCK_BITS
    if len(values) > most:
        for d, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            for s in range(a, max(b - k + 1, a), most - k):
                e = min(s + most - 1, b)
                for _, anchor, low, high, h, whole in _runs(values[s:e], np.array([0, e - s]), k, q):
                    yield np.full(len(anchor), d), anchor + (s - a), low + (s - a), high + (s - a), h, whole
        return
    counts = np.maximum(np.diff(offsets) - k + 1, 0)
    if not counts.sum():
        return
    small, long = grams(values, q), grams(values, k)
    mask = np.uint64(most - 1)
    least = sliding_min((small & ~mask) | np.arange(len(small), dtype=np.uint64), k - q + 1)
    at = _spread(offsets[:-1], counts)
    document = np.repeat(np.arange(len(counts)), counts)
    anchor = (least[at] & mask).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (document[1:] != document[:-1])]))
    last = np.append(first[1:], len(at)) - 1
    low, high, anchor, document = at[first], at[last], anchor[first], document[first]
    whole = mix64(long[low] * GOLDEN + long[high] + (high - low).astype(np.uint64))
    start = offsets[document]
    yield document, anchor - start, low - start, high - start, mix64(small[anchor] + GOLDEN), whole


def _pack(anchor: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return (anchor << (2 * _RUN + 1)) | ((anchor - low) << _RUN) | (anchor - high)


def _unpack(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(anchor, first window, last window)``"""
    anchor = at >> (2 * _RUN + 1)
    return anchor, anchor - ((at >> _RUN) & ((1 << _RUN) - 1)), anchor - (at & ((1 << _RUN) - 1))


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in columns.values()], names=list(columns))


def _copies(keys: tuple[np.ndarray, ...], doc: np.ndarray, body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by key and place, and which rows in that order have their key at an earlier place. Repeats of one place are left out."""
    order = np.lexsort((at, body, doc, *keys[::-1]))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    copy, first, _ = _elsewhere(new, doc[order], body[order], at[order], (0, 0, 0))
    return order[first | copy], copy[first | copy]


def _elsewhere(new: np.ndarray, doc: np.ndarray, body: np.ndarray, at: np.ndarray, before: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray, tuple[int, int, int]]:
    """For rows in order of place: which have their group in an earlier place, which are the first of their group, or of it within another text of the first
    one's id; and ``(id, text, first place)`` to go on with. ``before`` is what the rows go on from."""
    if not len(new):
        return new, new, before
    group = np.cumsum(new)
    first_doc = np.concatenate([[before[0]], doc[new]])[group]
    fresh = new.copy()
    fresh[1:] |= body[1:] != body[:-1]
    fresh[0] |= body[0] != before[1]
    first_at = np.concatenate([[before[2]], at[fresh]])[np.cumsum(fresh)]
    own = doc == first_doc
    return ~own | (at != first_at), own & fresh, (first_doc[-1], body[-1], first_at[-1])


def _route(symbols: Symbols, k: int, q: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, most=2 << 20):
            ids, bodies = part["doc_id"].to_numpy(), part["body"].to_numpy()
            offsets, values, _ = symbols(part["text"])
            for document, anchor, low, high, h, whole in _runs(values, offsets, k, q):
                doc, body, at = ids[document], bodies[document], _pack(anchor, low, high)
                order, copy = _copies((h, whole), doc, body, at)
                h, whole, doc, body, at = h[order], whole[order], doc[order], body[order], at[order]
                h = np.where(copy, mix64(at.astype(np.uint64) * GOLDEN), h)  # settled: deal it anywhere
                yield _batch(h=signed(h), whole=signed(whole), doc=doc, body=body, at=at | np.where(copy, _FLAG, 0))

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From anchors in order of (hash, run, place): copies of an earlier run (``open`` false) and anchors with several runs (``open`` true)."""
    seen_h = seen_whole = waiting = None
    place = 0, 0, 0
    for batch in batches:
        h, whole, doc, body, at = (batch[c].to_numpy() for c in ("h", "whole", "doc", "body", "at"))
        done = (at & _FLAG) > 0
        out = [(h[done], doc[done], body[done], at[done] & ~_FLAG, False)]
        h, whole, doc, body, at = h[~done], whole[~done], doc[~done], body[~done], at[~done]
        if len(h):
            new_h, new_whole = np.ones(len(h), bool), np.ones(len(h), bool)
            new_h[1:] = h[1:] != h[:-1]
            new_whole[1:] = whole[1:] != whole[:-1]
            if seen_h is not None and h[0] == seen_h:
                new_h[0], new_whole[0] = False, whole[0] != seen_whole
            copy, first, place = _elsewhere(new_whole | new_h, doc, body, at, place)
            group = np.cumsum(new_h)
            several = np.zeros(group[-1] + 1, bool)
            several[group[first & ~new_h]] = True
            if waiting is not None and several[0]:
                out.append((*waiting, True))
                waiting = None
            is_open = first & (~new_h | several[group])
            out += [(h[copy], doc[copy], body[copy], at[copy], False), (h[is_open], doc[is_open], body[is_open], at[is_open], True)]
            if group[-1] > 0:
                start = np.flatnonzero(new_h)[-1:]
                waiting = None if several[-1] else (h[start], doc[start], body[start], at[start])
            seen_h, seen_whole = h[-1], whole[-1]
        columns = [np.concatenate([o[i] for o in out]) for i in range(4)]
        yield _batch(**dict(zip(("h", "doc", "body", "at"), columns)), open=np.concatenate([np.full(len(o[0]), o[4]) for o in out]))


def _cut(symbols: Symbols, k: int):
    """Contexts of the open anchors of a document; the windows of hot anchors one by one, with their hash as key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, most=2 << 20):
            offsets, values, raw = symbols(part["text"])
            rows = part["anchors"].flatten()
            counts = np.diff(part["anchors"].offsets.to_numpy())
            start, doc, body = (np.repeat(v, counts) for v in (offsets[:-1], part["doc_id"].to_numpy(), part["body"].to_numpy()))
            h, at, hot = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("h", "at", "hot"))
            _, low, high = _unpack(at)
            cold = ~hot
            size = (high - low + k)[cold]
            text = raw[_spread((start + low)[cold], size)]
            ends = np.concatenate([[0], np.cumsum(size * raw.itemsize)]).astype(np.int32)
            context = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(text.tobytes())])
            yield _batch(h=h[cold], doc=doc[cold], body=body[cold], at=at[cold], context=context)
            if hot.any():
                each = (high - low + 1)[hot]
                place, owner, text_of = _spread(low[hot], each), np.repeat(doc[hot], each), np.repeat(body[hot], each)
                key = mix64(grams(values, k)[_spread((start + low)[hot], each)] ^ GOLDEN)
                packed = _pack(place, place, place)
                order, copy = _copies((key,), owner, text_of, packed)
                key = np.where(copy, mix64(packed[order].astype(np.uint64) * GOLDEN), key[order])
                yield _batch(h=signed(key), doc=owner[order], body=text_of[order], at=packed[order] | np.where(copy, _FLAG, 0), context=pa.nulls(len(key), pa.binary()))

    return run


def _resolve(index: Index, k: int, dtype: type):
    """Windows that also start earlier, from contexts in order of (key, place): ``doc, body, low, high``."""

    def search(rows: list[tuple]) -> pa.RecordBatch:
        h, doc, body, at = (np.concatenate([r[i] for r in rows]) for i in range(4))
        blobs = [b for r in rows for b in r[4]]
        contexts = np.frombuffer(b"".join(blobs), dtype)
        offsets = np.concatenate([[0], np.cumsum([len(b) for b in blobs])]) // np.dtype(dtype).itemsize
        _, low, high = _unpack(at)
        first = index(contexts, offsets, h, k)
        counts = high - low + 1
        place, owner = _spread(low, counts), np.repeat(np.arange(len(doc)), counts)
        earlier = np.flatnonzero(first != _spread(offsets[:-1], counts))
        first, owner, place = first[earlier], owner[earlier], place[earlier]
        context = np.searchsorted(offsets, first, "right") - 1
        first_place = low[context] + first - offsets[context]  # of one place there may be several contexts, of repeated rows
        other = np.flatnonzero((doc[context] == doc[owner]) & (body[context] != body[owner]))
        if len(other):  # first in another text of the same id: what counts is the first place in this one
            other = other[np.lexsort((place[other], body[owner[other]], first[other]))]
            fresh = np.ones(len(other), bool)
            fresh[1:] = (first[other][1:] != first[other][:-1]) | (body[owner[other]][1:] != body[owner[other]][:-1])
            first_place[other] = place[other][fresh][np.cumsum(fresh) - 1]
        again = (doc[context] != doc[owner]) | (first_place != place)
        return _batch(doc=doc[owner[again]], body=body[owner[again]], low=place[again], high=place[again])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, last, first = [], 0, None, (0, 0, 0)
        for batch in batches:
            h, doc, body, at = (batch[c].to_numpy() for c in ("h", "doc", "body", "at"))
            lone = batch["context"].is_null().to_numpy(zero_copy_only=False)
            if lone.any():
                key, owner, text_of, place = h[lone], doc[lone], body[lone], at[lone]
                new = np.concatenate([[last is None or key[0] != last], key[1:] != key[:-1]])
                again, _, first = _elsewhere(new, owner, text_of, place, first)
                again |= (place & _FLAG) > 0
                last = key[-1]
                window = place[again] >> (2 * _RUN + 1)
                yield _batch(doc=owner[again], body=text_of[again], low=window, high=window)
            full = np.flatnonzero(~lone)
            if len(full):
                blobs = batch["context"].take(pa.array(full)).to_pylist()
                h, doc, body, at = h[full], doc[full], body[full], at[full]
                fresh = np.ones(len(h), bool)  # repeated rows bring the same context again
                fresh[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]) | (body[1:] != body[:-1]) | (at[1:] != at[:-1])
                h, doc, body, at, blobs = h[fresh], doc[fresh], body[fresh], at[fresh], [b for b, f in zip(blobs, fresh) if f]
                edge = 0
                if n >= SHARD:  # a group of one key stays together
                    fresh = np.flatnonzero(h != held[-1][0][-1])
                    edge = fresh[0] if len(fresh) else len(h)
                    held.append((h[:edge], doc[:edge], body[:edge], at[:edge], blobs[:edge]))
                    n += edge
                    if edge < len(h):
                        yield search(held)
                        held, n = [], 0
                if edge < len(h):
                    held.append((h[edge:], doc[edge:], body[edge:], at[edge:], blobs[edge:]))
                    n += len(h) - edge
        if held:
            yield search(held)

    return run


def with_body(docs: DataFrame) -> DataFrame:
    """``docs`` with ``body``, which tells the texts of one id apart."""
    return docs.withColumn("body", F.xxhash64("text"))


def earlier_windows(docs: DataFrame, symbols: Symbols, index: Index, dtype: type, k: int, q: int) -> DataFrame:
    """Runs of windows that also start earlier (smaller id, or same document and earlier start): ``doc, body, low, high``, a row per run.

    ``docs`` has ``doc_id`` (not null), ``text`` and ``body`` (:func:`with_body`). The result may hold several rows for one window.
    """
    anchors = docs.mapInArrow(_route(symbols, k, q), "h bigint, whole bigint, doc bigint, body bigint, at bigint")
    settled = staged(anchors.repartition("h").sortWithinPartitions("h", "whole", "doc", "body", "at")
                     .mapInArrow(_settle, "h bigint, doc bigint, body bigint, at bigint, open boolean"), "repeats-settled")
    opened = settled.where("open").select("h", "doc", "body", "at")
    hot = opened.groupBy("h").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > HOT).select("h", F.lit(True).alias("hot"))
    by_doc = staged(opened.join(hot, "h", "left").groupBy("doc", "body").agg(
        F.collect_list(F.struct("h", "at", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("anchors")), "repeats-open")
    contexts = (docs.join(by_doc, (docs["doc_id"] == by_doc["doc"]) & (docs["body"] == by_doc["body"])).select("doc_id", docs["body"], "text", "anchors")
                .mapInArrow(_cut(symbols, k), "h bigint, doc bigint, body bigint, at bigint, context binary"))
    found = staged(contexts.repartition("h").sortWithinPartitions("h", "doc", "body", "at")
                   .mapInArrow(_resolve(index, k, dtype), "doc bigint, body bigint, low bigint, high bigint"), "repeats-found")
    anchor, run = F.shiftright("at", 2 * _RUN + 1), (1 << _RUN) - 1
    copies = settled.where("not open").select(
        "doc", "body", (anchor - F.shiftright("at", _RUN).bitwiseAND(run)).alias("low"), (anchor - F.col("at").bitwiseAND(run)).alias("high"))
    return copies.union(found)


def covered(low: np.ndarray, high: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of ``n`` symbols lie in a window that starts from ``low`` to ``high``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.minimum(low, n), 1)
    np.add.at(edge, np.minimum(high + k, n), -1)
    return np.cumsum(edge[:n]) > 0


def with_windows(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``docs`` with the windows of each document as arrays ``low`` and ``high`` (null where there are none)."""
    lists = windows.groupBy("doc", "body").agg(F.collect_list(F.struct("low", "high")).alias("x")).select("doc", "body", F.col("x.low").alias("low"), F.col("x.high").alias("high"))
    return docs.join(lists, (docs["doc_id"] == lists["doc"]) & (docs["body"] == lists["body"]), "left").drop("doc").drop(docs["body"]).drop(lists["body"])
