"""Collocations, the multi-index and the Merkle manifest against brute force, on edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from punctua.llm.collocations import count_phrases, mine_collocations
from punctua.llm.merkle import build_manifest, extract_proofs, fold, verify_documents
from punctua.llm.multi_index import build_index, nearest_vectors, search, traverse

EXTRA = {"phrase": "x", "rank": 1, "words": 2, "f": 3, "tree": "t", "at": 4, "hash": "h", "n": 5, "row": 6, "c": 7, "w1": "w", "cell": 8, "vector": 9, "query_id": 10}
EXTRA_SCHEMA = ", ".join(f"{k} {'string' if isinstance(v, str) else 'bigint'}" for k, v in EXTRA.items())


def documents(spark, rows):
    """``(doc_id, text, lang, source)`` rows as documents with extra columns named like inner ones."""
    data = [(i, t, la, s, len(t) if t is not None else None, *EXTRA.values()) for i, t, la, s in rows]
    return spark.createDataFrame(data, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {EXTRA_SCHEMA}").repartition(3)


def brute_phrases(rows, order=4):
    counts, total = Counter(), Counter()
    for _, text, lang, _ in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            total[lang or "und"] += len(words)
            for k in range(1, order + 1):
                counts.update((lang or "und", *words[i:i + k]) for i in range(len(words) - k + 1))
    return counts, total


def brute_collocations(rows, least, top, order=4):
    f, total = brute_phrases(rows, order)
    found = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    inner = Counter()
    for p, a in found.items():
        for k in range(2, len(p) - 1):
            for i in range(1, len(p) - k + 1):
                q = (p[0], *p[i:i + k])
                inner[q] = max(inner[q], a)
    out = []
    for p, a in found.items():
        if 100 * inner[p] >= 80 * a:
            continue
        score, _, left, right = min(((2000000 * a // (f[p[:k + 1]] + f[(p[0], *p[k + 1:])])), k, f[p[:k + 1]], f[(p[0], *p[k + 1:])]) for k in range(1, len(p) - 1))
        out.append((p[0], " ".join(p[1:]), a, left, right, total[p[0]], score))
    ranked = []
    for lang in sorted({x[0] for x in out}):
        best = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:top]
        ranked += [(x[0], i + 1, *x[1:]) for i, x in enumerate(best)]
    return sorted(ranked)


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(12)] + ["Ärger", "été", "NEW", "York", "日本"]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(1, 60)):
            parts.append("new york city hall" if rng.random() < 0.15 else rng.choice(vocabulary))
            parts.append(rng.choice([" ", " ", " ", "\t", "  ", ", ", ". ", "\n", "!?", "\x0b", "\r\n"]))
        rows.append((i, "".join(parts), rng.choice(["en", "de", None]), rng.choice(["a", "b", None])))
    rows += [(100, None, "en", "a"), (101, "", "de", None), (102, " \t ", None, "b"), (103, "...", "en", "c"), (104, "same words " * 4000, "en", "hot")]
    rows += [rows[0], rows[0], (105, rows[1][1], rows[1][2], "a")]
    return rows


@pytest.mark.parametrize("least, top", [(3, 10), (5, 2000), (30, 3)])
def test_collocations_equal_brute_force(spark, prose, least, top):
    got = mine_collocations(documents(spark, prose), least=least, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute_collocations(prose, least, top)


def test_phrase_counts_keep_every_prefix(spark, prose):
    counts, total = brute_phrases(prose, 3)
    rows = count_phrases(documents(spark, prose), least=4, order=3).collect()
    assert {(r.lang, *r.phrase.split(" ")): r.f for r in rows if r.words} == {p: n for p, n in counts.items() if n >= 4}
    assert {r.lang: r.f for r in rows if not r.words} == {k: n for k, n in total.items() if n}


def test_collocations_split_over_pieces_of_text(spark, prose, monkeypatch):
    from punctua.llm import collocations

    monkeypatch.setattr(collocations, "RANGES", 4)
    monkeypatch.setattr(collocations, "RANGE_BITS", (4, 5))  # so few buckets that nearly all share one
    monkeypatch.setattr(collocations, "MAP_BITS", 5)
    got = mine_collocations(documents(spark, prose), least=3, top=50)
    assert sorted(map(tuple, got.collect())) == brute_collocations(prose, 3, 50)


def test_collocations_of_nothing(spark):
    for rows in ([], [(1, None, None, None)], [(1, "", "en", "a"), (2, "one two", "en", "a")]):
        assert mine_collocations(documents(spark, rows)).collect() == []


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(leaves):
    """Root and, for each leaf, its siblings level by level as ``(left, right)``."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, p in enumerate(at):
            run = p // 16 * 16
            paths[i].append(("".join(level[run:p]), "".join(level[p + 1:run + 16])))
        level = [H("".join(level[i:i + 16])) for i in range(0, len(level), 16)]
        at = [p // 16 for p in at]
    return level[0], paths


def brute_manifest(rows):
    def leaf(r, text):
        i, _, lang, source = r
        values = [i, source, lang, len(r[1]) if r[1] is not None else None, text]
        return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def lower(t):
        return t and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)

    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    trees = {s: brute_tree([leaf(r, r[1]) for r in by[s]]) for s in names}
    root, over = brute_tree([trees[s][0] for s in names])
    out = []
    for s, above in zip(names, over):
        for r, path in zip(by[s], trees[s][1]):
            own = leaf(r, r[1])
            node = leaf(r, lower(r[1])) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else own
            for left, right in path + above:
                node = H(left + node + right)
            out.append((r[0], own, trees[s][0], root, H("".join(a + b for a, b in path + above)), node, node == root))
    return out


@pytest.mark.parametrize("sizes", [[1], [16], [17], [2, 256, 257], [1, 3, 600, 33], [5000, 1]])
def test_merkle_equals_brute_force(spark, sizes):
    rng = random.Random(sum(sizes))
    rows, i = [], 0
    for s, size in enumerate(sizes):
        for _ in range(size):
            i += rng.randint(1, 3)
            rows.append((i, rng.choice(["Some Text", "lower only", "", None, "Ünïcode É" * 3]) if rng.random() < 0.5 else f"Doc {i}", rng.choice(["en", None]), [None, "é", "b", "a"][s]))
    rng.shuffle(rows)
    got = verify_documents(documents(spark, rows))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect())) == sorted(brute_manifest(rows))


def test_merkle_of_many_sources_ties_and_null_ids(spark):
    rows = [(i % 40, f"T{i % 7}", None, f"s{i % 300}") for i in range(900)] + [(None, "x", "en", None), (None, "X", "en", None), (7, "x" * 300_000 + "Z", "en", "")]
    rows += rows[:25]
    got = verify_documents(documents(spark, rows))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute_manifest(rows), key=key)


def test_merkle_of_nothing_and_proofs_as_paths(spark):
    assert verify_documents(documents(spark, [])).collect() == []
    rows = [(i, f"text {i}", "en", "a" if i % 3 else "b") for i in range(300)]
    manifest = build_manifest(documents(spark, rows))
    assert len(manifest.documents) == 2  # leaves and every second level above
    proofs = extract_proofs(manifest)
    assert proofs.where(fold(F.col("hash"), F.col("path")) != F.col("root")).count() == 0
    assert proofs.where(F.size("path") != F.when(F.col("tree") == "a", 3).otherwise(3)).count() == 0


def vectors(spark, rows):
    data = [(i, None if v is None else [None if x is None else float(x) for x in v], *[x for k, x in EXTRA.items()]) for i, v in rows]
    return spark.createDataFrame(data, f"vec_id bigint, embedding array<double>, {EXTRA_SCHEMA}").repartition(3)


def brute_nearest(rows, k, every=20):
    rows = sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    out = []
    for q, x in rows:
        if q % every == 0:
            near = sorted((-float(np.add.reduce(np.array(x) * np.array(v))), i) for i, v in rows if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near[:k])]
    return sorted(out)


def test_multi_index_finds_nine_in_ten(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 24))
    rows = [(i, v) for i, v in enumerate(x)]
    found = nearest_vectors(vectors(spark, rows)).collect()
    true = {(q, i): s for q, _, i, s in brute_nearest(rows, 20)}
    assert len(found) == len(true) == 150 * 20
    hits = [r for r in found if (r.query_id, r.vec_id) in true]
    assert len(hits) >= 0.9 * len(true)
    assert all(true[r.query_id, r.vec_id] == pytest.approx(r.score, rel=1e-12) for r in hits)
    by = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append((r.rank, -r.score, r.vec_id))
    assert all([x[0] for x in v] == list(range(1, 21)) and [x[1:] for x in v] == sorted(x[1:] for x in v) for v in by.values())


def test_multi_index_ties_copies_and_broken_vectors(spark, monkeypatch):
    from punctua.llm import multi_index

    monkeypatch.setattr(multi_index, "SHARD", 16)  # a hot cell is split over blocks
    monkeypatch.setattr(multi_index, "QUERIES", 2)
    rng = random.Random(2)
    rows = [(i, [1, 2, 3, 4]) for i in range(100)] + [(i, [rng.choice([-1, 0, 1]) for _ in range(4)]) for i in range(100, 160)]
    rows += rows[:5] + [(20, [0, 0, 1, 5]), (None, [1, 1, 1, 1]), (200, None), (220, [0, 0, 0, 0]), (240, [1, None, 1, 1]), (260, [1, float("nan"), 0, 0]),
                        (280, [float("inf"), 0, 0, 0]), (300, [1, 2, 3]), (-20, [5, 0, 0, 1])]
    full = [r for r in rows if r[1] is None or len(r[1]) == 4]
    found = search(index := build_index(vectors(spark, rows)), index.entries.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "vector"), recall=1.0)
    want = brute_nearest(full, 20)
    got = sorted(map(tuple, found.collect()))
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert len(set(got) & set(want)) >= 0.9 * len(want)


def test_multi_index_of_few_or_no_vectors(spark):
    assert nearest_vectors(vectors(spark, [])).collect() == []
    assert nearest_vectors(vectors(spark, [(20, [0.0, 0.0]), (None, [1.0, 2.0])])).collect() == []
    assert nearest_vectors(vectors(spark, [(20, [1.0, 0.0])])).collect() == []
    few = [(0, [1.0]), (1, [2.0]), (2, [2.0]), (20, [-1.0])]
    assert sorted(map(tuple, nearest_vectors(vectors(spark, few)).collect())) == brute_nearest(few, 20)


def test_traversal_takes_cells_in_order():
    rng = np.random.default_rng(4)
    a, b, sizes = rng.normal(size=6), rng.normal(size=9), rng.integers(0, 4, (6, 9))
    cells = traverse(a, b, sizes, np.inf)
    sums = (a[:, None] + b).ravel()
    assert sorted(cells) == sorted(np.flatnonzero(sizes.ravel())) and all(sums[x] >= sums[y] for x, y in zip(cells, cells[1:]))
    some = traverse(a, b, sizes, 20)
    assert some == cells[:len(some)] and sizes.ravel()[some].sum() >= 20 > sizes.ravel()[some[:-1]].sum()
