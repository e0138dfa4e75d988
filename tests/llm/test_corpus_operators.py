"""Corpus operators against brute force, on edge cases: nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from punctua.llm import repeats
from punctua.llm.decontaminate import containment_sketches, drop_leaks, find_leaks, item_shingles
from punctua.llm.fm_dedup import remove_repeated_passages, strip_passages
from punctua.llm.html_layout import extract_text, page_text
from punctua.llm.language import identify_language, keep_identified
from punctua.llm.mixing import mix_sources
from punctua.llm.near_dedup import keep_one, near_groups
from punctua.llm.quality_rules import binomial_tail, judge_quality
from punctua.llm.suffix_dedup import refine_buckets, remove_repeats
from punctua.llm.token_edits import VOCABULARY, TokenTree, count_tokens, counter
from punctua.llm.toxicity import maximal_segments, score_toxicity

CLASH = {"size": 1, "score": 2.0, "kept": "x", "h": 3, "band": 4, "row": 5, "stratum": "s", "w": 6, "component": 7, "low": 8}
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
    f"{c} {'string' if isinstance(v, str) else 'double' if isinstance(v, float) else 'bigint'}" for c, v in CLASH.items())


def frame(spark, rows):
    """Documents ``(id, text)`` or ``(id, text, lang, source)`` with extra columns named like inner ones."""
    full = [(r + (None, None))[:4] for r in rows]
    return spark.createDataFrame([(i, t, la, s, len(t or ""), *CLASH.values()) for i, t, la, s in full], SCHEMA).repartition(3)


def prose(rng, n, words="alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron".split()):
    return " ".join(rng.choice(words) + (str(rng.randint(0, 99)) if rng.random() < 0.5 else "") for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base, passage, long = prose(rng, 150), prose(rng, 60), prose(rng, 6000)
    rows = [(1, base), (2, base), (3, base.replace("alpha", "ALPHA")), (4, base + " one more"), (5, None), (6, ""), (7, " \t\n "), (8, "word"),
            (9, "word"), (10, "Two words"), (11, prose(rng, 80) + " " + passage + " " + prose(rng, 40)), (12, passage), (13, prose(rng, 10) + "\n" + passage),
            (14, "a" * 400), (15, "ab " * 300), (16, long), (17, long[:20000]), (18, base[:700]), (19, "é" * 150 + "ü"), (20, "é" * 150), (21, "x y z"),
            (None, base), (None, passage), (1, base)]
    words = base.split()
    for i in range(30):
        edited = list(words)
        for _ in range(rng.randint(0, 16)):
            edited[rng.randrange(len(edited))] = f"new{rng.randint(0, 10**6)}"
        rows.append((100 + i, " ".join(edited)))
    return rows


def earlier(rows, k, split):
    """Removed symbols of each document by definition; documents that repeat an id and text are one."""
    seen, out = set(), {}
    for i, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        symbols = split((text or "").encode())
        gone = [False] * len(symbols)
        mine = {}
        for p in range(len(symbols) - k + 1):
            window = tuple(symbols[p:p + k])
            if window in seen or window in mine:
                gone[p:p + k] = [True] * k
            mine.setdefault(window, p)
        seen |= set(mine)
        out[i, text] = symbols, gone
    return out


@pytest.mark.parametrize("hot", [2000, 2])
def test_suffix_dedup(spark, texts, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = [r for r in texts if r[0] is not None] + [(None, texts[0][1])]
    want = {}
    for (i, _), (symbols, gone) in earlier(rows, 100, list).items():
        kept = bytes(s for s, g in zip(symbols, gone) if not g)
        want[i] = len(symbols), sum(gone), sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()
    got = remove_repeats(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got} == want
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)


@pytest.mark.parametrize("hot", [2000, 2])
def test_substring_dedup(spark, texts, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = [r for r in texts if r[0] is not None] + [(None, texts[0][1])]
    want = {i: (len(s), sum(g), b" ".join(w for w, x in zip(s, g) if not x).decode()) for (i, _), (s, g) in earlier(rows, 20, bytes.split).items()}
    docs = frame(spark, rows)
    got = remove_repeated_passages(docs).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == want
    stripped = strip_passages(docs)
    assert stripped.columns == docs.columns
    texts_of = {r.doc_id: r.text for r in stripped.collect()}
    given = dict(rows)
    assert texts_of == {i: given[i] if not n else kept for i, (words, n, kept) in want.items() if not n or n < words}


@pytest.mark.parametrize("hot", [2000, 2])
def test_repeated_rows_are_one_document(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rng = random.Random(11)
    alone, passage = prose(rng, 300), prose(rng, 80)
    rows = [(1, alone)] * 2 + [(2, passage + " " + prose(rng, 60))] * 3 + [(3, prose(rng, 30) + " " + passage)] * 2 + [(4, passage[:300] + " " + prose(rng, 50))]
    rows += [(5, prose(rng, 120) + " " + passage[40:])] * 2 + [(6, passage[20:260] + prose(rng, 20)), (None, prose(rng, 90)), (None, rows[-1][1])]
    rows += [(9, alone[:900] + " " + prose(rng, 9))] * 2
    for repartition in (1, 3):
        docs = frame(spark, rows).repartition(repartition)
        by_byte, by_word = remove_repeats(docs).collect(), remove_repeated_passages(docs).collect()
        want = {(i, len(s), sum(g), bytes(x for x, y in zip(s, g) if not y)) for (i, _), (s, g) in earlier(rows, 100, list).items()}
        assert len(by_byte) == len(rows) and {(r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in by_byte if r.doc_id} == {w for w in want if w[0]}
        want = {(i, len(s), sum(g), b" ".join(x for x, y in zip(s, g) if not y).decode()) for (i, _), (s, g) in earlier(rows, 20, bytes.split).items()}
        assert len(by_word) == len(rows) and {tuple(r) for r in by_word if r.doc_id} == {w for w in want if w[0]}
        assert len([r for r in strip_passages(docs).collect() if r.doc_id == 1 and r.text == alone]) == 2


def test_texts_under_one_id_do_not_erase_each_other(spark):
    rng = random.Random(12)
    start = prose(rng, 100)
    rows = [(1, start + " " + prose(rng, 8)), (1, start + " " + prose(rng, 8))]
    assert {r.n_removed for r in remove_repeats(frame(spark, rows)).collect()} == {0}
    assert {r.n_removed for r in remove_repeated_passages(frame(spark, rows)).collect()} == {0}


@pytest.mark.parametrize("hot", [2000, 1])
def test_what_one_text_of_an_id_loses_the_others_keep(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rng = random.Random(13)
    first, unique, own, start = prose(rng, 120), prose(rng, 90), prose(rng, 60), prose(rng, 70)
    for key in (2, None):
        rows = [(1 if key else -9, first), (key, first), (key, unique), (key, own + " x " + own), (key, start + " a " + prose(rng, 30)), (key, start + " b " + prose(rng, 30)),
                (key, start + " c " + start), (key, unique)]
        for n in (1, 4):
            docs = frame(spark, rows).repartition(n)
            kept = {bytes(r.kept).decode(): r.n_removed for r in remove_repeats(docs).collect() if r.doc_id == key}
            words = {r.kept: r.n_removed for r in remove_repeated_passages(docs).collect() if r.doc_id == key}
            lost = 0 if key is None else len(first.split())  # a null id comes first, so its text stays and the other goes
            assert words[unique] == kept[unique] == 0
            assert words["" if key else first] == lost and kept["" if key else first] == (len(first) if key else 0)
            assert all(words[t] == kept[t] == 0 for i, t in rows[4:6])
            assert words[own + " x"] == 60 and words[start + " c"] == 70
            assert sum(n > 0 for n in kept.values()) == (3 if key else 2)
            left = [r.text for r in strip_passages(docs).collect() if r.doc_id == key]
            assert left.count(unique) == 2 and own + " x" in left


def test_refine_buckets_is_exact():
    rng = random.Random(1)
    import numpy as np
    for depth in (3, 8, 20, 37):
        parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 60))) for _ in range(40)]
        offsets = np.cumsum([0, *map(len, parts)])
        bucket = refine_buckets(np.frombuffer(b"".join(parts), np.uint8), offsets, depth)
        strings = {int(o) + p: part[p:p + depth] for o, part in zip(offsets, parts) for p in range(len(part) - depth + 1)}
        count, label = Counter(strings.values()), {}
        for at, s in strings.items():
            assert (bucket[at] >= 0) == (count[s] > 1)
            if count[s] > 1:
                assert label.setdefault(s, bucket[at]) == bucket[at]
        assert len(set(label.values())) == len(label)


def shingles(text, width):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + width]) for i in range(max(len(words) - width + 1, 1))} if words else set()


def groups(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def test_every_text_of_an_id_links(spark, texts):
    rng = random.Random(8)
    a, c = prose(rng, 120), prose(rng, 120)
    near = lambda t, w: " ".join([*t.split()[:-1], w])
    rows = [(1, a), (1, c), (2, near(a, "x")), (3, near(c, "y")), (4, prose(rng, 120)), (5, near(c, "z"))]
    got = {r.doc_id: (r.component_id, r.kept) for r in near_groups(frame(spark, rows)).collect()}
    assert got == {1: (1, True), 2: (1, False), 3: (1, False), 4: (4, True), 5: (1, False)}


def test_short_items_are_found_inside_documents(spark):
    docs = [(1, "alpha beta gamma"), (2, "well Alpha beta gamma indeed and more"), (3, "alpha beta delta gamma"), (4, "beta gamma"), (5, None), (6, "x y"),
            (7, "one two three four five six"), (8, "solo")]
    bench = spark.createDataFrame([("a", "alpha beta gamma"), ("b", "solo"), ("c", "two three four five six seven"), ("d", "one two three four five"), ("e", None)], "item_id string, text string")
    found = find_leaks(frame(spark, docs), bench)
    assert sorted((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in found.collect()) == [(1, "a", 1, 1), (2, "a", 1, 1), (7, "d", 1, 1), (8, "b", 1, 1)]
    assert sorted(r.doc_id for r in drop_leaks(frame(spark, docs), bench).collect()) == [3, 4, 5, 6]


def test_near_groups(spark, texts):
    rows = [r for r in texts if r[0] is not None]
    docs = frame(spark, [*rows, (None, texts[0][1])])
    got = near_groups(docs).collect()
    assert len(got) == len(rows) + 1
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None} == groups(rows, 2, 80)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {None} | {i for i, v in groups(rows, 5, 80).items() if v[2]}


def test_leaks(spark, texts):
    item = " ".join(texts[10][1].split()[85:125])
    bench = spark.createDataFrame([(1, item), (2, "two words"), (3, None), (4, ""), (5, "nothing like this is in any document at all"), (1, item), (None, item)],
                                  "item_id bigint, text string")
    docs = frame(spark, texts)
    want = {(r[0], i) for r in texts if r[0] is not None for i, t in ((1, item), (2, "two words"))
            if len(shingles(t, 5) & shingles(r[1], 5)) >= 0.8 * len(shingles(t, 5))}
    got = find_leaks(docs, bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and (11, 1) in want and got.count() == len(want)
    left = drop_leaks(docs, bench)
    assert left.columns == docs.columns
    assert left.count() == sum(r[0] not in {d for d, _ in want} for r in texts)


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_sketches_lose_no_holder(spark, percent):
    rng = random.Random(14)
    items = {n: prose(rng, n) for n in (5, 6, 9, 12, 19, 20, 35, 68, 131)} | {200 + i: "which of these is the right answer to the question " + prose(rng, 12) for i in range(9)}
    rows = []
    for i, t in items.items():  # the first words of every item, from too few to all, inside a long text
        w = t.split()
        rows += [(1000 * i + m, " ".join([prose(rng, 150), *w[:m], prose(rng, 150)])) for m in range(5, len(w) + 1, 1 + len(w) // 25)]
    bench = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    want = {(d, i): len(shingles(t, 5) & shingles(x, 5)) for d, x in rows for i, t in items.items()}
    want = {(*k, v) for k, v in want.items() if v and 100 * v >= percent * len(shingles(items[k[1]], 5))}
    assert {(r.doc_id, r.item_id, r.n_shared) for r in find_leaks(frame(spark, rows), bench, percent).collect()} == want and len(want) >= len(items)
    sketch = containment_sketches(item_shingles(bench), percent).groupBy("item_id", "matches").count().collect()
    sizes = {i: len(shingles(t, 5)) for i, t in items.items()}
    assert len(sketch) == len(items) and all(r["count"] - r.matches == sizes[r.item_id] - -(-sizes[r.item_id] * percent // 100) and r.matches >= 1 for r in sketch)
    by_part = {}
    for r in sketch:
        if r["count"] < sizes[r.item_id]:
            by_part.setdefault(sizes[r.item_id].bit_length(), set()).add(r["count"])
    assert all(len(v) == 1 for v in by_part.values())


def test_quality(spark, texts):
    rng = random.Random(2)
    rows = [*texts, (50, "go " * 8 + "x" * 30), (51, ("one two three four five six seven eight nine ten " * 3).strip())]
    rows += [(1000 + i, prose(rng, 30)) for i in range(900)] + [(3000 + i, " ".join("ab###" for _ in prose(rng, 30).split()) + f" {i}") for i in range(50)]
    labels = spark.createDataFrame([(1000 + i, 1, 0) for i in range(900)] + [(3000 + i, 0, 0) for i in range(50)] + [(None, 1, 0), (1000, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in judge_quality(frame(spark, rows), labels).collect() if r.doc_id is not None}
    for i, text in rows:
        if i is None:
            continue
        words = (text or "").split()
        windows = [tuple(words[p:p + 8]) for p in range(len(words) - 7)]
        count = Counter(windows)
        again = {p + j for p, w in enumerate(windows) if count[w] > 1 for j in range(8)}
        lines = [x for x in (text or "").split("\n") if x.split()]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines) == (len(words), sum(map(len, words)), len(again), len(lines) - len(set(lines)))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in text or "")
        assert r.base_failed == (len(words) < 20 or 100 * len(again) > 30 * len(words))
    assert all(got[1000 + i].kept for i in range(900)) and not any(got[3000 + i].kept for i in range(50))
    assert judge_quality(frame(spark, rows).limit(0), labels).count() == 0


def test_binomial_tail(spark):
    from math import comb
    cases = [(k, n, p) for p in (0.0125, 0.05, 0.3) for n in (1, 10, 400, 900) for k in (0, 1, 3, 10) if k < n * p]
    for p in (0.0125, 0.05, 0.3):
        rows = spark.createDataFrame([(k, n) for k, n, q in cases if q == p], "k int, n int").select("k", "n", binomial_tail(F.col("k"), F.col("n"), p).alias("x")).collect()
        for r in rows:
            assert r.x == pytest.approx(sum(comb(r.n, i) * p**i * (1 - p) ** (r.n - i) for i in range(r.k + 1)), rel=1e-8)


def test_mixing(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(0, 60)) or None, None, rng.choice(["a", "b", "b", "b", "é", None, "Z"])) for i in range(3000)]
    rows += [(5000, "same words here", None, "a")] * 7 + [(None, "no id", None, "b")]
    docs = frame(spark, rows)
    got = mix_sources(docs).collect()
    assert len(got) == len(rows)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mix_sources(docs.repartition(5)).collect()), key=str)
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len((text or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, full = {}, set()
    while True:  # by the words of the contract: reshare what is above the limit
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        target = {s: 2 * sizes[s] if s in full else left * weight[s] / sum(weight[x] for x in order if x not in full) for s in order}
        above = {s for s in order if target[s] > 2 * sizes[s] + 1e-9}
        if not above:
            break
        full |= above
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source]
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 30 for s in order)
    assert mix_sources(docs.limit(0)).count() == 0


def test_mixing_is_unbiased(spark):
    docs = frame(spark, [(i, "w " * (i % 40 + 1), None, "ab"[i % 7 == 0]) for i in range(600)])
    copies = Counter()
    for seed in range(6):
        for r in mix_sources(docs, seed=seed).collect():
            copies[r.source, r.size < 20] += r.copies / r.target * r.source_size
    n = Counter(("ab"[i % 7 == 0], i % 40 + 1 < 20) for i in range(600))
    for key, total in copies.items():
        assert total / 6 == pytest.approx(n[key], rel=0.12)


def test_language(spark):
    rng = random.Random(4)
    vocabulary = {"en": "the house was built near old river stones", "de": "das haus wurde an dem alten fluss gebaut", "fr": "la maison fut bâtie près du vieux fleuve"}
    rows = [(i, prose(rng, rng.randint(4, 60), vocabulary[la].split()), la, "s") for i, la in enumerate(rng.choice(list(vocabulary)) for _ in range(400))]
    odd = [(1001, None, "en", "s"), (1002, "", "en", "s"), (1003, "123 --- 456", "de", "s"), (None, "the old house", "en", "s"), (1004, "the old house", None, "s")]
    docs = frame(spark, rows + odd + rows[:1])
    got = identify_language(docs).collect()
    assert len(got) == len(rows) + len(odd) + 1
    by_id = {r.doc_id: r for r in got}
    out = [(by_id[i].lang_pred == la) for i, _, la, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(out) > 80 and sum(out) / len(out) > 0.98
    assert [by_id[i].lang_pred for i in (1001, 1002, 1003)] == ["und"] * 3 and by_id[1004].lang_pred == by_id[None].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got)
    kept = keep_identified(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in rows} | {1004, None}
    assert {r.lang_pred for r in identify_language(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert identify_language(docs.limit(0)).count() == 0


def test_language_stage_drops_unlearned_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").where(F.col("text").rlike(r"\p{L}"))
    rng = random.Random(3)
    junk = ["Все люди рождаются свободными и равными в своем достоинстве и правах.", "人人生而自由在尊严和权利上一律平等他们赋有理性和良心",
            "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
            "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(400)),
            " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(60))]
    added = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(junk)], "doc_id bigint, text string, lang string")
    left = keep_identified(docs.union(added))
    assert left.where("doc_id < 0").count() == 0
    assert left.where("doc_id >= 0").count() >= 0.995 * docs.count()


def all_maximal(scores):
    """Maximal scoring segments by their recursive definition: the best one, then the same left and right of it."""
    best = max(((sum(scores[a:b]), a - b, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), key=lambda x: (x[0], x[1]), default=None)
    if best is None or best[0] <= 1e-9:
        return []
    _, _, a, b = best
    return ([(x, y) for x, y in all_maximal(scores[:a])] + [(a, b)] + [(b + x, b + y) for x, y in all_maximal(scores[b:])])


def test_maximal_segments():
    import numpy as np
    rng = random.Random(6)
    for _ in range(300):
        scores = [rng.choice([-3.1, -1.3, -0.7, 0.9, 1.7, 2.3]) + rng.random() / 100 for _ in range(rng.randint(0, 12))]
        assert sorted((s, e) for s, e, _ in maximal_segments(np.array(scores))) == sorted(all_maximal(scores))


def test_toxicity(spark):
    rng = random.Random(7)
    rows, marks = [], []
    for i in range(700):
        words, bad = prose(rng, rng.randint(20, 200)).split(), i % 5 == 0
        for _ in range(3 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "nasty", "awful"]))
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(bad)))
    docs = frame(spark, [*rows, (9001, None), (9002, ""), (None, "vile nasty"), rows[0]])
    labels = spark.createDataFrame([*marks, (None, 1, 1), (9001, 1, None)], "doc_id bigint, quality int, toxic int")
    got = score_toxicity(docs, labels).collect()
    assert len(got) == 704 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    for r in got:
        if r.doc_id is not None and r.doc_id < 700:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.doc_id % 5 == 0)
            assert bool(r.passages) == (r.doc_id % 5 == 0)
        elif r.doc_id:
            assert r.predicted == 0 and not r.passages
    none = score_toxicity(docs, labels.limit(0)).collect()
    assert len(none) == 704 and not any(r.predicted for r in none)


def test_token_tree_round_trip():
    tokens, rng = counter(VOCABULARY), random.Random(8)
    parts = ["a", "b", " ", "  ", "\n", "1", "23", "!", "'s", "é", " the", "\n\n", "word"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 300)))
        tree = TokenTree(text, tokens)
        for _ in range(rng.randint(1, 4)):
            start = rng.randint(0, len(text))
            end = min(len(text), start + rng.randint(0, 9))
            new = "".join(rng.choice(parts) for _ in range(rng.randint(0, 4)))
            tree.edit(start, end, new)
            text = text[:start] + new + text[end:]
        assert tree.text() == text and tree.total == len(tokens.encoding.encode_ordinary(text))


def test_count_tokens(spark):
    tokens = counter(VOCABULARY)
    long = "the quick brown fox " * 5000
    rows = [(1, "hello world", [(0, 5, "bye")]), (2, None, None), (3, "", [(0, 9, "x")]), (None, "a b", None), (4, long, [(50, 60, ""), (10, 20, "zz"), (15, 30, "overlap")]), (1, "hello world", [(0, 5, "bye")])]
    got = count_tokens(spark.createDataFrame(rows, "doc_id bigint, text string, edits array<struct<start:bigint,end:bigint,text:string>>")).collect()
    n = lambda t: len(tokens.encoding.encode_ordinary(t))
    assert sorted((r.doc_id or 0, r.n_tokens, r.n_edits, r.n_tokens_after) for r in got) == sorted([
        (1, n("hello world"), 1, n("bye world")), (1, n("hello world"), 1, n("bye world")), (2, 0, 0, 0), (3, 0, 1, 1), (0, 2, 0, 2),
        (4, n(long), 2, n(long[:10] + "zz" + long[20:50] + long[60:]))])
    assert next(r.n_reencoded for r in got if r.doc_id == 4) < 100


def test_html_layout(spark):
    page = ("<title>no</title><ul><li>One<li>Two <b>bold</b><ol><li>a<li>b</ol></ul><p>First<p>Sec\n ond<br>next &amp; last<div>x<div>y</div></div>"
            "<table><tr><th>Name<th>Qty<tr><td>Longer<td>1<tr><td colspan=2>wide</table><p hidden>no<p style='display: none'>no</p><pre> a\n  b</pre>"
            "<span style='visibility:hidden'>no<i style='visibility:visible'>yes</i></span><script>no</script><details><summary>sum</summary>no</details>")
    assert page_text(page) == ("* One\n* Two bold\n  1. a\n  2. b\n\nFirst\n\nSec ond\nnext & last\n\nx\ny\n\nName    Qty\nLonger  1\nwide\n\n a\n  b\n\nyes\nsum")
    assert page_text("1 < 2 <3 &lt;b&gt; <") == "1 < 2 <3 <b> <"
    deep = "<div>" * 20000 + "deep" + "<table><tr><td>" * 400 + "x"
    assert page_text(deep).split() == ["deep", "x"]
    rows = [(1, "u", page), (2, "u", None), (3, None, ""), (None, "u", "<p>x"), (1, "u", page)]
    got = extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert sorted((r.page_id or 0, r.text) for r in got) == sorted([(1, page_text(page)), (2, ""), (3, ""), (0, "x"), (1, page_text(page))])


@pytest.mark.parametrize("html, text", [
    ("<table><td>x</table>", "x"), ("<table><tbody><td>x<td>y<tr><th>z</table>", "x  y\nz"), ("<table>text<tr><td>x</table>", "text\n\nx"),
    ("<table><tr>text<td>x</table>after", "text\n\nx\n\nafter"), ("<table><form><tr><td>x</form><tr><td>y</table>", "x\ny"),
    ("<table><tr><div>d<td>x</table>", "d\n\nx"), ("<table><div>d<tr><td>x</table>", "d\n\nx"), ("<table><caption>c<td>x</table>", "c\nx"),
    ("<table><colgroup><col>t<tr><td>x</table>", "t\n\nx"), ("<table><tr><td>a<table><td>b</table><td>c</table>", "a  c\n\nb"),
    ("<table><tr><td>a<tr><table><td>b</table>", "a\n\nb"), ("<table><tr><input type=hidden value=h><td>x</table>", "x"),
    ("<table><tr style='visibility:hidden'><td>x<td style='visibility:visible'>y<tr><td>z</table>", "   y\nz"),
    ("<table><tbody style='visibility:hidden'><tr><td>x</table>", ""), ("<table><tr><td style='visibility:hidden'>x</table>", ""),
    ("<table><td style='white-space:pre'>a  b</table>", "a  b"),
    ("a <math><mi>x</mi><mo>+</mo><mn>1</mn><annotation>no</annotation></math> b", "a x+1 b"), ("<map><area><a>m</a></map>", "m"),
    ("<svg><defs><text>no</text></defs><rect/><title>no</title><text>one</text><g display=none><text>no</text></g><text>two</text>no</svg> b", "one two b"),
    ("<svg><rect/><p>x</p>y", "x\n\ny"), ("<svg/>x", "x"),
])
def test_text_of_tables_and_drawings(html, text):
    assert page_text(html) == text


def test_empty_tables(spark):
    docs = frame(spark, [(1, "x")]).limit(0)
    bench = spark.createDataFrame([], "item_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for out in (find_leaks(docs, bench), drop_leaks(docs, bench), remove_repeats(docs), remove_repeated_passages(docs), strip_passages(docs), near_groups(docs),
                keep_one(docs), score_toxicity(docs, labels), keep_identified(docs), judge_quality(docs, labels)):
        assert out.count() == 0
