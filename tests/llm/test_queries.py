"""Registered corpus queries on the smallest data: columns of their contracts, SQL where there is some, and the pipeline."""

from pathlib import Path

import pytest
from oracle import connect, rows_of

import corpus_pipeline
from punctua.llm.catalog import LLM_QUERIES, LLM_SQL

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data here")
COLUMNS = {
    "op1_decontaminate": "doc_id item_id", "op2_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op3_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept", "op4_token_edits": "doc_id n_tokens",
    "op5_toxicity": "doc_id held_out score predicted", "op6_html_layout": "page_id text", "op7_near_dedup": "doc_id n_shingles component_id kept",
    "op8_language_id": "doc_id held_out lang_pred score", "op9_mix_sources": "doc_id size source_size target taken",
    "op10_substring_dedup": "doc_id n_words n_removed kept_sha256", "op11_collocations": "lang rank phrase a l r n score",
    "op12_multi_index": "query_id rank vec_id score", "op13_merkle_manifest": "doc_id leaf subroot root proof_sha256 folded_root verified",
}


def test_all_are_registered():
    assert set(COLUMNS) == set(LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    df = LLM_QUERIES[name](spark, FOLDER)
    rows = df.collect()
    assert set(COLUMNS[name].split()) <= set(df.columns)
    if name == "op12_multi_index":
        assert len(rows) == 20 * spark.read.parquet(f"{FOLDER}/embeddings.parquet").where("vec_id % 20 = 0").count()
    elif name not in ("op1_decontaminate", "op11_collocations"):
        assert len(rows) == spark.read.parquet(f"{FOLDER}/{'pages' if 'html' in name else 'documents'}.parquet").count()
    if name in LLM_SQL:
        cursor = connect(FOLDER).execute(LLM_SQL[name])
        columns = [d[0] for d in cursor.description]
        assert sorted(columns) == sorted(df.columns)
        assert rows_of(df.columns, [tuple(r) for r in rows]) == rows_of(columns, cursor.fetchall())


def shingles(text, width=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + width]) for i in range(max(len(words) - width + 1, 1))} if words else set()


def test_pipeline_stages(spark, tmp_path):
    docs = given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [shingles(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "mix":
            assert docs.columns == given.columns
        old, new = {r.doc_id: r.text for r in before.collect()}, {r.doc_id: r for r in docs.collect()}
        if name == "language_id":
            assert set(old) - set(new) == {i for i, t in old.items() if not any(c.isalpha() for c in t or "")}
        elif name == "near_dedup":
            sets = {i: shingles(t) for i, t in old.items()}
            kept = sorted(new)
            for n, a in enumerate(kept):  # no two that stay are near
                assert not any(sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for b in kept[n + 1:])
            for a in set(old) - set(new):  # what goes has a near document with a smaller id or a chain to one
                assert any(a != b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for b in old)
        elif name == "substring_dedup":
            seen = set()
            for i in sorted(old):
                words = (old[i] or "").split()
                windows = [tuple(words[p:p + 20]) for p in range(len(words) - 19)]
                gone = {p + j for p, w in enumerate(windows) if w in seen or w in windows[:p] for j in range(20)}
                seen |= set(windows)
                left = [w for j, w in enumerate(words) if j not in gone]
                assert (i in new) == bool(left or not gone)
                if i in new:
                    assert new[i].text == (old[i] if not gone else " ".join(left))
        elif name == "decontaminate":
            assert set(old) - set(new) == {i for i, t in old.items() if any(s and 100 * len(s & shingles(t)) >= 80 * len(s) for s in items)}
        else:
            assert set(new) == set(old) and all(r.taken == r.copies * r.size for r in new.values())
    run = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, docs.collect()))
