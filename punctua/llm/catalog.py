"""The registered corpus queries and, where SQL can say it, the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.llm.collocations import mine_collocations
from punctua.llm.decontaminate import find_leaks
from punctua.llm.fm_dedup import remove_repeated_passages
from punctua.llm.html_layout import extract_text
from punctua.llm.language import held_out, identify_language
from punctua.llm.merkle import verify_documents
from punctua.llm.mixing import mix_sources
from punctua.llm.multi_index import nearest_vectors
from punctua.llm.near_dedup import near_groups
from punctua.llm.oracles import COLLOCATIONS, DECONTAMINATE, merkle_sql, quality_sql
from punctua.llm.quality_rules import judge_quality
from punctua.llm.suffix_dedup import remove_repeats
from punctua.llm.token_edits import count_tokens, redactions
from punctua.llm.toxicity import score_toxicity
from punctua.session import pin_utc

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_SQL: dict[str, str] = {"op1_decontaminate": DECONTAMINATE, "op3_quality_rules": quality_sql(),
                           "op11_collocations": COLLOCATIONS, "op13_merkle_manifest": merkle_sql()}


def _query(fn: Callable[..., DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        pin_utc(spark)
        return fn(lambda name: spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet"))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    LLM_QUERIES[fn.__name__] = run
    return fn


@_query
def op1_decontaminate(table) -> DataFrame:
    return find_leaks(table("documents"), table("benchmark"))


@_query
def op2_suffix_dedup(table) -> DataFrame:
    return remove_repeats(table("documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op3_quality_rules(table) -> DataFrame:
    return judge_quality(table("documents"), table("labels")).drop("n_lines")


@_query
def op5_toxicity(table) -> DataFrame:
    return score_toxicity(table("documents"), table("labels"))


@_query
def op7_near_dedup(table) -> DataFrame:
    return near_groups(table("documents"))


@_query
def op8_language_id(table) -> DataFrame:
    return identify_language(table("documents")).withColumn("held_out", held_out())


@_query
def op9_mix_sources(table) -> DataFrame:
    return mix_sources(table("documents")).drop("copies")


@_query
def op10_substring_dedup(table) -> DataFrame:
    return remove_repeated_passages(table("documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op4_token_edits(table) -> DataFrame:
    return count_tokens(redactions(table("documents")))


@_query
def op6_html_layout(table) -> DataFrame:
    return extract_text(table("pages"))


@_query
def op11_collocations(table) -> DataFrame:
    return mine_collocations(table("documents"))


@_query
def op12_multi_index(table) -> DataFrame:
    return nearest_vectors(table("embeddings"))


@_query
def op13_merkle_manifest(table) -> DataFrame:
    return verify_documents(table("documents"))
