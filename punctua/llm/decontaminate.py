"""Benchmark decontamination: MinHash containment search, partitioned by item size, then exact shingles (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.llm.common import shingle_hash, staged, starts, words

SHINGLE = 5
CONTAINED = 80  # percent of an item's distinct shingles
SPARE = 4  # sketch entries beyond those that a holder of the largest item of a size partition may miss


def _needed(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / F.lit(100))


def item_shingles(benchmark: DataFrame) -> DataFrame:
    """Distinct shingles of every item: ``item_id, shingle, h, n`` (``n``: the item's number of them)."""
    tokens = benchmark.select("item_id", words(F.lower("text")).alias("w"))
    each = tokens.select("item_id", "w", F.explode(starts(F.col("w"), SHINGLE)).alias("at")).select(
        "item_id", F.array_join(F.slice("w", F.col("at") + 1, SHINGLE), " ").alias("shingle"),
        shingle_hash(F.col("w"), F.col("at"), SHINGLE).alias("h")).distinct()
    return each.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("item_id")))


def containment_sketches(items: DataFrame, percent: int, spare: int = SPARE) -> DataFrame:
    """MinHash sketches of the items: ``item_id, h, matches, least``.

    A sketch is the ``k`` least shingles of an item in one order of all shingles (a bottom-``k`` MinHash), and ``k`` is that of the item's size
    partition: sizes from ``2^p`` to ``2^(p+1) - 1`` share the sketch length ``m + spare``, with ``m`` what a holder of the
    partition's largest size may miss. The order is the hash, with shingles that many items share moved behind the others by the
    power of two of their number, so that a common phrase of the benchmark is in few sketches.

    The share of a sketch found in a document estimates the containment. A holder of ``c = ceil(n * percent / 100)`` of ``n`` shingles
    misses at most ``n - c``, so ``matches = k - (n - c)`` is the estimate's threshold that no holder stays below: unlike signatures of the document, which
    a long text around a short item swamps, it loses no pair. ``least`` is the number of words that holder has at least.
    """
    shared = items.groupBy("h").agg(F.floor(F.log2(F.count_distinct("item_id"))).alias("common"))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("common", "h"))
    largest = F.pow(F.lit(2.0), F.floor(F.log2("n")) + 1) - 1
    length = F.least(F.col("n"), (largest - _needed(largest, percent)).cast("long") + max(spare, 1))
    needed = _needed(F.col("n"), percent)
    return (items.select("item_id", "h", "n").join(shared, "h").withColumn("rank", rank).withColumn("k", length).where("rank <= k")
            .select("item_id", "h", (F.col("k") - F.col("n") + needed).cast("int").alias("matches"), needed.cast("int").alias("least")))


def _short_widths(items: DataFrame) -> list[int]:
    """Numbers of words below ``SHINGLE`` that some item has: at most ``SHINGLE - 1``."""
    size = F.size(F.split("shingle", " "))
    return sorted(r[0] for r in items.select(size.alias("m")).where(F.col("m") < SHINGLE).distinct().collect())


def _document_shingles(docs: DataFrame, short: list[int], *columns: Column) -> DataFrame:
    """Every run of ``SHINGLE`` words, and of as many words as short items have: ``doc_id, h`` and ``columns`` over ``w, at, width``."""
    tokens = docs.select("doc_id", words(F.lower("text")).alias("w"))

    def spots(m: int) -> Column:
        at = F.when(F.size("w") >= m, F.sequence(F.lit(0), F.size("w") - m)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.struct(i.alias("at"), F.lit(m).alias("width"))) if short else at

    spot = F.explode(F.concat(*[spots(m) for m in (SHINGLE, *short)]))
    if not short:
        each = tokens.select("doc_id", "w", spot.alias("at"), F.lit(SHINGLE).alias("width"))
        return each.select("doc_id", shingle_hash(F.col("w"), F.col("at"), SHINGLE).alias("h"), *columns)
    each = tokens.select("doc_id", "w", spot.alias("spot")).select("doc_id", "w", "spot.*")
    parts = [F.when(F.col("width") > i, F.get("w", F.col("at") + i)) for i in range(SHINGLE)]  # nulls do not change the hash
    return each.select("doc_id", F.xxhash64(*parts).alias("h"), *columns)


def find_leaks(docs: DataFrame, benchmark: DataFrame, percent: int = CONTAINED) -> DataFrame:
    """Documents that hold a benchmark item: ``doc_id, item_id, n_item, n_shared, containment``, one row per pair.

    Texts are lower-cased; shingles are ``SHINGLE`` consecutive words. An item is held if at least ``percent`` of its distinct shingles occur in
    the document; an item of fewer words is one shingle, held wherever its words stand one after another. Every distinct shingle of a whole document is looked
    up in the items' sketches; pairs with enough matches (see :func:`containment_sketches`) are then compared by their shingles as text.

    The sketches are joined without a hint: Spark broadcasts them below its own size threshold, else both sides shuffle
    on the shingle hash, and adaptive execution splits a hot one. Null and blank texts hold nothing and are held by
    nothing; rows that share a ``doc_id`` (or an ``item_id``) count as one document (item); null ids match nothing. Empty tables give no rows.
    """
    docs = docs.select("doc_id", "text").where("doc_id is not null")
    items = staged(item_shingles(benchmark.select("item_id", "text").where("item_id is not null")), "leak-items")
    sketches, short = staged(containment_sketches(items, percent), "leak-sketches"), _short_widths(items)
    size = F.size("w").alias("words")
    found = staged(_document_shingles(docs, short, size).join(sketches, "h").where("words >= least")
                   .groupBy("doc_id", "item_id", "matches").agg(F.count_distinct("h").alias("matched"))
                   .where("matched >= matches").select("doc_id", "item_id"), "leak-candidates")
    held = docs.join(found.select("doc_id").distinct(), "doc_id", "left_semi")
    text = F.array_join(F.slice("w", F.col("at") + 1, F.col("width")), " ").alias("shingle")
    shared = (_document_shingles(held, short, text).join(items, ["h", "shingle"]).join(found, ["doc_id", "item_id"], "left_semi")
              .groupBy("doc_id", "item_id").agg(F.first("n").alias("n_item"), F.count_distinct("shingle").alias("n_shared")))
    return shared.where(F.col("n_shared") >= _needed(F.col("n_item"), percent)).select(
        "doc_id", "item_id", "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, percent: int = CONTAINED) -> DataFrame:
    """``docs`` without the documents of :func:`find_leaks`; rows with a null id stay."""
    leaks = staged(find_leaks(docs, benchmark, percent).select("doc_id").distinct(), "leaks")
    return docs.join(leaks, docs["doc_id"] == leaks["doc_id"], "left_anti")
