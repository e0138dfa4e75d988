"""Mix sources to target weights by pivotal dependent rounding (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.llm.common import staged, words

FAN_IN = 64  # nodes that one step of the reduction tree folds
NODE = "struct<doc_id:bigint,size:bigint,n:bigint,whole:bigint,p:double>"


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, limit: float) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    Sources in code point order (null last) take ``weights`` in turn. Together they get ``share`` of all sizes; a target
    stops at ``limit`` times its source's size and the excess goes to the others by weight. In order of rising
    ``limit * size / weight`` the level of the first ``k`` sources being full rises until the true level and falls after
    it, so the level is the largest of these. The windows hold one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighted = per_source.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn - 1) % len(weights) + 1))
    every = Window.partitionBy()
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    levels = (
        weighted.withColumn("cap", limit * F.col("source_size"))
        .withColumn("total", share * F.sum("source_size").over(every))
        .withColumn("full", F.coalesce(F.sum("cap").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", F.max((F.col("total") - F.col("full")) / F.col("open")).over(every))
    )
    return levels.select("source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def _uniform(seed: int, a: Column, b: Column) -> Column:
    draw = F.xxhash64(F.lit(seed), a["doc_id"], a["size"], b["doc_id"], b["size"])
    return draw.bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))


def _node(of: Column, p: Column) -> Column:
    return F.struct(*[of[c].alias(c) for c in ("doc_id", "size", "n", "whole")], p.alias("p"))


def _pivot(seed: int):
    """Fold step: the carried node meets the next one; words move between them until one is integral."""

    def step(state: Column, new: Column) -> Column:
        old = state["rest"]
        a, b = old["size"] * old["p"], new["size"] * new["p"]  # expected words of either
        up = F.least(old["size"] - a, b)  # words that can go from new to old
        down = F.least(a, new["size"] - b)
        rise = _uniform(seed, old, new) * (up + down) < down
        old_fills, new_empties = old["size"] - a <= b, b <= old["size"] - a
        old_empties, new_fills = a <= new["size"] - b, new["size"] - b <= a
        p_old = F.when(rise, F.when(old_fills, 1.0).otherwise((a + b) / old["size"])).otherwise(
            F.when(old_empties, 0.0).otherwise((a - (new["size"] - b)) / old["size"]))
        p_new = F.when(rise, F.when(new_empties, 0.0).otherwise((b - (old["size"] - a)) / new["size"])).otherwise(
            F.when(new_fills, 1.0).otherwise((a + b) / new["size"]))
        old_done = F.when(rise, old_fills).otherwise(old_empties)
        old_after, new_after = _node(old, p_old), _node(new, p_new)
        moved = F.struct(
            F.when(old_done, new_after).otherwise(old_after).alias("rest"),
            F.concat(state["done"], F.array(F.when(old_done, old_after).otherwise(new_after))).alias("done"))
        first = F.struct(new.alias("rest"), state["done"].alias("done"))
        settled = F.struct(new.alias("rest"), F.concat(state["done"], F.array(old)).alias("done"))
        return F.when(old.isNull(), first).when(old["p"].isin(0.0, 1.0), settled).otherwise(moved)

    return step


def _settle(state: Column, new: Column) -> Column:
    """Fold step over the last residuals of a source, large to small: what one is rounded by, the next ones make up for."""
    due = state["due"] + new["p"] * new["size"]
    taken = F.when(2 * due >= new["size"], 1.0).otherwise(0.0)
    return F.struct((due - taken * new["size"]).alias("due"), F.concat(state["done"], F.array(_node(new, taken))).alias("done"))


def _nodes(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """The nodes of each key as one array, from large to small."""
    order = F.reverse(F.array_sort(F.collect_list(F.struct("size", "doc_id", "n", "whole", "p"))))
    typed = F.transform("nodes", lambda x: F.struct(*[x[c].alias(c) for c in ("doc_id", "size", "n", "whole", "p")]))
    return nodes.groupBy(*keys).agg(order.alias("nodes")).select(*keys, typed.cast(f"array<{NODE}>").alias("nodes"))


def _fold(nodes: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """One level of the reduction tree: per key the decided nodes (``done``) and one residual (``rest``)."""
    start = F.struct(F.lit(None).cast(NODE).alias("rest"), F.array().cast(f"array<{NODE}>").alias("done"))
    return (_nodes(nodes, keys).select(*keys, F.aggregate("nodes", start, _pivot(seed)).alias("state"))
            .select(*keys, "state.rest", "state.done"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, limit: float = 2.0,
                seed: int = 20) -> DataFrame:
    """Copies of each document so that each source takes its target: ``doc_id, source, size, source_size, target, copies, taken``.

    A document of a source gets ``target / source_size`` copies in expectation. The whole part is certain; the
    fraction is rounded dependently. Documents of one source and size class (a power of two) are dealt into blocks of about
    ``FAN_IN``; in a block two fractions meet and words move between them at random, keeping their sum and every
    expectation, until one is integral. Each block leaves one residual, and residuals meet in blocks of the next level until
    each size class of a source has one. These few are rounded from large to small, each making up for the words that the
    ones before were rounded by. A source's words so miss its target by at most half of one document, mostly a small one.

    Draws are hashes of the ids met, so reruns agree. Null texts have size 0 and take nothing; a null source is a source
    of its own; rows that agree in id, source and size are rounded together and share the copies evenly. An empty table gives no rows.
    """
    sizes = staged(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source",
                               F.size(words(F.col("text"))).cast("bigint").alias("size")), "mix-sizes")
    targets = staged(source_targets(sizes, weights, share, limit), "mix-targets")
    same = F.col("s.source").eqNullSafe(F.col("t.source"))
    rows = sizes.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    wanted = F.round(F.when(F.col("source_size") > 0, F.col("n") * F.col("target") / F.col("source_size")).otherwise(0.0), 9)
    split = staged(
        rows.alias("s").join(targets.alias("t"), same).select("s.*", wanted.alias("wanted"))
        .withColumn("whole", F.floor("wanted")).withColumn("p", F.col("wanted") - F.col("whole"))
        .withColumn("class", F.when((F.col("p") > 0) & (F.col("size") > 0), F.floor(F.log2("size"))))
        .drop("wanted"), "mix-split")

    open_rows = split.where("class is not null")
    blocks = open_rows.groupBy("source", "class").agg(F.ceil(F.count(F.lit(1)) / F.lit(FAN_IN)).alias("blocks"))
    widest = blocks.agg(F.max("blocks")).first()[0] or 1  # one number
    key = F.col("s.source").eqNullSafe(F.col("b.source")) & (F.col("s.class") == F.col("b.class"))
    nodes = (open_rows.alias("s").join(blocks.alias("b"), key)
             .select("s.*", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.col("blocks")).alias("block")))
    columns = ["source", "doc_id", "size", "n", "whole", "p"]
    decided = [split.where("class is null").select(*columns)]

    keys = ["source", "class", "block"]
    while True:
        level = staged(_fold(nodes, keys, seed), "mix-level")
        decided.append(level.select("source", F.explode("done").alias("x")).select("source", "x.*").select(*columns))
        rest = level.select(*keys, "rest.*")
        if widest == 1:
            break
        widest = -(-widest // FAN_IN)
        nodes = rest.withColumn("block", F.expr(f"block div {FAN_IN}"))
    start = F.struct(F.lit(0.0).alias("due"), F.array().cast(f"array<{NODE}>").alias("done"))
    last = _nodes(rest, ["source"]).select("source", F.explode(F.aggregate("nodes", start, _settle)["done"]).alias("x"))
    decided.append(last.select("source", "x.*").select(*columns))

    rounded = decided[0]
    for part in decided[1:]:
        rounded = rounded.unionByName(part)
    copies = F.col("whole") + F.col("p").cast("bigint")
    each = (rounded.select("source", "doc_id", "size", "n", copies.alias("all"), F.explode(F.sequence(F.lit(1), F.col("n"))).alias("turn"))
            .withColumn("copies", F.expr("all div n") + F.when(F.col("turn") <= F.col("all") % F.col("n"), 1).otherwise(0)))
    return each.alias("s").join(targets.alias("t"), same).select(
        "s.doc_id", "s.source", "s.size", "t.source_size", "t.target", F.col("s.copies").cast("bigint").alias("copies"),
        (F.col("s.copies") * F.col("s.size")).alias("taken"))
