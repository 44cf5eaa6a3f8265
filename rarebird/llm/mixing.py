"""Mixing sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources a document belongs to). Tokens of
a pattern may flow to any of its sources; a source takes up to its quota; the k-th pass over a
pattern's tokens costs k - 1 a token, so that repetition is spread and used only where unique tokens
run out (a convex cost). The flow gives each pattern the words to take: whole passes over all its
documents, and for the rest the documents first in a seeded order.

Targets are set by a table of the sources, of any number: their places by code point from a
range-partitioned sort, the level at which shares are cut by repeated aggregation. A source that no
document shares with another needs no flow: it takes its quota from its own words. Only overlapping
patterns go to the flow on the driver.

The order is that of a digest of seed, id and text; rows equal in both follow by their place in the
written table of sizes, so that any of them may be taken alone. Where a pattern's share ends is found
by histograms of 12 bits of the order each and a look into one cell, so no group is ever sorted or
gathered whole; the cut is the document boundary nearest to the share.

Edge cases: a null text has size 0; a null source is a source of its own, last in order; an empty
membership is one pattern without a source and is not taken; empty texts and empty sources take 0;
rows may share an id, or be equal (how many of equal rows are taken is the same in every run); an empty table gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rarebird.llm.common import SPACE, SPACE_CHARS, Scratch, text_of

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_PASSES = 2
#: overlapping membership patterns that the flow network may have; more are refused, not cut
MAX_PATTERNS = 20_000


def words_in(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACE))).cast("long")


def set_targets(sizes: DataFrame, weights: Sequence[float], share: float, passes: int, scratch: Scratch) -> DataFrame:
    """``sizes`` (source, source_size, ...) with ``target``: shares of ``share`` times all sizes by weight,
    none above ``passes`` times its size, the excess reshared. Sources weigh ``weights`` in turn."""
    order = F.col("source").asc_nulls_last()  # by code point
    parts = 1 + sizes.count() // 1_000_000
    placed = scratch.keep(sizes.repartitionByRange(parts, order).sortWithinPartitions(order)
                          .withColumn("at", F.monotonically_increasing_id()), "placed")
    # a place is the row's number in its partition and the rows of the partitions before
    part = F.shiftright("at", 33)
    before, shift = 0, []
    for r in placed.groupBy(part.alias("p")).count().orderBy("p").collect():
        shift.append(F.when(part == r["p"], before))
        before += r["count"]
    place = F.col("at").bitwiseAND((1 << 33) - 1) + F.coalesce(*shift, F.lit(0))
    weigh = F.get(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights)).cast("int"))
    weighed = placed.withColumn("weight", weigh).withColumn("cap", F.lit(passes) * F.col("source_size"))
    total, weight = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    left, level, capped = share * (total or 0), float("inf"), -1
    if weight:
        level = left / weight
        while True:  # the level rises until it caps no further source
            full = F.col("cap") / F.col("weight") <= level
            n, cap, of = weighed.where(full).agg(F.count(F.lit(1)), F.sum("cap"), F.sum("weight")).first()
            if n == capped:
                break
            capped, of = n, of or 0.0
            level = (left - (cap or 0)) / (weight - of) if weight > of else float("inf")
    return weighed.withColumn("target", F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight"))).drop("at", "weight", "cap")


def min_cost_flow(patterns: Mapping[tuple, int], quotas: Mapping[object, int], passes: int) -> dict[tuple[tuple, object], int]:
    """Words from each pattern to each of its sources: the largest flow of the least repetition cost.

    ``patterns``: size of each set of sources. Successive shortest paths; as every cost lies on the
    arcs that enter patterns, the k-th phase opens the k-th pass and augments along breadth-first
    paths of the residual network.
    """
    used = {p: 0 for p in patterns}
    room = dict(quotas)
    flow: dict[tuple[tuple, object], int] = {}
    of_source: dict[object, set[tuple]] = {}
    for p in patterns:
        for s in p:
            of_source.setdefault(s, set()).add(p)
    for k in range(1, passes + 1):
        for start in sorted(patterns, key=repr):
            while used[start] < k * patterns[start]:
                came: dict[tuple, object] = {("p", start): None}
                queue, end = deque([("p", start)]), None
                while queue and end is None:
                    node = queue.popleft()
                    if node[0] == "p":
                        for s in node[1]:
                            if ("s", s) not in came:
                                came["s", s] = node
                                if room.get(s, 0) > 0:
                                    end = ("s", s)
                                    break
                                queue.append(("s", s))
                    else:
                        for p in of_source[node[1]]:
                            if flow.get((p, node[1]), 0) > 0 and ("p", p) not in came:
                                came["p", p] = node
                                queue.append(("p", p))
                if end is None:
                    break
                path = [end]
                while came[path[-1]] is not None:
                    path.append(came[path[-1]])
                path.reverse()
                amount = min(k * patterns[start] - used[start], room[end[1]],
                             *[flow[b[1], a[1]] for a, b in zip(path, path[1:], strict=False) if a[0] == "s"])
                for a, b in zip(path, path[1:], strict=False):
                    if a[0] == "p":
                        flow[a[1], b[1]] = flow.get((a[1], b[1]), 0) + amount
                    else:
                        flow[b[1], a[1]] -= amount
                used[start] += amount
                room[end[1]] -= amount
    return {k: v for k, v in flow.items() if v}


def order_digest(seed: str, id_col: str, text: Column) -> Column:
    own = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), own, F.lit(":"), F.md5(text.cast("binary"))).cast("binary"))


def takes(sized: DataFrame, weights: Sequence[float], share: float, passes: int, scratch: Scratch) -> DataFrame:
    """(ps, n, take, source_size, target) of every membership pattern ``ps``."""
    spark = sized.sparkSession
    totals = scratch.keep(sized.groupBy("sources").agg(F.sum("size").alias("n")), "patterns")
    by_source = totals.select(F.explode("sources").alias("source"), "n", F.size("sources").alias("width")).groupBy("source").agg(
        F.sum("n").alias("source_size"), F.max("width").alias("width"))
    told = scratch.keep(set_targets(by_source, weights, share, passes, scratch), "targets")
    headed = totals.select("sources", "n", F.get("sources", F.lit(0)).alias("head"), F.size("sources").alias("own"))
    headed = headed.join(told, F.col("head").eqNullSafe(F.col("source")) & (F.col("own") > 0), "left")

    # patterns that share a source with another one, and the quotas of their sources
    shared = totals.withColumn("s", F.explode("sources")).join(told, F.col("s").eqNullSafe(F.col("source")))
    knotted = shared.groupBy("sources", "n").agg(
        F.max("width").alias("width"), F.collect_list(F.struct(F.col("s"), F.col("target"))).alias("t")).where("width > 1")
    net = knotted.limit(MAX_PATTERNS + 1).collect()
    if len(net) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} overlapping membership patterns")
    quotas = {t["s"]: int(t["target"] + 0.5) for r in net for t in r["t"]}
    flow = min_cost_flow({tuple(r["sources"]): int(r["n"]) for r in net}, quotas, passes)
    solved: dict[tuple, int] = {tuple(r["sources"]): 0 for r in net}
    for (p, _), amount in flow.items():
        solved[p] += amount
    kind = sized.schema["sources"].dataType.simpleString()
    solution = spark.createDataFrame([(list(p), x) for p, x in solved.items()], f"fs {kind}, solved bigint")
    alone = F.least(F.floor(F.col("target") + 0.5), passes * F.col("n"))
    return headed.join(F.broadcast(solution), F.col("sources").eqNullSafe(F.col("fs")), "left").select(
        F.col("sources").alias("ps"), "n", F.coalesce("solved", alone, F.lit(0)).cast("bigint").alias("take"),
        F.coalesce("source_size", F.lit(0)).cast("bigint").alias("source_size"), F.coalesce("target", F.lit(0.0)).alias("target"))


def mix(docs: DataFrame, sources: Column, id_col: str = "doc_id", text: str = "text", seed: str = "mix",
        weights: Sequence[float] = WEIGHTS, share: float = SHARE, passes: int = MAX_PASSES) -> DataFrame:
    """One row per row of ``docs``: id, sources, size, source_size and target (of its first source), taken.

    ``sources``: array of the sources of a row. Sources, by code point and null last, weigh
    ``weights`` in turn and share ``share`` times all sizes.
    """
    scratch = Scratch(docs.sparkSession)
    member = F.array_sort(F.array_distinct(sources))
    sized = scratch.keep(docs.select(
        F.col(id_col).alias("id"), member.alias("sources"),
        words_in(text_of(text)).alias("size"), order_digest(seed, id_col, text_of(text)).alias("digest"),
        F.monotonically_increasing_id().alias("row")), "sized")
    rest = F.when(F.col("n") > 0, F.col("take") % F.col("n")).otherwise(0)
    whole = F.when(F.col("n") > 0, F.least(F.expr("take div n"), F.lit(passes))).otherwise(0)
    plan = scratch.keep(takes(sized, weights, share, passes, scratch).select(
        "ps", whole.alias("passes"), rest.alias("rest"), "source_size", "target"), "plan")

    # where the rest of each pattern ends in the seeded order
    same = F.col("sources").eqNullSafe(F.col("ps"))
    spread = F.md5(F.concat_ws(":", "digest", F.col("row").cast("string")).cast("binary"))
    cells = sized.join(plan.select("ps", F.col("rest").alias("left")), same).where("left > 0").select("sources", "digest", "row", "size", "left")
    levels = [F.substring("digest", 1, 3), F.substring("digest", 4, 3), F.col("digest"),
              F.substring(spread, 1, 3), F.substring(spread, 4, 3)]
    for level, part in enumerate(levels):
        hist = cells.groupBy("sources", "left", part.alias("c")).agg(F.sum("size").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("sources").orderBy("c"))
        edge = hist.withColumn("upto", upto).where("upto >= left and upto - n < left").select(
            F.col("sources").alias("ps"), "c", (F.col("left") - F.col("upto") + F.col("n")).alias("next"))
        cells = cells.join(scratch.keep(edge, f"edge-{level}"), same & (part == F.col("c"))).select(
            "sources", "digest", "row", "size", F.col("next").alias("left"))
        if level == 1:  # few rows are left, but for equal ones
            cells = scratch.keep(cells, "cells")
    at = F.struct("digest", spread.alias("spread"))
    peers = cells.groupBy("sources", "left", at.alias("at")).agg(F.sum("size").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("sources").orderBy("at"))
    ended = peers.withColumn("upto", upto).where("upto - n < left")
    nearer = (F.col("upto") <= F.col("left")) | (F.col("upto") - F.col("left") < F.col("left") - F.col("upto") + F.col("n"))
    last = ended.groupBy("sources").agg(F.max(F.when(nearer, F.col("at"))).alias("last"), F.min("at").alias("first"))
    ends = scratch.keep(plan.join(last, same, "left").drop("sources"), "ends")

    # no document of the cell is taken: everything before its first document is
    chosen = F.when(F.col("last").isNotNull(), at <= F.col("last")).when(F.col("first").isNotNull(), at < F.col("first")).otherwise(False)
    times = F.col("passes") + F.when((F.col("rest") > 0) & chosen, 1).otherwise(0)
    return sized.join(ends, same).select(F.col("id").alias(id_col), "sources", "size", "source_size", "target",
                                         (F.col("size") * F.least(times, F.lit(passes))).cast("long").alias("taken"))
