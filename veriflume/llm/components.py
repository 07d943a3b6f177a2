"""Connected components of an edge table, by alternating large-star and small-star rounds.

Everything stays distributed: each round is two grouped minima and two joins; AQE may split the partition of a hub.
The edges of a round are written to the shared folder, so lineage stays short and lost executors cost one round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star round over rows ``(a, b)``; large: neighbours above the node, small: those below it and the node."""
    if large:
        pairs = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = pairs.join(least, "a")
    kept = joined.where("b > a") if large else joined
    out = kept.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:  # the node itself hangs on the minimum too
        out = out.unionAll(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node that has an edge; root is the smallest node of the component.

    ``edges`` has columns ``a, b`` of one orderable type; loops and repeats are harmless. Rounds go on until the edges
    no longer change (their number grows with the logarithm of the longest path).
    """
    now = materialise(edges.select("a", "b").where("a <> b").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        now = materialise(_star(_star(now, True), False), "edges")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("components did not settle")
    return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))


#: Rounds of comparisons with one node a key, unless before the pairs left are at most ``FEW`` times the members.
ROUNDS, FEW = 2, 4


def linked(
    members: DataFrame,
    verified: Callable[[DataFrame], DataFrame],
    start: DataFrame | None = None,
    possible: Callable[[str, str, str, str], Column] | None = None,
    able: Callable[[str, str, str], Column] | None = None,
) -> DataFrame:
    """Verified pairs ``a, b`` that join the same components as all verified pairs that meet at a key do.

    ``members`` has ``key, node, n`` and perhaps ``pos``: who meets where; ``verified`` keeps the good ones of pairs
    ``a, b``; ``start`` holds pairs known to be good; ``possible`` is a cheap condition on ``n, pos`` of two that each
    good pair meets at one of its keys, and ``able`` one on ``n, pos`` of a member and the least ``n`` at its key that
    every member of a possible pair meets. In each round all at a key are compared with one of them that are not yet in
    its component, at first with the one of the least ``pos``. When few pairs are left that meet and lie in different
    components, or after ``ROUNDS``, all of these are compared, so that no link is lost. Two that are already in one
    component are never compared: a key that many alike nodes share costs no square, and neither do those at it that
    are not able.
    """
    spark = members.sparkSession
    fits, able = possible or (lambda n, p, m, q: F.lit(True)), able or (lambda n, p, least: F.lit(True))
    members = members if "pos" in members.columns else members.withColumn("pos", F.lit(0))
    kind = members.schema["node"].dataType.simpleString()
    good = materialise(start, "links") if start is not None else spark.createDataFrame([], f"a {kind}, b {kind}")

    def placed() -> DataFrame:
        roots = components(good)
        return materialise(members.join(roots, "node", "left").select("key", "node", "n", "pos", F.coalesce("root", "node").alias("root")), "placed")

    def opened(now: DataFrame) -> DataFrame:
        """``key, least`` of keys where different components meet."""
        return now.groupBy("key").agg((F.min("root") != F.max("root")).alias("open"), F.min("n").alias("least")).where("open").select("key", "least")

    def apart(now: DataFrame) -> DataFrame:
        """Those of ``now`` that may be in a good pair across components."""
        some = materialise(now.join(opened(now), "key").where(able("n", "pos", "least")).drop("least"), "able")
        return materialise(some.join(opened(some), "key", "left_semi"), "apart")

    now = placed() if start is not None else members.withColumn("root", F.col("node"))
    total = members.count()
    for i in range(ROUNDS):
        by = F.struct(F.col("pos") if i == 0 else F.lit(0), F.xxhash64("node", F.lit(i)))
        hub = F.min_by(F.struct("node", "n", "pos", "root"), by).alias("hub")
        hubs = now.groupBy("key").agg(hub, (F.min("root") != F.max("root")).alias("open")).where("open")
        hubs = hubs.select("key", F.col("hub.node").alias("a"), F.col("hub.n").alias("n_a"), F.col("hub.pos").alias("pos_a"), F.col("hub.root").alias("root_a"))
        pairs = now.join(hubs, "key").where(fits("n", "pos", "n_a", "pos_a") & (F.col("root") != F.col("root_a"))).select("a", F.col("node").alias("b")).distinct()
        good = materialise(good.unionByName(verified(pairs)), "links")
        now = placed()
        left = apart(now)
        sizes = left.groupBy("key", "root").count().groupBy("key")
        ways = sizes.agg((F.sum("count") * F.sum("count") - F.sum(F.col("count") * F.col("count"))).alias("ways"))
        if (ways.agg(F.sum("ways")).first()[0] or 0) <= FEW * total:
            break
    other = left.select("key", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("pos").alias("pos_a"), F.col("root").alias("root_a"))
    across = (F.col("a") < F.col("node")) & (F.col("root") != F.col("root_a"))
    pairs = left.join(other, "key").where(fits("n", "pos", "n_a", "pos_a") & across).select("a", F.col("node").alias("b")).distinct()
    return materialise(good.unionByName(verified(pairs)), "links")
