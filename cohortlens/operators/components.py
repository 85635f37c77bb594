"""Connected components of an edge table by alternating large-star / small-star rounds
(Kiveris et al., "Connected Components in MapReduce and Beyond", SoCC 2014).

Each round is two shuffles of the edge table; the number of rounds is O(log^2 n). The edge
table is checkpointed every round into the session's checkpoint folder, so lineage stays short
and a lost executor only repeats the current round. A hub's edges are split over salted sub-hubs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.session import ensure_checkpoint_dir, materialize


def _undirected(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.where(F.col("a") != F.col("b")).distinct()


WHOLE_EDGES = 1 << 16  # up to so many edges any task may hold all
HUB_SHARE = 1000  # a task gets about one in so many edges of a hub


def _minima(e: DataFrame) -> DataFrame:
    return e.groupBy("a").agg(F.min("b").alias("mb"), F.count(F.lit(1)).alias("degree"))


def with_minimum(e: DataFrame, n_edges: int) -> DataFrame:
    """Every edge (a, b) with ``mb``, the least neighbour of a.

    The least neighbours come from map-side combined minima. A hub's edges do not meet in one task: they are dealt to
    sub-hubs (a, salt) by their other end, and each sub-hub has a copy of the hub's minimum. Hubs have more than one in
    HUB_SHARE of the edges, so there are fewer than HUB_SHARE of them, and they are broadcast."""
    mins = _minima(e)
    if n_edges <= WHOLE_EDGES:
        return e.join(mins.drop("degree"), "a")
    chunk = max(1, n_edges // HUB_SHARE)
    salts = F.ceil(F.col("degree") / chunk).cast("int")
    hubs = mins.where(F.col("degree") > chunk).select("a", salts.alias("salts"))
    dealt = e.join(F.broadcast(hubs), "a", "left").withColumn("salt", F.pmod(F.xxhash64("b"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
    return dealt.join(mins.select("a", "mb", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt")), ["a", "salt"]).drop("salt")


def _large_star(e: DataFrame, n_edges: int) -> DataFrame:
    m = F.least(F.col("a"), F.col("mb"))
    out = with_minimum(e, n_edges).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), m.alias("b"))
    return _undirected(out)


def _small_star(e: DataFrame, n_edges: int) -> DataFrame:
    smaller = e.where(F.col("b") < F.col("a"))
    m = F.least(F.col("a"), F.col("mb"))
    leaves = with_minimum(smaller, n_edges).select(F.col("b").alias("a"), m.alias("b"))
    centre = _minima(smaller).select(F.col("a"), m.alias("b"))
    return _undirected(leaves.unionByName(centre))


def _signature(e: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    r = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"),
              F.sum(F.pmod(h, F.lit(2147483647))).alias("s")).first()
    return (r["n"], r["x"], r["s"])


def connected_components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """nodes(node LONG), edges(a LONG, b LONG) -> (node, component) with component = min node id.

    Every round's edge table is written to the shared checkpoint folder and read back, so
    lineage and plan size stay flat (measured: letting the plan grow over rounds costs far more
    than the write) and a lost executor only repeats the current round.
    """
    ensure_checkpoint_dir(nodes.sparkSession)
    e = _undirected(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")))
    e = materialize(e, "cc-edges")
    sig = _signature(e)
    for _ in range(max_rounds):
        nxt = materialize(_small_star(_large_star(e, sig[0]), sig[0]), "cc-round")  # one computation, lineage cut
        new_sig = _signature(nxt)
        e = nxt
        if new_sig == sig:
            break
        sig = new_sig
    else:
        raise RuntimeError("connected components did not converge")
    comp = e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("mb"))
    return (nodes.select(F.col("node").cast("long").alias("node")).join(comp, "node", "left")
            .select("node", F.least(F.col("node"), F.coalesce(F.col("mb"), F.col("node"))).alias("component")))
