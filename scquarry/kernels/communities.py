"""Clusters of a weighted graph by modularity, at several resolutions at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scquarry.functions.text import each_of
from scquarry.session import materialize

ROUNDS, LEAST_MOVED = 10, 0.002


def _moves(edges: DataFrame, state: DataFrame, total: float, rounds: int, seed: int) -> DataFrame:
    """state (resolution, id, degree, c) after rounds in which half of the nodes may join the neighbouring group of most gain.

    Edges may belong to a resolution or, without that column, to all.
    """
    on = ["resolution", "dst"] if "resolution" in edges.columns else ["dst"]
    for n in range(rounds):
        size = state.groupBy("resolution", "c").agg(F.sum("degree").alias("size"))
        near = edges.join(state.select("resolution", F.col("id").alias("dst"), F.col("c").alias("to")), on)
        near = near.groupBy("resolution", F.col("src").alias("id"), "to").agg(F.sum("weight").alias("w"))
        # staying is a choice too, even without a neighbour in the own group
        stay = state.select("resolution", "id", F.col("c").alias("to"), F.lit(0.0).alias("w"))
        near = near.unionByName(stay).groupBy("resolution", "id", "to").agg(F.sum("w").alias("w"))
        x = near.join(state, ["resolution", "id"]).join(size.withColumnRenamed("c", "to"), ["resolution", "to"])
        own = F.when(F.col("to") == F.col("c"), F.col("degree")).otherwise(0.0)
        gain = F.col("w") - F.col("resolution") * F.col("degree") * (F.col("size") - own) / total
        best = x.withColumn("gain", F.round(gain, 9)).groupBy("resolution", "id").agg(
            F.max(F.struct("gain", (F.col("to") == F.col("c")).alias("stay"), F.xxhash64("to", F.lit(seed)).alias("tie"), "to")).alias("b"), F.first("degree").alias("degree"), F.first("c").alias("c")
        )
        turn = F.pmod(F.xxhash64("id", F.lit(n), F.lit(seed)), F.lit(2)) == 0
        state = materialize(best.select("resolution", "id", "degree", F.when(turn, F.col("b.to")).otherwise(F.col("c")).alias("c"), (turn & (F.col("b.to") != F.col("c"))).alias("moved")), "moves")
        moved = state.agg(F.avg(F.col("moved").cast("double"))).first()[0] or 0.0
        state = state.drop("moved")
        if moved < LEAST_MOVED:
            break
    return state


def communities(edges: DataFrame, nodes: DataFrame, resolutions: list[float], seed: int = 42, rounds: int = ROUNDS, levels: int | None = None) -> DataFrame:
    """cell_id, resolution, cluster (0, 1, ... by size, then by the smallest member): groups of high modularity.

    edges: src, dst, weight (each undirected edge once); nodes: cell_id. All resolutions move in the same rounds. Nodes move in
    halves by a seeded hash, so that results don't depend on partitions; groups found in one level are the nodes of the next,
    until a level joins no groups (or for so many levels). A node without edges stays alone.
    """
    both = edges.select("src", "dst", F.col("weight").cast("double").alias("weight"))
    both = materialize(both.union(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")), "edges")
    total = both.agg(F.sum("weight")).first()[0] or 1.0
    degree = nodes.select(F.col("cell_id").alias("id")).join(both.groupBy(F.col("src").alias("id")).agg(F.sum("weight").alias("degree")), "id", "left")
    start = degree.select("id", F.coalesce("degree", F.lit(0.0)).alias("degree"), F.col("id").alias("c"), each_of([float(r) for r in resolutions], "double").alias("resolution")).select("resolution", "id", "degree", "c")
    state = _moves(both, materialize(start, "start"), total, rounds, seed)
    out = state.select("resolution", F.col("id").alias("cell_id"), "c")
    level, left = 0, None
    while levels is None or level + 1 < levels:
        before, left = left, state.select("resolution", "c").distinct().count()
        if left == before:
            break
        level += 1
        # groups as nodes: an edge belongs to the resolution whose groups it joins
        a = state.select("resolution", F.col("id").alias("src"), F.col("c").alias("s"))
        b = state.select(F.col("resolution").alias("_r"), F.col("id").alias("dst"), F.col("c").alias("d"))
        g = (both if level == 1 else grouped).join(a, "src" if level == 1 else ["resolution", "src"])
        g = g.join(b, (g["dst"] == b["dst"]) & (g["resolution"] == b["_r"])).select("resolution", F.col("s").alias("src"), F.col("d").alias("dst"), "weight")
        grouped = materialize(g.groupBy("resolution", "src", "dst").agg(F.sum("weight").alias("weight")), "groups")
        upper = state.groupBy("resolution", F.col("c").alias("id")).agg(F.sum("degree").alias("degree")).select("resolution", "id", "degree", F.col("id").alias("c"))
        state = _moves(grouped.filter("src <> dst"), materialize(upper, "upper"), total, rounds, seed + level)
        out = out.join(state.select("resolution", F.col("id").alias("c"), F.col("c").alias("_c")), ["resolution", "c"]).select("resolution", "cell_id", F.col("_c").alias("c"))
    sizes = out.groupBy("resolution", "c").agg(F.count(F.lit(1)).alias("n"), F.min("cell_id").alias("first"))
    name = (F.row_number().over(W.partitionBy("resolution").orderBy(F.desc("n"), "first")) - 1).cast("string").alias("cluster")
    return out.join(sizes.select("resolution", "c", name), ["resolution", "c"]).select("cell_id", "resolution", "cluster")


def modularity(edges: DataFrame, assignments: DataFrame) -> DataFrame:
    """resolution, modularity of a clustering (cell_id, resolution, cluster) of a graph."""
    both = edges.select("src", "dst", "weight").union(edges.select(F.col("dst"), F.col("src"), "weight"))
    total = both.agg(F.sum("weight")).first()[0] or 1.0
    a = assignments.select(F.col("cell_id").alias("src"), "resolution", F.col("cluster").alias("a"))
    b = assignments.select(F.col("cell_id").alias("dst"), F.col("resolution").alias("_r"), F.col("cluster").alias("b"))
    e = both.join(a, "src").join(b, ["dst"]).filter("resolution = _r")
    inside = e.groupBy("resolution").agg(F.sum(F.when(F.col("a") == F.col("b"), F.col("weight")).otherwise(0.0)).alias("i"))
    size = e.groupBy("resolution", "a").agg(F.sum("weight").alias("s")).groupBy("resolution").agg(F.sum(F.col("s") * F.col("s")).alias("q"))
    return inside.join(size, "resolution").select("resolution", (F.col("i") / total - F.col("q") / (total * total)).alias("modularity"))
