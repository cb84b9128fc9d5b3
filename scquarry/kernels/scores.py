"""Scores of gene sets per cell and the phase of the cell cycle."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scquarry.functions.text import each_of
from scquarry.session import materialize, sent_if_small

BINS = 24
#: Sets whose scores are added up side by side; with more, every value goes to each of its gene's sets.
SIDE_BY_SIDE = 16
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def control_size(sizes: list[int], n_genes: int) -> int:
    """Control genes per gene of a set: the smallest set's size, but less than a bin of genes holds."""
    return min(min(sizes), max(1, n_genes // BINS - 1))


def xxhash(data: bytes, seeds: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of one value (little-endian number or UTF-8) from many seeds (unsigned)."""
    turn = lambda x, n: (x << np.uint64(n)) | (x >> np.uint64(64 - n))
    word = lambda at, n: np.full(1, int.from_bytes(data[at : at + n], "little"), np.uint64)
    at, size = 0, len(data)
    if size >= 32:
        v = [seeds + _P1 + _P2, seeds + _P2, seeds.copy(), seeds - _P1]
        for at in range(0, size - 31, 32):
            v = [turn(x + word(at + 8 * j, 8) * _P2, 31) * _P1 for j, x in enumerate(v)]
        at += 32
        h = turn(v[0], 1) + turn(v[1], 7) + turn(v[2], 12) + turn(v[3], 18)
        for x in v:
            h = (h ^ (turn(x * _P2, 31) * _P1)) * _P1 + _P4
    else:
        h = seeds + _P5
    h = h + np.uint64(size)
    while at + 8 <= size:
        h, at = turn(h ^ (turn(word(at, 8) * _P2, 31) * _P1), 27) * _P1 + _P4, at + 8
    if at + 4 <= size:
        h, at = turn(h ^ (word(at, 4) * _P1), 23) * _P2 + _P3, at + 4
    for at in range(at, size):
        h = turn(h ^ (word(at, 1) * _P5), 11) * _P1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def control_genes(bins: DataFrame, sets: DataFrame, control: int, seed: int) -> DataFrame:
    """set_name, gene_id: the control genes that the genes of a set draw from their own bins, each control ones, the first by
    xxhash64(gene_id, own gene, seed).

    One task holds a bin (a 24th of the genes) and the sets' genes in it, not their pairs: the hashes of the bin are made anew
    for each gene of a set, until all genes of the bin are drawn, which further ones can't change.
    """
    kind, name = bins.schema["gene_id"].dataType.simpleString(), sets.schema["set_name"].dataType.simpleString()
    width = {"tinyint": 4, "smallint": 4, "int": 4, "bigint": 8}.get(kind)
    value = lambda x: int(x).to_bytes(width, "little", signed=True) if width else str(x).encode()
    last = seed.to_bytes(4, "little", signed=True)

    def draw(members: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        members = members.sort_values("gene_id")
        seeds, found = members["_h"].to_numpy(np.int64).view(np.uint64), []
        for s, genes in own.groupby("set_name"):
            taken = np.zeros(len(members), bool) if control < len(members) else np.ones(len(members), bool)
            for g in genes["own_gene"] if control > 0 else ():
                if taken.all():
                    break
                h = xxhash(last, xxhash(value(g), seeds)).view(np.int64)
                cut = np.partition(h, control - 1)[control - 1]
                taken |= h < cut
                taken[np.flatnonzero(h == cut)[: control - int((h < cut).sum())]] = True
            found.append(pd.DataFrame({"set_name": s, "gene_id": members["gene_id"][taken]}))
        return pd.concat(found) if found else pd.DataFrame({"set_name": own["set_name"][:0], "gene_id": members["gene_id"][:0]})

    members = bins.select("bin", "gene_id", F.xxhash64("gene_id").alias("_h")).repartition(BINS, "bin")
    own = sets.select(F.col("bin").alias("own_bin"), "set_name", F.col("gene_id").alias("own_gene")).repartition(BINS, "own_bin")
    return members.groupBy("bin").cogroup(own.groupBy("own_bin")).applyInPandas(lambda p, q: draw(p, q), f"set_name {name}, gene_id {kind}")


def module_scores(data: DataFrame, cells: DataFrame, genes: DataFrame, sets: DataFrame, control: int, seed: int = 42, value: str = "data") -> DataFrame:
    """cell_id, set_name, score: the mean of a set's genes less that of its control genes, zeros included.

    sets: set_name, gene_id. Genes are cut into BINS bins of equal size by their mean; every gene of a set draws control genes
    from its own bin by a seeded hash. Sets and controls become weights of genes, so that scores are one weighted sum over the
    non-zero values.
    """
    n = F.lit(cells.count())
    means = genes.select("gene_id").join(data.groupBy("gene_id").agg((F.sum(value) / n).alias("m")), "gene_id", "left").withColumn("m", F.coalesce("m", F.lit(0.0)))
    bins = materialize(means.select("gene_id", F.ntile(BINS).over(W.partitionBy(F.lit(0)).orderBy("m", F.xxhash64("gene_id"))).alias("bin")), "bins")  # one row per gene
    sets = materialize(sets.join(bins, "gene_id"), "sets")
    controls = materialize(control_genes(bins, sets, control, seed), "controls")
    size = lambda x, s: x.join(x.groupBy("set_name").agg(F.count(F.lit(1)).alias("_c")), "set_name").select("set_name", "gene_id", (F.lit(s) / F.col("_c")).alias("weight"))
    weights = size(sets.select("set_name", "gene_id"), 1.0).union(size(controls, -1.0))
    names = sorted(r["set_name"] for r in sets.select("set_name").distinct().collect())  # all of them: as few as the sets
    if 0 < len(names) <= SIDE_BY_SIDE:  # one row per gene: no value is sent once for each set
        wide = materialize(weights.groupBy("gene_id").agg(*[F.sum(F.when(F.col("set_name") == n, F.col("weight"))).alias(f"_w{i}") for i, n in enumerate(names)]), "weights")
        s = data.join(sent_if_small(wide), "gene_id").groupBy("cell_id").agg(*[F.sum(F.col(value) * F.col(f"_w{i}")).alias(f"_s{i}") for i in range(len(names))])
        each = F.explode(F.array(*[F.struct(F.lit(n).alias("set_name"), F.col(f"_s{i}").alias("score")) for i, n in enumerate(names)]))
        s = s.select("cell_id", each.alias("_e")).select("cell_id", "_e.*")
    else:
        weights = weights.groupBy("set_name", "gene_id").agg(F.sum("weight").alias("weight"))
        s = data.join(weights, "gene_id").groupBy("cell_id", "set_name").agg(F.sum(F.col(value) * F.col("weight")).alias("score"))
    grid = cells.select("cell_id", each_of(names, "string").alias("set_name"))
    return grid.join(s, ["cell_id", "set_name"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))


def cycle_phase(scores: DataFrame) -> DataFrame:
    """cell_id, s_score, g2m_score, phase, cc_difference from scores of the sets S and G2M; an exact tie above zero is Undecided."""
    w = scores.groupBy("cell_id").agg(F.max(F.when(F.col("set_name") == "S", F.col("score"))).alias("s_score"), F.max(F.when(F.col("set_name") == "G2M", F.col("score"))).alias("g2m_score"))
    s, g = F.col("s_score"), F.col("g2m_score")
    phase = F.when((s < 0) & (g < 0), "G1").when(s > g, "S").when(g > s, "G2M").otherwise("Undecided")
    return w.withColumns({"phase": phase, "cc_difference": s - g})
