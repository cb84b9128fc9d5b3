"""Sparse count matrices as rows: totals, filters, normalization, reconciliation, comparison and validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cell_totals(counts: DataFrame, cells: DataFrame, families: dict[str, Column | str] | None = None) -> DataFrame:
    """cells with ncount, nfeature and, per family, the percentage of counts in genes for which its flag (a column of counts) holds.

    Cells without counts have zeros and null percentages; counts of unknown cells are dropped; values of zero are no features.
    """
    families = families or {}
    flag = lambda f: f if isinstance(f, Column) else F.col(f)
    sums = counts.groupBy("cell_id").agg(
        F.sum("value").alias("ncount"), F.count(F.when(F.col("value") > 0, 1)).alias("nfeature"), *[F.sum(F.when(flag(f), F.col("value")).otherwise(0.0)).alias(n) for n, f in families.items()]
    )
    share = [F.when(F.col("ncount") > 0, F.col(n) * 100 / F.col("ncount")).alias(n) for n in families]
    out = cells.join(sums, "cell_id", "left").withColumns({"ncount": F.coalesce("ncount", F.lit(0.0)), "nfeature": F.coalesce("nfeature", F.lit(0))})
    return out.select(*cells.columns, "ncount", "nfeature", *share)


def keep_input_values(cells: DataFrame, metrics: DataFrame, fields: Sequence[str]) -> DataFrame:
    """metrics with <field>_input_metadata (what the input claimed) and <field>_before_qc (the first recomputed value), each written once.

    cells holds the input's metadata; where it already has such a column, that one is kept.
    """
    old = cells.select("cell_id", *[F.col(c).alias("_" + c) for c in cells.columns if c != "cell_id"])
    out = metrics.join(old, "cell_id", "left")
    for f in fields:
        claimed, before = f"{f}_input_metadata", f"{f}_before_qc"
        out = out.withColumn(claimed, F.col("_" + (claimed if claimed in cells.columns else f))) if claimed in cells.columns or f in cells.columns else out.withColumn(claimed, F.lit(None).cast("double"))
        out = out.withColumn(before, F.coalesce(F.col("_" + before), F.col(f)) if before in cells.columns else F.col(f))
    return out.drop(*["_" + c for c in cells.columns if c != "cell_id"])


def gene_prevalence(counts: DataFrame, genes: DataFrame, more_than: int, cells: DataFrame | None = None) -> DataFrame:
    """gene_id, n_cells with the gene (of the given cells) and retained; genes never seen have 0."""
    used = counts if cells is None else counts.join(cells.select("cell_id"), "cell_id", "left_semi")
    seen = used.filter("value > 0").groupBy("gene_id").agg(F.count(F.lit(1)).alias("n_cells"))
    out = genes.select("gene_id").join(seen, "gene_id", "left").withColumn("n_cells", F.coalesce("n_cells", F.lit(0)))
    return out.withColumn("retained", F.col("n_cells") > more_than)


def min_cells_features(counts: DataFrame, min_cells: int = 3, min_features: int = 200, sequential: bool = False) -> DataFrame:
    """counts of genes in min_cells cells or more and cells of min_features genes or more, over all samples together.

    Both are counted on the unfiltered matrix unless sequential, which counts a cell's genes after the genes are filtered.
    """
    genes = counts.groupBy("gene_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_cells)
    some = counts.join(genes, "gene_id", "left_semi")
    cells = (some if sequential else counts).groupBy("cell_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_features)
    return some.join(cells, "cell_id", "left_semi")


def feature_names(c: Column) -> Column:
    """Gene names as objects store them: underscores become hyphens."""
    return F.regexp_replace(c, "_", "-")


def first_matches(wanted: DataFrame, genes: DataFrame) -> DataFrame:
    """The genes whose name equals a wanted name whatever the case, of several the first in gene_ord: name, gene_id."""
    found = wanted.select(F.upper("name").alias("name")).distinct().join(genes.select(F.upper("gene_name").alias("name"), "gene_id", "gene_ord"), "name")
    return found.groupBy("name").agg(F.min_by("gene_id", F.struct("gene_ord", "gene_id")).alias("gene_id"))


def sample_sizes(counts: DataFrame, cells: DataFrame) -> DataFrame:
    """Per sample its cells, those of them with counts, and the genes detected in any; each gene of a sample counts once."""
    size = cells.groupBy("sample").agg(F.count(F.lit(1)).alias("cells"))
    some = counts.filter("value > 0").join(cells.select("cell_id", "sample"), "cell_id")
    seen = some.groupBy("sample", "cell_id").agg(F.count(F.lit(1)).alias("_n")).groupBy("sample").agg(F.count(F.lit(1)).alias("cells_with_counts"))
    genes = some.groupBy("sample", "gene_id").agg(F.count(F.lit(1)).alias("_n")).groupBy("sample").agg(F.count(F.lit(1)).alias("genes_detected"))
    out = size.join(seen, "sample", "left").join(genes, "sample", "left")
    return out.select("sample", "cells", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("cells_with_counts", "genes_detected")])


def log_normalize(counts: DataFrame, totals: DataFrame, scale: float = 1e4) -> DataFrame:
    """counts with data = ln(1 + scale * value / ncount); zeros stay out."""
    return counts.join(totals.select("cell_id", "ncount"), "cell_id").withColumn("data", F.log1p(F.col("value") * scale / F.col("ncount")))


def gene_moments(data: DataFrame, value: str, n_cells: Column) -> DataFrame:
    """Per gene n (non-zeros), mean and sample variance of value over all n_cells cells, zeros included."""
    s = data.groupBy("gene_id").agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("_s"), F.sum(F.col(value) * F.col(value)).alias("_q"))
    return s.select("gene_id", "n", (F.col("_s") / n_cells).alias("mean"), ((F.col("_q") - F.col("_s") * F.col("_s") / n_cells) / (n_cells - 1)).alias("variance"))


def regression_coefficients(data: DataFrame, value: str, covariate: DataFrame, x: str) -> DataFrame:
    """Per gene intercept and slope of value on one covariate of the cells by least squares, zeros included.

    Sums over the non-zeros and over all cells are enough: n, sum x and sum x * x come from the cells, the rest from data.
    """
    c = covariate.select("cell_id", F.col(x).cast("double").alias("_x"))
    t = c.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_x"), F.lit(0.0)).alias("x"), F.coalesce(F.sum(F.col("_x") * F.col("_x")), F.lit(0.0)).alias("xx")).first()
    n, sx, sxx = F.lit(t["n"]), F.lit(t["x"]), F.lit(t["xx"])
    s = data.join(c, "cell_id").groupBy("gene_id").agg(F.sum(value).alias("_sy"), F.sum(F.col(value) * F.col("_x")).alias("_sxy"))
    slope = (n * F.col("_sxy") - sx * F.col("_sy")) / F.nullif(n * sxx - sx * sx, F.lit(0.0))
    return s.withColumn("slope", F.coalesce(slope, F.lit(0.0))).select("gene_id", ((F.col("_sy") - F.col("slope") * sx) / n).alias("intercept"), "slope")


def pool_with_map(cells: DataFrame, mapping: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """What keeps a cell map from covering a matrix exactly: problem, key. Empty when all is well.

    cells: cell_id of the matrix; mapping: cell_id, sample; expected: the samples that must occur, each and no other.
    """
    both = cells.select("cell_id", F.lit(True).alias("_c")).join(mapping.select("cell_id", F.lit(True).alias("_m")).distinct(), "cell_id", "full_outer")
    missing = both.filter("_m IS NULL").select(F.lit("CELL_NOT_MAPPED").alias("problem"), F.col("cell_id").cast("string").alias("key"))
    extra = both.filter("_c IS NULL").select(F.lit("MAPPED_CELL_MISSING").alias("problem"), F.col("cell_id").cast("string").alias("key"))
    twice = mapping.groupBy("cell_id").count().filter("count > 1").select(F.lit("CELL_MAPPED_TWICE").alias("problem"), F.col("cell_id").cast("string").alias("key"))
    out = missing.union(extra).union(twice)
    if expected is not None:
        s = mapping.select("sample").distinct().withColumn("_m", F.lit(True)).join(expected.select("sample").distinct().withColumn("_e", F.lit(True)), "sample", "full_outer")
        out = out.union(s.filter("_e IS NULL").select(F.lit("UNKNOWN_SAMPLE"), "sample")).union(s.filter("_m IS NULL").select(F.lit("SAMPLE_WITHOUT_CELLS"), "sample"))
    return out


def named_map(mapping: DataFrame, cell: str, sample: str) -> DataFrame:
    """A map of cells under its own names of columns as cell_id, sample; other columns of it are left behind."""
    return mapping.select(F.col(cell).cast("string").alias("cell_id"), F.col(sample).cast("string").alias("sample"))


def select_mapped(counts: DataFrame, cells: DataFrame, mapping: DataFrame, samples: Sequence[str], confirmed: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts of the cells of confirmed samples, the whole map with a flag selected, and sample, cells, selected.

    The map must cover the matrix. A part of its samples needs a confirmation; without one, samples must be all of them.
    """
    if not pool_with_map(cells, mapping).isEmpty():
        raise ValueError("the cell map does not cover the matrix exactly")
    wanted = F.col("sample").isin(*samples)
    if not confirmed and (not mapping.filter(~wanted).isEmpty() or mapping.select("sample").distinct().count() != len(set(samples))):
        raise ValueError("Cell map sample set must exactly match")
    flagged = mapping.withColumn("selected", wanted)
    own = flagged.filter("selected").select("cell_id")
    totals = flagged.groupBy("sample", "selected").agg(F.count(F.lit(1)).alias("cells"))
    return counts.join(own, "cell_id", "left_semi"), flagged, totals.select("sample", "cells", "selected")


def reconcile_features(a: DataFrame, b: DataFrame) -> DataFrame:
    """Genes that only one of two inputs has (gene_id, only_in): sets must be equal, nothing is intersected or filled with zeros."""
    x, y = a.select("gene_id").distinct(), b.select("gene_id").distinct()
    return x.join(y, "gene_id", "left_anti").withColumn("only_in", F.lit("a")).union(y.join(x, "gene_id", "left_anti").withColumn("only_in", F.lit("b")))


def sparse_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Entry-wise comparison on the genes and cells that both have: one row of n_common, n_mismatch, max_abs_delta."""
    common = lambda x, y, k: x.join(y.select(k).distinct(), k, "left_semi")
    x = common(common(a, b, "gene_id"), b, "cell_id").select("gene_id", "cell_id", F.col("value").alias("_a"))
    y = common(common(b, a, "gene_id"), a, "cell_id").select("gene_id", "cell_id", F.col("value").alias("_b"))
    delta = F.abs(F.coalesce("_a", F.lit(0.0)) - F.coalesce("_b", F.lit(0.0)))
    return x.join(y, ["gene_id", "cell_id"], "full_outer").agg(F.count(F.lit(1)).alias("n_common"), F.count(F.when(delta > 0, 1)).alias("n_mismatch"), F.coalesce(F.max(delta), F.lit(0.0)).alias("max_abs_delta"))


def contract_violations(counts: DataFrame, cells: DataFrame, required: Sequence[str] = ("sample", "grp"), integral: bool = True) -> DataFrame:
    """rule, n: how often each rule of the count and metadata contract is broken; n is 0 for a rule that holds."""
    v = F.col("value")
    blank = lambda c: c.isNull() | (F.trim(c.cast("string")) == "")
    bad = {"NOT_FINITE": v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), "NEGATIVE": v < 0, "BLANK_ID": blank(F.col("gene_id")) | blank(F.col("cell_id"))}
    if integral:
        bad["NOT_INTEGRAL"] = v != F.floor(v)
    one = counts.agg(*[F.count(F.when(c, 1)).alias(n) for n, c in bad.items()])
    meta = cells.agg(*[F.count(F.when(blank(F.col(c)), 1)).alias(f"BLANK_{c.upper()}") for c in required])
    rows = one.unpivot([], list(bad), "rule", "n").union(meta.unpivot([], [f"BLANK_{c.upper()}" for c in required], "rule", "n"))
    count = lambda df, name: df.agg(F.lit(name).alias("rule"), F.count(F.lit(1)).alias("n"))
    rows = rows.union(count(counts.groupBy("gene_id", "cell_id").count().filter("count > 1"), "REPEATED_ENTRY"))
    rows = rows.union(count(cells.groupBy("cell_id").count().filter("count > 1"), "REPEATED_CELL"))
    rows = rows.union(count(counts.select("cell_id").distinct().join(cells, "cell_id", "left_anti"), "CELL_WITHOUT_METADATA"))
    return rows.union(count(cells.join(counts.select("cell_id").distinct(), "cell_id", "left_anti"), "CELL_WITHOUT_COUNTS"))


def child_violations(parent: DataFrame, child: DataFrame) -> DataFrame:
    """Entries in which a child differs from its parent's submatrix on the child's cells and genes: side, gene_id, cell_id, value."""
    keys = ["gene_id", "cell_id", "value"]
    extra = child.select(keys).join(parent.select(keys), keys, "left_anti").withColumn("side", F.lit("child"))
    inside = parent.join(child.select("cell_id").distinct(), "cell_id", "left_semi").join(child.select("gene_id").distinct(), "gene_id", "left_semi")
    return extra.union(inside.select(keys).join(child.select(keys), keys, "left_anti").withColumn("side", F.lit("parent"))).select("side", *keys)


def corrected_violations(corrected: DataFrame, cells: DataFrame, contamination: str) -> DataFrame:
    """rule, n for a corrected matrix: finite, not negative; contamination of every cell known and within 0 and 1."""
    v, c = F.col("value"), F.col(contamination)
    a = corrected.agg(F.count(F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), 1)).alias("NOT_FINITE"), F.count(F.when(v < 0, 1)).alias("NEGATIVE"))
    b = cells.agg(F.count(F.when(c.isNull() | F.isnan(c) | (c < 0) | (c > 1), 1)).alias("CONTAMINATION_RANGE"))
    return a.unpivot([], ["NOT_FINITE", "NEGATIVE"], "rule", "n").union(b.unpivot([], ["CONTAMINATION_RANGE"], "rule", "n"))


def fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row that is equal for equal rows in any order: n_rows, hash_xor, hash_sum (of the hash's upper half, so that sums stay exact)."""
    h = F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("hash_xor"), F.coalesce(F.sum(F.shiftright(h, 32)), F.lit(0)).alias("hash_sum"))
