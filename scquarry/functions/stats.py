"""Statistics as DataFrame functions: distributed ranks, exact percentiles, correlation, association and agreement measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scquarry.session import materialize

#: Buckets of values into which each group is cut for ranking; a value with more than this part of all rows is a heavy tie.
BUCKETS, HEAVY = 64, 1000
#: Distinct values of a group that one task may sort; only groups with more are cut.
SORTED = 100_000


def finite(c: Column) -> Column:
    x = c.cast("double")
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def value_ranks(df: DataFrame, keys: Sequence[str], value: str, buckets: int = BUCKETS, also: dict[str, Column] | None = None, most: int = SORTED) -> DataFrame:
    """keys, value, n_equal, before (rows of the group with less) and n, one row per distinct finite value of a group.

    also names further aggregates of the rows of a value.

    Equal values are counted before anything is sorted, and written once. A group of more than most distinct values is cut into
    buckets at approximate quantiles and the places in a bucket are counted on from the sizes of those before it, so that no task
    sorts more of a group; the ranks are exact however the cuts fall. The many small groups need no quantiles, whose memory and
    joins would outgrow the values themselves. Groups without finite values have no rows.
    """
    also = also or {}
    counts = df.filter(finite(F.col(value))).groupBy(*keys, F.col(value).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n_equal"), *[a.alias(n) for n, a in also.items()])
    counts = materialize(counts, "values")
    along = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    upto = F.sum("n_equal").over(along.orderBy("value").rowsBetween(W.unboundedPreceding, 0))
    whole = lambda df: df.select(*keys, "value", "n_equal", (upto - F.col("n_equal")).alias("before"), F.sum("n_equal").over(along).alias("n"), *also)
    large = materialize(counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most).select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_n"), "large")
    if not large.count():
        return whole(counts)
    return whole(counts.join(large, _same(keys), "left_anti")).union(_cut_ranks(counts.join(large, _same(keys), "left_semi"), keys, buckets, also))


def _cut_ranks(counts: DataFrame, keys: Sequence[str], buckets: int, also: dict[str, Column]) -> DataFrame:
    """value_ranks() of groups too large for one task."""
    cuts = counts.groupBy(*keys).agg(F.percentile_approx("value", [i / buckets for i in range(1, buckets)], 1000).alias("_cuts"))
    same = lambda a, b: a.join(b.withColumnsRenamed({k: f"_k_{k}" for k in keys}), _same(keys), "inner").drop(*[f"_k_{k}" for k in keys])
    cut = same(counts, cuts).withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col("value")))).drop("_cuts")
    sizes = cut.groupBy(*keys, "_b").agg(F.sum("n_equal").alias("_s"))
    along = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    sizes = sizes.select(*keys, "_b", (F.sum("_s").over(along.orderBy("_b").rowsBetween(W.unboundedPreceding, 0)) - F.col("_s")).alias("_offset"), F.sum("_s").over(along).alias("n"))
    joined = cut.join(sizes.withColumnsRenamed({**{k: f"_k_{k}" for k in keys}, "_b": "_k_b"}), _same(keys) & (F.col("_b") == F.col("_k_b")))
    inside = W.partitionBy(*keys, "_b").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    return joined.select(*keys, "value", "n_equal", (F.col("_offset") + F.sum("n_equal").over(inside) - F.col("n_equal")).alias("before"), "n", *also)


def _same(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return out


def average_ranks(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """df's rows with finite values and their average rank (from 1; ties share the mean of their places) within keys.

    Values that many rows share (more than 1 / HEAVY of all rows: no more than HEAVY values) are joined by a broadcast, so that no
    task gets all rows of a tie; the others by a shuffle. df is read three times.
    """
    r = materialize(value_ranks(df, keys, value), "ranks")
    least = (r.agg(F.coalesce(F.sum("n_equal"), F.lit(0)).alias("t")).first()["t"] or 0) / HEAVY
    ranked = r.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("value").alias("_ranked"), (F.col("before") + (F.col("n_equal") + 1) / 2.0).alias(name), (F.col("n_equal") > F.lit(least)).alias("_heavy"))
    here = _same(keys) & (F.col(value).cast("double") == F.col("_ranked"))
    heavy, light = F.broadcast(ranked.filter("_heavy")), ranked.filter("NOT _heavy")
    rest = df.join(heavy.select("_ranked", *[f"_k_{k}" for k in keys]), here, "left_anti")
    return df.join(heavy, here).union(rest.join(light, here)).drop("_ranked", "_heavy", *[f"_k_{k}" for k in keys])


def percentiles(df: DataFrame, keys: Sequence[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """Exact percentiles (linear between neighbours) of the finite values per group, one column per name of wanted."""
    r = value_ranks(df, keys, value)
    p = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(q)).alias("p")) for n, q in wanted.items()])).alias("w")
    r = r.select(*keys, "value", "before", "n_equal", "n", p).withColumn("h", F.col("w.p") * (F.col("n") - 1))
    at = lambda i: F.when((F.col("before") <= i) & (i < F.col("before") + F.col("n_equal")), F.col("value"))
    r = r.withColumn("lo", at(F.floor("h"))).withColumn("hi", at(F.ceil("h"))).filter("lo IS NOT NULL OR hi IS NOT NULL")
    g = r.groupBy(*keys, "w.name").agg(F.max("lo").alias("lo"), F.max("hi").alias("hi"), F.max(F.col("h") - F.floor("h")).alias("part"))
    g = g.withColumn("v", F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part"))
    return g.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == n, F.col("v"))).alias(n) for n in wanted])


def spearman(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Per group n and rho of the rows with both values finite; rho is null with fewer than three rows or without variation."""
    both = df.filter(finite(F.col(x)) & finite(F.col(y))).select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    once = materialize(average_ranks(materialize(both, "pairs"), keys, "_x", "_rx").drop("_x"), "pairs")
    ranked = average_ranks(once, keys, "_y", "_ry")
    s = ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.covar_pop("_rx", "_ry").alias("_c"), (F.stddev_pop("_rx") * F.stddev_pop("_ry")).alias("_d"))
    return s.select(*keys, "n", F.when(F.col("n") >= 3, F.col("_c") / F.nullif(F.col("_d"), F.lit(0.0))).alias("rho"))


def eta_squared(df: DataFrame, keys: Sequence[str], group: str, x: str) -> DataFrame:
    """Per keys n and eta_squared: the share of x's variation that lies between groups; null without variation.

    Only sums, squares and numbers per group are sent. Rows with x not finite don't count; a null group is a group.
    """
    g = df.filter(finite(F.col(x))).groupBy(*keys, group).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col(x).cast("double")).alias("_s"), F.sum(F.col(x).cast("double") * F.col(x)).alias("_q"))
    a = g.groupBy(*keys).agg(F.sum("_n").alias("n"), F.sum("_s").alias("_s"), F.sum("_q").alias("_q"), F.sum(F.col("_s") * F.col("_s") / F.col("_n")).alias("_b"))
    mean = F.col("_s") * F.col("_s") / F.col("n")
    total = F.col("_q") - mean
    return a.select(*keys, "n", F.when(total > F.abs(F.col("_q")) * 1e-12, (F.col("_b") - mean) / total).alias("eta_squared"))


def adjusted_rand(df: DataFrame, keys: Sequence[str], a: str, b: str) -> DataFrame:
    """Per keys n and the adjusted Rand index of two labellings; where chance leaves no room, 1 for equal partitions and else 0."""
    pairs = lambda c: c * (c - 1) / 2.0
    cross = df.groupBy(*keys, a, b).agg(F.count(F.lit(1)).alias("_c"))
    rows = cross.groupBy(*keys, F.col(a)).agg(F.sum("_c").alias("_c"), F.count(F.lit(1)).alias("_m"))
    cols = cross.groupBy(*keys, F.col(b)).agg(F.sum("_c").alias("_c"), F.count(F.lit(1)).alias("_m"))
    kinds = {"_o": cross.withColumn("_m", F.lit(1)), "_r": rows, "_l": cols}
    parts = None
    for name, k in kinds.items():
        p = k.groupBy(*keys).agg(F.sum(pairs(F.col("_c"))).alias("s"), F.sum("_c").alias("n"), F.max("_m").alias("m")).withColumn("kind", F.lit(name))
        parts = p if parts is None else parts.unionByName(p)
    v = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    s = parts.groupBy(*keys).agg(v("_o", "s").alias("o"), v("_r", "s").alias("r"), v("_l", "s").alias("l"), F.max("n").alias("n"), (F.max("m") == 1).alias("equal"))
    expected = F.col("r") * F.col("l") / F.nullif(pairs(F.col("n")), F.lit(0.0))
    room = (F.col("r") + F.col("l")) / 2.0 - expected
    return s.select(*keys, "n", F.when(F.coalesce(F.abs(room), F.lit(0.0)) < 1.5e-8, F.when(F.col("equal"), 1.0).otherwise(0.0)).otherwise((F.col("o") - expected) / room).alias("ari"))


def pc_selection(spectrum: DataFrame, keys: Sequence[str], cumulative: float = 90.0, individual: float = 5.0, drop: float = 0.1, max_pc: int = 50, first_drop: bool = False) -> DataFrame:
    """How many components to keep per spectrum (keys, pc from 1, stdev): max_pc, sd_pick, drop_pick, pc_used, selection_method.

    Shares are those of the standard deviations. sd_pick is the first component with the cumulative share above and its own
    below the bounds; drop_pick the one after the last drop above the bound; the smaller counts, 20 if neither exists, and 2
    at least. Spectra hold a bounded number of components, one group each. first_drop takes the first drop above the bound instead of
    the last, and a cumulative share that reaches its bound instead of passing it: an earlier rule, kept as a control.
    """
    p = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    s = spectrum.filter(F.col("pc") <= max_pc)
    s = s.withColumn("_share", F.col("stdev") * 100 / F.sum("stdev").over(p))
    s = s.withColumn("_cum", F.sum("_share").over(p.orderBy("pc").rowsBetween(W.unboundedPreceding, 0))).withColumn("_drop", F.col("_share") - F.lead("_share").over(p.orderBy("pc")))
    g = s.groupBy(*keys).agg(
        F.max("pc").cast("int").alias("max_pc"),
        F.min(F.when(((F.col("_cum") >= cumulative) if first_drop else (F.col("_cum") > cumulative)) & (F.col("_share") < individual), F.col("pc"))).cast("int").alias("sd_pick"),
        ((F.min if first_drop else F.max)(F.when(F.col("_drop") > drop, F.col("pc"))) + 1).cast("int").alias("drop_pick"),
    )
    used = F.greatest(F.lit(2), F.least(F.coalesce(F.least("sd_pick", "drop_pick"), F.lit(20)), F.col("max_pc"))).cast("int")
    method = (
        F.when(F.col("sd_pick").isNotNull() & F.col("drop_pick").isNotNull(), "reference_sd_min_cumulative_last_drop")
        .when(F.col("sd_pick").isNotNull(), "reference_sd_cumulative_only")
        .when(F.col("drop_pick").isNotNull(), "reference_sd_last_drop_only")
        .otherwise("fallback_min_20_max_pc")
    )
    g = g.withColumns({"pc_used": used, "selection_method": method})
    return g.withColumn("low_dim_warning", (F.col("max_pc") >= 10) & (F.col("pc_used") <= 3))


def pc_cap(max_pcs: int, n_cells: int, n_hvg: int, n_genes: int) -> int:
    """The most components that the data allow."""
    return min(50, max_pcs, n_cells - 1, n_hvg - 1, n_genes - 1)


def rank_sum(df: DataFrame, keys: Sequence[str], value: str, inside: str, n_cells: DataFrame) -> DataFrame:
    """Per keys the Wilcoxon rank sum of the cells inside against the others, zeros included: n_in, n_out, u and z.

    df holds non-zero values (positive) with a flag inside; n_cells the numbers of all cells (one row of n_in and n_out). The cells
    without a row tie at zero, below all others.
    """
    # equal values are counted before they are ranked, those inside too: no row is joined to its rank
    r = value_ranks(df.select(*keys, F.col(value).cast("double").alias("_v"), F.col(inside).alias("_i")), keys, "_v", also={"_in": F.count(F.when(F.col("_i"), 1))})
    size = n_cells.select("n_in", "n_out").first()
    s = r.groupBy(*keys).agg(
        F.sum("n_equal").alias("_nz"),
        F.sum("_in").alias("_nzi"),
        F.sum(F.col("_in") * (F.col("before") + (F.col("n_equal") + 1) / 2.0)).alias("_s"),
        F.sum(F.pow("n_equal", F.lit(3)) - F.col("n_equal")).alias("_t"),
    )
    s = s.withColumns({c: F.lit(size[c]) for c in ("n_in", "n_out")})
    # doubles: products of numbers of cells outgrow integers
    n_in, n_out, nzi = (F.col(c).cast("double") for c in ("n_in", "n_out", "_nzi"))
    n = n_in + n_out
    zeros = n - F.col("_nz")
    rank = F.col("_s") + nzi * zeros + (n_in - nzi) * (zeros + 1) / 2.0
    u = rank - n_in * (n_in + 1) / 2.0
    tied = F.col("_t") + zeros * zeros * zeros - zeros
    sd = F.sqrt(n_in * n_out / 12.0 * ((n + 1) - tied / (n * (n - 1.0))))
    return s.select(*keys, "n_in", "n_out", u.alias("u"), F.when(sd > 0, (u - n_in * n_out / 2.0) / sd).alias("z"))
