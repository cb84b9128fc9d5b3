"""A score cutoff per source that keeps a target fraction of its records: sketch-bracketed exact selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scquarry.llm.quantiles import ranks, summarize
from scquarry.session import materialize

#: Rows of one source that a bracket may hold before it is narrowed by another summary of the bracket alone.
BRACKET_ROWS, ROUNDS = 1_000_000, 8


def cutoffs(records: DataFrame, targets: DataFrame, source: str = "source", score: str = "score", bracket_rows: int = BRACKET_ROWS) -> DataFrame:
    """Per source the least score such that at least keep_percent of its records score at most as high.

    records has source and score (null sources and null or NaN scores don't count); targets has source and
    keep_percent, at most one row a source; sources without a target are left out, as are sources without records. Result:
    source, keep_percent, n, cutoff, n_kept. Equal scores fall on one side together, so more than the target may be kept.

    A rank-interval summary per source gives two scores between which the cutoff must lie. Records below the bracket are only
    counted, those in it are counted by score and sorted. Brackets that hold too many records are narrowed first.
    """
    rows = records.select(F.col(source).alias("source"), F.col(score).cast("double").alias("score")).filter("source IS NOT NULL AND score IS NOT NULL AND NOT isnan(score)")
    aims = targets.select(F.col("source").alias("source"), "keep_percent")
    # state: a source's number of records, the rank wanted, and the bracket [low, high] that is known to hold the cutoff
    bracket = None
    for _ in range(ROUNDS):
        inside = rows if bracket is None else rows.join(bracket.filter("open").select("source", "low", "high"), "source").filter("score >= low AND score <= high").select("source", "score")
        r = ranks(summarize(inside, ["source"], "score"), ["source"]).select("source", F.col("tuple_value").alias("value"), "rmin", "rmax", "n")
        if bracket is None:
            r = r.join(aims, "source").withColumn("aim", F.greatest(F.lit(1), F.ceil(F.col("n") * F.col("keep_percent") / 100)).cast("bigint")).withColumn("total", F.col("n")).withColumn("held", F.col("n"))
        else:
            r = r.join(bracket.select("source", "keep_percent", "total", F.col("within").alias("held"), (F.col("want") - F.col("below")).alias("aim")), "source")
        # rmax < aim: too few records are at or below the value for it to be the cutoff, which is no lower in any case.
        # rmin >= aim: enough are.
        found = r.groupBy("source", "keep_percent", "total", "held").agg(
            F.coalesce(F.max(F.when(F.col("rmax") < F.col("aim"), F.col("value"))), F.min("value")).alias("low"),
            F.coalesce(F.min(F.when(F.col("rmin") >= F.col("aim"), F.col("value"))), F.max("value")).alias("high"),
        )
        if bracket is not None:
            found = found.unionByName(bracket.filter("NOT open").select("source", "keep_percent", "total", F.col("within").alias("held"), "low", "high"))
        found = materialize(found, "brackets")
        # the exact check of the bracket: records below it and in it
        counts = (
            rows.join(found.select("source", "low", "high"), "source")
            .groupBy("source")
            .agg(F.sum(F.expr("int(score < low)")).cast("bigint").alias("below"), F.sum(F.expr("int(score >= low AND score <= high)")).cast("bigint").alias("within"))
        )
        want = F.greatest(F.lit(1), F.ceil(F.col("total") * F.col("keep_percent") / 100)).cast("bigint")
        # where narrowing no longer helps, a few scores hold most records; these are counted by score all the same
        narrow = (F.col("within") > bracket_rows) & (F.col("low") < F.col("high")) & ((F.lit(bracket is None)) | (F.col("within") < 0.9 * F.col("held")))
        bracket = materialize(found.join(counts, "source").withColumn("want", want).withColumn("open", narrow).drop("held"), "brackets")
        if bracket.filter("open").isEmpty():
            break
    by_score = (
        rows.join(bracket.select("source", "low", "high"), "source")
        .filter("score >= low AND score <= high")
        .groupBy("source", "score")
        .agg(F.count(F.lit(1)).alias("c"))
        .withColumn("up_to", F.sum("c").over(W.partitionBy("source").orderBy("score").rowsBetween(W.unboundedPreceding, 0)))
    )
    hit = by_score.join(bracket.select("source", "keep_percent", "total", "below", "want"), "source").filter("below + up_to >= want")
    return hit.groupBy("source", "keep_percent", F.col("total").alias("n")).agg(F.min("score").alias("cutoff"), F.min(F.col("below") + F.col("up_to")).alias("n_kept"))
