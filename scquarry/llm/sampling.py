"""A sample whose shares of categories match targets: systematic unequal-probability sampling with repaired floors."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scquarry.session import materialize

#: Items that one sorted run is planned to hold.
RUN_ITEMS = 100_000
#: Rows of the table of targets up to which it is broadcast.
BROADCAST_TARGETS = 10_000


def shares(plan: DataFrame) -> DataFrame:
    """plan (target_set, category, target, available) with expected: the items to draw, in proportion to the targets, as far as there are any.

    What a category can't give is taken from the others in proportion to their targets, so that the expected numbers add up to
    the sum of the targets where the stock allows: expected = min(available, level * target) with one level per set. Categories run
    dry one after the other as the level rises, in the order of available / target; sums along this order give the level.
    """
    w = W.partitionBy("target_set")
    dry = F.col("available") / F.nullif(F.col("target"), F.lit(0.0))
    after = w.orderBy(F.asc_nulls_last("_dry"), "category").rowsBetween(W.currentRow, W.unboundedFollowing)
    before = w.orderBy(F.asc_nulls_last("_dry"), "category").rowsBetween(W.unboundedPreceding, -1)
    p = plan.withColumn("_dry", dry).withColumn("_size", F.sum("target").over(w))
    usable = F.when(F.col("target") > 0, F.col("available")).otherwise(0)
    # with the categories before this one dry, what is left of the size goes to this one and those after it
    p = p.withColumn("_level", (F.col("_size") - F.coalesce(F.sum(usable).over(before), F.lit(0))) / F.nullif(F.sum("target").over(after), F.lit(0.0)))
    # the right level is the first that leaves its own category wet
    p = p.withColumn("_level", F.min(F.when((F.col("target") > 0) & (F.col("_level") <= F.col("_dry")), F.struct("_dry", "category", "_level"))).over(w)["_level"])
    expected = F.when(F.col("target") > 0, F.least(F.col("available").cast("double"), F.coalesce(F.col("_level") * F.col("target"), F.col("available").cast("double")))).otherwise(0.0)
    return p.withColumn("expected", expected).drop("_dry", "_size", "_level")


def repair(plan: DataFrame) -> DataFrame:
    """plan (target_set, category, passed, floor) with lacking and surplus: floors are filled with what categories above theirs give.

    The sum of what floors lack is taken from the others in proportion to what they have above their floors, rounded along the
    categories' order so that it adds up; as far as they have enough, the sample keeps its size.
    """
    w = W.partitionBy("target_set")
    along = w.orderBy("category").rowsBetween(W.unboundedPreceding, 0)
    p = plan.withColumn("lacking", F.greatest(F.lit(0), F.col("floor") - F.col("passed"))).withColumn("_above", F.greatest(F.lit(0), F.col("passed") - F.col("floor")))
    p = p.withColumn("_give", F.least(F.sum("lacking").over(w), F.sum("_above").over(w))).withColumn("_all", F.greatest(F.lit(1), F.sum("_above").over(w)))
    up_to = F.sum("_above").over(along)
    return p.withColumn("_to", up_to).withColumn("surplus", F.expr("_give * _to div _all - _give * (_to - _above) div _all")).drop("_above", "_give", "_all", "_to")


def draw(items: DataFrame, targets: DataFrame, seed: int = 42, run_items: int = RUN_ITEMS) -> tuple[DataFrame, DataFrame]:
    """A sample for every target set and a report on its categories.

    items has category and item; an item may have several categories and rows, and counts once in each category. targets has
    target_set, category, target_permille, min_rows, sample_size; categories of both must be spelt alike, each once in a set. Rows
    with a null category or item are left out; null numbers of a target count as 0. Results:

    sample: target_set, category, item. report: target_set, category, required (the larger of min_rows and the target, rounded
    up), floor (min_rows, or what is there), available, drawn, met (available is no less than required), and of the set
    sample_size and total, what was drawn of all its categories. Without items all categories with a requirement are unmet.

    The items of a category are in a random order (by a hash, so that work lost with an executor is done again alike); each has
    the inclusion probability expected / available, expected being the target or, where categories run out of items, more
    (shares()). The probabilities are summed over the categories in their order, with prefix sums over runs of the order and over
    the items of a run, and an item is drawn where the sum plus one random start passes an integer: each category gets its
    expected number, rounded up or down, and the set its size. Then floors are repaired: a category with fewer than its floor gets
    the next items in its order, and those above their floors give up as many, the last ones drawn. A set thus has its
    sample_size of items as long as its permilles add up to 1000, its floors leave room and its categories have enough items.
    """
    wide = targets.select("target_set", "category", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("target_permille", "min_rows", "sample_size")])
    small = wide.count() <= BROADCAST_TARGETS
    hint = F.broadcast if small else (lambda x: x)
    wanted = wide.select("category").distinct()
    order = F.xxhash64("item", F.lit(seed))
    cells = items.select("category", "item").filter("category IS NOT NULL AND item IS NOT NULL").join(hint(wanted), "category", "left_semi").groupBy("category", "item").agg(order.alias("h"))
    cells = materialize(cells, "items")
    bits = max(4, math.ceil(math.log2(max(cells.count(), 1) / run_items + 1)))
    run = F.shiftrightunsigned("h", 64 - bits)
    cells = cells.withColumn("run", run)
    runs = cells.groupBy("category", "run").agg(F.count(F.lit(1)).alias("c"))
    offsets = runs.select("category", "run", (F.sum("c").over(W.partitionBy("category").orderBy("run").rowsBetween(W.unboundedPreceding, 0)) - F.col("c")).alias("offset"))
    sizes = runs.groupBy("category").agg(F.sum("c").alias("available"))
    plan = (
        wide.join(sizes, "category", "left")
        .withColumn("available", F.coalesce("available", F.lit(0)))
        .withColumn("target", F.col("target_permille") * F.col("sample_size") / F.lit(1000.0))
        .withColumn("required", F.greatest("min_rows", F.ceil("target")).cast("bigint"))
        .withColumn("floor", F.least("min_rows", "available").cast("bigint"))
    )
    plan = shares(plan)
    # neither 0 nor 1, nor where sums of tenths of items would meet an integer
    u = (F.pmod(F.xxhash64("target_set", F.lit(seed)), F.lit(1_000_003)) + 0.37) / F.lit(1_000_003.0)
    before = F.sum("expected").over(W.partitionBy("target_set").orderBy("category").rowsBetween(W.unboundedPreceding, 0)) - F.col("expected")
    plan = plan.withColumn("base", before + u).withColumn("passed", (F.floor(F.col("base") + F.col("expected")) - F.floor("base")).cast("bigint"))
    plan = materialize(repair(plan), "plan")
    placed = cells.join(offsets, ["category", "run"])
    placed = placed.withColumn("at", F.col("offset") + F.row_number().over(W.partitionBy("category", "run").orderBy("h", "item")))
    each = placed.join(hint(plan.select("target_set", "category", "available", "expected", "base", "passed", "lacking", "surplus")), "category")
    up_to = F.floor(F.col("base") + F.col("expected") * F.col("at") / F.col("available"))
    ahead = F.floor(F.col("base") + F.col("expected") * (F.col("at") - 1) / F.col("available"))
    so_far = up_to - F.floor("base")
    # of the items drawn the last ones are given up; of those not drawn the first ones fill what a floor lacks
    chosen = each.filter(((up_to > ahead) & (so_far <= F.col("passed") - F.col("surplus"))) | ((up_to == ahead) & (F.col("at") - so_far <= F.col("lacking"))))
    sample = chosen.select("target_set", "category", "item")
    drawn = sample.groupBy("target_set", "category").agg(F.count(F.lit(1)).alias("drawn"))
    report = plan.join(drawn, ["target_set", "category"], "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    total = F.sum("drawn").over(W.partitionBy("target_set"))
    return sample, report.select("target_set", "category", "required", "floor", "available", "drawn", (F.col("available") >= F.col("required")).alias("met"), "sample_size", total.alias("total"))
