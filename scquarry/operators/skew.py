"""Per-key results when a few keys hold most records: two-stage salted aggregation."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def heavy_keys(df: DataFrame, key: str, tasks: int) -> tuple[DataFrame, int]:
    """Keys that hold more than 1 / (2 * tasks) of all rows, each with its number of salts, and the number of rows.

    At most 2 * tasks keys can be that heavy, whatever the data, so the result may be broadcast. Counting combines on the map
    side: every task sends one row per key.
    """
    counts = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    counts.persist()
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("t")).first()["t"]
    least = max(1, total / (2.0 * tasks))
    rows = counts.filter(F.col("_n") > least).collect()
    counts.unpersist()
    salts = [(r["_key"], int(math.ceil(r["_n"] * tasks / max(total, 1)))) for r in rows]
    schema = f"_key {df.schema[key].dataType.simpleString()}, _salts int"
    return df.sparkSession.createDataFrame(salts, schema), int(total)


def salted_aggregate(
    df: DataFrame,
    key: str,
    item: str,
    sums: dict[str, str] | None = None,
    mins: dict[str, str] | None = None,
    maxs: dict[str, str] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Rows, distinct items and sums per key in evenly sized work.

    Rows of a heavy key get a salt in 0..salts-1. Partial sums are made per (key, salt) and then merged by key, whatever items
    the rows have: the salt is a hash of the row's values, as even as a random number, but the same when a lost executor's work
    is run again. Rows that are alike in all values used share a salt; they are combined on the map side before anything is sent.
    Items are counted by a salt of their own, a hash of the item, which keeps all rows of an item together: distinct items of a
    key then add up over its salts, and repeated items are combined on the map side too.

    sums, mins and maxs map result names to SQL expressions of one row. Result: key, n_rows, n_items, n_salts and those names.
    A null key is a group of its own; null items count as rows but not as items; an empty table gives an empty result; columns
    of df other than those named are ignored, so clashing names do no harm.
    """
    sums, mins, maxs = sums or {}, mins or {}, maxs or {}
    spark = df.sparkSession
    tasks = tasks or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    given = {n: (F.expr(e), fn) for group, fn in ((sums, F.sum), (mins, F.min), (maxs, F.max)) for n, e in group.items()}
    base = df.select(F.col(key).alias("_key"), F.col(item).alias("_item"), *[e.alias(n) for n, (e, _) in given.items()])
    heavy, _ = heavy_keys(base, "_key", tasks)
    heavy = heavy.withColumnRenamed("_key", "_heavy")
    known = base.join(F.broadcast(heavy), F.col("_key").eqNullSafe(F.col("_heavy")), "left").withColumn("_salts", F.coalesce("_salts", F.lit(1)))
    rows = known.withColumn("_salt", F.pmod(F.xxhash64("_item", *given), F.col("_salts")).cast("int"))
    partial = rows.groupBy("_key", "_salt").agg(F.count(F.lit(1)).alias("_rows"), *[fn(n).alias(n) for n, (_, fn) in given.items()])
    items = known.filter("_item IS NOT NULL").select("_key", "_item", F.pmod(F.xxhash64("_item"), F.col("_salts")).cast("int").alias("_salt"))
    counted = items.groupBy("_key", "_salt", "_item").agg(F.lit(1).alias("_one")).groupBy("_key", "_salt").agg(F.count(F.lit(1)).alias("_items"))
    return (
        partial.unionByName(counted, allowMissingColumns=True)
        .groupBy("_key")
        .agg(F.sum("_rows").alias("n_rows"), F.coalesce(F.sum("_items"), F.lit(0)).alias("n_items"), F.count("_rows").cast("int").alias("n_salts"), *[fn(n).alias(n) for n, (_, fn) in given.items()])
        .withColumnRenamed("_key", key)
    )
