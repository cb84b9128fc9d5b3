from collections import Counter

from pyspark.sql import functions as F

from scquarry.operators.skew import heavy_keys, salted_aggregate


def test_salted_equals_plain(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 100 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 1000).alias("item"),
        (F.col("id") % 13).cast("double").alias("v"),
        F.lit("clash").alias("_salt"),
    )
    got = {r["k"]: r for r in salted_aggregate(df, "k", "item", {"total": "v"}, {"low": "v"}, {"high": "v"}, tasks=8).collect()}
    want = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("item").alias("d"), F.sum("v").alias("t"), F.min("v").alias("l"), F.max("v").alias("h")).collect()
    assert len(got) == len(want)
    for r in want:
        g = got[r["k"]]
        assert (g["n_rows"], g["n_items"], g["total"], g["low"], g["high"]) == (r["n"], r["d"], r["t"], r["l"], r["h"])
    assert got["hot"]["n_salts"] > 1 and got["k1"]["n_salts"] == 1


def test_heavy_keys_are_few_and_even(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, "a").when(F.col("id") < 700, "b").otherwise(F.col("id").cast("string")).alias("k"))
    heavy, total = heavy_keys(df, "k", 10)
    assert total == 1000 and {r["_key"]: r["_salts"] for r in heavy.collect()} == {"a": 4, "b": 3}


def test_empty_and_single_item(spark):
    assert salted_aggregate(spark.createDataFrame([], "k string, i string"), "k", "i").count() == 0
    one = spark.createDataFrame([("a", "x")] * 50 + [(None, None)], "k string, i string")
    assert Counter((r["k"], r["n_rows"], r["n_items"]) for r in salted_aggregate(one, "k", "i", tasks=4).collect()) == Counter([("a", 50, 1), (None, 1, 0)])
