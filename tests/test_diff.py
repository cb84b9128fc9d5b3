import random

import numpy as np
from conftest import rows
from pyspark.sql import functions as F

from scquarry.operators import diff
from scquarry.operators.diff import diff_copies, latest_rows

SCHEMA = "version string, k string, x double, y double, t string"


def brute(data):
    a = {r[1]: r for r in data if r[0] == "original"}
    b = {r[1]: r for r in data if r[0] == "skill"}
    out = []
    clean = lambda s: None if s is None or not s.strip() else s.strip()
    for k in {*a, *b}:
        if k not in a or k not in b:
            out.append((k, "missing_original" if k not in a else "missing_skill"))
            continue
        for i, name in ((2, "x"), (3, "y")):
            u, v = a[k][i], b[k][i]
            if (u is None) != (v is None) or u is not None and not (u == v or (u != u and v != v) or abs(u - v) <= 1e-10):
                out.append((k, name))
        if clean(a[k][4]) != clean(b[k][4]):
            out.append((k, "t"))
    return sorted(out, key=repr)


def make(n, share, seed):
    r = random.Random(seed)
    data = []
    for i in range(n):
        k = None if i == 0 else f"K{i}"
        x = r.choice([None, float("nan"), r.random() * 100, r.random() * 1e9, float(r.randrange(50)), -0.0, 1e300])
        base = [k, x, round(r.random(), 3), r.choice([None, "", " ", "a", "B ", "long" * 200])]
        other = list(base)
        if r.random() < share:
            other[r.choice([1, 2])] = r.random()
        if r.random() < share:
            other[3] = r.choice(["c", None, "A"])
        if x is not None and abs(x) < 100:
            other[1] = other[1] + 1e-13 if other[1] is not None else None
        if r.random() > share / 2:
            data.append(("original", *base))
        if r.random() > share / 2:
            data.append(("skill", *other))
    return data


def test_against_brute_force(spark):
    for n, share, seed in ((300, 0.1, 1), (4000, 0.02, 2), (3000, 1.0, 3)):
        data = make(n, share, seed)
        got = rows(diff_copies(spark.createDataFrame(data, SCHEMA).repartition(3), "version", ["k"], ["x", "y"], ["t"]))
        assert got == brute(data)


def test_equal_copies_and_empty(spark):
    data = make(200, 0.0, 4)
    assert rows(diff_copies(spark.createDataFrame(data, SCHEMA), "version", ["k"], ["x", "y"], ["t"])) == brute(data) == []
    assert rows(diff_copies(spark.createDataFrame([], SCHEMA), "version", ["k"], ["x", "y"], ["t"])) == []


def test_one_side_only_and_wrong_estimate(spark, monkeypatch):
    data = [("original", f"K{i}", 1.0, 2.0, "a") for i in range(5000)]
    monkeypatch.setattr(diff, "estimate", lambda _: 1)  # one bucket: decoding fails at first and is tried with more
    got = rows(diff_copies(spark.createDataFrame(data, SCHEMA), "version", ["k"], ["x", "y"], ["t"]))
    assert got == sorted((f"K{i}", "missing_skill") for i in range(5000))
    monkeypatch.setattr(diff, "ROUNDS", 1)  # nothing could be decoded: all keys are compared
    assert len(rows(diff_copies(spark.createDataFrame(data, SCHEMA), "version", ["k"], ["x", "y"], ["t"]))) == 5000


def test_estimate_is_near(spark):
    data = [("original", f"K{i}", 1.0, 2.0, "a") for i in range(20000)] + [("skill", f"K{i}", 1.0 if i % 10 else 2.0, 2.0, "a") for i in range(20000)]
    df = spark.createDataFrame(data, SCHEMA).select("version", F.xxhash64("k").alias("_k"), F.xxhash64("k", "x").alias("_h"))
    assert 4000 / 2.5 < diff.estimate(diff._elements(df, "version", ("original", "skill"))) < 4000 * 2.5


def test_hashes_equal_spark(spark):
    x = [0, 1, -1, 2**62, -(2**63), 12345678901]
    want = [r[0] for r in spark.createDataFrame([(v,) for v in x], "v bigint").select(F.xxhash64("v")).collect()]
    assert diff._hash_long(np.array(x, np.int64).view(np.uint64)).view(np.int64).tolist() == want


def test_latest_rows(spark):
    df = spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 2, "y"), ("a", None, 9, "z"), (None, 1, 1, "n")], "k string, at int, no int, v string")
    assert rows(latest_rows(df, ["k"], ["at", "no"]).select("k", "v")) == [("a", "y"), (None, "n")]


def test_latest_of_repeated_rows_counts(spark):
    at = ["2024-01-01", "2024-01-02", None]
    r = random.Random(5)
    data = [(v, f"K{i % 400}", float(r.randrange(3)), 0.0, r.choice(["a", "b", None]), r.choice(at), i) for i in range(3000) for v in (r.choice(["original", "skill", "other"]),)]
    df = spark.createDataFrame(data, SCHEMA + ", at string, no bigint").withColumn("at", F.to_timestamp("at")).repartition(5)
    last = {}
    for row in sorted(data, key=lambda x: (x[5] or "", x[6])):
        last[row[0], row[1]] = row[:5]
    want = brute(last.values())
    assert len(want) > 100 and rows(diff_copies(df, "version", ["k"], ["x", "y"], ["t"], order=("at", "no"))) == want
    assert rows(diff_copies(df.withColumn("no", F.col("no").cast("int")), "version", ["k"], ["x", "y"], ["t"], order=("at", "no"))) == want
