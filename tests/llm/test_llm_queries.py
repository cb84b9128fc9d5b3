"""The training-data queries with SQL against DuckDB, and pN_found against brute force, on the smallest tables."""

import collections
import math
import os
import re
import unicodedata

import duckdb
import numpy as np
import pytest

from scquarry.llm import queries

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(DIR):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, con, name):
    got = queries.QUERIES[name](spark, DIR)
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({queries.SQL[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_sample_shares(spark, con):
    got = {(r["target_set"], r["category"]): r["drawn"] for r in queries.p2_drawn(spark, DIR).collect()}
    rows = con.sql(queries._P2 + "SELECT r.*, min_rows, target_permille * sample_size / 1000.0, sample_size FROM r JOIN sampling_targets USING (target_set, category)").fetchall()
    assert len(got) == len(rows)
    for t in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == t]
        assert sum(got[t, r[1]] for r in mine) == min(mine[0][6], sum(r[3] for r in mine))
        assert all(got[t, c] >= min(floor, available) for _, c, _, available, floor, _, _ in mine)


def test_percentiles_within_their_bound(spark, con):
    values = collections.defaultdict(list)
    for s, a, b in con.sql("SELECT upper(trim(sample, ' ' || chr(9) || chr(10) || chr(160))), ncount_rna, nfeature_rna FROM cell_qc_all").fetchall():
        for m, v in (("ncount_rna", a), ("nfeature_rna", b)):
            if v is not None and not math.isnan(v) and v >= 0:
                values[m, s].append(v)
                values[m, "all"].append(v)
    rows = queries.p5_percentiles(spark, DIR).collect()
    assert len(rows) == 6 * sum(1 for m, s in values if s is not None)
    for r in rows:
        v = np.sort(values[r["metric"], r["sample"] if r["scope"] == "sample" else "all"])
        assert r["n"] == len(v)
        target = max(1, math.ceil(r["percent"] * len(v) / 100))
        low, high = np.searchsorted(v, r["value"], "left") + 1, np.searchsorted(v, r["value"], "right")
        assert max(0, low - target, target - high) <= r["rank_error"] <= 0.005 * len(v) + 1


def test_containers(spark, con):
    token = re.compile(r"\w+|[^\w\s]+")
    size = {i: len(token.findall(t)) for i, t in con.sql("SELECT doc_id, text FROM documents WHERE text IS NOT NULL").fetchall()}
    parts = queries.p7_containers(spark, DIR).collect()
    total, used, n = collections.Counter(), collections.Counter(), collections.Counter()
    for r in parts:
        total[r["doc_id"]] += r["tokens"]
        n[r["doc_id"]] += 1
        used[r["container_id"]] += r["tokens"]
    assert total == {i: s for i, s in size.items() if s}
    assert max(used.values()) <= 1024 and {r["container_id"]: r["used"] for r in parts} == used
    assert all(n[i] == max(1, math.ceil(s / 1024)) for i, s in size.items() if s)
    assert len(used) <= 1.05 * math.ceil(sum(used.values()) / 1024) + 1
    assert sorted(r["doc_id"] for r in queries.p7_found(spark, DIR).collect()) == sorted(i for i, s in size.items() if s > 1024)


def test_leaks(spark, con):
    def words(s):
        s = unicodedata.normalize("NFD", re.sub(r"</?[A-Za-z!][^<>]*>", " ", s).casefold())
        return re.findall(r"[^\W_]+", "".join(c for c in s if not unicodedata.combining(c)))

    runs = collections.defaultdict(set)
    for i, p in con.sql("SELECT item_id, passage FROM eval_items").fetchall():
        w = words(p)
        for k in range(len(w) - 11):
            runs[tuple(w[k : k + 12])].add(i)
    want = set()
    for d, t in con.sql("SELECT doc_id, text FROM documents WHERE text IS NOT NULL").fetchall():
        w = words(t)
        for k in range(len(w) - 11):
            want |= {(d, i) for i in runs.get(tuple(w[k : k + 12]), ())}
    assert want and set(map(tuple, queries.p8_found(spark, DIR).collect())) == want


def test_subjects_agree_with_labels(spark):
    d = "/root/testdata/sf0.1"
    found = {(r["doc_id"], r["subject"]) for r in queries.p9_found(spark, d).collect()}
    c = duckdb.connect()
    labels = set(c.sql(f"SELECT DISTINCT l.doc_id, l.subject FROM '{d}/subject_labels.parquet' l JOIN '{d}/documents.parquet' d ON d.doc_id = l.doc_id WHERE text IS NOT NULL").fetchall())
    some = {i for i, _ in labels}
    mine = {x for x in found if x[0] in some}
    assert len(mine & labels) / len(mine) > 0.95 and len(mine & labels) / len(labels) > 0.95
    assert max(collections.Counter(i for i, _ in found).values()) <= 3
