import collections
import math
import os
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from scquarry.llm import cutoff, leaks, packing, quantiles, sampling, subjects


# --- sampling ---------------------------------------------------------------------------------------------------------
def test_shares_floors_and_shortfalls(spark):
    sizes = {"A": 600, "B": 300, "C": 40, "D": 3, "E": 0}
    items = [(c, f"{c}{i}") for c, n in sizes.items() for i in range(n)] + [("A", "A0")] * 500 + [(None, "x"), ("A", None)]
    targets = [("s", "A", 500, 0, 101), ("s", "B", 300, 0, 101), ("s", "C", 150, 20, 101), ("s", "D", 40, 1, 101), ("s", "E", 10, 1, 101), ("t", "C", 1000, 50, 30), ("u", "B", None, None, None), ("u", None, 5, 1, 3)]
    sample, report = sampling.draw(
        spark.createDataFrame(items, "category string, item string").withColumn("target_set", F.lit("clash")), spark.createDataFrame(targets, "target_set string, category string, target_permille int, min_rows bigint, sample_size bigint"), run_items=50
    )
    got = {(r["target_set"], r["category"]): r for r in report.collect()}
    drawn = collections.Counter((r["target_set"], r["category"]) for r in sample.collect())
    assert sample.count() == sample.distinct().count()
    for k, r in got.items():
        assert drawn.get(k, 0) == r["drawn"] and r["met"] == (r["available"] >= r["required"]) and r["drawn"] >= r["floor"]
        assert r["total"] == sum(n for (s, _), n in drawn.items() if s == k[0])
    # D and E run dry, the others get their items; C is below its floor, the others give up what it lacks
    assert got["s", "C"]["drawn"] == 20 and got["s", "D"]["drawn"] in (2, 3) and got["s", "E"]["drawn"] == 0 and got["s", "A"]["total"] == 101
    assert abs(got["s", "A"]["drawn"] - 78 * 5 / 8) <= 2 and abs(got["s", "B"]["drawn"] - 78 * 3 / 8) <= 2
    assert (got["t", "C"]["required"], got["t", "C"]["floor"], got["t", "C"]["drawn"], got["t", "C"]["met"]) == (50, 40, 40, False)
    assert got["u", "B"]["drawn"] == 0 and got["u", "B"]["met"] and not got["u", None]["met"]


def test_sets_keep_their_size(spark):
    """Whatever floors ask for and categories lack: the size, each category within one of its share, the share filled up level by level."""
    r = random.Random(15)
    targets, sizes = [], {f"c{i}": r.choice([0, 3, 50, 400, 2000]) for i in range(12)}
    for t in range(25):
        names = r.sample(sorted(sizes), r.randrange(1, 12))
        cuts = sorted(r.sample(range(1, 1000), len(names) - 1))
        targets += [(f"t{t}", c, hi - lo, r.choice([0, 0, 2, 40]), r.choice([7, 100, 1500]) if c == names[0] else 0) for c, lo, hi in zip(names, [0, *cuts], [*cuts, 1000])]
    size = {t: n for t, _, _, _, n in targets if n}
    targets = [(t, c, p, m, size[t]) for t, c, p, m, _ in targets]
    items = spark.createDataFrame([(c, f"{c}-{i}") for c, n in sizes.items() for i in range(n)], "category string, item string")
    _, report = sampling.draw(items, spark.createDataFrame(targets, "target_set string, category string, target_permille int, min_rows bigint, sample_size bigint"), run_items=300)
    got = {(x["target_set"], x["category"]): x for x in report.collect()}
    for t, n in size.items():
        mine = {c: (p * n / 1000, m) for s, c, p, m, _ in targets if s == t}
        low, high = 0.0, 1e6
        for _ in range(100):  # the level by bisection
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(sizes[c], mid * x) for c, (x, _) in mine.items()) < n else (low, mid)
        floors = {c: min(m, sizes[c]) for c, (_, m) in mine.items()}
        stock = sum(sizes[c] for c in mine)
        assert got[t, next(iter(mine))]["total"] == max(min(n, stock), sum(floors.values()))
        if all(floors[c] <= min(sizes[c], high * x) for c, (x, _) in mine.items()):
            assert all(abs(got[t, c]["drawn"] - min(sizes[c], high * x)) < 1 + 1e-6 for c, (x, _) in mine.items())


def test_systematic_total_and_even_chances(spark):
    """Without floors the whole sample has its size to one, and every item about the same chance."""
    items = spark.range(900).select((F.col("id") % 3).cast("string").alias("category"), F.col("id").cast("string").alias("item"))
    targets = spark.createDataFrame([("s", str(c), p, 0, 100) for c, p in enumerate((333, 333, 334))], "target_set string, category string, target_permille int, min_rows int, sample_size bigint")
    hits = collections.Counter()
    for seed in range(12):
        sample, _ = sampling.draw(items, targets, seed=seed)
        got = [r["item"] for r in sample.collect()]
        assert len(got) == 100
        hits.update(got)
    assert max(hits.values()) <= 7
    empty, report = sampling.draw(items.filter("false"), targets)
    assert empty.count() == 0 and report.filter("met OR total > 0").count() == 0


# --- cutoffs ----------------------------------------------------------------------------------------------------------
def exact_cutoff(values, keep):
    v = sorted(values)
    need = max(1, math.ceil(len(v) * keep / 100))
    return v[need - 1], sum(x <= v[need - 1] for x in v)


@pytest.mark.parametrize("bracket", [1_000_000, 10])
def test_cutoffs_are_exact(spark, bracket):
    r = random.Random(4)
    data = [(s, r.choice([round(r.random(), 2), r.random(), 0.05])) for s, n in (("a", 9000), ("b", 50), ("c", 1)) for _ in range(n)] + [("b", -0.5)] * 9 + [("ties", 0.3)] * 400 + [("ties", 0.9)]
    junk = [(None, 0.5), ("a", None), ("a", float("nan"))]
    df = spark.createDataFrame(data + junk, "source string, score double").repartition(7)
    targets = spark.createDataFrame([("a", 90), ("b", 33), ("c", 1), ("ties", 50), ("none", 90)], "source string, keep_percent int")
    got = {x["source"]: x for x in cutoff.cutoffs(df, targets, bracket_rows=bracket).collect()}
    assert set(got) == {"a", "b", "c", "ties"}
    for s, keep in (("a", 90), ("b", 33), ("c", 1), ("ties", 50)):
        v = [x for k, x in data if k == s]
        assert (got[s]["n"], got[s]["cutoff"], got[s]["n_kept"]) == (len(v), *exact_cutoff(v, keep))
    assert cutoff.cutoffs(df.filter("false"), targets).count() == 0


# --- percentiles ------------------------------------------------------------------------------------------------------
def test_rank_bounds_hold_through_all_levels(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BUFFER", 2000)
    r = np.random.default_rng(9)
    n = 30000
    value = np.where(r.random(n) < 0.3, 7.0, np.round(r.lognormal(3, 2, n), 2))
    day, group = r.integers(0, 5, n), np.where(r.random(n) < 0.5, "hot", "g" + (np.arange(n) % 9).astype(str).astype(object))
    df = spark.createDataFrame([(str(g), int(d), float(v)) for g, d, v in zip(group, day, value)] + [("hot", 0, None), ("hot", 0, float("nan")), (None, 2, 5.0)], "g string, d int, v double").repartition(6)
    days = quantiles.summarize(df, ["g", "d"], "v", tuples=100)
    for keys, part in ((["g"], quantiles.combine(days, ["g"], tuples=100)), ([], quantiles.combine(quantiles.combine(days, ["g"], tuples=100), [], tuples=100))):
        for x in quantiles.percentiles(part, keys, [1, 25, 50, 75, 99.9]).collect():
            v = np.sort(value if not keys else value[group == x["g"]])
            v = np.sort(np.r_[v, 5.0]) if not keys else np.array([5.0]) if x["g"] is None else v
            target = max(1, math.ceil(x["percent"] * len(v) / 100))
            low, high = np.searchsorted(v, x["value"], "left") + 1, np.searchsorted(v, x["value"], "right")
            assert x["n"] == len(v)
            assert max(0, low - target, target - high) <= x["rank_error"] <= 0.05 * len(v) + 1
    assert quantiles.percentiles(quantiles.summarize(df.filter("false"), ["g"], "v"), ["g"], [50]).count() == 0


@pytest.mark.parametrize("buffers", [2, 16, 64])
def test_error_stays_flat_as_parts_grow(spark, monkeypatch, buffers):
    """The bound follows the height of the tree, not the number of buffers that a task fills; negative numbers count like others."""
    monkeypatch.setattr(quantiles, "BUFFER", 4096)
    monkeypatch.setattr(quantiles, "FAN", 8)
    n = 4096 * buffers * 4
    df = spark.range(0, n, 1, 4).select(F.lit("hot").alias("g"), ((F.xxhash64("id") % 1_000_003) / 7.0).alias("v"))
    got = quantiles.percentiles(quantiles.summarize(df, ["g"], "v", tuples=200), ["g"], [1, 50, 99]).collect()
    levels = 1 + math.ceil(math.log(4 * buffers, 8))
    v = np.sort([r["v"] for r in df.select("v").collect()])
    for x in got:
        target = math.ceil(x["percent"] * n / 100)
        low, high = np.searchsorted(v, x["value"], "left") + 1, np.searchsorted(v, x["value"], "right")
        assert max(0, low - target, target - high) <= x["rank_error"] <= (levels + 1) * n / 200
    assert len(got) == 3 and min(v) < 0


# --- packing ----------------------------------------------------------------------------------------------------------
def test_hilbert_is_a_walk_through_all_cells():
    side = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    key = packing.hilbert(side, 3)
    assert sorted(key.tolist()) == list(range(512))
    path = side[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_fill_is_tight_and_near():
    r = random.Random(2)
    sizes = [(i, r.choice([r.randrange(1, 1025), r.randrange(1, 300)])) for i in range(3000)]
    got = list(packing.fill(sizes, 1024))
    assert sorted(x for c in got for x in c) == sizes
    assert max(sum(n for _, n in c) for c in got) <= 1024 and len(got) <= 1.02 * sum(n for _, n in sizes) / 1024 + 2
    spread = [max(i for i, _ in c) - min(i for i, _ in c) for c in got]
    assert np.mean(spread) < 2 * packing.LOOK  # mates are neighbours: random ones were 1000 apart
    assert list(packing.fill([], 10)) == [] and list(packing.fill([(1, 10), (2, 10)], 10)) == [[(1, 10)], [(2, 10)]]
    assert packing.best_subset([7, 5, 4, 3], 9) == [1, 2] and packing.best_subset([5], 4) == [] and packing.best_subset([], 4) == []


def test_mates_are_alike(spark):
    """Documents of several subjects, shuffled: those in a container are nearer to one another than any two documents."""
    r = random.Random(3)
    kinds = [[f"k{s}w{i}" for i in range(40)] for s in range(30)]
    docs = [(d, " ".join(r.choice(kinds[d % 30]) for _ in range(r.randrange(30, 300)))) for d in range(3000)]
    got = packing.pack(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    vector = {d: packing.project(packing.plain_tokens(t), {}) for d, t in docs}
    mates = collections.defaultdict(list)
    for x in got:
        mates[x["container_id"]].append(vector[x["doc_id"]])
    far = [np.linalg.norm(a - b) for c in mates.values() for i, a in enumerate(c) for b in c[:i]]
    other = [np.linalg.norm(vector[r.randrange(3000)] - vector[r.randrange(3000)]) for _ in range(3000)]
    assert np.mean(far) < 0.5 * np.mean(other)
    assert sum(x["tokens"] for x in got) > 0.99 * 1024 * len(mates)


def test_pack_edges(spark):
    texts = [(1, None), (2, ""), (3, " \n "), (4, "a b c"), (4, "a b c"), (5, "w " * 2500), (6, "x " * 1024), (7, "ÄÖ_1 !? é")]
    got = packing.pack(spark.createDataFrame([(i, t, "z") for i, t in texts], "doc_id bigint, text string, tokens string")).collect()
    parts = collections.defaultdict(list)
    for r in got:
        parts[r["doc_id"]].append((r["part"], r["first_token"], r["tokens"]))
    assert sorted(parts[5]) == [(1, 0, 1024), (2, 1024, 1024), (3, 2048, 452)]
    assert parts[6] == [(1, 0, 1024)] and parts[4] == [(1, 0, 3)] * 2 and parts[7] == [(1, 0, 3)] and set(parts) == {4, 5, 6, 7}
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    copies = spark.range(30000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"))
    sizes = packing.pack(copies).groupBy(F.split("container_id", "-")[0].alias("task")).count().collect()
    assert len(sizes) == 2 and min(r["count"] for r in sizes) > 10000


@pytest.mark.skipif(not os.path.exists("/opt/tokenizers/byte_bpe_50k.json"), reason="no tokenizer file")
def test_tokenizer_file():
    t = packing.tokenizer_file("/opt/tokenizers/byte_bpe_50k.json")
    assert 2 <= len(t("hello world")) <= 4 and t("") == []


# --- leaks ------------------------------------------------------------------------------------------------------------
def sentence(r, n, vocabulary=4000):
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def edited(r, p, kind, every):
    """p with an edit of the kind in every stretch of so many words."""
    out = []
    for i, w in enumerate(p):
        at = i % every == every // 2
        out += [] if at and kind == "d" else [f"x{r.randrange(10**9)}"] if at and kind == "s" else [f"x{r.randrange(10**9)}", w] if at and kind == "i" else [w]
    return out


def test_every_run_is_found_and_edits_too(spark):
    r = random.Random(6)
    passages = [sentence(r, 60) for _ in range(30)] + [sentence(r, 11)]
    items = [(f"I{i}", " ".join(p)) for i, p in enumerate(passages)] + [("copy", " ".join(passages[0])), ("null", None), (None, "x"), ("I3", " ".join(passages[3]))]
    docs, want, near = [], set(), {(k, every): set() for k in "sid" for every in (6, 11)}
    for d in range(400):
        w = sentence(r, r.randrange(0, 300))
        i, at = r.randrange(1, 30), r.randrange(0, len(w) + 1)
        if d % 4 == 0:
            n, i = r.choice([12, 13, 20, 60]), r.randrange(30)
            s = r.randrange(0, 61 - n)
            w[at:at] = passages[i][s : s + n]
            want |= {(d, f"I{i}"), (d, "copy")} if i == 0 else {(d, f"I{i}")}
        elif d % 4 == 1:  # every window of twelve words has an edit or two
            kind = r.choice(sorted(near))
            w[at:at] = edited(r, passages[i], *kind)
            near[kind].add((d, f"I{i}"))
        elif d % 4 == 2:
            w[at:at] = passages[i][:11]
        docs.append((d, " ".join(w).upper().replace("W1", "Ẃ1").replace(" W2", " <b>W2").replace(" W3", "</b> W3")))
    docs += [(1000, None), (1001, ""), (1002, "short text"), (None, docs[0][1]), docs[0]]
    df, it = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("passage", F.lit("x")), spark.createDataFrame(items, "item_id string, passage string")
    members = {(x["item_id"], x["member"]) for x in leaks.members_of(it).collect()}
    assert members == {(f"I{i}" if i else least, f"I{i}") for least in [min("I0", "copy")] for i in range(30)} | {(min("I0", "copy"), "copy")}
    results = []
    for bound in (leaks.BROADCAST_WINDOWS, 0):
        found = {(x["doc_id"], x["item_id"]): x for x in leaks.find_leaks(df, it, broadcast_windows=bound).collect()}
        got = {(d, m) for (d, i), x in found.items() if x["run_words"] >= 12 for j, m in members if i == j}
        assert got == want
        assert all(x["edits"] > 0 and not x["run_words"] for k, x in found.items() if any(k in v for v in near.values()))
        for kind, pairs in near.items():
            assert len(pairs & set(found)) >= 0.9 * len(pairs), kind
        assert found[next(k for k in want if k[1] == "I5")]["n_items"] == 1
        results.append(found)
    assert results[0] == results[1]
    assert leaks.find_leaks(df, it.filter("false")).count() == 0 and leaks.find_leaks(df.filter("false"), it).count() == 0
    assert leaks.members_of(it.filter("false")).count() == 0


@pytest.mark.parametrize("kinds", ["s", "i", "d", "ss", "si", "sd", "ii", "id", "dd"])
def test_windows_reach_the_recall(kinds):
    """Pairs of windows with each kind of one or two edits at random places, none of them exact, share a signature."""
    r = np.random.default_rng(12)
    a = r.integers(1, 2**63, (4000, leaks.RUN), dtype=np.uint64)
    b = np.empty((4000, leaks.RUN + leaks.EDITS), np.uint64)
    for row, x in enumerate(a.tolist()):
        for k in kinds:
            at, new = int(r.integers(0, len(x))), int(r.integers(1, 2**63))
            x[at : at + (k != "i")] = [] if k == "d" else [new]
        b[row] = (x + r.integers(1, 2**63, 8, dtype=np.uint64).tolist())[: b.shape[1]]
    assert (leaks.edit_distance(a, b) <= len(kinds)).all() and len(leaks.near_pairs(a, b)[0]) == len(a)
    hit = np.zeros(len(a), bool)
    for x, y in zip(leaks.signatures(a.ravel(), np.arange(len(a)) * a.shape[1]), leaks.signatures(b.ravel(), np.arange(len(b)) * b.shape[1])):
        hit |= x == y
    assert hit.mean() >= (0.99 if len(kinds) == 1 else 0.9)
    # no such pair is held back by the runs of words that are looked up
    for q in leaks.GRAMS:
        grams = [leaks.grams(x, q) for x in (a.ravel(), b.ravel())]
        known = np.zeros(1 << 20, np.uint8)
        for p in leaks.Filter.places(grams[0], np.uint64(64 - 23)):
            np.bitwise_or.at(known, (p >> np.uint64(3)).astype(int), (1 << (p & np.uint64(7)).astype(int)).astype(np.uint8))
        have = np.r_[0, np.cumsum(leaks.Filter(known).has(grams[1]))]
        starts = np.arange(len(b)) * b.shape[1]
        assert (have[np.minimum(starts + b.shape[1] - q + 1, len(have) - 1)] - have[starts] >= leaks.RUN - q + 1 - q * leaks.EDITS).all()


def test_edit_distance():
    a = np.array([[1, 2, 3, 4]] * 4)
    b = np.array([[1, 2, 3, 4, 7], [2, 3, 4, 5, 6], [9, 8, 7, 6, 5], [1, 9, 2, 3, 4]])
    assert leaks.edit_distance(a, b).tolist() == [0, 1, 4, 1]
    assert leaks.words("Café <b>x_y</b> 12-A") == ["cafe", "x", "y", "12", "a"]


# --- subjects ---------------------------------------------------------------------------------------------------------
def test_subjects_of_made_up_documents(spark):
    r = random.Random(8)
    topics = {s: [f"{s}term{chr(97 + i)}" for i in range(12)] for s in ("art", "law", "bio")}
    general = [f"common{chr(97 + i)}" for i in range(20)]

    def line(s):
        return " ".join(r.choice(general) for _ in range(5)) + (f" {r.choice(topics[s])} {r.choice(topics[s])}" if s else "") + "."

    docs, truth, labels = [], set(), []
    for d in range(900):
        own = r.sample(sorted(topics), r.choice([0, 1, 1, 1, 2]))
        lines = [line(s) for s in own for _ in range(4)] + [line(None) for _ in range(3)]
        other = [s for s in topics if s not in own]
        lines += [line(r.choice(other))] if r.random() < 0.3 else []
        r.shuffle(lines)
        docs.append((d, " ".join(lines), r.choice(["en", "EN ", None])))
        truth |= {(d, s) for s in own}
        if len(own) == 1 and r.random() < 0.4:
            labels.append((d, own[0] if r.random() < 0.92 else r.choice(other)))
    docs += [(5000, None, "en"), (5001, "", None), (5002, docs[0][1], "en")]
    labels += [(5000, "art"), (7777, "law"), (3, None), (4, "unknown")]
    df, lb = spark.createDataFrame(docs, "doc_id bigint, text string, lang string"), spark.createDataFrame(labels, "doc_id bigint, subject string")
    got = {tuple(x) for x in subjects.assign_subjects(df, lb, sorted(topics)).collect()}
    assert {s for d, s in got if d == 5002} == {s for d, s in got if d == 0}
    got = {x for x in got if x[0] < 5000}
    assert len(got & truth) / len(got) > 0.95 and len(got & truth) / len(truth) > 0.95
    assert subjects.assign_subjects(df, lb.filter("false"), sorted(topics)).count() == 0
    assert rows(subjects.assign_subjects(df.filter("false"), lb, sorted(topics))) == []


def test_a_rare_subject_has_a_centroid(spark, monkeypatch):
    """Labels are drawn by subject: one with few of them, each in a language of its own, is found all the same."""
    monkeypatch.setattr(subjects, "MAX_LABELLED", 120)
    r = random.Random(9)
    topics = {s: [f"{s}term{chr(97 + i)}" for i in range(12)] for s in ("art", "law", "bio")}
    line = lambda s: " ".join(f"common{chr(97 + r.randrange(20))}" for _ in range(5)) + f" {r.choice(topics[s])} {r.choice(topics[s])}."
    docs, truth, labels = [], set(), []
    for d in range(1200):
        s = "bio" if d % 100 == 0 else r.choice(["art", "law"])
        docs.append((d, " ".join(line(s) for _ in range(5)), f"l{d}" if s == "bio" else "en"))
        truth.add((d, s))
        labels.append((d, s))
    df, lb = spark.createDataFrame(docs, "doc_id bigint, text string, lang string"), spark.createDataFrame(labels, "doc_id bigint, subject string")
    got = {tuple(x) for x in subjects.assign_subjects(df, lb, sorted(topics)).collect()}
    assert len({x for x in got & truth if x[1] == "bio"}) >= 10 and len(got & truth) / len(got | truth) > 0.95
