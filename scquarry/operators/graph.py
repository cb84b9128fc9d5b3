"""Neighbour graphs and batch design: exact nearest neighbours in blocks, shared neighbours, label mixing, connected groups."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scquarry.session import materialize

#: Query vectors that go to every task, and those of a block where there are more; with vectors of 100 numbers about 3 MB.
BLOCK = 4096
#: Cells with one neighbour that are compared in one task; of a neighbour of more cells, parts are compared.
HUB = 2000
#: Pairs of labels that are joined on the driver.
DRIVER_PAIRS = 100_000
#: Share of the true neighbours that an index must find, and the queries on which that is measured.
RECALL, MEASURED = 0.9, 500


def _best(ids: np.ndarray, q: np.ndarray, kept: tuple[np.ndarray, np.ndarray] | None, own: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances and ids of the k nearest of each query: those kept so far and the vectors x of own; ties go to the smaller id."""
    d = np.sqrt(np.maximum((q * q).sum(axis=1)[:, None] - 2 * q @ x.T + (x * x).sum(axis=1)[None, :], 0))
    d[ids[:, None] == own[None, :]] = np.inf
    i = np.broadcast_to(own, d.shape)
    if kept is not None:
        d, i = np.hstack([kept[0], d]), np.hstack([kept[1], i])
    if d.shape[1] > k:
        # all that tie with the k-th may be wanted: ids decide
        edge = np.partition(d, k - 1, axis=1)[:, k - 1]
        order = np.array([sorted(np.flatnonzero(d[r] <= edge[r]), key=lambda c: (d[r, c], i[r, c]))[:k] for r in range(len(ids))]).reshape(len(ids), k)
        d, i = np.take_along_axis(d, order, 1), np.take_along_axis(i, order, 1)
    return d, i


def nearest(queries: DataFrame, base: DataFrame, k: int = 20, block: int = BLOCK, rows_block: int = 16 * BLOCK) -> DataFrame:
    """The k nearest base vectors of every query: src, dst, rnk (from 1), dist (Euclidean); a query's own id is left out.

    queries and base have cell_id and vec. Up to block queries go to every task, which keeps the best k of its own rows for each.
    More are cut into blocks by a hash, and so are the rows; each block of queries meets each block of rows in a task of its own.
    The best of each are merged by query, so that never all pairs exist anywhere. Ties go to the smaller id. Rows with a null
    id or vector are left out; with fewer than k other vectors all are given.
    """
    spark, kind = base.sparkSession, base.schema["cell_id"].dataType.simpleString()
    given = lambda df: df.filter("cell_id IS NOT NULL AND vec IS NOT NULL").select("cell_id", F.col("vec").cast("array<double>").alias("vec"))
    rows, asked = given(base), given(queries)
    schema = f"src {kind}, dst {kind}, dist double"
    count = asked.count()
    if not count:
        return spark.createDataFrame([], f"src {kind}, dst {kind}, rnk int, dist double")

    def give(ids: np.ndarray, kept: tuple[np.ndarray, np.ndarray] | None) -> pa.RecordBatch:
        d, i = kept if kept is not None else (np.zeros((len(ids), 0)), np.zeros((len(ids), 0), object))
        good = np.isfinite(d)
        src = np.broadcast_to(ids[:, None], d.shape)[good]
        return pa.RecordBatch.from_arrays([pa.array(src.tolist()).cast(_arrow(kind)), pa.array(i[good].tolist()).cast(_arrow(kind)), pa.array(d[good])], ["src", "dst", "dist"])

    if count <= block:
        some = asked.collect()  # at most block rows
        shared = spark.sparkContext.broadcast((np.array([r["cell_id"] for r in some], object), np.array([r["vec"] for r in some], float)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (ids, q), kept = shared.value, None
            for big in batches:
                for at in range(0, big.num_rows, 2048):
                    b = big.slice(at, 2048)
                    kept = _best(ids, q, kept, np.array(b.column(0).to_pylist(), object), np.array(b.column(1).flatten().to_numpy(zero_copy_only=False)).reshape(b.num_rows, -1), k)
            yield give(ids, kept)

        found = rows.mapInArrow(run, schema)
    else:
        own = lambda n: F.pmod(F.xxhash64("cell_id"), F.lit(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        n_q, n_r = max(1, -(-count // block)), max(1, -(-rows.count() // rows_block))

        def meet(left, right):
            import pandas as pd

            ids, kept = left["cell_id"].to_numpy(object), None
            if len(left) and len(right):
                q, x, names = np.vstack(left["vec"].to_numpy()), np.vstack(right["vec"].to_numpy()), right["cell_id"].to_numpy(object)
                for at in range(0, len(x), 2048):
                    kept = _best(ids, q, kept, names[at : at + 2048], x[at : at + 2048], k)
            return pa.Table.from_batches([give(ids, kept)]).to_pandas() if kept is not None else pd.DataFrame({c: pd.Series([], dtype=t) for c, t in (("src", left["cell_id"].dtype), ("dst", left["cell_id"].dtype), ("dist", float))})

        left, right = asked.withColumn("qb", own(n_q)).withColumn("rb", every(n_r)), rows.withColumn("rb", own(n_r)).withColumn("qb", every(n_q))
        found = left.groupBy("qb", "rb").cogroup(right.groupBy("qb", "rb")).applyInPandas(meet, schema)
    place = F.row_number().over(W.partitionBy("src").orderBy("dist", "dst"))
    return found.withColumn("rnk", place).filter(F.col("rnk") <= k).select("src", "dst", "rnk", "dist")


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def _probes(ranks: np.ndarray, recall: float) -> int:
    """The fewest lists to look at; ranks has, per measured query, the places of its true neighbours' lists among its nearest lists (-1: none).

    The mean recall of the queries less two standard errors must reach recall.
    """
    have = (ranks >= 0).sum(axis=1)
    ranks, have = ranks[have > 0], have[have > 0]
    top = int(ranks.max(initial=0)) + 1
    for p in range(1, top):
        r = ((ranks >= 0) & (ranks < p)).sum(axis=1) / have
        if r.mean() - 2 * r.std() / len(r) ** 0.5 >= recall:
            return p
    return top


def nearest_indexed(base: DataFrame, k: int = 20, lists: int | None = None, probes: int | None = None, sample: int = 20_000, queries: DataFrame | None = None, recall: float = RECALL) -> DataFrame:
    """Approximate neighbours by an inverted file: src, dst, rnk, dist.

    lists centroids are fitted on a sample of at most so many rows (by a hash of the id); every row is then indexed in the list
    of its nearest centroid, and every query looks at its probes nearest lists. Lists beyond a bound are cut by a hash of the id
    into parts, and so are their queries; each part of the one meets each part of the other in a task of its own, so that a hot
    list makes no large task and no row is left out. queries defaults to all rows, lists to the root of their number (64 to 4,096).
    Without probes, as many lists are looked at as recall takes: MEASURED queries are searched exactly, and the places of their
    true neighbours' lists tell the recall of every number of probes, up to all lists where the vectors have no structure.
    """
    spark, kind = base.sparkSession, base.schema["cell_id"].dataType.simpleString()
    rows = base.filter("cell_id IS NOT NULL AND vec IS NOT NULL").select("cell_id", F.col("vec").cast("array<double>").alias("vec"))
    asked = rows if queries is None else queries.filter("cell_id IS NOT NULL AND vec IS NOT NULL").select("cell_id", F.col("vec").cast("array<double>").alias("vec"))
    fit = np.array([r["vec"] for r in rows.orderBy(F.xxhash64("cell_id"), "cell_id").limit(sample).select("vec").collect()])
    if not len(fit):
        return spark.createDataFrame([], f"src {kind}, dst {kind}, rnk int, dist double")
    lists = lists or min(4096, max(64, int(rows.count() ** 0.5)))
    c = fit[np.linspace(0, len(fit) - 1, min(lists, len(fit))).astype(int)]
    for _ in range(8):
        near = ((c * c).sum(1)[None, :] - 2 * fit @ c.T).argmin(1)
        c = np.array([fit[near == j].mean(0) if (near == j).any() else c[j] for j in range(len(c))])
    shared = spark.sparkContext.broadcast(c)

    def lists_of(count: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    x = np.array(b.column(1).flatten().to_numpy(zero_copy_only=False)).reshape(b.num_rows, -1)
                    c = shared.value
                    order = ((c * c).sum(1)[None, :] - 2 * x @ c.T).argsort(axis=1, kind="stable")[:, :count]
                    yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(order.tolist(), pa.list_(pa.int32()))], ["cell_id", "vec", "lists"])

        return run

    schema = f"cell_id {kind}, vec array<double>, lists array<int>"
    at = materialize(rows.mapInArrow(lists_of(1), schema).select("cell_id", "vec", F.col("lists")[0].alias("list")), "lists")
    if probes is None:
        some = asked.orderBy(F.xxhash64("cell_id", F.lit(1)), "cell_id").limit(MEASURED).collect()
        true = nearest(spark.createDataFrame(some, asked.schema), rows, k).join(at.select(F.col("cell_id").alias("dst"), "list"), "dst").select("src", "list").collect()
        of = {r["cell_id"]: i for i, r in enumerate(some)}
        x = np.array([r["vec"] for r in some]).reshape(len(some), -1)
        place = ((c * c).sum(1)[None, :] - 2 * x @ c.T).argsort(axis=1, kind="stable").argsort(axis=1) if len(some) else None
        held: list[list[int]] = [[] for _ in some]
        for r in true:
            held[of[r["src"]]].append(int(place[of[r["src"]], r["list"]]))
        ranks = np.full((len(some), max(map(len, held), default=0)), -1)
        for i, h in enumerate(held):
            ranks[i, : len(h)] = h
        probes = _probes(ranks, recall)
    sizes = at.groupBy("list").agg((F.ceil(F.count(F.lit(1)) / 20_000.0)).cast("int").alias("parts"))  # one row per list
    own = F.pmod(F.xxhash64("cell_id"), F.col("parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    at = at.join(F.broadcast(sizes), "list").withColumn("part", own).withColumn("turn", every)
    want = asked.mapInArrow(lists_of(min(probes, len(c))), schema).select("cell_id", "vec", F.explode("lists").alias("list")).join(F.broadcast(sizes), "list")
    want = want.withColumn("turn", own).withColumn("part", every)

    def search(key, left, right):
        import pandas as pd

        q, x = np.vstack(left["vec"].to_numpy()), np.vstack(right["vec"].to_numpy())
        own, ids = left["cell_id"].to_numpy(), right["cell_id"].to_numpy()
        frames = []
        for s in range(0, len(q), 1024):
            d = np.sqrt(np.maximum((q[s : s + 1024] ** 2).sum(1)[:, None] - 2 * q[s : s + 1024] @ x.T + (x * x).sum(1)[None, :], 0))
            d[own[s : s + 1024, None] == ids[None, :]] = np.inf
            top = d.argsort(axis=1, kind="stable")[:, :k]
            v = np.take_along_axis(d, top, 1)
            good = np.isfinite(v)
            frames.append(pd.DataFrame({"src": np.repeat(own[s : s + 1024], top.shape[1])[good.ravel()], "dst": ids[top.ravel()][good.ravel()], "dist": v[good]}))
        return pd.concat(frames) if frames else pd.DataFrame({"src": [], "dst": [], "dist": []})

    def both(key, left, right):
        import pandas as pd

        return search(key, left, right) if len(left) and len(right) else pd.DataFrame({"src": pd.Series([], dtype=left["cell_id"].dtype), "dst": pd.Series([], dtype=left["cell_id"].dtype), "dist": pd.Series([], dtype=float)})

    place_of = ["list", "part", "turn"]
    found = want.select(*place_of, "cell_id", "vec").groupBy(*place_of).cogroup(at.select(*place_of, "cell_id", "vec").groupBy(*place_of)).applyInPandas(both, f"src {kind}, dst {kind}, dist double")
    place = F.row_number().over(W.partitionBy("src").orderBy("dist", "dst"))
    return found.withColumn("rnk", place).filter(F.col("rnk") <= k).select("src", "dst", "rnk", "dist")


def neighbour_graph(vectors: DataFrame, k: int = 20, exact: bool = False) -> DataFrame:
    """The k nearest of every vector: by the inverted file with a measured recall of RECALL or more, or by exact search if that is asked for."""
    return nearest(vectors, vectors, k) if exact else nearest_indexed(vectors, k)


def shared_neighbours(nn: DataFrame, prune: float = 1 / 15, hub: int = HUB) -> DataFrame:
    """The shared-neighbour graph: src < dst, weight = common / all neighbours (each cell is its own), weights below prune left out.

    Cells meet at the neighbours that they share. The cells of a neighbour of more than hub cells are cut into parts by a hash, and
    each part meets each other part in a task of its own, so that a hub makes no large task.
    """
    nn = materialize(nn.select("src", "dst"), "nn")  # read several times below
    own = nn.union(nn.select("src", F.col("src").alias("dst")).distinct())
    sizes = own.groupBy("src").agg(F.count(F.lit(1)).alias("k"))
    hubs = own.groupBy("dst").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(hub))).cast("int").alias("parts")).filter("parts > 1")
    cut = materialize(own.join(hubs, "dst", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", F.pmod(F.xxhash64("src"), F.col("parts")).cast("int")), "hubs")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    a = cut.select(F.col("src").alias("x"), "dst", F.col("part").alias("p"), every.alias("q"))
    b = cut.select(F.col("src").alias("y"), "dst", F.col("part").alias("q"), every.alias("p"))
    common = a.join(b, ["dst", "p", "q"]).filter("x < y").groupBy("x", "y").agg(F.count(F.lit(1)).alias("c"))
    j = common.join(sizes.select(F.col("src").alias("x"), F.col("k").alias("kx")), "x").join(sizes.select(F.col("src").alias("y"), F.col("k").alias("ky")), "y")
    weight = F.col("c") / (F.col("kx") + F.col("ky") - F.col("c"))
    return j.select(F.col("x").alias("src"), F.col("y").alias("dst"), weight.alias("weight")).filter(F.col("weight") >= prune)


def same_label_fraction(nn: DataFrame, cells: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Per field the mean, over the cells with a label, of the share of neighbours with the same label: field, value, cells."""
    label = lambda f: F.when(F.trim(F.col(f).cast("string")) != "", F.col(f).cast("string"))
    long = cells.select("cell_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), label(f).alias("v")) for f in fields])).alias("l")).select("cell_id", "l.field", "l.v")
    a = nn.select("src", "dst").join(long.select(F.col("cell_id").alias("src"), "field", F.col("v").alias("a")), "src").filter("a IS NOT NULL")
    pairs = a.join(long.select(F.col("cell_id").alias("dst"), F.col("field").alias("f"), F.col("v").alias("b")), "dst").filter("field = f")
    each = pairs.groupBy("field", "src").agg(F.avg(F.coalesce((F.col("a") == F.col("b")).cast("double"), F.lit(0.0))).alias("s"))
    return each.groupBy("field").agg(F.avg("s").alias("value"), F.count(F.lit(1)).alias("cells"))


def neighbour_means(nn: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """values' cells with the mean of value over their neighbours; a neighbour without a value counts as 0."""
    v = values.select(F.col("cell_id").alias("dst"), F.col(value).alias("_v"))
    return nn.select("src", "dst").join(v, "dst", "left").groupBy(F.col("src").alias("cell_id")).agg(F.avg(F.coalesce("_v", F.lit(0.0))).alias("smooth"))


def components(pairs: DataFrame, a: str, b: str, driver_pairs: int = DRIVER_PAIRS) -> int:
    """The number of connected groups of a bipartite graph of labels.

    Up to driver_pairs distinct pairs are joined on the driver. With more, every label takes the least label of those beside it until
    none changes; labels take those of their labels at the same time, so that chains are short.
    """
    name = lambda side, c: F.concat(F.lit(side), F.col(c).cast("string"))
    edges = materialize(pairs.select(name("a", a).alias("x"), name("b", b).alias("y")).dropna().distinct(), "pairs")
    if edges.count() <= driver_pairs:
        root: dict[str, str] = {}

        def find(x: str) -> str:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for r in edges.collect():
            root[find(r["x"])] = find(r["y"])
        return len({find(x) for x in list(root)})
    both = edges.union(edges.select("y", "x"))
    labels = materialize(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("label")), "labels")
    while True:
        beside = both.join(labels.select(F.col("x").alias("y"), "label"), "y").groupBy("x").agg(F.min("label").alias("near"))
        new = labels.join(beside, "x").select("x", "label", F.least("label", "near").alias("least"))
        jump = labels.select(F.col("x").alias("least"), F.col("label").alias("further"))
        new = materialize(new.join(jump, "least").select("x", F.least("least", "further").alias("label"), (F.least("least", "further") != F.col("label")).alias("moved")), "labels")
        labels = new.select("x", "label")
        if new.filter("moved").isEmpty():
            return labels.select("label").distinct().count()


def batch_design(cells: DataFrame, fields: Sequence[str], group: str, selected: str | None, technical: Sequence[str] = ()) -> DataFrame:
    """Per candidate field: available, n_levels, n_missing, role, confounded_with_group, selected and the one decision.

    A field is confounded with the group when the graph of their value pairs falls into several parts: then no model of both has
    full rank. It is null where a label is missing or there is one level only. Sample may be the batch whatever the groups are.
    """
    spark = cells.sparkSession
    blank = lambda c: c.isNull() | (F.trim(c.cast("string")) == "")
    have = [f for f in fields if f in cells.columns]
    names = [*have, *([group] if group in cells.columns and group not in have else [])]
    one = cells.agg(
        F.count(F.lit(1)).alias("n"), *[x for f in names for x in (F.countDistinct(F.when(~blank(F.col(f)), F.col(f))).alias(f"levels_{f}"), F.count(F.when(blank(F.col(f)), 1)).alias(f"missing_{f}"))]
    ).first()
    group_ok = group in cells.columns and not one[f"missing_{group}"]

    def confounded(f: str) -> bool | None:
        if not group_ok or f not in have or one[f"missing_{f}"] or one[f"levels_{f}"] < 2 or one[f"levels_{group}"] < 2:
            return None
        return components(cells, f, group) > 1

    found = {f: confounded(f) for f in fields}

    def decide() -> str:
        if selected is None:
            return "NO_CONFIRMED_TECHNICAL_BATCH"
        if selected not in have:
            return "BATCH_FIELD_MISSING"
        if one[f"missing_{selected}"]:
            return "BATCH_VALUES_MISSING"
        if one[f"levels_{selected}"] < 2:
            return "ONE_BATCH_LEVEL"
        if selected != "sample":
            if selected not in technical:
                return "TECHNICAL_MEANING_UNCONFIRMED"
            if not group_ok:
                return "BIOLOGICAL_GROUP_UNAVAILABLE"
            if found.get(selected, confounded(selected)):
                return "BATCH_GROUP_CONFOUNDED"
        return "ELIGIBLE"

    reason = decide()
    role = lambda f: "BIOLOGICAL_SAMPLE" if f == "sample" else "CONFIRMED_TECHNICAL" if f in technical else "UNCONFIRMED_TECHNICAL_MEANING"
    rows = [(f, f in have, one[f"levels_{f}"] if f in have else 0, one[f"missing_{f}"] if f in have else one["n"], role(f), found[f], f == selected, reason) for f in fields]
    return spark.createDataFrame(rows, "field string, available boolean, n_levels bigint, n_missing bigint, role string, confounded_with_group boolean, selected boolean, decision string")


def label_grid(cells: DataFrame, a: Column, b: Column) -> DataFrame:
    """Counts of every combination of two labels, zero where none occurs: a, b, cells. Labels are few: their sets meet, not the cells."""
    pairs = cells.select(a.alias("a"), b.alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("cells"))
    sets = pairs.agg(F.array_sort(F.collect_set("a")).alias("x"), F.array_sort(F.collect_set("b")).alias("y")).select(F.explode("x").alias("a"), "y").select("a", F.explode("y").alias("b"))
    return sets.join(pairs, ["a", "b"], "left").withColumn("cells", F.coalesce("cells", F.lit(0)))
