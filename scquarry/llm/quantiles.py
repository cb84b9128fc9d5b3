"""Rank-interval summaries: percentiles of very large columns with bounded error, from parts that can be combined."""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scquarry.session import materialize

#: Tuples that a task holds before it compresses them.
BUFFER = 1 << 18
#: A summary's tuples beyond which it is compressed: each compression adds at most 1 / TUPLES of the group's rows to the
#: width of its rank intervals, half of that to the error of a percentile.
TUPLES = 2000
#: Summaries of a group that are merged at once, about: with more of them, they are merged in a tree, whose height is the logarithm
#: of their number to this base. Each level adds no more than 1 / TUPLES of the rows to the width of the rank intervals.
FAN = 32

_SUMMARY = "value double, g bigint, d bigint, sid bigint"
#: The columns of a summary beside its keys.
TUPLE = {"value": "tuple_value", "g": "tuple_g", "d": "tuple_d", "sid": "tuple_sid"}


def compress(gid: np.ndarray, value: np.ndarray, g: np.ndarray, d: np.ndarray, tuples: int) -> tuple[np.ndarray, ...]:
    """Summaries of at most about tuples + 2 tuples per group from tuples sorted by group and value.

    A tuple (value, g, d) says: g rows more than at the tuple before are known to be at most value, and d more may be. Runs of
    tuples that together hold no more than a step (the rows of the group / tuples) become one, that of the greatest value, which
    widens its rank interval by less than a step. The least and the greatest value stay.
    """
    if not len(gid):
        return gid, value, g, d
    first = np.flatnonzero(np.r_[True, gid[1:] != gid[:-1]])
    group = np.cumsum(np.r_[True, gid[1:] != gid[:-1]]) - 1
    size = np.diff(np.r_[first, len(gid)])
    total = np.add.reduceat(g, first)
    rank = np.cumsum(g)
    rank -= (rank[first] - g[first])[group]
    step = np.maximum(1, total // tuples)
    run = np.where((size > tuples)[group], (rank - 1) // step[group], np.arange(len(gid)))
    last = np.ones(len(gid), bool)
    last[:-1] = (group[1:] != group[:-1]) | (run[1:] != run[:-1])
    last[first] = True
    keep = np.flatnonzero(last)
    before = np.r_[0, rank[keep][:-1]]
    before[np.r_[True, group[keep][1:] != group[keep][:-1]]] = 0
    return gid[keep], value[keep], rank[keep] - before, d[keep]


def merge(gid: np.ndarray, sid: np.ndarray, value: np.ndarray, g: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each group's summaries (told apart by sid) as one: sorted tuples whose rank intervals hold for all rows of the group.

    Where a value lies between two tuples of another summary, that summary's part of its rank is known but for the width of the
    interval there, at most max(g + d) - 1: these widths add up in d.
    """
    order = np.lexsort((sid, gid))
    pair = np.flatnonzero(np.r_[True, (gid[order][1:] != gid[order][:-1]) | (sid[order][1:] != sid[order][:-1])]) if len(gid) else np.zeros(0, int)
    if len(pair):
        width = np.maximum.reduceat((g + d)[order], pair) - 1
        of = np.cumsum(np.isin(np.arange(len(gid)), pair)) - 1
        pair_gid = gid[order][pair]
        start = np.flatnonzero(np.r_[True, pair_gid[1:] != pair_gid[:-1]])
        others = np.repeat(np.add.reduceat(width, start), np.diff(np.r_[start, len(pair)])) - width
        d = d.copy()
        d[order] += others[of]
    order = np.lexsort((value, gid))
    return gid[order], value[order], g[order], d[order]


def _codes(column: pa.Array) -> tuple[np.ndarray, list]:
    x = column.dictionary_encode() if not isinstance(column, pa.DictionaryArray) else column
    return x.indices.to_numpy(zero_copy_only=False).astype(np.int64), x.dictionary.to_pylist()


def _emit(names: list, gid: np.ndarray, value: np.ndarray, g: np.ndarray, d: np.ndarray, sid: int) -> pa.RecordBatch:
    """Every group's tuples get a sid of their own: groups that are combined later keep their summaries apart."""
    key = pa.array(names, pa.string()).take(pa.array(gid))
    return pa.RecordBatch.from_arrays([key, pa.array(value), pa.array(g), pa.array(d), pa.array(sid + gid)], ["k", "value", "g", "d", "sid"])


def _partial(tuples: int, whole: bool):
    """For mapInArrow: summaries of what a task sees. whole: rows come sorted by k, and a group's last batch closes it.

    Names of summaries are made from the call, the task and the buffer, so that a task that runs again makes the same ones.
    """
    call = uuid.uuid4().hex

    def flush(held: list[pa.RecordBatch], more: bool, number: int) -> tuple[pa.RecordBatch | None, list[pa.RecordBatch]]:
        t = pa.Table.from_batches(held).combine_chunks()
        k = t.column("k").combine_chunks()
        gid, names = _codes(k.chunk(0) if isinstance(k, pa.ChunkedArray) else k)
        closed = len(gid)
        if whole and more:
            closed = int(np.argmax(gid == gid[-1]))  # the last group may go on; it waits, unless it fills the buffer by itself
            if len(gid) - closed >= BUFFER:
                closed = len(gid)
        rest = [b for b in t.slice(closed).to_batches() if b.num_rows]
        gid, value, g, d, sid = gid[:closed], *(t.column(c).to_numpy()[:closed] for c in ("value", "g", "d", "sid"))
        # Rows of plain values (sid 0) are exact: all of them are one summary.
        gid, value, g, d = compress(*merge(gid, sid, value, g, d), tuples)
        name = int.from_bytes(hashlib.blake2b(f"{call} {TaskContext.get().partitionId()} {number}".encode(), digest_size=7).digest(), "big") << 6
        return _emit(names, gid, value, g, d, name), rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = number = 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            size += b.num_rows
            if size >= BUFFER:
                out, held = flush(held, True, number)
                size, number = sum(x.num_rows for x in held), number + 1
                yield out
        if held:
            yield flush(held, False, number)[0]

    return run


def _key(keys: Sequence[str]) -> Column:
    """The keys as one text, null told apart from blank; decoded by _keys()."""
    return F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("+"), F.col(k).cast("string")), F.lit("-")) for k in keys]) if keys else F.lit("")


def _keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    part = [F.split("k", "\x1f").getItem(i) for i in range(len(keys))]
    return df.select(*[F.when(p.startswith("+"), F.substring(p, 2, 2**31 - 1)).alias(k) for p, k in zip(part, keys)], *[F.col(c).alias(n) for c, n in TUPLE.items()])


def _reduce(parts: DataFrame, tuples: int) -> DataFrame:
    """One summary per k from partial summaries, merged in a tree: about FAN at once, as often as their number asks for.

    A group with a third of all rows is thus merged in as many tasks as it has FAN summaries, and its error grows with the height of
    the tree only.
    """
    schema = f"k string, {_SUMMARY}"
    parts = materialize(parts, "summaries")
    most = parts.select("k", "sid").distinct().groupBy("k").count().agg(F.coalesce(F.max("count"), F.lit(0)).alias("m")).first()["m"]
    while most > FAN:
        most = math.ceil(most / FAN)
        part = F.concat("k", F.lit("\x1e"), F.pmod(F.xxhash64("sid"), F.lit(most)).cast("string"))
        merged = parts.withColumn("k", part).repartition("k").sortWithinPartitions("k", "value", "sid", "g", "d").mapInArrow(_partial(tuples, True), schema)
        parts = materialize(merged.withColumn("k", F.regexp_replace("k", "\x1e[0-9]+$", "")), "summaries")
    return parts.repartition(F.col("k")).sortWithinPartitions("k", "value", "sid", "g", "d").mapInArrow(_partial(tuples, True), schema)


def summarize(df: DataFrame, keys: Sequence[str], value: str, tuples: int = TUPLES) -> DataFrame:
    """Summaries (keys as text, and the columns of TUPLE) of the numbers in a column, one per combination of keys.

    Null and NaN are no measurements; infinite numbers are the least and the greatest; groups without measurements have no summary.
    Every task summarizes its own rows before anything is sent, so that a hot group costs no more than any other.
    """
    v = F.col(value).cast("double")
    rows = df.filter(v.isNotNull() & ~F.isnan(v)).select(_key(keys).alias("k"), v.alias("value"), F.lit(1).cast("bigint").alias("g"), F.lit(0).cast("bigint").alias("d"), F.lit(0).cast("bigint").alias("sid"))
    return _keys(_reduce(rows.mapInArrow(_partial(tuples, False), f"k string, {_SUMMARY}"), tuples), keys)


def combine(summaries: DataFrame, keys: Sequence[str], tuples: int = TUPLES) -> DataFrame:
    """Summaries by fewer keys from summaries by more, for instance samples from their days; unions of stored results too."""
    rows = summaries.select(_key(keys).alias("k"), *[F.col(n).alias(c) for c, n in TUPLE.items()])
    return _keys(_reduce(rows.mapInArrow(_partial(tuples, False), f"k string, {_SUMMARY}"), tuples), keys)


def ranks(summaries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, tuple_value and its rank interval: rmin and rmax, its least and its greatest rank, and the group's n."""
    from pyspark.sql import Window as W

    w = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(1))
    running = w.orderBy("tuple_value", "tuple_g", "tuple_d").rowsBetween(W.unboundedPreceding, 0)
    return summaries.withColumn("rmin", F.sum("tuple_g").over(running)).withColumn("n", F.sum("tuple_g").over(w)).withColumn("rmax", F.least(F.col("rmin") + F.col("tuple_d"), F.col("n")))


def percentiles(summaries: DataFrame, keys: Sequence[str], percents: Sequence[float]) -> DataFrame:
    """Per group and percent: n, value and rank_error, a bound of how many ranks the value is off ceil(percent / 100 * n)."""
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in percents])).alias("percent")
    r = ranks(summaries, keys).select(*keys, F.col("tuple_value").alias("value"), "rmin", "rmax", "n", wanted)
    target = F.greatest(F.lit(1), F.ceil(F.col("percent") * F.col("n") / 100)).cast("bigint")
    r = r.withColumn("off", F.greatest(F.abs(target - F.col("rmin")), F.abs(F.col("rmax") - target)))
    best = r.groupBy(*keys, "percent").agg(F.min(F.struct("off", "value")).alias("b"), F.max("n").alias("n"))
    return best.select(*keys, "percent", "n", F.col("b.value").alias("value"), F.col("b.off").alias("rank_error"))
