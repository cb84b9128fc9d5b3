"""Differences between two copies of a dataset, found with invertible Bloom lookup tables (IBLTs)."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scquarry.functions.text import blank_to_null, strip
from scquarry.session import materialize

#: Every element sits in one cell of each of PARTS parts of its table.
PARTS = 3
#: Cells per part of a bucket's table; elements that a bucket is planned to decode (half of its cells: far below the load of
#: 0.81 up to which three parts can be peeled); rounds with four times as many buckets for the buckets that fail.
PART_CELLS, BUCKET_ELEMENTS, ROUNDS = 1024, 1536, 6
#: Differing keys up to which they are sent to every task to fetch their rows (8 bytes each); more are joined by a shuffle.
BROADCAST_KEYS = 1_000_000
#: The estimator's table: strata, cells per part of a stratum.
STRATA, STRATUM_CELLS = 48, 32

_M = 0xFFFFFFFFFFFFFFFF


def _hash_long(x: np.ndarray) -> np.ndarray:
    """xxHash64 of 64-bit integers with seed 42, as Spark's xxhash64 of one bigint column."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    rot = lambda v, r: (v << np.uint64(r)) | (v >> np.uint64(64 - r))
    with np.errstate(over="ignore"):
        h = np.full(len(x), 42, np.uint64) + p5 + np.uint64(8)
        h = rot(h ^ (rot(x.astype(np.uint64) * p2, 31) * p1), 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        return h ^ (h >> np.uint64(32))


def _element_hash(key: np.ndarray, row: np.ndarray) -> np.ndarray:
    return _hash_long(_hash_long(key) ^ row)


def _positions(e: np.ndarray, cells: int) -> np.ndarray:
    """The element's cell in each part, parts one after the other."""
    return np.stack([((e >> np.uint64(20 * j)) & np.uint64(cells - 1)).astype(np.int64) + j * cells for j in range(PARTS)], axis=1)


def peel(cells: int, pos: np.ndarray, n: np.ndarray, key: np.ndarray, row: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, bool]:
    """The keys of the elements of a subtracted table, and whether all of it could be read.

    pos, n, key, row and check describe the cells that aren't missing. Cells with one element left are read and their
    elements taken out, all at once, until none is left.
    """
    size = PARTS * cells
    c, k, r, h = np.zeros(size, np.int64), np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.zeros(size, np.uint64)
    c[pos], k[pos], r[pos], h[pos] = n, key, row, check
    found: list[np.ndarray] = []
    for _ in range(size):
        at = np.flatnonzero(np.abs(c) == 1)
        if len(at):
            e = _element_hash(k[at], r[at])
            where = _positions(e, cells)
            good = (_hash_long(e) == h[at]) & (where == at[:, None]).any(axis=1)
            at, e, where = at[good], e[good], where[good]
        if not len(at):
            break
        _, first = np.unique(e, return_index=True)
        at, e, where = at[first], e[first], where[first]
        keys, rows, signs, checks = k[at], r[at], c[at], _hash_long(e)
        found.append(keys)
        for j in range(PARTS):
            np.subtract.at(c, where[:, j], signs)
            np.bitwise_xor.at(k, where[:, j], keys)
            np.bitwise_xor.at(r, where[:, j], rows)
            np.bitwise_xor.at(h, where[:, j], checks)
    done = not (c.any() or k.any() or r.any() or h.any())
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), done


def _numeric_token(c: Column, tolerance: float) -> list[Column]:
    """Columns to hash in place of a number: equal only for numbers at most tolerance apart, and equal for most of those.

    Small numbers are rounded to a grid as fine as the tolerance, so that numeric noise around a decimal fraction stays in
    one cell; numbers for which the grid would be finer than their own precision stand for themselves.
    """
    x = c.cast("double")
    small = F.abs(x) < float(2**50) * tolerance
    kind = F.when(x.isNull(), 0).when(F.isnan(x), 1).when(small, 2).otherwise(3)
    return [kind, F.when(kind == 2, F.rint(x / tolerance).cast("bigint")).otherwise(0), F.when(kind == 3, x).otherwise(0.0)]


def _text_token(c: Column) -> list[Column]:
    s = blank_to_null(c.cast("string"))
    return [s.isNull(), F.coalesce(s, F.lit(""))]


def _elements(rows: DataFrame, version: str, sides: tuple[str, str]) -> DataFrame:
    e = F.xxhash64(F.xxhash64("_k").bitwiseXOR(F.col("_h")))
    return rows.select("_k", "_h", F.when(F.col(version) == sides[0], 1).otherwise(-1).alias("_sign"), e.alias("_e"), F.xxhash64(e).alias("_check"))


def _cells(elements: DataFrame, by: Column, cells: int) -> DataFrame:
    """The subtracted tables: adding one copy's elements with +1 and the other's with -1 subtracts the tables cell by cell."""
    at = F.array(*[(F.shiftrightunsigned("_e", 20 * j).bitwiseAND(F.lit(cells - 1)) + F.lit(j * cells)).cast("int") for j in range(PARTS)])
    return (
        elements.select(by.alias("_by"), F.explode(at).alias("_pos"), "_sign", "_k", "_h", "_check")
        .groupBy("_by", "_pos")
        .agg(F.sum("_sign").alias("n"), F.bit_xor("_k").alias("k"), F.bit_xor("_h").alias("h"), F.bit_xor("_check").alias("check"))
        .filter("n <> 0 OR k <> 0 OR h <> 0 OR check <> 0")
    )


def _arrays(p: pd.DataFrame) -> tuple[np.ndarray, ...]:
    return p["_pos"].to_numpy(np.int64), p["n"].to_numpy(np.int64), *(p[c].to_numpy(np.int64).view(np.uint64) for c in ("k", "h", "check"))


def estimate(elements: DataFrame) -> int:
    """About how many elements are in one copy only: strata that hold every second, fourth, eighth ... element are peeled.

    The strata's tables have at most STRATA * PARTS * STRATUM_CELLS cells, whatever the data; they come to the driver.
    """
    e = F.col("_check")
    stratum = F.least(F.lit(STRATA - 1), F.coalesce(F.log2(e.bitwiseAND(F.negate(F.greatest(e, F.lit(-(2**63) + 1)))).cast("double")), F.lit(0)).cast("int"))
    cells = _cells(elements, stratum, STRATUM_CELLS).toPandas()
    count = 0
    for i in range(STRATA - 1, -1, -1):
        keys, done = peel(STRATUM_CELLS, *_arrays(cells[cells["_by"] == i]))
        if not done:
            return max(count, 1) * 2 ** (i + 1) if count else 2 ** (i + 1) * STRATUM_CELLS
        count += len(keys)
    return count


def differing_keys(rows: DataFrame, version: str, sides: tuple[str, str]) -> DataFrame:
    """Key hashes (_k) of the rows that the two copies don't share; a few keys too many where decoding failed ROUNDS times.

    Buckets of keys have their own tables, so every task decodes a bounded table. The number of buckets follows the estimate;
    buckets that can't be decoded are tried again with four times as many.
    """
    elements = _elements(rows, version, sides)
    buckets = max(1, math.ceil(estimate(elements) / BUCKET_ELEMENTS))
    found, failed = [], None

    def decode(p: pd.DataFrame) -> pd.DataFrame:
        keys, done = peel(PART_CELLS, *_arrays(p))
        keys = np.unique(keys).view(np.int64)
        return pd.DataFrame({"_by": p["_by"].iloc[0], "_k": keys, "_failed": False}) if done else pd.DataFrame({"_by": p["_by"].iloc[:1], "_k": [0], "_failed": True})

    for _ in range(ROUNDS):
        part = elements if failed is None else elements.join(failed[1], F.pmod("_k", F.lit(failed[0])) == F.col("_bad"), "left_semi")
        got = materialize(_cells(part, F.pmod("_k", F.lit(buckets)), PART_CELLS).groupBy("_by").applyInPandas(decode, "_by bigint, _k bigint, _failed boolean"), "iblt")
        found.append(got.filter("NOT _failed").select("_k"))
        bad = got.filter("_failed").select(F.col("_by").alias("_bad"))
        if bad.isEmpty():
            failed = None
            break
        failed, buckets = (buckets, bad), buckets * 4
    if failed is not None:
        found.append(elements.join(failed[1], F.pmod("_k", F.lit(failed[0])) == F.col("_bad"), "left_semi").select("_k"))
    out = found[0]
    for x in found[1:]:
        out = out.union(x)
    return out.distinct()


def _order_key(order: Sequence[str], rows: DataFrame) -> Column:
    """order as one value to be compared: a number where a time and a whole number are given, for which hash aggregation has room."""
    kinds = [rows.schema[c].dataType.simpleString() for c in order]
    if kinds == ["timestamp", "bigint"]:
        at = F.coalesce(F.unix_micros(order[0]), F.lit(-(2**63))).cast("decimal(19,0)")
        return (at * F.expr("10000000000000000000BD")).cast("decimal(38,0)") + F.coalesce(order[1], F.lit(-(2**63))).cast("decimal(19,0)")
    return F.struct(*order)


def diff_copies(
    rows: DataFrame,
    version: str,
    keys: Sequence[str],
    numeric: Sequence[str] = (),
    text: Sequence[str] = (),
    sides: tuple[str, str] = ("original", "skill"),
    tolerance: float = 1e-10,
    names: dict[str, str] | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """What two copies of a dataset disagree on: (keys, field_name), one row per differing field.

    rows holds both copies, told apart by version (one of sides; other rows are ignored). With order, only the row of a key and
    version that is greatest in it (nulls least; its last column tells all rows apart) counts; without it keys must be unique in
    each copy. field_name is missing_<side> for a key that only the other copy has, else the name of a field in which the copies
    differ (names renames fields; two fields of one name give one row). Numbers differ when more than tolerance apart; NaN equals
    NaN only; texts differ after trimming, blank equals null, null differs from any value. Null keys equal one another. Copies that
    agree, and empty tables, give no rows.

    Of rows that agree only hashes are read, sent (where order must choose among them) and written: tables of key and row hash are
    subtracted and peeled, and only the rows of the keys so found are fetched and compared field by field, which also removes the
    keys that differ by noise only.
    """
    names = names or {}
    token = [t for c in numeric for t in _numeric_token(F.col(c), tolerance)] + [t for c in text for t in _text_token(F.col(c))]
    key_token = [t for k in keys for t in (F.col(k).isNull(), F.coalesce(F.col(k).cast("string"), F.lit("")))]
    own = rows.filter(F.col(version).isin(*sides))
    hashed = own.select(version, *keys, *numeric, *text, *order, F.xxhash64(*key_token).alias("_k"))
    short = own.select(version, F.xxhash64(*key_token).alias("_k"), F.xxhash64(F.lit("key"), *key_token).alias("_k2"), F.xxhash64(F.lit("row"), *key_token, *token).alias("_h"), *order)
    if order:  # keys are told apart by 128 bits here
        short = short.select(version, "_k", "_k2", "_h", _order_key(order, own).alias("_o")).groupBy(version, "_k", "_k2").agg(F.max_by("_h", "_o").alias("_h"))
    short = materialize(short.select(version, "_k", "_h"), "hashes")
    differing = materialize(differing_keys(short, version, sides), "differing")
    wanted = hashed.join(F.broadcast(differing) if differing.count() <= BROADCAST_KEYS else differing, "_k", "left_semi")
    if order:
        wanted = latest_rows(wanted, (version, "_k", *keys), order)
    wanted = materialize(wanted, "differing")  # both sides are read from it

    def side(s: str, prefix: str) -> DataFrame:
        return wanted.filter(F.col(version) == s).select(F.col("_k").alias(f"{prefix}_k"), *[F.col(c).alias(prefix + c) for c in (*keys, *numeric, *text)])

    same_key = F.col("a_k") == F.col("b_k")
    for k in keys:
        same_key &= F.col("a" + k).eqNullSafe(F.col("b" + k))
    both = side(sides[0], "a").join(side(sides[1], "b"), same_key, "full_outer")
    out: list[Column] = []
    for c in numeric:
        a, b = F.col("a" + c).cast("double"), F.col("b" + c).cast("double")
        same = a.eqNullSafe(b) | F.coalesce(F.abs(a - b) <= tolerance, F.lit(False))
        out.append(F.when(~same, F.lit(names.get(c, c))))
    for c in text:
        a, b = blank_to_null(F.col("a" + c).cast("string")), blank_to_null(F.col("b" + c).cast("string"))
        out.append(F.when(~a.eqNullSafe(b), F.lit(names.get(c, c))))
    fields = (
        F.when(F.col("a_k").isNull(), F.array(F.lit(f"missing_{sides[0]}")))
        .when(F.col("b_k").isNull(), F.array(F.lit(f"missing_{sides[1]}")))
        .otherwise(F.array_distinct(F.array_compact(F.array(*out)) if out else F.array().cast("array<string>")))
    )
    chosen = [F.when(F.col("a_k").isNull(), F.col("b" + k)).otherwise(F.col("a" + k)).alias(k) for k in keys]
    return both.select(*chosen, F.explode(fields).alias("field_name"))


def latest_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key the row that is greatest in order (nulls least), combined on the map side; ties in all of order need a unique last column."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def normal_version(c: Column) -> Column:
    return F.lower(strip(c))
