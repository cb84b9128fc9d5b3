"""Sinks: bundles of tables that are read back before they are published, single-file tables, manifests."""

from __future__ import annotations

import csv
import hashlib
import json
import os
import shutil
import tempfile
import uuid
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scquarry.operators.matrix import fingerprint
from scquarry.sources.routing import safe_path

MANIFEST = ("database", "sample", "tissue", "disease", "source_type", "group", "local_path", "file_type", "count_source", "count_evidence", "metadata_evidence", "files_json")
#: Values of a kind of problem that are named; beyond them the number of all is given.
EXAMPLES = 20
READABLE = ("10x_mtx", "10x_h5", "h5ad", "rds", "text")


def _print(df: DataFrame) -> tuple:
    return tuple(fingerprint(df, sorted(df.columns)).first())


def write_bundle(tables: dict[str, DataFrame], target: str | Path, provenance: dict | None = None) -> dict:
    """Write tables as Parquet below target, which must not exist with other content: staged, read back, compared, then renamed.

    The manifest holds rows, schema and an order-free fingerprint of every table. A bundle of equal content is used again.
    """
    target = Path(target)
    spark = next(iter(tables.values())).sparkSession
    staged = target.with_name(f".{target.name}.{uuid.uuid4().hex}")
    manifest = {"provenance": provenance or {}, "tables": {}}
    try:
        for name, df in tables.items():
            df.write.parquet(str(staged / name))
            back = spark.read.schema(df.schema).parquet(str(staged / name))
            got, want = _print(back), _print(df)
            if got != want:
                raise ValueError(f"{name}: what was read back differs from what was written")
            manifest["tables"][name] = {"rows": got[0], "hash_xor": got[1], "hash_sum": got[2], "schema": json.loads(df.schema.json())}
        atomic_json(staged / "manifest.json", manifest)
        if target.exists():
            if json.loads((target / "manifest.json").read_text(encoding="utf-8"))["tables"] != manifest["tables"]:
                raise FileExistsError(f"{target} holds other content")
        else:
            os.rename(staged, target)
    finally:
        shutil.rmtree(staged, ignore_errors=True)
    return manifest


def read_bundle(spark: SparkSession, target: str | Path, verify: bool = True) -> dict[str, DataFrame]:
    """The tables of a bundle; verify compares them with the manifest."""
    manifest = json.loads((Path(target) / "manifest.json").read_text(encoding="utf-8"))
    out = {n: spark.read.parquet(str(Path(target) / n)) for n in manifest["tables"]}
    for n, m in manifest["tables"].items():
        if verify and _print(out[n]) != (m["rows"], m["hash_xor"], m["hash_sum"]):
            raise ValueError(f"{n}: content differs from its manifest")
    return out


def atomic_json(path: str | Path, value) -> None:
    """Write value as JSON so that a reader finds either the file as it was or the whole new one."""
    target = os.path.abspath(path)
    os.makedirs(os.path.dirname(target), exist_ok=True)
    with tempfile.NamedTemporaryFile("w", encoding="utf-8", dir=os.path.dirname(target), suffix=".json", delete=False) as f:
        try:
            json.dump(value, f, ensure_ascii=False, indent=2)
            f.flush()
            os.fsync(f.fileno())
        except BaseException:
            os.unlink(f.name)
            raise
    os.replace(f.name, target)


def write_table(df: DataFrame, path: str | Path, order: Sequence[str]) -> None:
    """A small table as one CSV file, sorted, null as empty; rows stream through the driver one partition at a time."""
    path = Path(path)
    pending = path.with_name(path.name + ".pending")
    with pending.open("w", encoding="utf-8", newline="") as f:
        out = csv.writer(f)
        out.writerow(df.columns)
        for r in df.orderBy(*order).toLocalIterator():
            out.writerow(["" if v is None else v for v in r])
    os.replace(pending, path)


def read_table(spark: SparkSession, path: str | Path) -> DataFrame:
    """A CSV file as text columns; a byte order mark is no part of the first name; empty fields are null."""
    with Path(path).open(encoding="utf-8-sig", newline="") as f:
        header = next(csv.reader(f))
    schema = ", ".join(f"`{c}` string" for c in header)
    return spark.read.csv(str(path), schema=schema, header=True, enforceSchema=True, multiLine=True, escape='"')


def report_rows(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """section, sample, metric, value, status, note as text."""
    return spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows], "section string, sample string, metric string, value string, status string, note string")


def validate_manifest(rows: DataFrame, root: str | Path | None = None) -> list[str]:
    """What is wrong with a manifest: missing fields, repeated samples, unreadable kinds, shared inputs without a map, unsafe paths.

    All rows are checked. Every unsafe path is named; of repeated samples, kinds and shared inputs EXAMPLES are, with the number of
    all where there are more.
    """
    problems = [f"missing field: {c}" for c in MANIFEST if c not in rows.columns]
    if problems:
        return problems
    blank = lambda c: F.col(c).isNull() | (F.trim(c) == "")
    needed = ("database", "sample", "group", "local_path", "file_type")
    seen = rows.agg(*[F.count(F.when(blank(c), 1)).alias(c) for c in needed]).first()
    problems += [f"blank {c} in {seen[c]} rows" for c in needed if seen[c]]

    def report(found: DataFrame, what: str, column: str) -> None:
        """The problem for the first EXAMPLES of the values found, and how many there are if they are more."""
        some = [r[0] for r in found.select(column).orderBy(column).limit(EXAMPLES + 1).collect()]
        problems.extend(f"{what}: {v}" for v in some[:EXAMPLES])
        if len(some) > EXAMPLES:
            problems.append(f"{what}: {found.count()} in all")

    report(rows.groupBy("sample").count().filter("count > 1"), "Duplicate sample", "sample")
    report(rows.filter(~F.col("file_type").isin(*READABLE)).select("file_type").distinct(), "Unsupported file_type", "file_type")
    mapped = F.col("cell_map_path").isNotNull() & (F.trim("cell_map_path") != "") if "cell_map_path" in rows.columns else F.lit(False)
    shared = rows.groupBy("local_path").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(mapped, 1)).alias("m")).filter("n > 1 AND m < n")
    report(shared, "Shared input without a cell map", "local_path")
    for r in rows.select("local_path").distinct().orderBy("local_path").toLocalIterator() if root else ():
        try:
            safe_path(root, r["local_path"] or "")
        except ValueError as e:
            problems.append(str(e))
    return problems


def read_signature(rows: DataFrame, fields: Sequence[str] = ("file_type", "count_source", "delimiter", "orientation", "feature_column", "drop_columns")) -> DataFrame:
    """Inputs (local_path) that samples want to read in different ways: local_path, n_ways. Empty when all agree."""
    have = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields if f in rows.columns]
    return rows.groupBy("local_path").agg(F.countDistinct(F.sha2(F.concat_ws("\x1f", *have), 256)).alias("n_ways")).filter("n_ways > 1")


def sha256(path: str | Path) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()
