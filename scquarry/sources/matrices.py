"""Readers of count matrices: 10x trios and text matrices as rows of non-zero counts."""

from __future__ import annotations

import csv
import gzip
import io
import re
from collections.abc import Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scquarry.sources.routing import detect_trio

csv.field_size_limit(2**31 - 1)  # a wide header read with the wrong delimiter is one field
_DELIMITERS = {"comma": ",", "tab": "\t", "semicolon": ";", "space": " "}


def _open(path: str | Path) -> io.TextIOBase:
    return io.TextIOWrapper(gzip.open(path) if str(path).endswith(".gz") else open(path, "rb"), encoding="utf-8-sig")


def _numbered(spark: SparkSession, path: str | Path) -> DataFrame:
    """Lines with their number from 1. A gzip text is one split anyway; the names of genes and cells are the short side of a matrix."""
    rows = spark.read.text(str(path)).rdd.zipWithIndex().map(lambda x: (x[1] + 1, x[0][0]))
    return spark.createDataFrame(rows, "n bigint, line string")


def probe_trio(directory: str | Path, spark: SparkSession) -> dict:
    """Sizes of a trio: the header's must be those of the name files, else an error; how many genes have no name."""
    trio = detect_trio(directory)
    with _open(trio["matrix"]) as f:
        for line in f:
            if not line.startswith("%"):
                break
    rows, columns, entries = (int(x) for x in line.split())
    features, barcodes = _numbered(spark, trio["features"]), _numbered(spark, trio["barcodes"])
    name = F.trim(F.split("line", "\t").getItem(1))
    seen = features.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.coalesce(name, F.lit("")).isin("", "NA"), 1)).alias("m")).first()
    if seen["n"] != rows or barcodes.count() != columns:
        raise ValueError("matrix dimensions mismatch the names of genes and cells")
    return {"rows": rows, "columns": columns, "entries": entries, "missing_gene_names": seen["m"], "feature_name_fallback": "feature_id_for_missing_gene_name" if seen["m"] else ""}


def read_trio(spark: SparkSession, directory: str | Path, prefix: str = "") -> tuple[DataFrame, DataFrame, DataFrame]:
    """counts, genes and cells of a trio, plain or gzip in any mixture.

    A gene without a name (blank or NA) takes its id, one without either unannotated_feature_<line>. prefix goes before cell ids.
    """
    probe = probe_trio(directory, spark)
    trio = detect_trio(directory)
    part = F.split("line", "\t")
    known = lambda i: F.when(~F.coalesce(F.trim(part.getItem(i)), F.lit("")).isin("", "NA"), F.trim(part.getItem(i)))
    fallback = F.concat(F.lit("unannotated_feature_"), F.col("n").cast("string"))
    genes = _numbered(spark, trio["features"]).select(F.col("n").alias("gene_ord"), F.coalesce(known(0), fallback).alias("gene_id"), F.coalesce(known(1), known(0), fallback).alias("gene_name"))
    cells = _numbered(spark, trio["barcodes"]).select(F.col("n").alias("cell_ord"), F.concat(F.lit(prefix), F.trim("line")).alias("cell_id"))
    lines = spark.read.text(str(trio["matrix"])).filter("NOT startswith(value, '%')").select(F.split(F.trim("value"), r"\s+").alias("x"))
    triplets = lines.select(F.col("x")[0].cast("bigint").alias("gene_ord"), F.col("x")[1].cast("bigint").alias("cell_ord"), F.col("x")[2].cast("double").alias("value"))
    # The line with the sizes is the only one that may equal (rows, columns, entries), but for an entry in the last corner:
    # entries are unique, so that two equal lines are the sizes and that entry.
    header = (F.col("gene_ord") == probe["rows"]) & (F.col("cell_ord") == probe["columns"]) & (F.col("value") == float(probe["entries"]))
    corner = triplets.filter(header)
    data = triplets.filter(~header)
    if corner.count() > 1:
        data = data.union(corner.limit(1))
    counts = data.filter("value <> 0").join(genes.select("gene_ord", "gene_id"), "gene_ord").join(cells, "cell_ord").select("cell_id", "gene_id", "value")
    return counts, genes.select("gene_id", "gene_name", "gene_ord"), cells.select("cell_id")


def sniff_text(path: str | Path, sample_rows: int = 50) -> dict:
    """Delimiter, orientation, feature column and missing ID header of a text matrix, from its first rows.

    A delimiter is right when the header and the rows agree on the number of fields. Values must look like counts: fractions mean
    processed data, which are an error, as are negative numbers.
    """
    with _open(path) as f:
        head = f.readline().rstrip("\r\n")
        body = [x.rstrip("\r\n") for _, x in zip(range(sample_rows), f) if x.strip()]
    if not body:
        raise ValueError("no rows")
    best = None
    for name, d in _DELIMITERS.items():
        h, rows = next(csv.reader([head], delimiter=d)), list(csv.reader(body, delimiter=d))
        widths = {len(r) for r in rows}
        if len(widths) == 1 and (w := widths.pop()) > 1 and w - len(h) in (0, 1) and (best is None or w > best[3]):
            best = (name, h, rows, w)
    if best is None:
        raise ValueError("no delimiter fits header and rows")
    name, header, rows, width = best
    missing = width == len(header) + 1
    first = "" if missing else header[0]
    barcode = re.compile(r"[ACGT]{8,}(-[0-9A-Za-z]+)?$")
    names, ids = header if missing else header[1:], [r[0] for r in rows]
    by_cells = sum(bool(barcode.search(x)) for x in ids) > len(ids) / 2 and not any(barcode.search(x) for x in names[:50])
    values = [v for r in rows for v in r[1:] if v.strip()]
    numbers = [float(v) for v in values if re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", v.strip())]
    if any(v != int(v) for v in numbers):
        raise ValueError("Normalized/processed values instead of counts")
    if any(v < 0 for v in numbers):
        raise ValueError("negative values")
    return {
        "delimiter": name,
        "orientation": "cells_by_genes" if by_cells else "genes_by_cells",
        "feature_column": "__row_names__" if missing or not first.strip() else first,
        "text_header_missing_id": missing,
        "columns": len(names),
    }


def read_text(spark: SparkSession, path: str | Path, delimiter: str = "comma", orientation: str = "genes_by_cells", feature_column: str | None = None, drop_columns: Sequence[str] = (), missing_id: bool = False) -> DataFrame:
    """counts of a text matrix: rows become non-zero triplets one by one, never a dense matrix.

    feature_column names the column of row ids (default the first; __row_names__ too); drop_columns are left out. Values that
    are no finite numbers, negative ones and fractions (processed data) are an error, in whatever row they stand.
    """
    d = _DELIMITERS[delimiter]
    with _open(path) as f:
        header = next(csv.reader([f.readline().rstrip("\r\n")], delimiter=d))
    names = ["__row_names__", *header] if missing_id else header
    own = 0 if feature_column in (None, "__row_names__") else names.index(feature_column)
    use = [i for i, n in enumerate(names) if i != own and n not in drop_columns]
    first_line = d.join(header)
    cells_first = orientation == "cells_by_genes"

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, columns, values = [], [], []
            for line in b.column(0).to_pylist():
                if not line.strip():
                    continue
                r = next(csv.reader([line.lstrip("﻿")], delimiter=d))
                if d.join(r) == first_line:
                    continue
                if len(r) != len(names):
                    raise ValueError(f"a row has {len(r)} fields instead of {len(names)}")
                for i in use:
                    if (v := float(r[i])) != 0:
                        if not 0 < v < float("inf") or v != int(v):
                            raise ValueError(f"no count: {r[i]}")
                        rows.append(r[own])
                        columns.append(names[i])
                        values.append(v)
            cell, gene = (rows, columns) if cells_first else (columns, rows)
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.string()), pa.array(gene, pa.string()), pa.array(values, pa.float64())], ["cell_id", "gene_id", "value"])

    return spark.read.text(str(path)).mapInArrow(convert, "cell_id string, gene_id string, value double")


def read_binary(path: str | Path) -> None:
    """HDF5 (.h5, .h5ad) and R objects (.rds) can't be read: their libraries are no part of this engine. Always an error."""
    raise ImportError(f"{path}: reading this format needs h5py, anndata or R; convert it to a 10x trio, text or Parquet first")


def combine(parts: Sequence[DataFrame], gene_sets: Sequence[DataFrame] | None = None) -> DataFrame:
    """Matrices of samples put side by side; a cell in two of them is an error, as are differing sets of genes.

    A matrix here holds its non-zero counts, so a gene without any count in a sample would look absent: with gene tables that keep
    such genes pass gene_sets, one per matrix.
    """
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    sets = gene_sets or parts
    genes = sets[0].select("gene_id").distinct()
    for p in sets[1:]:
        genes = genes.union(p.select("gene_id").distinct())
    if not genes.groupBy("gene_id").count().filter(F.col("count") < len(parts)).isEmpty():
        raise ValueError("the matrices differ in their genes; reconcile them first")
    seen = None
    for i, p in enumerate(parts):
        c = p.select("cell_id").distinct().withColumn("_p", F.lit(i))
        seen = c if seen is None else seen.union(c)
    if not seen.groupBy("cell_id").count().filter("count > 1").isEmpty():
        raise ValueError("a cell occurs in two matrices")
    return out


def empty_droplets(parts: dict[str, DataFrame], genes: DataFrame) -> DataFrame:
    """Background matrices per library, on the genes of the object: library_id, cell_id as <library>::background::<cell>, gene_id, value."""
    out = None
    for library, p in parts.items():
        if not genes.select("gene_id").join(p.select("gene_id").distinct(), "gene_id", "left_anti").isEmpty():
            raise ValueError(f"{library}: the background lacks genes")
        if not p.filter("value < 0 OR value <> floor(value)").isEmpty():
            raise ValueError(f"{library}: the background holds no counts")
        x = p.join(genes.select("gene_id"), "gene_id", "left_semi").select(F.lit(library).alias("library_id"), F.concat(F.lit(f"{library}::background::"), F.col("cell_id").cast("string")).alias("cell_id"), "gene_id", "value")
        out = x if out is None else out.union(x)
    return out
