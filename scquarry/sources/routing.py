"""What an input file is, which of several to read, and how: decisions on names and sizes, without reading data."""

from __future__ import annotations

import json
import os
import re
import tarfile
import zipfile
from collections.abc import Callable, Sequence
from pathlib import Path

#: A text matrix is read as a stream when it would take this share of memory as a dense one.
DENSE_SHARE = 0.25


def file_type(name: str) -> str:
    """The kind of an input by its name: raw_reads is never read, unknown neither."""
    n = Path(name).name.lower()
    stem = n[:-3] if n.endswith(".gz") else n
    if stem.endswith((".fastq", ".fq", ".sra")):
        return "raw_reads"
    if stem.endswith(".h5ad"):
        return "h5ad"
    if stem.endswith(".rds"):
        return "rds"
    if stem.endswith(".h5"):
        return "10x_h5_candidate"
    if stem.endswith(".mtx") or re.search(r"(^|[_.-])(features|genes|barcodes)\.tsv$", stem):
        return "10x_mtx"
    if n.endswith((".tar", ".tar.gz", ".tgz", ".zip")):
        return "archive"
    if stem.endswith((".csv", ".tsv", ".txt")):
        return "text"
    return "unknown"


def detect_trio(directory: str | Path) -> dict[str, Path]:
    """matrix, features and barcodes of a directory, plain or gzip; each exactly once."""
    patterns = {"matrix": r"(^|.*[_.-])matrix\.mtx(\.gz)?$", "features": r"(^|.*[_.-])(features|genes)\.tsv(\.gz)?$", "barcodes": r"(^|.*[_.-])barcodes\.tsv(\.gz)?$"}
    out = {}
    for part, pattern in patterns.items():
        found = sorted(p for p in Path(directory).iterdir() if re.match(pattern, p.name.lower()))
        if len(found) != 1:
            raise ValueError(f"{part}: {len(found)} files instead of one")
        out[part] = found[0]
    return out


def choose_filtered(names: Sequence[str]) -> str:
    """The filtered matrix of several, else the only one; two filtered ones are ambiguous."""
    filtered = [n for n in names if "filtered" in n.lower()]
    chosen = filtered or [n for n in names if "raw" not in n.lower()] or list(names)
    if len(chosen) != 1:
        raise ValueError("ambiguous matrices: " + ", ".join(chosen))
    return chosen[0]


def physical_memory() -> int:
    return os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")


def dense_memory_safe(n_bytes: int, memory: int | None = None) -> bool:
    return n_bytes < DENSE_SHARE * (memory or physical_memory())


def select_text_reader(rows: int, columns: int, memory: int | None = None) -> tuple[str, int, str]:
    """dense or streaming, the bytes of a dense matrix, and the reason; how well the file compresses doesn't matter."""
    dense = rows * columns * 8
    memory = memory or physical_memory()
    if dense >= DENSE_SHARE * memory:
        return "streaming", dense, f"dense size of {dense} bytes is 25% of physical RAM or more"
    return "dense", dense, f"dense size of {dense} bytes is below 25% of physical RAM"


def rank_candidates(candidates: Sequence[dict]) -> list[dict]:
    """Raw-count candidates by preference: sparse objects, then dense ones, then text. Their equality must be evidenced."""
    raw = [c for c in candidates if "normalized" not in c["url"].lower() and "tpm" not in c["url"].lower()]
    if len(raw) > 1 and (len({c.get("raw_counts_id") for c in raw}) != 1 or any(not c.get("raw_counts_id") or not c.get("same_counts_evidence") for c in raw)):
        raise ValueError("raw_counts_id and same_counts_evidence must agree before one candidate may stand for another")
    place = {"10x_mtx": 0, "10x_h5_candidate": 1, "h5ad": 2, "rds": 3, "text": 4}
    return sorted(raw, key=lambda c: place.get(file_type(c["url"]), 9))


def select_candidate(candidates: Sequence[dict], inspect: Callable[[dict], dict], memory: int | None = None, audit_path: str | Path | None = None) -> tuple[dict, list[dict]]:
    """The first candidate that is verified raw counts and fits: sparse, dense within memory, or verified text; and all attempts."""
    ranked = rank_candidates(candidates)
    attempts = [{"url": c["url"], "status": "excluded", "reason": "not raw counts"} for c in candidates if c not in ranked]
    chosen = None
    for c in ranked:
        seen = c.get("validated_evidence") or (dict(raw_counts=c.get("verified_raw_counts"), sparse=True) if file_type(c["url"]) == "text" and c.get("verified_raw_counts") else inspect(c))
        if not seen.get("raw_counts"):
            attempts.append({"url": c["url"], "status": "rejected", "reason": "not verified as raw counts"})
        elif not seen.get("sparse") and not dense_memory_safe(int(seen.get("estimated_memory_bytes", 0)), memory):
            attempts.append({"url": c["url"], "status": "rejected", "reason": "dense matrix over the 25% RAM limit"})
        else:
            attempts.append({"url": c["url"], "status": "selected", "reason": ""})
            chosen = c
            break
    if audit_path:
        Path(audit_path).write_text(json.dumps({"candidates": attempts, "selected": chosen and chosen["url"]}, indent=2), encoding="utf-8")
    if chosen is None:
        raise ValueError("no candidate can be read")
    return chosen, attempts


def safe_path(root: str | Path, relative: str) -> Path:
    """A path below root; absolute ones, drives, backslashes and ways out are errors."""
    if not relative or "\\" in relative or ":" in relative or relative.startswith("/") or ".." in Path(relative).parts:
        raise ValueError(f"unsafe path: {relative}")
    target = (Path(root) / relative).resolve()
    if not target.is_relative_to(Path(root).resolve()):
        raise ValueError(f"path leaves its root: {relative}")
    return target


def extract_member(archive: str | Path, member: str, target: str | Path) -> Path:
    """One exact member of a tar or zip archive."""
    safe_path(Path(target).parent, member)
    if zipfile.is_zipfile(archive):
        with zipfile.ZipFile(archive) as z, z.open(member) as source:
            data = source.read()
    else:
        with tarfile.open(archive) as t:
            source = t.extractfile(member)
            if source is None:
                raise ValueError(f"no file: {member}")
            data = source.read()
    Path(target).write_bytes(data)
    return Path(target)


def assemble_parts(parts: Sequence[str | Path], target: str | Path, hashes: Sequence[str] | None = None) -> Path:
    """Ordered parts of a file put together, each checked against its SHA-256; an equal target is used again."""
    import hashlib

    blocks = [Path(p).read_bytes() for p in parts]
    for b, h, p in zip(blocks, hashes or [None] * len(blocks), parts):
        if h and hashlib.sha256(b).hexdigest() != h:
            raise ValueError(f"part changed: {p}")
    whole = b"".join(blocks)
    target = Path(target)
    if not (target.is_file() and target.read_bytes() == whole):
        pending = target.with_name(target.name + ".part")
        pending.write_bytes(whole)
        os.replace(pending, target)
    return target


def parse_soft(text: str) -> list[dict]:
    """Blocks of a SOFT text: entity, id and fields, each with all of its values."""
    out: list[dict] = []
    for line in text.splitlines():
        key, _, value = line.partition("=")
        if line.startswith("^"):
            out.append({"entity": key[1:].strip(), "id": value.strip(), "fields": {}})
        elif line.startswith("!") and out:
            out[-1]["fields"].setdefault(key[1:].strip(), []).append(value.strip())
    return out


def is_single_cell(fields: dict[str, Sequence[str]]) -> bool:
    """Whether a series' description is of single cells; arrays and bulk sequencing are not."""
    text = " ".join(v for values in fields.values() for v in values).lower()
    return bool(re.search(r"single[- ]?(cell|nucle)|sc-?rna|sn-?rna|10x genomics|droplet", text)) and not re.search(r"\bmicroarray\b|\bexpression array\b|\bbulk rna", text)


def propose_input(sample: str, urls: Sequence[str]) -> dict:
    """The input plan of a sample from its files."""
    own = [u for u in urls if Path(u).name.startswith(sample)] or list(urls)
    kinds = {file_type(u) for u in own}
    if kinds == {"10x_mtx"} and len(own) == 3:
        return {"file_type": "10x_mtx", "files_json": json.dumps([{"url": u} for u in own])}
    usable = [u for u in own if file_type(u) in ("text", "h5ad", "rds", "10x_h5_candidate")]
    if len(usable) != 1:
        raise ValueError("no single input for " + sample)
    return {"file_type": file_type(usable[0]), "files_json": json.dumps([{"url": usable[0]}])}


def enforce_single_cell(fields: dict[str, Sequence[str]]) -> None:
    """Stop before anything is built where a series isn't of single cells."""
    if not is_single_cell(fields):
        raise ValueError("the series is not of single cells: nothing is built")


def required_routes(rows: Sequence[dict], native: bool = True) -> list[str]:
    """What must be there to read the inputs of a manifest: nothing for trios, text and Parquet, else the route of their kind; with native
    readers of this engine only."""
    kinds = {r["file_type"] for r in rows}
    routes = {"10x_h5": "hdf5", "h5ad": "hdf5", "rds": "r_objects"}
    unknown = kinds - {"10x_mtx", "text", *routes}
    if unknown:
        raise ValueError("unknown kinds: " + ", ".join(sorted(unknown)))
    needed = sorted({routes[k] for k in kinds if k in routes})
    return needed if native else ["external"] if kinds else []


def safe_name(name: str) -> str:
    """A dataset's name that is safe as a folder's: letters, digits, dots, hyphens and underscores, a letter or digit first."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", name or "") or ".." in name:
        raise ValueError(f"unsafe name: {name}")
    return name
