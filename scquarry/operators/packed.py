"""Several values packed in one field: choose each field's dialect by minimum description length."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scquarry.session import materialize

#: Characters that can separate values. Blanks never do.
DELIMITERS = ";,|/&\t\n\r"
BRACKETS = {"[": "]", "{": "}", "(": ")"}
QUOTES = "\"'"
#: Bits of a character of a value that no field gives; odds, before anything is counted, that a delimiter in a plain value belongs to
#: it, and that a quotation is none; rounds of counting and parsing.
CHAR_BITS, PRIOR, ROUNDS = 6.0, 2.0**-6, 3

#: A quotation mark where a quotation may open.
_BARE_QUOTE = re.compile(r"(?:^|[;,|/&\t\n\r])\s*[\"']")


def unwrap(field: str) -> str:
    """field without white space around it and without brackets around the whole of it."""
    s = field.strip()
    while len(s) > 1 and s[0] in BRACKETS and s[-1] == BRACKETS[s[0]] and _closes_last(s):
        s = s[1:-1].strip()
    return s


def _closes_last(s: str) -> bool:
    depth, close = 0, BRACKETS[s[0]]
    for i, c in enumerate(s):
        depth += (c == s[0]) - (c == close)
        if not depth:
            return i == len(s) - 1
    return False


def _quotation(s: str, at: int) -> tuple[str, int] | None:
    """The content of the quotation that opens at s[at] and the place after it, or None if it never closes."""
    mark, i, out = s[at], at + 1, []
    while (j := s.find(mark, i)) >= 0:
        out.append(s[i:j])
        if s[j + 1 : j + 2] != mark:
            return "".join(out), j + 1
        out.append(mark)
        i = j + 2
    return None


def parse(field: str, delimiters: str = DELIMITERS, quotes: str = QUOTES) -> list[tuple[str, bool]]:
    """The values of an unwrapped field in one dialect, each with whether it was quoted; blank pieces are left out.

    A quotation opens only at the start of a value. One that never closes is plain text. Text between a closing quotation mark
    and the next delimiter makes the whole piece a plain value, marks included.
    """
    out, i, n = [], 0, len(field)
    while i <= n:
        while i < n and field[i].isspace() and field[i] not in delimiters:
            i += 1
        value, quoted, start = "", False, i
        if i < n and field[i] in quotes and (q := _quotation(field, i)):
            value, i, quoted = q[0], q[1], True
        j = i
        while j < n and field[j] not in delimiters:
            j += 1
        rest = field[i:j].strip()
        value, quoted = (field[start:j] if quoted and rest else value + rest).strip(), quoted and not rest
        if value:
            out.append((value, quoted))
        i = j + 1
    return out


def dialects(field: str) -> list[tuple[str, str]]:
    """The dialects that can tell something about a field: every set of the delimiters in it, with quotes read or not.

    The first one has all delimiters and quotes.
    """
    present = sorted({c for c in field if c in DELIMITERS})
    marks = "".join(q for q in QUOTES if q in field)
    sets = ["".join(c) for k in range(len(present), -1, -1) for c in combinations(present, k)]
    return [(d, q) for q in dict.fromkeys((marks, "")) for d in sets]


@dataclass(frozen=True)
class Code:
    """Lengths of a kind's code, from counts over all distinct fields of the kind."""

    values: int  # values in all
    separators: int  # delimiters that separate them
    inside: int  # delimiters inside plain values
    quoted: int  # quotations
    bare: int  # quotation marks at the start of plain values

    def value(self, text: str, count: int) -> float:
        """By the value's share, or spelt out after the mark of a value that is new."""
        return math.log2(max(1, self.values) / count) if count else math.log2(self.values + 1) + 1 + CHAR_BITS * len(text)

    @property
    def delimiter_inside(self) -> float:
        return math.log2((self.separators + self.inside + 1) / (self.inside + PRIOR))

    @property
    def bare_quote(self) -> float:
        return math.log2((self.quoted + self.bare + 1) / (self.bare + PRIOR))


def _odd(values: list[tuple[str, bool]]) -> tuple[int, int]:
    """Delimiters inside and quotation marks before plain values."""
    plain = [v for v, quoted in values if not quoted]
    return sum(c in DELIMITERS for v in plain for c in v), sum(len(_BARE_QUOTE.findall(v)) for v in plain)


def cost(values: list[tuple[str, bool]], code: Code, counts: dict[str, int]) -> float:
    """Bits that describe the values of a field in some dialect."""
    inside, bare = _odd(values)
    return inside * code.delimiter_inside + bare * code.bare_quote + sum(code.value(v, counts.get(v, 0)) for v, _ in values)


def cheapest(field: str, code: Code, counts: dict[str, int]) -> tuple[str, str]:
    """The cheapest dialect of an unwrapped field; of equally cheap ones that with the most delimiters and quotes."""
    best, least = ("", ""), math.inf
    for d, q in dialects(field):
        # the delimiters left inside are what a dialect costs at least
        if q and not _BARE_QUOTE.search(field) and sum(field.count(c) for c in DELIMITERS if c not in d) * code.delimiter_inside >= least:
            continue
        if (bits := cost(parse(field, d, q), code, counts)) < least:
            best, least = (d, q), bits
    return best


def _batch(names: list[str], kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The values of distinct fields (context, field, fid), split at every delimiter with quotes read."""
    for b in batches:
        rows = []
        for context, field, fid in zip(*(b.column(i).to_pylist() for i in range(3))):
            values = parse(unwrap(field))
            rows += [(context, fid, v, quoted, *(_odd(values) if not i else (0, 0))) for i, (v, quoted) in enumerate(values)]
        yield _batch(["context", "fid", "value", "quoted", "inside", "bare"], [pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64()], rows)


def _other_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The plain values with delimiters inside that the other dialects of fields give."""
    for b in batches:
        rows = []
        for context, field, fid in zip(*(b.column(i).to_pylist() for i in range(3))):
            s = unwrap(field)
            seen = {v for d, q in dialects(s)[1:] for v, quoted in parse(s, d, q) if not quoted and any(c in DELIMITERS for c in v)}
            rows += [(context, fid, v) for v in seen]
        yield _batch(["context", "fid", "value"], [pa.string(), pa.int64(), pa.string()], rows)


def odd_dialects(fields: DataFrame) -> DataFrame:
    """The distinct fields (context, field) whose cheapest dialect isn't to split at every delimiter: context, field, delimiters, quotes.

    A value's code has the logarithm of its share of all values of the kind; a new value is spelt out; a delimiter inside a plain
    value costs the logarithm of how seldom that is. All counts are over all distinct fields: nothing is left out for being rare
    or long. Leaving a delimiter inside can pay only where the value so kept is known as a whole, and that only quotations
    tell: pieces that are new cost less than a spelt-out value of the same characters with a delimiter inside. Fields in which some
    dialect gives such a value, or in which a quotation runs into plain text, are ambiguous. They don't count at first; the
    others teach the code, the ambiguous ones are parsed by it, counted, and parsed again.
    """
    spark = fields.sparkSession
    given = materialize(fields.distinct().withColumn("fid", F.xxhash64("context", "field")), "fields")
    pieces = materialize(given.mapInArrow(_pieces, "context string, fid bigint, value string, quoted boolean, inside bigint, bare bigint"), "pieces")
    known = pieces.filter(F.col("quoted") & F.col("value").rlike(f"[{re.escape(DELIMITERS)}]")).select("context", "value").distinct()
    other = given.filter(F.col("field").rlike(f"[{re.escape(DELIMITERS)}]")).mapInArrow(_other_values, "context string, fid bigint, value string")
    asked = other.join(known, ["context", "value"], "left_semi").select("fid").union(pieces.filter("inside > 0").select("fid")).distinct()
    asked = materialize(asked, "ambiguous")
    schema = "context string, field string, delimiters string, quotes string"
    if asked.isEmpty():
        return spark.createDataFrame([], schema)
    sure = pieces.join(asked, "fid", "left_anti")
    unsure = given.join(asked, "fid", "left_semi")
    wanted = unsure.mapInArrow(_all_values, "context string, fid bigint, value string")
    columns = ["context", "value", "quoted", "inside", "bare"]
    counted, chosen = sure.select(*columns), None
    for _ in range(ROUNDS):
        counts = counted.groupBy("context", "value").agg(F.count(F.lit(1)).alias("n"))
        totals = counted.groupBy("context").agg(F.count(F.lit(1)).alias("values"), F.sum("inside").alias("inside"), F.count_if("quoted").alias("quoted"), F.sum("bare").alias("bare"))
        totals = totals.join(given.groupBy("context").agg(F.count(F.lit(1)).alias("fields")), "context")  # one row per kind of fields
        by_field = wanted.join(counts, ["context", "value"]).groupBy("fid").agg(F.map_from_entries(F.collect_list(F.struct("value", "n"))).alias("counts"))
        rows = unsure.join(by_field, "fid", "left").join(totals, "context", "left")
        chosen = materialize(rows.select("context", "field", "fid", "counts", *_TOTALS).mapInArrow(_choose, schema), "dialects")
        more = chosen.mapInArrow(_chosen_pieces, "context string, value string, quoted boolean, inside bigint, bare bigint")
        counted = sure.select(*columns).union(more)
    return chosen.filter("delimiters IS NOT NULL")


_TOTALS = ("values", "inside", "quoted", "bare", "fields")


def _all_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for context, field, fid in zip(*(b.column(b.schema.names.index(c)).to_pylist() for c in ("context", "field", "fid"))):
            s = unwrap(field)
            rows += [(context, fid, v) for v in {v for d, q in dialects(s) for v, _ in parse(s, d, q)}]
        yield _batch(["context", "fid", "value"], [pa.string(), pa.int64(), pa.string()], rows)


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for r in b.to_pylist():
            values, inside, quoted, bare, fields = (r[c] or 0 for c in _TOTALS)
            s = unwrap(r["field"])
            first, best = dialects(s)[0], cheapest(s, Code(values, max(0, values - fields), inside, quoted, bare), dict(r["counts"] or ()))
            rows.append((r["context"], r["field"], *(best if best != first else (None, None))))
        yield _batch(["context", "field", "delimiters", "quotes"], [pa.string()] * 4, rows)


def _chosen_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for r in b.to_pylist():
            values = parse(unwrap(r["field"]), *((r["delimiters"], r["quotes"]) if r["delimiters"] is not None else ()))
            rows += [(r["context"], v, quoted, *(_odd(values) if not i else (0, 0))) for i, (v, quoted) in enumerate(values)]
        yield _batch(["context", "value", "quoted", "inside", "bare"], [pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64()], rows)


def split_packed(df: DataFrame, context: str, field: str) -> DataFrame:
    """df with one row per value of its packed field: the columns of df besides field, item_pos (from 1) and item.

    Each field is parsed in the dialect (a set of delimiters, quotes read or not) that describes it in the fewest bits. The code
    is learnt from all distinct fields of a kind, see odd_dialects(), which also gives the fields to be parsed otherwise than at
    every delimiter; all fields are parsed where they lie, and only where there are such fields they are joined to the rows.

    context names a column whose values keep apart kinds of fields. Rows whose field is null or blank, or has blank pieces only, give
    no row. Ties take the dialect with the most delimiters. Repeated rows each give their values; extra columns are carried along;
    an empty table gives an empty result.
    """
    if {"item_pos", "item", "_delimiters", "_quotes"} & set(df.columns) - {field}:
        raise ValueError("item_pos, item, _delimiters and _quotes are names of the result")
    used = df.filter(F.col(field).isNotNull() & F.col(field).rlike(r"\S"))
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    odd = odd_dialects(used.select(named(context).alias("context"), F.col(field).alias("field")))
    kept = [c for c in df.columns if c != field]
    if odd.isEmpty():
        used = used.select(*kept, field, F.lit(None).cast("string").alias("_delimiters"), F.lit(None).cast("string").alias("_quotes"))
    else:
        odd = odd.select(F.col("context").alias("_context"), F.col("field").alias("_field"), F.col("delimiters").alias("_delimiters"), F.col("quotes").alias("_quotes"))
        used = used.join(odd, (named(context) == F.col("_context")) & (F.col(field) == F.col("_field")), "left").select(*kept, field, "_delimiters", "_quotes")
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept) + (", " if kept else "") + "item_pos int, item string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[tuple, list[str]] = {}
        for b in batches:
            rows, pos, items = [], [], []
            names = b.schema.names
            for i, key in enumerate(zip(*(b.column(names.index(c)).to_pylist() for c in (field, "_delimiters", "_quotes")))):
                if (values := memo.get(key)) is None:
                    f, d, q = key
                    values = [v for v, _ in (parse(unwrap(f)) if d is None else parse(unwrap(f), d, q))]
                    if len(memo) < 50_000:
                        memo[key] = values
                rows += [i] * len(values)
                pos += range(1, len(values) + 1)
                items += values
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(names.index(k)).take(at) for k in kept] + [pa.array(pos, pa.int32()), pa.array(items, pa.string())], [*kept, "item_pos", "item"])

    return used.mapInArrow(run, schema)
