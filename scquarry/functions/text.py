"""Column functions for labels and texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that trimming removes; Spark's own trim() removes blanks only.
WHITE_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0    　"


def strip(c: Column) -> Column:
    """c without white space at its ends."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def blank_to_null(c: Column) -> Column:
    """c stripped; blank becomes null."""
    s = strip(c)
    return F.when(s != "", s)


def label(c: Column) -> Column:
    """A label in the spelling in which equal labels are equal: stripped and in upper case; null stays null."""
    return F.upper(strip(c))


def each_of(values: list, kind: str) -> Column:
    """One row per value of a short list (names, markers, resolutions), for use in a select; an empty list gives no row."""
    return F.explode(F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>"))


def text_number(c: Column) -> Column:
    """The number that a text reads as (commas separate thousands), or null."""
    s = strip(c)
    plain = F.regexp_replace(s, ",", "")
    shape = r"^[+-]?((\d{1,3}(,\d{3})+|\d+)(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
    return F.when(s.rlike(shape), plain.try_cast("double"))
