"""Parsers for delimited text lines, as column expressions.

Two flavours:
* strict — every line must have the expected shape; a bad line fails the job with a
  message naming it (ANSI casts also raise on bad numbers);
* lenient — a bad line produces no row (guard + ``try_cast`` + filter).

Java-style integer parsing is kept: an optional sign and digits only, no surrounding
blanks (``try_cast`` alone would accept ``' 12 '``), in the int range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INT_TEXT = r"^[+-]?[0-9]+$"
# Java String.trim: strip every char <= U+0020 from both ends
_EDGE_CONTROL = r"^[\x00-\x20]+|[\x00-\x20]+$"


def java_trim(c: Column) -> Column:
    return F.regexp_replace(c, _EDGE_CONTROL, "")


def strict_int(c: Column, what: Column | str = "value") -> Column:
    """Parse an int or fail the job naming the offending line."""
    what_col = F.col(what) if isinstance(what, str) else what
    parsed = F.when(c.rlike(INT_TEXT), c.try_cast("int"))
    return F.when(parsed.isNotNull(), parsed).otherwise(
        F.raise_error(F.concat(F.lit("not an int in line: "), what_col)).cast("int"))


def lenient_int(c: Column) -> Column:
    """Parse an int, or null when the text is not a plain in-range int."""
    return F.when(c.rlike(INT_TEXT), c.try_cast("int"))


def _jvm_split(value: Column, sep: str) -> Column:
    """Split like Java's String.split(char): trailing empty fields are dropped."""
    parts = F.split(value, _regex_quote(sep))
    # drop trailing empties: cut the array after its last non-empty element
    last = F.aggregate(
        F.transform(parts, lambda x, i: F.when(F.length(x) > 0, i + 1).otherwise(F.lit(0))),
        F.lit(0), lambda acc, x: F.greatest(acc, x))
    return F.slice(parts, 1, last)


def _regex_quote(sep: str) -> str:
    return "\\" + sep if sep in ".[]{}()\\*+?^$|" else sep


def parse_fields_strict(lines: DataFrame, names: Sequence[str], sep: str = " ",
                        exact: bool = True, col: str = "value") -> DataFrame:
    """Split each line and parse the first ``len(names)`` fields as ints.

    ``exact``: the line must have exactly that many fields (the 3-field play-count
    format); otherwise at least that many, the rest ignored. A bad line fails the job."""
    v = F.col(col)
    parts = _jvm_split(v, sep)
    n = len(names)
    size_ok = (F.size(parts) == n) if exact else (F.size(parts) >= n)
    checked = F.when(size_ok, parts).otherwise(
        F.raise_error(F.concat(F.lit("wrong field count in line: "), v)).cast("array<string>"))
    tmp = lines.select(v.alias("__line"), checked.alias("__parts"))
    return tmp.select(*[strict_int(F.get(F.col("__parts"), i), "__line").alias(nm)
                        for i, nm in enumerate(names)])


def parse_id_name_strict(lines: DataFrame, col: str = "value") -> DataFrame:
    """``id<TAB>name`` lines → (id int, name string), failing the job on the first
    line whose id is not an int (a line without a tab has its whole text as the id)."""
    v = F.col(col)
    pos = F.instr(v, "\t")
    id_txt = F.when(pos > 0, F.expr(f"substring(`{col}`, 1, instr(`{col}`, '\t') - 1)")
                    ).otherwise(v)
    name = F.when(pos > 0, java_trim(F.expr(f"substring(`{col}`, instr(`{col}`, '\t') + 1)"))
                  ).otherwise(F.lit(""))
    return lines.select(strict_int(id_txt, col).alias("id"), name.alias("name"))


def parse_id_name_lenient(lines: DataFrame, col: str = "value") -> DataFrame:
    """``id<TAB>name`` lines → (id int, name string); lines without a tab or with a
    bad id give no row. The name is the rest of the line after the first tab (later
    tabs kept), with blanks and control characters trimmed from both ends."""
    v = F.col(col)
    pos = F.instr(v, "\t")
    id_txt = F.when(pos > 0, F.expr(f"substring(`{col}`, 1, instr(`{col}`, '\t') - 1)"))
    name = F.when(pos > 0, java_trim(F.expr(f"substring(`{col}`, instr(`{col}`, '\t') + 1)")))
    return (lines.select(lenient_int(id_txt).alias("id"), name.alias("name"))
            .where(F.col("id").isNotNull() & F.col("name").isNotNull()))


def parse_pairs_lenient(lines: DataFrame, names: Sequence[str] = ("artist", "alias"),
                        sep: str = "\t", col: str = "value") -> DataFrame:
    """Two-int lines; lines whose first field is empty (or which are malformed) give
    no row."""
    parts = _jvm_split(F.col(col), sep)
    a, b = F.get(parts, 0), F.get(parts, 1)
    out = lines.select(
        F.when((F.size(parts) == 2) & (F.length(a) > 0), lenient_int(a)).alias(names[0]),
        F.when((F.size(parts) == 2) & (F.length(a) > 0), lenient_int(b)).alias(names[1]))
    return out.where(F.col(names[0]).isNotNull() & F.col(names[1]).isNotNull())
