"""Composed Column expressions. All JVM-side built-ins; no Python UDFs."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The six comparison operators a delta extract accepts.
COMPARISON_OPERATORS = (">", ">=", "<", "<=", "=", "<>")


def quote_ident(name: str) -> str:
    """A column name as a SQL identifier (backticks, inner backticks doubled)."""
    return "`" + name.replace("`", "``") + "`"


def quote_literal(text: str) -> str:
    """A Python string as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_count(c) -> Column:
    """Number of nulls in a column (partial-aggregatable sum)."""
    return F.sum(_c(c).isNull().cast("long"))


def percent(num, den) -> Column:
    """``100.0 * num / den`` in double, multiply first; null when den is 0."""
    return F.try_divide(F.lit(100.0) * _c(num).cast("double"), _c(den).cast("double"))


def typed_literal(value, kind: str = "DATE", fmt: str = "yyyyMMdd") -> Column:
    """Turn a metadata-given text value into a typed literal (delta column type)."""
    kind = (kind or "").upper()
    if isinstance(value, _dt.datetime):
        return ts_literal(value)
    if isinstance(value, _dt.date):
        return F.lit(value)
    if kind in ("DATE",):
        return F.to_date(F.lit(str(value)), fmt)
    if kind in ("TIMESTAMP", "DATETIME"):
        return F.to_timestamp_ntz(F.lit(str(value)), F.lit(fmt))
    if kind in ("NUMBER", "INT", "INTEGER", "BIGINT", "DECIMAL", "NUMERIC"):
        return F.lit(value).cast("decimal(38,10)") if "." in str(value) else F.lit(int(value))
    return F.lit(value)


def ts_literal(value, kind: str = "timestamp_ntz") -> Column:
    """A timestamp literal built from its wall-clock text, so no time zone of
    the Python process enters: ``timestamp_ntz`` stays as written and
    ``timestamp`` is read in the session time zone."""
    if not isinstance(value, _dt.datetime):
        value = _dt.datetime.combine(value, _dt.time())
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(kind)


def compare(c, op: str, value, upper=None) -> Column:
    """Comparison predicate builder; ``between`` is inclusive on both ends.

    Any operator outside the six comparisons and ``between`` is refused.
    """
    col = _c(c)
    v = value if isinstance(value, Column) else F.lit(value)
    op = op.strip().lower()
    if op == "between":
        if upper is None:
            raise ValueError("between needs an upper bound")
        u = upper if isinstance(upper, Column) else F.lit(upper)
        return (col >= v) & (col <= u)
    if op == ">":
        return col > v
    if op == ">=":
        return col >= v
    if op == "<":
        return col < v
    if op == "<=":
        return col <= v
    if op == "=":
        return col == v
    if op == "<>":
        return col != v
    raise ValueError(f"operator {op!r} is not one of {COMPARISON_OPERATORS + ('between',)}")


def not_blank(c) -> Column:
    """Not null and not the empty string."""
    return _c(c).isNotNull() & (_c(c) != F.lit(""))


def isin_ci(c, values) -> Column:
    """Case-insensitive membership."""
    return F.upper(_c(c)).isin([str(v).upper() for v in values])


def size_pretty_sql(x: str) -> str:
    """SQL text of ``size_pretty`` over the expression ``x``."""
    b = f"CAST({x} AS BIGINT)"
    parts = [f"WHEN abs({b}) < 10240 THEN concat(CAST({b} AS STRING), ' bytes')"]
    for unit, shift in (("kB", 9), ("MB", 19), ("GB", 29)):
        parts.append(f"WHEN abs(shiftright({b}, {shift})) < 20479 "
                     f"THEN concat(CAST(shiftright(shiftright({b}, {shift}) + 1, 1) AS STRING), ' {unit}')")
    return ("CASE " + " ".join(parts)
            + f" ELSE concat(CAST(shiftright(shiftright({b}, 39) + 1, 1) AS STRING), ' TB') END")


def size_pretty(c) -> Column:
    """Human-readable byte count with half-up rounding per unit.

    Below 10240 bytes the number is printed as is; each larger unit is used while
    the rounded value stays below 10240 (computed with shifts keeping one extra
    bit for the rounding, so no floating point is involved).
    """
    if isinstance(c, str):
        return F.expr(size_pretty_sql(f"`{c}`"))
    b = c.cast("long")
    units = (("kB", 9), ("MB", 19), ("GB", 29), ("TB", 39))
    out = F.when(F.abs(b) < 10240, F.concat(b.cast("string"), F.lit(" bytes")))
    for i, (unit, shift) in enumerate(units):
        half = F.shiftright(b, shift)
        text = F.concat(F.shiftright(half + 1, 1).cast("string"), F.lit(" " + unit))
        out = out.when(F.abs(half) < 20479, text) if i < len(units) - 1 else out.otherwise(text)
    return out


def seam_repair(c) -> Column:
    """Join the physical lines of a quoted field.

    A line ends at ``\n``, ``\r\n`` or a lone ``\r`` (as a line reader sees
    it). A run of line breaks becomes one space when neither neighbour is a
    space (or a line break); every other line break is dropped. The start and
    the end of the field count as non-space neighbours, as the quote character
    sits there.
    """
    lines = F.regexp_replace(_c(c), r"\r\n?", "\n")
    once = F.regexp_replace(lines, r"(?<![ \n])\n+(?![ \n])", " ")
    return F.regexp_replace(once, r"\n", "")


def delimiter_repair(c) -> Column:
    """Drop ``"`` and CR, then byte FE -> U+0001 and byte DF -> ``"``.

    The line is re-read as ISO-8859-1 so that single foreign bytes survive.
    """
    latin = F.decode(_c(c).cast("binary"), "ISO-8859-1")
    return F.translate(latin, "þß\"\r", "\u0001\"")


def job_number(c) -> Column:
    """Last three characters of the part before the first '-', as int."""
    return F.right(F.split_part(_c(c), F.lit("-"), F.lit(1)), F.lit(3)).try_cast("int")


def naming_flags(jobname, incond, outcond) -> tuple[Column, Column]:
    """(in-condition bad, out-condition bad).

    In-condition is bad when it is non-empty and has neither ``PL-`` nor ``-OK``;
    the out-condition must equal ``PL-<job>-OK``. An absent condition counts as
    empty for the in-check and as wrong for the out-check.
    """
    inc = F.coalesce(_c(incond), F.lit(""))
    in_bad = (inc != "") & ~inc.contains("PL-") & ~inc.contains("-OK")
    expected = F.concat(F.lit("PL-"), _c(jobname), F.lit("-OK"))
    out_bad = F.coalesce(_c(outcond) != expected, F.lit(True))
    return in_bad, out_bad


def expected_flag(actual, expected) -> Column:
    """LATE when the actual date differs from the expected one (or is missing)."""
    return F.when(F.coalesce(F.to_date(_c(actual)) == F.to_date(_c(expected)), F.lit(False)),
                  F.lit("OK")).otherwise(F.lit("LATE"))


def lag_text(c) -> Column:
    """Lag days as text, ``NA`` when unknown."""
    return F.coalesce(_c(c).cast("string"), F.lit("NA"))
