"""A1-A5: raw, refined, delta, custom-SQL and dated-path scans.

Predicates are built on the bare column (no function around it) so that they
reach the parquet reader as ``PushedFilters`` and prune partitions.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedwright.functions.exprs import compare, ts_literal, typed_literal


def _as_date(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    s = str(value).strip()
    fmt = "%Y-%m-%d" if "-" in s else "%Y%m%d"
    return _dt.datetime.strptime(s, fmt).date()


def _date_pred(df: DataFrame, col: str, lo, hi_inclusive) -> Column:
    """Inclusive date window on a date, timestamp or yyyyMMdd-text column."""
    dtype = df.schema[col].dataType
    c = F.col(col)
    lo_d = _as_date(lo)
    hi_d = _as_date(hi_inclusive)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        # half-open range on the raw column keeps the predicate pushable
        kind = "timestamp_ntz" if isinstance(dtype, T.TimestampNTZType) else "timestamp"
        return (c >= ts_literal(lo_d, kind)) & (c < ts_literal(hi_d + _dt.timedelta(days=1), kind))
    if isinstance(dtype, T.DateType):
        return (c >= F.lit(lo_d)) & (c <= F.lit(hi_d))
    if isinstance(dtype, T.StringType):
        return (c >= F.lit(lo_d.strftime("%Y%m%d"))) & (c <= F.lit(hi_d.strftime("%Y%m%d")))
    # numeric yyyyMMdd partitions
    return (c >= F.lit(int(lo_d.strftime("%Y%m%d")))) & (c <= F.lit(int(hi_d.strftime("%Y%m%d"))))


def scan_raw(df: DataFrame, from_date=None, load_col: str = "loaddate") -> DataFrame:
    """A1: all rows, or the rows loaded on ``from_date``."""
    if from_date is None or str(from_date) == "":
        return df
    return df.where(_date_pred(df, load_col, from_date, from_date))


def scan_refined(df: DataFrame, part_col: str | None = None, from_date=None,
                 end_date=None) -> DataFrame:
    """A2: all rows without a partition column; inclusive range with an end
    date; equality otherwise."""
    if not part_col:
        return df
    end = end_date if end_date not in (None, "") else from_date
    return df.where(_date_pred(df, part_col, from_date, end))


def _column(df: DataFrame, name: str) -> str:
    """The column's own spelling (metadata names come upper-cased)."""
    same = [c for c in df.columns if c.lower() == name.lower()]
    if name in df.columns:
        return name
    if len(same) != 1:
        raise ValueError(f"no single column {name!r} in {df.columns}")
    return same[0]


#: Metadata date formats are upper-cased (B1): Spark's letters for their parts, longest first.
_FORMAT_PARTS = (("YYYY", "yyyy"), ("HH24", "HH"), ("MI", "mm"), ("MM", "MM"), ("DD", "dd"), ("HH", "HH"), ("SS", "ss"), ("YY", "yy"))


def spark_format(fmt: str) -> str:
    """A metadata date format (``YYYYMMDD``, ``YYYY-MM-DD HH24:MI:SS``) in Spark's letters; Spark
    formats (``yyyyMMdd``) stay."""
    if fmt != fmt.upper():
        return fmt
    out, i = "", 0
    while i < len(fmt):
        for part, letters in _FORMAT_PARTS:
            if fmt.startswith(part, i):
                out, i = out + letters, i + len(part)
                break
        else:
            out, i = out + fmt[i], i + 1
    return out


def _instant(value) -> tuple[_dt.datetime, bool]:
    """A bound as a wall-clock time, and whether it names a whole day."""
    if isinstance(value, _dt.datetime):
        return value, False
    if isinstance(value, _dt.date):
        return _dt.datetime.combine(value, _dt.time()), True
    s = str(value).strip()
    if len(s) == 8 and s.isdigit() or len(s) == 10 and s[4] == "-" and s[7] == "-":
        return _dt.datetime.combine(_as_date(s), _dt.time()), True
    if s.isdigit() and len(s) == 14:
        return _dt.datetime.strptime(s, "%Y%m%d%H%M%S"), False
    return _dt.datetime.fromisoformat(s), False


_PYTHON_PARTS = (("yyyy", "%Y"), ("MM", "%m"), ("dd", "%d"), ("HH", "%H"), ("mm", "%M"), ("ss", "%S"), ("yy", "%y"))


def _as_text(at: _dt.datetime, fmt: str) -> str:
    out = fmt
    for letters, code in _PYTHON_PARTS:
        out = out.replace(letters, code)
    return at.strftime(out)


def _delta_range(op: str, lo, hi) -> list[tuple[str, _dt.datetime]]:
    """Comparisons of a point in time with the bounds; a day as a bound means all of it."""
    at, day = _instant(lo)
    after = at + _dt.timedelta(days=1) if day else None
    if op == "between":
        end, end_day = _instant(hi)
        return [(">=", at), ("<", end + _dt.timedelta(days=1)) if end_day else ("<=", end)]
    if not day:
        return [(op, at)]
    return {">": [(">=", after)], ">=": [(">=", at)], "<": [("<", at)], "<=": [("<", after)],
            "=": [(">=", at), ("<", after)], "<>": [("<>", at)]}[op]


def scan_delta(df: DataFrame, delta_col: str | None, op: str = "=", from_val=None,
               to_val=None, col_type: str = "DATE", col_fmt: str = "yyyyMMdd") -> DataFrame:
    """A3: delta extract. ``op`` is one of the six comparisons or ``between``
    (inclusive range of from/to); no delta column means all rows.

    The column stays bare and the bounds take its type, so the predicate is pushed
    down: timestamps compare with the bound's time of day (a bound that is a day means the whole day),
    text columns with the bound written in ``col_fmt`` (which must sort like the dates it
    writes), numbers with its digits.
    """
    if not delta_col:
        return df
    name = _column(df, delta_col)
    kind = (col_type or "").upper()
    dtype = df.schema[name].dataType
    op = op.strip().lower()
    if op not in (">", ">=", "<", "<=", "=", "<>", "between"):
        raise ValueError(f"operator {op!r} is not a comparison")
    if kind not in ("DATE", "TIMESTAMP"):
        lo = typed_literal(from_val, kind, col_fmt)
        return df.where(compare(name, op, lo, typed_literal(to_val, kind, col_fmt) if to_val is not None else None))
    c = F.col(f"`{name}`")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        ts = "timestamp_ntz" if isinstance(dtype, T.TimestampNTZType) else "timestamp"
        bounds = _delta_range(op, from_val, to_val)
        if bounds[0][0] == "<>" and _instant(from_val)[1]:
            at = bounds[0][1]
            return df.where((c < ts_literal(at, ts)) | (c >= ts_literal(at + _dt.timedelta(days=1), ts)))
        pred = F.lit(True)
        for o, at in bounds:
            pred = pred & compare(c, o, ts_literal(at, ts))
        return df.where(pred)
    # one value per day (or per written instant): bounds of the column's type
    if isinstance(dtype, T.DateType):
        value = lambda v: F.lit(_instant(v)[0].date())
    else:
        fmt = spark_format(col_fmt)
        if fmt.find("yy") > 0 and op not in ("=", "<>"):
            raise ValueError(f"format {col_fmt!r} doesn't sort by date: only = and <> work on text")
        value = lambda v: F.lit(_as_text(_instant(v)[0], fmt))
        if not isinstance(dtype, T.StringType):
            value = lambda v: F.lit(int(_as_text(_instant(v)[0], fmt)))
    return df.where(compare(c, op, value(from_val), value(to_val) if to_val is not None else None))


def read_sql_file(spark: SparkSession, path: str) -> str:
    """SQL text of a file: a local path on the driver, or one that the cluster's file systems read."""
    import os

    from feedwright.sources import storage
    if "://" not in path and os.path.isfile(path):
        with open(path) as fh:
            return fh.read()
    if not storage.exists(spark, path):
        raise FileNotFoundError(path)
    return storage.read_small(spark, path)


def read_sql_text(spark: SparkSession, text_or_path: str) -> str:
    """SQL text given inline (kept as written, R30) or as a file: a single token ending
    in ``.sql`` is a path, anything else is SQL."""
    t = text_or_path.strip()
    return read_sql_file(spark, t) if t.lower().endswith(".sql") and not re.search(r"\s", t) else text_or_path


#: Quoted texts, quoted names, comments and the semicolons between statements.
_TOKEN = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|;", re.S)

_MARKER = re.compile(r"<<\s*(\w+)\s*>>")


def split_statements(text: str) -> list[str]:
    """Statements of a ``;`` list; semicolons in quotes and comments don't separate."""
    parts, at = [], 0
    for m in _TOKEN.finditer(text):
        if m.group() == ";":
            parts.append(text[at:m.start()])
            at = m.end()
    parts.append(text[at:])
    return [p.strip() for p in parts if p.strip()]


def _parts(text: str):
    """``(kind, part)`` of an SQL text: plain, quoted (with its quote character) or comment."""
    at = 0
    for m in _TOKEN.finditer(text):
        if m.start() > at:
            yield "", text[at:m.start()]
        first = m.group()[0]
        yield (first if first in "'\"`" else "" if first == ";" else "#"), m.group()
        at = m.end()
    if at < len(text):
        yield "", text[at:]


def marker_text(key: str, value) -> str:
    """A parameter's text inside quotes."""
    if value is None or isinstance(value, bool):
        raise ValueError(f"<<{key}>> in quotes needs a text, number or date, not {value!r}")
    return f"{value:%Y-%m-%d %H:%M:%S}" if isinstance(value, _dt.datetime) else str(value)


def replace_markers(text: str, params: dict, plain, quoted) -> str:
    """``text`` with its ``<<KEY>>`` markers replaced: ``plain(key)`` outside quotes, ``quoted(key, quote)`` inside (of keys that
    have a value; others are text there). Comments stay as they are."""
    out = []
    for kind, part in _parts(text):
        if not kind:
            part = _MARKER.sub(lambda m: plain(m.group(1)), part)
        elif kind != "#":
            part = _MARKER.sub(lambda m, q=kind: quoted(m.group(1), q) if m.group(1) in params else m.group(), part)
        out.append(part)
    return "".join(out)


def bind_markers(text: str, params: dict) -> str:
    """Spark SQL text: a bare ``<<KEY>>`` becomes the named parameter ``:KEY``; in a quoted text (``'<<KEY>>'``,
    ``'x_<<KEY>>'``, ``DATE '<<KEY>>'``) or name the value's own text stands for it, escaped, so that it can't end the quotes."""
    def quoted(key, quote):
        value = marker_text(key, params[key])
        if quote == "`":
            return value.replace("`", "``")
        return value.replace("\\", "\\\\").replace(quote, "\\" + quote)

    return replace_markers(text, params, lambda key: f":{key}", quoted)


def scan_sql(spark: SparkSession, text: str, params: dict | None = None,
             views: dict[str, DataFrame] | None = None) -> DataFrame:
    """A4/C11: custom extract SQL with ``<<KEY>>`` or ``:key`` parameters.

    Bare ``<<KEY>>`` markers are rewritten to named parameter markers, whose values are
    bound; inside quotes the value's escaped text is filled in (``bind_markers``). A ``;`` list runs in order and
    the last statement's result is returned (B8).
    """
    for name, view in (views or {}).items():
        view.createOrReplaceTempView(name)
    params = dict(params or {})
    text = bind_markers(read_sql_text(spark, text), params)
    statements = split_statements(text)
    if not statements:
        raise ValueError("empty SQL text")
    result = None
    for stmt in statements:
        plain = "".join(part for kind, part in _parts(stmt) if not kind)
        used = {k: v for k, v in params.items() if re.search(r":" + re.escape(k) + r"\b", plain)}
        result = spark.sql(stmt, args=used or None)
    return result


def scan_sql_per_row(spark: SparkSession, text: str, keys: DataFrame, key: str, params: dict | None = None,
                     views: dict[str, DataFrame] | None = None) -> DataFrame | None:
    """One statement for every row of ``keys`` at once: its ``<<key>>`` markers are the row's column ``key``, and the result has
    the statement's columns and ``key``. Catalyst turns the lateral join into one scan that is aggregated per key.

    None where the statement can't run this way (a list of statements, or the key outside a condition): run it per row then."""
    from pyspark.errors import AnalysisException, ParseException
    params = dict(params or {})
    text = read_sql_text(spark, text)
    if len(split_statements(text)) != 1:
        return None
    column = "fw_keys.fw_key"
    text = split_statements(text)[0]
    found = []
    for kind, part in _parts(text):
        if kind == "'" and any(m.group(1) == key for m in _MARKER.finditer(part)):
            inner = re.split(rf"<<\s*{key}\s*>>", part[1:-1])
            part = "(" + f" || {column} || ".join(f"'{x}'" for x in inner) + ")" if any(inner) else column
        elif not kind:
            part = re.sub(rf"<<\s*{key}\s*>>|:{key}\b", column, part)
        found.append(part)
    for name, view in (views or {}).items():
        view.createOrReplaceTempView(name)
    name = f"fw_keys_{uuid.uuid4().hex}"
    keys.select(F.col(key).cast("string").alias("fw_key")).distinct().createOrReplaceTempView(name)
    statement = bind_markers("".join(found), params)
    plain = "".join(part for kind, part in _parts(statement) if not kind)
    used = {k: v for k, v in params.items() if re.search(r":" + re.escape(k) + r"\b", plain)}
    try:
        out = spark.sql(f"SELECT {column} AS fw_key, fw_rows.* FROM {name} AS fw_keys, LATERAL ({statement}) AS fw_rows", args=used or None)
        # the analyser looks at the whole plan here; what it can't decorrelate is refused now
        out._jdf.queryExecution().optimizedPlan()
        return out
    except (AnalysisException, ParseException):
        return None
    finally:
        spark.catalog.dropTempView(name)


def dated_path(template: str, date) -> str:
    """A5: replace the one ``<<strftime-pattern>>`` token by the formatted date."""
    m = re.search(r"<<(.+?)>>", template)
    if not m:
        return template
    return template.replace(m.group(0), _as_date(date).strftime(m.group(1)))


def scan_dated_path(spark: SparkSession, template: str, date, fmt: str = "parquet",
                    **options) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(dated_path(template, date))
