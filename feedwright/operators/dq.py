"""Data-quality checks by source type and their reconciliation.

A check returns the tall form ``(sub_group, stat, value)``: the reference's one
result row per check becomes one row per statistic, and a whole DQ group is
checked by one grouped query instead of one query per sub-group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.operators.jobstat import latest_linecount
from feedwright.sources.jdbc import JDBC_TYPES, scan_jdbc
from feedwright.sources.scans import marker_text, replace_markers, scan_sql

CheckFn = Callable[..., DataFrame]


#: Statistics are compared exactly: 28 digits before the point, 10 after it (doubles are rounded to that); greater numbers, NaN and
#: infinities are compared as text.
VALUE = "decimal(38,10)"


def to_stats(df: DataFrame, key: str = "sub_group") -> DataFrame:
    """Unpivot a wide check result into ``(sub_group, stat, value, text)``: numbers as exact
    decimals in ``value``, anything else (and numbers that no such decimal holds) as ``text``."""
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    types = dict(df.dtypes)
    rows = []
    for c in df.columns:
        if c == key:
            continue
        is_number = types[c] in numeric or types[c].startswith("decimal")
        col = F.col(f"`{c}`")
        value = col.try_cast(VALUE) if is_number else F.lit(None).cast(VALUE)
        rows.append(F.struct(F.lit(c).alias("stat"), value.alias("value"), F.when(value.isNull(), col.cast("string")).alias("text")))
    if not rows:
        raise ValueError("a check needs at least one statistic")
    return df.select(F.col(key).cast("string").alias("sub_group"), F.explode(F.array(*rows)).alias("s")).select(
        "sub_group", "s.stat", "s.value", "s.text")


def sql_check(spark: SparkSession, query: str, params: dict | None = None,
              views: dict[str, DataFrame] | None = None, key: str = "sub_group", **_) -> DataFrame:
    """Hive-style check: SQL text with ``<<KEY>>`` parameters bound."""
    return to_stats(scan_sql(spark, query, params, views), key)


def bound_text(query: str, params: dict | None) -> str:
    """A source query with its ``<<KEY>>`` markers as literals, quoted by type: the source
    database parses the text, so nothing is spliced in as it comes. Inside quotes the value's text stands for the marker, its quotes
    doubled. Identifiers go in as ``Identifier("NAME")`` and must be plain names."""
    params = dict(params or {})
    return replace_markers(query, params, lambda key: _source_literal(params[key]) if key in params else f"<<{key}>>",
                           lambda key, quote: marker_text(key, params[key]).replace(quote, quote * 2))


class Identifier(str):
    """A table or column name as a query parameter (letters, digits, ``_ $ #`` and dots)."""


def _source_literal(v) -> str:
    import datetime as dt
    import decimal
    import re
    if v is None:
        return "NULL"
    if isinstance(v, Identifier):
        if not re.fullmatch(r"[A-Za-z_][\w$#]*(\.[A-Za-z_][\w$#]*)*", v):
            raise ValueError(f"{v!r} is no plain name")
        return str(v)
    if isinstance(v, bool):
        raise ValueError("a boolean has no literal all sources read; use 0 or 1")
    if isinstance(v, (int, float, decimal.Decimal)):
        return str(v)
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP '{v:%Y-%m-%d %H:%M:%S}'"
    if isinstance(v, dt.date):
        return f"DATE '{v:%Y-%m-%d}'"
    return "'" + str(v).replace("'", "''") + "'"


def jdbc_check(spark: SparkSession, query: str, db_type: str, server: str, key: str = "sub_group",
               params: dict | None = None, **kw) -> DataFrame:
    """Relational source check through JDBC; parameters go in as typed literals of the
    source query."""
    return to_stats(scan_jdbc(spark, db_type, server, query=bound_text(query, params), user=kw.get("user"),
                              password=kw.get("password")), key)


def jobstat_check_stats(spark: SparkSession, jobstat: DataFrame, **_) -> DataFrame:
    """Job-stat check: latest extract line count per (feed, filedate)."""
    lc = latest_linecount(jobstat)
    return lc.select(F.concat_ws("|", "feed", F.col("filedate").cast("string")).alias("sub_group"),
                     F.lit("linecount").alias("stat"), F.col("linecount").cast(VALUE).alias("value"),
                     F.lit(None).cast("string").alias("text"))


CHECKS: dict[str, CheckFn] = {"HIVE": sql_check, "SQL": sql_check, "JOBSTAT": jobstat_check_stats}
for _t in JDBC_TYPES:
    CHECKS[_t] = jdbc_check


def run_check(spark: SparkSession, db_type: str, **kwargs) -> DataFrame:
    """Dispatch by source type; an unknown type is an error (R16: every
    type is reachable)."""
    fn = CHECKS.get(db_type.upper())
    if fn is None:
        raise ValueError(f"no DQ check for source type {db_type!r}")
    if fn is jdbc_check:
        kwargs.setdefault("db_type", db_type)
    return fn(spark, **kwargs)


def require_single_row(df: DataFrame, key: str = "sub_group", expected=None) -> DataFrame:
    """A check must give exactly one result row per sub-group: not two, and not none.

    ``expected``: the sub-groups that must have a row; without it, at least one row."""
    found = {r[0]: r[1] for r in df.groupBy(F.col(key).cast("string")).count().where(F.col("count") != 1).limit(1).collect()}
    for group, n in found.items():
        raise RuntimeError(f"invalid DQ result: {n} rows for {group!r}")
    if expected is not None:
        want = df.sparkSession.createDataFrame([(str(e),) for e in expected], "k string")
        missing = want.join(df.select(F.col(key).cast("string").alias("k")), "k", "left_anti").limit(1).collect()
        if missing:
            raise RuntimeError(f"invalid DQ result: 0 rows for {missing[0][0]!r}")
    elif df.limit(1).count() == 0:
        raise RuntimeError("invalid DQ result: 0 rows")
    return df


def reconcile(source: DataFrame, target: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Full outer join of source and target statistics on (sub_group, stat). Numbers compare as
    exact decimals, text statistics by equality (their values are shown as null)."""
    side = lambda df, p: df.select("sub_group", "stat", F.col("value").cast(VALUE).alias(f"{p}_value"),
                                   (F.col("text") if "text" in df.columns else F.lit(None).cast("string")).alias(f"{p}_text"),
                                   F.lit(True).alias(f"{p}_there"))
    j = side(source, "src").join(side(target, "tgt"), ["sub_group", "stat"], "full_outer")
    diff = F.col("tgt_value") - F.col("src_value")
    no = lambda p: F.col(f"{p}_there").isNull() | (F.col(f"{p}_value").isNull() & F.col(f"{p}_text").isNull())
    status = (F.when(no("src"), F.lit("MISSING_SOURCE"))
              .when(no("tgt"), F.lit("MISSING_TARGET"))
              .when(F.col("src_text").isNotNull() | F.col("tgt_text").isNotNull(),
                    F.when(F.col("src_text").eqNullSafe(F.col("tgt_text")), F.lit("MATCH")).otherwise(F.lit("MISMATCH")))
              .when(F.abs(diff) <= F.lit(str(tolerance)).cast(VALUE), F.lit("MATCH"))
              .otherwise(F.lit("MISMATCH")))
    return j.select("sub_group", "stat", "src_value", "tgt_value", diff.alias("diff"), status.alias("dq_status"))
