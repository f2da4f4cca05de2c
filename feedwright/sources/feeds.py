"""Feeds from metadata: a ``FeedSpec`` from one table-metadata row and its column rows (B1, B2 -> M3),
and the file sources a feed can name (A5, A8, A9, A10, A12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedwright.operators.metadata import normalise_table_metadata
from feedwright.sources.files import read_first_n, read_multiline_csv, read_repaired_lines
from feedwright.sources.jdbc import JDBC_TYPES
from feedwright.sources.scans import dated_path
from feedwright.sources.xml import read_xml_rows

FILE_KINDS = ("csv", "delimited", "repaired", "xml", "parquet", "orc")


def open_file(spark: SparkSession, date, path: str, kind: str, columns: list[str], sep: str = ",",
              row_tag: str | None = None, key: str | None = None) -> DataFrame:
    """The landed file of ``date`` (its path may hold one ``<<strftime>>`` token) with the given column names."""
    at = dated_path(path, date)
    if kind == "csv":
        df = read_multiline_csv(spark, at, len(columns), sep)
    elif kind == "delimited":
        df = read_first_n(spark, at, len(columns), sep)
    elif kind == "repaired":
        parts = F.split("value", "\u0001" if sep == "\u0001" else _literal(sep), -1)
        df = read_repaired_lines(spark, at).select(*[F.try_element_at(parts, F.lit(i + 1)).alias(c) for i, c in enumerate(columns)])
    elif kind == "xml":
        return read_xml_rows(spark, at, row_tag or "row", columns, key)
    elif kind in ("parquet", "orc"):
        return spark.read.format(kind).load(at)
    else:
        raise ValueError(f"file kind {kind!r} is not one of {FILE_KINDS}")
    return df.toDF(*columns)


def _literal(sep: str) -> str:
    from feedwright.sources.files import _regex_literal
    return _regex_literal(sep)


def feed_spec(table: dict, columns: list[dict], base: str = "", source: DataFrame | None = None, views: dict | None = None,
              file_kind: str = "csv", file_name: str = "", secrets: dict | None = None, status_path: str | None = None,
              row_tag: str | None = None, key: str | None = None):
    """M3's input from normalised metadata: ``table`` is one row of B1, ``columns`` its rows of B2.

    ``base`` is put before the raw and refined folders. ``row_tag`` and ``key`` are for XML files. ``SPLIT_BY`` splits a JDBC read,
    a bucketing clause makes the refined table a bucketed one. A FILE feed reads ``file_name`` (a
    ``<<strftime>>`` token is the run date) in its landing folder; a relational feed reads its
    server by JDBC (credentials in ``secrets``), every other one the given ``source``.
    """
    from feedwright.plans.ingest import FeedSpec
    t = {k.upper(): v for k, v in table.items()}
    text = lambda k: str(t.get(k) or "").strip()
    db = text("DB_TYPE").upper()
    name = text("TRGTTBLNM").lower()
    names = [c["SOURCECOLNM"] for c in sorted(columns, key=lambda c: int(c["SEQ_NB"]))]
    under = lambda k, tail: "/".join([base.rstrip("/"), text(k).strip("/"), tail]).replace("//", "/") if not base.startswith(
        ("hdfs:", "s3", "file:")) else "/".join([base.rstrip("/"), text(k).strip("/"), tail])
    spec = FeedSpec(
        feed=text("SOURCETBLNM"), schema=text("SOURCESCHEMA"), source=source, col_meta=columns,
        raw_path=under("HIVE_RAW_DIR", f"{name}_raw"), refined_path=under("HIVE_REFINED_DIR", name),
        delta_col=text("DELTACOLUMN") or None, delta_type=text("DELTACOLUMNTYPE") or "DATE",
        delta_fmt=text("DELTACOLUMNFMT") or "yyyyMMdd", truncate=text("HIVE_TBL_TRUNCATE") or None,
        raw_retention=int(t.get("HIVE_RAW_RETENTION") or 0), refined_retention=int(t.get("HIVE_REFINED_RETENTION") or 0),
        db_type=db, source_sql=text("SOURCE_SQL_TXT") or None, source_views=views or {},
        refined_format=text("RFND_FILE_FMT").lower() or "parquet", status_path=status_path, bucketing=text("BUCKETINGCLAUSE"),
        table=f"{text('TGT_DB').lower()}_{name}" if text("BUCKETINGCLAUSE") else "")
    if db == "FILE":
        spec.file = {"path": text("EXTRACTLANDINGDIR") + file_name, "kind": file_kind, "columns": names,
                     "sep": text("DELIMITER") or ",", "row_tag": row_tag, "key": key}
    elif db in JDBC_TYPES and source is None and not spec.source_sql:
        spec.jdbc = {"db_type": db, "server": text("DB_SERVER"), "table": f"{text('SOURCESCHEMA')}.{text('SOURCETBLNM')}",
                     "user": text("DB_USER") or None, **({"split_by": text("SPLIT_BY")} if text("SPLIT_BY") else {}), **(secrets or {})}
    return spec


#: The truncate modes and refined formats of the metadata.
_TRUNCATE, _FORMATS = ("Y", "P", "N"), ("parquet", "orc")


def planned_feeds(tables: DataFrame, columns: DataFrame, db_types: tuple[str, ...] = ("HIVE", "FILE", *JDBC_TYPES)) -> DataFrame:
    """Every feed of the metadata in one step: its table row (B1, normalised), its extracted columns (B2) as an array in order,
    what is wrong with it (``problem``, null if it can be loaded) and its ``settings``.

    One aggregate over the column metadata (a feed's columns are one row) and one join; nothing is looked up per feed."""
    cols = columns.where(F.upper("IS_EXTRACTED") == "Y").groupBy(F.upper("SOURCESCHEMA").alias("_s"), F.upper("SOURCETBLNM").alias("_t")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("SEQ_NB").cast("int").alias("SEQ_NB"), "SOURCECOLNM", "RAW_COL_INHIVE", "RFND_COL_INHIVE",
                                             "RFND_COL_TYPE_INHIVE", "IS_EXTRACTED", "IS_PARTITIONED"))).alias("feed_columns"))
    t = normalise_table_metadata(tables)
    f = t.join(cols, (F.col("SOURCESCHEMA") == F.col("_s")) & (F.col("SOURCETBLNM") == F.col("_t")), "left").drop("_s", "_t")
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    first = F.filter("feed_columns", lambda x: F.upper(x["IS_PARTITIONED"]) == "Y")[0]
    by_date = F.coalesce(F.upper(first["RFND_COL_TYPE_INHIVE"]).rlike("^(DATE|TIMESTAMP)"), F.lit(False))
    on_delta = F.coalesce(F.upper(first["SOURCECOLNM"]) == F.upper("DELTACOLUMN"), F.lit(False))
    has_delta = F.exists("feed_columns", lambda x: F.upper(x["SOURCECOLNM"]) == F.upper("DELTACOLUMN"))
    same = F.count(F.lit(1)).over(Window.partitionBy("SOURCESCHEMA", "SOURCETBLNM"))
    problem = (F.when(same > 1, "more than one table row")
               .when(blank("SOURCETBLNM") | blank("TRGTTBLNM"), "no table name")
               .when(F.col("feed_columns").isNull(), "no column is extracted")
               .when(~F.upper("DB_TYPE").isin([x.upper() for x in db_types]) | F.col("DB_TYPE").isNull(), "unknown source type")
               .when(~blank("HIVE_TBL_TRUNCATE") & ~F.upper("HIVE_TBL_TRUNCATE").isin(*_TRUNCATE), "unknown truncate mode")
               .when(~blank("RFND_FILE_FMT") & ~F.lower("RFND_FILE_FMT").isin(*_FORMATS), "unknown file format")
               .when((F.upper("HIVE_TBL_TRUNCATE") == "P") & ~(by_date & (on_delta | ~blank("SOURCE_SQL_TXT"))), "truncate P would replace other windows")
               .when((F.upper("DB_TYPE") == "FILE") & ~blank("DELTACOLUMN") & ~F.coalesce(has_delta, F.lit(False)), "the delta column isn't in the file"))
    settings = F.concat_ws("|", F.upper("DB_TYPE"), F.coalesce(F.upper("HIVE_TBL_TRUNCATE"), F.lit("")),
                           F.when(blank("DELTACOLUMN"), "all").otherwise("delta"), F.when(~blank("SOURCE_SQL_TXT"), "sql").otherwise("table"),
                           F.when(first.isNull(), "plain").when(by_date, "date").otherwise("value"))
    return f.select("*", problem.alias("problem"), settings.alias("settings"))
