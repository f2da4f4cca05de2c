"""Table and column metadata, projection and partition twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedwright.functions.exprs import not_blank

# Table-metadata fields by normalisation rule.
UPPER_FIELDS = ("SOURCESCHEMA", "SOURCETBLNM", "REFRESHRATE", "DELTACOLUMN", "DELTACOLUMNTYPE",
                "DELTACOLUMNFMT", "DB_TYPE", "DB_SERVER", "DB_USER", "BUCKETINGCLAUSE", "TGT_STG_DB",
                "TGT_DB", "HIVE_TBL_TRUNCATE", "TRGTTBLNM", "V1SUPPORT")
LOWER_FIELDS = ("HDFS_BASEDIR",)
STRIP_LOWER_FIELDS = ("HDFSEXTRACTDIR", "HIVE_RAW_DIR", "HIVE_REFINED_DIR")


def _blank_to(c: Column, default) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def normalise_table_metadata(meta: DataFrame) -> DataFrame:
    """B1: upper / lower / strip per field, defaults for empty values, and a
    trailing ``/`` on the landing directory. Custom SQL text is kept as written (R30)."""
    out = []
    for name in meta.columns:
        c = F.col(name)
        if name in UPPER_FIELDS:
            e = F.upper(c)
        elif name in LOWER_FIELDS:
            e = F.lower(c)
        elif name in STRIP_LOWER_FIELDS:
            e = F.lower(F.trim(c))
        elif name == "EXTRACTLANDINGDIR":
            e = F.when(c.endswith("/"), c).otherwise(F.concat(c, F.lit("/")))
        elif name == "DELIMITER" or name == "SPLIT_BY" or name == "RFND_FILE_FMT":
            e = F.coalesce(c, F.lit(""))
        elif name in ("HIVE_RAW_RETENTION", "HIVE_REFINED_RETENTION"):
            e = F.coalesce(c.cast("int"), F.lit(0))
        elif name == "REFRESH_REFINED_DDL_DML":
            e = _blank_to(F.upper(c), "Y")
        elif name == "SOURCE_SQL_TXT":
            e = F.coalesce(c, F.lit(""))
        else:
            e = c
        out.append(e.alias(name))
    return meta.select(*out)


def lookup_table_metadata(meta: DataFrame, schema: str, table: str) -> DataFrame:
    """B1 lookup, names compared upper-cased on both sides."""
    return meta.where((F.upper("SOURCESCHEMA") == schema.upper()) & (F.upper("SOURCETBLNM") == table.upper()))


def extracted_columns(col_meta: DataFrame, keys=("SOURCESCHEMA", "SOURCETBLNM")) -> DataFrame:
    """B2/G1: extracted columns with their position per table (ordered by SEQ_NB)."""
    w = Window.partitionBy(*keys).orderBy("SEQ_NB", "SOURCECOLNM")
    return (col_meta.where(F.upper("IS_EXTRACTED") == "Y")
            .withColumn("col_position", F.row_number().over(w)))


def projection_spec(col_meta_rows) -> list[dict]:
    """Driver-side list of the extracted columns (metadata rows, one per column)."""
    rows = [r.asDict() if hasattr(r, "asDict") else dict(r) for r in col_meta_rows]
    rows = [r for r in rows if str(r.get("IS_EXTRACTED", "")).upper() == "Y"]
    return sorted(rows, key=lambda r: (int(r["SEQ_NB"]), r["SOURCECOLNM"]))


def project(df: DataFrame, spec: list[dict], source_key: str = "SOURCECOLNM") -> DataFrame:
    """Extracted columns in order, source name -> refined name, ``try_cast``
    to the refined type (failed casts become null, R24)."""
    return df.select([F.col(f"`{r[source_key]}`").try_cast(r["RFND_COL_TYPE_INHIVE"])
                      .alias(r["RFND_COL_INHIVE"].lower()) for r in spec])


def raw_projection(df: DataFrame, spec: list[dict]) -> DataFrame:
    """Extracted source columns under their raw-table names (no cast)."""
    return df.select([F.col(f"`{r['SOURCECOLNM']}`").alias(r["RAW_COL_INHIVE"].lower()) for r in spec])


def cast_rejects(df: DataFrame, spec: list[dict]) -> DataFrame:
    """Per target column, the number of non-null source values that failed the cast."""
    aggs = [F.count_if(F.col(f"`{r['SOURCECOLNM']}`").isNotNull()
                       & F.col(f"`{r['SOURCECOLNM']}`").try_cast(r["RFND_COL_TYPE_INHIVE"]).isNull())
            .alias(r["RFND_COL_INHIVE"].lower()) for r in spec]
    return df.agg(*aggs)


def partition_twin_expr(c: Column, dtype_name: str) -> Column:
    if dtype_name in ("date", "timestamp", "timestamp_ntz"):
        return F.date_format(c, "yyyyMMdd")
    return c.cast("string")


def add_partition_twins(df: DataFrame, partition_cols: list[str]) -> tuple[DataFrame, str, str | None]:
    """Each partition column gets a ``<col>_ptn`` twin.

    Returns the frame, the comma-separated twin list (R13) and the DQ partition
    column (the first twin, lower-cased).
    """
    types = dict(df.dtypes)
    twins = [f"{c.lower()}_ptn" for c in partition_cols]
    out = df
    for c, t in zip(partition_cols, twins):
        out = out.withColumn(t, partition_twin_expr(F.col(c), types[c]))
    return out, ",".join(twins), (twins[0] if twins else None)


def dq_plan(metadata_dq: DataFrame, grouping: DataFrame, xref: DataFrame, tbl_meta: DataFrame,
            group_nm: str | None = None) -> DataFrame:
    """DQ plan of a group (all groups when ``group_nm`` is None).

    Inner joins on the sub-group and on (schema, table); disabled groups and
    blank sub-groups disappear. The metadata tables grow with the number of
    feeds, so the joins are left to the planner (AQE turns the small sides into
    broadcasts at run time from measured sizes).
    """
    x = xref.where(not_blank(F.col("sub_group_nm")))
    if group_nm is not None:
        x = x.where(F.col("group_nm") == group_nm)
    g = grouping.where(F.col("dq_chk_flg") == 1).select("group_nm")
    return (x.join(g, "group_nm")
            .join(metadata_dq, "sub_group_nm")
            .join(tbl_meta, ["sourceschema", "sourcetblnm"])
            .select("group_nm", "sub_group_nm", "filename", "src_qry_scr", "tgt_qry_scr",
                    "db_type", "db_server", "db_user"))


def first_columns(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` columns (a projection; pruned at the scan)."""
    return df.select(df.columns[:n])
