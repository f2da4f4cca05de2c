"""XML feeds.

``split_xml`` finds the row elements (a file is many tasks; comments, CDATA and nested rows as XML has them) and each
record is parsed on its own with ``from_xml``. A fault costs its record only: every other row survives,
and the lost ones are counted (``xml_faults``). A row inside a row is a record of its own; the outer record has its own elements.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedwright.sources.split_xml import RECORD, row_elements

CORRUPT = "_corrupt_record"


def read_xml_raw(spark: SparkSession, path: str, row_tag: str, tags: list[str], salvage: bool = False) -> DataFrame:
    """Every wanted tag as ``array<string>`` (so repeats are kept in order) plus
    the corrupt-record column, which holds the text of a record that isn't well-formed (the
    tags of such a row are null); surrounding spaces are kept.

    ``salvage`` reads the leading elements of such a record up to the fault, as a recovering parser does; the corrupt-record column
    still has its text."""
    schema = T.StructType([T.StructField(t, T.ArrayType(T.StringType())) for t in tags]
                          + [T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "rowTag": row_tag, "ignoreSurroundingSpaces": "false"}
    found = row_elements(spark, path, row_tag)
    record = F.when(F.col("kind") == RECORD, F.col("text"))
    # a generator of one element: what is asked of the parsed record is asked after it, so no record is parsed twice
    out = found.select("text", record.alias("record"), F.explode(F.array(F.from_xml(record, schema, options))).alias("r"))
    bad = F.col("record").isNull() | F.col(f"r.{CORRUPT}").isNotNull()
    if not salvage:
        return out.select(*[F.when(~bad, F.col(f"r.`{t}`")).alias(t) for t in tags], F.when(bad, F.col("text")).alias(CORRUPT))
    tag = re.escape(row_tag)
    whole = r"\s*+<([A-Za-z_][\w.:-]*+)(?:\s[^<>]*+)?(?:/>|(?<!/)>[^<]*+</\2\s*+>)"
    leading = F.regexp_extract("text", rf"(<{tag}(?:\s[^<>]*+)?>(?:{whole})*+)", 1)
    head = F.when(bad & (leading != ""), F.from_xml(F.concat(leading, F.lit(f"</{row_tag}>")), schema, options))
    out = out.select("*", head.alias("s"))
    return out.select(*[F.when(bad, F.col(f"s.`{t}`")).otherwise(F.col(f"r.`{t}`")).alias(t) for t in tags], F.when(bad, F.col("text")).alias(CORRUPT))


def xml_faults(raw: DataFrame) -> DataFrame:
    """Number of records that are lost because they aren't well-formed."""
    return raw.agg(F.count_if(F.col(CORRUPT).isNotNull()).alias("faults"))


def xml_rows(raw: DataFrame, tags: list[str], key: str | None = None, salvaged: bool = False) -> DataFrame:
    """A10/A11/C4 on a raw read: drop the corrupt-record row (``salvaged``: keep those with leading elements), keep only rows
    that hold the key element (an empty element counts as present), and take
    the first value of each tag with ``""`` for absent or empty (R8)."""
    ok = raw.where(F.col(CORRUPT).isNull() | F.coalesce(*[F.col(f"`{t}`")[0] for t in tags]).isNotNull() if salvaged else F.col(CORRUPT).isNull())
    if key is not None:
        ok = ok.where(F.col(key).isNotNull())
    return ok.select(*[F.coalesce(F.try_element_at(F.col(t), F.lit(1)), F.lit("")).alias(t) for t in tags])


def read_xml_rows(spark: SparkSession, path: str, row_tag: str, tags: list[str],
                  key: str | None = None, salvage: bool = False) -> DataFrame:
    return xml_rows(read_xml_raw(spark, path, row_tag, tags, salvage), tags, key, salvage)


def key_rejects(raw: DataFrame, key: str) -> DataFrame:
    """Number of well-formed rows dropped because the key element is absent."""
    return raw.where(F.col(CORRUPT).isNull()).agg(F.count_if(F.col(key).isNull()).alias("rejected"))


JOB_SCHEMA = T.StructType([
    T.StructField("_JOBNAME", T.StringType()),
    T.StructField("INCOND", T.ArrayType(T.StructType([T.StructField("_NAME", T.StringType())]))),
    T.StructField("OUTCOND", T.ArrayType(T.StructType([T.StructField("_NAME", T.StringType())]))),
])


def read_job_definitions(spark: SparkSession, path: str) -> DataFrame:
    """Per JOB its name and the last in- and out-condition (R19: null when
    the job has none)."""
    df = spark.read.format("xml").option("rowTag", "JOB").schema(JOB_SCHEMA).load(path)
    return df.select(F.col("_JOBNAME").alias("jobname"),
                     F.try_element_at(F.col("INCOND"), F.lit(-1)).getField("_NAME").alias("incond"),
                     F.try_element_at(F.col("OUTCOND"), F.lit(-1)).getField("_NAME").alias("outcond"))
