"""Delimited text feeds.

* A8 — quoted CSV whose fields hold line breaks. Spark's CSV reader joins the
  physical lines of a quoted field (``multiLine``); the reference's seam rule is
  then one regular expression per field (``seam_repair``). That reader takes a file in one task, so feeds with a file larger
  than a split are read by ``split_csv``: many tasks a file, the same rows.
* A9 — plain delimited text, first *n* fields, no quote handling; line-split.
* A12 — byte-level repair of lines with foreign delimiter/quote bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedwright.functions.exprs import delimiter_repair, seam_repair


#: A value that no feed holds: with it as the null token, an empty quoted field stays empty.
NO_NULLS = "\u0000"


def read_multiline_csv(spark: SparkSession, path: str, n: int, sep: str = ",",
                       header: bool = True, split: bool | None = None) -> DataFrame:
    """Quoted CSV with line breaks inside quotes; every value is a string,
    header and rows are cut to exactly ``n`` columns (missing ones are null, an empty quoted field is
    ``""``), blank lines are dropped (R6, R7). Rows may be wider than the header: fields beyond it
    are kept up to ``n`` as ``_c<i>``. ``split`` reads each file by many tasks (None: if one is larger than a split)."""
    reader = (spark.read.option("multiLine", True).option("sep", sep).option("quote", '"').option("escape", '"')
              .option("mode", "PERMISSIVE").option("nullValue", NO_NULLS).option("emptyValue", ""))
    names = reader.option("header", header).csv(path).columns if header else []
    names = [c.removesuffix("\r") for c in names]
    # the schema has n columns at least: a reader that takes the header's width drops what is beyond it
    wide = max(n, len(names))
    names = [*names, *(f"_c{i}" for i in range(len(names), wide))]
    schema = T.StructType([T.StructField(f"_f{i}", T.StringType()) for i in range(wide)])
    if split is None:
        split = largest_file(spark, path) > _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    if split:
        from feedwright.sources.split_csv import csv_fields, split_records
        df = csv_fields(split_records(spark, path, header), wide, sep, NO_NULLS)
        return df.select(*[seam_repair(F.col(f"_f{i}")).alias(names[i]) for i in range(n)])
    df = reader.option("header", header).option("enforceSchema", True).schema(schema).csv(path)
    return df.select(*[seam_repair(F.col(f"_f{i}")).alias(names[i]) for i in range(n)])


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file that a reader of ``path`` takes (listing only)."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(path).agg(F.max("length")).first()[0]
    return int(found or 0)


def _bytes(size: str) -> int:
    """A size setting (``134217728``, ``128MB``, ``16m``) in bytes."""
    text = str(size).strip().lower().rstrip("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}.get(text[-1:], 1)
    return int(text.rstrip("kmgt")) * unit


def read_first_n(spark: SparkSession, path: str, n: int, sep: str = ",") -> DataFrame:
    """Plain delimited lines, the first ``n`` fields as ``_c0 … _c{n-1}``;
    the separator is literal, trailing empty fields are kept and a line may end in CR LF."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.regexp_replace("value", "\r$", "").alias("value")).where(F.col("value") != "")
    parts = F.split(F.col("value"), _regex_literal(sep), -1)
    return lines.select(*[F.try_element_at(parts, F.lit(i + 1)).alias(f"_c{i}") for i in range(n)])


def _regex_literal(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch for ch in s)


def read_repaired_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines split at ``\\n`` only (a lone CR stays in the line), read as
    ISO-8859-1, then ``"``/CR dropped and FE -> U+0001, DF -> ``"``."""
    return spark.read.option("lineSep", "\n").text(path).select(delimiter_repair(F.col("value")).alias("value"))


def latin1_line(c: Column) -> Column:
    """Raw ISO-8859-1 bytes of a line, as the text writer's string payload (the
    cast from binary keeps the bytes as they are)."""
    return F.encode(c, "ISO-8859-1").cast("string")
