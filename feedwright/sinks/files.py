"""L1 and the writers used by the format round trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, header: bool = False, sep: str = ",",
              max_records_per_file: int | None = None, mode: str = "errorifexists") -> None:
    """L1: CSV with minimal quoting (only where a value needs it), ``"`` doubled
    inside quotes, leading/trailing spaces kept, no header by default."""
    w = (df.write.mode(mode).option("header", header).option("sep", sep).option("quote", '"')
         .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).option("lineSep", "\n"))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.csv(path)


def write_csv_counted(df: DataFrame, path: str, **kw) -> int:
    """Write and count the written rows in the same job (an ``Observation``
    on the written plan, no second scan). An empty output is an error (R10)."""
    obs = Observation("written")
    write_csv(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, **kw)
    n = int(obs.get["rows"])
    if n == 0:
        raise RuntimeError(f"no rows written to {path}")
    return n


def write_xml(df: DataFrame, path: str, row_tag: str = "row", root_tag: str = "rows",
              max_records_per_file: int | None = None) -> None:
    w = df.write.format("xml").option("rowTag", row_tag).option("rootTag", root_tag)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)


def write_lines(df: DataFrame, path: str, max_records_per_file: int | None = None) -> None:
    """One string column as lines (``\\n``-terminated)."""
    w = df.write.option("lineSep", "\n")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.text(path)
