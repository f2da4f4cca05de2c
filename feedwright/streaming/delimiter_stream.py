"""The delimiter repair (A12) on a stream of landed text files.

Stateless: the same Column expression as the batch reader, applied per
micro-batch; ``availableNow`` processes what has landed and stops, and the
checkpoint makes a restarted run continue where it stopped.

``start_ledger_stream`` loads the stream into a table of load units (``sinks.units``) instead, with a ledger row per batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feedwright.functions.exprs import delimiter_repair
from feedwright.sinks.event_log import EventLog
from feedwright.sinks.units import UnitTable

#: The ledger of a stream load: a row per batch.
LEDGER_SCHEMA = T.StructType([T.StructField("stream", T.StringType()), T.StructField("batch", T.LongType()), T.StructField("rows", T.LongType())])


def start_delimiter_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str,
                           available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    r = spark.readStream.format("text").option("lineSep", "\n")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = r.load(in_dir)
    out = lines.select(delimiter_repair(F.col("value")).alias("value"))
    w = out.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def ledger(spark: SparkSession, path: str) -> EventLog:
    return EventLog(spark, path, LEDGER_SCHEMA, ("stream",), ("stream", "batch"))


def load_batch(rows: DataFrame, batch: int, stream: str, table: str, ledger_path: str) -> None:
    """One micro-batch: its rows become the table's unit of that batch, then its ledger row. Both replace what an earlier try of the batch left."""
    spark = rows.sparkSession
    seen = Observation(f"{stream}-{batch}")
    UnitTable(spark, table).load(rows.observe(seen, F.count(F.lit(1)).alias("n")), f"batch-{batch:012d}", [])
    ledger(spark, ledger_path).append(spark.createDataFrame([(stream, batch, int(seen.get["n"]))], LEDGER_SCHEMA))


def start_ledger_stream(spark: SparkSession, in_dir: str, table: str, ledger_path: str, checkpoint: str, stream: str = "delimiter",
                        available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """S1 with L3/L6: repaired lines into a table, each batch exactly once.

    Spark runs a batch again when a run died before it was committed. The batch number is the same then, so the unit is replaced and
    the ledger keeps one row: no line is doubled, and the ledger's counts add up to the table's rows."""
    r = spark.readStream.format("text").option("lineSep", "\n")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    out = r.load(in_dir).select(delimiter_repair(F.col("value")).alias("value"))
    w = out.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: load_batch(df, n, stream, table, ledger_path))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
