"""L2 with a bucketing clause: refined tables whose loads are bucketed, so that joins on the key need no exchange.

A catalog table, bucketed and sorted by the clause's columns; its files stay at the feed's refined path, and a session that doesn't know the
table yet registers it again from there. A load is hash-partitioned into the table's buckets, so it writes one file per bucket and partition. Append
loads are partitions ``load_unit=<unit>`` (see ``sinks.units``) and replace themselves when they are repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedwright.functions.exprs import quote_ident
from feedwright.sinks.units import UNIT
from feedwright.sources import storage


class BucketedTable:
    def __init__(self, spark: SparkSession, name: str, path: str, schema: T.StructType, buckets: int, cols: list[str],
                 partition_cols: list[str], fmt: str = "parquet"):
        missing = [c for c in cols if c not in schema.names]
        if missing:
            raise ValueError(f"{name}: the bucketing clause names {missing}, which aren't refined columns {schema.names}")
        self.spark, self.name, self.path, self.buckets, self.cols, self.partition_cols = spark, name, path.rstrip("/"), buckets, cols, partition_cols
        if not spark.catalog.tableExists(name):
            fields = ", ".join(f"{quote_ident(f.name)} {f.dataType.simpleString()}" for f in
                               [*schema.fields, *([T.StructField(UNIT, T.StringType())] if UNIT in partition_cols else [])])
            listed = ", ".join(map(quote_ident, cols))
            partitioned = f"PARTITIONED BY ({', '.join(map(quote_ident, partition_cols))}) " if partition_cols else ""
            at = path.replace("'", "\\'")
            spark.sql(f"CREATE TABLE {name} ({fields}) USING {fmt} {partitioned}CLUSTERED BY ({listed}) SORTED BY ({listed}) "
                      f"INTO {buckets} BUCKETS LOCATION '{at}'")
            if partition_cols and storage.exists(spark, path):
                spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self, col: str, values: list[str]) -> None:
        """Drop partitions of the first partition column, with their files."""
        for v in values:
            text = str(v).replace("'", "\\'")
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({quote_ident(col)} = '{text}')")
            storage.delete(self.spark, f"{self.path}/{col}={v}")      # a table with a location keeps them otherwise

    def load(self, df: DataFrame, unit: str | None = None, replace_all: bool = False) -> None:
        """Insert a load: the table's whole content with ``replace_all``, the unit's rows with ``unit``, else the partitions that ``df`` has rows for."""
        if unit is not None:
            self.drop(UNIT, [unit])
            df = df.withColumn(UNIT, F.lit(unit))
        elif not replace_all and not self.partition_cols:
            raise ValueError(f"{self.name} has no partitions to replace")
        elif replace_all and self.partition_cols:
            first = self.partition_cols[0]
            self.drop(first, storage.partition_values(self.spark, self.path, first))
        # an insert into a table goes by the session's setting only; static would empty the table (the library's sessions have it dynamic)
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        df = df.select(*[F.col(quote_ident(c)) for c in self.read().columns])
        (df.repartition(self.buckets, *[F.col(quote_ident(c)) for c in self.cols]).write
         .insertInto(self.name, overwrite=unit is None))
