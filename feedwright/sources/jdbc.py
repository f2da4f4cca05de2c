"""Relational sources and sinks through Spark's JDBC data source.

The reference shells out to sqoop, bteq, beeline and psql; here each source type
maps to a JDBC URL prefix and driver class, Hive to ``spark.table``. Parallel
extracts use the split column options (A7); batched writes use ``batchsize`` (L4).
Production drivers are not shipped; the embedded Derby driver that comes with
Spark is used by the tests (in-process, so it only works in local mode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# URL prefix and driver class per source type.
JDBC_TYPES = {
    "ORACLE": ("jdbc:oracle:thin:@//", "oracle.jdbc.OracleDriver"),
    "ORACLE-SQOOP": ("jdbc:oracle:thin:@//", "oracle.jdbc.OracleDriver"),
    "ORACLE-SQOOP-TNS": ("jdbc:oracle:thin:@", "oracle.jdbc.OracleDriver"),
    "SYBASE": ("jdbc:sybase:Tds:", "com.sybase.jdbc4.jdbc.SybDriver"),
    "SYBASE-SQOOP": ("jdbc:sybase:Tds:", "com.sybase.jdbc4.jdbc.SybDriver"),
    "SQLSERVER": ("jdbc:sqlserver://", "com.microsoft.sqlserver.jdbc.SQLServerDriver"),
    "SQLSERVER-SQOOP": ("jdbc:sqlserver://", "com.microsoft.sqlserver.jdbc.SQLServerDriver"),
    "TERADATA": ("jdbc:teradata://", "com.teradata.jdbc.TeraDriver"),
    "GREENPLUM": ("jdbc:postgresql://", "org.postgresql.Driver"),
    "GPHDFS-PULL": ("jdbc:postgresql://", "org.postgresql.Driver"),
    "PSQL": ("jdbc:postgresql://", "org.postgresql.Driver"),
    "DERBY": ("jdbc:derby:", "org.apache.derby.jdbc.EmbeddedDriver"),
}


#: Range queries of a split read whose number isn't given.
SPLITS = 4


def jdbc_url(db_type: str, server: str) -> tuple[str, str]:
    t = db_type.upper()
    if t not in JDBC_TYPES:
        raise ValueError(f"unknown source type {db_type!r}")
    prefix, driver = JDBC_TYPES[t]
    return (server if server.startswith("jdbc:") else prefix + server), driver


def scan_jdbc(spark: SparkSession, db_type: str, server: str, query: str | None = None,
              table: str | None = None, user: str | None = None, password: str | None = None,
              split_by: str | None = None, bounds: tuple | None = None, num_partitions: int | None = None,
              fetch_size: int = 10_000) -> DataFrame:
    """One extract; with ``split_by`` the read is split into
    ``num_partitions`` range queries over ``bounds`` (filters are pushed down). Without bounds the source is asked for the column's
    least and greatest value first; ``num_partitions`` is ``SPLITS`` then, if not given."""
    if db_type.upper() == "HIVE":
        return spark.sql(query) if query else spark.table(table)
    url, driver = jdbc_url(db_type, server)
    r = spark.read.format("jdbc").option("url", url).option("driver", driver).option("fetchsize", fetch_size)
    if user:
        r = r.option("user", user)
    if password:
        r = r.option("password", password)
    if query and not split_by:
        r = r.option("query", query)
    else:
        r = r.option("dbtable", table if table else f"({query}) q")
    if split_by and not bounds:
        names = [c for c in r.load().columns if c.lower() == split_by.lower()]
        if len(names) != 1:
            raise ValueError(f"no single column {split_by!r} to split by")
        split_by = names[0]
        ask = (spark.read.format("jdbc").option("url", url).option("driver", driver)
               .option("query", f'SELECT MIN(q."{split_by}") AS LO, MAX(q."{split_by}") AS HI FROM {table if table else f"({query})"} q'))
        for k, v in (("user", user), ("password", password)):
            ask = ask.option(k, v) if v else ask
        bounds, num_partitions = tuple(ask.load().first()), num_partitions or SPLITS
        if bounds[0] is None:      # no rows, or only nulls: nothing to split
            split_by = None
    if split_by:
        if not num_partitions:
            raise ValueError("split_by needs num_partitions with its bounds")
        r = (r.option("partitionColumn", split_by).option("lowerBound", str(bounds[0]))
             .option("upperBound", str(bounds[1])).option("numPartitions", str(num_partitions)))
    return r.load()


def write_jdbc(df: DataFrame, db_type: str, server: str, table: str, mode: str = "append",
               batch_size: int = 250, user: str | None = None, password: str | None = None,
               num_partitions: int | None = None) -> None:
    """L4: batched insert (250 rows per batch, as the reference's metrics load)."""
    url, driver = jdbc_url(db_type, server)
    w = (df.write.format("jdbc").mode(mode).option("url", url).option("driver", driver)
         .option("dbtable", table).option("batchsize", batch_size))
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    if user:
        w = w.option("user", user)
    if password:
        w = w.option("password", password)
    w.save()
