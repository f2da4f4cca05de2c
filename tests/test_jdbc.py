"""A6/A7/L4 on the embedded Derby driver that ships with Spark (in-process,
memory only: valid in local mode, where the executors share the driver JVM)."""

import pytest

from feedwright.operators import dq
from feedwright.sources.jdbc import jdbc_url, scan_jdbc, write_jdbc


def test_url_per_type():
    assert jdbc_url("oracle", "h:1521/s")[0] == "jdbc:oracle:thin:@//h:1521/s"
    assert jdbc_url("TERADATA", "td")[1] == "com.teradata.jdbc.TeraDriver"
    with pytest.raises(ValueError):
        jdbc_url("mainframe", "x")


def test_derby_write_split_read_and_check(spark):
    url = "jdbc:derby:memory:fw_test;create=true"
    df = spark.range(1000).selectExpr("id", "id % 7 AS g")
    write_jdbc(df, "DERBY", url, "T_SRC", mode="overwrite", batch_size=250)
    back = scan_jdbc(spark, "DERBY", url, table="T_SRC", split_by="id", bounds=(0, 999), num_partitions=4)
    assert back.rdd.getNumPartitions() == 4 and back.count() == 1000
    filtered = back.where("id < 10")
    assert "PushedFilters" in filtered._jdf.queryExecution().executedPlan().toString() and filtered.count() == 10
    stats = dq.run_check(spark, "DERBY", query='SELECT "g" AS SUB_GROUP, COUNT(*) AS N FROM T_SRC GROUP BY "g"',
                         server=url, key="SUB_GROUP")
    assert sorted((r.sub_group, r.value) for r in stats.collect())[0] == ("0", 143.0)


def test_ingest_from_jdbc_source(spark):
    import datetime as dt

    from feedwright.plans.ingest import FeedSpec, ingest
    from feedwright.session import scratch_path
    url = "jdbc:derby:memory:fw_ingest;create=true"
    src = spark.createDataFrame([(i, dt.date(2024, 1, 1 + i % 5)) for i in range(100)], "id long, bus_dt date")
    write_jdbc(src, "DERBY", url, "T_FEED", mode="overwrite")
    meta = [{"SOURCECOLNM": "id", "RAW_COL_INHIVE": "ID", "RFND_COL_INHIVE": "ID", "RFND_COL_TYPE_INHIVE": "BIGINT",
             "IS_EXTRACTED": "Y", "IS_PARTITIONED": "N", "SEQ_NB": 1},
            {"SOURCECOLNM": "bus_dt", "RAW_COL_INHIVE": "BUS_DT", "RFND_COL_INHIVE": "BUS_DT",
             "RFND_COL_TYPE_INHIVE": "DATE", "IS_EXTRACTED": "Y", "IS_PARTITIONED": "Y", "SEQ_NB": 2}]
    base = scratch_path(spark, "ingest-jdbc")
    spec = FeedSpec("JFEED", None, meta, f"{base}/raw", f"{base}/refined", delta_col="bus_dt",
                    jdbc={"db_type": "DERBY", "server": url, "table": "T_FEED", "split_by": "id",
                          "bounds": (0, 99), "num_partitions": 4})
    res = ingest(spark, spec, "20240102", "20240103", jobpid=41)
    assert res["rowcount"] == 40 and res["refined_count"] == 40
