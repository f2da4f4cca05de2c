"""Compaction by sizes, gaps as intervals, exactly-once streams, bucketed loads, feeds from metadata, stored profiles."""

import datetime as dt
import json
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedwright.operators.profile import null_profile
from feedwright.operators.rules import missing_ranges
from feedwright.operators.stored_profile import merged_profile, profile_store
from feedwright.plans.ingest import FeedSpec, ingest, read_refined
from feedwright.session import scratch_path
from feedwright.sinks import compaction
from feedwright.sources import storage
from feedwright.sources.feeds import feed_spec, planned_feeds
from feedwright.sources.jdbc import scan_jdbc, write_jdbc
from feedwright.streaming import delimiter_stream as ds


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 120), max_size=40))
def test_groups_of_small_files(sizes):
    files = {f"f{i}": n for i, n in enumerate(sizes)}
    found = compaction.groups(files, 100)
    names = [n for g in found for n in g]
    assert len(names) == len(set(names)) and all(len(g) > 1 and sum(files[n] for n in g) <= 100 for g in found)
    assert all(2 * files[n] <= 100 for n in names)
    left = [n for n, s in files.items() if 2 * s <= 100 and n not in names]
    # first fit: two files that stay alone don't fit together
    assert all(files[a] + files[b] > 100 for i, a in enumerate(left) for b in left[i + 1:])


def test_compaction_carries_on_after_a_crash(spark, monkeypatch):
    folder = scratch_path(spark, "crash")
    spark.range(40).repartition(8).write.parquet(folder)
    old = set(storage.file_sizes(spark, folder))
    real = storage.rename
    monkeypatch.setattr(storage, "rename", lambda *a: (_ for _ in ()).throw(OSError("crash")))
    with pytest.raises(OSError):
        compaction.compact_folder(spark, folder, 1 << 20)
    monkeypatch.setattr(storage, "rename", real)
    assert set(storage.file_sizes(spark, folder)) == old and spark.read.parquet(folder).count() == 40
    compaction.finish(spark, folder)
    assert len(storage.file_sizes(spark, folder)) == 1 and spark.read.parquet(folder).count() == 40
    assert [n for n in os.listdir(folder) if n.startswith(("_staged", "_comp"))] == []
    assert compaction.compact_folder(spark, folder, 1 << 20) == 0


def test_journal_half_done(spark):
    folder = scratch_path(spark, "half")
    spark.range(10).repartition(2).write.parquet(folder)
    names = sorted(storage.file_sizes(spark, folder))
    spark.range(10).coalesce(1).write.parquet(f"{folder}/_staged-x")
    [new] = storage.file_sizes(spark, f"{folder}/_staged-x")
    storage.create_new(spark, f"{folder}/_compaction-x.json", json.dumps({"staged": "_staged-x", "new": [new], "old": names}))
    storage.rename(spark, f"{folder}/_staged-x/{new}", f"{folder}/{new}")
    storage.delete(spark, f"{folder}/{names[0]}")
    compaction.finish(spark, folder)
    assert list(storage.file_sizes(spark, folder)) == [new] and spark.read.parquet(folder).count() == 10


@pytest.mark.parametrize("numbers", [[], [5], [1, 2, 3], [3, 1, 10, 10, None, 4], [-5, 10**18, 0], [-2**63, 2**63 - 1], list(range(0, 3000, 7))])
def test_gaps_as_intervals(spark, numbers):
    df = spark.createDataFrame([(n,) for n in numbers], "v long").repartition(3)
    have = sorted({n for n in numbers if n is not None})
    want = [(a + 1, b - 1) for a, b in zip(have, have[1:], strict=False) if b > a + 1]
    assert sorted(tuple(r) for r in missing_ranges(spark, df, "v").collect()) == want


def test_a_batch_that_runs_again_replaces_itself(spark):
    table, log = scratch_path(spark, "batch-table"), scratch_path(spark, "batch-log")
    rows = spark.range(5).select(F.col("id").cast("string").alias("value"))
    for n in (0, 1, 1, 0):
        ds.load_batch(rows, n, "s", table, log)
    assert ds.UnitTable(spark, table).read("value string").count() == 10
    assert sorted(tuple(r) for r in ds.ledger(spark, log).read().collect()) == [("s", 0, 5), ("s", 1, 5)]
    ds.load_batch(rows.limit(0), 1, "s", table, log)
    assert ds.UnitTable(spark, table).read("value string").count() == 5


def meta(*cols):
    return [{"SOURCECOLNM": c, "RAW_COL_INHIVE": c.upper(), "RFND_COL_INHIVE": c.upper(), "RFND_COL_TYPE_INHIVE": t, "IS_EXTRACTED": "Y",
             "IS_PARTITIONED": p, "SEQ_NB": i} for i, (c, t, p) in enumerate(cols)]


def feed(spark, cols, **kw):
    base = scratch_path(spark, "round3")
    source = spark.createDataFrame([(i, dt.datetime(2024, 1, 1 + i % 6, 5), f"s{i % 2}" if i % 3 else None) for i in range(60)], "id long, ts timestamp_ntz, st string")
    return FeedSpec(kw.pop("feed", "F"), source, cols, f"{base}/raw", f"{base}/refined", delta_col="ts", **kw)


PLAIN = meta(("id", "BIGINT", "N"), ("ts", "DATE", "N"), ("st", "STRING", "N"))
BY_DATE = meta(("id", "BIGINT", "N"), ("ts", "DATE", "Y"), ("st", "STRING", "N"))


@pytest.mark.parametrize("cols,truncate", [(PLAIN, None), (BY_DATE, None), (PLAIN, "Y"), (BY_DATE, "Y"), (BY_DATE, "N")])
def test_bucketed_loads_replace_what_other_loads_replace(spark, cols, truncate):
    name = f"bucketed_{cols is PLAIN}_{truncate}".lower()
    s = feed(spark, cols, bucketing="CLUSTERED BY (ID) INTO 3 BUCKETS", table=name, truncate=truncate)
    for window in (("20240101", "20240103"), ("20240104", "20240105"), ("20240101", "20240103")):
        res = ingest(spark, s, *window)
    assert res["rowcount"] == res["refined_count"] == 30
    got = sorted(r.id for r in read_refined(spark, s, res["refined_schema"]).collect())
    want = [i for i in range(60) if i % 6 < (3 if truncate == "Y" else 5)]
    assert got == want
    # another session finds the rows by the path
    spark.sql(f"DROP TABLE {name}")
    assert sorted(r.id for r in read_refined(spark, s, res["refined_schema"]).collect()) == want
    s.source = s.source.where("day(ts) <> 2")
    res = ingest(spark, s, "20240101", "20240103")
    assert res["refined_count"] == 20 and not [r for r in read_refined(spark, s, res["refined_schema"]).collect() if r.ts.day == 2]
    spark.sql(f"DROP TABLE {name}")


def test_a_bucketing_clause_names_refined_columns(spark):
    with pytest.raises(ValueError, match="aren't refined columns"):
        ingest(spark, feed(spark, PLAIN, bucketing="CLUSTERED BY (NOBODY) INTO 2 BUCKETS", table="bucketed_nobody"), "20240101")


@pytest.mark.parametrize("cols,truncate", [(PLAIN, None), (BY_DATE, None), (PLAIN, "Y")])
def test_stored_profiles_equal_a_scan(spark, cols, truncate):
    s = feed(spark, cols, truncate=truncate, profile_path=scratch_path(spark, "profiles"))
    for window in (("20240101", "20240103"), ("20240104", "20240105"), ("20240101", "20240103")):
        res = ingest(spark, s, *window)
    s.source = s.source.where("day(ts) <> 2 AND day(ts) <> 4 AND day(ts) <> 5")
    for window in (("20240101", "20240103"), ("20240104", "20240105")):
        ingest(spark, s, *window)
    stored = merged_profile(profile_store(spark, s.profile_path), s.refined_path)
    full = null_profile(read_refined(spark, s, res["refined_schema"]).select("id", "ts", "st"))
    both = [sorted((r.column_name, r.n_rows or 0, r.null_pct) for r in x.where("column_name IN ('id', 'ts', 'st')").collect()) for x in (stored, full)]
    assert both[0] == both[1] and both[0][0][1] == (0 if truncate == "Y" else 20)


def test_feeds_of_the_metadata_are_checked_in_one_step(spark):
    cols = ("SOURCESCHEMA", "SOURCETBLNM", "TRGTTBLNM", "DB_TYPE", "HIVE_TBL_TRUNCATE", "DELTACOLUMN", "RFND_FILE_FMT", "SOURCE_SQL_TXT", "EXTRACTLANDINGDIR", "DELIMITER")
    rows = [("crm", "good", "good", "hive", "p", "ts", "", "", "/l", None), ("crm", "plain", "plain", "hive", "n", "", None, "", "/l", None),
            ("crm", "twice", "t", "hive", "", "", "", "", "", ""), ("CRM", "TWICE", "t", "hive", "", "", "", "", "", ""),
            ("crm", "none", "n", "hive", "", "", "", "", "", ""), ("crm", "type", "t", "cics", "", "", "", "", "", ""),
            ("crm", "mode", "t", "hive", "q", "", "", "", "", ""), ("crm", "fmt", "t", "hive", "", "", "csv", "", "", ""),
            ("crm", "p", "t", "hive", "p", "other", "", "", "", ""), ("crm", "file", "t", "file", "y", "other", "", "", "", ""), ("crm", "name", " ", "hive", "", "", "", "", "", "")]
    tables = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    named = ["good", "plain", "twice", "type", "mode", "fmt", "p", "file", "name"]
    columns = spark.createDataFrame([("CRM", n, *[r[k] for k in ("SOURCECOLNM", "RAW_COL_INHIVE", "RFND_COL_INHIVE", "RFND_COL_TYPE_INHIVE", "IS_EXTRACTED", "IS_PARTITIONED", "SEQ_NB")])
                                     for n in named for r in BY_DATE],
                                    "SOURCESCHEMA string, SOURCETBLNM string, SOURCECOLNM string, RAW_COL_INHIVE string, RFND_COL_INHIVE string, "
                                    "RFND_COL_TYPE_INHIVE string, IS_EXTRACTED string, IS_PARTITIONED string, SEQ_NB int")
    found = {(r.SOURCETBLNM, r.problem) for r in planned_feeds(tables, columns).collect()}
    assert found == {("GOOD", None), ("PLAIN", None), ("TWICE", "more than one table row"), ("NONE", "no column is extracted"), ("TYPE", "unknown source type"),
                     ("MODE", "unknown truncate mode"), ("FMT", "unknown file format"), ("P", "truncate P would replace other windows"),
                     ("FILE", "the delta column isn't in the file"), ("NAME", "no table name")}
    good = planned_feeds(tables, columns).where("SOURCETBLNM = 'GOOD'").first()
    assert good.settings == "HIVE|P|delta|table|date" and [c.SOURCECOLNM for c in good.feed_columns] == ["id", "ts", "st"]


def test_feed_settings_reach_the_spec():
    table = {"SOURCESCHEMA": "CRM", "SOURCETBLNM": "T", "TRGTTBLNM": "TT", "DB_TYPE": "ORACLE", "DB_SERVER": "h", "SPLIT_BY": "ID", "TGT_DB": "DM",
             "BUCKETINGCLAUSE": "CLUSTERED BY (ID) INTO 2 BUCKETS", "HIVE_RAW_DIR": "r", "HIVE_REFINED_DIR": "f"}
    s = feed_spec(table, PLAIN, "/b")
    assert s.jdbc["split_by"] == "ID" and s.table == "dm_tt" and s.schema == "CRM" and s.bucketing.startswith("CLUSTERED")
    s = feed_spec(dict(table, DB_TYPE="FILE", EXTRACTLANDINGDIR="/l/"), PLAIN, "/b", file_kind="xml", file_name="x.xml", row_tag="rec", key="id")
    assert (s.file["row_tag"], s.file["key"]) == ("rec", "id")


def test_split_reads_ask_for_their_bounds(spark):
    url = "jdbc:derby:memory:fw_bounds;create=true"
    write_jdbc(spark.range(10, 900).selectExpr("id", "id % 7 AS g"), "DERBY", url, "T_BOUNDS", mode="overwrite")
    df = scan_jdbc(spark, "DERBY", url, table="T_BOUNDS", split_by="ID")
    assert df.rdd.getNumPartitions() == 4 and df.count() == 890
    write_jdbc(spark.range(0).selectExpr("id"), "DERBY", url, "T_NONE", mode="overwrite")
    assert scan_jdbc(spark, "DERBY", url, table="T_NONE", split_by="id").count() == 0
    with pytest.raises(ValueError, match="to split by"):
        scan_jdbc(spark, "DERBY", url, table="T_BOUNDS", split_by="nobody")
