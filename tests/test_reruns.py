"""Load units, the event log, and loads that are repeated after a failure."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedwright.plans.ingest import FeedSpec, audit_table, ingest, read_refined, status_table
from feedwright.plans.run_feeds import run_feeds
from feedwright.session import scratch_path
from feedwright.sinks.event_log import EventLog
from feedwright.sinks.tables import VersionedTable
from feedwright.sinks.units import UnitTable, unit_key
from feedwright.sources import storage

SCHEMA = T.StructType([T.StructField("feed", T.StringType()), T.StructField("run", T.LongType()), T.StructField("state", T.StringType())])


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def log(spark, path=None, keys=("feed", "run"), **kw):
    return EventLog(spark, path or scratch_path(spark, "log"), SCHEMA, ("feed",), keys, **kw)


def got(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_the_last_row_of_a_key_counts(spark):
    a = log(spark)
    assert a.read().collect() == [] and a.versions() == []
    a.append(rows(spark, ("A", 1, "started"), ("B", 1, "started")))
    a.append(rows(spark, ("A", 1, "done")))
    a.append(rows(spark, ("A", 1, "again"), (None, 2, None)))
    assert sorted(map(str, a.read().collect())) == sorted(map(str, rows(spark, ("A", 1, "again"), ("B", 1, "started"), (None, 2, None)).collect()))
    assert got(a.read({"feed": "A"})) == [("A", 1, "again")] and a.read({"feed": "C"}).count() == 0


def test_a_write_without_commit_counts_for_nothing_and_blocks_nothing(spark):
    a = log(spark)
    a.append(rows(spark, ("A", 1, "x")))
    real, a._commit = a._commit, lambda *args: (_ for _ in ()).throw(OSError("lost before the commit"))
    with pytest.raises(OSError):
        a.append(rows(spark, ("A", 2, "x")))
    a._commit = real
    # a claim whose writer died before it wrote the content
    bucket = storage.names(spark, f"{a.path}/commits")[0]
    assert storage.create_new(spark, f"{a.path}/commits/{bucket}/{2:012d}", "")
    assert got(a.read()) == [("A", 1, "x")]
    a.append(rows(spark, ("A", 2, "y")))
    assert got(a.read()) == [("A", 1, "x"), ("A", 2, "y")] and a.versions() == [1, 3]
    assert a.vacuum(older_than_seconds=0) == 1 and got(a.read()) == [("A", 1, "x"), ("A", 2, "y")]


def test_events_without_keys_are_all_kept_through_merges(spark):
    path = scratch_path(spark, "events")
    a = log(spark, path, keys=(), fan_in=3, grace=0)
    want = []
    for i in range(10):
        a.append(rows(spark, ("A", i, "s"), ("A", i, "s")))
        want += [("A", i, "s")] * 2
        assert got(a.read()) == sorted(want)
    [bucket] = storage.names(spark, f"{path}/commits")
    assert len(storage.names(spark, f"{path}/commits/{bucket}")) <= 6
    assert len(storage.names(spark, f"{path}/data")) <= 6


def test_the_second_of_two_merges_doesnt_count(spark):
    path = scratch_path(spark, "merges")
    a = log(spark, path, keys=(), fan_in=2)
    for i in range(2):
        a.append(rows(spark, ("A", i, "s")), merge=False)
    [bucket] = map(int, storage.names(spark, f"{path}/commits"))
    b = log(spark, path, keys=(), fan_in=2)
    stale = b._commits(bucket)
    assert a.merge(bucket) == 3
    b._commits = lambda _b: stale          # it looked before the other merge was committed
    assert b.merge(bucket) == 4
    assert got(a.read()) == [("A", 0, "s"), ("A", 1, "s")]
    a.append(rows(spark, ("A", 2, "s")), merge=False)
    late = log(spark, path, keys=(), fan_in=2, grace=0)
    late.merge(bucket)
    assert got(late.read()) == [("A", 0, "s"), ("A", 1, "s"), ("A", 2, "s")]
    assert 4 not in late.versions() and 1 not in late.versions()


def test_writers_side_by_side(spark):
    path = scratch_path(spark, "side-by-side")
    logs = [log(spark, path, buckets=1, fan_in=4) for _ in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: logs[i % 4].append(rows(spark, (f"F{i % 3}", i, "s"))), range(12)))
    assert got(logs[0].read()) == sorted((f"F{i % 3}", i, "s") for i in range(12))
    assert len(set(logs[0].versions())) == len(logs[0].versions())


def test_a_failed_version_isnt_given_again(spark):
    t = VersionedTable(spark, scratch_path(spark, "versions"), "id long")
    t.save(spark.range(1))
    with pytest.raises(Exception, match="dies"):
        t.save(spark.range(3).select(F.expr("raise_error('dies')").cast("long").alias("id")))
    assert t.read().count() == 1
    assert t.save(spark.range(2)) == 3 and t.read().count() == 2


def test_units_replace_themselves(spark):
    t = UnitTable(spark, scratch_path(spark, "units"))
    schema = spark.range(1).schema
    assert t.read(schema).count() == 0
    a, b = unit_key("between", dt.date(2024, 1, 1), dt.date(2024, 1, 2)), unit_key(">", dt.date(2024, 1, 1), dt.date(2024, 1, 1))
    assert (a, b) == ("in-20240101-20240102", "gt-20240101")
    t.load(spark.range(3), a, [])
    t.load(spark.range(10, 12), b, [])
    t.load(spark.range(5), a, [])
    assert sorted(r.id for r in t.read(schema).collect()) == [0, 1, 2, 3, 4, 10, 11]
    assert [r.id for r in t.read(schema, [b]).orderBy("id").collect()] == [10, 11]
    assert t.folders() == {a: f"load_unit={a}@2", b: f"load_unit={b}@1"} and {r.unit for r in t.manifest().collect()} == {a, b}
    # a publication that came after, before the older folder is deleted
    storage.make_folder(spark, f"{t.path}/load_unit={b}@0")
    with pytest.raises(Exception, match="dies"):
        t.load(spark.range(3).select(F.expr("raise_error('dies')").cast("long").alias("id")), a, [])
    assert t.read(schema).count() == 7 and storage.names(spark, f"{t.path}/_staged") == []


def test_rows_from_before_the_units_stay(spark):
    path = scratch_path(spark, "before")
    spark.range(4).selectExpr("id", "id % 2 AS p").write.partitionBy("p").parquet(path)
    t = UnitTable(spark, path)
    t.load(spark.range(10, 12).selectExpr("id", "id % 2 AS p"), "in-1", ["p"])
    assert got(t.read("id long, p int")) == [(0, 0), (1, 1), (2, 0), (3, 1), (10, 0), (11, 1)]
    assert t.partition_values("p") == ["0", "1"]
    t.drop_partitions("p", ["1"])
    assert got(t.read("id long, p int")) == [(0, 0), (2, 0), (10, 0)]


def meta(*cols):
    return [{"SOURCECOLNM": c, "RAW_COL_INHIVE": c.upper(), "RFND_COL_INHIVE": c.upper(), "RFND_COL_TYPE_INHIVE": t, "IS_EXTRACTED": "Y",
             "IS_PARTITIONED": p, "SEQ_NB": i} for i, (c, t, p) in enumerate(cols)]


PLAIN = meta(("id", "BIGINT", "N"), ("ts", "DATE", "N"), ("st", "STRING", "N"))
BY_STATUS = meta(("id", "BIGINT", "N"), ("ts", "DATE", "N"), ("st", "STRING", "Y"))
BY_DATE = meta(("id", "BIGINT", "N"), ("ts", "DATE", "Y"), ("st", "STRING", "N"))


def spec(spark, cols, **kw):
    base = scratch_path(spark, "reruns")
    source = spark.createDataFrame([(i, dt.datetime(2024, 1, 1 + i % 6, 5), f"s{i % 2}") for i in range(60)], "id long, ts timestamp_ntz, st string")
    return FeedSpec(kw.pop("feed", "F"), source, cols, f"{base}/raw", f"{base}/refined", delta_col="ts", **kw)


@pytest.mark.parametrize("cols", [PLAIN, BY_STATUS])
def test_counts_quality_and_copy_are_of_the_loaded_unit(spark, cols):
    s = spec(spark, cols, postprocess="drop:st", publish_path=scratch_path(spark, "published"))
    ingest(spark, s, "20240101", "20240103")
    res = ingest(spark, s, "20240104", stages="GELQ")
    assert (res["rowcount"], res["refined_count"], res["postprocessed"].count()) == (10, 10, 10)
    assert {r.left_pct for r in res["quality"].collect()} == {0.0} and res["refined_size"] > 0
    assert read_refined(spark, s, res["refined_schema"]).count() == 40
    # the quality stage alone reads the unit that an earlier run loaded
    assert ingest(spark, s, "20240104", stages="GQ")["quality"].where("right_pct > 0").count() == 0


def test_a_switch_that_cant_work_is_refused_before_the_load(spark):
    s = spec(spark, PLAIN, postprocess="trim;upper:nowhere")
    with pytest.raises(Exception, match="nowhere"):
        ingest(spark, s, "20240101")
    assert not storage.exists(spark, s.refined_path)


def test_an_empty_rerun_empties_its_unit_only(spark):
    s = spec(spark, PLAIN)
    for d in ("20240101", "20240102"):
        res = ingest(spark, s, d)
    s.source = s.source.where("id < 0")
    assert ingest(spark, s, "20240101")["refined_count"] == 0
    assert {r.ts for r in read_refined(spark, s, res["refined_schema"]).collect()} == {dt.date(2024, 1, 2)}


def test_open_windows_keep_days_they_have_no_rows_for(spark):
    s = spec(spark, BY_DATE)
    ingest(spark, s, "20240101", "20240106")
    s.operator, s.source = ">=", s.source.where("day(ts) <> 5")
    res = ingest(spark, s, "20240103")
    assert res["rowcount"] == res["refined_count"] == 30
    assert storage.partition_values(spark, s.refined_path, "ts_ptn") == [f"2024010{d}" for d in range(1, 7)]


def test_one_name_in_two_schemas_and_extracts(spark):
    status = scratch_path(spark, "two")
    crm, ops = (spec(spark, BY_DATE, schema=n, status_path=status) for n in ("CRM", "OPS"))
    assert ingest(spark, crm, "20240101", stages="GE")["decision"] == "RUN"
    assert ingest(spark, crm, "20240101", stages="GL")["refined_count"] == 10
    assert ingest(spark, crm, "20240101")["decision"] == "GRACEFUL_EXIT"
    assert ingest(spark, ops, "20240101")["decision"] == "RUN"
    found = status_table(spark, status).read()
    assert {(r.schema_name, r.stages, r.status) for r in found.collect()} == {
        ("CRM", "GE", "EXTRACT_COMPLETED"), ("CRM", "GL", "COMPLETED SUCCESSFULLY"), ("OPS", "GEL", "COMPLETED SUCCESSFULLY")}
    assert audit_table(spark, status).where("schema_name = 'OPS'").count() == 5


def test_feeds_side_by_side(spark):
    good, bad = spec(spark, PLAIN, feed="GOOD"), spec(spark, PLAIN, feed="BAD")
    bad.source = bad.source.drop("st")
    report, results = run_feeds(spark, [(bad, "20240101", None), (good, "20240101", "20240102")], 2)
    found = {r.feed: r for r in report.collect()}
    assert (found["GOOD"].status, found["GOOD"].refined_count) == ("LOADED", 20)
    assert found["BAD"].status == "FAILED" and "st" in found["BAD"].message and set(results) == {("", "GOOD")}


def test_a_merge_is_as_many_files_as_its_size_needs(spark, monkeypatch):
    from feedwright.sinks import event_log
    for bound, keys in ((1, ()), (1, ("feed", "run")), (1 << 30, ())):
        monkeypatch.setattr(event_log, "MERGED_BYTES", bound)
        path = scratch_path(spark, "merge-files")
        a = log(spark, path, keys=keys, fan_in=3, grace=0, buckets=1)
        for i in range(3):
            a.append(rows(spark, *[("A", 1000 * i + j, "s") for j in range(300)]))
        assert len(storage.names(spark, f"{path}/commits/0")) == 1 and a.read().count() == 900
        (folder,) = storage.names(spark, f"{path}/data")
        n = len(storage.data_files(spark, f"{path}/data/{folder}/bucket=0"))
        assert n == 1 if bound > 1 else n > 1 or keys


def test_buckets_are_merged_side_by_side(spark):
    import threading
    a = log(spark, scratch_path(spark, "side"), buckets=4)
    together, seen = threading.Barrier(3, timeout=30), []
    a.merge = lambda b: (together.wait(), seen.append(b))
    a._merge_all([0, 1, 2])
    assert sorted(seen) == [0, 1, 2]


def test_a_window_is_counted_from_its_own_folders(spark, monkeypatch):
    base = scratch_path(spark, "own-folders")
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    source = spark.createDataFrame([(i, d, s) for i, d in enumerate(days) for s in "AB"] + [(99, None, "A")], "k int, d date, s string")
    meta = [{"SOURCECOLNM": c, "RAW_COL_INHIVE": c.upper(), "RFND_COL_INHIVE": c.upper(), "RFND_COL_TYPE_INHIVE": t, "IS_EXTRACTED": "Y",
             "IS_PARTITIONED": p, "SEQ_NB": i} for i, (c, t, p) in enumerate([("k", "INT", "N"), ("d", "DATE", "Y"), ("s", "STRING", "Y")])]
    spec = FeedSpec("OWN", source, meta, f"{base}/raw", f"{base}/refined", truncate="Y")
    opened, load = [], type(spark.read).load
    monkeypatch.setattr(type(spark.read), "load", lambda self, path=None, *a, **k: opened.append(path) or load(self, path, *a, **k))
    res = ingest(spark, spec, "20200105", "20200107", jobpid=1)
    assert res["rowcount"] == 81 and res["refined_count"] == 6
    assert opened == [[f"{base}/refined/d_ptn=202001{d:02d}" for d in (5, 6, 7)]]  # not the other 37 days
    assert ingest(spark, spec, "20210101", "20210102", jobpid=2)["refined_count"] == 81  # none in the window: the received count
    assert spark.read.schema(res["refined_schema"]).parquet(spec.refined_path).count() == 81
