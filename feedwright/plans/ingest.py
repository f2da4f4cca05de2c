"""M3: ingest one feed window — extract, raw, refined, counts, sizes,
compaction, retention, audit.

One lazy plan per step; the writes are the only actions besides the refined
count. Counts of written rows come from ``Observation``s on the writes (no
re-scan; an empty window drops the observation and counts as no rows). Every
step appends an audit row (L6), saved at once when the feed names a status path,
so a failed run leaves its steps and a FAILED row. The run's last row is appended to the run status
at the end (L5; both are append-only logs, see ``sinks.event_log``); a run of a window that a run with stage L
already completed ends before it extracts anything (D8/M2). Run status is kept per (schema, feed).

What a load replaces: with truncate ``Y`` the table; with ``P``, or by default
where the first partition column is the delta column, the partitions it has rows for, and in a closed window (``between``, ``=``) the
window's other partitions too (days that have no rows any more); otherwise it appends a load unit
(``sinks.units``), which a repeated load of the same window replaces. So a run that fails after its
write can be repeated in every mode. ``P`` is refused where partitions don't imply the window, as it
would replace rows of other windows.
"""

from __future__ import annotations

import datetime as _dt
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedwright.operators.counts import refined_count_with_fallback
from feedwright.operators.jobstat import COMPLETED, EXTRACT_COMPLETED, JOBSTAT_SCHEMA, STATUS_SCHEMA, upsert
from feedwright.operators.metadata import add_partition_twins, project, projection_spec, raw_projection
from feedwright.operators.metrics import path_bytes
from feedwright.operators.postprocess import apply_postprocessors
from feedwright.operators.stored_profile import profile_store
from feedwright.operators.stored_profile import record as record_profile
from feedwright.sinks.compaction import compact_folder, finish
from feedwright.sinks.event_log import EventLog
from feedwright.sinks.bucketed import BucketedTable
from feedwright.sinks.tables import observed, parse_bucketing_clause, retention_candidates, write_partitioned
from feedwright.sinks.units import UNIT, UnitTable, unit_key
from feedwright.sources import storage
from feedwright.sources.jdbc import scan_jdbc
from feedwright.sources.scans import _as_date, scan_delta, scan_refined, scan_sql

# Audit status messages per step.
ST_GENERATE = "GENERATE EXTRACT SCRIPT"
ST_EXTRACT = "START EXECUTE SOURCE DB EXTRACT SCRIPT"
ST_EXTRACTED = "Completed Execute source db script"
ST_LOADED = "Completed Loading data to Hive"
ST_DONE = "COMPLETED SUCCESSFULLY"
ST_FAILED = "FAILED"

# The stage letters (G generate, E extract, L load, F custom SQL
# from the metadata, Q quality, P folder post-processing) and the combinations
# a run may ask for.
STAGES = {"G", "E", "L", "F", "Q", "P"}
ALLOWED_STAGES = ("G", "GE", "GEL", "GL", "GQ", "Q", "GLQ", "GELQ", "GF", "GEF", "GELF", "GLF", "GQF", "GELQF",
                  "GFE", "GEFL", "GEFLQ", "GEQLF", "GFEL", "P")


def check_stages(stages: str) -> str:
    """Refuse combinations outside the allowed list and runs without G. P
    (edge-node folder post-processing) is not built; F without custom SQL is
    refused by ``ingest``."""
    st = (stages or "").upper()
    if st not in ALLOWED_STAGES:
        raise ValueError(f"stage combination {stages!r} is not allowed: {ALLOWED_STAGES}")
    if st == "P":
        raise NotImplementedError("folder post-processing (P) is not built; use FeedSpec.postprocess")
    if "G" not in st:
        raise ValueError("extraction, load or quality check need script generation: include G")
    return st


@dataclass
class FeedSpec:
    feed: str
    source: DataFrame | None
    col_meta: list[dict]
    raw_path: str
    refined_path: str
    delta_col: str | None = None
    delta_type: str = "DATE"
    delta_fmt: str = "yyyyMMdd"
    operator: str = "between"
    truncate: str | None = None            # Y, P, N; None: the window where partitions imply it, else append
    raw_retention: int | None = 0
    refined_retention: int | None = 0
    db_type: str = "HIVE"
    replicas: int = 3
    raw_file_bytes: int = 256 * 1024 * 1024   # compaction target per raw file
    postprocess: object = None
    publish_path: str | None = None        # where the post-processed window is written
    source_sql: str | None = None          # custom extract (text or file) replacing the delta predicate
    source_views: dict = field(default_factory=dict)
    jdbc: dict | None = None               # relational source: scan_jdbc arguments (A6/A7)
    file: dict | None = None               # file source: sources.feeds.open_file arguments (A5, A8, A9, A10, A12)
    refined_format: str = "parquet"
    status_path: str | None = None         # run status and audit are kept here
    bucketing: str = ""                    # CLUSTERED BY (refined columns) INTO n BUCKETS: the refined table is a bucketed one
    table: str = ""                        # its name in the catalog
    profile_path: str | None = None        # null counts per partition are kept here (operators.stored_profile)
    schema: str = ""                       # the source schema: run status is kept per (schema, feed)
    extra: dict = field(default_factory=dict)


def status_table(spark: SparkSession, status_path: str) -> EventLog:
    """The durable run status below a status path: the last row of every run."""
    return EventLog(spark, f"{status_path.rstrip('/')}/jobstat", STATUS_SCHEMA, ("schema_name", "feed"),
                    ("schema_name", "feed", "jobpid"))


def audit_log(spark: SparkSession, status_path: str) -> EventLog:
    """All audit events below a status path."""
    return EventLog(spark, f"{status_path.rstrip('/')}/audit", STATUS_SCHEMA, ("schema_name", "feed"))


def audit_table(spark: SparkSession, status_path: str) -> DataFrame:
    """All audit rows saved below a status path."""
    return audit_log(spark, status_path).read()


def purge_path_partitions(spark: SparkSession, table_path: str, col: str, run_date, retention,
                          units: UnitTable | None = None) -> list[str]:
    """L8 on a path table: drop partitions older than ``run_date - retention`` (in every load unit, if it has units).
    Candidates come from the folder names of the first level; values that are no date stay."""
    if retention in (None, 0, ""):
        return []
    values = units.partition_values(col) if units else storage.partition_values(spark, table_path, col)
    parts = spark.createDataFrame([(v,) for v in values], f"`{col}` string")
    old = [r[0] for r in retention_candidates(parts, col, _as_date(run_date), int(retention)).collect()]
    if units:
        units.drop_partitions(col, old)
    else:
        for v in old:
            storage.delete(spark, f"{table_path.rstrip('/')}/{col}={v}")
    return sorted(old)


def persist_jobstat(spark: SparkSession, state: DataFrame, name: str = "run_status") -> str:
    """A one-off copy of a run-status table; ``status_table`` keeps the durable one."""
    from feedwright.sinks.tables import new_version
    return new_version(spark, state, name)


def _is_date(type_name: str) -> bool:
    return type_name.upper().startswith(("DATE", "TIMESTAMP"))


def partitions_imply_window(spec: FeedSpec, cols: list[dict]) -> bool:
    """Whether the first partition column is the delta column of a date window (for a
    custom extract: any date), so that the partitions of a window hold that window only."""
    ptn = [r for r in cols if str(r.get("IS_PARTITIONED", "N")).upper() == "Y"]
    if not ptn or not _is_date(str(ptn[0]["RFND_COL_TYPE_INHIVE"])):
        return False
    if spec.source_sql:
        return True
    return bool(spec.delta_col) and spec.delta_col.lower() == str(ptn[0]["SOURCECOLNM"]).lower()


def truncate_mode(spec: FeedSpec, cols: list[dict]) -> str:
    """Y, P or N after the rules above."""
    mode = (spec.truncate or "").upper()
    if mode == "Y":
        return "Y"
    if mode == "P" and not partitions_imply_window(spec, cols):
        raise ValueError(f"{spec.feed}: truncate P would replace rows outside the loaded window; "
                         "partition by the delta date first, or use N")
    return "P" if mode == "P" or (not mode and partitions_imply_window(spec, cols)) else "N"


def ingest(spark: SparkSession, spec: FeedSpec, from_date, end_date=None, run_date=None, stages: str = "GEL",
           jobpid: int | None = None, jobstat: DataFrame | None = None, override: bool = False) -> dict:
    """One window of one feed. With a status path (or a ``jobstat`` frame and no ``override``) a
    window that already completed returns ``{"decision": "GRACEFUL_EXIT"}`` and loads nothing."""
    stages = check_stages(stages)
    if "F" in stages and not spec.source_sql:
        raise ValueError("stage F needs the custom extract SQL (SOURCE_SQL_TXT)")
    cols = projection_spec(spec.col_meta)
    mode = truncate_mode(spec, cols)
    from_d = _as_date(from_date)
    end_d = _as_date(end_date) if end_date else from_d          # R28
    run_d = _as_date(run_date) if run_date else from_d
    table = status_table(spark, spec.status_path) if spec.status_path else None
    if table is not None and not override and "L" in stages:
        # runs that loaded complete a window; an extract alone doesn't (rows without stages are from elsewhere)
        state = table.read({"schema_name": spec.schema, "feed": spec.feed})
        done = state.where((F.col("status") == COMPLETED) & (F.col("stages").isNull() | F.col("stages").contains("L"))
                           & (F.col("filedate") == F.lit(from_d)) & (F.col("file_end_dt") == F.lit(end_d)))
        if done.limit(1).count():
            return {"decision": "GRACEFUL_EXIT", "jobstat": table.read() if jobstat is None else jobstat, "from_date": from_d,
                    "end_date": end_d}
    jobpid = jobpid if jobpid is not None else int(time.time() * 1000)
    audit: list[tuple] = []
    info = {"decision": "RUN", "raw_size": 0, "raw_replica_size": 0, "refined_size": 0, "refined_replica_size": 0,
            "linecount": 0, "rowcount": 0, "refined_count": 0, "partition_col": ""}
    loaddate = from_d.strftime("%Y%m%d")
    started = _dt.datetime.now().replace(microsecond=0)

    def log(status: str, message: str = ""):
        audit.append((spec.feed, jobpid, f"{spec.feed.lower()}_{loaddate}", started,
                      _dt.datetime.now().replace(microsecond=0), info["linecount"], info["rowcount"], from_d, status,
                      message, info["raw_size"], info["raw_replica_size"], info["refined_size"],
                      info["refined_replica_size"], info["partition_col"], end_d, info["refined_count"], spec.schema, stages))
        if spec.status_path:
            audit_log(spark, spec.status_path).append(spark.createDataFrame(audit[-1:], STATUS_SCHEMA))

    try:
        _run(spark, spec, cols, mode, stages, from_d, end_d, run_d, loaddate, jobpid, info, log)
    except Exception as e:
        log(ST_FAILED, f"{type(e).__name__}: {str(e)[:500]}")
        raise
    last = spark.createDataFrame(audit[-1:], STATUS_SCHEMA)      # the run's final status row
    if table is not None:
        table.append(last)
    if jobstat is None and table is not None:
        state = table.read()
    else:
        row = last.select(*(jobstat.columns if jobstat is not None else JOBSTAT_SCHEMA.names))
        state = upsert(jobstat, row) if jobstat is not None else row
    return {"audit": spark.createDataFrame(audit, STATUS_SCHEMA), "jobstat": state, **info, "from_date": from_d,
            "end_date": end_d, "loaddate": loaddate}


def bucketed_table(spark: SparkSession, spec: FeedSpec, schema, mode: str, partition_cols: list[str]) -> BucketedTable:
    """The refined table of a feed with a bucketing clause."""
    cols, n = parse_bucketing_clause(spec.bucketing)
    name = spec.table or "_".join(x for x in (spec.schema, spec.feed) if x).lower()
    return BucketedTable(spark, name, spec.refined_path, schema, n, cols, [*([UNIT] if mode == "N" else []), *partition_cols], spec.refined_format)


def read_refined(spark: SparkSession, spec: FeedSpec, schema) -> DataFrame:
    """The refined table of a feed; of an append table the published units only."""
    if spec.bucketing:
        cols = projection_spec(spec.col_meta)
        ptn = [f"{r['RFND_COL_INHIVE'].lower()}_ptn" for r in cols if str(r.get("IS_PARTITIONED", "N")).upper() == "Y"]
        return bucketed_table(spark, spec, schema, truncate_mode(spec, cols), ptn).read().drop(UNIT)
    if truncate_mode(spec, projection_spec(spec.col_meta)) == "N":
        return UnitTable(spark, spec.refined_path, spec.refined_format).read(schema)
    return spark.read.schema(schema).format(spec.refined_format).load(spec.refined_path)


def _extract(spark: SparkSession, spec: FeedSpec, from_d, end_d) -> DataFrame:
    if spec.source_sql:
        # A4: the custom SQL replaces the generated extract; the window is
        # bound as parameters <<FROM_DT>> / <<END_DT>> (dates)
        return scan_sql(spark, spec.source_sql, {"FROM_DT": from_d, "END_DT": end_d}, spec.source_views or None)
    if spec.jdbc:
        # A relational source is read through JDBC (split-column
        # parallel read); the delta predicate is pushed into its query
        source = scan_jdbc(spark, **spec.jdbc)
    elif spec.file:
        from feedwright.sources.feeds import open_file
        source = open_file(spark, from_d, **spec.file)
    else:
        source = spec.source
    return scan_delta(source, spec.delta_col, spec.operator, from_d, end_d if spec.operator == "between" else None,
                      col_type=spec.delta_type, col_fmt=spec.delta_fmt)


def _has_rows(df: DataFrame) -> bool:
    return df.limit(1).count() > 0


def _run(spark, spec, cols, mode, stages, from_d, end_d, run_d, loaddate, jobpid, info, log) -> None:
    ptn_src = [r["RFND_COL_INHIVE"].lower() for r in cols if str(r.get("IS_PARTITIONED", "N")).upper() == "Y"]
    info["partition_col"] = ",".join(f"{c}_ptn" for c in ptn_src)            # R13
    raw_folder = f"{spec.raw_path.rstrip('/')}/loaddate={loaddate}"
    if "G" in stages:
        log(ST_GENERATE)

    raw_schema = None
    if "E" in stages:
        log(ST_EXTRACT)
        raw = raw_projection(_extract(spark, spec, from_d, end_d), cols)
        raw_schema = raw.schema
        obs = Observation(f"extract_{jobpid}")
        write_partitioned(raw.withColumn("loaddate", F.lit(loaddate)).observe(obs, F.count(F.lit(1)).alias("n")),
                          spec.raw_path, ["loaddate"], truncate="P")
        info["linecount"] = info["rowcount"] = int(observed(obs).get("n", 0))
        if not info["rowcount"]:
            storage.delete(spark, raw_folder)      # a dynamic overwrite without rows leaves the old partition
        info["raw_size"], info["raw_replica_size"] = path_bytes(spark, raw_folder, spec.replicas)
        log(ST_EXTRACTED)

    def raw_window() -> DataFrame:
        if storage.exists(spark, raw_folder):
            finish(spark, raw_folder)      # of a compaction that broke off
            reader = spark.read.schema(raw_schema) if raw_schema is not None else spark.read
            return reader.parquet(raw_folder)
        if raw_schema is None:
            raise FileNotFoundError(f"{spec.feed}: nothing was extracted for {loaddate}")
        return spark.createDataFrame([], raw_schema)

    refined_schema = None
    first_ptn = f"{ptn_src[0]}_ptn" if ptn_src else None
    lo, hi = from_d.strftime("%Y%m%d"), end_d.strftime("%Y%m%d")
    closed = bool(spec.source_sql) or spec.operator.strip().lower() in ("between", "=")
    bucketed: BucketedTable | None = None
    units = UnitTable(spark, spec.refined_path, spec.refined_format) if mode == "N" and not spec.bucketing else None
    unit = unit_key("between" if spec.source_sql else spec.operator, from_d, end_d) if mode == "N" else None
    loaded: list[str] | None = None        # with P: the partitions that this load has rows for
    date_ptn = bool(ptn_src) and any(_is_date(str(r["RFND_COL_TYPE_INHIVE"])) for r in cols
                                     if r["RFND_COL_INHIVE"].lower() == ptn_src[0])

    def window_folders() -> list[str]:
        """Folders of the refined rows of this window: its unit, its partitions, or the whole table."""
        if units:
            folder = units.folders().get(unit)
            return [folder] if folder else []
        if unit:
            return [f"{UNIT}={unit}"]
        if not date_ptn:
            return storage.names(spark, spec.refined_path)
        if not closed and loaded is not None:
            return loaded
        return [f"{first_ptn}={v}" for v in storage.partition_values(spark, spec.refined_path, first_ptn) if lo <= v <= hi]

    def refined_window() -> DataFrame:
        if units:
            schema = refined_schema
            if schema is None:             # no load in this run: the schema is the unit's own
                schema = spark.read.format(spec.refined_format).load(
                    [f"{spec.refined_path.rstrip('/')}/{f}" for f in window_folders()]).schema if window_folders() else raw_window().schema
            return units.read(schema, [unit])
        if spec.bucketing:
            table = (bucketed or bucketed_table(spark, spec, spark.read.format(spec.refined_format).load(spec.refined_path).drop(UNIT).schema, mode,
                                                [f"{c}_ptn" for c in ptn_src])).read()
            if unit:
                return table.where(F.col(UNIT) == unit).drop(UNIT)
        elif date_ptn and refined_schema is not None:
            # the window's folders only: the cost of listing doesn't grow with the other days of the table
            folders = [f"{spec.refined_path.rstrip('/')}/{f}" for f in window_folders()]
            if not folders:
                return spark.createDataFrame([], refined_schema)
            table = spark.read.schema(refined_schema).option("basePath", spec.refined_path).format(spec.refined_format).load(folders)
        else:
            reader = spark.read.schema(refined_schema) if refined_schema is not None else spark.read
            table = reader.format(spec.refined_format).load(spec.refined_path)
        if not date_ptn:
            return table
        table = table.withColumn(first_ptn, F.col(first_ptn).cast("string"))
        if not closed and loaded is not None:
            days = [v.partition("=")[2] for v in loaded]
            return table.where(F.col(first_ptn).isin(days)) if days else table.limit(0)
        return scan_refined(table, first_ptn, from_d, end_d)

    if "L" in stages:
        raw_part = raw_window()
        # Values that fail the cast become null; their number per column is
        # observed on the same write (no second scan)
        rejects = Observation(f"rejects_{jobpid}")
        checked = raw_part.observe(rejects, F.count(F.lit(1)).alias("_rows"), *[
            F.count_if(F.col(r["RAW_COL_INHIVE"].lower()).isNotNull()
                       & F.col(r["RAW_COL_INHIVE"].lower()).try_cast(r["RFND_COL_TYPE_INHIVE"]).isNull())
            .alias(r["RFND_COL_INHIVE"].lower()) for r in cols])
        refined, _ptn_list, _dq_col = add_partition_twins(project(checked, cols, "RAW_COL_INHIVE"), ptn_src)
        info["refined_schema"] = refined_schema = refined.schema
        if spec.postprocess:
            apply_postprocessors(refined, spec.postprocess)      # switches that can't work are refused before the load
        if unit:
            info["unit"] = unit
        if spec.bucketing:
            bucketed = bucketed_table(spark, spec, refined.schema, mode, [f"{c}_ptn" for c in ptn_src])
            bucketed.load(refined, unit, replace_all=mode == "Y")
        elif units:
            units.load(refined, unit, [f"{c}_ptn" for c in ptn_src])
        else:
            write_partitioned(refined, spec.refined_path, [f"{c}_ptn" for c in ptn_src], truncate=mode, fmt=spec.refined_format)
        info["cast_rejects"] = {k: int(v) for k, v in observed(rejects).items() if k != "_rows" and v}
        emptied: list[str] = []
        if mode == "P":
            # partitions that this load has rows for: one small aggregate over the raw window
            twin = add_partition_twins(project(raw_part, cols, "RAW_COL_INHIVE"), ptn_src)[0].select(first_ptn).distinct()
            loaded = [f"{first_ptn}={r[0]}" for r in twin.collect() if r[0] is not None]      # at most one row per day of the window
            if closed:
                # only a closed window says which days it replaces; an open one leaves the days that it has no rows for
                emptied = [f.partition("=")[2] for f in sorted(set(window_folders()) - set(loaded))]
                if bucketed:
                    bucketed.drop(first_ptn, emptied)
                for v in emptied:
                    storage.delete(spark, f"{spec.refined_path.rstrip('/')}/{first_ptn}={v}")
        # Compact the raw partition unless raw data is not retained or the
        # source lands its own files; only small files that fit together are rewritten
        info["compacted"] = False
        if str(spec.raw_retention) != "-1" and "SQOOP" not in spec.db_type.upper():
            info["compacted"] = compact_folder(spark, raw_folder, spec.raw_file_bytes) > 0
        # Refined rows of the window, with the received-count fallback
        counted = refined_count_with_fallback(
            spark.createDataFrame([(spec.feed, info["rowcount"])], "feed string, received_count long"),
            refined_window().agg(F.count(F.lit(1)).alias("refined_count")).withColumn("feed", F.lit(spec.feed)), ["feed"])
        info["refined_count"] = int(counted.first()["final_count"])
        if spec.profile_path:
            store = profile_store(spark, spec.profile_path)
            window = refined_window()
            key = first_ptn if mode == "P" else F.lit(unit or "all")
            known = [] if mode != "N" else [r[0] for r in store.read({"table": spec.refined_path}).select("partition").distinct().collect() if r[0] == unit]
            # a unit or table without rows has no partition to count: zeros stand for it
            gone = emptied or ([unit or "all"] if mode != "P" and not _has_rows(window) and (known or mode == "Y") else [])
            record_profile(store, window, spec.refined_path, key, gone)
        info["raw_size"], info["raw_replica_size"] = path_bytes(spark, raw_folder, spec.replicas)
        info["refined_size"], info["refined_replica_size"] = path_bytes(
            spark, spec.refined_path, spec.replicas, window_folders() if date_ptn or units else None)
        purged_ref = []
        if mode != "P" and date_ptn:
            purged_ref = purge_path_partitions(spark, spec.refined_path, first_ptn, run_d, spec.refined_retention, units)
        rej = ", ".join(f"{k} {v}" for k, v in sorted(info["cast_rejects"].items()))
        note = f", refined {len(purged_ref)}" + (f"; cast rejects: {rej}" if rej else "")
    else:
        note = ""
    if "Q" in stages:
        # M5 after the load: null profile of the raw window under its refined names
        # against the refined window (one aggregate per side, compared by name)
        from feedwright.plans.validate import validate_tables
        raw_q = raw_window().select([F.col(f"`{r['RAW_COL_INHIVE'].lower()}`").alias(r["RFND_COL_INHIVE"].lower()) for r in cols])
        ref_q = refined_window().drop(*[f"{c}_ptn" for c in ptn_src])
        found = validate_tables(raw_q, ref_q)
        rows = found.collect()                    # one row per column; the raw window may be purged below
        info["quality"] = spark.createDataFrame(rows, found.schema)
        # a column whose share of nulls grew was nulled by the cast
        flagged = info["quality"].where("null_defer OR full_null_right OR right_pct > left_pct").count()
        log("DATA QUALITY CHECKED", f"{flagged} column(s) flagged")
    if "E" in stages or "L" in stages:            # after an extract-only run as well
        purged_raw = purge_path_partitions(spark, spec.raw_path, "loaddate", run_d, spec.raw_retention)
        if "L" in stages:
            log(ST_LOADED, f"purged raw {len(purged_raw)}" + note)

    if spec.postprocess:
        published = apply_postprocessors(refined_window(), spec.postprocess)
        if spec.publish_path:
            published.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
                f"{spec.publish_path.rstrip('/')}/window={lo}-{hi}")
            published = spark.read.parquet(f"{spec.publish_path.rstrip('/')}/window={lo}-{hi}")
        info["postprocessed"] = published
    if "L" in stages:
        log(ST_DONE)
    elif "E" in stages:
        log(EXTRACT_COMPLETED)             # the extract's line count can be looked up, its window isn't loaded
