"""M4: run the source and the target check of a DQ group and compare them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.operators.dq import CHECKS, bound_text, jdbc_check, jobstat_check_stats, reconcile, require_single_row, run_check, to_stats
from feedwright.sources.jdbc import scan_jdbc
from feedwright.sources.scans import scan_sql, scan_sql_per_row


def dq_reconcile(spark: SparkSession, source_check: dict, target_check: dict,
                 tolerance: float = 0.0) -> DataFrame:
    """Each check is ``{"db_type": ..., **arguments}`` for the registry."""
    src = run_check(spark, **source_check)
    tgt = run_check(spark, **target_check)
    return reconcile(src, tgt, tolerance)


def reconcile_scripts(spark: SparkSession, plan: DataFrame, load_script, params: dict | None = None,
                      views: dict | None = None, tolerance: float = 0.0, strict: bool = True,
                      jobstat: DataFrame | None = None, secrets: dict | None = None, target_type: str = "HIVE",
                      target: dict | None = None) -> DataFrame:
    """M4 with one script per sub-group, as the reference's DQ plans hold them.

    ``plan`` is the DQ plan of one group (B6: sub_group_nm, src_qry_scr,
    tgt_qry_scr, db_type, db_server, db_user, …) — metadata, one row per sub-group, so it
    is collected. ``load_script(name)`` returns the script text (or a path). Source
    scripts run on the row's source type through the check registry (a ``JOBSTAT`` row takes
    the run-status table, its sub-group naming ``feed|date``), target scripts on the target: with a relational ``target_type``
    on the server ``target["server"]`` as ``target["user"]`` (or the plan's own columns ``tgt_db_server`` and ``tgt_db_user``), never on
    the source's.

    Sub-groups that name the same script share it: a Spark script that uses ``SUB_GROUP`` runs once for all its sub-groups, with the
    sub-group as a column of a lateral join (one scan a side; per sub-group only where Spark can't decorrelate it), and one that
    groups by a ``sub_group`` column itself runs once anyway. A relational source gets one query per sub-group. All results are unioned and reconciled in one job; the one-row rule
    (R18) is checked on the unioned results of a side, in one job per side.
    """
    rows = plan.collect()
    empty = "sub_group string, stat string, src_value decimal(38,10), tgt_value decimal(38,10), diff decimal(38,10), dq_status string"
    if not rows:
        return spark.createDataFrame([], empty)

    def wide(db_type, place, text, args):
        if CHECKS.get(db_type) is jdbc_check:
            server, user = place
            return scan_jdbc(spark, db_type, server, query=bound_text(text, args), user=user, password=(secrets or {}).get(server))
        return scan_sql(spark, text, args, views)

    def source_place(row):
        return row["db_server"], row["db_user"] if "db_user" in row.asDict() else None

    def target_place(row):
        if CHECKS.get(target_type.upper()) is not jdbc_check:
            return None, None
        row = row.asDict()
        server = row.get("tgt_db_server") or (target or {}).get("server")
        if not server:
            raise ValueError(f"a {target_type} target needs a server: target={{'server': ...}} or the plan's tgt_db_server")
        return server, row.get("tgt_db_user") or (target or {}).get("user")

    def side(script_col, type_of, place_of):
        done, results = set(), []
        for row in rows:
            db_type = type_of(row).upper()
            if db_type not in CHECKS:
                raise ValueError(f"no DQ check for source type {db_type!r}")
            if CHECKS[db_type] is jobstat_check_stats:
                if jobstat is None:
                    raise ValueError("a JOBSTAT check needs the run-status table")
                stats = jobstat_check_stats(spark, jobstat).where(F.col("sub_group") == row["sub_group_nm"])
                results.append((None, stats))
                continue
            text = load_script(row[script_col])
            per_group = "<<SUB_GROUP>>" in text.replace(" ", "") or ":SUB_GROUP" in text
            where = (row[script_col], db_type, place_of(row))
            if where in done:
                continue
            if per_group and CHECKS[db_type] is not jdbc_check:
                # every sub-group of the script in one scan
                same = {r["sub_group_nm"] for r in rows if (r[script_col], type_of(r).upper(), place_of(r)) == where}
                keys = spark.createDataFrame([(g,) for g in sorted(same)], "SUB_GROUP string")
                df = scan_sql_per_row(spark, text, keys, "SUB_GROUP", params, views)
                if df is not None:
                    done.add(where)
                    df = df.withColumn("sub_group", F.col("sub_group" if "sub_group" in df.columns else "fw_key").cast("string")).drop("fw_key")
                    results.append((df.select("sub_group"), to_stats(df)))
                    continue
            if not per_group:
                done.add(where)
            df = wide(db_type, place_of(row), text, dict(params or {}, **({"SUB_GROUP": row["sub_group_nm"]} if per_group else {})))
            if "sub_group" not in df.columns:
                df = df.withColumn("sub_group", F.lit(row["sub_group_nm"]))
            df = df.withColumn("sub_group", F.col("sub_group").cast("string"))
            results.append((df.select("sub_group"), to_stats(df)))
        if strict:
            groups = [g for g, _ in results if g is not None]
            want = [r["sub_group_nm"] for r in rows if CHECKS[type_of(r).upper()] is not jobstat_check_stats]
            if groups:
                require_single_row(reduce(DataFrame.unionByName, groups), expected=sorted(set(want)))
        return reduce(DataFrame.unionByName, [s for _, s in results])

    src = side("src_qry_scr", lambda r: r["db_type"], source_place)
    tgt = side("tgt_qry_scr", lambda r: target_type, target_place)
    return reconcile(src, tgt, tolerance)
