"""Format round trips: multi-line CSV, plain CSV, byte-level repair (batch and
stream), XML rows, malformed XML, XML feed to CSV, job definitions.

Each query writes data derived from a driver table below the shared checkpoint
folder, reads it back with the operator under test and returns the result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from feedwright.operators.metadata import project
from feedwright.operators.rules import job_numbers, missing_numbers, missing_ranges, naming_check as _naming_check
from feedwright.operators.rules import unnumbered_jobs as _unnumbered_jobs
from feedwright.plans.job_defs import parse_job_definitions
from feedwright.plans.xml_feed import read_feed_csv, xml_feed_to_csv as _xml_feed_to_csv
from feedwright.queries import register
from feedwright.session import in_session, scratch_path, with_fixed_splits
from feedwright.sinks.files import write_csv, write_lines, write_xml
from feedwright.sinks.units import UnitTable
from feedwright.sources import derive, storage
from feedwright.sources.files import _bytes, largest_file, latin1_line, read_first_n, read_multiline_csv, read_repaired_lines
from feedwright.sources.tables import read_table
from feedwright.sources.xml import read_xml_raw, read_xml_rows, xml_faults, xml_rows
from feedwright.streaming.delimiter_stream import ledger, start_delimiter_stream, start_ledger_stream

FILE_ROWS = 1000         # rows per landed CSV / line file (multi-line CSV: one task per file)
XML_FILE_ROWS = 20000    # rows per landed XML file
SPLIT_BYTES = 1 << 16    # a split of the single-file feeds, so that they are many tasks at any scale
SPLITS = 64              # beyond as many splits of that size, the splits grow with the file (up to the session's own size)
DOC_ROWS = 2000          # rows per XML document in the malformed feed

ORDERS_TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
ORDERS_TAGS = [c for c, _ in ORDERS_TYPES]


def _typed_orders(df):
    spec = [{"SOURCECOLNM": c, "RFND_COL_INHIVE": c, "RFND_COL_TYPE_INHIVE": t} for c, t in ORDERS_TYPES]
    return project(df, spec)


def _fine_splits(spark, path):
    """A session that reads the file at ``path`` by many tasks: splits of 64 kB, or as large as ``SPLITS`` of them need to be."""
    fine = with_fixed_splits(spark)
    usual = _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    size = -(-largest_file(spark, path) // SPLITS)
    fine.conf.set("spark.sql.files.maxPartitionBytes", max(SPLIT_BYTES, min(size, usual)))
    return fine


@register("csv_multiline", """
SELECT doc_id, substr(r, 2, length(r) - 2) AS text, lang FROM (
  SELECT doc_id, lang,
         list_reduce(string_split('"' || text || '"', chr(10)),
                     lambda a, b: a || CASE WHEN length(a) > 0 AND length(b) > 0 AND right(a, 1) <> ' '
                                                 AND left(b, 1) <> ' ' THEN ' ' ELSE '' END || b) AS r
  FROM documents)""")
def csv_multiline(spark, sf_dir):
    path = scratch_path(spark, "csv-multiline")
    write_csv(read_table(spark, sf_dir, "documents"), path, header=True, max_records_per_file=FILE_ROWS)
    df = read_multiline_csv(spark, path, 3)
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")


@register("csv_split", """
SELECT doc_id, substr(r, 2, length(r) - 2) AS text, lang, source FROM (
  SELECT doc_id, lang, source,
         list_reduce(string_split('"' || text || '"', chr(10)),
                     lambda a, b: a || CASE WHEN length(a) > 0 AND length(b) > 0 AND right(a, 1) <> ' '
                                                 AND left(b, 1) <> ' ' THEN ' ' ELSE '' END || b) AS r
  FROM documents)""")
def csv_split(spark, sf_dir):
    """A8 on one file: all documents land in a single quoted CSV file, which many tasks read (splits of 64 kB, larger
    ones where the file has more than ``SPLITS`` of them)."""
    path = scratch_path(spark, "csv-split")
    write_csv(read_table(spark, sf_dir, "documents").coalesce(1), path, header=True)
    fine = _fine_splits(spark, path)
    df = read_multiline_csv(fine, path, 4)
    return in_session(spark, df).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source")


@register("csv_first_n", "SELECT p_partkey, p_name, p_brand FROM part")
def csv_first_n(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    path = scratch_path(spark, "csv-first-n")
    write_lines(part.select(F.concat_ws("|", *[F.col(c).cast("string") for c in part.columns]).alias("value")),
                path, max_records_per_file=FILE_ROWS)
    df = read_first_n(spark, path, 3, "|")
    return df.select(F.col("_c0").cast("long").alias("p_partkey"), F.col("_c1").alias("p_name"),
                     F.col("_c2").alias("p_brand"))


def _foreign_lines(part):
    # p_partkey FE p_name FE DF p_brand DF " p_type " [CR]
    line = F.concat(F.col("p_partkey").cast("string"), F.lit("þ"), F.col("p_name"), F.lit("þß"), F.col("p_brand"),
                    F.lit("ß\""), F.col("p_type"), F.lit("\""),
                    F.when(F.col("p_size") % 2 == 0, F.lit("\r")).otherwise(F.lit("")))
    return part.select(latin1_line(line).alias("value"))


_REPAIR_DUCK = """
SELECT translate(CAST(p_partkey AS VARCHAR) || 'þ' || p_name || 'þß' || p_brand || 'ß"' || p_type || '"'
                 || CASE WHEN p_size % 2 = 0 THEN chr(13) ELSE '' END,
                 'þß"' || chr(13), chr(1) || '"') AS value
FROM part"""


@register("delimiter_repair", _REPAIR_DUCK)
def delimiter_repair(spark, sf_dir):
    path = scratch_path(spark, "latin1-lines")
    write_lines(_foreign_lines(read_table(spark, sf_dir, "part")), path, max_records_per_file=FILE_ROWS)
    return read_repaired_lines(spark, path)


@register("stream_delimiter", _REPAIR_DUCK)
def stream_delimiter(spark, sf_dir):
    in_dir = scratch_path(spark, "stream-in")
    out_dir = scratch_path(spark, "stream-out")
    write_lines(_foreign_lines(read_table(spark, sf_dir, "part")), in_dir, max_records_per_file=FILE_ROWS)
    q = start_delimiter_stream(spark, in_dir, out_dir, scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(out_dir)


@register("stream_ledger", f"""
WITH v AS ({_REPAIR_DUCK}) SELECT value, (SELECT count(*) FROM part) AS ledger_rows FROM v""")
def stream_ledger(spark, sf_dir):
    """S1 with L3/L6: the stream into a table by batches with a ledger. Its last batch runs twice (the run dies between the batch's
    writes and its commit), yet each line and each ledger row is there once."""
    in_dir, table, log, checkpoint = (scratch_path(spark, f"ledger-{n}") for n in ("in", "table", "log", "checkpoint"))
    lines = _foreign_lines(read_table(spark, sf_dir, "part"))
    write_lines(lines.repartition(5), in_dir)

    def run():
        q = start_ledger_stream(spark, in_dir, table, log, checkpoint, max_files_per_trigger=2)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))

    run()
    commits = [n for n in storage.names(spark, f"{checkpoint}/commits") if n.isdigit()]
    storage.delete(spark, f"{checkpoint}/commits/{max(commits, key=int)}")
    before = UnitTable(spark, table).folders()
    run()
    after = UnitTable(spark, table).folders()
    if len(commits) < 2 or set(before) != set(after) or before == after:
        raise RuntimeError("the last batch wasn't run again")
    rows = UnitTable(spark, table).read("value string")
    counted = ledger(spark, log).read().agg(F.sum("rows").alias("ledger_rows"))
    return rows.crossJoin(F.broadcast(counted))       # one row


@register("xml_roundtrip", "SELECT * FROM orders")
def xml_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "xml-orders")
    write_xml(read_table(spark, sf_dir, "orders"), path, "row", "rows", max_records_per_file=XML_FILE_ROWS)
    return _typed_orders(read_xml_rows(spark, path, "row", ORDERS_TAGS))


@register("xml_split", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderstatus || ' > </row>' END AS note, 'outer' AS part FROM orders UNION ALL
SELECT o_orderkey, -1, o_orderpriority, 'inner' FROM orders WHERE o_orderkey % 3 = 0""")
def xml_split(spark, sf_dir):
    """A10/A11 on one file without line breaks, read by many tasks (splits as in ``csv_split``): rows in comments and CDATA sections that are no rows,
    closing tags with blanks, ``>`` in attributes, rows inside rows."""
    k = F.col("o_orderkey")
    inner = F.when(k % 3 == 0, F.concat(F.lit("<row><k>"), k.cast("string"), F.lit("</k><note>"), F.col("o_orderpriority"), F.lit("</note></row >")))
    text = F.concat(F.lit("<row id='x>y'><!-- <row><k>0</k></row> --><k>"), k.cast("string"), F.lit("</k>"), F.coalesce(inner, F.lit("")),
                    F.lit("<c>"), F.col("o_custkey").cast("string"), F.lit("</c>"),
                    F.when(k % 5 == 0, F.lit("<note/>")).otherwise(F.concat(F.lit("<note><![CDATA["), F.col("o_orderstatus"), F.lit(" > </row>]]></note>"))),
                    F.when(k % 2 == 0, F.lit("</row >")).otherwise(F.lit("</row>")))
    path = scratch_path(spark, "xml-split")
    (read_table(spark, sf_dir, "orders").select(text.alias("value")).coalesce(1).write.option("lineSep", " ").text(path))
    fine = _fine_splits(spark, path)
    rows = read_xml_rows(fine, path, "row", ["k", "c", "note"], key="k")
    return in_session(spark, rows).select(F.col("k").cast("long").alias("o_orderkey"), F.when(F.col("c") == "", F.lit(-1)).otherwise(F.col("c").try_cast("long")).alias("o_custkey"),
                       "note", F.when(F.col("c") == "", F.lit("inner")).otherwise(F.lit("outer")).alias("part"))


@register("xml_malformed_prefix", """
SELECT *, (SELECT count(*) FROM orders WHERE o_orderkey % 89 < 2) AS faults FROM orders WHERE o_orderkey % 89 > 1""")
def xml_malformed_prefix(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    el = lambda c, v: F.concat(F.lit(f"<{c}>"), v, F.lit(f"</{c}>"))
    body = F.concat(
        el("o_orderkey", F.col("o_orderkey").cast("string")), el("o_custkey", F.col("o_custkey").cast("string")),
        el("o_orderstatus", F.col("o_orderstatus")), el("o_totalprice", F.col("o_totalprice").cast("string")),
        el("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")),
        el("o_orderpriority", F.col("o_orderpriority")))
    # every 89th record is cut (an element opened and never closed), and every 89th but one
    # is never closed itself: faults stand between good rows throughout each document
    cut, unclosed = F.col("o_orderkey") % 89 == 0, F.col("o_orderkey") % 89 == 1
    line = F.concat(F.lit("<row>"), body, F.when(cut, F.lit("<o_note>")).otherwise(F.lit("")),
                    F.when(unclosed, F.lit("")).otherwise(F.lit("</row>")))
    rows = orders.select(F.floor(F.col("o_orderkey") / DOC_ROWS).alias("doc"),
                         F.struct(F.col("o_orderkey"), line.alias("line")).alias("r"))
    docs = rows.groupBy("doc").agg(F.sort_array(F.collect_list("r")).alias("rs"))
    text = docs.select(F.concat(F.lit("<rows>\n"), F.array_join(F.transform("rs", lambda x: x["line"]), "\n"),
                                F.lit("\n</rows>")).alias("value"))
    path = scratch_path(spark, "xml-malformed")
    write_lines(text, path)
    raw = read_xml_raw(spark, path, "row", ORDERS_TAGS)
    rows = xml_rows(raw, ORDERS_TAGS)
    return _typed_orders(rows).withColumn("faults", F.lit(xml_faults(raw).first()["faults"]).cast("long"))


@register("xml_feed_to_csv", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderpriority END AS o_orderpriority,
       count(*) OVER () AS rows_written
FROM orders WHERE o_orderkey % 50 <> 0""")
def xml_feed_to_csv(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    feed = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 50 == 0, F.lit(None).cast("long")).otherwise(F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus", "o_totalprice", "o_orderdate",
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))
    xml_path = scratch_path(spark, "xml-feed")
    write_xml(feed, xml_path, "row", "rows", max_records_per_file=XML_FILE_ROWS)
    out = scratch_path(spark, "xml-feed-csv")
    res = _xml_feed_to_csv(spark, xml_path, "row", ORDERS_TAGS, out, key="o_custkey")
    back = _typed_orders(read_feed_csv(spark, out, ORDERS_TAGS))
    return back.withColumn("rows_written", F.lit(res["rows_written"]).cast("long"))


_JOBS_DUCK = """
WITH j AS (
  SELECT 'JB' || lpad(CAST((p_size * 17) % 1000 AS VARCHAR), 3, '0') || '-'
           || upper(split_part(p_type, ' ', 1)) || CAST(p_partkey AS VARCHAR) AS jobname,
         p_partkey AS k FROM part),
c AS (
  SELECT jobname,
         CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN 'PL-' || jobname || '-OK' WHEN 2 THEN 'WAIT'
                    WHEN 3 THEN 'WAIT-OK' ELSE 'PL-X' END AS incond,
         CASE WHEN k % 3 = 0 THEN 'PL-' || jobname || '-BAD' ELSE 'PL-' || jobname || '-OK' END AS outcond
  FROM j)
SELECT jobname, incond, outcond,
       (coalesce(incond, '') <> '' AND NOT contains(coalesce(incond, ''), 'PL-')
        AND NOT contains(coalesce(incond, ''), '-OK')) AS in_bad,
       coalesce(outcond <> 'PL-' || jobname || '-OK', true) AS out_bad
FROM c"""


def _jobs_frame(spark, sf_dir):
    return derive.job_definitions_from_part(read_table(spark, sf_dir, "part"))


@register("naming_check", _JOBS_DUCK)
def naming_check(spark, sf_dir):
    jobs = derive.job_conditions_from_part(read_table(spark, sf_dir, "part"))
    return _naming_check(jobs.select("jobname", "incond", "outcond"))


@register("job_definitions_check", _JOBS_DUCK)
def job_definitions_check(spark, sf_dir):
    path = scratch_path(spark, "job-defs")
    write_xml(_jobs_frame(spark, sf_dir), path, "JOB", "SMART_FOLDER",
              max_records_per_file=XML_FILE_ROWS)
    return _naming_check(parse_job_definitions(spark, path))


@register("sequence_gaps", """
WITH n AS (SELECT DISTINCT CAST((p_size * 17) % 1000 AS BIGINT) AS job_num FROM part)
SELECT g AS job_num
FROM (SELECT unnest(generate_series((SELECT min(job_num) FROM n), (SELECT max(job_num) FROM n))) AS g)
WHERE g NOT IN (SELECT job_num FROM n)""")
def sequence_gaps(spark, sf_dir):
    jobs = derive.job_conditions_from_part(read_table(spark, sf_dir, "part")).select("jobname")
    return missing_numbers(spark, job_numbers(jobs), "job_num")


@register("sequence_gap_ranges", """
WITH n AS (SELECT DISTINCT CAST(o_orderkey AS BIGINT) * o_orderkey * 1000 + o_custkey % 3 AS v FROM orders),
w AS (SELECT v, lead(v) OVER (ORDER BY v) AS nxt FROM n)
SELECT v + 1 AS first, nxt - 1 AS last FROM w WHERE nxt > v + 1""")
def sequence_gap_ranges(spark, sf_dir):
    """D6/H3 on sparse numbers (up to 10^11 apart at sf0.1): the gaps as intervals."""
    numbers = read_table(spark, sf_dir, "orders").selectExpr("o_orderkey * o_orderkey * 1000 + o_custkey % 3 AS v")
    return missing_ranges(spark, numbers, "v")


@register("unnumbered_jobs", """
SELECT DISTINCT p_name AS jobname FROM part
WHERE TRY_CAST(right(split_part(p_name, '-', 1), 3) AS INTEGER) IS NULL""")
def unnumbered_jobs(spark, sf_dir):
    """H2: names that hold no job number are reported, not dropped (part names stand in for job names)."""
    return _unnumbered_jobs(read_table(spark, sf_dir, "part").select(F.col("p_name").alias("jobname")))
