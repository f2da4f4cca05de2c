"""Property tests: Spark expressions against small plain-Python models of the
reference behaviour, on random inputs (one Spark job per example batch)."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedwright.functions.exprs import seam_repair, size_pretty
from feedwright.operators.profile import compare_profiles
from feedwright.session import scratch_path
from feedwright.sinks.files import write_csv
from feedwright.sources.files import read_multiline_csv

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def join_physical_lines(value: str) -> str:
    """Model of the line-joining loop: the quoted field's physical lines are
    appended one by one, with one space at a seam when the text so far and the
    next line are non-empty and neither side of the seam is a space. The
    opening and closing quotes are the neighbours at the field's ends."""
    lines = ('"' + value + '"').split("\n")
    acc = lines[0]
    for nxt in lines[1:]:
        if acc and nxt and acc[-1] != " " and nxt[0] != " ":
            acc += " "
        acc += nxt
    return acc[1:-1]


texts = st.lists(st.text(alphabet=["a", "b", " ", "\n", '"'], max_size=12), min_size=1, max_size=60)


@SETTINGS
@given(texts)
def test_seam_repair_matches_line_joining(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r.i: r.r for r in df.select("i", seam_repair("v").alias("r")).collect()}
    assert got == {i: join_physical_lines(v) for i, v in enumerate(values)}


@SETTINGS
@given(texts)
def test_multiline_csv_roundtrip_matches_line_joining(spark, values):
    path = scratch_path(spark, "prop-csv")
    df = spark.createDataFrame([(i, v, "z") for i, v in enumerate(values)], "i int, v string, z string")
    write_csv(df, path, header=True, max_records_per_file=7)
    back = read_multiline_csv(spark, path, 2)
    got = {int(r.i): r.v for r in back.collect()}
    # an empty value is written as "" and stays empty
    assert got == {i: join_physical_lines(v) for i, v in enumerate(values)}


def pretty_model(b: int) -> str:
    if abs(b) < 10240:
        return f"{b} bytes"
    for unit, shift in (("kB", 9), ("MB", 19), ("GB", 29)):
        half = b >> shift
        if abs(half) < 20479:
            return f"{(half + 1) >> 1} {unit}"
    return f"{((b >> 39) + 1) >> 1} TB"


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=2 ** 62), min_size=1, max_size=80))
def test_size_pretty_model(spark, sizes):
    df = spark.createDataFrame([(s,) for s in sizes], "b long")
    assert [r[0] for r in df.select(size_pretty("b")).collect()] == [pretty_model(s) for s in sizes]


pcts = st.one_of(st.none(), st.floats(min_value=0, max_value=100, allow_nan=False))


@SETTINGS
@given(st.lists(st.tuples(pcts, pcts), min_size=1, max_size=40))
def test_profile_flags_model(spark, pairs):
    left = spark.createDataFrame([(f"c{i}", 1, a) for i, (a, _) in enumerate(pairs)],
                                 "column_name string, n_rows long, null_pct double")
    right = spark.createDataFrame([(f"c{i}", 1, b) for i, (_, b) in enumerate(pairs)],
                                  "column_name string, n_rows long, null_pct double")
    got = {r.column_name: (r.null_defer, r.full_null_left, r.full_null_right)
           for r in compare_profiles(left, right).collect()}
    for i, (a, b) in enumerate(pairs):
        both = a is not None and b is not None
        defer = both and int(a) != int(b) and math.fabs(a - b) > 1.0
        assert got[f"c{i}"] == (defer, both and int(a) == 100, both and int(b) == 100)


def plan_model(req, dec, hwm, done):
    """Python model of the window decision, in the reference's order."""
    feed, ex_from, ex_end, override = req
    if ex_end is not None and ex_from is None:
        return "END_WITHOUT_FROM", None, None
    if ex_from is not None:
        f, e = ex_from, ex_end or ex_from
    else:
        if dec is None or dec[2] != 1:
            return "NO_CALENDAR", None, None
        eff, switch, _n = dec
        f = hwm + dt.timedelta(days=1) if hwm is not None else eff
        e = eff
        if e == f and switch == "N":
            return "NOT_SCHEDULED", f, e
        if f > e:
            return "ABORTED", f, e
    if (feed, f, e) in done and not override:
        return "GRACEFUL_EXIT", f, e
    return "RUN", f, e


days = st.dates(min_value=dt.date(2024, 1, 1), max_value=dt.date(2024, 1, 8))


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), days), st.one_of(st.none(), days), st.booleans(),
                          st.one_of(st.none(), st.tuples(days, st.sampled_from("YN"), st.integers(1, 2))),
                          st.one_of(st.none(), days), st.booleans()), min_size=1, max_size=25))
def test_plan_windows_model(spark, feeds):
    from feedwright.operators.jobstat import COMPLETED, JOBSTAT_SCHEMA
    from feedwright.plans.calendar import plan_windows
    reqs, decs, js_rows, done, expect = [], [], [], set(), {}
    for i, (ex_from, ex_end, override, dec, hwm, complete_window) in enumerate(feeds):
        feed = f"f{i}"
        reqs.append((feed, ex_from, ex_end, override))
        if dec is not None:
            decs.append((feed, dec[0], dec[1], dec[2]))
        t = dt.datetime(2024, 1, 1)
        if hwm is not None:
            js_rows.append((feed, 2 * i, "f", t, t, 1, 1, hwm, COMPLETED, "", 0, 0, 0, 0, "", hwm, 1))
            done.add((feed, hwm, hwm))
        if complete_window and ex_from is not None:
            e = ex_end or ex_from
            js_rows.append((feed, 2 * i + 1, "f", t, t, 1, 1, ex_from, COMPLETED, "", 0, 0, 0, 0, "", e, 1))
            done.add((feed, ex_from, e))
    for i, (ex_from, ex_end, override, dec, hwm, cw) in enumerate(feeds):
        feed = f"f{i}"
        hw = max([w[2] for w in done if w[0] == feed], default=None)
        expect[feed] = plan_model((feed, ex_from, ex_end, override), dec, hw, done)
    req_df = spark.createDataFrame(reqs, "feed string, explicit_from date, explicit_end date, override boolean")
    dec_df = spark.createDataFrame(decs, "feed string, eff_date date, run_switch string, n_calendar_rows long")
    js_df = spark.createDataFrame(js_rows, JOBSTAT_SCHEMA)
    got = {r.feed: (r.decision, r.from_date, r.end_date) for r in plan_windows(req_df, dec_df, js_df).collect()}
    for feed, (decision, f, e) in expect.items():
        assert got[feed][0] == decision, (feed, got[feed], expect[feed])
        if decision not in ("END_WITHOUT_FROM", "NO_CALENDAR"):
            assert got[feed][1:] == (f, e), (feed, got[feed], expect[feed])


def repair_model(raw: bytes) -> str:
    """Model of the byte-level repair: drop quotes and CR, then FE -> U+0001, DF -> quote."""
    s = raw.decode("latin-1")
    return s.replace('"', "").replace("\r", "").replace("\xfe", "\x01").replace("\xdf", '"')


@SETTINGS
@given(st.lists(st.binary(max_size=20).map(lambda b: b.replace(b"\n", b"")), min_size=1, max_size=60))
def test_delimiter_repair_model(spark, lines):
    from feedwright.functions.exprs import delimiter_repair
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(lines)], "i int, b binary")
    got = {r.i: r.v for r in df.select("i", delimiter_repair(F.col("b").cast("string")).alias("v")).collect()}
    assert got == {i: repair_model(b) for i, b in enumerate(lines)}


def naming_model(job, inc, out):
    inc_bad = inc not in (None, "") and "PL-" not in inc and "-OK" not in inc
    out_bad = ("PL-" + job + "-OK") != out
    head = job.split("-")[0][-3:]
    try:
        num = int(head)
    except ValueError:
        num = None
    return inc_bad, out_bad, num


names = st.text(alphabet=["A", "B", "1", "2", "-", "P", "L", "O", "K"], min_size=1, max_size=10)


@SETTINGS
@given(st.lists(st.tuples(names, st.one_of(st.none(), names), names), min_size=1, max_size=60))
def test_naming_rules_model(spark, jobs):
    from feedwright.functions.exprs import job_number, naming_flags
    df = spark.createDataFrame([(i, j, a, b) for i, (j, a, b) in enumerate(jobs)], "i int, j string, a string, b string")
    ib, ob = naming_flags(F.col("j"), F.col("a"), F.col("b"))
    got = {r.i: (r.ib, r.ob, r.n) for r in df.select("i", ib.alias("ib"), ob.alias("ob"),
                                                      job_number("j").alias("n")).collect()}
    assert got == {i: naming_model(j, a, b) for i, (j, a, b) in enumerate(jobs)}


vals = st.one_of(st.none(), st.just(""), st.text(alphabet=["a", "b", "z", " ", "1"], min_size=1, max_size=6))
records = st.lists(st.tuples(st.lists(vals, max_size=2), st.lists(vals, max_size=2)), min_size=1, max_size=25)


@SETTINGS
@given(records)
def test_xml_rows_model(spark, recs):
    """Each record has 0-2 <k> and 0-2 <v> children (None = empty element);
    model: first child wins, empty or absent gives '', rows without <k> are
    dropped when k is the key."""
    import os
    import xml.etree.ElementTree as ET
    from xml.sax.saxutils import escape

    from feedwright.sources.xml import read_xml_rows

    def el(tag, v):
        return f"<{tag}/>" if v is None else f"<{tag}>{escape(v)}</{tag}>"
    body = "".join("<row>" + "".join(el("k", v) for v in ks) + "".join(el("v", v) for v in vs) + "</row>"
                   for ks, vs in recs)
    doc = f"<R>{body}</R>"
    path = scratch_path(spark, "prop-xml")
    os.makedirs(path)
    with open(os.path.join(path, "a.xml"), "w") as fh:
        fh.write(doc)
    model_all, model_key = [], []
    for row in ET.fromstring(doc).findall("row"):
        vals_ = tuple((n.text or "") if (n := row.find(t)) is not None else "" for t in ("k", "v"))
        model_all.append(vals_)
        if row.find("k") is not None:
            model_key.append(vals_)
    got_all = sorted(tuple(r) for r in read_xml_rows(spark, path, "row", ["k", "v"]).collect())
    got_key = sorted(tuple(r) for r in read_xml_rows(spark, path, "row", ["k", "v"], key="k").collect())
    assert got_all == sorted(model_all)
    assert got_key == sorted(model_key)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 3), st.one_of(st.none(), st.integers(0, 50)),
                          st.sampled_from(["EXTRACT_COMPLETED", "COMPLETED SUCCESSFULLY"])),
                min_size=1, max_size=40))
def test_latest_linecount_model(spark, rows):
    """Model: per (feed, filedate) among EXTRACT_COMPLETED rows with a line
    count, the one with the latest process_end, ties to the highest jobpid."""
    from feedwright.operators.jobstat import JOBSTAT_SCHEMA, latest_linecount
    d = dt.date(2024, 1, 3)
    full = []
    for pid, (feed, minute, lc, status) in enumerate(rows):
        t = dt.datetime(2024, 1, 3, 10, minute)
        full.append((feed, pid, "f", t, t, lc, lc, d, status, "", 0, 0, 0, 0, "", d, lc))
    got = {r.feed: r.linecount for r in latest_linecount(spark.createDataFrame(full, JOBSTAT_SCHEMA)).collect()}
    model = {}
    for feed in ("A", "B"):
        cand = [(r[4], r[1], r[5]) for r in full if r[0] == feed and r[8] == "EXTRACT_COMPLETED" and r[5] is not None]
        if cand:
            model[feed] = str(max(cand)[2])
    assert got == model


def _keys():
    return st.lists(st.text(alphabet=["a", "A", "b", "B", "c", "C"], min_size=1, max_size=3), min_size=1,
                    max_size=4, unique_by=str.lower)


leaf = st.one_of(st.integers(-5, 5), st.lists(st.integers(0, 3), min_size=1, max_size=3))
nested = st.recursive(leaf, lambda inner: _keys().flatmap(
    lambda ks: st.tuples(*[inner for _ in ks]).map(lambda vs, ks=ks: dict(zip(ks, vs)))), max_leaves=8)


def lower_model(x):
    if isinstance(x, dict):
        return {k.lower(): lower_model(v) for k, v in x.items()}
    if isinstance(x, list):
        return [lower_model(v) for v in x]
    return x


def to_row(x):
    from pyspark.sql import Row
    if isinstance(x, dict):
        return Row(**{k: to_row(v) for k, v in x.items()})
    return x


@SETTINGS
@given(_keys().flatmap(lambda ks: st.tuples(*[nested for _ in ks]).map(lambda vs, ks=ks: dict(zip(ks, vs)))))
def test_lower_keys_model(spark, record):
    from feedwright.functions.keys import lower_keys
    df = spark.createDataFrame([to_row(record)])
    got = lower_keys(df).first().asDict(recursive=True)
    assert got == lower_model(record)
