import os

import pytest
from pyspark.sql import functions as F

from feedwright.plans.job_defs import check_job_definitions
from feedwright.plans.xml_feed import read_feed_csv, xml_feed_to_csv
from feedwright.session import scratch_path
from feedwright.sinks.files import write_csv, write_csv_counted
from feedwright.sources.files import read_first_n, read_multiline_csv, read_repaired_lines
from feedwright.sources.xml import key_rejects, read_xml_raw, read_xml_rows
from feedwright.streaming.delimiter_stream import start_delimiter_stream


def write(path, data, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as f:
        f.write(data)
    return path


@pytest.fixture()
def tmp(spark):
    return scratch_path(spark, "test")


def test_multiline_csv_f10(spark, tmp):
    text = 'id,t,x\n1,"ab\ncd",x1\n2,"ab \ncd",x2\n\n3,"ab\n\ncd\n ef",x3\n4,"\nq""q""",x4\n5,plain,\n'
    write(f"{tmp}/a.csv", text)
    df = read_multiline_csv(spark, tmp, 2)
    assert df.columns == ["id", "t"]
    got = {r.id: r.t for r in df.collect()}
    assert got == {"1": "ab cd", "2": "ab cd", "3": "ab cd ef", "4": ' q"q"', "5": "plain"}
    wide = read_multiline_csv(spark, tmp, 4)
    assert wide.columns == ["id", "t", "x", "_c3"] and wide.where(F.col("_c3").isNotNull()).count() == 0


def test_multiline_csv_semicolon(spark, tmp):
    write(f"{tmp}/b.csv", 'a;b\n1;"x\ny"\n')
    assert [tuple(r) for r in read_multiline_csv(spark, tmp, 2, sep=";").collect()] == [("1", "x y")]


def test_first_n_plain(spark, tmp):
    write(f"{tmp}/p.txt", "a|b|c\n1|2\n\n4|5|6|7\n7||\n")
    got = [tuple(r) for r in read_first_n(spark, tmp, 3, "|").collect()]
    assert sorted(got, key=str) == sorted([("a", "b", "c"), ("1", "2", None), ("4", "5", "6"), ("7", "", "")], key=str)


def test_delimiter_repair_file_and_stream_f12(spark, tmp):
    write(f"{tmp}/in/f.txt", b'a"b\rc\xfed\xdfe\xdf\nline2\xfex\r\n', "wb")
    got = sorted(r.value for r in read_repaired_lines(spark, f"{tmp}/in").collect())
    assert got == sorted(['abc\x01d"e"', "line2\x01x"])
    q = start_delimiter_stream(spark, f"{tmp}/in", f"{tmp}/out", f"{tmp}/ckpt")
    q.awaitTermination()
    assert sorted(r.value for r in spark.read.parquet(f"{tmp}/out").collect()) == got


XML_F11 = ("<R><A><row><k>1</k><v>x</v></row><row><k/><v>y</v></row><row><v>z</v></row></A>"
           "<row><k>4</k><v></v><v>second</v></row></R>")


def test_xml_rows_f11(spark, tmp):
    write(f"{tmp}/a.xml", XML_F11)
    allrows = sorted(tuple(r) for r in read_xml_rows(spark, tmp, "row", ["k", "v"]).collect())
    assert allrows == sorted([("1", "x"), ("", "y"), ("", "z"), ("4", "")])
    keyed = sorted(tuple(r) for r in read_xml_rows(spark, tmp, "row", ["k", "v"], key="k").collect())
    assert keyed == sorted([("1", "x"), ("", "y"), ("4", "")])
    assert key_rejects(read_xml_raw(spark, tmp, "row", ["k", "v"]), "k").first()["rejected"] == 1


def test_xml_truncated_keeps_prefix(spark, tmp):
    write(f"{tmp}/t.xml", "<R><row><k>1</k></row><row><k>2</k></row><row><k>3</k><v>cut")
    assert sorted(r.k for r in read_xml_rows(spark, tmp, "row", ["k", "v"]).collect()) == ["1", "2"]


def test_xml_feed_to_csv_counts(spark, tmp):
    write(f"{tmp}/x/a.xml", "<R><row><k>1</k><v>a,b</v></row><row><k>2</k><v>q\"x</v></row><row><v>no key</v></row>"
                            "<row><k>3</k><v/></row></R>")
    res = xml_feed_to_csv(spark, f"{tmp}/x", "row", ["k", "v"], f"{tmp}/csv", key="k")
    assert res["rows_written"] == 3 and res["rows_rejected"] == 1
    assert [(r.status, r.rowcount) for r in res["audit"].collect()] == \
        [("XML Parsing Started", 0), ("XML Parsing Completed", 3)]
    back = sorted(tuple(r) for r in read_feed_csv(spark, f"{tmp}/csv", ["k", "v"]).collect())
    assert back == [("1", "a,b"), ("2", 'q"x'), ("3", "")]
    raw = "".join(open(os.path.join(f"{tmp}/csv", f)).read() for f in os.listdir(f"{tmp}/csv") if f.endswith(".csv"))
    assert '"a,b"' in raw and '"q""x"' in raw and "1," in raw      # quotes only where needed


def test_empty_output_is_error(spark, tmp):
    with pytest.raises(RuntimeError):
        write_csv_counted(spark.createDataFrame([], "a string"), f"{tmp}/empty")


def test_job_definitions_f9(spark, tmp):
    xml = ('<X><SMART_FOLDER>'
           '<JOB JOBNAME="ABC001-LOAD"><OUTCOND NAME="PL-ABC001-LOAD-OK"/></JOB>'
           '<JOB JOBNAME="ABC002-LOAD"><INCOND NAME="PL-ABC001-LOAD-OK"/><OUTCOND NAME="PL-ABC002-LOAD-OK"/></JOB>'
           '<JOB JOBNAME="ABC005-LOAD"><INCOND NAME="X"/><INCOND NAME="WAIT"/><OUTCOND NAME="PL-ABC005-OK"/></JOB>'
           '<JOB JOBNAME="ABC006-LOAD"><INCOND NAME="WAIT-OK"/><OUTCOND NAME="PL-ABC006-LOAD-OK"/></JOB>'
           '</SMART_FOLDER></X>')
    write(f"{tmp}/j.xml", xml)
    flags, missing = check_job_definitions(spark, tmp)
    got = {r.jobname: (r.incond, r.in_bad, r.out_bad) for r in flags.collect()}
    assert got == {"ABC001-LOAD": (None, False, False), "ABC002-LOAD": ("PL-ABC001-LOAD-OK", False, False),
                   "ABC005-LOAD": ("WAIT", True, True), "ABC006-LOAD": ("WAIT-OK", False, False)}
    assert sorted(r.job_num for r in missing.collect()) == [3, 4]


def test_csv_writer_roundtrip_keeps_spaces(spark, tmp):
    df = spark.createDataFrame([(1, "  lead", "trail  "), (2, "\nnl", "")], "id int, a string, b string")
    write_csv(df, f"{tmp}/w", header=True)
    back = sorted(tuple(r) for r in spark.read.option("header", True).option("multiLine", True)
                  .option("escape", '"').option("nullValue", "\u0000").csv(f"{tmp}/w").collect())
    assert back == [("1", "  lead", "trail  "), ("2", "\nnl", "")]


def test_stream_restart_processes_new_files_once(spark, tmp):
    write(f"{tmp}/in/a.txt", b"one\xfe1\n", "wb")
    q = start_delimiter_stream(spark, f"{tmp}/in", f"{tmp}/out", f"{tmp}/ckpt")
    q.awaitTermination()
    write(f"{tmp}/in/b.txt", b"two\xdf2\xdf\n", "wb")
    q = start_delimiter_stream(spark, f"{tmp}/in", f"{tmp}/out", f"{tmp}/ckpt")   # restart from the checkpoint
    q.awaitTermination()
    assert sorted(r.value for r in spark.read.parquet(f"{tmp}/out").collect()) == ["one\x011", 'two"2"']
