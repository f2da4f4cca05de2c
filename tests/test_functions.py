import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedwright.functions import exprs
from feedwright.functions.keys import lower_keys


def one(spark, expr, schema="x string", rows=None):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_size_pretty_f8(spark):
    rows = [(0,), (10239,), (10240,), (10752,), (10485760,), (20 * 1024 ** 3,), (50 * 1024 ** 4,)]
    out = one(spark, exprs.size_pretty("x"), "x long", rows)
    assert out == ["0 bytes", "10239 bytes", "10 kB", "11 kB", "10 MB", "20 GB", "50 TB"]


def test_compare_refuses_unknown_operator():
    with pytest.raises(ValueError):
        exprs.compare("x", "like", 1)
    with pytest.raises(ValueError):
        exprs.compare("x", "between", 1)


@pytest.mark.parametrize("op,expected", [(">", [3]), (">=", [2, 3]), ("<", [1]), ("<=", [1, 2]),
                                         ("=", [2]), ("<>", [1, 3])])
def test_compare_six_operators(spark, op, expected):
    df = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    assert sorted(r.x for r in df.where(exprs.compare("x", op, 2)).collect()) == expected


def test_between_inclusive(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,)], "x int")
    assert sorted(r.x for r in df.where(exprs.compare("x", "between", 2, 3)).collect()) == [2, 3]


def test_seam_repair_f10(spark):
    rows = [("ab\ncd",), ("ab \ncd",), ("ab\n\ncd\n ef",), ('\nq"q"',), ("plain",), ("end\n",),
            ("ab\r\ncd",), ("ab\rcd\r\n\r\nef",)]
    assert one(spark, exprs.seam_repair("x"), rows=rows) == ["ab cd", "ab cd", "ab cd ef", ' q"q"', "plain", "end ",
                                                             "ab cd", "ab cd ef"]


def test_delimiter_repair_f12(spark):
    rows = [(bytearray(b'a"b\rc\xfed\xdfe\xdf'),), (bytearray(b"line2\xfex\r"),)]
    out = one(spark, exprs.delimiter_repair(F.col("x").cast("string")), "x binary", rows)
    assert out == ['abc\x01d"e"', "line2\x01x"]


def test_naming_flags_f9(spark):
    rows = [("ABC001-LOAD", None, "PL-ABC001-LOAD-OK"), ("ABC002-LOAD", "PL-ABC001-LOAD-OK", "PL-ABC002-LOAD-OK"),
            ("ABC005-LOAD", "WAIT", "PL-ABC005-OK"), ("ABC006-LOAD", "WAIT-OK", "PL-ABC006-LOAD-OK")]
    df = spark.createDataFrame(rows, "j string, i string, o string")
    i, o = exprs.naming_flags(F.col("j"), F.col("i"), F.col("o"))
    got = [(r[0], r[1]) for r in df.select(i, o).collect()]
    assert got == [(False, False), (False, False), (True, True), (False, False)]


def test_job_number(spark):
    assert one(spark, exprs.job_number("x"), rows=[("ABC001-LOAD",), ("JOB012-A",), ("X12-A",), ("nodash",)]) == [1, 12, None, None]


def test_percent_divide_by_zero_and_order(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "n long, d long")
    got = [r[0] for r in df.select(exprs.percent("n", "d")).collect()]
    assert got[0] == 100.0 * 1 / 3 and got[1] is None


def test_expected_flag_and_lag_text_f13(spark):
    rows = [(dt.date(2024, 1, 3), dt.datetime(2024, 1, 3, 10), 0),
            (dt.date(2024, 1, 3), dt.datetime(2024, 1, 4, 1), 1),
            (dt.date(2024, 1, 3), dt.datetime(2024, 1, 2, 23), None)]
    df = spark.createDataFrame(rows, "e date, a timestamp_ntz, lag int")
    got = [(r[0], r[1]) for r in df.select(exprs.expected_flag("a", "e"), exprs.lag_text("lag")).collect()]
    assert got == [("OK", "0"), ("LATE", "1"), ("LATE", "NA")]


def test_not_blank_and_isin_ci(spark):
    df = spark.createDataFrame([(None,), ("",), ("dm",), ("Stage",), ("other",)], "x string")
    assert [r[0] for r in df.select(exprs.not_blank("x")).collect()] == [False, False, True, True, True]
    assert [r[0] for r in df.select(exprs.isin_ci("x", ["DM", "STAGE"])).collect()] == [None, False, True, True, False]


def test_lower_keys_nested(spark):
    df = spark.createDataFrame([((1, (2, "a"), [(3, "b")]), {"KEY": {"InNer": 1}})],
                               "REC struct<ID:int, SUB:struct<X:int, Y:string>, ARR:array<struct<Z:int, W:string>>>, "
                               "M map<string, map<string, int>>")
    out = lower_keys(df)
    assert out.columns == ["rec", "m"]
    assert out.schema["rec"].dataType.simpleString() == \
        "struct<id:int,sub:struct<x:int,y:string>,arr:array<struct<z:int,w:string>>>"
    r = out.first()
    assert r.rec.sub.y == "a" and r.rec.arr[0].w == "b" and r.m == {"key": {"inner": 1}}
