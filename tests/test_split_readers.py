"""CSV and XML files that are read by many tasks."""

import csv
import io
import os
import random

import pytest

from feedwright.sources.files import _bytes, read_multiline_csv
from feedwright.sources.split_csv import split_records


def small_splits(spark, size):
    s = spark.newSession()
    for k in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        s.conf.set(k, spark.conf.get(k))
    s.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    s.conf.set("spark.sql.files.openCostInBytes", "0")
    return s


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def table(seed, n, end="\n"):
    r = random.Random(seed)
    field = lambda: "".join(r.choice(['a', 'é', ' ', ',', '"', '\n', '\n\n', 'xyz', '']) for _ in range(r.choice([0, 1, 3, 12, 60])))
    rows = [[str(i), field(), field()] for i in range(n)]
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerow(["id", "a\nhead", "b"])
    w.writerows(rows)
    return rows, out.getvalue()


@pytest.mark.parametrize("size", [64, 300, 5000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_of_split_files(spark, tmp_path, size, end):
    want = []
    for f in range(3):
        rows, text = table(f, 150 if f else 30, end)
        want += rows
        write(f"{tmp_path}/c/{f}.csv", text)
    s = small_splits(spark, size)
    records = split_records(s, f"{tmp_path}/c", True)
    assert size > 300 or records.rdd.getNumPartitions() > 10
    got = sorted((next(csv.reader(io.StringIO(r.record))) for r in records.collect()), key=lambda x: (int(x[0]), x))
    assert got == sorted(want, key=lambda x: (int(x[0]), x))
    if end == "\r\n":       # Spark's own reader keeps the carriage return here
        return
    split = sorted(map(str, read_multiline_csv(s, f"{tmp_path}/c", 3, split=True).collect()))
    assert split == sorted(map(str, read_multiline_csv(spark, f"{tmp_path}/c", 3, split=False).collect()))


def test_a_field_over_many_splits_and_an_open_end(spark, tmp_path):
    long = "line\n" * 400
    write(f"{tmp_path}/l/a.csv", f'id,v\n1,"{long}"\n2,x\n\n3,"{long}end"\n4,"open\n5,never closed\n')
    s = small_splits(spark, 100)
    got = {r[0] for r in split_records(s, f"{tmp_path}/l", True).collect()}
    assert got == {f'1,"{long}"', "2,x", f'3,"{long}end"', '4,"open\n5,never closed'}
    write(f"{tmp_path}/h/a.csv", f'id,"{long}"\n1,x\n2,y')
    assert {r[0] for r in split_records(s, f"{tmp_path}/h", True).collect()} == {"1,x", "2,y"}
    assert {r[0] for r in split_records(s, f"{tmp_path}/h", False).collect()} == {f'id,"{long}"', "1,x", "2,y"}


def test_large_files_are_split_by_default(spark, tmp_path):
    rows, text = table(9, 400)
    write(f"{tmp_path}/d/a.csv", text)
    s = small_splits(spark, 2000)
    df = read_multiline_csv(s, f"{tmp_path}/d", 2)
    assert "MapInArrow" in df._jdf.queryExecution().executedPlan().toString() and df.count() == len(rows)
    assert "MapInArrow" not in read_multiline_csv(spark, f"{tmp_path}/d", 2)._jdf.queryExecution().executedPlan().toString()
    assert (_bytes("128MB"), _bytes("16m"), _bytes("100"), _bytes("134217728b")) == (1 << 27, 1 << 24, 100, 1 << 27)


def test_empty_files(spark, tmp_path):
    write(f"{tmp_path}/e/a.csv", "")
    write(f"{tmp_path}/e/b.csv", "id,v\n")
    assert split_records(spark, f"{tmp_path}/e", True).count() == 0


def document(seed, n):
    """A well-formed document with everything that a lexer can stumble over."""
    r = random.Random(seed)
    noise = ["<!-- <row><k>no</k></row> -->", "<!-- </row> > -->", "<?pi <row> ?>", "\n", "<other a='<row>'.>"[:0], "<x><![CDATA[</row><row>]]></x>"]

    def row(depth=0):
        attrs = r.choice(["", ' a="x>y"', " b='</x>\" >'"[:0] or " b='q\">'", ' a="1" b="2>"'])
        if r.random() < 0.1:
            return f"<row{attrs}/>"
        body = []
        for t in r.sample(["k", "v", "w"], r.randrange(4)):
            text = r.choice(["", "t", "a &lt; b", "é > x", "<![CDATA[<row></row>]]>", "<!-- </row> -->y", "long " * r.randrange(30)])
            body.append(f"<{t}>{text}</{t}>")
        if depth < 3 and r.random() < 0.2:
            body.insert(r.randrange(len(body) + 1), row(depth + 1))
        return f"<row{attrs}>" + r.choice(["", "\n", " "]).join(body) + r.choice(["</row>", "</row >", "</row\n>"])

    return '<?xml version="1.0"?>\n<!DOCTYPE R [<!ENTITY z "<row>">]>\n<R>' + "".join(row() + r.choice(noise) for _ in range(n)) + "</R>"


def model(text):
    """The rows of an XML tree: first direct child of each name."""
    from xml.etree import ElementTree
    out = []
    for e in ElementTree.fromstring(text).iter("row"):
        out.append(tuple((c.text or "") if (c := e.find(t)) is not None else "" for t in ("k", "v", "w")))
    return sorted(out)


@pytest.mark.parametrize("size", [40, 150, 1000, 10**6])
def test_xml_rows_of_split_files(spark, tmp_path, size):
    from feedwright.sources.xml import read_xml_raw, read_xml_rows, xml_faults
    want = []
    for f in range(3):
        text = document(f, 60)
        want += model(text)
        write(f"{tmp_path}/x/{f}.xml", text)
    s = small_splits(spark, size)
    got = sorted(tuple(r) for r in read_xml_rows(s, f"{tmp_path}/x", "row", ["k", "v", "w"]).collect())
    assert got == sorted(want)
    assert xml_faults(read_xml_raw(s, f"{tmp_path}/x", "row", ["k", "v", "w"])).first()[0] == 0


def whole_text(text, size):
    """The lexer over parts that begin at a ``</row``."""
    from feedwright.sources import split_xml as sx
    split = sx._Split(sx.RowLexer("row"), 1, 0, (sx.TEXT, 0, [], {}), False)
    parts, at = [], 0
    while at < len(text):
        end = text.find("</row", at + size)
        end = len(text) if end < 0 else end
        parts.append(text[at:end])
        at = end
    for p in parts:
        split.feed(p)
    split.finish()
    return [(x[4], x[5]) for x in split.out]


def test_parts_dont_change_what_the_lexer_finds():
    for seed in range(30):
        text = document(seed, 20)
        assert whole_text(text, 1) == whole_text(text, 37) == whole_text(text, 10**6)


def test_leading_elements_of_broken_records(spark, tmp_path):
    from feedwright.sources.xml import read_xml_raw, read_xml_rows, xml_faults
    write(f"{tmp_path}/b/a.xml", "<R><row><k>1</k><v>x</v></row><row a='1'><k>2</k><v>cut<w>z</w></row><row><v>3</v><k/><w></row></R>")
    write(f"{tmp_path}/b/b.xml", "<R><row><k>4</k><w>y</w><row><k>5</k></row>")
    rows = lambda **k: sorted(tuple(r) for r in read_xml_rows(spark, f"{tmp_path}/b", "row", ["k", "v", "w"], **k).collect())
    assert rows() == [("1", "x", ""), ("5", "", "")]
    assert rows(salvage=True) == [("", "3", ""), ("1", "x", ""), ("2", "", ""), ("4", "", "y"), ("5", "", "")]
    assert rows(salvage=True, key="k") == rows(salvage=True)
    assert xml_faults(read_xml_raw(spark, f"{tmp_path}/b", "row", ["k", "v", "w"], salvage=True)).first()[0] == 3


def test_a_record_over_many_splits_between_faults(spark, tmp_path):
    from feedwright.sources.xml import read_xml_raw, read_xml_rows, xml_faults
    long = "<k>" + "x > " * 300 + "</k>"
    write(f"{tmp_path}/m/a.xml", f"<R></row><row><row>{long}</row><row>{long}<v>1</v></row><!-- " + "<row>" * 50 + f"--><row><v>2</v></row>{long}</R>")
    s = small_splits(spark, 64)
    got = sorted((len(r.k), r.v) for r in read_xml_rows(s, f"{tmp_path}/m", "row", ["k", "v"]).collect())
    assert got == [(0, "2"), (1200, ""), (1200, "1")]
    assert xml_faults(read_xml_raw(s, f"{tmp_path}/m", "row", ["k", "v"])).first()[0] == 2


def test_the_code_of_a_task_doesnt_grow_with_the_splits(spark):
    import numpy as np
    from pyspark import cloudpickle

    from feedwright.sources.split_csv import _mapper
    sizes = []
    for n in (10, 100_000):
        inside = spark.sparkContext.broadcast({1: np.arange(n)})
        sizes.append(len(cloudpickle.dumps(_mapper(inside, '"', True, False))))
    assert sizes[1] < sizes[0] + 100


def test_splits_of_single_file_feeds_grow_with_the_file(spark, tmp_path):
    from feedwright.queries import formats
    from feedwright.session import with_fixed_splits
    s = with_fixed_splits(spark)
    s.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    for size, want in ((1000, 1 << 16), (64 << 17, 1 << 17), (64 << 20, 1 << 20), (65 << 20, 1 << 20)):
        path = f"{tmp_path}/s{size}"
        os.makedirs(path)
        with open(f"{path}/a.csv", "wb") as f:
            f.truncate(size)
        assert _bytes(formats._fine_splits(s, path).conf.get("spark.sql.files.maxPartitionBytes")) == want
