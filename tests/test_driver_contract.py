"""The driver's gate, locally: entry() smoke and every registered query against
its DuckDB twin (row count, column names, order-insensitive value hash)."""

import duckdb
import pytest

import __spark_entry__ as entry
from feedwright import queries as library
from tools.check_oracle import digest
from tests.conftest import SF_SMALL

ROWS_ONLY = {"file_sizes", "total_external_size"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "column_name" in df.columns


def test_every_query_has_an_oracle_or_is_rows_only():
    q, o = library.queries(), library.oracle_sql()
    assert set(o) <= set(q)
    assert set(q) - set(o) == ROWS_ONLY
    for name in q:
        assert "pipeline" not in name and not name.startswith("op")
    assert set(q) <= set(entry.queries()) and set(o) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(library.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only_queries_run(spark, name):
    assert entry.queries()[name](spark, SF_SMALL).count() > 0


def test_file_sizes_brute_force(spark):
    import os
    got = {r.table_name: (r.size_bytes, r.n_files) for r in entry.queries()["file_sizes"](spark, SF_SMALL).collect()}
    sizes = {f[:-len(".parquet")]: os.path.getsize(os.path.join(SF_SMALL, f))
             for f in os.listdir(SF_SMALL) if f.endswith(".parquet")}
    assert {k: v for k, v in got.items() if k != "DATABASE"} == {k: (v, 1) for k, v in sizes.items()}
    assert got["DATABASE"] == (sum(sizes.values()), len(sizes))


def test_total_external_size_brute_force(spark, monkeypatch):
    import os

    from feedwright.queries import metrics as qm
    seen = {}
    real = qm.scratch_path

    def remember(s, name):
        seen[name] = real(s, name)
        return seen[name]
    monkeypatch.setattr(qm, "scratch_path", remember)
    rows = {r.table_name: r for r in entry.queries()["total_external_size"](spark, SF_SMALL).collect()}
    r = rows["part"]
    data = other = 0
    for dp, _dn, fn in os.walk(seen["part-sizes"]):
        for f in fn:
            if f.endswith(".crc"):
                continue                      # the local file system hides its own checksum files
            size = os.path.getsize(os.path.join(dp, f))
            if f.endswith(".parquet"):
                data += size
            else:
                other += size
    assert (r.total_bytes, r.data_bytes, r.external_bytes) == (data + other, data, other)
