import hashlib
import re

from feedwright.llm import exact_dedup as xd


def brute(rows):
    norm = {i: re.sub(r"[\x20\x09-\x0D]", "", t or "") for i, t in rows}
    out = {}
    for i, _ in rows:
        group = [(len(t or ""), -j, j) for j, t in rows if norm[j] == norm[i]]
        keep = max(group)[2]
        out[i] = (keep, len(group), keep == i, hashlib.sha256(norm[i].encode()).hexdigest())
    return out


ROWS = [(5, "a b"), (3, "ab"), (4, "a  b"), (-2, "a\tb "), (9, "é \x85"), (8, "é\x85"), (1, ""), (0, None), (2, " \n\x0b\x0c\r"), (7, "\xa0"), (6, "x" * 100_000), (10, "x" * 100_000)]


def test_equals_brute_force(spark):
    df = spark.createDataFrame([(i, t, "d", 7) for i, t in ROWS], "doc_id long, text string, digest string, keep_id int").repartition(3)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in xd.dedup(df).collect()}
    assert got == brute(ROWS)


def test_index_persists_over_batches(spark):
    index = xd.DigestIndex(spark, buckets=4)
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    first = {r.doc_id: r.kept for r in xd.dedup(frame([(1, "a"), (2, "b"), (3, "a ")]), index=index, batch="1").collect()}
    assert first == {1: False, 2: True, 3: True}
    second = {r.doc_id: (r.keep_id, r.kept) for r in xd.dedup(frame([(4, "a   "), (5, "c"), (6, "c")]), index=index, batch="2").collect()}
    assert second == {4: (3, False), 5: (5, True), 6: (5, False)}  # what is stored wins, even over a longer text
    assert {r.keep_id for r in index.read().collect()} == {3, 2, 5}
    # the same batch once more: nothing is added and the decisions stay
    again = {r.doc_id: (r.keep_id, r.kept) for r in xd.dedup(frame([(4, "a   "), (5, "c"), (6, "c")]), index=index, batch="2").collect()}
    assert again == second and index.read().count() == 3
    meta = spark.sql(f"describe extended {index.table}").collect()
    assert {r.col_name: r.data_type for r in meta}["Num Buckets"] == "4"


def test_index_is_opened_again_by_its_path(spark):
    from feedwright.session import scratch_path
    path = scratch_path(spark, "kept-index")
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    index = xd.DigestIndex(spark, path, buckets=4)
    xd.dedup(frame([(1, "a")]), index=index, batch="1").count()
    spark.sql(f"DROP TABLE {index.table}")  # as in a session whose catalog doesn't know it
    later = xd.DigestIndex(spark, path, buckets=4)
    assert [(r.keep_id, r.kept) for r in xd.dedup(frame([(2, "a ")]), index=later, batch="2").collect()] == [(1, False)]
    assert later.read().count() == 1


def test_index_side_is_read_without_exchange(spark):
    index = xd.DigestIndex(spark, buckets=4)
    xd.dedup(spark.createDataFrame([(i, str(i)) for i in range(50)], "doc_id long, text string"), index=index, batch="1").count()
    new = xd.digests(spark.createDataFrame([(9, "q")], "id long, text string")).repartition(4, "digest")
    old = index.read().select("digest", "keep_id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = new.hint("merge").join(old.hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scan = plan[plan.index("SortMergeJoin"):]
    assert "Bucketed: true" in scan and scan.count("Exchange") == 1


def test_first_batch_takes_the_anti_join(spark, monkeypatch):
    index = xd.DigestIndex(spark, buckets=4)
    assert index.exists() and index.read().count() == 0
    plans, fresh = [], xd.DigestIndex.fresh

    def spy(self, groups):
        out = fresh(self, groups)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(xd.DigestIndex, "fresh", spy)
    df = spark.createDataFrame([(1, "a"), (2, "a ")], "doc_id long, text string")
    assert sorted((r.doc_id, r.kept) for r in xd.dedup(df, index=index).collect()) == [(1, False), (2, True)]
    assert len(plans) == 1 and "LeftAnti" in plans[0] and "SortMergeJoin" in plans[0] and "Bucketed: true" in plans[0]
    assert index.read().count() == 1


def test_nulls_repeated_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a"), (1, "a"), (1, "a  "), (1, "a  ")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in xd.dedup(df).collect()), key=str)
    assert got == [(1, 1, 2, True), (None, 1, 2, False)]
    tie = spark.createDataFrame([(None, "a"), (1, "a")], "doc_id long, text string")
    assert sorted(((r.doc_id, r.keep_id, r.kept) for r in xd.dedup(tie).collect()), key=str) == [(1, None, False), (None, None, True)]
    assert xd.dedup(df.limit(0)).count() == 0


def test_buckets_follow_the_first_batch_and_stay(spark, monkeypatch):
    from feedwright.session import scratch_path
    monkeypatch.setattr(xd, "BUCKET_ROWS", 10)
    monkeypatch.setattr(xd, "LEAST_BUCKETS", 2)
    path = scratch_path(spark, "grown-index")
    frame = lambda a, b: spark.createDataFrame([(i, str(i)) for i in range(a, b)], "doc_id long, text string")
    index = xd.DigestIndex(spark, path)
    xd.dedup(frame(0, 45), index=index, batch="1").count()
    assert index.buckets == 5
    index.forget()
    again = xd.DigestIndex(spark, path)
    assert again.buckets == 5 and xd.dedup(frame(40, 50), index=again, batch="2").where("kept").count() == 5
    wider = again.rebuild(scratch_path(spark, "rebuilt"), 7)
    assert wider.buckets == 7 and wider.read().count() == 50 and xd.dedup(frame(0, 60), index=wider, batch="3").where("kept").count() == 10


def test_a_run_leaves_no_table(spark):
    before = {t.name for t in spark.catalog.listTables()}
    got = xd.dedup(spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string"))
    assert {t.name for t in spark.catalog.listTables()} == before and got.where("kept").count() == 1


def test_merged_texts_are_reported(spark):
    import pytest
    df = spark.createDataFrame([(5, "one"), (5, "another"), (5, "one"), (6, "x")], "doc_id long, text string")
    with pytest.warns(UserWarning, match="1 texts share their id"):
        assert xd.dedup(df).count() == 2
