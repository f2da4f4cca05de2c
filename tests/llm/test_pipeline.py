"""The pipeline's stages against brute force on a small corpus, and whole runs."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as cp
from feedwright.llm import exact_dedup, packing, simhash_mih, suffix_dedup
from feedwright.llm import vocabularies as voc
from test_exact_dedup import brute as brute_exact
from test_simhash_mih import brute_components, brute_fingerprint
from test_suffix_dedup import _brute_cover

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    r = random.Random(21)
    word = lambda: "".join(r.choice("aeioulntrsdmp") for _ in range(r.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(60) for _ in range(3)]
    good = []
    for i in range(90):
        parts = [prose(r.randint(5, 120))]
        if i % 3 == 0:
            parts.insert(r.randint(0, 1), shared[i % 9 // 3])
        good.append("\n".join(parts))
    good += [good[0], good[1] + " ", good[2].replace(" ", "  "), good[0], "é" * 130 + good[5][:200], "é" * 200]
    base = prose(300).split()
    for i in range(6):  # near copies
        w = list(base)
        w[10 + i] = w[10 + i] + "x"
        good.append(" ".join(w))
    junk = [" ".join(["###"] * 20 + [word() + "$$$" for _ in range(60)]) for _ in range(30)]
    rows = [(2 * i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(good)] + [(2 * i + 1, t, "en", "s0", len(t)) for i, t in enumerate(junk)]
    return rows + [(5000, "", "en", None, 0), (5002, None, None, None, None)]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(d, int(d % 2 == 0), 0) for d, *_ in corpus() if d < 5000]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stage_order_and_registration():
    assert len(cp.STAGES) == 5
    assert [f for _, f in cp.STAGES] == [cp.quality, cp.exact, cp.near, cp.passages, cp.sequences]
    assert entry.queries()["pipeline"] is cp.run and cp.ORACLE_SQL is None


def test_every_stage_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r.asDict() for r in docs.collect()}

    kept = cp.quality(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    got = {r.doc_id for r in kept.collect()}
    assert got >= {d for d in rows if d % 2 == 0 and d < 180} and not any(d % 2 for d in got)

    docs, rows = kept, {d: r for d, r in rows.items() if d in got}
    kept = cp.exact(spark, docs, sf_dir)
    want = brute_exact([(d, r["text"]) for d, r in rows.items()])
    assert {r.doc_id: r.asDict() for r in kept.collect()} == {d: r for d, r in rows.items() if want[d][2]}
    assert kept.columns == docs.columns

    docs, rows = kept, {d: r for d, r in rows.items() if want[d][2]}
    kept = cp.near(spark, docs, sf_dir)
    root = brute_components({d: brute_fingerprint(r["text"]) for d, r in rows.items()}, 4)
    assert {r.doc_id: r.asDict() for r in kept.collect()} == {d: r for d, r in rows.items() if root[d] == d}
    assert len({d for d in rows if root[d] != d}) >= 3

    docs, rows = kept, {d: r for d, r in rows.items() if root[d] == d}
    kept = cp.passages(spark, docs, sf_dir)
    cover = _brute_cover([(d, r["text"]) for d, r in rows.items()])
    assert kept.columns == docs.columns and kept.schema == docs.schema
    cut = 0
    for r in kept.collect():
        old = rows[r.doc_id]["text"]
        if old is None:
            assert r.text is None
            continue
        at, left = 0, []
        for c in old:  # a character goes if all its bytes are covered
            n = len(c.encode())
            if not all(cover[r.doc_id][at:at + n]):
                left.append(c)
            at += n
        assert r.text == "".join(left) and r.n_chars == len(left)
        assert (r.lang, r.source) == (rows[r.doc_id]["lang"], rows[r.doc_id]["source"])
        cut += len(left) < len(old)
    assert cut > 10

    texts = {r.doc_id: r.text for r in kept.collect()}
    with open(voc.default_path(packing.FILE), "rb") as f:
        encode = packing.encoder(f.read(), "tokenizers")
    total = {}
    for p in cp.sequences(spark, kept, sf_dir).collect():
        total[p.doc_id] = total.get(p.doc_id, 0) + p.length
    assert total == {d: len(encode([t or ""])[0]) + 1 for d, t in texts.items()}


def test_run_equals_the_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert sorted(cp.run(spark, sf_dir).collect()) == sorted(docs.collect())


def test_repeated_ids_extra_columns_and_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    twice = docs.union(docs.limit(4)).union(docs.limit(2).withColumn("text", F.lit("short"))).withColumns(
        {c: F.lit(1) for c in ("id", "spans", "fp", "row", "rest", "keep", "kept", "digest", "score")})
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, twice, sf_dir)
        assert out.columns == twice.columns
        twice = out
    assert twice.groupBy("doc_id").count().filter("count > 1").count() == 0
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


def test_rows_without_an_id_are_documents_of_their_own(spark, sf_dir):
    r = random.Random(3)
    prose = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    a, b, c = prose(90), prose(70), prose(80)
    rows = [(None, a, "en", "x", 1), (None, b, "en", "y", 2), (None, a + " ", "en", "z", 3), (-2**62, c, "en", "w", 4)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    ids = lambda rows, *names: sorted((tuple(x[n] for n in names) for x in rows), key=str)
    kept = cp.exact(spark, docs, sf_dir)
    assert kept.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    assert ids(kept.collect(), "doc_id", "source") == ids([dict(doc_id=-2**62, source="w"), dict(doc_id=None, source="y"), dict(doc_id=None, source="z")], "doc_id", "source")
    kept = cp.near(spark, kept, sf_dir)
    kept = cp.passages(spark, kept, sf_dir)
    assert sorted(x.text for x in kept.collect()) == sorted([a + " ", b, c])
    packed = cp.sequences(spark, kept, sf_dir).collect()
    assert sorted(str(p.doc_id) for p in packed) == [str(-2**62), "None", "None"]

    exact = exact_dedup.dedup(docs).collect()
    assert ids(exact, "doc_id", "keep_id", "group_size", "kept") == sorted(
        [(-2**62, -2**62, 1, True), (None, None, 1, True), (None, None, 2, True), (None, None, 2, False)], key=str)
    assert [x.doc_id for x in simhash_mih.near_duplicates(docs).collect()].count(None) == 3
    cut = suffix_dedup.removal_digest(docs).collect()
    assert [x.doc_id for x in cut].count(None) == 3 and sum(x.n_removed > 0 for x in cut) == 1
    assert [x.doc_id for x in suffix_dedup.without_repeats(docs).collect()].count(None) == 3
    assert exact_dedup.dedup(docs.filter("doc_id is null")).filter("kept").count() == 2
