import numpy as np
import pytest
from pyspark.sql import functions as F

from feedwright.llm import quality_cotrain as q
from feedwright.llm import subword

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    hold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    got = q.classify(docs, labels.filter(~hold)).join(labels.filter(hold), "doc_id").toPandas()
    good = got[got.quality == 1]
    assert good.kept.mean() > 0.98
    assert (~got[got.quality == 0].kept).mean() > 0.9
    # the combination is no worse than either view
    error = lambda c: ((got[c] >= 0.5) != (got.quality == 1)).mean()
    assert error("score") <= min(error("content_score"), error("metadata_score")) + 0.01


def test_views_teach_each_other():
    """Labels in few documents, a pool that each view covers in part: pseudo-labels help the weaker view."""
    r = np.random.default_rng(5)
    n = 3000
    y = r.integers(0, 2, n)
    a = np.where(r.random(n)[:, None] < 0.9, (2 * y[:, None] - 1) * 1.5, 0) + r.normal(size=(n, 6))
    b = np.concatenate([(2 * y[:, None] - 1) * 0.5 + r.normal(size=(n, 4)), r.normal(size=(n, 60))], axis=1)
    label = y.copy()
    label[80:] = -1
    a, b = a.astype(np.float32), b.astype(np.float32)
    with_pool, alone = q.cotrain(a, b, label, rounds=3), q.cotrain(a, b, label, rounds=0)
    right = lambda m: ((m[0][1].logit(b) > 0) == (y == 1))[80:].mean()
    assert right(with_pool) > right(alone) + 0.02


def test_training_and_scoring_use_the_same_features():
    texts = [b"", b"One two two.\nThree ### | !!", "é ñ".encode(), b"x" * 4000, b" \t "]
    view = q.View(q.content_view(texts * 3), np.array([0, 1, 1, 0, 1] * 3, float), np.zeros(2048 + 3), np.ones(2048 + 3))
    total, count = subword.bag_sums(texts, view.weights[:2048], q.SIZES, q.BITS)
    fast = total / np.maximum(count, 1) + q._words(texts) @ view.weights[2048:] + view.bias
    assert np.allclose(fast, q.content_view(texts) @ view.weights + view.bias)


def test_cases(spark, tables):
    _, labels = tables
    schema = "doc_id long, text string, lang string, source string, score double, row string"
    df = spark.createDataFrame([(None, None, None, None, 1.0, "r"), (1, "", "en", None, None, None), (1, "", "en", None, None, None), (2, "The a", None, "s", 2.0, "q")], schema)
    none = labels.limit(0)
    assert [r.score for r in q.classify(df, none).collect()] == [0.5] * 4
    assert q.accepted(df, none).collect() == df.collect()
    one_class = spark.createDataFrame([(1, 1), (2, 1), (None, 0)], "doc_id long, quality int")
    assert all(r.kept for r in q.classify(df, one_class).collect())
    mixed = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, None)], "doc_id long, quality int")
    many = spark.createDataFrame([(i, "good text here" if i % 2 else "bad bad bad ###", "en", "s", 0.0, "x") for i in range(40)] + [(None, None, None, None, None, None)], schema)
    kept = q.accepted(many, mixed).collect()
    assert {r.doc_id for r in kept if r.doc_id is not None} == set(range(1, 40, 2))
    assert {r.row for r in kept if r.doc_id is not None} == {"x"}
    assert q.classify(df.limit(0), labels).count() == 0 and q.accepted(df.limit(0), none).count() == 0


def test_thresholds_take_the_surest_share():
    r = np.random.default_rng(2)
    logits = np.concatenate([r.normal(6, 2, 700), r.normal(-6, 2, 300), np.full(200, 25.0)])
    at = q.bins(logits)
    high, low = q.thresholds(np.bincount(at, minlength=q.BINS))
    taken, edge = logits[at >= high], np.sort(logits)[::-1][int(q.SHARE * len(logits))]
    assert len(taken) >= q.SHARE * len(logits) and taken.min() >= edge - 0.1 and taken.min() <= 25  # equal scores all count
    assert (at <= low).sum() >= q.SHARE * len(logits) and logits[at <= low].max() < -2
    # nobody is sure: nothing is taken
    none = q.bins(np.zeros(50))
    high, low = q.thresholds(np.bincount(none, minlength=q.BINS))
    assert not ((none >= high) | (none <= low)).any()
    assert not q.thresholds(np.zeros(q.BINS, np.int64))[0] < 0


def test_every_unlabelled_document_is_in_the_pool(spark):
    """Rounds over a table give the rows that rounds over the same features in memory give."""
    r = np.random.default_rng(9)
    words = ["good", "fine", "text", "here", "more"], ["###", "!!", "bad", "bad", "||"]
    rows = [(i, " ".join(r.choice(words[i % 2], 30 + int(r.integers(0, 40)))), "en" if r.random() < 0.5 else "de", f"s{i % 2 if r.random() < 0.9 else 2}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, quality int")
    models, *_ = q.train(docs, labels, max_taught=10**6)
    order = sorted(range(400), key=lambda i: __import__("zlib").crc32(str(i).encode()) << 64 | i)
    texts, langs, sources = ([rows[i][k] for i in order] for k in (1, 2, 3))
    content, meta = q.content_view([t.encode() for t in texts]).astype(np.float32), q.metadata_view([t.encode() for t in texts], sources, langs).astype(np.float32)
    y = np.array([i % 2 if i < 120 else -1 for i in order])
    known = y >= 0
    want, *_ = q.cotrain(content[known], meta[known], y[known], pool=q.Pool(content[~known], meta[~known]))
    for a, b in zip(models, want, strict=True):
        assert np.allclose(a.weights, b.weights, rtol=1e-2, atol=1e-3)
