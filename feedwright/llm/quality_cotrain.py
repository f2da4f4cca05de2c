"""Quality classifier by co-training.

Two views of a document: *content*, the hashed bag of its character n-grams and how its words repeat; and *page
metadata*, its source, language, size and layout (lines, character classes). One logistic classifier per view is
trained on labelled documents. In each round, both classifiers score every unlabelled document; per view and class a threshold takes the surest
share of them (from a histogram of all scores, never below a confidence), and the documents beyond it teach the other view as pseudo-labels.
In the end each view is calibrated on labelled documents
that no classifier was trained on, and the calibrated views are combined by a logistic fit on the same documents. All documents are then scored by broadcast weights of fixed size.

A round is one pass over the documents that writes two numbers a row; the histogram is a fixed number of bins. What a fit takes is bounded:
at most ``MAX_LABELLED`` labelled documents, and ``MAX_TAUGHT`` new pseudo-labelled ones a round, view and class, picked from all that are sure by the smallest hashes
of their ids; their features, not their texts, reach the driver: ``2 ** BITS`` numbers each.

Cases: null and empty texts have empty bags and get whatever the intercepts say; null sources and languages are a value of their own; without labels of both classes every
score is 0.5 and every document is kept; null ids are never trained on; repeated rows are scored row by row (in training, an id is one of its rows); a text of any length is
scored whole, in one task (some 20 bytes of memory per byte of it); documents at a threshold all count as sure, and equal hashes go by id; columns other than the four named
ones may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from feedwright.llm import subword
from feedwright.llm.common import byte_blocks, ship_package, written
from feedwright.llm.toxicity import _logistic

SIZES, BITS = (1, 2, 3), 11
SLOTS = 64  # hashed sources, and as many hashed languages
MAX_LABELLED, MAX_TAUGHT = 4000, 400
ROUNDS, SURE, SHARE = 2, 0.95, 0.1  # rounds; confidence of a pseudo-label; the share of all unlabelled documents per class, round and view
BINS, SPAN = 1200, 30.0  # histogram of logits from -SPAN to SPAN
CALIBRATION = 4  # one labelled document in four calibrates
THRESHOLD = 0.5
STEPS, RATE, PULL = 200, 0.1, 3e-3

FLOOR = 0.01  # least deviation of a column: rare n-grams are not blown up

_REPEATS = 3  # numeric content features
_LAYOUT = 9  # numeric metadata features


def _words(texts: list[bytes]) -> np.ndarray:
    """Share of distinct words, share of words equal to the one before, share of words in the commonest one."""
    out = np.zeros((len(texts), _REPEATS))
    for i, t in enumerate(texts):
        w = t.split()
        if w:
            counts: dict[bytes, int] = {}
            for x in w:
                counts[x] = counts.get(x, 0) + 1
            out[i] = len(counts) / len(w), sum(a == b for a, b in zip(w, w[1:], strict=False)) / len(w), max(counts.values()) / len(w)
    return out


_CLASS = np.zeros((256, 4), np.int64)
_CLASS[65:91, 0] = 1  # capitals
_CLASS[48:58, 1] = 1  # digits
_CLASS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)], 2] = 1  # other printable ASCII
_CLASS[128:, 3] = 1


def _layout(texts: list[bytes]) -> np.ndarray:
    """Logarithms of size, lines and words, mean words per line, mean word length, and the shares of character classes."""
    out = np.zeros((len(texts), _LAYOUT))
    for i, t in enumerate(texts):
        n, lines = len(t), t.count(b"\n") + 1
        w = len(t.split())
        counts = np.bincount(np.frombuffer(t, np.uint8), minlength=256) @ _CLASS / max(n, 1)
        out[i] = np.log1p(n), np.log(lines), np.log1p(w), min(w / lines, 200) / 50, min(n / max(w, 1), 50) / 10, *counts
    return out


def _slot(value: str | None) -> int:
    return 0 if value is None else 1 + zlib.crc32(value.encode()) % (SLOTS - 1)


def metadata_view(texts: list[bytes], sources: list[str | None], langs: list[str | None]) -> np.ndarray:
    one = np.zeros((len(texts), 2 * SLOTS))
    for i, (s, g) in enumerate(zip(sources, langs, strict=True)):
        one[i, _slot(s)] = one[i, SLOTS + _slot(g)] = 1
    return np.concatenate([_layout(texts), one], axis=1)


def content_view(texts: list[bytes]) -> np.ndarray:
    """Dense content features (training samples only)."""
    which, rows = subword.bags(texts, SIZES, BITS)
    bag = np.bincount(which.astype(np.int64) << BITS | rows, minlength=len(texts) << BITS).reshape(len(texts), -1).astype(np.float64)
    bag /= np.maximum(bag.sum(axis=1, keepdims=True), 1)
    return np.concatenate([bag, _words(texts)], axis=1)


class View:
    """A logistic classifier on standardised columns, folded back to raw columns after training."""

    def __init__(self, x: np.ndarray, y: np.ndarray, center: np.ndarray, scale: np.ndarray):
        z = ((x - center) / scale).astype(np.float32)
        w, b = np.zeros(z.shape[1], np.float32), np.float32(0)
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) / len(y)
        g2, gb2 = np.full(z.shape[1], 1e-12, np.float32), 1e-12
        for _ in range(STEPS):  # full-batch Adagrad
            p = 1 / (1 + np.exp(-np.clip(z @ w + b, -30, 30)))
            d = (weight * (p - y)).astype(np.float32)
            g, gb = d @ z + np.float32(PULL) * w, d.sum()
            g2 += g * g
            gb2 += gb * gb
            w -= np.float32(RATE) * g / np.sqrt(g2)
            b -= np.float32(RATE * gb / np.sqrt(gb2))
        w = w.astype(np.float64)
        self.weights = w / scale
        self.bias = float(b - (self.weights * center).sum())

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(x @ self.weights + self.bias, -30, 30)


def bins(logits: np.ndarray) -> np.ndarray:
    """The histogram bin of each logit."""
    return np.clip(np.floor((logits + SPAN) * (BINS / (2 * SPAN))), 0, BINS - 1).astype(np.int64)


def thresholds(counts: np.ndarray) -> tuple[int, int]:
    """``(high, low)``: bins from ``high`` on are surely good, bins up to ``low`` surely bad: the surest ``SHARE`` of the counted documents each
    (whole bins, the one that reaches the share included), of a confidence of ``SURE`` at least."""
    want = SHARE * counts.sum()
    edge = np.log(SURE / (1 - SURE))
    down, up = np.cumsum(counts[::-1]), np.cumsum(counts)
    high = max(BINS - 1 - int(np.searchsorted(down, want)), int(bins(np.array([edge]))[0]) + 1)
    low = min(int(np.searchsorted(up, want)), int(bins(np.array([-edge]))[0]) - 1)
    return high, low


class Pool:
    """Unlabelled documents in memory: ``(content, meta)`` features."""

    def __init__(self, content: np.ndarray, meta: np.ndarray):
        self.views = (content, meta)
        self.taken = [np.zeros(len(content), bool), np.zeros(len(content), bool)]  # by the view that was taught

    def sure(self, models, step: int):
        """Per view: the features and labels of the documents that the other view is sure of now and that it wasn't taught yet."""
        out = []
        for k in (1, 0):  # view k teaches the other one
            at = bins(models[k].logit(self.views[k]))
            high, low = thresholds(np.bincount(at, minlength=BINS))
            new = np.flatnonzero(((at >= high) | (at <= low)) & ~self.taken[1 - k])
            self.taken[1 - k][new] = True
            out.append((self.views[1 - k][new], (at[new] >= high).astype(np.int64)))
        return out


def cotrain(content: np.ndarray, meta: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pool=None):
    """Both views' classifiers and the combination. ``y``: 1, 0, or -1 for rows without a label, which are the pool where none is given;
    rows in a fixed order. ``pool.sure(models, step)`` gives the pseudo-labelled rows of a round for each view."""
    known = np.flatnonzero(y >= 0)
    hold = known[::CALIBRATION]
    train = np.setdiff1d(known, hold)
    if len(set(y[train].tolist())) < 2 or len(set(y[hold].tolist())) < 2:
        return None
    pool = pool or Pool(content[y < 0], meta[y < 0])
    views = (content, meta)
    stats = [(v.mean(axis=0), np.maximum(v.std(axis=0), FLOOR)) for v in views]
    rows, label = [v[train] for v in views], [y[train], y[train]]  # what each view is trained on
    for step in range(rounds + 1):
        models = [View(x, t.astype(np.float64), *st) for x, t, st in zip(rows, label, stats, strict=True)]
        if step == rounds:
            break
        for k, (x, t) in enumerate(pool.sure(models, step)):
            rows[k], label[k] = np.concatenate([rows[k], x]), np.concatenate([label[k], t])
    calibrated = [_logistic(m.logit(v[hold])[:, None], y[hold].astype(np.float64)) for m, v in zip(models, views, strict=True)]
    both = np.column_stack([c[0] * m.logit(v[hold]) + c[1] for m, v, c in zip(models, views, calibrated, strict=True)])
    combine = _logistic(both, y[hold].astype(np.float64))
    return models, calibrated, combine


def _combine(model, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, ...]:
    """Calibrated probabilities of both views and their combination from the views' logits."""
    _, calibrated, combine = model
    z = [c[0] * x + c[1] for c, x in zip(calibrated, (first, second), strict=True)]
    sigmoid = lambda v: 1 / (1 + np.exp(-np.clip(v, -30, 30)))
    return sigmoid(z[0]), sigmoid(z[1]), sigmoid(combine[0] * z[0] + combine[1] * z[1] + combine[2])


def _columns(docs: DataFrame):
    text = lambda c: F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string")
    return (F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(text("text"), F.lit("")).cast("binary").alias("text"),
            text("source").alias("source"), text("lang").alias("lang"))


def _sample(docs: DataFrame, picked: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, int]]:
    """Id to (content, meta, y) of the bounded ``picked`` (doc_id, y); of repeated ids one row counts."""
    found = docs.select(*_columns(docs)).join(F.broadcast(picked.withColumnRenamed("doc_id", "picked_id")),
                                              F.col("doc_id") == F.col("picked_id")).drop("picked_id")
    schema = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("content", pa.binary()), ("meta", pa.binary())])

    def features(batches):
        for batch in byte_blocks(batches, 1 << 20):
            texts = batch.column(1).to_pylist()
            content = content_view(texts).astype("<f4")
            meta = metadata_view(texts, batch.column(2).to_pylist(), batch.column(3).to_pylist()).astype("<f4")
            yield pa.record_batch([batch.column(0), batch.column(4), pa.array([c.tobytes() for c in content], pa.binary()),
                                   pa.array([m.tobytes() for m in meta], pa.binary())], schema=schema)

    rows: dict = {}
    for r in found.mapInArrow(features, "doc_id long, y int, content binary, meta binary").toLocalIterator():
        if r["doc_id"] not in rows or (r["content"], r["meta"]) < rows[r["doc_id"]][:2]:
            rows[r["doc_id"]] = r["content"], r["meta"], r["y"]
    array = lambda b: np.frombuffer(b, "<f4").astype(np.float32)
    # a fixed order that isn't the order of the ids
    return {i: (array(rows[i][0]), array(rows[i][1]), rows[i][2]) for i in sorted(rows, key=lambda i: zlib.crc32(str(i).encode()) << 64 | i & (1 << 64) - 1)}


class CorpusPool:
    """The unlabelled documents of a table: every round scores them all where they are."""

    def __init__(self, docs: DataFrame, known: DataFrame, max_taught: int):
        self.docs, self.max_taught = docs, max_taught
        self.known = known.select(F.col("known_id").cast("long").alias("doc_id"))
        self.taken = [set(), set()]

    def sure(self, models, step: int):
        spark = self.docs.sparkSession
        shared = spark.sparkContext.broadcast(models)
        schema = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("second", pa.int64())])

        def run(batches):
            for batch in byte_blocks(batches, 1 << 20):
                first, second = _logits(shared.value, *(batch.column(i).to_pylist() for i in (1, 2, 3)))
                yield pa.record_batch([batch.column(0), pa.array(bins(first)), pa.array(bins(second))], schema=schema)

        # three numbers a row meet the labelled ids, not the texts
        scored = self.docs.select(*_columns(self.docs)).where("doc_id is not null").mapInArrow(run, "doc_id long, first long, second long")
        at = written(scored.join(self.known, "doc_id", "left_anti"), f"cotrain-round-{step}")
        out = []
        for k, column in ((1, "second"), (0, "first")):  # view k teaches the other one
            counts = np.zeros(BINS, np.int64)
            for r in at.groupBy(column).count().collect():  # at most BINS rows
                counts[r[column]] = r["count"]
            high, low = thresholds(counts)
            gone = spark.createDataFrame([(i,) for i in self.taken[1 - k]], "doc_id long")  # at most rounds x 2 x max_taught
            sure = at.where((F.col(column) >= high) | (F.col(column) <= low)).groupBy("doc_id").agg(F.min((F.col(column) >= high).cast("int")).alias("y"))
            sure = sure.join(F.broadcast(gone), "doc_id", "left_anti")
            picked = None
            for value in (0, 1):
                part = sure.where(F.col("y") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(self.max_taught)
                picked = part if picked is None else picked.union(part)
            rows = _sample(self.docs, picked)
            self.taken[1 - k].update(rows)
            width = models[1 - k].weights.shape[0]
            x = np.stack([r[1 - k] for r in rows.values()]) if rows else np.zeros((0, width), np.float32)
            out.append((x, np.array([r[2] for r in rows.values()], np.int64)))
        return out


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_taught: int = MAX_TAUGHT):
    """The co-trained model, or None without labels of both classes."""
    ship_package(docs.sparkSession)
    known = (labels.filter("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").alias("known_id"))
             .agg(F.max("quality").cast("int").alias("y")))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").distinct()
    marked = ids.join(known, F.col("doc_id") == F.col("known_id")).select("doc_id", "y")
    rows = _sample(docs, marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))  # a bounded number of ids
    if not rows:
        return None
    content, meta, y = (np.stack([r[k] for r in rows.values()]) for k in range(3))
    return cotrain(content, meta, y.astype(np.int64), pool=CorpusPool(docs, known, max_taught))


def _logits(models, texts, sources, langs) -> tuple[np.ndarray, np.ndarray]:
    """Both views' logits of each text."""
    content, meta = models
    bag, rest = content.weights[:1 << BITS], content.weights[1 << BITS:]
    total, count = subword.bag_sums(texts, bag, SIZES, BITS)
    first = np.clip(total / np.maximum(count, 1) + _words(texts) @ rest + content.bias, -30, 30)
    return first, meta.logit(metadata_view(texts, sources, langs))


def _scores(model, texts, sources, langs):
    """Content, metadata and combined score of each text."""
    if model is None:
        return [np.full(len(texts), 0.5)] * 3
    return _combine(model, *_logits(model[0], texts, sources, langs))


def score(docs: DataFrame, model) -> DataFrame:
    """Per row: doc_id, content_score, metadata_score, score (the combination)."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.float64()) for c in ("content_score", "metadata_score", "score"))])

    def run(batches):
        for batch in byte_blocks(batches, 1 << 20):
            found = _scores(shared.value, *(batch.column(i).to_pylist() for i in (1, 2, 3)))
            yield pa.record_batch([batch.column(0), *(pa.array(f) for f in found)], schema=schema)

    return docs.select(*_columns(docs)).mapInArrow(run, "doc_id long, content_score double, metadata_score double, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, content_score, metadata_score, score, kept (score of ``threshold`` or more)."""
    return score(docs, train(docs, labels)).withColumn("kept", F.col("score") >= threshold)


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) that the classifier keeps; rows are filtered where they are, without a join."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *_columns(docs)[1:])
    out = T.StructType([rows.schema["row"]])
    schema = to_arrow_schema(out)

    def run(batches):
        for batch in byte_blocks(batches, 1 << 20):
            keep = _scores(shared.value, *(batch.column(i).to_pylist() for i in (1, 2, 3)))[2] >= threshold
            yield pa.record_batch([batch.column(0).filter(pa.array(keep)).cast(schema.field(0).type)], schema=schema)

    return rows.mapInArrow(run, out).select("row.*")
