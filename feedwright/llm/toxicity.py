"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A document is read in segments of ``SEGMENT`` words. A segment is the bag of the character n-grams
of its words (3 to 5 bytes, with word boundaries), hashed to rows of an embedding table; the mean of the rows goes through a linear
softmax. Embeddings and softmax are trained together by mini-batch Adagrad. N-grams are dropped at random during
training, so every part of a telling word carries weight, and misspellings that were never seen share n-gram vectors with
the words that were. A segment starts with the label of its document; after the first rounds, segments of toxic
documents that the model itself calls harmless are relabelled, so long documents with few toxic words teach the words.

A document's evidence is its segment logits at a few places from the top and their mean; a logistic fit on training documents turns it into
a probability, and ``predicted`` is 1 from ``THRESHOLD`` on.

Training uses labelled rows only, at most ``MAX_DOCS`` documents (smallest hashes of the ids, a fixed sample) and ``MAX_BYTES`` of text: in
the order of the hashes, a document of more than an eighth of that (1 MiB), or one that would pass the whole, is left out and the next one is looked at;
and never rows whose ``crc32(doc_id as text) % 4`` is 2. Only the text is an input. The fitted model is a fixed number of
weights, broadcast to the tasks; since the softmax is linear in the mean, each n-gram needs one weight.

Cases: null and empty texts have no segment and get the score of a bag without n-grams; without labelled
rows of both classes every score is the base rate (0.5 without any label); null ids are not held out and never trained on; repeated rows are scored row by row; a text of any length is scored whole, in one task
(some 20 bytes of memory per byte of it); equal scores are no ties, as nothing is ranked; only the named columns are read, so others may have any name; an empty table gives
an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm import subword
from feedwright.llm.common import byte_blocks, ship_package

SIZES, BITS, DIM = (3, 4, 5), 17, 8
SEGMENT = 1
#: Places from the top whose segment logits are a document's evidence, and the pull of their fit.
RANKS, PULL = (1, 2, 3, 5, 8, 13), 1.0
MAX_DOCS, MAX_BYTES = 4000, 8 << 20
HELD_OUT, THRESHOLD = 2, 0.3
ROUNDS, BATCH, RATE, DROP, SEED = 4, 1024, 0.3, 0.3, 7


def segments(texts: list[bytes], words: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cleaned bytes of all texts, the start of each segment, and its text's number (texts without words have none)."""
    text, starts = subword.padded(texts)
    blank = text == 32
    begins = np.flatnonzero(blank[:-1] & ~blank[1:])  # the blank before each word
    doc = np.searchsorted(starts, begins, "right") - 1
    first = np.searchsorted(doc, doc, "left") if len(doc) else doc
    head = (np.arange(len(begins)) - first) % words == 0
    return text, begins[head], doc[head]


def _train(texts: list[bytes], labels: np.ndarray, seed: int = SEED):
    """Embeddings reduced to one weight per n-gram, bias, and the logistic fit of documents: (weights, bias, fit)."""
    rng = np.random.default_rng(seed)
    text, begins, doc = segments(texts)
    at, rows = [], []
    for row, ok in subword.grams(text, SIZES, BITS):
        p = np.flatnonzero(ok)
        at.append((np.searchsorted(begins, p, "right") - 1).astype(np.int32))
        rows.append(row[p].astype(np.int32))
    seg, rows = np.concatenate(at), np.concatenate(rows)
    del at, text
    rows = rows[np.argsort(seg, kind="stable")]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(seg, minlength=len(begins)))])
    del seg
    y = labels[doc].astype(np.float64)
    emb = rng.normal(0, 0.1, (DIM, 1 << BITS))
    out = rng.normal(0, 0.1, (DIM, 2))
    bias = np.array([np.log1p(-y.mean()), np.log(y.mean())]) if 0 < y.mean() < 1 else np.zeros(2)
    ge, go, gb = np.full(emb.shape, 1e-4), np.full(out.shape, 1e-4), np.full(2, 1e-4)
    counts = np.diff(bounds)
    for step in range(ROUNDS):
        if step >= 2:  # harmless parts of toxic documents; each toxic document keeps its strongest segment
            logit = _segment_logits(rows, bounds, emb, out, bias)
            best = np.full(len(texts), -np.inf)
            np.maximum.at(best, doc, logit)
            y = (labels[doc] == 1) & ((logit > 0) | (logit >= best[doc]))
            y = y.astype(np.float64)
        # both classes weigh the same in a round
        share = max(y.mean(), 1e-9)
        weight = np.where(y == 1, 0.5 / share, 0.5 / max(1 - share, 1e-9))
        weight = np.minimum(weight, 20.0)
        shuffled = rng.permutation(len(begins))
        for s in range(0, len(shuffled), BATCH):
            pick = shuffled[s:s + BATCH]
            pick = pick[counts[pick] > 0]
            if not len(pick):
                continue
            n = counts[pick]
            base = np.repeat(bounds[pick] - (np.cumsum(n) - n), n)
            r = rows[base + np.arange(n.sum())]
            which = np.repeat(np.arange(len(pick)), n)
            keep = rng.random(len(r)) >= DROP
            r, which = r[keep], which[keep]
            size = np.maximum(np.bincount(which, minlength=len(pick)), 1)
            e = emb[:, r]
            h = np.stack([np.bincount(which, weights=e[d], minlength=len(pick)) for d in range(DIM)], axis=1) / size[:, None]
            z = h @ out + bias
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(pick)), y[pick].astype(int)] -= 1
            p *= (weight[pick] / len(pick))[:, None]
            dh = (p @ out.T) / size[:, None]
            dout, db = h.T @ p, p.sum(axis=0)
            touched, slot = np.unique(r, return_inverse=True)
            for d in range(DIM):
                g = np.bincount(slot, weights=dh[which, d], minlength=len(touched))
                ge[d, touched] += g * g
                emb[d, touched] -= RATE * g / np.sqrt(ge[d, touched])
            go += dout * dout
            out -= RATE * dout / np.sqrt(go)
            gb += db * db
            bias -= RATE * db / np.sqrt(gb)
    weights = ((out[:, 1] - out[:, 0]) @ emb).astype(np.float32)
    offset = float(bias[1] - bias[0])
    found = np.concatenate([evidence(texts[s:s + 200], weights, offset) for s in range(0, len(texts), 200)])
    return weights, offset, _logistic(found, labels)


def _segment_logits(rows, bounds, emb, out, bias):
    w = (out[:, 1] - out[:, 0]) @ emb
    total = np.concatenate([[0.0], np.cumsum(w[rows])])
    return (total[bounds[1:]] - total[bounds[:-1]]) / np.maximum(np.diff(bounds), 1) + bias[1] - bias[0]


def evidence(texts: list[bytes], weights: np.ndarray, offset: float) -> np.ndarray:
    """Per text: its segment logits at ``RANKS`` from the top, their mean, and the logarithm of their number."""
    text, begins, doc = segments(texts)
    out = np.full((len(texts), len(RANKS) + 2), offset)
    out[:, -1] = 0
    if not len(begins):
        return out
    total, count = np.zeros(len(begins)), np.zeros(len(begins))
    for row, ok in subword.grams(text, SIZES, BITS):
        total += np.add.reduceat(np.where(ok, weights[row], np.float32(0)).astype(np.float64), begins)
        count += np.add.reduceat(ok.astype(np.int64), begins)
    logit = total / np.maximum(count, 1) + offset
    order = np.lexsort((-logit, doc))
    logit, doc = logit[order], doc[order]
    first = np.searchsorted(doc, np.arange(len(texts)))
    n = np.bincount(doc, minlength=len(texts))
    for i, rank in enumerate(RANKS):
        has = n >= rank
        out[has, i] = logit[first[has] + rank - 1]
    some = n > 0
    out[some, -2] = np.bincount(doc, weights=logit, minlength=len(texts))[some] / n[some]
    out[:, -1] = np.log1p(n)
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the columns and an intercept: a logistic fit by damped Newton steps with a light pull towards 0."""
    center, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    m = np.column_stack([(x - center) / scale, np.ones(len(x))])
    pull = np.append(np.full(x.shape[1], PULL), 1e-6)
    w = np.zeros(m.shape[1])
    w[-1] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    loss = lambda w: np.logaddexp(0, m @ w).sum() - y @ (m @ w) + 0.5 * (pull * w * w).sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(m @ w, -30, 30)))
        step = np.linalg.solve((m * (p * (1 - p))[:, None]).T @ m + np.diag(pull), m.T @ (p - y) + pull * w)
        while np.abs(step).max() > 1e-9 and loss(w - step) > loss(w):
            step = step / 2
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] / scale * center).sum())


def probability(x: np.ndarray, fit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ fit[:-1] + fit[-1], -30, 30)))


def held_out(id_col: str = "doc_id"):
    """Rows that training never sees."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_bytes: int = MAX_BYTES):
    """The model, fitted on a bounded sample of the labelled rows that aren't held out."""
    known = (labels.filter("doc_id is not null and toxic in (0, 1)").filter(~held_out())
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs))
    picked = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(known), "doc_id")
    sizes = picked.groupBy("doc_id").agg(F.max(F.octet_length("text")).alias("size")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()  # at most max_docs rows
    taken, size = [], 0
    for r in sizes:
        n = r["size"] or 0
        if n <= max_bytes // 8 and size + n <= max_bytes:  # one that doesn't fit is passed over, smaller ones follow
            taken.append((r["doc_id"],))
            size += n
    ids = docs.sparkSession.createDataFrame(taken, known.select("doc_id").schema)
    rows = picked.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))
    texts, toxic = [], []
    for r in rows.orderBy(F.xxhash64("doc_id"), "doc_id").toLocalIterator():  # max_bytes at most
        texts.append((r["text"] or "").encode())
        toxic.append(r["toxic"])
    y = np.array(toxic, np.int64)
    if len(set(toxic)) < 2:
        rate = float(y.mean()) if len(y) else 0.5
        rate = min(max(rate, 0.01), 0.99)
        return np.zeros(1 << BITS, np.float32), 0.0, np.array([0.0] * (len(RANKS) + 2) + [np.log(rate / (1 - rate))])
    return _train(texts, y)


def score(docs: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches):
        weights, offset, fit = shared.value
        for batch in byte_blocks(batches, 1 << 20):
            ids = batch.column(0).to_pylist()
            p = probability(evidence(batch.column(1).to_pylist(), weights, offset), fit)
            out = [i is not None and zlib.crc32(str(i).encode()) % 4 == HELD_OUT for i in ids]
            yield pa.record_batch([batch.column(0), pa.array(out), pa.array(p), pa.array((p >= threshold).astype(np.int32))], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Train on ``labels`` (doc_id, toxic) and score every row of ``docs`` (doc_id, text)."""
    return score(docs, train(docs, labels), threshold)
