import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from feedwright.llm import periodic_runs as pr


def brute_lyndon(w):
    n, out = len(w), []
    for i in range(n):
        out.append(max(k for k in range(1, n - i + 1) if all(w[i:i + k] < w[i + j:i + k] for j in range(1, k))))
    return out


def brute_runs(w):
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if size >= max(6, 4 * q) and not any((i, size) == k for k in out):
                out[i, size] = q
            i = j
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=24))
def test_baier_grouping_gives_the_lyndon_array(w):
    assert pr.lyndon_array(w, 4) == brute_lyndon(w)


def periodic():
    word = st.integers(0, 3)
    part = st.tuples(st.lists(word, min_size=1, max_size=5), st.integers(1, 9)).map(lambda x: x[0] * x[1])
    return st.lists(part, max_size=6).map(lambda parts: [x for p in parts for x in p])


@settings(max_examples=400, deadline=None)
@given(periodic())
def test_runs_of_a_text(w):
    assert (pr.runs_of(np.array(w, np.int64)) if w else []) == brute_runs(w)


@settings(max_examples=200, deadline=None)
@given(st.lists(periodic(), max_size=5))
def test_blocks_of_documents(docs):
    texts = [[b"%d" % x for x in d] for d in docs]
    assert pr.block_runs(texts) == [brute_runs(t) for t in texts]


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    keep = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()), sha(b" ".join(keep)))


def test_documents(spark):
    r = random.Random(12)
    texts = [" ".join(r.choice("abcé") for _ in range(r.randrange(0, 60))) for _ in range(120)]
    texts += ["", None, " \t\n", "a " * 4000, "a b " * 12, "x\x1cy x\x1cy " * 5, ("one two three " * 7 + "four ") * 5, "word",
              " ".join(str(i % 997) for i in range(5000)), "line of words\n" * 9]
    rows = list(enumerate(texts)) + [(None, "b b b b b b b"), (None, None), (3, "c c c c c c"), (3, "c c c c c c"), (-8, "z " * 30)]
    rows += [(i, " ".join(str(r.randrange(400)) for _ in range(r.randrange(1, 90)))) for i in range(1000, 1400)]
    assert sum(i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 30
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, tile string, n_runs int").repartition(4)
    key = lambda t: (t[0] is None, t[0] or 0, t[6], t[7])
    got = sorted((tuple(x) for x in pr.runs_digest(df).collect()), key=key)
    assert got == sorted((expected(i, t) for i, t in rows), key=key)


def test_runs_and_collapsed_text(spark):
    df = spark.createDataFrame([(1, "to be or not to be or not to be or not to be or not to go"), (2, "plain")], "doc_id long, text string")
    got = {x.doc_id: x for x in pr.periodic_runs(df).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 17, 4)] and got[1].collapsed == "to be or not go"
    assert got[2].runs == [] and got[2].collapsed == "plain"


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pr.runs_digest(df).collect() == [] and pr.periodic_runs(df).collect() == []
