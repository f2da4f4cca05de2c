import hashlib
import random

import pytest

from feedwright.llm import suffix_dedup as sd

SCHEMA = "doc_id long, text string, spans string, left long"


def _brute_cover(docs):
    """Bytes that the contract covers, window by window."""
    first, covered = {}, {}
    for doc, text in sorted(docs):
        b = (text or "").encode()
        covered[doc] = bytearray(len(b))
        for i in range(len(b) - 99):
            w = b[i:i + 100]
            if w in first:
                covered[doc][i:i + 100] = b"\1" * 100
            else:
                first[w] = (doc, i)
    return covered


def brute(docs):
    covered, out = _brute_cover(docs), {}
    for doc, text in docs:
        b, c = (text or "").encode(), covered[doc]
        runs = sum(1 for i in range(len(c)) if c[i] and not (i and c[i - 1]))
        out[doc] = (len(b), sum(c), runs, hashlib.sha256(bytes(x for x, k in zip(b, c, strict=True) if not k)).hexdigest())
    return out


def cases(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("aeioulntrsé") for _ in range(r.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(40) for _ in range(4)]
    docs = []
    for _ in range(60):
        parts = []
        for _ in range(r.randint(1, 5)):
            p = r.choice(passages) if r.random() < 0.5 else prose(r.randint(1, 60))
            if r.random() < 0.3:
                p = p[r.randint(0, 80):][:r.randint(60, 300)]
            if r.random() < 0.2:
                at = r.randint(0, len(p))
                p = p[:at] + "X" + p[at + 1:]
            parts.append(p)
        docs.append(r.choice(["", " ", "\n"]).join(parts))
    docs += [docs[3], docs[3], "", None, "a" * 500, "ab" * 400, "a" * 99, "a" * 100, docs[5] + "é", "é" * 120, "\0" * 150 + "x", "\0" * 130]
    docs += ["b" * 230 + docs[0] + "b" * 230, docs[7] * 3]
    return [(i * 3 - 5, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_removal_equals_brute_force(spark, seed):
    docs = cases(seed)
    df = spark.createDataFrame([(d, t, "s", 1) for d, t in docs], SCHEMA).repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.removal_digest(df).collect()}
    assert got == brute(docs)


@pytest.mark.parametrize("max_group", [1, 3])
def test_large_groups_by_windows(spark, monkeypatch, max_group):
    monkeypatch.setattr(sd, "MAX_GROUP", max_group)
    docs = cases(6)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in sd.removal_digest(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute(docs)


def test_long_documents_are_cut_with_overlap(spark, monkeypatch):
    r = random.Random(5)
    base = "".join(r.choice("abcdefgh \n") for _ in range(sd.CHUNK + 5000))
    docs = [(1, base), (2, "zz" + base[sd.CHUNK - 700:sd.CHUNK + 900] + "yy"), (3, base[:50] + base[100:])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in sd.removal_digest(df).collect()}
    assert got == brute(docs)


def test_null_and_repeated_ids_and_empty_table(spark):
    r = random.Random(9)
    t = "".join(r.choice("abcdef ") for _ in range(300))
    df = spark.createDataFrame([(None, t), (7, t), (7, t), (7, "short")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_removed) for r in sd.removal_digest(df).collect())
    assert got == [(-1, 300, 0), (7, 300, 300)]
    assert sd.removal_digest(df.limit(0)).count() == 0


def test_groups_are_maximal_repeats(spark):
    docs = [(d, t) for d, t in cases(4) if t]
    text = dict(docs)
    rows = sd.maximal_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.repeat, []).append((r.doc_id, r.start, r.length, r.first))
    assert groups
    for occ in groups.values():
        strings = {text[d].encode()[s:s + n] for d, s, n, _ in occ}
        assert len(strings) == 1 and len(strings.pop()) >= 100 and len(occ) >= 2
        assert [f for *_, f in sorted(occ)] == [True] + [False] * (len(occ) - 1)


def _listed(spark, docs, **options):
    groups = {}
    for r in sd.maximal_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), **options).collect():
        groups.setdefault(r.repeat, []).append((r.doc_id, r.start, r.length, r.first))
    return {name: sorted(occ) for name, occ in groups.items()}


@pytest.mark.parametrize("max_group", [None, 1])
def test_groups_list_every_occurrence(spark, max_group):
    r = random.Random(12)
    prose = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    copy, passage = prose(400), prose(350)
    docs = cases(4)[:30] + cases(4)[-8:] + [(1000 + i, copy) for i in range(5)] + [(2000, prose(1000)), (2002, "x" * 350 + "é")]
    docs += [(3000 + i, prose(150 + i) + passage + prose(90)) for i in range(4)]
    text = {d: (t or "").encode() for d, t in docs}
    windows = {}
    for d, b in text.items():
        for i in range(len(b) - 99):
            windows.setdefault(b[i:i + 100], set()).add((d, i))
    groups = _listed(spark, docs, max_group=max_group)
    seen = {}  # window: the largest set of places that one group lists for it
    strings = set()
    for occ in groups.values():
        (n,) = {n for _, _, n, _ in occ}
        (string,) = {text[d][s:s + n] for d, s, _, _ in occ}
        places = {(d, s) for d, s, _, _ in occ}
        assert len(string) == n >= 100 and len(places) == len(occ) >= 2 and string not in strings
        strings.add(string)
        # whole: all places of its string in all documents
        assert places == {(d, i) for d, i in windows[string[:100]] if text[d][i:i + n] == string}
        assert [f for *_, f in occ] == [True] + [False] * (len(occ) - 1)
        for k in range(n - 99):
            seen.setdefault(string[k:k + 100], set()).add(len(occ))
    # every repeated window is in a group with exactly its places
    for w, places in windows.items():
        assert (len(places) in seen.get(w, ())) == (len(places) > 1)


def test_groups_of_large_grams_are_the_same(spark):
    docs = cases(2)
    assert _listed(spark, docs, max_group=1) == _listed(spark, docs, max_group=3) == _listed(spark, docs)


def test_prefix_intervals_against_definition():
    r = random.Random(0)
    for _ in range(200):
        lcp = [r.randint(0, 4) for _ in range(r.randint(1, 12))]
        want = {(min(lcp[a:b]), a, b) for a in range(len(lcp) + 1) for b in range(a + 1, len(lcp) + 1)
                if (a == 0 or lcp[a - 1] < min(lcp[a:b])) and (b == len(lcp) or lcp[b] < min(lcp[a:b]))}
        assert sorted(sd.prefix_intervals(lcp)) == sorted(want)
