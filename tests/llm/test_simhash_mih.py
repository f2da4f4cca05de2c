import random
import re

import pytest
import xxhash

from feedwright.llm import simhash_mih as mih


def brute_fingerprint(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, distance):
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = list(fps)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            if (fps[a] ^ fps[b]).bit_count() <= distance:
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in ids}


def docs():
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcDEFéß") for _ in range(r.randint(1, 5)))
    out = []
    for _ in range(25):
        base = [word() for _ in range(r.randint(0, 400))]
        for _ in range(r.randint(1, 6)):
            v = list(base)
            for _ in range(r.randint(0, 2)):
                if v:
                    v[r.randrange(len(v))] = word()
            out.append(r.choice([" ", "\n", "\x0b\t"]).join(v))
    return [*out, "", None, " \n", "one", "one two three", "A B c d", "a b C D", "x\x85y \xa0 z w q", out[0], "w " * 40000]


def test_equals_brute_force(spark):
    rows = [(7 * i - 9, t) for i, t in enumerate(docs())]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(i, t, "f", 3) for i, t in rows], "doc_id long, text string, fp string, root int").repartition(4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in mih.near_duplicates(df).collect()}
    fps = {i: brute_fingerprint(t) for i, t in rows}
    comp = brute_components(fps, 4)
    assert got == {i: (f"{fps[i]:016x}", comp[i]) for i in fps}
    assert len(set(comp.values())) < len(comp)


@pytest.mark.parametrize("distance,segments", [(4, mih.SEGMENTS), (2, ((32, 1), (32, 0))), (5, ((21, 1), (21, 1), (22, 1)))])
def test_links_on_random_fingerprints(spark, distance, segments):
    r = random.Random(distance)
    values = set()
    for _ in range(40):
        v = r.getrandbits(64)
        values.add(v)
        for _ in range(8):
            for b in r.sample(range(64), r.randint(1, 4)):
                v ^= 1 << b
            values.add(v)
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= distance}
    got = mih.links(spark.createDataFrame([(v,) for v in signed], "fp long"), distance, segments).collect()
    assert {(x.a, x.b) for x in got} == want and len(got) == len(want)


def test_radii_that_would_lose_links_are_refused(spark):
    with pytest.raises(ValueError):
        mih.links(spark.createDataFrame([(1,)], "fp long"), 5)


def test_chain_and_star_components(spark):
    from feedwright.llm.common import components
    links = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 180)] + [(300, 299), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {x: 100 for x in range(100, 180)} | {300: 299, 299: 299}
    assert got == want


def test_nulls_repeated_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b"), (1, None), (1, "a b"), (2, "")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.fingerprint == "0" * 16) for r in mih.near_duplicates(df).collect()), key=str)
    assert got == [(1, None, False), (2, 2, True), (None, None, False)]
    assert mih.near_duplicates(df.limit(0)).count() == 0


def test_widths_follow_the_number_of_fingerprints(spark):
    assert mih.widths(1000) == mih.widths(10**7) == mih.SEGMENTS
    assert [b for b, _ in mih.widths(10**9)] == [32, 32] and sum(r + 1 for _, r in mih.widths(10**9)) == 5
    for d in (1, 2, 3, 5, 6):
        w = mih.widths(10**6, d)
        assert sum(b for b, _ in w) == 64 and sum(r + 1 for _, r in w) == d + 1
    values = [(0,), (15,), (31,), (1 << 40 | 7,)]
    df = spark.createDataFrame(values, "fp long")
    pairs = lambda w: sorted(tuple(r) for r in mih.links(df, 4, w).collect())
    assert pairs(mih.widths(10**9)) == pairs(mih.SEGMENTS) == sorted((a, b) for (a,) in values for (b,) in values if a < b and bin(a ^ b).count("1") <= 4)
