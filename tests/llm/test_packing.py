import random
import zlib

import numpy as np
import pytest

from feedwright.llm import packing
from feedwright.llm import vocabularies as voc


@pytest.fixture(scope="module")
def file():
    with open(voc.default_path(packing.FILE), "rb") as f:
        return f.read()


def texts():
    r = random.Random(8)
    kinds = ["abc def the and ing ", "éàüß ñ", "日本語", "😀‍👩", "0123½²", " \t\n\r\x0b\x1c\x85\xa0", "'s't'll", "#$%&*!?<>|_"]
    out = ["".join(r.choice(r.choice(kinds)) for _ in range(int(r.paretovariate(0.7)) % 9000)) for _ in range(400)]
    return [*out, "", None, "<|endoftext|>", "word " * 9000, "word " * 2047, out[0], out[0]]


def test_both_libraries_give_the_same_ids(file):
    fast, slow = packing.encoder(file, "tiktoken"), packing.encoder(file, "tokenizers")
    t = [x or "" for x in texts()]
    for a, b in zip(fast(t), slow(t), strict=True):
        assert a.tolist() == b.tolist()


def test_added_tokens_in_texts_have_the_ids_of_the_library(spark, file):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(voc.default_path(packing.FILE))
    t = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n\n y", "<|endoftext", "é  <|endoftext|>  's"]
    want = [e.ids for e in tok.encode_batch(t, add_special_tokens=False)]
    assert want[0] == [64, 220, 50256, 275]
    for library in ("tiktoken", "tokenizers"):
        assert [a.tolist() for a in packing.encoder(file, library)(t)] == want
    got = packing.pack(spark.createDataFrame(list(enumerate(t)), "doc_id long, text string")).collect()
    assert {(p.doc_id, p.ids_crc32, p.doc_tokens) for p in got} == {
        (i, zlib.crc32(np.array([*ids, 1], "<u4").tobytes()), len(ids) + 1) for i, ids in enumerate(want)}


def test_added_tokens_that_are_no_plain_splits_go_to_the_library(file):
    import json
    data = json.loads(file)
    assert voc.added_tokens(file) == {"<|endoftext|>": 50256}
    data["added_tokens"][0]["lstrip"] = True
    other = json.dumps(data).encode()
    assert voc.added_tokens(other) is None
    assert packing.encoder(other, "tiktoken")(["a <|endoftext|> b"])[0].tolist() == [64, 50256, 275]


def test_pieces_and_sequences(spark, file):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, length long").repartition(4)
    got = packing.pack(df).collect()
    encode = packing.encoder(file, "tokenizers")
    docs, seqs = {}, {}
    for p in got:
        docs.setdefault(p.doc_id, []).append(p)
        seqs.setdefault(p.sequence_id, []).append(p)
    assert set(docs) == {i for i, _ in rows}
    for i, t in rows:
        ids = [*encode([t or ""])[0].tolist(), 1]
        at = 0
        for p in sorted(docs[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and 1 <= p.length <= 2048
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    for s in seqs.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    assert sorted(seqs) == list(range(len(seqs)))


def one_by_one(lengths, size):
    """Shortest-pack-first on single pieces: the sorted room left in all packs."""
    packs = []
    for n in sorted(lengths, reverse=True):
        best = max(range(len(packs)), key=lambda i: packs[i], default=None)
        if best is None or packs[best] < n:
            packs.append(size - n)
        else:
            packs[best] -= n
    return sorted(packs)


def test_histogram_equals_packing_one_by_one():
    r = random.Random(2)
    for _ in range(150):
        size = r.choice([8, 17, 64])
        lengths = [r.randint(1, size) for _ in range(r.randint(0, 120))]
        hist = {n: lengths.count(n) for n in set(lengths)}
        patterns = packing.shortest_pack_first(hist, size)
        assert sorted(size - sum(p) for c, p in patterns for _ in range(c)) == one_by_one(lengths, size)
        assert sorted(n for c, p in patterns for _ in range(c) for n in p) == sorted(lengths)


def test_nulls_repeated_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b"), (1, None), (1, "a b"), (1, "a b")], "doc_id long, text string")
    assert sorted(((p.doc_id, p.doc_tokens) for p in packing.pack(df).collect()), key=str) == [(1, 3), (None, 3)]
    assert packing.pack(df.limit(0)).count() == 0
