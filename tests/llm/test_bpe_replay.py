import hashlib
import random

import pytest
import tiktoken

from feedwright.llm import bpe_replay as bpe
from feedwright.llm import vocabularies as voc

PATTERN = voc.default_pattern()


@pytest.fixture(scope="module")
def ranks():
    with open(voc.default_path(bpe.FILE), "rb") as f:
        return voc.rank_file(f.read())


def texts():
    r = random.Random(3)
    kinds = ["abcdefgh the and ing", "aaaa", "éàüß ñ", "日本語中文", "😀🎉‍👩", "0123456789½²", " \t\n\r\x0b\x0c\x1c\x85\xa0 ", "'s't'll'RE", "#$%&*!?<>|_", "абвгд", "กขค", "\0\x01\x7f"]
    out = ["".join(r.choice(r.choice(kinds)) for _ in range(r.randint(0, 120))) for _ in range(1500)]
    out += ["", None, "a" * 3000, "ab" * 2000, "<|endoftext|>", "x" * 200_000, " " * 999, "aaa aaaa aaaaa " * 50]
    return out


def test_equals_the_library_and_round_trips(spark, ranks):
    lib = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids string").repartition(3)
    want = {i: lib.encode_ordinary(t or "") for i, t in rows}
    assert {r.doc_id: r.ids for r in bpe.encode(df).collect()} == want
    back = {r.doc_id: bytes(r.text) for r in bpe.decode(bpe.encode(df)).collect()}
    assert back == {i: (t or "").encode() for i, t in rows}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip_digest(df).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert got == {i: (len(want[i]), sha(",".join(map(str, want[i])).encode()), sha((t or "").encode())) for i, t in rows}


def test_order_inside_a_word():
    """Ranks no training gives: a merge brings up a pair of lower rank."""
    ranks = {bytes([b]): b + 10 for b in range(256)} | {b"ab": 400, b"aba": 2, b"cc": 401, b"abab": 1, b"bc": 399}
    vocab = bpe.Vocabulary(ranks, r"\S+|\s")
    r = random.Random(1)
    words = list({"".join(r.choice("abc") for _ in range(r.randint(1, 14))).encode() for _ in range(800)})
    assert bpe.replay(words, vocab) == [bpe.encode_word(w, ranks) for w in words]


def test_words_kept_by_a_worker_are_bounded(ranks, monkeypatch):
    monkeypatch.setattr(bpe, "KEEP", 50)
    vocab = bpe.Vocabulary(ranks, PATTERN)
    lib = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    for t in texts():
        ids, bounds = bpe.encode_texts([t or "", "x y"], vocab)
        assert ids.tolist() == lib.encode_ordinary(t or "") + lib.encode_ordinary("x y") and bounds.tolist()[0] == 0
        assert bounds.tolist()[1] == len(lib.encode_ordinary(t or ""))


def test_nulls_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b"), (1, None), (1, "a b"), (1, "a b")], "doc_id long, text string")
    rows = bpe.round_trip_digest(df).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in rows), key=str) == sorted([(None, 2), (1, 0), (1, 2), (1, 2)], key=str)
    assert bpe.round_trip_digest(df.limit(0)).count() == 0 and bpe.encode(df.limit(0)).count() == 0
