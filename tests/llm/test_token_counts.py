import random

import pytest
import sentencepiece

from feedwright.llm import token_counts as tc
from feedwright.llm import vocabularies as voc


@pytest.fixture(scope="module")
def file():
    with open(voc.default_path(tc.FILE), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(file):
    """The same file with model type unigram (field 3 of the trainer's settings, field 2 of the model)."""
    settings = next(v for n, v in voc.fields(file) if n == 2)
    at = file.index(settings)
    # the first varint field 3 after the two leading string fields
    i = settings.index(b"\x18\x02")
    assert dict(voc.fields(settings))[3] == 2
    return sentencepiece.SentencePieceProcessor(model_proto=file[:at + i] + b"\x18\x01" + file[at + i + 2:])


def brute(word, pieces):
    """All segmentations through plain dynamic programming over slices."""
    score = {p: s for p, s, kind in pieces if kind == 1}
    unknown = min(score.values()) - 10
    best = [(0.0, 0)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - 16), end):
            p = word[start:end]
            s = score.get(p, unknown if end - start == 1 else None)
            if s is not None and (best[end] is None or best[start][0] + s > best[end][0]):
                best[end] = (best[start][0] + s, best[start][1] + (1 if p in score else len(p.encode())))
    return best[-1][1], best[-1][0]


def words():
    r = random.Random(6)
    kinds = ["abcdefghijklmnopqrstuvwxyz", "etaoin", "éàüßñ", "日本語中", "😀‍", "0123", ".,!#$%", "абвг"]
    return ["".join(r.choice(r.choice(kinds[:k])) for _ in range(r.randint(1, 14))) for k in range(1, 9) for _ in range(300)]


def test_equals_the_library_word_by_word(library, file):
    model = tc.Unigram(voc.pieces(file))
    n = 0
    for w in words():
        (got,), (score,) = model.texts([w])
        if score > -(1 << 24):  # above, 32-bit sums are exact
            assert got == len(library.encode(w)), w
            n += 1
    assert n > 1000
    for a, b in zip(words(), reversed(words()), strict=True):
        (got,), (score,) = model.texts([f"{a} {b}"])
        if score > -(1 << 24):
            assert got == len(library.encode(f"{a} {b}"))


def test_library_sums_equal_encode_on_whole_texts(spark, library, file):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {r.doc_id: len(library.encode(r.text)) if r.text else 0 for r in docs.select("doc_id", "text").toLocalIterator()}
    got = {r.doc_id: r.n_tokens for r in tc.count_tokens(docs, sums="library").collect()}
    assert got == want
    exact = {r.doc_id: r.n_tokens for r in tc.count_tokens(docs).collect()}
    assert sum(exact[d] != want[d] for d in want) > len(want) // 4  # the two arithmetics differ: "the"
    r = random.Random(4)
    model = tc.Unigram(voc.pieces(file), "library")
    w = [*words(), "the", "hest", " ", "  ", "\n", "▁", "\t"]
    texts = [r.choice(["", " ", "\n"]).join(r.choice(w) + r.choice(["", " ", "    "]) for _ in range(r.randint(1, 40)))
             for _ in range(300)] + ["the", "x" * 5000, " " * 77, "\n\n", "the▁▁hest"]
    assert model.texts(texts)[0].tolist() == [len(library.encode(t)) if t else 0 for t in texts]


def test_usual_words_equal_the_whole_rule(file):
    model = tc.Unigram(voc.pieces(file), "library")
    r, usual = random.Random(8), 0
    for w in words() + ["the", "hest", "there", "ariear", "esuemente"]:
        w, a = "▁" + w, float(r.randint(-32, 32))
        found = model.usual_word(w, a)
        if found:
            usual += 1
            low, high, result = found
            for b in [a, *(float(b) for b in range(-31, 32) if low < b < high)]:
                assert result == model.library_word(w, b), (w, b)
    assert usual > 500


def test_library_sums_with_a_small_memory_and_without_steps(library, file, monkeypatch):
    pieces = voc.pieces(file)
    w = words()
    texts = [" ".join(w[i:i + 40]) + " the hest\nthere" for i in range(0, 1200, 40)]
    want = [len(library.encode(t)) for t in texts]
    monkeypatch.setattr(tc, "KEEP", 15)
    assert tc.Unigram(pieces, "library").texts(texts)[0].tolist() == want
    plain = tc.Unigram(pieces, "library")
    plain.step = None  # every score on arrival for itself
    assert plain.texts(texts)[0].tolist() == want


def test_library_sums_score_their_path(library, file):
    pieces = voc.pieces(file)
    score = {p: s for p, s, kind in pieces if kind == 1}
    model = tc.Unigram(pieces, "library")
    for w in ["the", "and", "hest", "esuemente", "information"]:
        path = library.encode(w, out_type=str)
        assert [x.tolist() for x in model.texts([w])] == [[len(path)], [sum(score[p] for p in path)]]
    with pytest.raises(ValueError):
        tc.Unigram(pieces, "other")


def test_equals_brute_force_on_whole_texts(spark, file):
    r = random.Random(2)
    pieces = voc.pieces(file)
    w = words()
    texts = [r.choice(["", " ", "\n"]).join(r.choice([*w, " ", "  ", "\n", "▁", "\t"]) + r.choice(["", " "]) for _ in range(r.randint(0, 30)))
             for _ in range(80)] + ["", None, " ", "   ", "\n\n", "x" * 5000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, score int").repartition(3)
    got = {x.doc_id: (x.n_tokens, x.score) for x in tc.count_tokens(df).collect()}
    want = {i: brute("▁" + t.replace(" ", "▁"), pieces) if t else (0, 0.0) for i, t in enumerate(texts)}
    assert got == want


def test_words_kept_are_bounded(file, monkeypatch):
    monkeypatch.setattr(tc, "KEEP", 20)
    small, large = tc.Unigram(voc.pieces(file)), tc.Unigram(voc.pieces(file))
    for i in range(0, 300, 30):
        t = [" ".join(words()[i:i + 30])]
        got = small.texts(t)
        monkeypatch.setattr(tc, "KEEP", 10**6)
        assert [g.tolist() for g in got] == [g.tolist() for g in large.texts(t)]
        monkeypatch.setattr(tc, "KEEP", 20)


def test_nulls_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(None, "the"), (1, None), (1, "the"), (1, "the")], "doc_id long, text string")
    assert sorted(((r.doc_id, r.n_tokens) for r in tc.count_tokens(df).collect()), key=str) == sorted([(None, 2), (1, 0), (1, 2), (1, 2)], key=str)  # _t + he
    assert tc.count_tokens(df.limit(0)).count() == 0


def test_frequent_words_are_kept_when_others_are_forgotten(file, monkeypatch):
    monkeypatch.setattr(tc, "KEEP", 50)
    model = tc.Unigram(voc.pieces(file), "library")
    counted, usual = [], model.usual_word
    monkeypatch.setattr(model, "usual_word", lambda w, a: counted.append(w) or usual(w, a))
    rare = sorted(set(words()))[:600]
    want = tc.Unigram(voc.pieces(file), "library").texts(["there"])[0].tolist()
    for w in rare:
        model.texts([w])
        assert model.texts(["there"])[0].tolist() == want
    assert len(counted) > 600 and counted.count("▁there") == 1
    assert model.results <= 55 and len(model.ways) + len(model.older) <= 110


def test_a_word_is_given_up_at_its_first_character_without_a_piece(file):
    model = tc.Unigram(voc.pieces(file), "library")
    seen, automaton = [], model.automaton

    class Watched:
        def iter(self, word):
            for last, match in automaton.iter(word):
                seen.append(last)
                yield last, match

    assert model.usual_word("▁there", 0.0) is not None
    model.automaton = Watched()
    assert model.usual_word("▁th\ue123" + "there" * 40, 0.0) is None
    assert max(seen) < 12  # the rest of the word isn't looked at


def test_words_with_one_result_equal_the_whole_rule(file, monkeypatch):
    model = tc.Unigram(voc.pieces(file), "library")
    w = sorted({"▁" + w for w in words() + ["the", "hest", "there", "ariear", "a", "e\0a", "th", "x" * 20, "there" * 9]})
    monkeypatch.setattr(tc, "GROUP", 100)
    found = model.usual_words([*w, "▁", "▁▁", "▁▁the", "the", "\n"])
    assert len(found) > 500 and set(found) <= set(w)
    for word, (low, high, *result) in found.items():
        assert all(low < b < high and tuple(result) == model.library_word(word, float(b)) for b in range(-32, 33)), word
    assert model.usual_words([]) == {} == tc.Unigram(voc.pieces(file)).usual_words(["\n"])


def test_a_blocks_new_words_are_looked_at_together(file, monkeypatch):
    model = tc.Unigram(voc.pieces(file), "library")
    r, counted, usual = random.Random(3), [], model.usual_word
    monkeypatch.setattr(model, "usual_word", lambda w, a: counted.append(w) or usual(w, a))
    w = [*words(), "the", "hest", "\0", "a\0b", "\n", "▁", "", "x" * 5000]
    texts = [r.choice([" ", "\n"]).join(r.choice(w) for _ in range(r.randint(0, 60))) for _ in range(100)] + ["", " "]
    got = [x.tolist() for x in model.texts(texts)]
    plain = {"▁" + w for w in words()[:600] if f" {w} " in " ".join(texts)}  # letters only
    assert len(plain) > 250 and len(plain & set(counted)) < len(plain) / 2
    monkeypatch.setattr(tc, "FEW", 10**9)  # one by one
    assert got == [x.tolist() for x in tc.Unigram(voc.pieces(file), "library").texts(texts)]
    assert [x.tolist() for x in model.texts([])] == [[], []]
