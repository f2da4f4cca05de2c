import random
import re

import numpy as np
import pytest
import sentencepiece
import tiktoken

from feedwright.llm import fertility as fe
from feedwright.llm import vocabularies as voc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    covered = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)}
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


@pytest.fixture(scope="module")
def tools():
    with open(voc.default_path(fe.BYTES), "rb") as f:
        ranks = voc.rank_file(f.read())
    return (sentencepiece.SentencePieceProcessor(model_file=voc.default_path(fe.PIECES)),
            tiktoken.Encoding("own", pat_str=voc.default_pattern(), mergeable_ranks=ranks, special_tokens={}))


def fertility(text, tools):
    w = WORD.findall(text or "")
    ids = [i for x in w for i in tools[0].encode(x)]
    n, chars = len(ids), sum(map(len, w))
    p = np.array([ids.count(i) / n for i in set(ids)]) if n else np.array([1.0])
    return (chars / max(n, 1), chars / max(sum(len(tools[1].encode_ordinary(" " + x)) for x in w), 1),
            sum(3 <= i < 259 for i in ids) / max(n, 1), -(p * np.log2(p)).sum() / np.log2(max(n, 2)), -np.log2(p.max()))


def texts():
    r = random.Random(12)
    words = ["the", "of", "éa", "日本", "x\x85y", "😀", "a|b", "##", "\xa0", "tion", "and,"]
    out = [r.choice([" ", "\n", " \t"]).join(r.choice(words[:r.randint(1, 11)]) for _ in range(r.randint(0, 90))) for _ in range(120)]
    return [*out, "", None, " \n ", "one", "a b c a b c", "l\nl\nl\n\n\n", "the " * 3000]


def test_counts_and_measures_equal_brute_force(spark, tools):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "en" if i % 2 else None, i) for i, t in rows], "doc_id long, text string, lang string, n_words int").repartition(3)
    got = {r.doc_id: r for r in fe.measures(df).collect()}
    for i, t in rows:
        g = got[i]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == base(t), t
        assert np.allclose((g.chars_per_piece, g.chars_per_token, g.fallback_share, g.entropy, g.min_entropy), fertility(t, tools))
        assert g.band_key == "en" if i % 2 else g.band_key.startswith("script:")


def test_bands(spark):
    cols = "doc_id long, band_key string, n_words long, n_repeat_words long, a double"
    r = random.Random(1)
    rows = [(i, f"k{i % 3}", 60 + i % 5, 0, i % 3 * 10 + r.gauss(0, 0.1)) for i in range(300)]
    rows += [(900, "k1", 60, 0, 12.0), (901, "k1", 60, 0, 8.0), (902, "k2", 49, 0, 20.0), (903, "k2", 60, 31, 20.0), (904, "k2", 60, 30, 20.0), (905, None, 60, 0, 1.0)]
    bands = (("a", 4.0, 0.05, 0),)
    got = {x.doc_id: (x.base_failed, x.kept) for x in fe.judge(spark.createDataFrame(rows, cols), bands).collect()}
    good = {}
    for k in range(3):
        v = sorted(x[4] for x in rows if x[1] == f"k{k}" and x[2] >= 50 and 100 * x[3] <= 50 * x[2])
        q = [v[int(np.ceil(p * len(v))) - 1] for p in (0.25, 0.5, 0.75)]
        half = max(4 * (q[2] - q[0]), 0.05)
        good[f"k{k}"] = (q[1] - half, q[1] + half)
    for d, k, n, rep, a in rows[:-1]:
        failed = n < 50 or 100 * rep > 50 * n
        assert got[d] == (failed, not failed and good[k][0] <= a <= good[k][1])
    assert got[900] == got[901] == (False, False) and got[902] == got[903] == (True, False) and got[904] == (False, True)


def test_on_labelled_documents(spark):
    """Junk is rejected, documents of good quality that pass the base rules stay."""
    d = "/root/testdata/sf0.01"
    judged = fe.quality_rules(spark.read.parquet(f"{d}/documents.parquet")).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    rows = judged.filter("not base_failed").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in rows}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.99
    assert n.get((0, False), 0) / (n.get((0, False), 0) + n.get((0, True), 0)) > 0.9


def test_nulls_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(None, "the"), (1, None), (1, "the"), (1, "the")], "doc_id long, text string")
    rows = fe.quality_rules(df).collect()
    assert sorted((str(r.doc_id), r.n_words, r.base_failed, r.kept) for r in rows) == [("1", 0, True, False), ("1", 1, True, False), ("1", 1, True, False), ("None", 1, True, False)]
    assert fe.quality_rules(df.limit(0)).count() == 0


def test_main_script():
    assert fe.main_script("abc где где") == "script:cyrillic" and fe.main_script("") == "script:latin" and fe.main_script("日本") == "script:han"


def test_repeated_words_with_many_different_words():
    r = np.random.default_rng(1)
    word = r.integers(0, 4, 60)
    big = word + (1 << 21)
    n = np.array([0, 25, 35, 0])
    assert fe.repeated_words(word, n).tolist() == fe.repeated_words(big, n).tolist()
    assert fe.repeated_words(np.zeros(0, np.int64), np.array([0, 0])).tolist() == [0, 0]
