"""Quality rules with tokeniser fertility.

Words are ``[^\\x20\\x09-\\x0D]+``. Two public vocabularies encode each word with one blank before
it: a piece vocabulary with byte fallback and a byte-level one. Measures of a document:

* ``chars_per_piece``, ``chars_per_token``: code points in words per token of either vocabulary (the inverse of fertility);
* ``fallback_share``: byte tokens among the pieces;
* ``entropy``: entropy (bits) of the document's pieces, as a share of the largest it can have, log2 of their number;
* ``min_entropy``: entropy of order infinity (bits), the surprise of the commonest piece.

Rejection bands: for each language (the ``lang`` column; where it is null, the main script of the text) the
median and the interquartile range of each measure over all documents that pass the base rules give an
interval ``median +- reach * range``; a document outside of one of its intervals is rejected. The quantiles are
mergeable sketches, so no group is gathered in one place, and one row per language is joined back. Bands have a least half
width, so a language whose documents are all alike rejects nobody for a hair's breadth.

Base rules: fewer than 50 words, or more than half of the words in 3-word windows that the text repeats.

Cases: null and empty texts have no words and fail the base rules; null ids and repeated rows are judged row by row; a language
with one document has a band around it; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm import vocabularies
from feedwright.llm.common import byte_blocks, ship_package, written

PIECES, BYTES = "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"
BLOCK, KEEP = 1 << 22, 400_000
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Bands: measure, reach (times the interquartile range), least half width, sides tested (-1 low, 1 high, 0 both).
BANDS = (("chars_per_piece", 6.0, 0.25, 0), ("chars_per_token", 3.5, 0.18, -1), ("fallback_share", 6.0, 0.02, 1),
         ("entropy", 5.0, 0.2, -1), ("min_entropy", 3.0, 0.9, -1))
#: Scripts told apart where the language is unknown: first code point of each range, name (fixed values).
SCRIPTS = ((0x41, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x590, "hebrew"), (0x600, "arabic"), (0x900, "indic"),
           (0xE00, "south-east asian"), (0x1100, "hangul"), (0x1E00, "latin"), (0x3040, "kana"), (0x3400, "han"), (0xAC00, "hangul"), (0x1F000, "symbols"))


class Measures:
    """Both vocabularies, and the words that this worker has encoded."""

    def __init__(self, pieces: bytes, ranks: bytes, pattern: str):
        import sentencepiece
        import tiktoken

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.tokens = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=vocabularies.rank_file(ranks), special_tokens={})
        kinds = vocabularies.pieces(pieces)
        self.is_byte = np.array([kind == 6 for *_, kind in kinds])
        self._forget()

    def _forget(self):
        # words seen so far get numbers; by number: code points, byte-level tokens, and where the pieces start in one array
        self.known: defaultdict[bytes, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.chars, self.n_tokens = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _learn(self, words: list[bytes]):
        texts = [w.decode("utf-8", "replace") for w in words]
        found = self.pieces.encode(texts, num_threads=1) if texts else []
        self.chars = np.concatenate([self.chars, np.array([len(t) for t in texts], np.int64)])
        self.n_tokens = np.concatenate([self.n_tokens, np.array([len(self.tokens.encode_ordinary(" " + t)) for t in texts], np.int64)])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.int32)])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum([len(i) for i in found], dtype=np.int64)])

    def block(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        """All measures of each text."""
        if len(self.known) > KEEP:
            self._forget()
        old = len(self.known)
        split = [np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)) for words in map(bytes.split, texts)]
        self._learn(list(islice(self.known, old, None)))
        word = np.concatenate([np.zeros(0, np.int64), *split])
        n_words = np.array([len(s) for s in split], np.int64)
        doc = np.repeat(np.arange(len(texts)), n_words)
        chars, n_tokens, ids, first = self.chars, self.n_tokens, self.ids, self.first
        n_pieces = np.diff(first)
        total = lambda v: np.bincount(doc, weights=v, minlength=len(texts)).astype(np.int64)
        # the pieces of all words in text order
        per_word = n_pieces[word]
        begin = np.cumsum(per_word) - per_word
        place = np.arange(per_word.sum()) - np.repeat(begin - first[word], per_word)
        piece, owner = ids[place] if len(ids) else place, np.repeat(doc, per_word)
        pieces = total(per_word)
        key, count = np.unique(owner << 20 | piece.astype(np.int64), return_counts=True)
        p = count / np.maximum(pieces, 1)[key >> 20]
        entropy = np.bincount(key >> 20, weights=-p * np.log2(p), minlength=len(texts))
        top = np.zeros(len(texts))
        np.maximum.at(top, key >> 20, p)
        bytes_ = np.bincount(owner, weights=self.is_byte[piece], minlength=len(texts)).astype(np.int64) if len(ids) else np.zeros(len(texts), np.int64)
        ratio = lambda a, b: a / np.maximum(b, 1)
        word_chars = total(chars[word])
        return {
            "n_words": n_words, "word_chars": word_chars,
            "n_symbols": np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64),
            "n_dup_lines": np.array([repeated_lines(t) for t in texts], np.int64),
            "n_repeat_words": repeated_words(word, n_words),
            "n_pieces": pieces, "chars_per_piece": ratio(word_chars, pieces), "chars_per_token": ratio(word_chars, total(n_tokens[word])),
            "fallback_share": ratio(bytes_, pieces), "entropy": entropy / np.log2(np.maximum(pieces, 2)),
            "min_entropy": -np.log2(np.where(top > 0, top, 1.0)),
        }


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def repeated_words(word: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Per text: words inside a 3-word window that the text holds twice or more (``word``: the words' numbers, text after text)."""
    ends = np.cumsum(n_words)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    at = np.flatnonzero(np.arange(len(word)) + 2 < ends[doc]) if len(word) else np.zeros(0, np.int64)
    covered = np.zeros(len(word) + 2, bool)
    if len(at):
        if int(word.max()) >= 1 << 21:  # numbers of pairs stay small, whatever the number of different words
            pair = np.unique(word[at] << 32 | word[at + 1], return_inverse=True)[1].astype(np.int64)
            key = pair << 32 | word[at + 2]
        else:
            key = word[at] << 42 | word[at + 1] << 21 | word[at + 2]
        order = np.lexsort((key, doc[at]))
        k, d = key[order], doc[at][order]
        same = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
        again = np.zeros(len(at), bool)
        again[1:] |= same
        again[:-1] |= same
        hits = at[order[again]]
        for shift in range(3):
            covered[hits + shift] = True
    return np.bincount(doc, weights=covered[:len(word)], minlength=len(n_words)).astype(np.int64)


def main_script(text: str) -> str:
    """The script of most letters of the text (whole text)."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    starts = np.array([s for s, _ in SCRIPTS])
    kind = np.searchsorted(starts, codes, "right") - 1
    counts = np.bincount(kind[kind >= 0], minlength=len(SCRIPTS))
    return "script:" + SCRIPTS[int(counts.argmax())][1]


#: Most languages whose bands are broadcast; with more the join is left to the planner (the result is the same).
MAX_BANDS = 10_000

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_pieces")
_RATIOS = ("chars_per_piece", "chars_per_token", "fallback_share", "entropy", "min_entropy")


def measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             pieces_path: str | None = None, bytes_path: str | None = None) -> DataFrame:
    """``doc_id, band_key`` (language or script), the base counts and the fertility measures of every row."""
    spark = df.sparkSession
    ship_package(spark)
    pieces = vocabularies.shared(spark, pieces_path or vocabularies.default_path(PIECES))
    ranks = vocabularies.shared(spark, bytes_path or vocabularies.default_path(BYTES))
    pattern = vocabularies.default_pattern()
    schema = pa.schema([("doc_id", pa.int64()), ("band_key", pa.string()), *((c, pa.int64()) for c in _COUNTS), *((c, pa.float64()) for c in _RATIOS)])

    def run(batches):
        m = vocabularies.built(("measures", pieces.id, ranks.id), lambda: Measures(pieces.value, ranks.value, pattern))
        for batch in byte_blocks(batches, BLOCK):
            texts = batch.column(1).to_pylist()
            out = m.block(texts)
            keys = [k if k is not None else main_script(t.decode("utf-8", "replace")) for k, t in zip(batch.column(2).to_pylist(), texts, strict=True)]
            yield pa.record_batch([batch.column(0), pa.array(keys, pa.string()), *(pa.array(out[c]) for c in (*_COUNTS, *_RATIOS))], schema=schema)

    lang = F.col(lang_col).cast("string") if lang_col in df.columns else F.lit(None).cast("string")
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
                     lang.alias("lang"))
    ddl = "doc_id long, band_key string, " + ", ".join(f"{c} long" for c in _COUNTS) + ", " + ", ".join(f"{c} double" for c in _RATIOS)
    return rows.mapInArrow(run, ddl)


def judge(measured: DataFrame, bands=BANDS, min_words: int = MIN_WORDS, max_repeat: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """``measured`` with base_failed and kept. Bands are taken from all rows that pass the base rules."""
    base = measured.withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words")))
    quartiles = [F.percentile_approx(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(1000)).alias(f"q_{c}") for c, *_ in bands]
    limits = base.filter("not base_failed").groupBy("band_key").agg(*quartiles)
    ok = F.lit(True)
    for c, reach, least, side in bands:
        q = F.col(f"q_{c}")
        half = F.greatest(reach * (q[2] - q[0]), F.lit(least))
        if side <= 0:
            ok &= F.col(c) >= q[1] - half
        if side >= 0:
            ok &= F.col(c) <= q[1] + half
    limits = written(limits, "bands")
    if limits.limit(MAX_BANDS + 1).count() <= MAX_BANDS:  # one row per language: a shuffle by language would gather a third of all rows
        limits = F.broadcast(limits)
    return base.join(limits, "band_key", "left").withColumn("kept", ~F.col("base_failed") & F.coalesce(ok, F.lit(False)))


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", bands=BANDS) -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, kept, and the fertility measures."""
    measured = written(measures(df, id_col, text_col, lang_col), "fertility")
    return judge(measured, bands).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                         "base_failed", "kept", "n_pieces", *_RATIOS)
