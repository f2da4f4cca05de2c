"""Byte-level BPE encoding by corpus-level merge replay, and decoding.

A block of documents is the corpus: its distinct pre-tokens are laid out as one array
of byte tokens, linked to their neighbours inside each word. An inverted index from a
token pair (named by the rank of its merge) to the positions where it stands drives
the work: ranks are taken in order, all positions of a rank are merged at once, and
only the pairs that touch a merged position are looked up again and re-indexed. A word
that stands a thousand times in the corpus is merged once. Blocks bound the memory, and
a worker keeps the words of earlier blocks, so frequent words are merged once per worker;
nothing is shuffled and nothing grows with the corpus.

The result is that of the tiktoken library: a pre-token that is a token as a whole
is that token; otherwise the pair of lowest rank is merged first, leftmost first. Where a
merge brings up a pair of lower rank than its own, order within the word matters, and the word is
merged again on its own in the exact order.

Cases: empty and null texts give no ids and decode to nothing; null ids stay null;
repeated rows are encoded row by row; an empty table gives an empty result. Decoding ids outside the vocabulary raises.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm import vocabularies
from feedwright.llm.common import byte_blocks, ship_package

FILE = "byte_bpe_multi_50k.tiktoken"
#: Bytes of text encoded at once, and words that a worker keeps (memory bounds; results don't depend on them).
BLOCK = 1 << 24
KEEP = 250_000
NONE = np.int64(1 << 40)  # rank of a pair that is no merge


class Vocabulary:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.pair_keys, self.pair_ranks = np.array(keys, np.int64)[order], np.array(values, np.int64)[order]
        # words that were encoded so far: their number, and per number where its ids start in one array
        self.known: defaultdict[str, int] = defaultdict()
        self.known.default_factory = self.known.__len__  # a word that is looked up gets the next number
        self.ids, self.starts = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of merging token a with token b (b below 0: no neighbour)."""
        key = (a << 32) | np.maximum(b, 0)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((b >= 0) & (self.pair_keys[at] == key), self.pair_ranks[at], NONE)


def encode_word(word: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The merges of one word, step by step: lowest rank first, leftmost first."""
    if word in ranks:
        return (ranks[word],)
    parts = [word[i:i + 1] for i in range(len(word))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], NONE), i) for i in range(len(parts) - 1))
        if rank == NONE:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return tuple(ranks[p] for p in parts)


def replay(words: list[bytes], vocab: Vocabulary) -> list[tuple[int, ...]]:
    """The ids of each word (no word is empty)."""
    out = [vocab.ranks.get(w) for w in words]
    out = [None if i is None else (i,) for i in out]
    todo = [i for i, ids in enumerate(out) if ids is None]
    if not todo:
        return out
    flat = np.frombuffer(b"".join(words[i] for i in todo), np.uint8)
    lens = np.array([len(words[i]) for i in todo], np.int64)
    n, ends = len(flat), np.cumsum(lens)
    word = np.repeat(np.arange(len(todo)), lens)
    token = np.concatenate([vocab.byte_id[flat], [-1]])  # the last place stands for "no neighbour"
    after = np.arange(1, n + 2)
    after[ends - 1] = n
    after[n] = n
    before = np.arange(-1, n)
    before[ends - lens] = -1
    before = np.concatenate([before, [-1]])
    rank = np.concatenate([vocab.pair_rank(token[:n], token[after[:n]]), [NONE]])
    dead = np.zeros(n + 1, bool)
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []
    again: list[np.ndarray] = []

    def enter(places, ranks):
        o = np.argsort(ranks, kind="stable")
        places, ranks = places[o], ranks[o]
        cut = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for r, part in zip(ranks[np.concatenate([[0], cut])].tolist(), np.split(places, cut), strict=True):
            if r in index:
                index[r].append(part)
            else:
                index[r] = [part]
                heappush(heap, r)

    at = np.flatnonzero(rank[:n] < NONE)
    if len(at):
        enter(at, rank[at])
        heapify(heap)
    while heap:
        r = heappop(heap)
        parts = index.pop(r)
        at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
        at = at[(rank[at] == r) & ~dead[at]]
        if not len(at):
            continue
        if len(at) > 1:
            at = np.unique(at)
            chained = np.zeros(len(at), bool)
            chained[1:] = after[at[:-1]] == at[1:]
            if chained.any():  # runs of one token: every second pair, from the left
                i = np.arange(len(at))
                at = at[(i - np.maximum.accumulate(np.where(chained, 0, i))) % 2 == 0]
        right = after[at]
        beyond = after[right]
        token[at] = r
        dead[right] = True
        after[at] = beyond
        before[beyond] = at
        left = before[at]
        touched = np.concatenate([at, left[left >= 0]])
        new = vocab.pair_rank(token[touched], token[after[touched]])
        rank[touched] = new
        if (new < r).any():
            again.append(word[touched[new < r]])
        live = new < NONE
        if live.any():
            enter(touched[live], new[live])
    alive = ~dead[:n]
    ids, counts = token[:n][alive].tolist(), np.bincount(word[alive], minlength=len(todo)).tolist()
    at = 0
    for i, c in zip(todo, counts, strict=True):
        out[i] = tuple(ids[at:at + c])
        at += c
    for w in np.unique(np.concatenate(again)).tolist() if again else ():
        out[todo[w]] = encode_word(words[todo[w]], vocab.ranks)
    return out


def encode_texts(texts: list[str], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts in order, and where each text's ids start (one place more at the end); the texts are one corpus."""
    known = vocab.known
    if len(known) > KEEP:
        known.clear()
        vocab.ids, vocab.starts = np.zeros(0, np.int64), np.zeros(1, np.int64)
    old = len(known)
    words = [np.fromiter(map(known.__getitem__, found), np.int64, len(found)) for found in map(vocab.find, texts)]
    new = replay([w.encode() for w in islice(known, old, None)], vocab)
    if new:
        vocab.ids = np.concatenate([vocab.ids, np.fromiter(chain.from_iterable(new), np.int64)])
        vocab.starts = np.concatenate([vocab.starts, vocab.starts[-1] + np.cumsum([len(i) for i in new])])
    # the words' ids in text order
    flat = np.concatenate([np.zeros(0, np.int64), *words])
    first, count = vocab.starts[flat], vocab.starts[flat + 1] - vocab.starts[flat]
    ends = np.cumsum(count)
    ids = vocab.ids[np.arange(count.sum()) + np.repeat(first - (ends - count), count)]
    bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)]
    return ids, bounds


def decode_ids(ids: list[int], vocab: Vocabulary) -> bytes:
    return b"".join(map(vocab.tokens.__getitem__, ids))


def _vocabulary(file, pattern) -> Vocabulary:
    return vocabularies.built(("bpe", file.id, pattern), lambda: Vocabulary(vocabularies.rank_file(file.value), pattern))


def _encoder(spark, path, pattern):
    ship_package(spark)
    return vocabularies.shared(spark, path or vocabularies.default_path(FILE)), pattern or vocabularies.default_pattern()


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id, ids array<int>`` of every row; ``path``: a rank file, ``pattern``: what splits text before the merges."""
    file, pattern = _encoder(df.sparkSession, path, pattern)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        vocab = _vocabulary(file, pattern)
        for batch in byte_blocks(batches, BLOCK):
            ids, bounds = encode_texts(batch.column(1).to_pylist(), vocab)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.record_batch([batch.column(0), lists], schema=schema)

    return _input(df, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``doc_id, text binary`` of every row of ids (null: none)."""
    file, pattern = _encoder(df.sparkSession, path, None)
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.binary())])

    def run(batches):
        vocab = _vocabulary(file, pattern)
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                yield pa.record_batch([part.column(0), pa.array([decode_ids(ids or [], vocab) for ids in part.column(1).to_pylist()],
                                                                pa.binary())], schema=schema)

    return (df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
            .mapInArrow(run, "doc_id long, text binary"))


def _input(df, id_col, text_col):
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def round_trip_digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                      pattern: str | None = None) -> DataFrame:
    """Encode, decode the ids, and hash both: doc_id, n_tokens, ids_sha256, decoded_sha256 (ids and bytes never leave the task)."""
    file, pattern = _encoder(df.sparkSession, path, pattern)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches):
        vocab = _vocabulary(file, pattern)
        names = vocabularies.built(("names", file.id), lambda: {i: b"%d" % i for i in vocab.tokens})
        for batch in byte_blocks(batches, BLOCK):
            ids, bounds = encode_texts(batch.column(1).to_pylist(), vocab)
            names_sha, bytes_sha = [], []
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                one = ids[s:e].tolist()
                names_sha.append(hashlib.sha256(b",".join(map(names.__getitem__, one))).hexdigest())
                bytes_sha.append(hashlib.sha256(decode_ids(one, vocab)).hexdigest())
            yield pa.record_batch([batch.column(0), pa.array(np.diff(bounds), pa.int64()), pa.array(names_sha, pa.string()),
                                   pa.array(bytes_sha, pa.string())], schema=schema)

    return _input(df, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
