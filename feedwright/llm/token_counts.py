"""Count-only Viterbi: the number of pieces of a text under a unigram vocabulary.

The vocabulary is the list of pieces and scores of a sentencepiece file. (No public file here
was trained as a unigram model, so the pieces and scores of ``piece_bpe_32k.model`` are
taken as one; the reference of the tests is the sentencepiece library on the same file with the model type
set to unigram.) An Aho-Corasick automaton lists every vocabulary match of a word with its end;
dynamic programming over the ends carries only the best score and the number of pieces. Tie rules are the
library's: only a strictly better score replaces one, candidates come by ascending start, and a
character that is no piece itself may stand alone as unknown, tried last, with the lowest score minus 10, and counts
as its UTF-8 bytes (byte fallback).

``sums`` names the arithmetic of the scores. ``"exact"`` adds without rounding; it gives the paths of the library's n-best list. ``"library"`` is
that of its ``encode``, and gives its counts: 32-bit floats, and where the best score on arriving at a character is beyond ``REBASE`` it is
subtracted from those of all ends beyond it that a piece has reached, and becomes 0. This file has pieces of -1e9 (runs of blank marks, a single one too), near which
that rounds scores to multiples of 64: "the" alone is one piece though "_t" + "he" has the better sum, and after "Ores" it is two.
The score returned is the exact sum over the path taken.

Texts are split at their words: no piece holds a blank mark after another character, hence every path has a boundary
before each run of marks. With exact sums a word's count is the same everywhere; with the library's it depends on the score on arrival, which is handed from word to word.
Where the scores are whole numbers and a lone mark is rounded to multiples of ``step``, only the score's rest by that step matters, so a word has few results.
Words are counted once per block (and score on arrival) and kept by the worker within a bound of words and of characters; nothing is shuffled.
With the library's sums two such bounds are kept, and a word of the older one moves to the newer when it comes up again, so frequent words aren't counted anew;
a block's new words are looked at together, and most turn out to have one result for every score on arrival.

Cases: null and empty texts have 0 pieces and score 0; null ids stay null; repeated rows count row by row; an empty table gives
an empty result; a word of any length is handled in time linear in its matches.
"""

from __future__ import annotations

import gc
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm import vocabularies
from feedwright.llm.common import byte_blocks, ship_package

FILE = "piece_bpe_32k.model"
MARK = "▁"
BLOCK = 1 << 22
KEEP = 400_000
KEEP_CHARS = 32 * KEEP
GROUP = 8192  # new words looked at together
FEW = 64  # fewer are counted one by one
LONG = 32  # longer words are, too
REBASE = 100_000.0  # fixed value of the library
EXACT = float(1 << 24)
NONE = float("-inf")
UNKNOWN_PENALTY = 10.0


def _step(score: dict[str, float], unknown: float) -> float | None:
    """The spacing of 32-bit floats at a lone mark's score, if a score on arrival matters by its rest only.

    That holds if all other scores are whole numbers whose sums with one on arrival are exact, and the lone mark's is so low that it is always
    subtracted: an even multiple of the spacing, far enough inside its power of two. A break of lines then always leaves 0.
    """
    mark = score.get(MARK)
    usual = [s for s in score.values() if s != mark]
    if mark is None or mark > -(1 << 26) or unknown > -(1 << 26) or any(s != int(s) or abs(s) > (1 << 22) for s in usual):
        return None
    step = float(np.spacing(np.float32(-mark)))
    inside = all(np.spacing(np.float32(-mark + d)) == step for d in (-4 * REBASE, 4 * REBASE))
    return step if inside and mark % (2 * step) == 0 else None


class Unigram:
    """Automaton over the normal pieces of a vocabulary; ``sums``: "exact" or "library"."""

    def __init__(self, pieces: list[tuple[str, float, int]], sums: str = "exact"):
        import ahocorasick

        if sums not in ("exact", "library"):
            raise ValueError(f"sums is exact or library, not {sums!r}")

        normal = [(p, s) for p, s, kind in pieces if kind == 1]
        if any(MARK in p.lstrip(MARK) for p, _ in normal):
            raise ValueError("a piece spans words: texts can't be split at blanks")
        self.unknown = min(s for _, s in normal) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for p, s in normal:
            self.automaton.add_word(p, (len(p), s))
        self.automaton.make_automaton()
        # line breaks that stand in no piece are boundaries too: shorter words, the same paths
        alone = "" if any("\n" in p for p, _ in normal) else "\n"
        self.words = re.compile(rf"\n|{MARK}*[^{MARK}\n]+|{MARK}+" if alone else rf"{MARK}*[^{MARK}]+|{MARK}+").findall
        self.library = sums == "library"
        self.step = _step({p: x for p, x in normal}, self.unknown) if alone else None
        if self.library and self.step:
            self._beginnings(dict(normal))
        self._forget()

    def _beginnings(self, score: dict[str, float]):
        """All beginnings of pieces, numbered from 1 (0: the empty one), as arrays: many words are looked at together."""
        numbers = {"": 0}
        for p in score:
            for n in range(1, len(p) + 1):
                numbers.setdefault(p[:n], len(numbers))
        chars = sorted({c for p in score for c in p if c != "\0"})  # 0 is no character of a piece, or none at all
        code = {c: i for i, c in enumerate(chars, 1)}
        self.code = np.zeros(0x110000, np.int32)
        self.code[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.codes = len(chars) + 1
        # (beginning, next character) -> beginning
        after = sorted((numbers[p[:-1]] * self.codes + code.get(p[-1], 0), n) for p, n in numbers.items() if p and "\0" not in p)
        self.steps, self.next = np.array([*after, (1 << 62, 0)], np.int64).T.copy()
        self.value = np.array([score.get(p, NONE) for p in numbers])
        self.longest = max(map(len, score))

    def _forget(self):
        # words seen so far get numbers; by number: pieces and score
        self.known: defaultdict[str, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.counts, self.scores = np.zeros(0, np.int64), np.zeros(0)
        # library sums: word -> (low, high, pieces, score, score on arrival at the next word) for arrivals between, or for the one that low and high are
        self.ways: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}  # those of the time before, until they are asked for again
        self.results = self.chars = 0

    def word(self, word: str) -> tuple[int, float]:
        """(pieces, score) of the best path."""
        n = len(word)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        matches: list[list[tuple[int, float]]] = [[] for _ in word]
        for last, match in self.automaton.iter(word):
            matches[last].append(match)  # the longest first: ascending starts
        for last, found in enumerate(matches):
            top, pieces = None, 0
            for length, score in found:
                start = last + 1 - length
                s = best[start] + score
                if top is None or s > top:
                    top, pieces = s, count[start] + 1
            if not found or found[-1][0] != 1:
                s = best[last] + self.unknown
                if top is None or s > top:
                    top, pieces = s, count[last] + len(word[last].encode())
            best[last + 1], count[last + 1] = top, pieces
        return count[n], best[n]

    def library_word(self, word: str, arrival: float = 0.0) -> tuple[int, float, float]:
        """(pieces, exact score, score on arrival at the next word) of the path that the library's sums make the best."""
        n = len(word)
        best, count, total = [arrival] + [0.0] * n, [0] * (n + 1), [0.0] * (n + 1)
        moved, last_moved = [], 0  # places whose score was subtracted from all open ends, with that score
        exact = EXACT if self.step else -1.0  # whole numbers below it need no rounding
        one = array("f", [self.unknown])  # an array rounds what it stores
        unknown = one[0]
        matches: list[list[tuple[int, float]]] = [[] for _ in word]
        for last, match in self.automaton.iter(word):
            matches[last].append(match)  # the longest first: ascending starts

        def at(value, seen, now):
            """An open end's value of the time of place ``seen``, at that of place ``now``."""
            for place, score in moved:
                if seen < place <= now:
                    one[0] = value - score
                    value = one[0]
            return value

        for last, found in enumerate(matches):
            top, seen = None, 0
            for length, score in found:
                start = last + 1 - length
                if last_moved > seen and top is not None:
                    top = at(top, seen, start)
                s, seen = best[start] + score, start
                if s > exact or s < -exact:
                    one[0] = s
                    s = one[0]
                if top is None or s > top:
                    top, pieces, whole = s, count[start] + 1, total[start] + score
            if not found or found[-1][0] != 1:
                if last_moved > seen and top is not None:
                    top = at(top, seen, last)
                one[0] = best[last] + unknown
                if top is None or one[0] > top:
                    top, pieces, whole = one[0], count[last] + len(word[last].encode()), total[last] + self.unknown
            end = last + 1
            if top > REBASE or top < -REBASE:
                moved.append((end, top))
                last_moved, top = end, 0.0
            best[end], count[end], total[end] = top, pieces, whole
        after = best[n]
        if self.step:
            after -= self.step * round(after / self.step)  # halves to the even one, as sums are rounded
        return count[n], total[n], after

    def usual_word(self, word: str, arrival: float):
        """What :meth:`library_word` gives for most words, and the open interval of arrivals with that result; None for other words.

        The lone mark is subtracted first, which leaves the pieces from the word's start on at whole steps; then the piece of mark and first
        character is, which leaves it 0, the longer ones at whole steps from it, and what begins after the lone mark beyond reach. From there on sums are exact.
        """
        step, n = self.step, len(word)
        if not step or n < 2 or word[0] != MARK or word[1] == MARK:
            return None
        half = step / 2
        best, back, first, one = [0.0] * (n + 1), [0] * (n + 1), {}, None
        done, top, at = 2, NONE, 0  # characters whose best score is known, then the best so far of the next one
        for last, (length, score) in self.automaton.iter(word):  # by end, the longest first: ascending starts
            start = last + 1 - length
            if start > 1:
                s = best[start] + score
                if s > top:
                    top, at = s, start
                if length == 1:
                    if last != done or top > REBASE or top < -REBASE:
                        return None
                    done += 1
                    best[done], back[done] = top, at
                    top = NONE
            elif start or not last:
                continue
            elif last > 1:
                if one is None:
                    return None
                steps = round((arrival + score) / step)
                edge = steps * step - score
                if edge - half > low:
                    low = edge - half
                if edge + half < high:
                    high = edge + half
                top, at = (steps - base) * step, 0
                first[last + 1] = top, score
            else:
                one = score
                base = round((arrival + one) / step)
                low, high = max(-half, base * step - half - one), min(half, base * step + half - one)
                first[2] = 0.0, one
        if done != n or one is None:
            return None
        end, pieces = n, 1
        while back[end]:
            end = back[end]
            pieces += 1
        whole_steps, score = first[end]
        after = best[n]
        return low, high, (pieces, after - whole_steps + score, after - step * round(after / step))

    def usual_words(self, words: list[str]) -> dict[str, tuple[float, float, int, float, float]]:
        """The words for which :meth:`usual_word` gives one result for all scores on arrival: that result, as it is kept.

        These scores lie within half a step of 0, so between two of them each first piece moves by a step at most, all to the same side.
        Hence what leads by more than a step on an arrival at 0 always leads, and only ends on the best path matter. The score handed on is the same
        up to whole steps, and so the same unless it is half a step, which may be rounded to either side.
        """
        words = sorted((w for w in words if 1 < len(w) <= LONG and w[0] == MARK != w[1]) if self.step else (), key=len)
        found = {}
        for i in range(0, len(words), GROUP):
            group = words[i:i + GROUP]
            good, *results = self._usual(group)
            found |= {w: (-self.step, self.step, *r) for w, ok, *r in zip(group, good.tolist(), *(r.tolist() for r in results), strict=True) if ok}
        return found

    def _matches(self, text: np.ndarray, start: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of words (by column) from a character on: (length, the words with a piece's beginning of this length there, the pieces' scores)."""
        here, at = np.arange(text.shape[1]), np.zeros(text.shape[1], np.int64)
        for length in range(1, min(self.longest, len(text) - start) + 1):
            key = at * self.codes + text[start + length - 1, here]
            i = np.searchsorted(self.steps, key)
            same = np.flatnonzero(self.steps[i] == key)
            here, at = here[same], self.next[i[same]]
            if not len(here):
                return
            yield length, here, self.value[at]

    def _usual(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """Whether a word has one result for all scores on arrival; pieces, score, score on arrival at the next word."""
        step, longest, each = self.step, max(map(len, words)), np.arange(len(words))
        n = np.fromiter(map(len, words), np.int64, len(words))
        text = self.code[np.array(words, f"U{longest}").view(np.uint32).reshape(-1, longest)].T.copy()
        # by end and word: the best sum and the next best so far, the best one's last piece; then pieces, score and whether the lead is too small
        best, other = np.full((longest + 1, len(words)), NONE), np.full((longest + 1, len(words)), NONE)
        start, score = np.zeros(best.shape, np.int64), np.zeros(best.shape)
        pieces, total, close = np.zeros(best.shape, np.int64), np.zeros(best.shape), np.zeros(best.shape, bool)

        def reach(end, here, sums, begin, scores):
            top = best[end, here]
            lead = sums > top
            other[end, here] = np.maximum(other[end, here], np.where(lead, top, sums))
            here = here[lead]
            best[end, here], start[end, here], score[end, here] = sums[lead], begin, scores[lead]

        base = np.zeros(len(words))
        for length, here, value in self._matches(text, 0):
            if length == 2:
                is_piece = value > NONE
                base[here] = np.rint(np.where(is_piece, value, 0.0) / step)
                reach(2, here[is_piece], np.zeros(is_piece.sum()), 0, value[is_piece])
            elif length > 2:
                reach(length, here, (np.rint(value / step) - base[here]) * step, 0, value)
        good = best[2] == 0
        for at in range(2, longest + 1):
            good &= (np.abs(best[at]) <= REBASE - step) | (at > n)
            pieces[at] = pieces[start[at], each] + 1
            total[at] = total[start[at], each] + score[at]
            close[at] = close[start[at], each] | (other[at] >= best[at] - step)
            alone = np.zeros(len(words), bool)
            for length, here, value in self._matches(text, at) if at < longest else ():
                if length == 1:
                    alone[here] = value > NONE
                reach(at + length, here, best[at, here] + value, at, value)
            good &= alone | (at >= n)
        after = best[n, each]
        with np.errstate(invalid="ignore"):
            after = after - step * np.rint(after / step)
            good &= ~close[n, each] & (np.abs(after) < step / 2)
        return good, pieces[n, each], total[n, each], after

    def library_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces and score of each text by the library's sums."""
        number: defaultdict[str, int] = defaultdict()
        number.default_factory = number.__len__
        split = [np.fromiter(map(number.__getitem__, words), np.int64, len(words))
                 for words in (self.words((MARK + t).replace(" ", MARK)) if t else [] for t in texts)]
        distinct = list(number)
        kept = [self._known(w) for w in distinct]
        new = [i for i, known in enumerate(kept) if not known]
        found = self.usual_words([distinct[i] for i in new]) if len(new) >= FEW else {}
        for i in new:
            if result := found.get(distinct[i]):
                kept[i] = self._keep(distinct[i], self._known(distinct[i]), result)
        # by number of the word: pieces, score, score on arrival at the next word (not a number where it depends on that at this one)
        always = -self.step if self.step else None
        varies = (0.0, 0.0, 0, 0.0, np.nan)
        results = (known[0] if known and known[0][0] == always else varies for known in kept)
        _, _, *results = np.fromiter(chain.from_iterable(results), np.float64, 5 * len(kept)).reshape(-1, 5).T.copy()
        word = np.concatenate([np.zeros(0, np.int64), *split])
        owner = np.repeat(np.arange(len(texts)), [len(s) for s in split])
        pieces, total, after = (r[word] for r in results)
        arrivals = np.concatenate([[0.0], after])[:-1]
        arrivals[np.diff(owner, prepend=-1) > 0] = 0.0
        open_ = np.flatnonzero(np.isnan(after))
        counted, last, get = [], 0.0, self.ways.get
        for i, arrival in zip(word[open_].tolist(), arrivals[open_].tolist(), strict=True):
            if arrival != arrival:  # after a word of this loop
                arrival = last
            w = distinct[i]
            for low, high, n, score, last in get(w, ()):
                if low < arrival < high or low == arrival == high:
                    break
            else:
                n, score, last = self._way(w, arrival)
                get = self.ways.get
            counted.append((n, score))
        if counted:
            pieces[open_], total[open_] = np.array(counted).T
        sums = [np.bincount(owner, weights=v, minlength=len(texts)) for v in (pieces, total)]
        return sums[0].astype(np.int64), sums[1]

    def _known(self, word: str) -> tuple:
        """The results kept of a word."""
        if self.results >= KEEP or self.chars >= KEEP_CHARS:
            # frequent words move on to the new time, the others are forgotten at the next turn
            self.older, self.ways, self.results, self.chars = self.ways, {}, 0, 0
        known = self.ways.get(word)
        if known is None and (known := self.older.pop(word, None)):
            self.ways[word] = known
            self.results += len(known)
            self.chars += len(word) * len(known)
        return known or ()

    def _keep(self, word: str, known: tuple, result: tuple) -> tuple:
        """Keeps a result beside those known."""
        self.ways[word] = known = (*known, result)
        self.results += 1
        self.chars += len(word)
        return known

    def _way(self, word: str, arrival: float) -> tuple[int, float, float]:
        """The result of a word for a new score on arrival, kept."""
        known = self._known(word)
        for low, high, *found in known:
            if low < arrival < high or low == arrival == high:
                return found
        usual = self.usual_word(word, arrival)
        low, high, found = usual if usual and usual[0] < arrival < usual[1] else (arrival, arrival, usual[2] if usual else self.library_word(word, arrival))
        self._keep(word, known, (low, high, *found))
        return found

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces and score of each text."""
        if self.library:
            running = gc.isenabled()
            gc.disable()  # the results kept hold no cycles, and searching them again and again takes a third of the time
            try:
                return self.library_texts(texts)
            finally:
                if running:
                    gc.enable()
        if len(self.known) > KEEP or self.chars > KEEP_CHARS:
            self._forget()
        old = len(self.known)
        split = [np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
                 for words in (self.words((MARK + t).replace(" ", MARK)) if t else [] for t in texts)]
        new = [self.word(w) for w in islice(self.known, old, None)]
        self.chars += sum(map(len, islice(self.known, old, None)))
        self.counts = np.concatenate([self.counts, np.array([c for c, _ in new], np.int64)])
        self.scores = np.concatenate([self.scores, np.array([s for _, s in new])])
        word = np.concatenate([np.zeros(0, np.int64), *split])
        owner = np.repeat(np.arange(len(texts)), [len(s) for s in split])
        total = lambda v: np.bincount(owner, weights=v[word], minlength=len(texts))
        return total(self.counts).astype(np.int64), total(self.scores)


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, sums: str = "exact") -> DataFrame:
    """``doc_id, n_tokens, score`` of every row; ``path``: a sentencepiece file; ``sums``: "exact", or "library" for the counts of its ``encode``."""
    spark = df.sparkSession
    ship_package(spark)
    file = vocabularies.shared(spark, path or vocabularies.default_path(FILE))
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("score", pa.float64())])

    def run(batches):
        model = vocabularies.built(("unigram", file.id, sums), lambda: Unigram(vocabularies.pieces(file.value), sums))
        for batch in byte_blocks(batches, BLOCK):
            counts, scores = model.texts(batch.column(1).to_pylist())
            yield pa.record_batch([batch.column(0), pa.array(counts), pa.array(scores)], schema=schema)

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, score double")
