"""Periodic runs of words by Baier grouping.

A run is a stretch of consecutive words with smallest period q and length >= max(6, 4q) that no neighbouring word extends.
Words are the parts between ``[\\x20\\x09-\\x0D]``; each document is judged alone.

1. *Regions.* In a run, each five words that follow each other come again (before or after) within a quarter of the run's length.
   Words outside every such five-word window can't lie in a run; they cut the text into regions, and the rule is used again inside
   them. This only takes words away that no run holds (each round is exact; hash collisions keep more). Windows of a
   whole block of documents are sorted at once.
2. *Baier grouping.* In a region, suffixes are grouped by their first word. The groups are taken from the largest to the
   smallest. Every suffix of the taken group (context u) looks for the nearest suffix before it that wasn't taken yet (union-find on the
   taken ones); that one's context v grows to v u^m, m being how many suffixes of the group found it, and it moves to a new
   group right above its old one (the larger m, the higher). When a group is taken, its context is the longest Lyndon word at each of
   its suffixes: the Lyndon array, without a suffix array.
3. *Both orders.* The same is done with the order of the words reversed. A run's Lyndon root is the longest Lyndon word at each
   place it begins, in one of the two orders; a run of exponent 4 holds three such places at least.
4. *LCE.* The first root of each chain is extended to both sides by longest common extensions (doubling, then halving block comparisons).

At scale: one pass over the documents, no shuffle, nothing is collected; a copy or a hot source is work of its own rows only.
Every document is one task's work: about 100 bytes of memory a word for the longest one.

Cases: null and empty texts have no words and no run; texts of any length are read whole; equal longest runs: smallest start, then period;
every row is a document, so repeated rows and ids give a row each, null ids stay null (and such texts are never tiled); only the two named columns
are read, so others may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import byte_blocks, ship_package

#: A run is at least so long, and at least so many times its period.
LEAST, TIMES = 6, 4

#: Words in a window, and rounds of the reduction (any number gives the same runs).
WINDOW, ROUNDS = 5, 6

_MIX = np.uint64(0x9E3779B97F4A7C15)


def regions(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(first, length)`` of the stretches that may hold runs, for documents of the given lengths one after the other."""
    at = np.arange(len(codes))
    first, length = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64), np.asarray(lengths, np.int64)
    for _ in range(ROUNDS):
        long = length >= LEAST
        first, length = first[long], length[long]
        if not len(first):
            break
        # the words of the regions, side by side
        ends = np.cumsum(length)
        region = np.repeat(np.arange(len(first)), length)
        at = np.arange(ends[-1]) - np.repeat(ends - length, length) + np.repeat(first, length)
        code = codes[at].astype(np.uint64)
        windows = len(code) - WINDOW + 1
        key = region[:windows].astype(np.uint64)
        with np.errstate(over="ignore"):
            for k in range(WINDOW):
                key = (key ^ (key >> np.uint64(29))) * _MIX + code[k:k + windows]
        whole = np.flatnonzero(region[:windows] == region[WINDOW - 1:])
        order = whole[np.argsort(key[whole], kind="stable")]
        here, after = order[:-1], order[1:]
        again = (key[here] == key[after]) & (region[here] == region[after]) & (TIMES * (after - here) <= length[region[here]])
        found = np.zeros(len(code) + 1, np.int32)
        for side in (here, after):
            starts = np.zeros(len(code) + 1, bool)
            starts[side[again]] = True
            found[:len(code)] |= starts[:len(code)]
        covered = np.cumsum(found)
        covered[WINDOW:] -= covered[:-WINDOW].copy()
        kept = covered[:len(code)] > 0
        if kept.all():
            break
        # stretches of kept words within a region
        change = np.flatnonzero(np.concatenate([[True], (kept[1:] != kept[:-1]) | (region[1:] != region[:-1])]))
        size = np.diff(np.append(change, len(code)))
        change, size = change[kept[change]], size[kept[change]]
        first, length = at[change], size
    return first, length


def lyndon_array(letters: list[int], kinds: int) -> list[int]:
    """The length of the longest Lyndon word at each place, letters being 0 to ``kinds - 1``: phase one of Baier's suffix sorting."""
    n = len(letters)
    groups: list[list[int]] = [[] for _ in range(kinds)]
    for i, c in enumerate(letters):
        groups[c].append(i)
    of, live = list(letters), [len(g) for g in groups]
    length = [1] * kinds
    below, above = list(range(-1, kinds - 1)), list(range(1, kinds + 1))
    above[-1] = -1
    free = list(range(n + 1))  # place i is i + 1 here; the nearest place up to it that wasn't taken, 0: none
    out = [0] * n
    g = kinds - 1
    while g >= 0:
        size = length[g]
        taken = groups[g] if live[g] == len(groups[g]) else [s for s in groups[g] if of[s] == g]
        groups[g] = []
        for s in taken:
            out[s] = size
            free[s + 1] = s
        times: dict[int, int] = {}
        for s in taken:
            while free[s] != s:
                free[s] = s = free[free[s]]
            if s:
                times[s - 1] = times.get(s - 1, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for p, m in times.items():
            moved.setdefault((m, of[p]), []).append(p)
        for m, old in sorted(moved, reverse=True) if len(moved) > 1 else moved:
            places = moved[m, old]
            if live[old] == len(places):  # the whole group grows
                length[old] += m * size
                continue
            live[old] -= len(places)
            new = len(groups)
            groups.append(sorted(places))
            live.append(len(places))
            length.append(length[old] + m * size)
            for p in places:
                of[p] = new
            up = above[old]
            below.append(old)
            above.append(up)
            above[old] = new
            below[up] = new
        g = below[g]
    return out


def _same(buffer: bytes, a: int, b: int, size: int) -> bool:
    return buffer[8 * a:8 * (a + size)] == buffer[8 * b:8 * (b + size)]


def common_extension(buffer: bytes, a: int, b: int, most: int, back: bool = False) -> int:
    """How many words from ``a`` and ``b`` on (``back``: before them) are equal, ``most`` at most: doubling, then halving."""
    done, step = 0, 8
    while done < most:
        step = min(step, most - done)
        at = -done - step if back else done
        if _same(buffer, a + at, b + at, step):
            done += step
            step *= 2
        elif step == 1:
            break
        else:
            step //= 2
            most = min(most, done + 2 * step + 1)
    return done


def runs_of(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of the runs of a text, sorted by start and period."""
    kinds, letters = np.unique(codes, return_inverse=True)
    n, buffer, out = len(codes), codes.astype(np.int64).tobytes(), set()
    for order in (letters, len(kinds) - 1 - letters):
        root = np.array(lyndon_array(order.tolist(), len(kinds)))
        i = np.arange(n)
        i = i[i + 2 * root < n]
        p = root[i]
        chain = (root[i + p] == p) & (root[i + 2 * p] == p) & (order[i] == order[i + p]) & (order[i] == order[i + 2 * p])
        seen: dict[int, int] = {}
        for at, q in zip(i[chain].tolist(), p[chain].tolist(), strict=True):
            if at < seen.get(q, 0):  # a later root of a stretch that was extended already
                continue
            left = common_extension(buffer, at, at + q, at, back=True)
            size = left + q + common_extension(buffer, at, at + q, n - at - q)
            seen[q] = at - left + size - q
            if size >= max(LEAST, TIMES * q):
                out.add((at - left, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def tiled(words: list[bytes], h: int | None) -> list[bytes]:
    """The contract's rewriting: with ``h % 10 = 0`` the words from ``a`` on repeat the first ``p`` of them."""
    n = len(words)
    if h is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (1 + (n - a) // p))[:n - a]


def block_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words."""
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    lengths = np.array([len(t) for t in texts], np.int64)
    codes = np.fromiter((number[w] for t in texts for w in t), np.int64, int(lengths.sum()))
    ends = np.cumsum(lengths)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(codes):
        return out
    first, size = regions(codes, lengths)
    document = np.searchsorted(ends, first, "right")
    for d, at, n in zip(document.tolist(), first.tolist(), size.tolist(), strict=True):
        if n >= LEAST:
            base = at - int(ends[d] - lengths[d])
            out[d] += [(base + s, m, q) for s, m, q in runs_of(codes[at:at + n])]
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    if runs:
        gone = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            gone[start + period] += 1
            gone[start + length] -= 1
        words = [w for w, k in zip(words, np.cumsum(gone).tolist(), strict=False) if not k]
    return b" ".join(words)


_RUN = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])


def _map(df: DataFrame, id_col: str, text_col: str, tile: bool, fields: list, ddl: str, row) -> DataFrame:
    ship_package(df.sparkSession)
    ids = F.col(f"`{id_col}`").cast("long")
    schema = pa.schema([("doc_id", pa.int64()), *fields])

    def run(batches):
        for block in byte_blocks(batches):
            ids, tiles = block.column(1).to_pylist(), block.column(2).to_pylist()
            texts = [tiled((t or b"").split(), h) for t, h in zip(block.column(0).to_pylist(), tiles, strict=True)]
            rows = [(i, *row(w, r)) for i, w, r in zip(ids, texts, block_runs(texts), strict=True)]
            if rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return df.select(F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"), ids.alias("doc_id"),
                     (F.crc32(ids.cast("string").cast("binary")) if tile else F.lit(None).cast("long")).alias("tile")).mapInArrow(run, f"doc_id long, {ddl}")


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: bool = False) -> DataFrame:
    """Per row: doc_id, runs (array of start, length, period) and the collapsed text. ``tile`` rewrites a tenth of the texts first."""
    def row(words, runs):
        return [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], collapsed(words, runs).decode("utf-8", "replace")

    return _map(df, id_col, text_col, tile, [("runs", pa.list_(_RUN)), ("collapsed", pa.string())],
                "runs array<struct<start: long, length: long, period: long>>, collapsed string", row)


def runs_digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: bool = True) -> DataFrame:
    """Per row: doc_id, n_runs, the longest run's start, length, period, exponent_milli, runs_sha256, collapsed_sha256."""
    def row(words, runs):
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        start, length, period = best or (None, None, None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        return (len(runs), start, length, period, 1000 * length // period if best else None,
                hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs)).hexdigest())

    longs = ("n_runs", "start", "length", "period", "exponent_milli")
    return _map(df, id_col, text_col, tile, [*((n, pa.int64()) for n in longs), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())],
                ", ".join(f"{n} long" for n in longs) + ", runs_sha256 string, collapsed_sha256 string", row)
