"""Suffix-array dedup: maximal repeats from common-prefix interval trees, and removal of repeated bytes.

Texts are UTF-8 bytes; a repeat has at least ``MIN_LEN`` (100) bytes and never
crosses a document. Steps, each one Spark stage between shuffles:

1. *Sampled suffixes.* In each window of 100 bytes the 24-byte grams of smallest
   hash are anchors. The choice depends on the window's bytes only, so equal windows
   have equal anchors at equal places: suffixes that start at anchors (about one in 39
   bytes) reach every repeat. Only ``(gram hash, context hash, id, offset)`` is
   shuffled, to the bucket of the gram.
2. *Equal contexts.* The context of an anchor is the 76 bytes before and the 100 bytes
   from it on; every 100-byte window that contains the gram lies inside. Of equal contexts
   only the first goes on; the others are repeats over the whole context. A map task already
   folds its own equal contexts and sends the later ones as finished intervals under
   a spread key, so a context shared by any share of all rows is one row per block of a task.
   Grams found once are dropped.
3. *Enhanced suffix array.* The bytes of the remaining contexts are fetched by a join on
   the id and sorted by gram: the suffix array of the bucket with its LCP values.
   A stack scan yields the common-prefix intervals; inside each one the preceding bytes
   are sorted and scanned in the same way: a set of suffixes whose preceding bytes differ
   (left diverse) and which no deeper interval holds whole (right diverse) is a
   maximal repeat with all its occurrences. Repeats are maximal within their
   context; longer ones come as a chain of groups whose union is the whole repeat.
   A gram with more than ``MAX_GROUP`` different contexts (the edge of a passage that a large share of all
   documents hold) would make one task do all of its work: its contexts are cut into their 100-byte windows,
   whose first places are a map-side combined minimum, joined back to the windows. The result is the same.
   :func:`maximal_repeats` lists groups with all occurrences: it keeps the context hash of every place and joins the places
   of equal contexts back to the groups.
4. *Removal.* Every occurrence but the first of each group is covered; the union of the covered
   intervals of a document is removed.

Why this is exact: a window that also starts earlier has its anchor in one bucket
with the earlier copy, and lies in a group of that bucket in which it isn't first; a
covered byte lies in a 100-byte window whose shifted copy starts earlier.

Cases: empty or short texts (under 100 bytes) lose nothing; null text is empty; null and
repeated ids as in :mod:`feedwright.llm.common`; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from feedwright.llm.common import byte_blocks, null_again, one_row_per_id, own_ids, public_id, written

MIN_LEN = 100
GRAM = 24
WINDOW = MIN_LEN - GRAM + 1  # grams in a window
LEFT = MIN_LEN - GRAM  # bytes of context before an anchor
RIGHT = MIN_LEN  # bytes of context from the anchor on
PAD = 192  # zeros between documents of a block: no context reaches the next one
CHUNK = 1 << 18  # bytes hashed at once; longer documents are cut with PAD bytes of overlap
FOLD = 1 << 20  # anchors folded at once in a map task
MARGIN = 256
#: Contexts of one gram that one task compares in memory (about 50 MB). Larger groups go by window hashes (see step 3).
MAX_GROUP = 1 << 16

_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                             0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(31)
    h *= _M[1]
    h ^= h >> np.uint64(29)
    h *= _M[2]
    h ^= h >> np.uint64(32)
    return h


def _gram_hash(x: np.ndarray) -> np.ndarray:
    """Hash of the GRAM values from each place on (len(x) - GRAM + 1 of them)."""
    h = (x + np.uint64(1)) * _M[0]
    h ^= h >> np.uint64(27)
    for n, a in ((1, 3), (2, 4), (4, 5)):
        h = h[:-n] * _M[a] + h[n:]
    eight = h[16:]  # 24 = 16 + 8
    wide = h[:-8] * _M[6] + h[8:]
    return _mix(wide[:len(eight)] * _M[7] + eight)


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        v = np.minimum(v[:-n], v[n:])
        n *= 2
    return np.minimum(v[:len(v) - (width - n)], v[width - n:]) if n < width else v


def _anchors(text: np.ndarray, real: np.ndarray):
    """Places of the anchors of a padded block, their gram hashes and context hashes."""
    x = text.astype(np.uint64)
    x += real
    h = _gram_hash(x)
    inside = np.cumsum(real, dtype=np.int32)
    inside = np.concatenate([np.zeros(1, np.int32), inside])
    order = (h >> np.uint64(32)).astype(np.uint32)
    whole_gram = (inside[GRAM:] - inside[:-GRAM]) == GRAM
    np.maximum(order, np.uint32(1), out=order)
    order[~whole_gram] = np.uint32(0xFFFFFFFF)
    low = _sliding_min(order, WINDOW)
    whole = (inside[MIN_LEN:] - inside[:-MIN_LEN]) == MIN_LEN
    edge = np.full(WINDOW - 1, 0xFFFFFFFF, np.uint32)
    # per gram: the largest minimum of the windows that hold it
    tops = _sliding_min(np.concatenate([edge, np.where(whole, ~low, np.uint32(0xFFFFFFFF)), edge]), WINDOW)
    at = np.flatnonzero((~tops == order) & whole_gram & (tops != np.uint32(0xFFFFFFFF)))
    ctx = np.zeros(len(at), np.uint64)
    for i, shift in enumerate((-76, -52, -28, -4, 20, 44, 68, 76)):
        ctx = (ctx ^ h[at + shift]) * _M[i] + _M[(i + 3) % 8]
        ctx ^= ctx >> np.uint64(30)
    return at, h[at], _mix(ctx)


def _pieces(ids, offsets, data):
    """Documents cut for hashing: (id, first byte kept, one past, slice start, slice end)."""
    for i, doc in enumerate(ids):
        lo, hi = int(offsets[i]), int(offsets[i + 1])
        n = hi - lo
        if n < MIN_LEN:
            continue
        for s in range(0, n, CHUNK):
            e = min(n, s + CHUNK)
            yield doc, s, e, lo, max(0, s - PAD), min(n, e + PAD)


def _block_anchors(ids, offsets, data):
    """(gram hash, context hash, id, offset) of all anchors of a batch."""
    held, size = [], 0

    def flush():
        total = size + MARGIN * (len(held) + 1)
        text, real = np.zeros(total, np.uint8), np.zeros(total, np.uint8)
        starts, at = [], MARGIN
        for _, _, _, lo, a, b in held:
            text[at:at + b - a] = data[lo + a:lo + b]
            real[at:at + b - a] = 1
            starts.append(at)
            at += b - a + MARGIN
        place, gram, ctx = _anchors(text, real)
        which = np.searchsorted(np.array(starts), place, "right") - 1
        first = np.array([a for *_, a, _ in held])
        off = place - np.array(starts)[which] + first[which]
        keep = (off >= np.array([s for _, s, *_ in held])[which]) & (off < np.array([e for _, _, e, *_ in held])[which])
        return gram[keep], ctx[keep], np.array([d for d, *_ in held], np.int64)[which[keep]], off[keep]

    for piece in _pieces(ids, offsets, data):
        held.append(piece)
        size += piece[5] - piece[4]
        if size >= CHUNK:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _binary(col):
    """Offsets and data of a binary Arrow column, as numpy views."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    return offsets, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


_ANCHOR = pa.schema([("key", pa.int64()), ("ctx", pa.int64()), ("id", pa.int64()), ("off", pa.int64())])


def _fold(parts):
    """One row per context of this block; the later ones as finished intervals (offset below 0, spread key)."""
    gram, ctx, ids, off = (np.concatenate(x) for x in zip(*parts, strict=True))
    o = np.lexsort((off, ids, ctx, gram))
    gram, ctx, ids, off = gram[o], ctx[o], ids[o], off[o]
    later = np.zeros(len(o), bool)
    later[1:] = (gram[1:] == gram[:-1]) & (ctx[1:] == ctx[:-1])
    spread = _mix(ids.astype(np.uint64) * _M[0] + off.astype(np.uint64))
    key = np.where(later, spread, gram).view(np.int64)
    ctx = np.where(later, np.uint64(0), ctx).view(np.int64)
    off = np.where(later, -off - 1, off)
    for s in range(0, len(o), 1 << 17):
        e = s + (1 << 17)
        yield pa.record_batch([pa.array(c[s:e]) for c in (key, ctx, ids, off)], schema=_ANCHOR)


def _map_anchors(batches):
    parts, n = [], 0
    for batch in byte_blocks(batches):
        offsets, data = _binary(batch.column(1))
        for part in _block_anchors(batch.column(0).to_pylist(), offsets, data):
            parts.append(part)
            n += len(part[0])
            if n >= FOLD:
                yield from _fold(parts)
                parts, n = [], 0
    if parts:
        yield from _fold(parts)


def _map_places(batches):
    """All anchors of a task, none folded."""
    for batch in byte_blocks(batches):
        offsets, data = _binary(batch.column(1))
        for gram, ctx, ids, off in _block_anchors(batch.column(0).to_pylist(), offsets, data):
            yield pa.record_batch([pa.array(c, pa.int64()) for c in (gram.view(np.int64), ctx.view(np.int64), ids, off)], schema=_ANCHOR)


#: kind: COVERED, a context that an earlier place has; REP, the first of equal contexts; HOT, the same in a large group.
COVERED, REP, HOT = 0, 1, 2
_FOUND = pa.schema([("id", pa.int64()), ("off", pa.int64()), ("kind", pa.int32()), ("key", pa.int64())])


def _equal_contexts(batches, max_group):
    """Later ones of equal contexts, and the first of each where a gram has several contexts."""
    table = [b for b in batches if b.num_rows]
    if not table:
        return
    key, ctx, ids, off = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in table]) for i in range(4))
    done = off < 0
    done_ids, done_off = ids[done], -off[done] - 1
    o = np.lexsort((off, ids, ctx, key))
    o = o[~done[o]]
    key, ctx, ids, off = key[o], ctx[o], ids[o], off[o]
    new_key = np.ones(len(o), bool)
    new_key[1:] = key[1:] != key[:-1]
    first = new_key.copy()
    first[1:] |= ctx[1:] != ctx[:-1]
    group = np.cumsum(new_key) - 1
    contexts = np.bincount(group, weights=first)[group]
    rep = first & (contexts > 1)
    late = ~first
    out_ids = np.concatenate([done_ids, ids[late], ids[rep]])
    out_off = np.concatenate([done_off, off[late], off[rep]])
    out_key = np.concatenate([np.zeros(len(done_ids) + late.sum(), np.int64), key[rep]])
    kind = np.concatenate([np.full(len(done_ids) + late.sum(), COVERED), np.where(contexts[rep] > max_group, HOT, REP)]).astype(np.int32)
    for s in range(0, len(out_ids), 1 << 17):
        e = s + (1 << 17)
        yield pa.record_batch([pa.array(c[s:e]) for c in (out_ids, out_off, kind, out_key)], schema=_FOUND)


_CONTEXT = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("off", pa.int64()), ("left", pa.binary()), ("right", pa.binary())])


def _contexts(batches):
    """The bytes around each wanted anchor."""
    for batch in byte_blocks(batches):
        rows = ([], [], [], [], [])
        for doc, text, wanted in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            for w in wanted:
                off = w["off"]
                for c, v in zip(rows, (w["key"], doc, off, text[max(0, off - LEFT):off], text[off:off + RIGHT]), strict=True):
                    c.append(v)
            if len(rows[0]) >= 1 << 15:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(rows, _CONTEXT, strict=True)], schema=_CONTEXT)
                rows = ([], [], [], [], [])
        if rows[0]:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(rows, _CONTEXT, strict=True)], schema=_CONTEXT)


def _matrix(col, width: int, backwards: bool):
    """Rows of bytes + 1, zero-padded to width; backwards: last byte first. And the lengths."""
    offsets, data = _binary(col)
    lens = (offsets[1:] - offsets[:-1]).astype(np.int64)
    j = np.arange(width)
    at = (offsets[1:, None] - 1 - j) if backwards else (offsets[:-1, None] + j)
    ok = j < lens[:, None]
    out = np.zeros((len(lens), width), np.uint8)
    out[ok] = data[at[ok]] + np.uint8(1)  # UTF-8 has no byte 255
    return out, lens


def _words(m: np.ndarray):
    """Big-endian 8-byte columns of a byte matrix: their order is the order of the rows' bytes."""
    pad = -m.shape[1] % 8
    if pad:
        m = np.concatenate([m, np.zeros((len(m), pad), np.uint8)], axis=1)
    return np.ascontiguousarray(m).view(">u8")


def _lcp(m: np.ndarray, lens: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows a[i] and b[i]."""
    out = np.empty(len(a), np.int64)
    for s in range(0, len(a), 1 << 15):
        differ = m[a[s:s + (1 << 15)]] != m[b[s:s + (1 << 15)]]
        out[s:s + (1 << 15)] = np.where(differ.any(axis=1), differ.argmax(axis=1), m.shape[1])
    return np.minimum(out, np.minimum(lens[a], lens[b]))


def prefix_intervals(lcp: list[int]):
    """Stack scan: the common-prefix intervals (depth, first, last) of a sorted run, ``lcp[i]`` being between i and i + 1."""
    stack = []  # (depth, first)
    for i, depth in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            yield d, first, i
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


class _Run:
    """The suffixes of one gram in suffix order: right LCPs, and the rows' bytes before the anchor."""

    def __init__(self, rows, right_lcp, left, left_len, left_rank, min_len):
        self.rows, self.lcp, self.left, self.left_len, self.rank, self.min_len = rows, right_lcp, left, left_len, left_rank, min_len

    def repeats(self):
        """Maximal repeats: (bytes before the anchor, bytes from it on, rows)."""
        rows, lcp = self.rows, self.lcp
        for depth, lo, hi in prefix_intervals(lcp.tolist()):
            members = rows[lo:hi + 1]
            child = np.concatenate([[0], np.cumsum(lcp[lo:hi] == depth)])
            o = np.argsort(self.rank[members], kind="stable")
            m, child = members[o], child[o]
            shared = _lcp(self.left, self.left_len, m[:-1], m[1:])
            need = self.min_len - depth
            if shared.max() < need:
                continue
            for before, a, b in prefix_intervals(np.where(shared >= need, shared, -1 if need > 0 else shared).tolist()):
                if before >= need and before >= 0 and (child[a:b + 1] != child[a]).any():
                    yield before, depth, m[a:b + 1]


def _bucket_repeats(batches, min_len=MIN_LEN):
    """Per bucket of grams: yields (before, length from the anchor, rows) and the rows' (id, off), first row first."""
    table = [b for b in batches if b.num_rows]
    if not table:
        return
    t = pa.Table.from_batches(table)
    key, ids, off = (t.column(i).to_numpy() for i in range(3))
    right, right_len = _matrix(t.column(4), RIGHT, False)
    left, left_len = _matrix(t.column(3), LEFT, True)
    del t, table
    rw, lw = _words(right), _words(left)
    suffix = np.lexsort([*(rw[:, i] for i in range(rw.shape[1] - 1, -1, -1)), key])
    by_left = np.lexsort([*(lw[:, i] for i in range(lw.shape[1] - 1, -1, -1)), key])
    rank = np.empty(len(key), np.int64)
    rank[by_left] = np.arange(len(key))
    del rw, lw
    sorted_key = key[suffix]
    lcp = _lcp(right, right_len, suffix[:-1], suffix[1:])
    cut = np.flatnonzero(sorted_key[1:] != sorted_key[:-1]) + 1
    starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(key)]])
    # pairs, the usual case, at once
    two = starts[ends - starts == 2]
    a, b = suffix[two], suffix[two + 1]
    before = _lcp(left, left_len, a, b)
    good = before + lcp[two] >= min_len
    yield "pairs", before[good], lcp[two][good], a[good], b[good], ids, off
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        if e - s > 2:
            for found in _Run(suffix[s:e], lcp[s:e - 1], left, left_len, rank, min_len).repeats():
                yield "group", *found, None, ids, off


def _earlier(ids, off, a, b):
    """Where row a comes before row b."""
    return (ids[a] < ids[b]) | ((ids[a] == ids[b]) & (off[a] < off[b]))


_SPAN = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])


def _covered(batches):
    """The largest covered interval around each anchor that isn't first in its groups."""
    reach = None
    for kind, before, length, a, b, ids, off in _bucket_repeats(batches):
        if reach is None:
            reach = np.full((2, len(ids)), -1, np.int64)
        if kind == "pairs":
            late = np.where(_earlier(ids, off, a, b), b, a)
            for side, v in ((0, before), (1, length)):
                np.maximum.at(reach[side], late, v)
        else:
            rows = a
            o = np.lexsort((off[rows], ids[rows]))
            late = rows[o[1:]]
            # rows at the first one's very place (same document, same offset) can't occur: anchors are unique there
            reach[0, late] = np.maximum(reach[0, late], before)
            reach[1, late] = np.maximum(reach[1, late], length)
    if reach is None:
        return
    at = np.flatnonzero(reach[1] >= 0)
    for s in range(0, len(at), 1 << 17):
        r = at[s:s + (1 << 17)]
        yield pa.record_batch([pa.array(ids[r]), pa.array(off[r] - reach[0, r]), pa.array(off[r] + reach[1, r])], schema=_SPAN)


_MEMBER = pa.schema([("key", pa.int64()), ("ctx", pa.int64()), ("left", pa.int64()), ("length", pa.int64()),
                     ("first_id", pa.int64()), ("first_start", pa.int64())])


def _anchored(strings: list[bytes], lefts) -> np.ndarray:
    """Whether the place ``left`` of each string is an anchor by a window inside the string: then every occurrence has that anchor."""
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in strings], dtype=np.int64)])
    data = np.frombuffer(b"".join(strings), np.uint8)
    wide, found = int(offsets[-1]) + 1, []
    for _, _, ids, off in _block_anchors(range(len(strings)), offsets, data):
        found.append(ids * wide + off)
    at = np.arange(len(strings)) * wide + np.asarray(lefts, np.int64)
    return np.isin(at, np.concatenate(found)) if found else np.zeros(len(strings), bool)


def _groups(batches):
    """The contexts in each repeat of a bucket's grams, one row each."""
    table = [b for b in batches if b.num_rows]
    if not table:
        return
    ctx = np.concatenate([b.column(5).to_numpy() for b in table])
    t = pa.Table.from_batches(table)
    key = t.column(0).to_numpy()
    lefts, rights = t.column(3).combine_chunks(), t.column(4).combine_chunks()

    def rows(found):
        strings = [lefts[int(m[0])].as_py()[-left:] * (left > 0) + rights[int(m[0])].as_py()[:right] for left, right, m in found]
        out = []
        for (left, right, m), good in zip(found, _anchored(strings, [f[0] for f in found]), strict=True):
            if good:
                f = m[np.lexsort((off[m], ids[m]))[0]]
                n = len(m)
                out.append((key[m], ctx[m], np.full(n, left), np.full(n, left + right), np.full(n, ids[f]), np.full(n, off[f] - left)))
        if out:
            yield pa.record_batch([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out, strict=True)], schema=_MEMBER)

    held, size = [], 0
    for kind, before, length, a, b, ids, off in _bucket_repeats(table):
        new = zip(before.tolist(), length.tolist(), np.stack([a, b], axis=1), strict=True) if kind == "pairs" else [(before, length, a)]
        for one in new:
            held.append((int(one[0]), int(one[1]), one[2]))
            size += len(one[2])
            if size >= 1 << 15:
                yield from rows(held)
                held, size = [], 0
    if held:
        yield from rows(held)


def _ddl(schema: pa.Schema) -> str:
    names = {"int64": "long", "int32": "int", "bool": "boolean", "binary": "binary", "string": "string"}
    return ", ".join(f"`{f.name}` {names[str(f.type)]}" for f in schema)


def _windows(batches):
    """Every 100-byte window around an anchor of a large group: its hash and place."""
    for batch in byte_blocks(batches, 1 << 20):
        rows = ([], [], [], [])
        for key, doc, off, left, right in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            context = left + right
            for s in range(min(len(left) + 1, len(context) - MIN_LEN + 1)):
                digest = hashlib.blake2b(context[s:s + MIN_LEN], digest_size=16).digest()
                for c, v in zip(rows, (key, digest, doc, off - len(left) + s), strict=True):
                    c.append(v)
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(rows, _WINDOW, strict=True)], schema=_WINDOW)


_WINDOW = pa.schema([("key", pa.int64()), ("digest", pa.binary()), ("id", pa.int64()), ("start", pa.int64())])


def _stages(docs: DataFrame, max_group: int | None = None):
    """Anchors with their verdict, and the contexts to compare (usual and large groups) of unique documents (id, text)."""
    max_group = MAX_GROUP if max_group is None else max_group
    raw = docs.select("id", F.col("text").cast("binary").alias("text"))
    anchors = raw.mapInArrow(_map_anchors, _ddl(_ANCHOR))
    found = written(anchors.repartition("key").mapInArrow(lambda it: _equal_contexts(it, max_group), _ddl(_FOUND)), "anchors")

    def contexts(kind):
        wanted = found.filter(F.col("kind") == kind).groupBy("id").agg(F.collect_list(F.struct("off", "key")).alias("wanted"))
        return raw.join(wanted, "id").select("id", "text", "wanted").mapInArrow(_contexts, _ddl(_CONTEXT))

    return found, contexts(REP).repartition("key"), contexts(HOT)


_HOT_GROUP = ["key", "head", "tail"]


def _hot_members(contexts: DataFrame) -> DataFrame:
    """What :func:`_groups` finds, for grams with any number of contexts: its two trees as counts of equal prefixes.

    A prefix of the bytes from the anchor on branches if its contexts go on in different ways (an end is a way of its own);
    inside it, the same is asked of the bytes before. A row per context and prefix, combined in the map tasks.
    """
    byte = lambda c, at: F.coalesce(F.conv(F.hex(F.substring(c, at, F.lit(1))), 16, 10).cast("int"), F.lit(-1))
    rows = contexts.select("key", "ctx", "id", "off", "right", "n_left", "n_right", F.reverse(F.hex("left")).alias("back"))
    # the bytes before, last first: their hex digits reversed, two for a byte
    branches = lambda c: (F.min(c) < F.max(c)) | (F.min(c) == -1)
    way = lambda c, at: F.coalesce(F.nullif(F.substring(c, at, F.lit(2)), F.lit("")), F.lit("-"))
    heads = (rows.select("key", "right", "n_right", F.explode(F.sequence(F.lit(GRAM), "n_right")).alias("depth"))
             .select("key", F.substring("right", F.lit(1), F.col("depth")).alias("head"), byte("right", F.col("depth") + 1).alias("next"))
             .groupBy("key", "head").agg(F.count("*").alias("n"), branches("next").alias("ok")).filter("n > 1 and ok").select("key", "head"))
    of = (rows.withColumn("depth", F.explode(F.sequence(F.lit(GRAM), "n_right")))
          .withColumn("head", F.substring("right", F.lit(1), F.col("depth"))).join(heads, ["key", "head"])
          .withColumn("least", F.greatest(F.lit(0), MIN_LEN - F.col("depth"))).filter("least <= n_left"))
    tails = (of.select("key", "ctx", "id", "off", "head", "depth", byte("right", F.col("depth") + 1).alias("next"), "back",
                       F.explode(F.sequence("least", "n_left")).alias("before"))
             .select("key", "ctx", "id", "off", "head", "depth", "next", "before", F.substring("back", F.lit(1), 2 * F.col("before")).alias("tail"),
                     way("back", 2 * F.col("before") + 1).alias("way")))
    tails = written(tails, "hot-tails")
    groups = (tails.groupBy(*_HOT_GROUP).agg(F.count("*").alias("n"), branches("next").alias("ok"), F.min("way").alias("low"), F.max("way").alias("high"),
                                             F.min(F.struct("id", "off")).alias("first"), F.first("before").alias("before"))
              .filter("n > 1 and ok and (low < high or low = '-')")
              .select(*_HOT_GROUP, "first", F.concat(F.unhex(F.reverse("tail")), "head").alias("string"), F.col("before").cast("long").alias("before")))

    def own(batches):
        for batch in byte_blocks(batches, 1 << 20):
            at = batch.schema.get_field_index("string")
            good = _anchored(batch.column(at).to_pylist(), batch.column(at + 1).to_pylist())
            yield batch.filter(pa.array(good))

    groups = groups.mapInArrow(own, groups.schema)
    return tails.select("key", "ctx", "head", "tail").join(groups, _HOT_GROUP).select(
        "key", "ctx", F.col("before").alias("left"), F.length("string").cast("long").alias("length"), F.col("first.id").alias("first_id"),
        (F.col("first.off") - F.col("before")).alias("first_start"))


def maximal_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_group: int | None = None) -> DataFrame:
    """Maximal repeat groups: ``(repeat, length, doc_id, start, first)``, one row per occurrence, all occurrences listed.

    Groups are found on one place per different context of a gram; equal contexts are a repeat by themselves, and the places of
    a context are joined back to the groups it is in. Of a group that several anchors find one is kept. Grams with over
    ``max_group`` contexts take another path to the same groups.
    """
    max_group = MAX_GROUP if max_group is None else max_group
    df, low = own_ids(df, id_col)
    docs = one_row_per_id(df, id_col, text_col)
    raw = docs.select("id", F.col("text").cast("binary").alias("text"))
    places = written(raw.mapInArrow(_map_places, _ddl(_ANCHOR)), "places")
    # different contexts with their first places; a gram's number of them
    classes = written(places.groupBy("key", "ctx").agg(F.min(F.struct("id", "off")).alias("p"), F.count("*").alias("n"))
                      .select("key", "ctx", "p.id", "p.off", "n"), "contexts")
    grams = classes.groupBy("key").agg(F.count("*").alias("contexts"), F.sum("n").alias("places")).filter("places > 1").select("key", "contexts")
    reps = classes.join(grams, "key").select("key", "ctx", "id", "off", "n", "contexts")
    wanted = reps.groupBy("id").agg(F.collect_list(F.struct("off", "key")).alias("wanted"))
    around = raw.join(wanted, "id").select("id", "text", "wanted").mapInArrow(_contexts, _ddl(_CONTEXT))
    # an anchor is one place of one document
    found = written(around.join(reps.select("id", "off", "ctx", "n", "contexts"), ["id", "off"])
                    .select("key", "id", "off", "left", "right", "ctx", "n", "contexts", F.length("left").alias("n_left"), F.length("right").alias("n_right")),
                    "around")
    several = found.filter((F.col("contexts") > 1) & (F.col("contexts") <= max_group)).select("key", "id", "off", "left", "right", "ctx")
    members = several.repartition("key").mapInArrow(_groups, _ddl(_MEMBER))
    hot = found.filter(F.col("contexts") > max_group)
    if hot.limit(1).count():
        members = members.unionByName(_hot_members(hot))
    members = written(members, "members")
    # the whole of equal contexts, unless (at an end of a document) a longer context holds it: then a group above has both
    alike = found.filter("n > 1").select(
        "key", "ctx", F.col("n_left").cast("long").alias("left"), (F.col("n_left") + F.col("n_right")).cast("long").alias("length"),
        F.col("id").alias("first_id"), (F.col("off") - F.col("n_left")).alias("first_start"))
    members = members.unionByName(alike.join(members, ["key", "ctx", "left", "length"], "left_anti").select(*members.columns))
    name = ["first_id", "first_start", "length"]
    one = members.groupBy(*name).agg(F.min(F.struct("key", "left")).alias("of")).select(*name, "of.key", "of.left")
    members = members.join(one, [*name, "key", "left"])
    start = F.col("off") - F.col("left")
    return places.join(members, ["key", "ctx"]).select(
        F.substring(F.sha2(F.concat_ws(":", *name), 256), 1, 16).alias("repeat"), "length", public_id(low=low).alias("doc_id"), start.alias("start"),
        ((F.col("id") == F.col("first_id")) & (start == F.col("first_start"))).alias("first"))


def _spans(docs: DataFrame) -> DataFrame:
    found, contexts, hot = _stages(docs)
    late = found.filter(F.col("kind") == COVERED).select("id", (F.col("off") - LEFT).alias("start"), (F.col("off") + RIGHT).alias("stop"))
    spans = late.unionByName(contexts.mapInArrow(_covered, _ddl(_SPAN)))
    if not found.filter(F.col("kind") == HOT).limit(1).count():
        return spans
    windows = written(hot.mapInArrow(_windows, _ddl(_WINDOW)), "windows")
    first = (windows.groupBy("key", "digest").agg(F.min(F.struct("id", "start")).alias("first"), F.count("*").alias("n"))
             .filter("n > 1").select("key", "digest", "first"))
    again = windows.join(first, ["key", "digest"]).filter(F.struct("id", "start") != F.col("first"))
    return spans.unionByName(again.select("id", "start", (F.col("start") + MIN_LEN).alias("stop")))


def _merge(spans, n):
    """Sorted, disjoint, non-adjacent runs inside [0, n)."""
    out = []
    for s, e in sorted((max(0, x["start"]), min(n, x["stop"])) for x in spans or ()):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        elif e > s:
            out.append([s, e])
    return out


_CUT = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                  ("kept", pa.binary())])


def _cut(batches):
    for batch in byte_blocks(batches):
        rows = []
        for doc, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            runs, at, parts = _merge(spans, len(text)), 0, []
            for s, e in runs:
                parts.append(text[at:s])
                at = e
            parts.append(text[at:])
            rows.append((doc, len(text), [{"start": s, "stop": e} for s, e in runs], b"".join(parts)))
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _CUT, strict=True)], schema=_CUT)


def dedup_substrings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_bytes, spans array<struct<start, stop>> (removed runs), kept binary (remaining bytes)``."""
    df, low = own_ids(df, id_col)
    docs = one_row_per_id(df, id_col, text_col)
    spans = _spans(docs).groupBy("id").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    joined = docs.select("id", F.col("text").cast("binary").alias("text")).join(spans, "id", "left").select("id", "text", "spans")
    cut = joined.mapInArrow(_cut, "id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")
    return cut.select(public_id(low=low).alias("doc_id"), "n_bytes", "spans", "kept")


def removal_digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return dedup_substrings(df, id_col, text_col).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def _char_runs(text: bytes, runs):
    """Runs shrunk to whole UTF-8 characters."""
    for s, e in runs:
        while s < e and text[s] & 0xC0 == 0x80:
            s += 1
        while e < len(text) and e > s and text[e] & 0xC0 == 0x80:
            e -= 1
        if e > s:
            yield s, e


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` (unique or null ids, any further columns) with the repeated characters cut out of the texts.

    A character goes if all its bytes are covered; a null text stays null, a text that is covered whole becomes empty.
    """
    given = df
    df, low = own_ids(df, id_col)
    key = F.col(f"`{id_col}`").cast("long").alias("id")
    spans = _spans(one_row_per_id(df, id_col, text_col)).groupBy("id").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    rest = [c for c in df.columns if c != text_col]
    rows = df.select(key, F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"), F.struct(*(F.col(f"`{c}`") for c in rest)).alias("rest"))
    rows = rows.join(spans, "id", "left").select("text", "spans", "rest")
    out = T.StructType([T.StructField("text", T.BinaryType()), rows.schema["rest"]])
    schema = to_arrow_schema(out)

    def cut(batches):
        for batch in byte_blocks(batches):
            texts = []
            for text, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text is not None and found:
                    at, parts = 0, []
                    for s, e in _char_runs(text, _merge(found, len(text))):
                        parts.append(text[at:s])
                        at = e
                    text = b"".join([*parts, text[at:]])
                texts.append(text)
            yield pa.record_batch([pa.array(texts, pa.binary()).cast(schema.field(0).type), batch.column(2).cast(schema.field(1).type)], schema=schema)

    done = rows.mapInArrow(cut, out)
    out = done.select(*(F.col("text").cast("string").alias(c) if c == text_col else F.col("rest").getField(c).alias(c) for c in df.columns))
    return null_again(out, low, given, id_col)
