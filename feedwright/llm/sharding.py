"""Sharding: best-fit-decreasing bin packing of indivisible groups into fixed-capacity shards.

A group is all documents with the same text; a shard holds whole groups. A document's size is the UTF-8 bytes of its text plus one.

1. *Groups.* One pass turns a text into its size, CRC and SHA-256; groups are sums by digest, combined in the map tasks.
2. *Order.* The groups are range-partitioned and sorted by falling size (ties: digest) and numbered by partition offset:
   no window over a size that many groups share, one count per partition on the driver.
3. *Packing.* The driver sees the histogram of group sizes only. Sizes are placed largest first; every group enters the bin with the least
   room that still holds it, which a balanced (AA) tree keyed by the room left finds. Bins with the same room are one run in the tree, so placing
   n groups of a size moves counts, and a size costs a few tree steps, whatever n is.
4. *Join back.* A size's groups are consecutive ranks; each rank interval belongs to one run of bins. Groups meet
   the interval table by an equality join on size (Spark picks its side by measured bytes), documents meet their group by digest.
5. *Slots.* Rows are range-partitioned by (shard, id) and numbered by partition offset: gapless from 0 in every shard, in id order.

``capacity`` given: as few shards of that capacity as best fit needs; a group beyond it has a shard of its own.
``shards`` given (the query: 16): the least capacity at which best fit needs no more shards, searched upwards from the mean, so the shards' bytes
are near equal. A group of at least the mean of what is left takes a shard alone first (it can't be divided), and the rest is balanced over the others.

What reaches the driver: distinct group sizes. Different sizes add up to at most the corpus' bytes, so there are at
most ``sqrt(2 * bytes)`` of them (41,000 for 0.86 GB, 14 million for 100 TB, 16 bytes each).

Hot groups: a group of any number of copies is one row after map-side sums; the join back has the documents on the left of a left join, which
adaptive execution splits; the range keys of both numberings are unique, so no range holds one key's rows alone.

Cases: a null text counts as empty (size 1) and is in the group of the empty texts; every row is a document, so repeated rows and ids and null ids
keep a slot each, with the id as it came; texts of any length only pass through hashes; equal sizes are told apart by digest; only the two named columns are
read, so others may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import written

SHARDS = 16
LAW = "bytes"

#: monotonically_increasing_id keeps the row number within its partition in these bits.
_ROW_BITS = (1 << 33) - 1


class _Node:
    __slots__ = ("key", "runs", "level", "left", "right")

    def __init__(self, key: int, run: tuple[int, int]):
        self.key, self.runs, self.level, self.left, self.right = key, [run], 1, None, None


def _skew(t):
    if t and t.left and t.left.level == t.level:
        low = t.left
        t.left, low.right = low.right, t
        return low
    return t


def _split(t):
    if t and t.right and t.right.right and t.level == t.right.right.level:
        up = t.right
        t.right, up.left = up.left, t
        up.level += 1
        return up
    return t


class Rooms:
    """Runs ``(first bin, number of bins)`` by the room left in each bin: a balanced (AA) search tree."""

    def __init__(self):
        self.root = None

    def tightest(self, size: int) -> _Node | None:
        """The node with the least room that holds ``size``."""
        best, t = None, self.root
        while t:
            if t.key < size:
                t = t.right
            else:
                best, t = t, t.left
        return best

    def add(self, room: int, run: tuple[int, int]) -> None:
        self.root = self._add(self.root, room, run)

    def _add(self, t, room, run):
        if t is None:
            return _Node(room, run)
        if room == t.key:
            t.runs.append(run)
            return t
        if room < t.key:
            t.left = self._add(t.left, room, run)
        else:
            t.right = self._add(t.right, room, run)
        return _split(_skew(t))

    def remove(self, room: int) -> None:
        self.root = self._remove(self.root, room)

    def _remove(self, t, room):
        if t is None:
            return None
        if room < t.key:
            t.left = self._remove(t.left, room)
        elif room > t.key:
            t.right = self._remove(t.right, room)
        elif t.left is None and t.right is None:
            return None
        else:
            near, side = (t.right, "left") if t.left is None else (t.left, "right")
            while getattr(near, side):
                near = getattr(near, side)
            t.key, t.runs = near.key, near.runs
            if side == "left":
                t.right = self._remove(t.right, near.key)
            else:
                t.left = self._remove(t.left, near.key)
        should = 1 + min(t.left.level if t.left else 0, t.right.level if t.right else 0)
        if should < t.level:
            t.level = should
            if t.right and should < t.right.level:
                t.right.level = should
        t = _skew(t)
        if t.right:
            t.right = _skew(t.right)
            if t.right.right:
                t.right.right = _skew(t.right.right)
        t = _split(t)
        if t.right:
            t.right = _split(t.right)
        return t


def best_fit_decreasing(sizes, counts, capacity: int, limit: int | None = None):
    """``(places, bins)`` for sizes in falling order: a place ``(index of the size, first rank within it, first bin, groups a bin)``
    covers the ranks up to the size's next place. None if more than ``limit`` bins are needed."""
    rooms, places, bins = Rooms(), [], 0
    for i, (size, n) in enumerate(zip(sizes, counts, strict=True)):
        rank = 0
        while n:
            node = rooms.tightest(size)
            if node is None:
                fits = max(1, capacity // size)  # a group beyond the capacity has a bin of its own
                full, rest = divmod(n, fits)
                if limit is not None and bins + full + (rest > 0) > limit:
                    return None
                for m, each in ((full, fits), (min(rest, 1), rest)):
                    if m:
                        places.append((i, rank, bins, each))
                        if capacity > each * size:
                            rooms.add(capacity - each * size, (bins, m))
                        rank += m * each
                        bins += m
                break
            room, (first, m) = node.key, node.runs.pop()
            if not node.runs:
                rooms.remove(room)
            fits = room // size
            full = min(m, n // fits)
            for k, each in ((full, fits), (int(full < m and n > full * fits), n - full * fits)):
                if k:
                    places.append((i, rank, first, each))
                    if room > each * size:
                        rooms.add(room - each * size, (first, k))
                    rank += k * each
                    n -= k * each
                    first += k
                    m -= k
            if m:
                rooms.add(room, (first, m))
    return places, bins


def least_capacity(sizes, counts, shards: int):
    """``(places, capacity)`` with ``shards`` bins at most and the bins' sums near equal (see the module)."""
    counts, places, bins = list(counts), [], 0
    ranks = [0] * len(counts)
    left = sum(s * n for s, n in zip(sizes, counts, strict=True))
    for i, size in enumerate(sizes):  # ends after ``shards`` steps at most
        while counts[i] and shards - bins > 1 and size * (shards - bins) >= left:
            places.append((i, ranks[i], bins, 1))
            left -= size
            bins += 1
            counts[i] -= 1
            ranks[i] += 1
        if counts[i]:
            break
    rest = shards - bins
    low = max(-(-left // rest), max((s for s, n in zip(sizes, counts, strict=True) if n), default=1))
    capacity, step, found = low, 1, best_fit_decreasing(sizes, counts, low, rest)
    while found is None:  # gallop to a capacity that is enough, then halve the gap
        low, capacity, step = capacity + 1, capacity + step, step * 2
        found = best_fit_decreasing(sizes, counts, capacity, rest)
    while low < capacity:
        middle = (low + capacity) // 2
        better = best_fit_decreasing(sizes, counts, middle, rest)
        if better is None:
            low = middle + 1
        else:
            found, capacity = better, middle
    return places + [(i, r + ranks[i], b + bins, each) for i, r, b, each in found[0]], capacity


def _numbered(df: DataFrame, keys: list, name: str) -> DataFrame:
    """``df`` range-partitioned and sorted by unique ``keys``, written, with its partition and its number in it."""
    return written(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns(
        {"part": F.spark_partition_id(), "nr": F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))}), name)


def _bases(counts, key=lambda r: ()):
    """Rows ``(part, base, *key)``: the rows before a partition among those with the same key, in partition order."""
    seen: dict = {}
    out = []
    for r in sorted(counts, key=lambda r: r["part"]):
        out.append((r["part"], seen.get(key(r), 0), *key(r)))
        seen[key(r)] = seen.get(key(r), 0) + r["count"]
    return out


def assign(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int | None = SHARDS,
           capacity: int | None = None) -> DataFrame:
    """Per row: doc_id, size, text_crc32, digest, shard, slot."""
    if (shards is None) == (capacity is None) or (shards or capacity) < 1:
        raise ValueError("give either the number of shards or their capacity, 1 at least")
    spark = df.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = written(df.select(F.col(f"`{id_col}`").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
                             F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest"),
                             F.monotonically_increasing_id().alias("row")), "shard-rows")
    groups = _numbered(rows.groupBy("digest").agg(F.sum("size").alias("size")), [F.desc("size"), F.asc("digest")], "shard-groups")
    histogram = groups.groupBy("size").count().toArrow().sort_by([("size", "descending")])
    sizes, counts = (histogram.column(c).to_pylist() for c in ("size", "count"))
    if shards is not None:
        places = least_capacity(sizes, counts, shards)[0]
    else:
        places = best_fit_decreasing(sizes, counts, capacity)[0]
    before = np.cumsum([0, *counts])  # groups of larger sizes
    table: dict[int, tuple[list, list, list]] = {}
    for i, rank, first, each in places:
        for column, value in zip(table.setdefault(i, ([], [], [])), (int(before[i]) + rank, first, each), strict=True):
            column.append(value)
    longs = pa.list_(pa.int64())
    places = written(spark.createDataFrame(pa.table(
        {"size": pa.array([sizes[i] for i in table], pa.int64())}
        | {n: pa.array([t[k] for t in table.values()], longs) for k, n in enumerate(("starts", "bins", "each"))})), "shard-places")
    bases = spark.createDataFrame(_bases(groups.groupBy("part").count().collect()), "part int, base long")  # a row per partition
    placed = (groups.join(F.broadcast(bases), "part").withColumn("rank", F.col("base") + F.col("nr")).join(places, "size")
              .withColumn("at", F.expr("size(filter(starts, s -> s <= rank))"))
              .select("digest", F.expr("int(element_at(bins, at) + (rank - element_at(starts, at)) div element_at(each, at))").alias("shard")))
    out = _numbered(rows.join(placed, "digest", "left"), ["shard", "doc_id", "row"], "shard-slots")
    per = out.groupBy("part", "shard").count().collect()  # a partition holds a range of (shard, id)
    # within its partition, a shard begins after the partition's rows of earlier shards
    inside: dict = {}
    first = {}
    for r in sorted(per, key=lambda r: (r["part"], r["shard"])):
        first[r["part"], r["shard"]] = inside.get(r["part"], 0)
        inside[r["part"]] = inside.get(r["part"], 0) + r["count"]
    offsets = [(part, shard, base - first[part, shard]) for part, base, shard in _bases(per, lambda r: (r["shard"],))]
    offsets = spark.createDataFrame(offsets, "part int, shard int, base long")
    return out.join(F.broadcast(offsets), ["part", "shard"]).select(
        "doc_id", "size", "text_crc32", "digest", "shard", (F.col("base") + F.col("nr")).alias("slot"))


def shard_digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law isn't ``key``)."""
    return assign(df, id_col, text_col).select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
                                               F.lit(None).cast("int").alias("grown_shard"))
