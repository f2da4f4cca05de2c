"""Packing by shortest-pack-first over the length histogram.

1. *Pieces.* A document's ids (its tokens and one end id) are cut into pieces of the
   sequence length; the rest is one shorter piece. So a document is cut only
   where no single sequence could hold it.
2. *Histogram.* Pieces are counted by length: at most ``size`` counts reach the driver,
   whatever the number of documents.
3. *Patterns.* Lengths are placed longest first, each on the open pack with the most room;
   packs with equal contents are one pattern with a count, and placing n pieces of a length moves
   counts, not pieces. A new pack is opened only where none has room.
4. *Join by rank.* The pieces are range-partitioned and sorted by length, id and start and numbered by partition offset (one count a
   partition on the driver), so a length that most pieces share is many partitions. A piece's rank among the pieces of its length picks its slot:
   slots of a length are consecutive rank intervals, each belonging to one place in one pattern.

The ids are those of the ``tokenizers`` file with ``add_special_tokens=False``: added tokens in a text (``<|endoftext|>``)
have their own ids, as in the library. They are computed by the same merges through tiktoken, which is three times
as fast (tests compare the ids); ``library="tokenizers"`` takes the other one, and so does a file whose added tokens
tiktoken can't split in the same way.

Cases: null and empty texts give one piece of length 1 (the end id); texts of any length are cut; null and repeated
ids as in :mod:`feedwright.llm.common`; equal lengths are told apart by id and start; only the two named columns are read, so others may have any
name; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm import vocabularies
from feedwright.llm.common import byte_blocks, one_row_per_id, own_ids, public_id, written

FILE = "byte_bpe_50k.json"
SIZE = 2048
END = 1

_PIECE = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])


def encoder(data: bytes, library: str):
    """A function from a list of texts to one array of ids per text."""
    added = None if library == "tokenizers" else vocabularies.added_tokens(data)
    if added is None:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_str(data.decode())
        return lambda texts: [np.array(e.ids, np.uint32) for e in tok.encode_batch(texts, add_special_tokens=False)]
    import tiktoken

    enc = tiktoken.Encoding("byte_level", pat_str=vocabularies.default_pattern(),
                            mergeable_ranks=vocabularies.byte_level_json(data), special_tokens=added)
    return lambda texts: [enc.encode_to_numpy(t, allowed_special="all") for t in texts]


def token_pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, size: int = SIZE,
                 end_id: int = END, library: str = "tiktoken") -> DataFrame:
    """``id, start, length, ids_crc32, doc_tokens`` of the pieces of every document."""
    docs = one_row_per_id(df, id_col, text_col)
    file = vocabularies.shared(df.sparkSession, path or vocabularies.default_path(FILE))

    def run(batches):
        encode = vocabularies.built(("encoder", file.id, library), lambda: encoder(file.value, library))
        end = np.array([end_id], np.uint32)
        for batch in byte_blocks(batches, 1 << 21):
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
                ids = np.concatenate([ids, end]).astype("<u4")
                for s in range(0, len(ids), size):
                    part = ids[s:s + size]
                    rows.append((doc, s, len(part), zlib.crc32(part.tobytes()), len(ids)))
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=_PIECE)

    return docs.select("id", "text").mapInArrow(run, "id long, start long, length long, ids_crc32 long, doc_tokens long")


def shortest_pack_first(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, list[int]]]:
    """Patterns ``(count, lengths in the order they were placed)`` for the counts of each length."""
    room: dict[int, list[tuple[int, list[int]]]] = {}  # open packs by the room left
    heap: list[int] = []  # rooms, the largest first

    def put(left, count, lengths):
        if left not in room:
            room[left] = []
            heapq.heappush(heap, -left)
        room[left].append((count, lengths))

    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        while n:
            while heap and not room[-heap[0]]:
                del room[-heapq.heappop(heap)]
            if heap and -heap[0] >= length:
                left = -heap[0]
                count, lengths = room[left].pop()
                take = min(n, count)
                if count > take:
                    room[left].append((count - take, lengths))
                put(left - length, take, [*lengths, length])
                n -= take
            else:  # no open pack has room: new packs, each filled before the next is opened
                fits = size // length
                packs, rest = divmod(n, fits)
                if packs:
                    put(size - fits * length, packs, [length] * fits)
                if rest:
                    put(size - rest * length, 1, [length] * rest)
                n = 0
    return [p for packs in room.values() for p in packs]


def slots(patterns: list[tuple[int, list[int]]]):
    """Per slot, sorted by length and first rank: length, first rank, first sequence id, offset."""
    by_length: dict[int, list[tuple[int, int, int]]] = {}
    base = 0
    for count, lengths in patterns:
        at = 0
        for length in lengths:
            by_length.setdefault(length, []).append((count, base, at))
            at += length
        base += count
    out = []
    for length in sorted(by_length):
        rank = 0
        for count, first, at in by_length[length]:
            out.append((length, rank, first, at))
            rank += count
    return np.array(out, np.int64).reshape(-1, 4)


def assign(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """``pieces`` (id, start, length, ...) with sequence_id and offset."""
    names = ("id", "start", "length", "ids_crc32", "doc_tokens")
    keys = ("length", "id", "start")
    numbered = written(pieces.select(*names).repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns(
        {"part": F.spark_partition_id().cast("long"), "nr": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "ranked-pieces")
    histogram = {r["length"]: r["count"] for r in numbered.groupBy("length").count().collect()}  # at most size rows
    table = slots(shortest_pack_first(histogram, size))
    lengths = sorted(histogram)
    before = np.zeros(size + 1, np.int64)  # pieces of smaller lengths
    before[lengths] = np.cumsum([0, *(histogram[n] for n in lengths)])[:-1]
    counts = {r["part"]: r["count"] for r in numbered.groupBy("part").count().collect()}  # a row per partition
    base = np.zeros(max(counts, default=0) + 2, np.int64)
    for part, n in counts.items():
        base[part + 1] = n
    base = np.cumsum(base)
    # global ranks: a slot begins at its length's first piece and its rank within the length
    key = before[table[:, 0]] + table[:, 1]
    shared = pieces.sparkSession.sparkContext.broadcast((base, key, table))
    schema = pa.schema([*((n, pa.int64()) for n in names), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(batches):
        base, key, table = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            part, nr = (b.column(i).to_numpy() for i in (5, 6))
            rank = base[part] + nr
            at = np.searchsorted(key, rank, "right") - 1
            yield pa.record_batch([*b.columns[:5], pa.array(table[at, 2] + rank - key[at]), pa.array(table[at, 3])], schema=schema)

    return numbered.select(*names, "part", "nr").mapInArrow(place, ", ".join(f"`{f.name}` long" for f in schema))


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, size: int = SIZE,
         end_id: int = END, library: str = "tiktoken") -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    df, low = own_ids(df, id_col)
    pieces = written(token_pieces(df, id_col, text_col, path, size, end_id, library), "pieces")
    return assign(pieces, size).select(public_id(low=low).alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
