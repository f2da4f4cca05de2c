"""SimHash near-dedup by multi-index hashing.

Fingerprints: words ``[^\\x20\\x09-\\x0D]+`` of the text, A-Z in lower case; shingles of
four words (fewer words: the whole sequence), repeats included; XXH64 (seed 42) of each;
a bit is 1 if it is set in over half of the hashes. No words: fingerprint zero.

Search: documents are reduced to distinct fingerprints first, so copies cost nothing. The 64 bits are
cut into segments, each with a small radius such that two fingerprints within the
maximal distance agree up to its radius in one segment at least (the radii plus one
add up to more than the distance). Every fingerprint stands in the table once per segment; each
probe flips the bits of one Hamming ball of a segment, so matches are plain equalities, and the complete
distance is verified in the join. A probe only takes partners of a larger fingerprint.

Links are between distinct fingerprints only and each is listed once; the components are found on
stars (one link per node and round), so a group of n copies or near copies is never expanded into its pairs
of documents.

Cases: null and empty texts have fingerprint zero and link like any other; texts of any length are read whole, in one task (shingles are
hashed in parts of 16,384); equal smallest ids can't be; null and repeated ids as in
:mod:`feedwright.llm.common`; only the two named columns are read, so others may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import byte_blocks, components, one_row_per_id, own_ids, public_id, written

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: (bits, radius) of the segments: 2 + 2 + 1 > 4.
SEGMENTS = ((21, 1), (21, 1), (22, 0))


def widths(n: int, distance: int = DISTANCE) -> tuple[tuple[int, int], ...]:
    """Segments for ``n`` distinct fingerprints: the number of segments whose probes and expected random matches are the fewest.

    Wider segments take more probes a fingerprint and let fewer random partners through: three segments of 21 bits up to some 25 million
    fingerprints, two of 32 beyond."""
    best = None
    for k in range(2, min(3, distance + 1) + 1):
        # the radii plus one add up to distance + 1; widths differ by one at most, the wider ones get the smaller radius
        radii = sorted(((distance + 1) // k - 1 + (i < (distance + 1) % k) for i in range(k)), reverse=True)
        bits = sorted(64 // k + (i < 64 % k) for i in range(k))
        balls = [sum(comb(b, r) for r in range(radius + 1)) for b, radius in zip(bits, radii, strict=True)]
        cost = n * sum(balls) + n * n * sum(ball / 2**b for ball, b in zip(balls, bits, strict=True))
        if best is None or cost < best[0]:
            best = cost, tuple(zip(bits, radii, strict=True))
    return best[1]


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """Fingerprint of one text (signed 64 bits)."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # on bytes: A-Z only, and exactly the six blanks
    if not words:
        return 0
    joined = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    n = max(1, len(words) - width + 1)
    stops = ends[width - 1:] if len(words) >= width else ends[-1:]
    ones, total = np.zeros(64, np.int64), n
    for s in range(0, n, 1 << 14):
        part = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[s:s + (1 << 14)], stops[s:s + (1 << 14)])]
        bits = np.unpackbits(np.array(part, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """``(id, fp long)`` of every document."""
    schema = pa.schema([("id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for batch in byte_blocks(batches, 1 << 22):
            yield pa.record_batch([batch.column(0), pa.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], pa.int64())],
                                  schema=schema)

    docs = one_row_per_id(df, id_col, text_col)
    return docs.select("id", F.col("text").cast("binary").alias("text")).mapInArrow(run, "id long, fp long")


def _masks(segments):
    """Per segment: its mask, and the flips of its ball, as signed 64-bit numbers."""
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    at = 0
    for bits, radius in segments:
        flips = [sum(1 << at + i for i in c) for r in range(radius + 1) for c in combinations(range(bits), r)]
        yield signed(((1 << bits) - 1) << at), [signed(f) for f in flips]
        at += bits
    if at != 64:
        raise ValueError("segments must cover 64 bits")


def links(fps: DataFrame, distance: int = DISTANCE, segments=SEGMENTS) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of distinct fingerprints ``fp`` at most ``distance`` bits apart."""
    if sum(r + 1 for _, r in segments) <= distance:
        raise ValueError("radii too small for the distance")
    table, probes = [], []
    for i, (mask, flips) in enumerate(_masks(segments)):
        table.append(F.struct(F.lit(i).alias("s"), F.col("fp").bitwiseAND(F.lit(mask)).alias("v")))
        probes += [F.struct(F.lit(i).alias("s"), F.col("fp").bitwiseAND(F.lit(mask)).bitwiseXOR(F.lit(f)).alias("v")) for f in flips]
    left = fps.select(F.col("fp").alias("a"), F.explode(F.array(*probes)).alias("k")).select("a", "k.s", "k.v")
    right = fps.select(F.col("fp").alias("b"), F.explode(F.array(*table)).alias("k")).select("b", "k.s", "k.v")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    # a ball holds both directions of a pair: one is enough
    return left.join(right, ["s", "v"]).filter((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                    distance: int = DISTANCE, segments=None) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links).

    ``segments`` (default: ``widths`` of the number of distinct fingerprints) change the search, not the links."""
    df, low = own_ids(df, id_col)
    docs = written(fingerprints(df, id_col, text_col, width), "fingerprints")
    distinct = docs.groupBy("fp").agg(F.min("id").alias("first"))
    segments = segments or widths(distinct.count(), distance)
    roots = components(links(distinct.select("fp"), distance, segments)).withColumnRenamed("node", "fp")
    member = distinct.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = member.groupBy("root").agg(F.min("first").alias("component"))
    of = member.join(smallest, "root").select("fp", "component")
    return docs.join(of, "fp", "left").select(public_id(low=low).alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                              public_id("component", low).alias("component_id"))
