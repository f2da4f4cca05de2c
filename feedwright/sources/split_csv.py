"""A8 on files larger than a split: quoted CSV with line breaks, one file read by many tasks.

Whether a line break ends a record depends on the quotes before it in the whole file. So:

1. one native pass counts the quote characters of every split (file and block start): a row per split;
2. a running sum per file over those rows tells which splits begin inside quotes;
3. every task reads the lines of its splits with that start and joins them to records wherever the count of quotes is even.

A record that crosses a split border is left out there; a third pass, over the files that have such borders only, gathers its pieces (one or two per
split) and joins them. Fields are parsed by Spark's ``from_csv``. Python only joins lines, in Arrow batches; every file
is read in splits, whatever its size.

All passes read in one session whose splits are at fixed places (``with_fixed_splits``).

What reaches the driver: the splits that begin inside quotes (8 bytes each, 128 MB of data a split) and the files they are of. They go to the
workers as a broadcast, once a worker: in the tasks' own code they would grow with the splits times the tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedwright.session import in_session, ship_package, with_fixed_splits

#: Kinds of pieces: a record, or the part of one that crosses a border; the same of the file's first record.
WHOLE, HEAD, MIDDLE, TAIL, FIRST_HEAD = range(5)

_SCHEMA = pa.schema([("record", pa.string()), ("file", pa.int64()), ("block", pa.int64()), ("kind", pa.int32())])
_DDL = "record string, file long, block long, kind int"


def _lines(spark: SparkSession, paths) -> DataFrame:
    """``(value, path, block)`` of the physical lines."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))


def split_starts(lines: DataFrame, quote: str = '"') -> DataFrame:
    """``(path, file, block, inside, open)`` per split: whether it begins inside quotes, and whether it ends there."""
    # map-side sums: a row per split is shuffled
    odd = lines.groupBy("path", "block").agg(F.pmod(F.sum(F.length("value") - F.length(F.replace("value", F.lit(quote)))), F.lit(2)).alias("odd"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.pmod(F.sum("odd").over(before), F.lit(2)), F.lit(0))
    return odd.select("path", F.xxhash64("path").alias("file"), "block", (inside == 1).alias("inside"), (F.pmod(inside + F.col("odd"), F.lit(2)) == 1).alias("open"))


class _Joiner:
    """Joins the lines of one split after the other to records."""

    def __init__(self, inside: dict[int, np.ndarray], quote: str, pieces: bool):
        self.inside, self.quote, self.pieces = inside, quote, pieces
        self.at = None
        self.open = None            # the lines of the record that isn't closed yet
        self.out: list[tuple] = []

    def _emit(self, text, kind):
        self.out.append((text, *self.at, kind))

    def begin(self, at):
        self.finish()
        blocks = self.inside.get(at[0])
        self.at, self.first = at, at[1] == 0
        self.tail = blocks is not None and len(blocks) and blocks[min(np.searchsorted(blocks, at[1]), len(blocks) - 1)] == at[1]
        self.open = [] if self.tail else None

    def finish(self):
        """The split's last record goes on in the next split (or the file ends inside quotes)."""
        if self.open is not None and self.pieces:
            self._emit("\n".join(self.open), MIDDLE if self.tail else FIRST_HEAD if self.first else HEAD)
        self.open = None

    def add(self, values: pa.Array):
        """Lines of the current split; whole records come back as an array."""
        n = len(values)
        odd = np.cumsum(pc.count_substring(values, self.quote).to_numpy(zero_copy_only=False)) + (self.open is not None)
        ends = np.flatnonzero(odd % 2 == 0)
        whole = None
        if self.open is not None:
            stop = int(ends[0]) + 1 if len(ends) else n
            self.open += values[:stop].to_pylist()
            if not len(ends):
                return None
            text = "\n".join(self.open)
            if self.tail:
                if self.pieces:
                    self._emit(text, TAIL)
            elif self.first:
                self.first = False      # the header
            elif not self.pieces:
                whole = text
            self.open, self.tail, ends = None, False, ends[1:]
        else:
            stop = 0
        last = int(ends[-1]) + 1 if len(ends) else stop
        records = []
        if whole is not None:
            records.append(pa.array([whole]))
        if last > stop and not self.pieces:
            # a record's lines lie between the ends: one join for all of them
            offsets = pa.array(np.concatenate([[stop], ends + 1]).astype(np.int32) - stop)
            joined = pc.binary_join(pa.ListArray.from_arrays(offsets, values[stop:last]), "\n")
            records.append(joined[1:] if self.first else joined)
        if last > stop:
            self.first = False
        if last < n:
            self.open = values[last:].to_pylist()
        return records


def _mapper(inside, quote: str, header: bool, pieces: bool):
    def run(batches):
        joiner = _Joiner(inside.value, quote, pieces)
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(0)
            file, block = (batch.column(i).to_numpy() for i in (1, 2))
            starts = np.flatnonzero(np.concatenate([[True], (file[1:] != file[:-1]) | (block[1:] != block[:-1])]))
            for a, b in zip(starts, [*starts[1:], len(file)], strict=True):
                at = (int(file[a]), int(block[a]))
                if at != joiner.at:
                    joiner.begin(at)
                    joiner.first = joiner.first and header
                for records in joiner.add(values[a:b]) or ():
                    m = len(records)
                    yield pa.record_batch([records.cast(pa.string()), pa.array(np.full(m, at[0])), pa.array(np.full(m, at[1])),
                                           pa.array(np.zeros(m, np.int32))], schema=_SCHEMA)
        joiner.finish()
        if joiner.out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*joiner.out, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

    return run


def split_records(spark: SparkSession, path: str, header: bool, quote: str = '"') -> DataFrame:
    """``record``: the logical records of the files as text (line breaks inside quotes kept), without headers and blank lines."""
    ship_package(spark)
    fixed = with_fixed_splits(spark)
    lines = _lines(fixed, path)
    starts = split_starts(lines, quote)
    # splits inside quotes, and the last split of a file that ends inside them
    border = starts.where("inside OR open").select("path", "file", "block", "inside").collect()
    inside: dict[int, np.ndarray] = {}
    for r in border:
        if r["inside"]:
            inside.setdefault(r["file"], []).append(r["block"])
    inside = spark.sparkContext.broadcast({f: np.sort(np.array(b)) for f, b in inside.items()})
    names = {}
    for r in border:
        if names.setdefault(r["file"], r["path"]) != r["path"]:
            raise RuntimeError(f"{r['path']} and {names[r['file']]} have the same hash")
    keyed = lambda df: df.select("value", F.xxhash64("path").alias("file"), "block")
    records = keyed(lines).mapInArrow(_mapper(inside, quote, header, False), _DDL).select("record")
    if border:
        found = keyed(_lines(fixed, sorted(names.values()))).mapInArrow(_mapper(inside, quote, header, True), _DDL)
        # pieces in file order; every head begins a record
        order = Window.partitionBy("file").orderBy("block", F.when(F.col("kind").isin(TAIL, MIDDLE), 0).otherwise(1))
        heads = F.sum(F.col("kind").isin(HEAD, FIRST_HEAD).cast("int")).over(order)
        joined = (found.withColumn("nr", heads).groupBy("file", "nr")
                  .agg(F.sort_array(F.collect_list(F.struct("block", F.when(F.col("kind").isin(TAIL, MIDDLE), 0).otherwise(1).alias("side"), "record", "kind"))).alias("p")))
        if header:
            joined = joined.where(F.col("p")[0]["kind"] != FIRST_HEAD)
        records = records.unionByName(joined.select(F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record")))
    records = records.select(F.regexp_replace("record", r"\r$", "").alias("record")).where("record <> ''")
    return in_session(spark, records)


def csv_fields(records: DataFrame, n: int, sep: str, null_value: str) -> DataFrame:
    """The first ``n`` fields of records as ``_f0 ...``."""
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "nullValue": null_value, "emptyValue": ""}
    return records.select(F.from_csv("record", ", ".join(f"_f{i} string" for i in range(n)), options).alias("r")).select("r.*")
