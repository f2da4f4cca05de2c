"""Run status and audit as an append-only log.

A writer never rewrites what is there, so it can neither block nor undo another one::

    <path>/data/<folder>/bucket=<b>/part-...     rows, written first
    <path>/commits/<b>/<number>                  a small file that names the folder: now the rows count

A number is claimed by exclusive creation; a writer that loses the race takes the next one. A write that fails leaves
a folder without a commit, which nobody reads. Rows are bucketed by the feed columns: all rows of a
feed are in one bucket (an append of one feed is one commit, so it counts wholly or not at all), and writers of different feeds rarely meet.

``read`` gives the latest row of every key: one aggregate over the committed rows, the greater commit number wins. Without
keys every row is an event of its own (the audit).

``merge`` (after an append, when a bucket has ``fan_in`` commits of one level) writes them as one folder of the next level
and commits it with the numbers it covers; rows keep their own order number. So a bucket has at most ``fan_in`` folders a level,
and a row is rewritten once a level. A folder is one file up to ``MERGED_BYTES`` and a file per so many bytes beyond, so no task merges
more than that; the buckets of an append are merged side by side. Of two merges of the same commits the smaller number counts. What a merge covers is deleted
``grace`` seconds after it, so a reader of the older state still finds its files.
"""

from __future__ import annotations

import json
import uuid
import warnings
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedwright.sources import storage

_SEQ = "_seq"

#: Bytes of the merged files that become one file.
MERGED_BYTES = 16 << 20

#: Buckets that are merged at a time.
_SIDE_BY_SIDE = 8


class EventLog:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, feed_cols: tuple[str, ...], keys: tuple[str, ...] = (),
                 buckets: int = 8, fan_in: int = 16, grace: float = 3600):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.feed_cols, self.keys, self.buckets, self.fan_in, self.grace = feed_cols, keys, buckets, fan_in, grace
        self._stored = T.StructType([*schema.fields, T.StructField(_SEQ, T.LongType())])

    # -- commits ------------------------------------------------------------------------------------------------

    def _numbers(self, bucket: int) -> list[int]:
        return sorted(int(n) for n in storage.names(self.spark, f"{self.path}/commits/{bucket}") if n.isdigit())

    def _commits(self, bucket: int) -> dict[int, dict]:
        """Number to commit; a file without content is none."""
        out = {}
        for n in self._numbers(bucket):
            text = storage.read_small(self.spark, f"{self.path}/commits/{bucket}/{n:012d}")
            if text:
                out[n] = json.loads(text)
        return out

    @staticmethod
    def _live(commits: dict[int, dict]) -> tuple[list[int], list[int]]:
        """Commits that count, and merges that came second."""
        covered: set[int] = set()
        void = []
        for n in sorted(commits):
            covers = commits[n]["covers"]
            if covered.intersection(covers):
                void.append(n)
            else:
                covered.update(covers)
        return [n for n in commits if n not in covered and n not in void], void

    def _commit(self, bucket: int, folder: str, level: int = 0, covers: tuple = ()) -> int:
        text = json.dumps({"folder": folder, "level": level, "covers": list(covers)})
        n = max(self._numbers(bucket), default=0) + 1
        while not storage.create_new(self.spark, f"{self.path}/commits/{bucket}/{n:012d}", text):
            n += 1
        return n

    def versions(self) -> list[int]:
        """The numbers of all commits."""
        return sorted(n for b in self._buckets() for n in self._commits(b))

    def _buckets(self) -> list[int]:
        return sorted(int(b) for b in storage.names(self.spark, f"{self.path}/commits") if b.isdigit())

    # -- rows ---------------------------------------------------------------------------------------------------

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.feed_cols), F.lit(self.buckets)).cast("int")

    def append(self, rows: DataFrame, merge: bool = True) -> None:
        """Add rows. They count from the commit on; an append that fails before it has no effect and may be repeated."""
        folder = uuid.uuid4().hex
        at = f"{self.path}/data/{folder}"
        rows = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields])
        rows.withColumn("bucket", self._bucket()).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(at)
        touched = [int(v) for v in storage.partition_values(self.spark, at, "bucket")]
        for bucket in touched:
            self._commit(bucket, folder)
        if merge:
            try:
                self._merge_all(touched)
            except Exception as e:  # the rows are committed; a later append merges
                warnings.warn(f"merge of {self.path} failed: {type(e).__name__}: {str(e)[:300]}", stacklevel=2)

    def _rows(self, live: dict[int, dict[int, dict]]) -> DataFrame:
        """The rows of commits by bucket, with their order number."""
        order = [(b, c["folder"], n) for b, commits in live.items() for n, c in commits.items()]
        if not order:
            return self.spark.createDataFrame([], self._stored)
        at = F.col("_metadata.file_path")
        rows = (self.spark.read.schema(self._stored).parquet(*[f"{self.path}/data/{f}/bucket={b}" for b, f, _ in order])
                .select("*", F.regexp_extract(at, r"/data/([0-9a-f]+)/bucket=", 1).alias("_folder"),
                        F.regexp_extract(at, r"/bucket=(\d+)/", 1).cast("int").alias("_bucket")))
        # a few commits per level and bucket, whatever the number of events
        numbers = self.spark.createDataFrame(order, "_bucket int, _folder string, _number long")
        return (rows.join(F.broadcast(numbers), ["_bucket", "_folder"])
                .select(*[f"`{f.name}`" for f in self.schema.fields], F.coalesce(_SEQ, "_number").alias(_SEQ)))

    def _latest(self, rows: DataFrame) -> DataFrame:
        if not self.keys:
            return rows
        rest = [f.name for f in self.schema.fields if f.name not in self.keys]
        row = F.struct(*[F.col(f"`{c}`") for c in rest], F.col(_SEQ))
        best = rows.groupBy(*self.keys).agg(F.max_by(row, F.struct(_SEQ, row)).alias("_r"))
        return best.select(*[(F.col(f"_r.`{f.name}`") if f.name in rest else F.col(f"`{f.name}`")).alias(f.name) for f in self.schema.fields],
                           F.col(f"_r.{_SEQ}").alias(_SEQ))

    def read(self, feed: dict | None = None) -> DataFrame:
        """The latest row of every key (without keys: all rows). ``feed`` (column to value) reads that feed's bucket only."""
        buckets = self._buckets()
        if feed is not None:
            one = self.spark.range(1).select(*[F.lit(feed[c]).cast(self.schema[c].dataType).alias(c) for c in self.feed_cols])
            buckets = [b for b in buckets if b == one.select(self._bucket()).first()[0]]
        live = {b: {n: c[n] for n in self._live(c)[0]} for b in buckets for c in [self._commits(b)]}
        out = self._latest(self._rows(live)).drop(_SEQ)
        for c, v in (feed or {}).items():
            out = out.where(F.col(f"`{c}`").eqNullSafe(F.lit(v)))
        return out

    # -- upkeep -------------------------------------------------------------------------------------------------

    def merge(self, bucket: int) -> int | None:
        """Write ``fan_in`` commits of one level as one of the next; returns its number if there was something to merge."""
        commits = self._commits(bucket)
        live, void = self._live(commits)
        levels: dict[int, list[int]] = {}
        for n in live:
            levels.setdefault(commits[n]["level"], []).append(n)
        made = None
        for level, numbers in sorted(levels.items()):
            if len(numbers) >= self.fan_in:
                folder = uuid.uuid4().hex
                rows = self._latest(self._rows({bucket: {n: commits[n] for n in numbers}}))
                files = self._files(bucket, [commits[n]["folder"] for n in numbers])
                rows.withColumn("bucket", F.lit(bucket)).coalesce(files).write.partitionBy("bucket").parquet(f"{self.path}/data/{folder}")
                made = self._commit(bucket, folder, level + 1, tuple(numbers))
                break
        self._clean(bucket, self._commits(bucket) if made else commits, void)
        return made

    def _merge_all(self, buckets: list[int]) -> None:
        """A merge waits for small jobs mostly; those of several buckets run at the same time."""
        from pyspark import inheritable_thread_target
        if len(buckets) < 2:
            for bucket in buckets:
                self.merge(bucket)
            return
        with ThreadPoolExecutor(min(len(buckets), _SIDE_BY_SIDE)) as pool:
            list(pool.map(inheritable_thread_target(self.spark)(self.merge), buckets))

    def _files(self, bucket: int, folders: list[str]) -> int:
        """How many files the merge of these folders is."""
        size = sum(sum(storage.data_files(self.spark, f"{self.path}/data/{f}/bucket={bucket}")) for f in folders)
        return max(1, -(-size // MERGED_BYTES))

    def _old(self, bucket: int, n: int) -> bool:
        return storage.age_seconds(self.spark, f"{self.path}/commits/{bucket}/{n:012d}") >= self.grace

    def _clean(self, bucket: int, commits: dict[int, dict], void: list[int]) -> None:
        # the greatest number stays, so that no number is given twice
        gone = [n for n in void if n in commits and n != max(commits) and self._old(bucket, n)]
        for n in set(commits) - set(void):
            covers = [m for m in commits[n]["covers"] if m in commits]
            if covers and self._old(bucket, n):
                gone += covers
        for n in dict.fromkeys(gone):
            storage.delete(self.spark, f"{self.path}/commits/{bucket}/{n:012d}")
            at = f"{self.path}/data/{commits[n]['folder']}"
            storage.delete(self.spark, f"{at}/bucket={bucket}")
            if not any(x.startswith("bucket=") for x in storage.names(self.spark, at)):
                storage.delete(self.spark, at)

    def vacuum(self, older_than_seconds: float = 24 * 3600) -> int:
        """Delete the folders of writes that failed before their commit; returns their number."""
        known = {c["folder"] for b in self._buckets() for c in self._commits(b).values()}
        lost = [f for f in storage.names(self.spark, f"{self.path}/data")
                if f not in known and storage.age_seconds(self.spark, f"{self.path}/data/{f}") > older_than_seconds]
        for f in lost:
            storage.delete(self.spark, f"{self.path}/data/{f}")
        return len(lost)
