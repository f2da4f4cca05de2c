"""Exact dedup with a persistent digest index.

The index is a table with one row per distinct text, bucketed and sorted by the digest of
the normalised text. New data is reduced to one row per digest, set against the
index by a sort-merge anti join (the index side is read by its buckets: no exchange
of what is already stored), and the new digests are appended. Texts are
never shuffled, only digests.

Equal means equal after deleting every character of ``[\\x20\\x09-\\x0D]``. Within one
batch the row with the most code points in the original text stays, then the
smallest id; a text that an earlier batch brought in stays with that batch's row.

Hot texts: the reduction combines in the map tasks first, and the join that hands the
decision back to every row has the large side on the left of a left join, which
adaptive execution splits.

Cases: a null text counts as empty; all empty texts are one group; texts of any length are hashed where they are, in one task each;
ties in length go to the smallest id; null and repeated
ids as in :mod:`feedwright.llm.common`; only the two named columns are read, so others may have any name; an empty batch adds nothing and gives an empty result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.llm.common import NULL_ID, one_row_per_id, own_ids, public_id, written
from feedwright.session import scratch_path
from feedwright.sources import storage

#: Characters that normalisation deletes: [\x20\x09-\x0D] (fixed values).
BLANKS = " \t\n\x0b\x0c\r"

#: Digests in a bucket (about 80 bytes each), the least number of buckets, and the file that keeps an index's number.
BUCKET_ROWS, LEAST_BUCKETS, _BUCKETS = 1_000_000, 16, "_buckets"


def _needed(rows: int) -> int:
    return max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))


def digests(docs: DataFrame) -> DataFrame:
    """``(id, digest binary, n_chars)`` of unique documents (id, text)."""
    return docs.select("id", F.unhex(F.sha2(F.translate("text", BLANKS, ""), 256)).alias("digest"),
                       F.length("text").cast("long").alias("n_chars"))


class DigestIndex:
    """A table ``(digest, keep_id, n_chars, batch)`` bucketed and sorted by digest.

    ``path`` is where its files live: name one to keep the index (a later session opens it by the same path);
    without one a new index is made below the shared checkpoint folder. A new index is an empty table, so
    its first batch takes the anti join too.

    The number of buckets is the number of tasks of its joins and stays with the index (a file beside the data keeps it). Where none is
    given, the first batch sets it: as many as its rows need at ``BUCKET_ROWS`` each. ``rebuild`` makes an index of another number.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = (path or scratch_path(spark, "digest-index")).rstrip("/")
        self.table = "digest_index_" + hashlib.sha256(self.path.encode()).hexdigest()[:16]
        kept = storage.read_small(spark, f"{self.path}/{_BUCKETS}")
        self.buckets = int(kept) if kept else buckets
        if self.buckets:
            self._create()

    def _create(self) -> None:
        if not self.exists():
            at = self.path.replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT, n_chars BIGINT, batch STRING) USING parquet "
                           f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{at}'")
        storage.create_new(self.spark, f"{self.path}/{_BUCKETS}", str(self.buckets))

    def rebuild(self, path: str | None = None, buckets: int | None = None) -> DigestIndex:
        """An index with the same rows in another number of buckets (None: as many as they need), at another path."""
        new = DigestIndex(self.spark, path, buckets or _needed(self.read().count()))
        new._append(self.read())
        return new

    def _append(self, rows: DataFrame) -> None:
        (rows.repartition(self.buckets, "digest").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.table))

    def forget(self) -> None:
        """Take the table out of the catalog; its files stay, and ``path`` opens them again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def fresh(self, groups: DataFrame) -> DataFrame:
        """The rows of ``groups`` whose digest isn't stored: a sort-merge anti join, the index read by its buckets."""
        return groups.hint("merge").join(self.read().select("digest").hint("merge"), "digest", "left_anti")

    def add(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: str = "0") -> DataFrame:
        """Dedup ``df`` against the index and itself, append what is new, and return one row per document:
        ``id, digest, keep_id, group_size (rows of this batch with the text), known (stored by an earlier batch)``, without
        null ids here; the index stores null for a row without an id.

        Each batch needs a name of its own: a batch that is run again after a failure between the append and the
        use of the result finds its own rows and gives the same decisions.
        """
        df, low = own_ids(df, id_col)
        return self._add(df, low, id_col, text_col, batch)

    def _add(self, df: DataFrame, low: int | None, id_col: str, text_col: str, batch: str) -> DataFrame:
        """:meth:`add` of rows that :func:`own_ids` gave an id."""
        rows = written(digests(one_row_per_id(df, id_col, text_col)), "digests")
        if not self.buckets:
            self.buckets = _needed(rows.count())
            self._create()
        # -1 - id: descending ids without overflow, also for the stand-in of a null id
        best = F.expr("max_by(id, struct(n_chars, (-1 - id)))").alias("keep_id")
        groups = rows.groupBy("digest").agg(best, F.max("n_chars").alias("n_chars"), F.count("*").alias("group_size"))
        fresh = self.fresh(groups)
        self._append(fresh.select("digest", public_id("keep_id", low).alias("keep_id"), "n_chars", F.lit(batch).alias("batch")))
        # the stand-in of null is from indexes that stored it
        stored = self.read().select("digest", F.when(F.col("keep_id") != NULL_ID, F.col("keep_id")).alias("old_id"), F.col("batch").alias("old_batch"))
        known = F.col("old_batch") != batch
        decided = (groups.select("digest", "group_size", "keep_id").hint("merge").join(stored.hint("merge"), "digest")
                   .select("digest", "group_size", F.when(known, F.col("old_id")).otherwise(F.coalesce("old_id", "keep_id")).alias("keep_id"),
                           known.alias("known")))
        return rows.select("id", "digest").join(decided, "digest", "left").select("id", "digest", "keep_id", "group_size", "known")


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", index: DigestIndex | None = None,
          batch: str = "0") -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256; ``index`` (default: a new one, which leaves no table in the
    catalog) gets the new digests."""
    df, low = own_ids(df, id_col)
    own = index or DigestIndex(df.sparkSession)
    found = own._add(df, low, id_col, text_col, batch)
    if index is None:
        own.forget()
    # an earlier batch's ids are as the caller knows them
    keep = F.when(F.col("known"), F.col("keep_id")).otherwise(public_id("keep_id", low))
    kept = F.coalesce((F.col("id") == F.col("keep_id")) & ~F.col("known"), F.lit(False))
    return found.select(public_id(low=low).alias("doc_id"), keep.alias("keep_id"), "group_size", kept.alias("kept"),
                        F.lower(F.hex("digest")).alias("text_sha256"))


#: DuckDB twin of ``dedup`` over the whole documents table.
SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents),
g AS (SELECT h, count(*) AS group_size, max(n) AS m FROM d GROUP BY h),
k AS (SELECT d.h, min(d.doc_id) AS keep_id FROM d JOIN g ON d.h = g.h AND d.n = g.m GROUP BY d.h)
SELECT d.doc_id, k.keep_id, g.group_size, d.doc_id = k.keep_id AS kept, d.h AS text_sha256
FROM d JOIN g ON d.h = g.h JOIN k ON d.h = k.h
"""
