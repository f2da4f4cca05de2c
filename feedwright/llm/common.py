"""Helpers shared by the operators of this subpackage.

Documents are read as ``(id, text)``: only the two named columns are taken from
the input, so further columns may have any name. Conventions used everywhere
unless an operator says otherwise:

* a null text counts as the empty text;
* each row with a null id is a document of its own; it comes before every other id: :func:`own_ids` gives these rows free
  ids below the others, which become null again in the result;
* rows that repeat an id (not null) are one document, judged by its longest text (ties: the
  greatest text), and give one result row; a warning says how many different texts that leaves out (:func:`merged_texts`). :func:`one_row_per_id` looks for
  repeated ids first, so a table with unique ids pays only for counting ids.
"""

from __future__ import annotations

import os
import tempfile
import warnings
import zipfile

import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.session import scratch_path

#: Stands for a null id inside an operator (sorts before every other id).
NULL_ID = -(2**63)

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of a cluster (once per application)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="feedwright-py-"), "feedwright_llm.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def own_ids(df: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, int | None]:
    """``df`` with an id of its own for each row that has none, and the least id that isn't such a one (None: no row lacks an id).

    The new ids (long) are the ones just below the least id; the rows are written, so they keep them.
    """
    ids = F.col(f"`{id_col}`").cast("long")
    seen = df.agg(F.count_if(ids.isNull()).alias("n"), F.min(ids).alias("low")).first()
    if not seen["n"]:
        return df, None
    low = 0 if seen["low"] is None else seen["low"]
    if low - seen["n"] < NULL_ID:
        raise ValueError("no ids are left below the least one for the rows without an id")
    named = [f"c{i}" for i in range(len(df.columns))]  # any names of columns
    rows = df.toDF(*named)
    id_name = named[df.columns.index(id_col)]
    lost = written(rows.filter(F.col(id_name).cast("long").isNull()).withColumns(
        {"part": F.spark_partition_id(), "nr": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "null-ids")
    at, before = [], low
    for r in lost.groupBy("part").agg(F.count("*").alias("n")).collect():  # one row per partition
        before -= r["n"]
        at.append((r["part"], before))
    lost = lost.join(F.broadcast(df.sparkSession.createDataFrame(at, "part int, base long")), "part")
    lost = lost.withColumn(id_name, F.col("base") + F.col("nr")).select(*named)
    known = rows.filter(F.col(id_name).cast("long").isNotNull()).withColumn(id_name, F.col(id_name).cast("long"))
    return known.unionByName(lost).toDF(*df.columns), low


def null_again(df: DataFrame, low: int | None, like: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``df`` with the ids of :func:`own_ids` taken back, the id column in the type of ``like``."""
    if low is None:
        return df
    ids = public_id(f"`{id_col}`", low).cast(like.schema[id_col].dataType)
    return df.select(*(ids.alias(c) if c == id_col else F.col(f"`{c}`") for c in df.columns))


def public_id(col="id", low: int | None = None):
    """The id as the caller knows it: null again where it was null (``low`` as :func:`own_ids` gives it)."""
    c = F.col(col)
    return c if low is None else F.when(c >= low, c)


def one_row_per_id(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id long, text string)`` with unique ids and no nulls (see the module's conventions)."""
    ship_package(df.sparkSession)
    ids = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    if not has_repeated_ids(ids, "id"):
        return ids
    lost = merged_texts(ids)
    if lost:
        warnings.warn(f"{lost} texts share their id with a longer one and aren't looked at: give every document an id of its own", stacklevel=2)
    return ids.groupBy("id").agg(F.expr("max_by(text, struct(length(text), text))").alias("text"))


def merged_texts(df: DataFrame, id_col: str = "id", text_col: str = "text") -> int:
    """How many different texts :func:`one_row_per_id` leaves out because their id has a longer one."""
    # different texts of an id by their hash: an id that a third of all rows share is summed in the map tasks
    texts = df.select(F.col(id_col).alias("i"), F.sha2(F.col(text_col).cast("binary"), 256).alias("h")).distinct()
    return int(texts.groupBy("i").agg((F.count("*") - 1).alias("n")).agg(F.sum("n")).first()[0] or 0)


def has_repeated_ids(df: DataFrame, id_col: str = "doc_id") -> bool:
    return bool(df.groupBy(F.col(id_col).cast("long")).count().filter("count > 1").limit(1).count())


def full_row_per_id(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``df``, one row per id: of repeated ids the row that :func:`one_row_per_id` judges."""
    if not has_repeated_ids(df, id_col):
        return df
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # ties of the text: the greatest row in a text form that any column type has
    best = F.max_by(row, F.struct(F.length(text), text, F.xxhash64(row))).alias("row")
    return df.groupBy(F.col(id_col).cast("long").alias("id")).agg(best).select("row.*")


def only_ids(df: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose id is in the first column of ``ids`` (null counts as an id)."""
    keep = ids.select(F.coalesce(ids[ids.columns[0]].cast("long"), F.lit(NULL_ID)).alias("keep"))
    return df.join(keep, F.coalesce(df[id_col].cast("long"), F.lit(NULL_ID)) == keep["keep"], "left_semi")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` below the shared checkpoint folder and read it again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def byte_blocks(batches, limit: int = 1 << 23):
    """Record batches cut so that their first binary column holds at most ``limit`` bytes (one row at least)."""
    for batch in batches:
        start, size = 0, 0
        col = next(c for c, f in zip(batch.columns, batch.schema, strict=True)
                   if str(f.type) in ("binary", "large_binary", "string", "large_string"))
        lens = pc.fill_null(pc.binary_length(col), 0).to_pylist()
        for i, n in enumerate(lens):
            if size and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if batch.num_rows > start:
            yield batch.slice(start)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components: ``(node, root)``, root being the component's smallest node.

    Alternates large-star and small-star steps; each round is written to the shared
    checkpoint folder, so no round depends on an executor that held an earlier one.
    A star keeps one link per node, so a hub never emits pairs of its neighbours.
    """
    spark = links.sparkSession
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                    .filter("u <> v").distinct(), "links")
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").union(down.select("u", F.col("m").alias("v"))).distinct())
        new = written(small, "links")
        # a forest of stars: no node is both a root and a child
        if new.select(F.col("v").alias("u")).distinct().join(new.select("u").distinct(), "u", "left_semi").limit(1).count() == 0 \
                and new.groupBy("u").count().filter("count > 1").limit(1).count() == 0:
            edges = new
            break
        edges = new
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
