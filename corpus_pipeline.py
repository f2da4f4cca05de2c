"""The corpus pipeline: quality classifier, exact dedup, SimHash near-dedup, suffix-array dedup, packing.

Each stage takes all documents that the stage before kept. A document that the classifier rejects goes; of equal texts and of
near duplicates one document stays; passages of 100 bytes and more that an earlier document holds are cut out
(whole characters only); what is left is packed. Rows that repeat a doc_id are one document from exact dedup on;
each row without a doc_id is a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.llm import exact_dedup, packing, quality_cotrain, simhash_mih, suffix_dedup
from feedwright.llm.common import documents, full_row_per_id, null_again, only_ids, own_ids, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_cotrain.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, low = own_ids(docs)
    rows = full_row_per_id(rows)
    return null_again(only_ids(rows, exact_dedup.dedup(rows).filter("kept").select("doc_id")), low, docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, low = own_ids(docs)
    rows = full_row_per_id(rows)
    return null_again(only_ids(rows, simhash_mih.near_duplicates(rows).filter("doc_id <=> component_id").select("doc_id")), low, docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, low = own_ids(docs)
    cut = null_again(suffix_dedup.without_repeats(full_row_per_id(rows)), low, docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns) if "n_chars" in docs.columns else cut


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("simhash near-dedup", near),
          ("suffix-array dedup", passages), ("packing", sequences)]

#: No stage but the second can be said in SQL; tests hold the others against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
