"""The training-data pipeline: reject poor text, drop near duplicates, mix the sources, pack sequences.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, all but the last with
the columns of ``docs``. ORACLE_SQL is None: the language model, the hash order of the mix and the packing plan have
no SQL; tests/llm holds the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.scale import materialise
from tillwise.llm.mixing import take_mix
from tillwise.llm.packing import pack_documents
from tillwise.llm.quality import Classifier
from tillwise.llm.shingle_join import shingle_components

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney classifier accepts; each is scored once."""
    return Classifier(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of those with the smallest doc_id one, of each group with five-word shingles alike to 0.8 or more.

    Rows are told apart by a number of their own, so a doc_id may stand at several texts or be missing; rows without
    words stay.
    """
    rows = materialise(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "zstd")
    groups = shingle_components(rows.select("row", F.col("doc.text").alias("text")), n=5, num=80, den=100, ident="row")
    ident = F.struct(F.col("doc.doc_id").isNull().alias("none"), F.col("doc.doc_id").alias("id"), "row").alias("place")
    placed = rows.select("row", ident).join(groups.select("row", "component_id"), "row")
    heads = placed.groupBy("component_id").agg(F.min("place").alias("place")).select("place.row")
    return rows.join(heads, "row", "left_semi").select("doc.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the weighted mix, a document twice if the mix takes it twice."""
    return take_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 2,048 tokens."""
    return pack_documents(docs)


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates),
          ("mixing to target weights", mix), ("best-fit packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs.select("doc_id", F.col("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")
