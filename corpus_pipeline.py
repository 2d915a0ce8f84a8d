"""The corpus pipeline: documents to packed training sequences, each stage written as Parquet and reread by the next."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regloom.llm import mixing, ngram_join, packing, pii, toxicity
from regloom.llm.common import importable, shared_folder, table

#: No stage but the rules within them can be said in SQL (a trained scorer, a similarity join, trees, a tokenizer).
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer does not call toxic, whole texts scored.

    Null and empty texts are scored as empty; rows with a null id and repeated rows stay or go by their text; all columns
    stay; an empty table stays empty.
    """
    importable(spark)
    machine = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, machine)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Texts without words are in no group and stay. Rows without an id stay. Where ids repeat, rows that differ in text are
    documents of their own, and of rows equal in id and text one stays; of a group's rows of one id that with the least
    hash. All columns stay; an empty table stays empty.
    """
    importable(spark)
    named = docs.where("doc_id IS NOT NULL")
    if named.groupBy("doc_id").count().where("count > 1").isEmpty():
        found = ngram_join.near_duplicates(named)
        kept = named.join(found.where("doc_id = component_id").select("doc_id"), "doc_id", "left_semi")
    else:
        keyed = named.withColumn("__key", F.xxhash64("doc_id", "text"))
        found = ngram_join.near_duplicates(keyed, "__key").withColumnRenamed("doc_id", "__key")
        ids = keyed.select("__key", "doc_id").distinct()
        least = found.join(ids, "__key").groupBy("component_id").agg(F.min(F.struct("doc_id", "__key"))["__key"].alias("__key"))
        kept = keyed.join(least.select("__key"), "__key", "left_semi").dropDuplicates(["__key"])
    return kept.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def _measured(docs: DataFrame) -> DataFrame:
    """n_chars follows a changed text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else docs


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets. All rows and columns stay, with null and empty texts as they are."""
    return _measured(pii.redact(docs, pii.fit(docs)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The passes over each document that the mix takes, in the order of the curriculum, as repeated rows with whole texts.

    Texts without words, null ones too, are in no pass; a null source is a source of its own; null ids and repeated rows are
    documents of their own; an empty table stays empty.
    """
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces of all that is left: a row for each piece. Null texts count as empty, null ids and repeated rows as documents."""
    importable(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", one_of_each_group),
    ("pii", redact),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = os.path.join(shared_folder(spark), f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
