"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with their columns; the last
returns the pieces of the packed sequences. Every stage is written before the next one reads it, and what
it read is removed then.

- toxicity: documents predicted toxic go.
- exact_dedup: of texts equal but for white space the longest stays, then the smallest doc_id.
- near_dedup: of documents linked by a Jaccard similarity of 0.8 or more over their sets of five-word
  shingles, directly or through others, the one with the smallest doc_id stays.
- mixing: a source's documents are left out or repeated by whole blocks, as its target weight asks.
- packing: pieces of byte-level BPE ids fill sequences of 2,048.

Null and empty texts pass the first stages like others (equal ones once); each has the end id to pack. Rows
with a null doc_id or other nulls, repeated rows and further columns pass as well. Without documents there
are no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm import exact, mixing, neardup, packing, toxicity
from roadlens.llm.tokens import public_file
from roadlens.llm.workers import bound_batches
from roadlens.operators.lineage import new_folder, remove

END = 1  # the id behind every document
NEAR = neardup.Settings(words=5, percent=80)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.survivors(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return neardup.survivors(docs, NEAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.realise(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    pieces = packing.pack(docs, public_file("byte_bpe_50k.json"), END)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_copies),
    ("near_dedup", remove_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Toxicity is learned and near copies are found by hashing, which SQL cannot state; the tests hold the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = None
    for name, stage in STAGES:
        done, path = path, new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if done:
            remove(spark, done)
    return docs
