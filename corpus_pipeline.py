"""The corpus pipeline: documents to a clean training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns of ``documents``; the last
adds the copy's number and its place in the shuffle. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandflow.llm import decontaminate, language_id, mixing, simhash_dedup, suffix_dedup
from strandflow.llm.common import read, shared_folder


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: texts without a letter, or of no language that the network knows, go."""
    return language_id.keep_known(docs, language_id.fit(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each component the document with the least id stays."""
    return simhash_dedup.keep_first(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup: bytes of strings that occur again go from every text; ``n_chars`` follows."""
    return suffix_dedup.remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a window like a benchmark item go."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each document as often as its source's target weight asks, in shuffled order."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", keep_languages),
    ("simhash_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontaminate", drop_contaminated),
    ("source_mix", mix_sources),
]

#: A trained network and connected components can't be said in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
