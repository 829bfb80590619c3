"""Documents to packed training sequences: filters, near copies, repeats, packing.

Every stage takes (spark, docs, folder) and returns a DataFrame; all but the last return the
columns of docs. run() writes each stage's rows as Parquet below spark.checkpoint.dir and
rereads them as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentloom.llm import packing, paragraphs, quality, simhash, toxicity
from rentloom.llm.common import table, written
from rentloom.session import delete_folder


def harmless(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Without the documents that score as toxic."""
    return toxicity.harmless(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Without the documents that score as of low quality."""
    return quality.good(docs, quality.fit(docs, table(spark, folder, "labels")))


def single(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of every group of near copies."""
    return simhash.without_near_copies(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, without passages that stand elsewhere before; n_chars follows."""
    out = paragraphs.without_repeats(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.coalesce(
            F.char_length("text").cast(out.schema["n_chars"].dataType), F.col("n_chars")))
    return out


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of the documents' tokens and their places in the sequences."""
    return packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", harmless), ("quality", good), ("near_copies", single), ("repeats", unrepeated), ("packing", packed),
]

#: Classifiers are fitted and tokens counted, which SQL does not express: tested in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Each stage's table goes when the next one is written; the last goes with the process."""
    docs, before = table(spark, folder, "documents"), None
    for name, stage in STAGES[:-1]:
        path = written(stage(spark, docs, folder), name)
        if before:
            delete_folder(spark, before)
        docs, before = spark.read.parquet(path), path
        # Spark deletes shuffle files of frames that are gone when the driver collects garbage
        spark._jvm.System.gc()
    return STAGES[-1][1](spark, docs, folder)
