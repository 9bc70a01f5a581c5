"""Raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as
Parquet in the shared folder and reads it again as the next stage's documents. All stages but the
last return the columns of documents. What a stage decides takes effect: toxic documents go,
shared passages are cut from later documents, one document stays of each near-duplicate class,
documents with benchmark passages go, and the rest is packed. A row is never dropped for a null or
an empty text; see each operator for what becomes of those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import decontaminate, line_dedup, packing, simhash, toxicity
from marketlake.llm.common import stored, table
from marketlake.llm.queries import tokenizer
from marketlake.session import configure


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_shared_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of earlier ones; n_chars counts what is left."""
    kept = line_dedup.drop_shared_passages(docs)
    if "n_chars" in kept.columns:
        kept = kept.withColumn(
            "n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
        )
    return kept.select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash class."""
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences."""
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_shared_passages),
    ("SimHash near-dedup", keep_one_of_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("best-fit packing", pack),
]

#: Model scores and alignments are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents table."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
