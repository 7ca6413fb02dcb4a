"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Toxic documents go, of equal texts one stays, of near duplicates one stays, documents that hold a benchmark
item go, and what is left is packed into windows of token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from stratum.llm.queries import table, toxicity_field
from stratum.llm.scratch import stored

TOXIC = 0.3


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below the limit, all columns."""
    field = toxicity_field(spark, sf_dir, docs)
    # Under other names, so that a column of the documents may be called like a score.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    scored = toxicity.score_documents(plain, field, tuple(plain.columns), text=f"c{docs.columns.index('text')}", spans=False)
    return scored.filter(F.col("score") < TOXIC).select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(docs.columns)])


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text up to white space, the one that op6 keeps."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents similar in five-word shingles, the one with the smallest id."""
    return simhash.drop_near_copies(docs, width=5, similarity=0.8)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The windows' pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    parts = packing.pieces(docs, capacity=1024, end_id=0)
    return packing.pack(parts.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"), capacity=1024)


STAGES = [
    ("toxicity", toxic), ("exact dedup", exact_copies), ("near-dedup", near_copies), ("decontamination", benchmark_leaks), ("packing", pack),
]

# Scores, fingerprints, latent vectors and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
