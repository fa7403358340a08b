"""Preparation of a training corpus: five stages from ``documents`` to shuffled shards.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps with the columns of ``docs``; the last adds the
place of each row. ``run`` writes every stage's result as Parquet and reads it again, so a lost executor costs no more
than the stage it worked on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.llm import decontaminate, minhash, mixing, sharding, toxicity
from agora.llm.text import table
from agora.session import materialize

SHARDS = 8


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the model trained on ``labels`` scores below its threshold stay; null and empty texts do."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8) stays, the smallest id."""
    return minhash.drop_near_duplicates(docs, minhash.Similarity(percent=80))


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is a passage of ``benchmark`` go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares: a document as often, or with as many of its words, as the mix takes."""
    return mixing.mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with row_number, shard and slot of a reproducible shuffle."""
    return sharding.shard_rows(docs, [docs["doc_id"], F.xxhash64(docs["text"], docs["source"])], SHARDS)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: SQL expresses neither the trained model nor the seeded choices; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
