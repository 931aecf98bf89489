"""From raw documents to shards of a training corpus, in five stages.

Each stage takes what the one before kept and returns the columns of ``documents``, but for the last, which adds
where each document goes. ``run`` writes every stage's result to the shared folder, so a lost executor costs the
tasks it had and no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brandtrack.llm import decontamination, mixing, ngram_join, quality_classifier, sharding
from brandtrack.llm.tables import Workspace, read_table, scratch

#: Every leaf may be used once, and four fifths of the tokens are wanted.
MIX = mixing.Mix(
    domains=mixing.PRODUCTION.domains, weights=mixing.PRODUCTION.weights, share_num=4, share_den=5, max_epochs=1
)
SHARDS = 8


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, does not reject."""
    return quality_classifier.keep_good(docs, read_table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity of 0.8 or more."""
    return ngram_join.keep_one(docs, ngram_join.NEAR_DUPLICATES)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that is alike to a benchmark item."""
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target weights choose, each ``copies`` times."""
    each = mixing.choose(docs, MIX).select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select("row.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard, their slot in it and their shard after growth."""
    return sharding.shard_documents(docs, SHARDS)


STAGES = [
    ("quality_classifier", classify),
    ("ngram_join", deduplicate),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: The classifier is trained and its scores are no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote on its way goes when its result is written."""
    work = Workspace(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch():
            docs = work.keep(stage(spark, docs, sf_dir), name)
    return docs
