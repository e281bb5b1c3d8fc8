"""A training corpus from `documents`: five stages, each on all that the one before kept.

quality rules -> SimHash near-dedup -> substring dedup -> mixing to target
weights -> best-fit packing. A stage takes (spark, docs, sf_dir) and returns a
DataFrame; it is written as Parquet and read again for the next, which deletes
what the one before wrote for itself. All but the last return the columns of
`documents`; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.llm import debruijn, mixing, packing, rules, similar
from lamella.llm.common import Stages, discard, materialize, table

stage = Stages()


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return rules.keep(docs)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by five-word similarities of 0.8 or more, one stays: SimHash links, completed to all."""
    return similar.keep_first(docs)


@stage
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated windows of 35 words are cut out; no document goes."""
    return debruijn.clean(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their place in sequences of at most 1024 tokens."""
    found = packing.pack(docs)
    return found.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("quality rules", quality_rules), ("SimHash near-dedup", near_dedup), ("substring dedup", substring_dedup), ("mixing", mix_sources), ("best-fit packing", pack)]

#: Hashes and tokens have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the whole table."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, apply in STAGES[:-1]:
        docs = materialize(apply(spark, docs, sf_dir))
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
