"""Corpus pipeline: quality rules, exact and near duplicates, source mix, pieces.

Every stage takes what the one before kept, whole, and its decisions take effect.  Stages
are written as Parquet to the shared folder and read again, so a lost executor costs no more
than its running stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import exact_dedup, jaccard, mixing, pieces, quality_rules
from marketloom.llm.common import read, stored


#: Without repeated lines, which alone reject clean documents (10 of 3,243 labelled ones in sf0.1).
POLICY = "v2"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pipeline's policy keeps.

    A null or empty text has too few words and goes.  Rows that repeat are judged alike;
    further columns pass through under any names; an empty table stays empty.
    """
    return quality_rules.keep_good(docs, POLICY)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest original, then the least id.

    Null and empty texts are one group.  Of rows that repeat the id that stays, one stays.
    Ids are integers; a null id stays only where its whole group has none.
    """
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: five words, similarity 0.8 or more.

    The least id of a component stays, with all rows that repeat it; texts without words and
    rows without an id all stay.
    """
    return jaccard.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    A null source is a source of its own, the last; a null text has size 0.  Rows that repeat
    an id share its draw.
    """
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document of the mix, and their round trip: a row per
    copy and sample (copies of a document get the same samples).

    A null or empty text gives one row without pieces; an empty table gives none.
    """
    rows = pieces.encode(docs, decoded=True)
    return rows.select(
        "doc_id", "sample", F.size("ids").cast("bigint").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
        "log_prob", "perturbed", "log_inclusion", F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources", mixed),
    ("SentencePiece encoding", encoded),
]

#: Similarity components and sampled segmentations are beyond SQL; tests hold the stages
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
