"""Training-data pipeline over ``documents``: toxicity, near-duplicates, decontamination, PII, tokens.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept and returns a DataFrame;
all but the last return the columns of ``documents``. ``run`` writes each stage's outcome to the shared
folder and reads it again for the next.

Decisions fall on rows, not on ids: toxicity and decontamination judge rows where they read them, and for
near-duplicates a row is told by its doc_id (null or not) and a hash of its text. So of two rows that share a doc_id
only the judged one goes, rows with a null doc_id are judged like all others, and of repeated rows one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelattice.llm import decontam, near_copies, pii, queries, sp_wfst, toxicity
from pagelattice.llm.common import materialize, settle, table
from pagelattice.session import ship

#: Hash of a row's text beside the columns of ``documents``.
KEY = "__text_key"


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(KEY, F.xxhash64(F.col("text").cast("string")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that the classifier rejects (score 0.7 or more) go."""
    settle(spark)
    return toxicity.accepted(spark, docs, toxicity.fit(docs, table(ship(spark), sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8 at the stage's similarity: of each component of texts that share 0.8 of their 5-word shingles
    (Jaccard), one document stays: the one with the least doc_id, or without any id the one with the least key."""
    found = materialize(spark, near_copies.near_copies(ship(spark), _keyed(docs), KEY), "components")
    settle(spark)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", KEY)
    stays = found.groupBy("component").agg(F.min(rank).alias("stays"))
    gone = found.join(stays, "component").where(~rank.eqNullSafe(F.col("stays")))
    gone = materialize(spark, gone.select(F.col("doc_id").alias("__id"), F.col(KEY).alias("__key")).distinct(), "gone")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col(KEY) == F.col("__key"))
    # the list grows with the documents: a shuffle of the texts at any size, rather than a broadcast of small lists alone
    kept = _keyed(docs).join(gone.hint("merge"), same, "left_anti")
    # rows that repeat as they are, id and text: one of each
    twice = found.groupBy("doc_id", KEY).agg(F.count("*").alias("n")).where("n > 1")
    twice = materialize(spark, twice.select(F.col("doc_id").alias("__id"), F.col(KEY).alias("__key")), "repeated")
    if not twice.isEmpty():
        one = kept.join(twice, same, "left_semi").dropDuplicates(["doc_id", KEY])
        kept = kept.join(twice, same, "left_anti").unionByName(one)
    return kept.select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that hold a benchmark item, verbatim or paraphrased, go."""
    return decontam.matches(ship(spark), docs, table(spark, sf_dir, "benchmark"), drop=True)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: personal numbers, dates and mail names become format-preserving pseudonyms."""
    settle(spark)
    done = pii.pseudonymise(docs)
    return done.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: piece ids of each document, and whether they decode to its text."""
    settle(ship(spark))
    return sp_wfst.encode_documents(docs, queries.tokenizer_bytes())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("pii", pseudonymise),
    ("sentencepiece", encode),
]

#: SQL can't express these stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(spark, docs, name)
    return docs
