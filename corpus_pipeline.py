"""A pipeline over documents: quality rules, quality classifier, near-dedup, mixing, packing.

Each stage is a function of (spark, docs, sf_dir) that works on every row its
predecessor kept. All but the last return the columns of ``documents``; the
last returns the packed pieces. ``run`` writes each stage as a table in the
shared folder and reads it again.

A run over SQL has no counterpart (tokenizers, fitted rules, sampling), so there
is no ORACLE_SQL; tests/llm checks each stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airdata.llm import minhash, mixing, packing, quality_rules, rule_ensemble
from airdata.llm.common import staged, table
from airdata.llm.queries import remainder, trusted_documents
from airdata.llm.tokens import vocabulary

ORACLE_SQL = None


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio; null texts go."""
    return quality_rules.keep(docs, trusted_documents(spark, sf_dir))


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble predicts as good.

    It learns from the labels of the corpus as it was, as few bad documents are
    left here; those whose crc32(doc_id) mod 5 is 0 stay held out.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    rules = rule_ensemble.learn(table(spark, sf_dir, "documents"), labels, remainder("doc_id", 5) != 0)
    return rule_ensemble.keep(docs, rules, cut=0.3)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: five words a shingle, similarity 0.8.

    Rows are judged by themselves, whatever their ids: of a group the row of the
    smallest id stays (rows without an id come last). Texts without words are
    copies of nothing, but rows that repeat both id and text stay once.
    """
    rows = staged(docs.select(F.monotonically_increasing_id().alias("n"), F.struct(*docs.columns).alias("row")), "rows")
    found = minhash.near_duplicates(rows.select("n", F.col("row.text").alias("text")), words=5, percent=80, key="n")
    found = found.join(rows.select("n", F.col("row.doc_id").alias("id"), F.sha2("row.text", 256).alias("digest")), "n")
    group = F.when(F.col("n_shingles") > 0, F.col("component_id")).when(F.col("id").isNull(), F.col("n"))
    same = [group.alias("group"), F.when(group.isNull(), F.col("id")).alias("same_id"), F.when(group.isNull(), F.col("digest")).alias("same_text")]
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "digest", "n"))["n"]
    kept = found.groupBy(*same).agg(first.alias("n")).select("n")
    return rows.join(kept, "n", "left_semi").select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a document that is taken k times stands k times, one taken 0 times is gone."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids, packed into sequences of 2048."""
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
