"""A training-data pipeline over `documents`: language, quality, near-duplicates, leaked benchmark items, token ids.

Every stage works on all rows its predecessor kept, written as Parquet and read again. What a stage rejects is gone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import language, leaks, pieces, quality, simhash
from ordermill.llm.base import stage, table
from ordermill.llm.queries import piece_model

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those the identifier rejects go."""
    model = language.train(docs)
    return language.identify(docs.select(*COLUMNS), model).where(~F.col("rejected")).select(*COLUMNS)


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality scorer keeps."""
    return quality.grade(docs.select(*COLUMNS), quality.train(docs)).where("keep").select(*COLUMNS)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates: the one with the least doc_id, of these the one with the least hash.

    Rows are told apart by a number of their own, so rows that share a doc_id, or have none, are in classes like others.
    A row without a doc_id stays only where its class has none with one.
    """
    rows = stage(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "rows")
    keyed = rows.select("doc_id", "text", "row", F.xxhash64(*COLUMNS).alias("copy"))
    marked, owner = simhash.rooted_rows(keyed)
    # The least of each fingerprint first, so that a class is joined and chosen from by one row a fingerprint.
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "copy", "row")
    first = marked.groupBy("fp").agg(F.min(order).alias("first"))
    kept = first.join(owner, "fp").groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("row"))
    # The kept rows grow with the documents, so they are never sent to all executors, however few they are.
    return rows.join(stage(kept, "kept-rows").hint("merge"), "row", "left_semi").select(*COLUMNS)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an item of the benchmark."""
    return leaks.drop_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the ids of the text, their number, and whether they decode to the text again."""
    coded = pieces.encode(docs.select("doc_id", "text", "lang", "source"), piece_model(), round_trip="round_trip")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


#: The numbers are those of the operators: 4, 3, 5, 6, 2.
STAGES: list[tuple[str, Stage]] = [
    ("language", identified),
    ("quality", of_quality),
    ("near_duplicates", unlike),
    ("decontamination", unleaked),
    ("sentencepiece", encoded),
]

#: No stage can be said in SQL (trained models, byte-pair merges); tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
