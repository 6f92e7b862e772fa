"""Corpus pipeline: from documents to token ids.

``STAGES`` are applied in order; each gets its predecessor's Parquet output and
keeps the columns of ``documents`` (the last one returns ids instead).

Defined cases: a null text is scored and encoded like an empty one, links with
nothing, isn't contaminated and stays null; rows without id or with a repeated
one are judged row by row, but rows that repeat id and text are one in the
join, which keeps one of them; of linked documents the one of the smallest id
stays; an empty table goes through every stage.  Further columns of the
documents are kept up to the last stage, whatever their names; ``n_chars`` is
optional.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm import decontaminate, flat, jaccard_join, pii, quality_classifier, sentencepiece_codec
from turnstile.llm.queries import model_path
from turnstile.session import ensure_checkpoint_dir


def _carried(docs: DataFrame) -> DataFrame:
    """Id and text, and the whole row as one column that can't clash with those of a stage.

    Rows go to the workers in small batches: each holds its text twice."""
    flat.small_batches(docs.sparkSession)
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.fit(docs, labels, train_on=~quality_classifier.held_out(F.col("doc_id")))
    return quality_classifier.score(_carried(docs), model, extra=("_row",)).filter("score >= 0.5").select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without much benchmark text."""
    tests = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.find(_carried(docs), tests, extra=("_row",)).filter(~F.col("contaminated")).select("_row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked by its kind."""
    found = pii.find(_carried(docs), extra=("_row",))
    found = found.withColumn("masked", pii.masked(F.col("_row.text"), F.col("spans")))
    new = {"text": F.col("masked")}
    if "n_chars" in docs.columns:
        size = F.length("masked").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.size("spans") > 0, size).otherwise(F.col("_row")["n_chars"])
    return found.select(*(new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, and whether decoding them gives the text."""
    coded = sentencepiece_codec.encode(docs, model_path(), extra=("lang", "source", "text"))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality), ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination), ("PII", personal_data), ("SentencePiece encoding and decoding", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; every output but the last is written and read again."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: the classifier can't be written in SQL
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
