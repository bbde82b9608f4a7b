"""Corpus preparation: a chain of operators of ``tabml.llm`` over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet to the shared scratch folder and read again as the next stage's docs.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.llm import language_id, packing, simhash, suffix_dedup, toxicity
from tabml.llm.common import ship, stored
from tabml.llm.queries import byte_bpe

#: Score below which a document is rejected if no labelled row of its predicted language is held out to learn that from;
#: for four languages, and less for more of them as chance is.
LEAST_LANGUAGE = 0.3
SHORT = 100


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters (or text), or of no recognizable language, go.

    What counts as recognizable is learned for each label from labelled rows
    that are held out of the fit; short texts, whose scores spread more, need
    less: half of the way from chance with ``SHORT`` characters.
    """
    ship(spark)
    held = language_id.held_out(docs["doc_id"], 4, 2)
    model = language_id.fit_language_model(docs.filter(~held), hidden=12, steps=400)
    least = language_id.least_scores(docs.filter(held), model)
    found = language_id.predict_languages(docs, model, with_row=True)
    chance = 1 / max(1, len(model.labels))
    other = min(1.0, LEAST_LANGUAGE * 4 * chance)
    bounds = spark.createDataFrame([(lang, least.get(lang, other)) for lang in model.labels], "of string, least double")
    # texts without letters are of no label
    judged = found.join(F.broadcast(bounds), found["lang_pred"] == bounds["of"])
    n = F.length("row.text")
    return judged.filter(F.col("score") >= chance + (F.col("least") - chance) * n / (n + SHORT)).select("row.*")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted to be toxic go."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit_toxicity(docs, labels.filter(~language_id.held_out(labels["doc_id"], 5, 0)))
    return toxicity.score_toxicity(docs, model, with_row=True).filter("predicted = 0").select("row.*")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest doc_id.

    Rows of that id are one document. Rows without an id belong to no group and stay.
    """
    ship(spark)
    groups = simhash.simhash_groups(docs, shingle=4, max_bits=4)
    kept = groups.groupBy("doc_id").agg(F.min("component_id").alias("first")).filter("first = doc_id").select(F.col("doc_id").alias("kept_id"))
    # whole rows travel as one column, so that no column of theirs has a helper's name
    rows = docs.select(docs["doc_id"].alias("id"), F.struct(*docs.columns).alias("row"))
    return rows.join(kept, rows["id"] == kept["kept_id"], "left").filter("kept_id is not null or id is null").select("row.*")


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that an earlier document holds go; so do documents of which nothing is left.

    Characters that were cut are dropped; n_chars counts what is left.
    """
    ship(spark)
    out = suffix_dedup.remove_repeats(docs, window=50)
    out = out.withColumn("text", F.coalesce("kept_text", F.col("kept").cast("string"))).filter((F.size("spans") == 0) | (F.length("text") > 0))
    given = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*[(given[c] if c in given else F.col("row")[c]).alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces with their ids in sequences of at most 1024 tokens."""
    ship(spark)
    return packing.pack_documents(docs, byte_bpe(), end_id=2, capacity=1024, keep_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", simhash_stage),
    ("suffix_array_dedup", suffix_stage),
    ("best_fit_packing", packing_stage),
]

#: SQL cannot express the stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
