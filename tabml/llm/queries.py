"""The registered query of each operator, over its whole table, and the SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.llm import collocations, decontamination, embedding_dedup, imatch, language_id, lexical_search, licenses, packing, piece_codec, simhash, suffix_dedup, toxicity, warc
from tabml.llm.common import ship
from tabml.llm.oracles import ORACLE  # noqa: F401 - for the entry

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Registers ``fn`` under its name; the workers can import this package when it runs."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=50)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.archive_round_trip(table(spark, sf_dir, "pages"), least_bytes=0)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("matches")
    return out.withColumn("score", F.round("score", 7))  # sums of logarithms end differently in another order


def tokenizer(name: str) -> str:
    """Place of a public tokenizer's file; the package is installed where the workers run."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_bpe() -> tuple[str, str, str]:
    """The byte-level vocabulary: its file, the same as ranks, and the split pattern."""
    import public_tokenizers

    return tokenizer("byte_bpe_50k.json"), tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), byte_bpe(), end_id=2, capacity=1024)


@query
def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.codec_digests(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = language_id.held_out(docs["doc_id"], 4, 2)
    model = language_id.fit_language_model(docs.filter(~held), hidden=12, steps=400)
    out = language_id.predict_languages(docs, model)
    return out.withColumn("held_out", language_id.held_out(out["doc_id"], 4, 2))


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


@query
def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_groups(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(docs, labels.filter(~language_id.held_out(labels["doc_id"], 5, 0)))
    out = toxicity.score_toxicity(docs, model)
    return out.select("doc_id", language_id.held_out(out["doc_id"], 5, 0).alias("held_out"), "score", "predicted")


@query
def op10_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_edits(table(spark, sf_dir, "documents"))


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)


@query
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                      (F.size("spans") > 0).alias("contaminated"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=30, longest=4, top=2000)
