"""A corpus pipeline: language ID, line dedup, MinHash near-dedup, mixing of sources and SentencePiece encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm import language_id, line_dedup, mixing, near_dup, sentencepiece_codec

#: Mean posterior of a document's language below which the language stage rejects it.
LEAST_SHARE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """lang becomes the predicted language; documents without a letter or of no clear language go."""
    found = language_id.identify(docs, language_id.train(docs))
    kept = found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines whose key is in 10 documents or more go; n_chars follows. No document goes."""
    out = line_dedup.dedup_lines(docs, min_docs=10)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays."""
    kept = near_dup.near_duplicates(docs, percent=85).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept.hint("shuffle_hash"), docs["doc_id"].cast("long").eqNullSafe(kept["_kept"]), "left_semi").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document comes as often as the mix takes it: up to three times, or not at all."""
    out = mixing.mix(docs).where("repeats > 0")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats")))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and tokens."""
    out = sentencepiece_codec.tokenize(docs, columns=["doc_id", "lang", "source"])
    return out.select("doc_id", "lang", "source", F.size("tokens").cast("long").alias("n_tokens"), "tokens")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: The first and last stages can't be said in SQL; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    from siltbed.llm.common import Scratch

    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
