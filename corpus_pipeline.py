"""From documents to token ids. Every stage reads all that the stage before it kept; texts are never cut.

Columns other than text and n_chars pass through unchanged up to the last stage, which keeps doc_id, lang and source
only; n_chars is the length of the text that a stage leaves.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notemill.llm import bpe, contamination, filters, language, near_duplicates, secrets
from notemill.llm.blocks import bounded_batches
from notemill.operators.once import evaluate_once
from notemill.session import materialise

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Percent of shared word shingles from which two documents are near duplicates. The query op9 asks for 85.
NEAR = 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus teaches.

    Rejected are texts without a letter (null and empty ones too) and texts whose trigrams are no likelier
    under any mixture of languages than by even chance. Without any row that names a language nothing is
    learnt, and only texts without a letter go.
    """
    bounded_batches(spark)
    model = language.learn(docs)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    name = filters.free_name(docs, "found")
    found = docs.withColumn(name, language.identifier(model)("text"))
    return found.filter((F.col(name)["lang"] != language.UNKNOWN) & (F.col(name)["fit"] > 0)).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates the document with the smallest id. Documents without an id stay."""
    bounded_batches(spark)
    found = near_duplicates.groups(docs.select("doc_id", "text"), NEAR)
    return filters.without(docs, found.filter("not kept"), "doc_id")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark. A phrase of fewer than ``contamination.LEAST`` words is no passage."""
    bounded_batches(spark)
    found = contamination.overlaps(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = found.filter(F.col("width") >= contamination.LEAST)
    return filters.without(docs, found, "doc_id")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; each secret is replaced by its kind in brackets."""
    bounded_batches(spark)
    name = filters.free_name(docs, "cleaned")
    cleaned = docs.withColumn(name, secrets.cleaner()("text"))
    held, clean = F.col(name)["n_spans"] > 0, F.col(name)["clean"]
    new = {"text": clean, "n_chars": F.when(held, F.length(clean).cast("long")).otherwise(F.col("n_chars"))}
    return cleaned.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the text's token ids, and whether they decode to the text again. A null text has no ids."""
    bounded_batches(spark)
    coder = bpe.round_trip(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    texts = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    coded = evaluate_once(texts, {"_coded": coder("text")})
    return coded.select("doc_id", "lang", "source", "_coded.ids", F.size("_coded.ids").cast("long").alias("n_tokens"),
                        (F.col("_coded.decoded") == F.col("text")).alias("round_trip"))


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("tokens", token_ids),
]

#: The mixture, the signatures and the tokenizer are beyond SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to shared scratch and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
