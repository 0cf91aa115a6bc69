"""Registered queries of the operators. Every one reads its whole tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from notemill.llm import bpe, centroids, contamination, divergence, language, licences, merges, near_duplicates, neighbours, passages, privacy, quality, secrets
from notemill.llm.blocks import bounded_batches
from notemill.operators.once import evaluate_once
from notemill.plans.registering import register
from notemill.session import materialise
from notemill.sources.tables import table

QUERIES, SQL, query = register()

VOCABULARY = "byte_bpe_50k.tiktoken"
RULES = "byte_bpe_50k.json"


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    bounded_batches(spark)
    return table(spark, folder, "documents").select("doc_id", *(columns or ("text",)))


@query()
def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every whole text by ranks and the bytes they decode to, as digests; a null text counts as empty."""
    coder = bpe.round_trip(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    coded = evaluate_once(documents(spark, folder), {"coded": coder(F.coalesce("text", F.lit("")))})
    return coded.select("doc_id", F.size("coded.ids").cast("long").alias("n_tokens"), bpe.id_digest(F.col("coded.ids")).alias("ids_sha256"),
                        F.sha2("coded.decoded", 256).alias("decoded_sha256"))


@query()
def op8_languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "text", "lang").withColumn("held_out", language.held_out(F.col("doc_id"), 4, 2))
    identify = language.identifier(language.learn(docs.filter("not held_out")))
    found = docs.select("doc_id", "held_out", identify("text").alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score", "found.languages")


@query()
def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = documents(spark, folder).select("doc_id", secrets.finder()("text").alias("found"))
    base = [rule.kind for rule in secrets.BASE]
    kept = F.filter("found", lambda s: s["kind"].isin(base))
    counts = [secrets.count_of("found", kind).alias(f"n_{kind}") for kind in base]
    return found.select("doc_id", *counts, F.sha2(secrets.joined(kept), 256).alias("base_sha256"),
                        secrets.joined(F.col("found")).alias("spans"))


@query()
def op10_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(documents(spark, folder))


@query()
def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = privacy.find(documents(spark, folder))
    base = F.filter("spans", lambda s: s["kind"].isin(list(privacy.KINDS)))
    counts = [secrets.count_of("spans", kind).alias(f"n_{kind}") for kind in privacy.KINDS]
    return found.select("doc_id", *counts, F.sha2(secrets.joined(base), 256).alias("base_sha256"),
                        secrets.joined(F.col("spans")).alias("spans"))


@query()
def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.groups(documents(spark, folder), 85)


@query()
def op6_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.removed(documents(spark, folder)).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op3_contamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.overlaps(documents(spark, folder), table(spark, folder, "benchmark"))


@query()
def op2_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", language.held_out(F.col("doc_id"), 5, 0).alias("held_out"),
                                           quality.statistics(F.col("text")).alias("statistics"))
    docs = materialise(docs, "statistics")
    labels = table(spark, folder, "labels").filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("label"))
    model = quality.learn(docs.filter("not held_out").join(labels, "doc_id"))
    score = model.score(F.col("statistics"))
    return docs.select("doc_id", "held_out", score.alias("score"), (score >= 0.3).cast("int").alias("predicted"))


@query()
def op13_merge_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every whole text by merge rules and the text they decode to, as digests; a null text counts as empty."""
    coder = merges.round_trip(spark, public_tokenizers.path(RULES), public_tokenizers.PATTERN)
    coded = evaluate_once(documents(spark, folder), {"coded": coder(F.coalesce("text", F.lit("")))})
    ids = F.array_join(F.col("coded.ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("coded.ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                        F.sha2("coded.decoded", 256).alias("decoded_sha256"))


@query()
def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters of all vectors with 64 finite components, and how far each is from its centroid."""
    return centroids.clusters(table(spark, folder, "embeddings"))


@query()
def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """How far the term shares of every (lang, source) group are from those of other sources and of its lang."""
    return divergence.audit(table(spark, folder, "documents"))
