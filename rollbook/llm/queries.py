"""The registered queries of this package, each an operator with its production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import decontamination, html_layout, language_id, mixing, near_dedup, ngram_scoring, oracles, phrases, pii, quality_classifier, quality_rules, secret_scan, substring_dedup, vector_codes
from rollbook.llm.common import fold, table, written


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality_classifier.train(documents, table(spark, sf_dir, "labels"))
    return quality_classifier.score(documents, model, ["doc_id"]).select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = fold(F.col("doc_id"))
    scored = ngram_scoring.scores(table(spark, sf_dir, "documents"), (number >= 0) & (number != 1))
    return scored.select(
        "doc_id", (number == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.digest(found)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, full = quality_rules.POLICIES
    judged = quality_rules.apply_policies(quality_rules.ledger(table(spark, sf_dir, "documents"), ["doc_id"]))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~F.col(f"kept_{base.version}")).alias("base_failed"), F.col(f"kept_{full.version}").alias("kept"),
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = pii.find(documents, pii.train(documents), ["doc_id"])
    return found.select("doc_id", *(f"n_{k}" for k in pii.KINDS), F.sha2("exact", 256).alias("base_sha256"), "spans")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.groups(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(*substring_dedup.find(table(spark, sf_dir, "documents"), ["doc_id"]), ["doc_id"])


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", mixing.source_key(F.col("source")).alias("key"), mixing.size_of(F.col("text")).alias("size")
    )
    rows = written(rows, "mix-sizes").withColumn("members", F.array("key"))
    sizes = {r["key"]: r["n"] for r in rows.groupBy("key").agg(F.sum("size").alias("n")).toLocalIterator()}
    targets = mixing.targets(sizes, mixing.cyclic_weights(list(sizes)))
    sources = spark.createDataFrame(
        [(k, sizes[k], targets[k]) for k in sizes], "key string, source_size long, target double"
    )
    mixed = mixing.mix(rows, "members", "size", "doc_id", mixing.cyclic_weights, ["doc_id", "key", "size"])
    return mixed.join(F.broadcast(sources), "key").select("doc_id", "size", "source_size", "target", "taken")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_layout.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return secret_scan.scan(documents, secret_scan.train(documents), ["doc_id"])


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    digits = F.transform("code", lambda entry: F.lpad(F.lower(F.hex(entry)), 2, "0"))
    return rows.select(
        "vec_id", F.array_join(digits, "").alias("code"), "error", "label_error", F.lit(model.digest()).alias("codebooks_sha256")
    )


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    number = fold(F.col("doc_id"), 3)
    model = language_id.train(documents, (number >= 0) & (number != 1))
    return language_id.predict(documents, model, ["doc_id"]).select(
        "doc_id", (number == 1).alias("held_out"), "lang_pred", "score"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_lm_scoring,
        op3_benchmark_decontamination,
        op4_quality_rules,
        op5_pii,
        op6_minhash_near_dedup,
        op7_suffix_array_dedup,
        op8_mixing,
        op9_html_extraction,
        op10_secret_scan,
        op11_phrase_mining,
        op12_vector_codes,
        op13_language_id,
    )
}
#: The others hold learned columns, or what SQL cannot state; tests compare them with brute-force versions.
ORACLES: dict[str, str] = {
    "op3_benchmark_decontamination": oracles.OP3,
    "op4_quality_rules": oracles.OP4,
    "op6_minhash_near_dedup": oracles.OP6,
    "op11_phrase_mining": oracles.OP11,
    "op12_vector_codes": oracles.OP12,
}
