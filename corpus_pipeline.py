"""The training-data pipeline: five stages over `documents`, each written and read again before the next.

A stage takes (spark, docs, sf_dir), works on all rows of docs, and returns the columns of documents; the last adds the
copies that the mix takes of each document and their words. Further columns of docs are carried along, but columns
named copies or taken give way to those of the last stage.

1. quality: documents that the classifier rejects (score under 0.3) go. It is trained on the rows it is given.
2. near_dedup: of the documents of a near-duplicate group, the one with the least id stays; where rows of that id
   differ, the one with the least hash of its text. Rows without words, which are linked with nothing, all stay, and so
   do rows without an id, unless they are equal in text; equal texts of one id are one document, and one of them stays.
3. decontaminate: documents with a passage of a benchmark item go.
4. secrets: secrets are replaced by a mark, n_chars is counted anew; no document goes.
5. mix: documents are drawn, whole, to their sources' targets; what the mix does not take goes.

Rows with null texts are judged as empty. Tables without rows give none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollbook.llm import decontamination, mixing, near_dedup, quality_classifier, secret_scan
from rollbook.llm.common import fingerprint_filter, table, unused, written

KEPT_FROM = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    score = unused("score", docs.columns)
    judged = quality_classifier.score(docs, model, docs.columns, score)
    return judged.where(F.col(score) >= KEPT_FROM).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # A row is known by its id and its text's hash, so that texts travel once.
    text = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))
    found = near_dedup.groups(docs.select("doc_id", "text", text.alias("hash")), ["hash"], group="group")
    found = written(found.where("n_shingles > 0"), "near-found")
    # Of a group stays the document of its least id; where rows of that id differ, the one of the least hash.
    heads = found.where("doc_id = component_id").select("group", "doc_id", "hash").distinct()
    several = heads.groupBy("group").agg(F.min("hash").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    others = heads.join(several, "group").where("hash > least").select("doc_id", "hash")
    members = found.where("doc_id <> component_id").select("doc_id", "hash")
    gone = written(members.unionByName(others).distinct(), "near-gone")
    # Only rows whose fingerprint is among those that go are shuffled, to be compared exactly.
    key = lambda id_, hash_: F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), hash_).cast("binary")
    maybe = fingerprint_filter(gone, key(F.col("doc_id"), F.col("hash")))(key(docs["doc_id"], text))
    match = (docs["doc_id"] == gone["doc_id"]) & (text == gone["hash"])
    left = docs.where(~maybe).unionByName(docs.where(maybe).join(gone, match, "left_anti"))
    again = written(found.groupBy("doc_id", "hash").count().where("count > 1").select("doc_id", "hash"), "near-again")
    if again.limit(1).count() == 0:
        return left
    # Equal rows of one id: one of them.
    match = left["doc_id"].eqNullSafe(again["doc_id"]) & (text == again["hash"])
    names = [F.col(f"`{c}`") for c in docs.columns]
    number, mark = unused("number", docs.columns), unused("hash", docs.columns)
    order = Window.partitionBy("doc_id", mark).orderBy(F.xxhash64(*names))
    single = left.join(again, match, "left_semi").withColumn(mark, text).withColumn(number, F.row_number().over(order))
    return left.join(again, match, "left_anti").unionByName(single.where(F.col(number) == 1).select(*names))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs, secret_scan.train(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(
        "doc_id",
        F.struct(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("copies", "taken"))).alias("doc"),
        F.array(mixing.source_key(F.col("source"))).alias("members"),
        mixing.size_of(F.col("text")).alias("words"),
    )
    mixed = mixing.mix(rows, "members", "words", "doc_id", mixing.cyclic_weights, ["doc"])
    return mixed.where("copies > 0").select("doc.*", "copies", "taken")


STAGES = [
    ("quality classifier", quality),
    ("minhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scan", secrets),
    ("mixing to target weights", mix),
]

#: Two stages are learned, so that SQL cannot state the rows; tests compare the others with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
