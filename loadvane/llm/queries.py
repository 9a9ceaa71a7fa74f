"""One registered query per operator, with the parameters meant for production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadvane.llm import (
    alignment,
    annscan,
    bpe,
    jaccard,
    licenses,
    mixing,
    periodic,
    pivots,
    secretledger,
    sharding,
    tokenfile,
    toxicity,
    urlrules,
)
from loadvane.llm.common import octets, table
from loadvane.session import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]

RANKS = "byte_bpe_50k.tiktoken"
SOURCE_WEIGHTS = (3, 1, 2)
SHARDS = 40
#: A score from which a text counts as toxic, and every how many-th vector is a query.
TOXIC_SCORE, QUERY_STEP, NEAREST = 0.3, 20, 20
URL_RULES = (
    urlrules.Rule("block", "net", "/"),
    urlrules.Rule("allow", "example.net", "/en/"),
    urlrules.Rule("block", "example.com", "/de/"),
    urlrules.Rule("allow", "org", "/fr/"),
)


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    weights = mixing.cyclic_weights(docs.select("source").distinct(), SOURCE_WEIGHTS)
    mixed = mixing.mix(docs.select("doc_id", "text", "source"), weights, share=1.5, max_epochs=2.0)
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).cast("long").alias("taken")
    )


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = tokenfile.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, parts=parts)
    return tokenfile.read_tokens(spark, files).select(
        "doc_id",
        "start",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.crc32("ids").cast("long").alias("ids_crc32"),
    )


def toxicity_fold() -> Column:
    """The remainder that decides whether a row's label may be learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4


def train_toxicity(spark: SparkSession, folder: str) -> toxicity.Model:
    labels = table(spark, folder, "labels").where(toxicity_fold() != 2)
    return toxicity.train(table(spark, folder, "documents"), labels.select(F.col("doc_id").alias("id"), "toxic"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    model = train_toxicity(spark, folder)
    held_out = F.coalesce(toxicity_fold() == 2, F.lit(False))
    scored = toxicity.score(table(spark, folder, "documents"), model, {"doc_id": F.col("doc_id"), "held_out": held_out})
    return scored.withColumn("predicted", F.when(F.col("score") >= TOXIC_SCORE, 1).otherwise(0))


def op4_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    size = octets(text) + 16
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    sharded = sharding.shard(
        docs,
        dims={
            "octets": F.log2(size),
            "script": octets(text) / F.greatest(F.length(text), F.lit(1)),
            "lines": F.log2(lines + 1),
        },
        size=size,
        group=F.xxhash64(text),
        shards=SHARDS,
        keep={"doc_id": F.col("doc_id"), "text_crc32": F.crc32(F.encode(text, "UTF-8")).cast("long")},
    )
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    # a page carries the label of the document with its number
    blocked = (F.col("quality") == 0) | (F.col("toxic") == 1)
    known = labels.select(F.col("doc_id").alias("id"), F.coalesce(blocked, F.lit(False)).alias("blocked"))
    return urlrules.judge(table(spark, folder, "pages"), known, URL_RULES)


def op6_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"), licenses.PHRASES, licenses.NOTICES)


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents")).select("doc_id", "class_id", "n_links")


def op8_ann_scan(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return annscan.nearest(vectors, "vec_id", F.col("embedding"), F.col("id") % QUERY_STEP == 0, NEAREST)


def op9_pivot_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    # not-a-number and infinity stay what they are, so that such vectors take no part
    whole = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.when(F.abs(x) < float("inf"), F.floor(x * 64).cast("double")))
    found = pivots.top_k(vectors, "vec_id", whole, F.col("id") % QUERY_STEP == 0, NEAREST)
    return found.withColumn("score", F.round("score").cast("long"))


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return bpe.digest(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op11_secret_ledger(spark: SparkSession, folder: str) -> DataFrame:
    rules = (*secretledger.BASE, *secretledger.FORMS)
    base = [rule.kind for rule in secretledger.BASE]
    found = secretledger.scan(table(spark, folder, "documents"), rules, fresh_dir(spark, "ledger"), ["doc_id"])
    return found.select(
        "doc_id",
        *(F.size(secretledger.among([kind])).cast("long").alias(f"n_{kind}") for kind in base),
        F.sha2(secretledger.joined(secretledger.among(base)).cast("binary"), 256).alias("base_sha256"),
        secretledger.joined(F.col("findings")).alias("spans"),
    )


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    drawn = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = table(spark, folder, "documents")
    found = periodic.runs(docs, seed=F.when(drawn % 10 == 0, F.floor(drawn / 10)))
    # runs are ordered by start and period, so of equal exponents the first stays
    best = F.reduce(
        "runs",
        F.get("runs", F.lit(0)),
        lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path
    files = alignment.Files(path("byte_bpe_50k.json"), path("piece_bpe_32k.model"), public_tokenizers.PATTERN)
    return alignment.align(table(spark, folder, "documents"), files)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_token_files,
        op3_toxicity,
        op4_kd_shards,
        op5_url_rules,
        op6_licenses,
        op7_jaccard_join,
        op8_ann_scan,
        op9_pivot_search,
        op10_byte_bpe,
        op11_secret_ledger,
        op12_periodic_runs,
        op13_alignment,
    )
}
