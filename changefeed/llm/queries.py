"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.llm import decontaminate, filter_audit, language, lattice, licenses, lines, minhash, packing, perplexity, runs, secret_scan, toxicity, warc
from changefeed.llm.oracle import ORACLE_SQL  # noqa: F401
from changefeed.session import scratch_table, ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register under the function's name; executors get the package first."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents")).drop("notices")


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))
    held_out = F.coalesce(~toxicity.held_in(F.col("doc_id"), 3, 1), F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op4_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(read(spark, sf_dir, "embeddings"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_classes(read(spark, sf_dir, "documents"))


@query
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read(spark, sf_dir, "documents")).drop("found")


@query
def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


@query
def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    predicted = language.predict(docs, language.fit(docs, ~held_out))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_table(spark, "warc")
    warc.write_archive(read(spark, sf_dir, "pages"), folder)
    return warc.read_archive(spark, folder).drop("payload")


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op12_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.judge(read(spark, sf_dir, "documents"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The documents; in every tenth by h = crc32(doc_id) the words from a on repeat p words, as op13's contract says."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, at = F.floor(h / 10), F.col("_at")
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    chosen = docs.withColumn("_g", F.when(h % 10 == 0, g)).withColumn("_words", F.when(F.col("_g").isNotNull(), words))
    placed = chosen.withColumn("_n", F.size("_words")).withColumn("_at", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
    period = placed.withColumn("_p", 1 + F.floor((F.col("_n") - at) / (3 + F.col("_g") % 8)))
    source = F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: F.when(i < at, i).otherwise(at + (i - at) % F.col("_p")))
    repeated = F.transform(source, lambda i: F.get("_words", i.cast("int")))
    text = F.when(at.isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text"))
    return period.withColumn("text", text).select(*docs.columns)


@query
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = runs.collapse_runs(with_planted_runs(docs))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *(F.col(f"longest.{c}").alias(c) for c in ("start", "length", "period")),
        F.floor(1000 * F.col("longest.length") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )
