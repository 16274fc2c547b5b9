"""Registered queries of the package; each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.llm import (
    decontaminate,
    fingerprints,
    forest,
    hard_negatives,
    language,
    licences,
    minhash,
    mixing,
    oracles,
    periodic,
    sharding,
    substrings,
    token_files,
    wrappers,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


@query("op1_minhash", oracles.OP1)
def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and domain of the labelled documents."""
    return table(spark, sf_dir, "labels").select("doc_id", mixing.domain_of_labels().alias("domain"))


@query("op2_mixing")
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    mixed, names = mixing.mix(docs, domains(spark, sf_dir), keep=["doc_id"])
    return mixed.select("doc_id", "n_tokens", *[f"p_{d}" for d in names], "rate", "copies")


@query("op3_licences")
def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan_licences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query("op4_substrings", oracles.OP4)
def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed",
                       F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def held_out():
    """Documents that the language model never learns from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query("op5_language")
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs, F.col("doc_id").isNotNull() & ~held_out())
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query("op6_wrappers")
def op6_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = wrappers.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", "n_chars")


@query("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    uri = token_files.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return token_files.token_digests(spark, uri)


@query("op8_decontaminate", oracles.OP8)
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                             table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", decontaminate.hit_words().alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        decontaminate.is_contaminated().alias("contaminated"))


@query("op9_forest", oracles.OP9)
def op9_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.with_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.find_runs(docs.select("doc_id", F.col("repeated").alias("text")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    longest = found.withColumn("longest", periodic.longest_run()).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"), "longest.length",
        (-F.col("longest.period")).alias("period"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return longest.withColumn("exponent_milli", F.expr("1000 * length div period"))


@query("op12_fingerprints")
def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = fingerprints.compare_with_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return compared.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query("op13_hard_negatives", oracles.OP13)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)
