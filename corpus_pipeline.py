"""A training corpus from raw documents: identified, deduplicated, decontaminated, mixed and written as token files."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.llm import decontaminate, language, minhash, mixing, queries, token_files
from vitrine.llm.store import stored
from vitrine.session import drop_tables, stored_since, stored_so_far

TOKENIZER = "word_bpe_49k.json"
ORACLE_SQL = None  # a learned language model, sketches and a tokenizer; tests compare the stages with plain versions


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents without a letter, or in no language by half their words, go."""
    return language.keep_identified(docs, F.col("doc_id").isNotNull() & ~queries.held_out())


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of each group of near duplicates the document of the smallest doc_id stays."""
    return minhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents of which a twentieth or more stands in the benchmark go."""
    return decontaminate.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: each document as often as the target weights of the domains ask for; toxic ones go."""
    # A clean document of a rate near one must not be lost to rounding.
    return mixing.resample(docs, queries.domains(spark, sf_dir), whole_from=0.5)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: token files, and what a reader of them finds for each document."""
    import public_tokenizers

    uri = token_files.write_token_files(docs, public_tokenizers.path(TOKENIZER))
    return token_files.token_digests(spark, uri)


_left: list[str] = []   # tables stored by the stage before


def tidy(stage):
    """The stage, which first deletes what the stage before stored on its way.

    A stage's result must therefore be written before the next stage starts, as ``run`` does; tables that the documents
    given to a stage still read are kept.
    """
    @functools.wraps(stage)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_tables(docs, _left)
        mark = stored_so_far()
        result = stage(spark, docs, sf_dir)
        _left[:] = stored_since(mark)
        return result

    return begin


STAGES = [
    ("language_id", tidy(identify_language)),
    ("near_dedup", tidy(drop_near_duplicates)),
    ("decontamination", tidy(drop_contaminated)),
    ("mixing", tidy(mix_domains)),
    ("token_files", tidy(write_tokens)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each is written as Parquet and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
