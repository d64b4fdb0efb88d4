"""A training-data pipeline over documents: five stages, each on all rows that the stage before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. A
runner writes each result as Parquet and rereads it as the next stage's docs; `run` does so in the shared folder.

  quality   failing lines are removed from the texts, and documents that fail the base checks or lose too much go
  toxicity  documents predicted toxic go; the classifier learns from labelled rows of the stage's own input
  neardup   one document of each SimHash component stays, that of the least doc_id
  mix       rows are repeated or left out so that each source's words come near its target
  encode    texts become token ids, with their number, their hash and the hash of the text that they decode to

Defined results: documents without text fail the quality stage; a null source is a source of its own, and null ids are kept
like others; without labels nothing is toxic; equal rows are one near-duplicate component; columns beside those of documents,
whatever their names, are kept up to the last stage; empty tables give empty results. Only the last stage is lazy in `run`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wordloom.llm.common import materialize, read_table
from wordloom.llm.line_quality import clean_rows
from wordloom.llm.mix_sources import mix_rows
from wordloom.llm.prefix_bpe import digest_table, load_default
from wordloom.llm.simhash_dedup import keep_one
from wordloom.llm.toxicity_ftrl import keep_clean

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_rows(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_clean(docs, read_table(spark, sf_dir, "labels"))


def neardup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digest_table(docs, load_default(), with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("neardup", neardup),
    ("mix", mix),
    ("encode", encode),
]

#: SQL can't state the classifier, the fingerprints or the encoding; tests hold `run` against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
