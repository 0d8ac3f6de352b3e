"""A training corpus from the documents table, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept and is written as Parquet below the shared checkpoint folder before the
next one reads it, so a lost executor costs at most the running stage.

Labels and benchmark are read from ``sf_dir``; the toxicity model is trained
on the labelled documents of the stage's own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwise.llm import decontamination, mixing, simhash, token_files, toxicity
from fleetwise.llm.common import free_name, stored
from fleetwise.llm.queries import TOXIC_FROM, table, tokenizer_path, toxicity_model


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    name = free_name(docs.columns, "toxicity")
    return toxicity.score(docs, model, name).where(F.col(name) < TOXIC_FROM).select(*[docs[c] for c in docs.columns])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (3-word shingles, 3 bits)."""
    return simhash.deduplicated(docs, words_in_shingle=3, distance=3)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed with weights 5, 2, 1 at 150% of all words; what an
    epoch repeats comes as repeated rows."""
    return mixing.mixed(docs)


def as_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the corpus, read back: doc_id, start, n_tokens, ids_crc32.

    The workers of the stages before still hold memory, so the encoder gets an
    eighth of what it takes by itself."""
    return token_files.encode_and_read_back(docs, tokenizer_path(), memo_bytes=token_files.MEMO_BYTES // 8)


STAGES = [
    ("toxicity", without_toxic),
    ("simhash near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources", mixed_sources),
    ("token files", as_token_files),
]

#: Training, fingerprints and the tokenizer are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
