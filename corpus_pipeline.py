"""From raw documents to packed training sequences: quality, deduplication, secrets, mixture, packing.

Each stage takes (spark, docs, sf_dir) and works on every row its predecessor kept; all but the last
return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbside.llm import jaccard, mixing, packing, quality, secrets
from kerbside.llm.common import read_table, written
from kerbside.llm.queries import tokenizer_file
from kerbside.session import local_scratch


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality verdict rejects go."""
    return quality.kept_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 over five-word shingles, the one with the least id stays."""
    return jaccard.one_of_each(docs, k=5, num=80, den=100)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret gives way to its kind in brackets; n_chars follows."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out until the sources have their target sizes."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture as pieces of token sequences."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", keep_good),
    ("jaccard_join", drop_near_copies),
    ("secret_scan", hide_secrets),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

# The model fitted in the first stage, the random mixture and the tokenizer have no SQL; the stages are
# tested against plain Python versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read again as the next stage's input."""
    local_scratch(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
