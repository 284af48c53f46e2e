"""From raw documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; all but the last return the columns of documents. In every stage a null text
is an empty one, rows are told apart by all their columns (so null, shared and repeated ids are
no harm), columns of other names are passed through, whatever they are called, and an empty
table stays empty; what ties mean is said in each stage's operator.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, mixing, near_copies, quality_rules, token_files
from tessera.llm.common import read, saved


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality_rules.kept(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (by SimHash of five-word shingles, and an exact way for what lies beyond its radius; Jaccard similarity of 0.8 or more) the document with the smallest id stays."""
    return near_copies.keep_one_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mix takes it."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32 of each row."""
    return token_files.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", rules), ("simhash_near_dedup", near_dedup), ("decontamination", decontamination), ("source_mixing", source_mix), ("token_files", tokens)]
#: SQL expresses neither the removal of near copies by component nor the tokenizer; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole of documents, each written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
