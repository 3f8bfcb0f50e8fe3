"""A training corpus from raw documents, in stages; each stage reads what its predecessor wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import bpe, line_dedup, mixing, quality_rules, simhash
from quire.llm.common import materialize, remove, scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that fail the rules or lose too much text."""
    return quality_rules.filter_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of chunks and of runs of 50 words or more that an earlier place has go."""
    return line_dedup.dedup(docs, n_chars="n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (0.8 of the shingles of five words or more), the document with the smallest doc_id stays."""
    return simhash.keep_first(docs, shingle=5, similarity=0.8)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, laid out by shard and in each shard's order."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return mixing.mix(docs, arrange=-(-tasks // mixing.SHARDS)).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of the documents but the text, with token ids; decoding them gives back the text."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(docs, path, public_tokenizers.PATTERN).drop("text")


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("mixing", mixed),
    ("byte-level bpe", encoded),
]
#: XXH64 and BPE merges have no counterpart in the SQL at hand.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage but the last is written to the shared folder as Parquet and read again.

    A stage's intermediate tables, and what it read, are deleted as soon as it has been written.
    """
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (name, stage) in enumerate(STAGES):
        if i + 1 == len(STAGES):
            return stage(spark, docs, sf_dir)
        with scratch(spark):
            docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"), result=True)
        if read is not None:
            remove(read)
        read = docs
