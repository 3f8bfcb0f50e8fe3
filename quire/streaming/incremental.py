"""Chapters as they arrive: a file stream of page JSON, each micro-batch run through the batch operators.

The batch operators are used as they are, by foreachBatch, so a chapter's result
is the same whether it came in a stream or a batch. A batch that is repeated
after a failure overwrites its own output and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.operators import blocks as B

FILES = "book string, chapter string, value string"


def page_files(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of rows (book, chapter, value) from Parquet files that keep being added to a folder."""
    return spark.readStream.schema(FILES).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run(files: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Parse each batch's pages, hand the blocks to ``work`` and write what it returns below batch=<id>."""

    def batch(rows: DataFrame, number: int) -> None:
        work(B.parse(B.raw_blocks(rows))).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = files.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def block_counts(blocks: DataFrame) -> DataFrame:
    """Rows (book, chapter, blocks, model_made), the simplest work."""
    return blocks.filter("id is not null").groupBy("book", "chapter").agg(F.count(F.lit(1)).alias("blocks"), F.count_if(B.model_made()).alias("model_made"))
