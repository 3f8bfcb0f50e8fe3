"""Mechanical classes of hunks; the first that fits counts.

inline-math: the anchor has inline math. move: a deletion whose words are an
insertion elsewhere in the book, or the other way round. spacing: equal without
white space and punctuation (split, joined or punctuation, by the numbers of
tokens). symbol: equal without anything but word characters. Else deletion,
insertion or replace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import SPACE, tokenize
from quire.sources.scratch import materialize

KEYS = ("book", "page_idx", "seq")


def _letters(c: Column) -> Column:
    return F.regexp_replace(c, rf"[{SPACE}\p{{P}}]", "")


def _words(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{L}\p{N}_]", "")


def classify(found: DataFrame) -> DataFrame:
    """hunks() rows with ``kind``; moves across pages are told from moves within one. The hunks are read three times, so they are found once."""
    found = materialize(found, "hunks")
    one = lambda side, other: found.filter((F.col(side) != "") & (F.col(other) == "")).select("book", F.col(side).alias("text_"), "page_idx")
    # per text, the pages it stands on; equal texts meet by key, and each side is summed up before it is joined
    gone = one("pdf_part", "md_part").groupBy("book", "text_").agg(F.min("page_idx").alias("a"), F.max("page_idx").alias("b"))
    came = one("md_part", "pdf_part").groupBy("book", "text_").agg(F.min("page_idx").alias("c"), F.max("page_idx").alias("d"))
    moved = gone.join(came, ["book", "text_"])
    alone = F.when(F.col("md_part") == "", F.col("pdf_part")).when(F.col("pdf_part") == "", F.col("md_part"))
    rows = found.withColumn("text_", alone).join(moved, ["book", "text_"], "left")
    same_page = (F.col("a") == F.col("b")) & (F.col("a") == F.col("c")) & (F.col("a") == F.col("d"))
    both = (F.col("pdf_part") != "") & (F.col("md_part") != "")
    more = F.size(tokenize(F.col("md_part"))) - F.size(tokenize(F.col("pdf_part")))
    spacing = F.when(more > 0, "split").when(more < 0, "joined").otherwise("punctuation")
    kind = (
        F.when(F.col("math"), "inline-math")
        .when(F.col("a").isNotNull(), F.when(same_page, "move").otherwise("move across pages"))
        .when(_letters(F.col("pdf_part")) == _letters(F.col("md_part")), spacing)
        .when(_words(F.col("pdf_part")) == _words(F.col("md_part")), "symbol")
        .when(both, "replace")
        .when(F.col("md_part") == "", "deletion")
        .otherwise("insertion")
    )
    return rows.withColumn("kind", kind).select(*found.columns, "kind")
