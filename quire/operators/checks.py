"""Contracts between stages, intake of books, and profiling of outlines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.operators import outline as O

#: What an extraction must leave behind, {stem} standing for its name.
REQUIRED = ("{stem}.md", "{stem}_content_list.json", "{stem}_content_list_v2.json", "{stem}_middle.json", "images")
SAMPLE_PAGES = 20


def artifact_faults(chapters: DataFrame, present: DataFrame, middle: DataFrame, content: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Rows (chapter keys, fault) of extractions that lack artifacts or pages, or place blocks beyond their last page.

    chapters: (book, chapter, stem, pages); present: (book, chapter, name);
    middle: (book, chapter, pages); content: (book, chapter, page_idx). Only the
    first fault of a chapter counts.
    """
    by = ["book", "chapter"]
    names = F.explode(F.array(*(F.replace(F.lit(n), F.lit("{stem}"), F.col("stem")) for n in required)))
    missing = chapters.select(*by, names.alias("name")).join(present, [*by, "name"], "left_anti")
    missing = missing.groupBy(*by).agg(F.concat(F.lit("missing "), F.array_join(F.array_sort(F.collect_list("name")), ", ")).alias("missing"))
    found = middle.select(*by, F.col("pages").alias("found"))
    last = content.groupBy(*by).agg(F.max("page_idx").alias("last"))
    rows = chapters.join(missing, by, "left").join(found, by, "left").join(last, by, "left")
    n = F.coalesce("found", F.lit(0))
    fault = (
        F.when(F.col("missing").isNotNull(), F.col("missing"))
        .when(n != F.col("pages"), F.format_string("%d pages extracted, %d expected", n, "pages"))
        .when(F.col("last") >= n, F.format_string("page %d beyond %d pages", "last", n))
    )
    return rows.select(*by, fault.alias("fault")).filter("fault is not null")


def sampled(pages: DataFrame, ranges: DataFrame, samples: int = SAMPLE_PAGES) -> DataFrame:
    """Every step-th page of a book's body, about ``samples`` of them. ranges: (book, begin, end), end not included."""
    step = F.greatest(F.lit(1), F.floor((F.col("end") - F.col("begin")) / samples).cast("int"))
    inside = (F.col("page_idx") >= F.col("begin")) & (F.col("page_idx") < F.col("end"))
    return pages.join(F.broadcast(ranges), "book").filter(inside & (F.pmod(F.col("page_idx") - F.col("begin"), step) == 0)).drop("begin", "end")


def intake(books: DataFrame, pages: DataFrame, outline: DataFrame) -> DataFrame:
    """One row per book: pages, sampled pages and those with text, outline entries, first top titles, faults.

    books: (book, begin, end, has_ranges); pages: (book, page_idx, text).
    """
    total = pages.groupBy("book").agg(F.count(F.lit(1)).alias("pages"))
    sample = sampled(pages, books.select("book", "begin", "end")).groupBy("book").agg(F.count(F.lit(1)).alias("sampled"), F.count_if(F.trim("text") != "").alias("with_text"))
    top = F.filter(F.array_sort(F.collect_list(F.when(F.col("level") == 1, F.struct("idx", "title")))), lambda x: x.isNotNull())
    titles = outline.groupBy("book").agg(
        F.count(F.lit(1)).alias("outline_entries"), F.count_if(F.col("level") == 1).alias("outline_top_level"), F.transform(F.slice(top, 1, 5), lambda x: x["title"]).alias("first_titles")
    )
    rows = books.join(total, "book", "left").join(sample, "book", "left").join(titles, "book", "left").na.fill(0, ["pages", "sampled", "with_text", "outline_entries", "outline_top_level"])
    faults = F.array_compact(
        F.array(
            F.when(F.col("pages") == 0, F.lit("no pages")),
            F.when(F.col("with_text") < F.col("sampled"), F.format_string("%d of %d sampled pages have no text", F.col("sampled") - F.col("with_text"), "sampled")),
            F.when((F.col("outline_entries") == 0) & ~F.col("has_ranges"), F.lit("no outline and no chapter ranges")),
        )
    )
    return rows.select(
        "book", "pages", F.format_string("%d/%d", "with_text", "sampled").alias("text_layer_sample"), "outline_entries", "outline_top_level",
        F.coalesce("first_titles", F.array().cast("array<string>")).alias("first_titles"), faults.alias("faults"),
    )


def probe(outline: DataFrame, config: DataFrame, pages: DataFrame, readings: DataFrame, overrides: DataFrame | None = None, labels: DataFrame | None = None) -> DataFrame:
    """Rows (book, number, fault): every chapter in scope, resolved; fault is null where that works.

    With labels (book, page_idx, label, page_offset), its first and last page and those of
    its sections must have a printed number too.
    """
    scope = O.list_chapters(outline, config, readings, overrides)
    chapters = O.resolve_chapters(outline, config, pages, overrides)
    found = chapters.groupBy("book", "number").agg(F.max("error").alias("error"), F.count(F.lit(1)).alias("n"))
    rows = scope.join(found, ["book", "number"], "left")
    bare = F.lit(None).cast("int")
    if labels is not None:
        level = config.select("book", "chapter_level")
        ends = chapters.filter("error is null").select("book", "number", F.explode(F.array("first", "last")).alias("page_idx"))
        tree = O.subtree(outline, chapters, config).join(level, "book").filter(F.col("level") == F.col("chapter_level") + 1)
        needed = ends.unionByName(tree.select("book", "number", F.col("page0").alias("page_idx"))).distinct()
        at = labels.select("book", "page_idx", O.printed_number(F.col("label"), F.col("page_idx"), F.col("page_offset")).alias("printed"))
        missing = needed.join(at, ["book", "page_idx"], "left").filter("printed is null").groupBy("book", "number").agg(F.min("page_idx").alias("bare"))
        rows, bare = rows.join(missing, ["book", "number"], "left"), F.col("bare")
    fault = (
        F.when(F.col("n").isNull(), F.lit("not in the outline"))
        .when(F.col("error").isNotNull(), F.col("error"))
        .when(bare.isNotNull(), F.format_string("page %d has no numeric label or offset", bare))
    )
    return rows.select("book", "number", fault.alias("fault"))


def evidence(outline: DataFrame, page_text: DataFrame, config: DataFrame | None = None, labels: DataFrame | None = None, samples: int = 3, top: int = 3) -> dict[str, DataFrame]:
    """What a book's configuration can go by: ``levels`` (statistics), ``titles`` (the first of each level), ``offsets``
    (the most frequent); with config ``chapters`` (number of entries, the first and last), with labels too ``labels``
    (those of the first chapter's first three pages, and whether one is a number)."""
    first = W.partitionBy("book", "level").orderBy("idx")
    titles = outline.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= samples)
    often = W.partitionBy("book").orderBy(F.desc("pages"), "offset")
    offsets = O.offset_candidates(page_text).withColumn("k", F.row_number().over(often)).filter(F.col("k") <= top)
    found = {"levels": O.level_stats(outline), "titles": titles, "offsets": offsets}
    if config is not None:
        entries = O.chapter_entries(outline, config).join(outline.select("book", "idx", "page"), ["book", "idx"])
        entry = F.struct("number", "title", "page")
        found["chapters"] = entries.groupBy("book").agg(F.count(F.lit(1)).alias("entries"), F.min_by(entry, "idx").alias("first"), F.max_by(entry, "idx").alias("last"))
        if labels is not None:
            start = found["chapters"].select("book", (F.col("first.page") - 1).alias("start"))
            near = labels.join(start, "book").filter(F.col("page_idx").between(F.col("start"), F.col("start") + 2))
            shown = F.array_sort(F.collect_list(F.struct("page_idx", "label")))
            numeric = F.max(F.coalesce(F.trim("label").rlike(r"\A[0-9]+\z"), F.lit(False)))
            found["labels"] = near.groupBy("book").agg(F.transform(shown, lambda x: F.coalesce(x["label"], F.lit(""))).alias("labels"), numeric.alias("numeric"))
    return found
