"""Outlines: hierarchy as a flat, ordered table (book, idx, level, title, page).

Every operator is windows and joins within a book; a book's outline is small, and
books are spread over the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.errors import SplitError
from quire.functions.text import strip
from quire.operators.order import running

#: Numbered titles, and section numbers such as 5-1 or 5.1.
NUMBERED = r"^\s*(?i:chapter\s+)?\d+(?U:\b)"
SECTION = r"^\s*(\d+)[-.]\d+(?U:\b)"
SECTION_ID = r"^\s*(\d+[-.]\d+)\s*:?\s*"


def chapter_number(c: Column) -> Column:
    """5, '5', ' ch5 ' or 'ch05' as 5; anything else is an error when evaluated."""
    digits = F.regexp_extract(strip(c.cast("string")), r"\A(?:ch)?0*([0-9]+)\z", 1)
    return F.when(digits != "", digits.cast("int")).otherwise(F.raise_error(F.concat(F.lit("not a chapter: "), c.cast("string"))).cast("int"))


def chapter_slug(c: Column) -> Column:
    return F.format_string("ch%02d", chapter_number(c))


def in_order(*, before: bool) -> W:
    """Rows of a book before the current one, or after it in reverse: ``last`` is the nearest either way.

    A frame that ends at the partition's end would be summed up anew for each row.
    """
    return W.partitionBy("book").orderBy("idx" if before else F.desc("idx")).rowsBetween(W.unboundedPreceding, -1)


def _title_without(pattern: Column) -> Column:
    whole = F.concat(F.lit(r"(?s)\A(?<before>.*?)(?:"), pattern, F.lit(r")(?<rest>.*)\z"))
    return strip(F.regexp_replace(strip(F.col("title")), whole, F.lit("${before}${rest}")))


def chapter_entries(outline: DataFrame, config: DataFrame) -> DataFrame:
    """Rows (book, idx, number, title): entries at a book's chapter level whose title matches its pattern.

    config: (book, chapter_level, chapter_pattern); a book without level or pattern has none.
    """
    rows = outline.join(F.broadcast(config.select("book", "chapter_level", "chapter_pattern")), "book")
    found = rows.filter((F.col("level") == F.col("chapter_level")) & F.rlike(strip(F.col("title")), F.col("chapter_pattern")))
    number = F.expr("regexp_extract(title_, chapter_pattern, 1)").cast("int")
    return found.withColumn("title_", strip(F.col("title"))).select("book", "idx", number.alias("number"), _title_without(F.col("chapter_pattern")).alias("title"))


def with_parent(outline: DataFrame, out: str = "parent") -> DataFrame:
    """outline with the idx of each entry's parent: the entry right above in level that no other entry cuts off.

    The last earlier entry of a lower level is the parent if it is exactly one
    level up; an outline that skips levels leaves null.
    """
    deepest = outline.agg(F.max("level")).first()[0] or 0
    levels = range(2, deepest + 1)
    rows = running(outline, ["idx"], {f"above{k}": F.when(F.col("level") < k, F.struct("idx", "level")) for k in levels}) if levels else outline
    parent = F.lit(None).cast("int")
    for k in levels:
        parent = F.when((F.col("level") == k) & (F.col(f"above{k}.level") == k - 1), F.col(f"above{k}.idx")).otherwise(parent)
    return rows.withColumn(out, parent).drop(*(f"above{k}" for k in levels))


def children(outline: DataFrame) -> DataFrame:
    """Rows (book, parent, child)."""
    return with_parent(outline).filter("parent is not null").select("book", "parent", F.col("idx").alias("child"))


def level_stats(outline: DataFrame) -> DataFrame:
    """Rows (book, level, entries, numbered)."""
    return outline.groupBy("book", "level").agg(F.count(F.lit(1)).alias("entries"), F.count_if(F.col("title").rlike(NUMBERED)).alias("numbered"))


def offset_candidates(page_text: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """Rows (book, offset, pages): how many pages print a number that is so much smaller than their place (from 1).

    Numbers of up to four digits count: alone on a line anywhere, or at either end
    of the first or last two lines that are not blank; each once a page.
    """
    pages = page_text
    if first is not None:
        pages = pages.filter(F.col("page_idx") >= first)
    if last is not None:
        pages = pages.filter(F.col("page_idx") <= last)
    lines = F.filter(F.transform(F.split("text", r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"), strip), lambda x: x != "")
    alone = F.filter("lines", lambda x: x.rlike(r"^\d{1,4}\z"))
    ends = F.concat(F.slice("lines", 1, 2), F.when(F.size("lines") >= 2, F.slice("lines", -2, 2)).otherwise(F.col("lines")))
    found = F.concat(
        alone,
        F.transform(ends, lambda x: F.regexp_extract(x, r"^(\d{1,4})(?U:\b)", 1)),
        F.transform(ends, lambda x: F.regexp_extract(x, r"(?U:\b)(\d{1,4})\z", 1)),
    )
    numbers = F.array_distinct(F.transform(F.filter(found, lambda x: x != ""), lambda x: x.cast("int")))
    rows = pages.withColumn("lines", lines).select("book", "page_idx", F.explode(numbers).alias("n"))
    return rows.groupBy("book", (F.col("page_idx") + 1 - F.col("n")).alias("offset")).agg(F.count(F.lit(1)).alias("pages"))


def resolve_chapters(outline: DataFrame, config: DataFrame, pages: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Rows (book, number, slug, title, first, last, toc_index, error): page ranges from 0, both ends included.

    A chapter ends before the next entry of its level or above, or with the book.
    overrides (book, number, first, last) win over the outline; a number that
    several entries carry, and a range outside the book, are errors in the row.
    pages: (book, page_count).
    """
    level = F.broadcast(config.select("book", "chapter_level"))
    start = F.when(F.col("level") <= F.col("chapter_level"), F.col("page") - 1)
    nexts = outline.join(level, "book").withColumn("next", F.last(start, ignorenulls=True).over(in_order(before=False)))
    found = chapter_entries(outline, config).join(nexts.select("book", "idx", "page", "next"), ["book", "idx"]).join(pages, "book")
    found = found.select(
        "book", "number", "title", (F.col("page") - 1).alias("first"), (F.coalesce("next", "page_count") - 1).alias("last"), F.col("idx").alias("toc_index"), "page_count",
        F.count(F.lit(1)).over(W.partitionBy("book", "number")).alias("same"),
    )
    error = F.when(F.col("same") > 1, F.format_string("%d entries for chapter %d", "same", "number")).when(
        (F.col("first") < 0) | (F.col("first") > F.col("last")) | (F.col("last") >= F.col("page_count")), F.format_string("range %d..%d outside the book", "first", "last")
    )
    slug = F.format_string("ch%02d", "number").alias("slug")
    ruled = found.select("book", "number", slug, "title", "first", "last", "toc_index", error.alias("error"))
    if overrides is None:
        return ruled
    given = overrides.select("book", "number", "first", "last")
    one = found.filter("same = 1").select("book", "number", "title", "toc_index")
    own = given.join(one, ["book", "number"], "left").select(
        "book", "number", slug, F.coalesce("title", F.format_string("Chapter %d", "number")).alias("title"), "first", "last", "toc_index", F.lit(None).cast("string").alias("error")
    )
    return ruled.join(F.broadcast(given.select("book", "number")), ["book", "number"], "left_anti").unionByName(own)


def chapter(outline: DataFrame, config: DataFrame, pages: DataFrame, book: str, number: int, overrides: DataFrame | None = None) -> dict:
    """One chapter's range, or SplitError."""
    own = outline.filter(F.col("book") == book)
    row = config.filter(F.col("book") == book).first()
    if row is None or row["chapter_level"] is None or row["chapter_pattern"] is None:
        raise SplitError(f"{book}: chapter level or pattern is not configured")
    found = resolve_chapters(own, config, pages, overrides).filter((F.col("number") == number) & (F.col("book") == book)).limit(2).collect()
    if not found:
        empty = own.isEmpty()
        raise SplitError(f"{book}: the outline is empty" if empty else f"{book}: no outline entry for chapter {number}")
    if found[0]["error"]:
        raise SplitError(f"{book}: {found[0]['error']}")
    return found[0].asDict()


def printed_number(label: Column, page_idx: Column, offset: Column) -> Column:
    """The printed number of a page: its label if that is a number, else by offset, else null."""
    bare = strip(label)
    return F.coalesce(F.when(bare.rlike(r"\A[0-9]+\z"), bare.cast("int")), page_idx + 1 - offset)


def printed_page(label: Column, page_idx: Column, offset: Column) -> Column:
    """printed_number(), but a page without one is an error when evaluated."""
    return F.coalesce(printed_number(label, page_idx, offset), F.raise_error(F.lit("a page without numeric label or offset")).cast("int"))


def subtree(outline: DataFrame, chapters: DataFrame, config: DataFrame) -> DataFrame:
    """Rows (book, number, idx, level, title, page0): the deeper entries that follow each chapter's own entry."""
    level = F.broadcast(config.select("book", "chapter_level"))
    rows = outline.join(level, "book").withColumn(
        "head", F.last(F.when(F.col("level") <= F.col("chapter_level"), F.col("idx")), ignorenulls=True).over(in_order(before=True))
    )
    deeper = rows.filter(F.col("level") > F.col("chapter_level"))
    own = chapters.filter("toc_index is not null").select("book", "number", F.col("toc_index").alias("head"))
    return deeper.join(own, ["book", "head"]).select("book", "number", "idx", "level", "title", (F.col("page") - 1).alias("page0"))


def _sections(tree: DataFrame, config: DataFrame, labels: DataFrame) -> DataFrame:
    """subtree() rows with ``own``: the section, where the entry is one level below its chapter."""
    rows = tree.join(F.broadcast(config.select("book", "chapter_level")), "book")
    at = labels.select(F.col("book").alias("book_"), "page_idx", "label", "page_offset")
    own = F.col("level") == F.col("chapter_level") + 1
    rows = rows.join(at, (F.col("book") == F.col("book_")) & (F.col("page0") == F.col("page_idx")) & own, "left")
    section = F.nullif(F.regexp_extract("title", SECTION_ID, 1), F.lit(""))
    found = F.struct(
        section.alias("section"), strip(F.regexp_replace("title", SECTION_ID, "")).alias("title"), F.col("page0").alias("pdf_page"),
        printed_page(F.col("label"), F.col("page0"), F.col("page_offset")).alias("printed_page"), "level",
    )
    return rows.select(*tree.columns, F.when(own, found).alias("own"))


def sections(outline: DataFrame, chapters: DataFrame, config: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (book, number, idx, section, title, pdf_page, printed_page, level): entries one level below the chapter.

    labels: (book, page_idx, label, page_offset).
    """
    found = _sections(subtree(outline, chapters, config), config, labels).filter("own is not null")
    return found.select("book", "number", "idx", "own.*")


def build_meta(outline: DataFrame, chapters: DataFrame, config: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per chapter: its pages, printed pages, sections and subtree, as arrays in outline order."""
    by = ["book", "number"]
    tree = _sections(subtree(outline, chapters, config), config, labels)
    listed = tree.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("idx", "level", "title", "page0"))).alias("t"), F.array_sort(F.collect_list(F.when(F.col("own").isNotNull(), F.struct("idx", "own.*")))).alias("s")
    )
    at = labels.select("book", "page_idx", printed_page(F.col("label"), F.col("page_idx"), F.col("page_offset")).alias("printed"))
    rows = chapters.filter("error is null")
    for end in ("first", "last"):
        rows = rows.join(at.select("book", F.col("page_idx").alias(end), F.col("printed").alias(f"{end}_printed")), ["book", end], "left")
    rows = rows.join(listed, by, "left")
    no_sections = F.array().cast("array<struct<number:string,title:string,pdf_page:int,printed_page:int,level:int>>")
    no_tree = F.array().cast("array<struct<level:int,title:string,page:int>>")
    return rows.select(
        "book",
        F.col("slug").alias("chapter"),
        "number",
        "title",
        F.array("first", "last").alias("pdf_pages"),
        F.array("first_printed", "last_printed").alias("printed_pages"),
        F.coalesce(F.transform("s", lambda x: F.struct(x["section"].alias("number"), x["title"].alias("title"), x["pdf_page"].alias("pdf_page"), x["printed_page"].alias("printed_page"), x["level"].alias("level"))), no_sections).alias("sections"),
        F.coalesce(F.transform("t", lambda x: F.struct(x["level"].alias("level"), x["title"].alias("title"), x["page0"].alias("page"))), no_tree).alias("toc_subtree"),
    )


def list_chapters(outline: DataFrame, config: DataFrame, readings: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Rows (book, number) in scope: a book's reading list if there is one, else its outline's chapters and overrides.

    readings: (book, chapters array<int>).
    """
    listed = readings.select("book", F.explode("chapters").alias("number")).distinct()
    found = chapter_entries(outline, config).select("book", "number")
    if overrides is not None:
        found = found.unionByName(overrides.select("book", "number"))
    return listed.unionByName(found.distinct().join(readings.select("book"), "book", "left_anti"))

