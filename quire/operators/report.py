"""Flags, review samples and the report of a chapter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions.text import fold
from quire.operators import blocks as B
from quire.schemas import BODY, FIGURES, REPORT_TYPE, RUNNING

#: What a running line may look like, folded.
FOLIO = r"^(page\s+)?[0-9]+$|^[ivxlc]+$"
HEAD = r"^(chapter|part)(?U:\b)"
#: Share of the candidates to review, and the least number.
SHARE, LEAST = 0.05, 3
CHAPTER = ("book", "chapter")


def is_running_matter(folded: Column, repeated: Column, title_folded: Column) -> Column:
    """Blank, a folio, a chapter or part head, repeated on other pages, or holding the chapter's title."""
    titled = (title_folded != "") & F.contains(folded, title_folded)
    return (folded == "") | folded.rlike(FOLIO) | folded.rlike(HEAD) | repeated | F.coalesce(titled, F.lit(False))


def running_matter_suspects(blocks: DataFrame, titles: DataFrame, exact: bool = True) -> DataFrame:
    """Blocks typed as running matter that do not look like it.

    blocks: (book, chapter, id, type, page_idx, text); titles: (book, chapter, title).
    """
    matter = blocks.filter(F.col("type").isin(*RUNNING)).withColumn("folded", fold(F.col("text"), exact))
    # on two pages or more: the first and the last page differ
    pages = matter.groupBy(*CHAPTER, "folded").agg((F.min("page_idx") != F.max("page_idx")).alias("repeated"))
    named = titles.select(*CHAPTER, fold(F.coalesce("title", F.lit("")), exact).alias("title_folded"))
    rows = matter.join(pages, [*CHAPTER, "folded"]).join(named, list(CHAPTER), "left")
    calm = is_running_matter(F.col("folded"), F.coalesce("repeated", F.lit(False)), F.coalesce("title_folded", F.lit("")))
    return rows.filter(~calm).select(*blocks.columns)


def spot_sample(candidates: DataFrame) -> DataFrame:
    """A seeded sample of each chapter's candidates (book, chapter, id, ...): the first n by a keyed hash.

    n is the share rounded half to even, at least LEAST, at most all.
    """
    own = W.partitionBy(*CHAPTER)
    key = F.sha2(F.concat("book", "chapter", "id"), 256)
    rows = candidates.withColumn("n_", F.count(F.lit(1)).over(own)).withColumn("k_", F.row_number().over(own.orderBy(key, "id")))
    return rows.filter(F.col("k_") <= F.least("n_", F.greatest(F.lit(LEAST), F.bround(F.col("n_") * SHARE).cast("long")))).drop("n_", "k_")


def crop_path(crop: str = "crop") -> Column:
    """The model's crop, or where one is to be rendered."""
    return F.coalesce(F.nullif(F.col(crop), F.lit("")), F.concat(F.lit("crops/"), F.col("id"), F.lit(".png")))


def model_flags(blocks: DataFrame) -> DataFrame:
    """Rows (book, chapter, id, type, crop, reason) of blocks whose content a model wrote."""
    names = F.create_map(*(F.lit(x) for kv in REPORT_TYPE.items() for x in kv))
    return blocks.filter(B.model_made()).select(*CHAPTER, "id", names[F.col("type")].alias("type"), crop_path().alias("crop"), F.lit("vlm_generated").alias("reason"))


def flags(blocks: DataFrame, titles: DataFrame, exact: bool = True) -> DataFrame:
    """All flagged blocks of both kinds; blocks also have a text column."""
    suspects = running_matter_suspects(blocks, titles, exact)
    rendered = F.concat(F.lit("crops/"), F.col("id"), F.lit(".png"))
    return model_flags(blocks).unionByName(
        suspects.select(*CHAPTER, "id", F.lit("text").alias("type"), rendered.alias("crop"), F.lit("running_matter_suspect").alias("reason"))
    )


def candidates(blocks: DataFrame) -> DataFrame:
    return blocks.filter(F.col("type").isin(*BODY))


def counts(blocks: DataFrame) -> DataFrame:
    """Rows (book, chapter, blocks, tables, formulas, figures)."""
    of = lambda *t: F.count_if(F.col("type").isin(*t))
    return blocks.filter("type is not null").groupBy(*CHAPTER).agg(
        F.count(F.lit(1)).alias("blocks"), of("table").alias("tables"), of("equation_interline").alias("formulas"), of(*FIGURES).alias("figures")
    )


def build(meta: DataFrame, blocks: DataFrame, hunks: DataFrame, extraction: DataFrame, exact: bool = True) -> DataFrame:
    """One report per chapter.

    meta: (book, chapter, title, printed_pages); blocks: parsed blocks with text;
    hunks: (book, chapter, seq, page, anchor, pdf_text, md_text); extraction:
    (book, chapter, backend, effort, version, modified timestamp).
    """
    by = list(CHAPTER)
    flagged = flags(blocks, meta, exact).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("id", "type", "crop", "reason"))).alias("flagged_blocks"))
    sample = spot_sample(candidates(blocks)).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("page_idx", "index", "id"))).alias("s"))
    listed = hunks.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("seq", "page", "anchor", "pdf_text", "md_text"))).alias("h"))
    # in UTC whatever the session's time zone is
    utc = F.to_utc_timestamp("modified", F.current_timezone())
    stamp = F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    ex = extraction.select(*by, F.struct("backend", F.coalesce("effort", F.lit("")).alias("effort"), F.coalesce("version", F.lit("")).alias("mineru_version"), stamp.alias("timestamp")).alias("extraction"))
    rows = meta.select(*by, F.col("printed_pages").alias("pages"))
    for part in (ex, counts(blocks), listed, flagged, sample):
        rows = rows.join(part, by, "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    hunk = "array<struct<page:int,anchor:string,pdf_text:string,md_text:string>>"
    flag = "array<struct<id:string,type:string,crop:string,reason:string>>"
    spot = "array<struct<id:string,crop:string>>"
    found = F.transform("h", lambda x: F.struct(x["page"].alias("page"), x["anchor"].alias("anchor"), x["pdf_text"].alias("pdf_text"), x["md_text"].alias("md_text")))
    return rows.select(
        *by,
        "pages",
        "extraction",
        F.struct(*(zero(c) for c in ("blocks", "tables", "formulas", "figures")), F.coalesce(F.size("h"), F.lit(0)).cast("long").alias("diff_hunks")).alias("counts"),
        F.coalesce(found.cast(hunk), F.array().cast(hunk)).alias("diff_hunks"),
        F.coalesce(F.col("flagged_blocks").cast(flag), F.array().cast(flag)).alias("flagged_blocks"),
        F.coalesce(F.transform("s", lambda x: F.struct(x["id"].alias("id"), F.concat(F.lit("crops/"), x["id"], F.lit(".png")).alias("crop"))).cast(spot), F.array().cast(spot)).alias("spot_check"),
        F.lit("pending_review").alias("status"),
    )
