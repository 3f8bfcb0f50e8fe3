"""The stages of one chapter over folders: split, compare, report. Extraction between them is the layout model's."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.errors import AlignError, ReportError
from quire.operators import align as A
from quire.operators import blocks as B
from quire.operators import checks, outline, report, validate
from quire.sources import readers, sinks

STEM = "chapter"
PAGE = "book string, page_idx int, label string, width double, height double"


class Books:
    """Configuration and tables of all books: outline (OUTLINE), pages (PAGE, and text for probes), words (WORDS)."""

    def __init__(self, spark: SparkSession, config: str, outline_path: str, pages: str, words: str | None = None) -> None:
        self.spark, self.config = spark, readers.books(spark, config)
        self.outline, self.pages = readers.outline(spark, outline_path), spark.read.parquet(pages)
        self.words = readers.words(spark, words) if words else None
        self.overrides = readers.overrides(self.config)
        self.counts = self.pages.groupBy("book").agg(F.count(F.lit(1)).cast("int").alias("page_count"))
        self.labels = self.pages.join(self.config.select("book", "page_offset"), "book").select("book", "page_idx", "label", "page_offset")

    def readings(self, course: str | None, directory: str | None) -> DataFrame:
        return readers.readings(self.spark, course or "", directory or "")


def _write(rows: DataFrame, path: str) -> None:
    rows.coalesce(1).write.mode("overwrite").json(path)  # one document


def split(books: Books, book: str, number: int, root: str) -> dict:
    """Resolve a chapter; write its meta document, and its pages and words numbered from 0, below the work folder."""
    readers.book_config(books.config, book)
    found = outline.chapter(books.outline, books.config, books.counts, book, number, books.overrides)
    own = books.outline.filter(F.col("book") == book)
    chapters = outline.resolve_chapters(own, books.config, books.counts, books.overrides).filter((F.col("book") == book) & (F.col("number") == number))
    work = readers.work_dir(root, book, found["slug"])
    meta = outline.build_meta(own, chapters, books.config, books.labels.filter(F.col("book") == book))
    _write(meta, f"{work}/meta")
    for name, table in (("pages", books.pages), ("words", books.words)):
        if table is not None:
            sinks.chapter_pages(table.filter(F.col("book") == book), chapters).write.mode("overwrite").parquet(f"{work}/{name}")
    return books.spark.read.schema(meta.schema).json(f"{work}/meta").first().asDict(recursive=True)


def _documents(spark: SparkSession, work: str, name: str, error: type[Exception]) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{work}/{name}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        raise error(f"{work}/{name} is missing; run the stage before this one")
    return spark.read.json(f"{work}/{name}")


def _blocks(spark: SparkSession, work: str, book: str, slug: str) -> DataFrame:
    """The chapter's blocks, with text, tokens and whether they hold inline math; a page without blocks is a row with a null id."""
    extraction = readers.extraction_dir(f"{work}/mineru", STEM)
    files = spark.read.text(readers.page_file(extraction, STEM), wholetext=True).select(F.lit(book).alias("book"), F.lit(slug).alias("chapter"), "value")
    blocks = B.parse(B.raw_blocks(files))
    return B.with_tokens(blocks).withColumn("math", F.size(B.inline_math()) > 0).withColumn("text", B.text())


def compare(spark: SparkSession, book: str, slug: str, root: str) -> dict:
    """Compare the text layer with the blocks and write the result."""
    work = readers.work_dir(root, book, slug)
    meta = _documents(spark, work, "meta", AlignError)
    pages = spark.read.parquet(f"{work}/pages").select("book", "page_idx", "width", "height")
    blocks = _blocks(spark, work, book, slug)
    words = spark.read.parquet(f"{work}/words")
    text = A.page_text(A.unmasked(words, A.masks(blocks.filter("id is not null"), pages)))
    layer = pages.select("book", "page_idx").join(text, ["book", "page_idx"], "left").withColumn("text", F.coalesce("text", F.lit("")))
    tokens = layer.select("book", "page_idx", A.page_tokens(F.col("text")).alias("tokens"))
    # a page without blocks keeps its row, with a null index
    sides = A.pages_of(tokens, blocks.select("book", "page_idx", "index", "id", "tokens", "math"))
    middle = readers.middle_json(spark, f"{readers.extraction_dir(f'{work}/mineru', STEM)}/{STEM}_middle.json")
    model = middle.select(F.posexplode("sizes").alias("page_idx", "size")).select("page_idx", F.col("size")[0].alias("model_width"), F.col("size")[1].alias("model_height"))
    first = meta.select("book", F.col("printed_pages")[0].cast("int").alias("first"))
    found = A.result(A.aligned(sides), first, pages.join(model, "page_idx")).withColumn("chapter", F.lit(slug))
    _write(found, f"{work}/guardrail")
    return spark.read.schema(found.schema).json(f"{work}/guardrail").first().asDict(recursive=True)


def review(spark: SparkSession, book: str, slug: str, root: str) -> dict:
    """Build the report of a chapter, validate it and write it."""
    work = readers.work_dir(root, book, slug)
    meta = _documents(spark, work, "meta", ReportError).select("book", "chapter", "title", F.col("printed_pages").cast("array<int>").alias("printed_pages"))
    listed = _documents(spark, work, "guardrail", ReportError)
    kind = "array<struct<page:int,anchor:string,pdf_text:string,md_text:string>>"
    hunks = spark.read.schema(f"book string, chapter string, hunks {kind}").json(f"{work}/guardrail").select("book", "chapter", F.posexplode("hunks").alias("seq", "h")).select("book", "chapter", "seq", "h.*")
    extraction = readers.extraction_dir(f"{work}/mineru", STEM)
    middle = readers.middle_json(spark, f"{extraction}/{STEM}_middle.json").select("effort", "version")
    modified = readers.file_digests(spark, readers.page_file(extraction, STEM)).select("modified")
    run = listed.select("book", "chapter").crossJoin(middle).crossJoin(modified)  # one row each
    run = run.select("book", "chapter", F.lit("hybrid-http-client").alias("backend"), "effort", "version", "modified")
    built = report.build(meta, _blocks(spark, work, book, slug), hunks, run)
    validate.require_valid(built.select(F.to_json(F.struct(*built.columns), {"ignoreNullFields": "false"}).alias("json")))
    _write(built, f"{work}/report")
    return spark.read.schema(built.schema).json(f"{work}/report").first().asDict(recursive=True)


def intake(books: Books, out: str) -> list[dict]:
    """Write the manifest of all books; its rows."""
    known = books.config.select("book", F.col("body_range.begin").alias("b"), F.col("body_range.end").alias("e"), (F.size("chapter_ranges") > 0).alias("has_ranges"))
    rows = known.join(books.counts, "book", "left")
    rows = rows.select("book", F.coalesce("b", F.lit(0)).alias("begin"), F.coalesce("e", "page_count", F.lit(0)).alias("end"), "has_ranges")
    manifest = checks.intake(rows, books.pages.select("book", "page_idx", "text"), books.outline)
    sinks.write_documents(manifest, out)
    return [r.asDict(recursive=True) for r in sinks.read_documents(books.spark, out, manifest.schema).orderBy("book").collect()]
