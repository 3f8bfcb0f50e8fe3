"""Sources: tables, page JSON, configuration; PDF files only where a PDF library is installed."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.errors import ConfigError
from quire.operators import blocks as B
from quire.schemas import OUTLINE, WORDS

CONFIG = (
    "book string, title string, edition string, course string, profile string, pdf string, body_range struct<begin:int,end:int>, "
    "chapter_level int, chapter_pattern string, page_offset int, patches string, chapter_ranges map<string,array<int>>, routing map<string,string>"
)
MIDDLE = "struct<pdf_info:array<struct<page_size:array<double>>>,_effort:string,_version_name:string>"


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def outline(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OUTLINE).parquet(path)


def words(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(WORDS).parquet(path)


def page_json(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of page files (book=.../chapter=.../<stem>_content_list_v2.json); pages without blocks are kept."""
    files = spark.read.text(path, wholetext=True)
    keyed = files.select(
        F.regexp_extract(F.input_file_name(), r"book=([^/]+)", 1).alias("book"), F.regexp_extract(F.input_file_name(), r"chapter=([^/]+)", 1).alias("chapter"), "value"
    )
    return B.parse(B.raw_blocks(keyed))


def page_lines(spark: SparkSession, path: str) -> DataFrame:
    """page_json() of many chapters: files below book=, a JSON line (chapter, value) for each page file, as write_documents() writes them.

    A folder and a file for each chapter are made, committed and listed one by one, so they do for a book's chapters, not for 100,000s.
    """
    return B.parse(B.raw_blocks(spark.read.schema("chapter string, value string, book string").json(path).select("book", "chapter", "value")))


def middle_json(spark: SparkSession, path: str) -> DataFrame:
    """Rows (path, pages, sizes, effort, version) of the layout model's own files; other fields are not read."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.from_json("value", MIDDLE).alias("m"))
    return files.select("path", F.coalesce(F.size("m.pdf_info"), F.lit(0)).alias("pages"), F.transform("m.pdf_info", lambda p: p["page_size"]).alias("sizes"), F.col("m._effort").alias("effort"), F.col("m._version_name").alias("version"))


def content_list(spark: SparkSession, path: str) -> DataFrame:
    """Rows (path, page_idx) of the flat block list, of which nothing else is read."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.explode(F.from_json("value", "array<struct<page_idx:int>>")).alias("b"))
    return files.select("path", "b.page_idx")


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """Rows (path, sha256, modified) of files."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"), F.col("modificationTime").alias("modified"))


def books(spark: SparkSession, path: str) -> DataFrame:
    """The books' configuration (YAML) as a small table."""
    import json

    import yaml

    with open(path, encoding="utf-8") as f:
        given = (yaml.safe_load(f) or {}).get("books")
    if not isinstance(given, dict):
        raise ConfigError(f"{path}: no books")
    rows = []
    for book, c in given.items():
        toc = c.get("toc") or {}
        body = c.get("body_range")
        ranges = {str(k): list(v) for k, v in (c.get("chapter_ranges") or {}).items()}
        routing = {str(k): str(v) for k, v in (c.get("routing") or {}).items()}
        rows.append((
            book, c.get("title"), str(c["edition"]) if c.get("edition") is not None else None, c.get("course"), c.get("profile"), c.get("pdf"),
            (body["begin"], body["end"]) if body else None, toc.get("chapter_level"), toc.get("chapter_pattern"), toc.get("page_offset"),
            json.dumps(toc.get("patches") or []), ranges, routing,
        ))
    return spark.createDataFrame(rows, CONFIG)


def book_config(config: DataFrame, book: str) -> dict:
    found = config.filter(F.col("book") == book).limit(1).collect()
    if not found:
        known = sorted(r["book"] for r in config.select("book").collect())
        raise ConfigError(f"unknown book {book!r}; known: {', '.join(known)}")
    return found[0].asDict(recursive=True)


def readings(spark: SparkSession, course: str, directory: str) -> DataFrame:
    """Rows (book, chapters) of a course's reading list; none if it has no file, which means all."""
    import yaml

    path = os.path.join(directory, f"{course}.yaml")
    given = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            given = yaml.safe_load(f) or {}
    return spark.createDataFrame([(b, [int(n) for n in c or []]) for b, c in given.items()], "book string, chapters array<int>")


def overrides(config: DataFrame) -> DataFrame:
    """Rows (book, number, first, last) of configured chapter ranges."""
    from quire.operators.outline import chapter_number

    rows = config.select("book", F.explode("chapter_ranges").alias("chapter", "r"))
    return rows.select("book", chapter_number(F.col("chapter")).alias("number"), F.col("r")[0].alias("first"), F.col("r")[1].alias("last"))


# paths


def page_file(directory: str, stem: str) -> str:
    return f"{directory}/{stem}_content_list_v2.json"


def extraction_dir(out: str, stem: str) -> str:
    return f"{out}/{stem}/hybrid_auto"


def work_dir(root: str, book: str, chapter: str) -> str:
    return f"{root}/book={book}/chapter={chapter}"


def model_config_path() -> str:
    """The layout model's settings: an absolute path from the environment, or a name in the home folder."""
    return os.path.join(os.path.expanduser("~"), os.environ.get("MINERU_TOOLS_CONFIG_JSON", "mineru.json"))


# PDF files, where PyMuPDF is installed


def _pymupdf():
    try:
        import pymupdf
    except ImportError as error:
        raise ConfigError("reading PDF files needs PyMuPDF; give tables instead") from error
    return pymupdf


def pdf_outline(spark: SparkSession, path: str) -> DataFrame:
    """The outlines of PDF files as OUTLINE rows, book being the file's name."""
    _pymupdf()

    def run(batches):
        import pandas as pd
        import pymupdf

        for pdf in batches:
            rows = []
            for p, content in zip(pdf["path"], pdf["content"], strict=True):
                toc = pymupdf.open(stream=content, filetype="pdf").get_toc()
                rows += [(os.path.basename(p).removesuffix(".pdf"), i, *e[:3]) for i, e in enumerate(toc)]
            yield pd.DataFrame(rows, columns=["book", "idx", "level", "title", "page"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, OUTLINE)


PAGES = (
    "book string, page_idx int, label string, width double, height double, text string, words array<struct<ord:int,x0:double,y0:double,x1:double,y1:double,word:string,block_no:int,line_no:int>>"
)


def pdf_pages(spark: SparkSession, path: str) -> DataFrame:
    """The pages of PDF files: label, size, text and words."""
    _pymupdf()

    def run(batches):
        import pandas as pd
        import pymupdf

        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"], strict=True):
                book = os.path.basename(p).removesuffix(".pdf")
                for page in pymupdf.open(stream=content, filetype="pdf"):
                    boxes = [(i, *w[:7]) for i, w in enumerate(page.get_text("words"))]
                    row = (book, page.number, page.get_label(), page.rect.width, page.rect.height, page.get_text(), boxes)
                    yield pd.DataFrame([row], columns=["book", "page_idx", "label", "width", "height", "text", "words"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, PAGES)
