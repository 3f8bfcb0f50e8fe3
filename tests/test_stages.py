import json

import pytest

from quire.__main__ import main

CONFIG = r"""books:
  b: {title: Book, course: c, toc: {chapter_level: 1, chapter_pattern: '^Chapter (\d+) *', page_offset: 2, patches: [{rule: rename, level: 1, match: '^Chapter', replace: 'CHAPTER'}]}}
"""


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Two chapters of two pages; the second one's blocks lack a word that its text layer has."""
    at = tmp_path_factory.mktemp("books")
    (at / "books.yaml").write_text(CONFIG)
    outline = [("b", 0, 1, "Chapter 1 One", 1), ("b", 1, 1, "Chapter 2 Two", 3), ("b", 2, 2, "2-1 First", 4)]
    spark.createDataFrame(outline, "book string, idx int, level int, title string, page int").write.parquet(f"{at}/outline")
    texts = ["one page", "second page", "this text stands here", "and some more of it"]
    pages = [("b", i, str(i + 7) if i % 2 else "", 600.0, 800.0, t) for i, t in enumerate(texts)]
    spark.createDataFrame(pages, "book string, page_idx int, label string, width double, height double, text string").write.parquet(f"{at}/pages")
    words = [("b", i, k, 50.0 * k, 100.0, 50.0 * k + 40, 110.0, w, 0, 0) for i, t in enumerate(texts) for k, w in enumerate(t.split())]
    spark.createDataFrame(words, "book string, page_idx int, ord int, x0 double, y0 double, x1 double, y1 double, word string, block_no int, line_no int").write.parquet(f"{at}/words")
    out = at / "work" / "book=b" / "chapter=ch02" / "mineru" / "chapter" / "hybrid_auto"
    out.mkdir(parents=True)
    para = lambda t: {"type": "paragraph", "bbox": [0, 0, 900, 300], "content": {"paragraph_content": [{"type": "text", "content": t}]}}
    head = {"type": "page_header", "bbox": [0, 900, 9, 910], "content": {"page_header_content": [{"type": "text", "content": "stray line"}]}}
    (out / "chapter_content_list_v2.json").write_text(json.dumps([[para("this text stands")], [para("and some more of it"), head]]))
    (out / "chapter_middle.json").write_text(json.dumps({"pdf_info": [{"page_size": [600, 800]}] * 2, "_effort": "high", "_version_name": "3"}))
    return at


def run(folder, *args):
    return main([x.replace("@", str(folder)) for x in args])


TABLES = ["--config", "@/books.yaml", "--outline", "@/outline", "--pages", "@/pages"]
CHAPTER = ["--book", "b", "--chapter", "2", "--work", "@/work"]


def test_stages_of_a_chapter(folder, capsys, spark):
    assert run(folder, "guardrail", *CHAPTER) == 1 and "missing" in capsys.readouterr().err
    assert run(folder, "split", *TABLES, "--words", "@/words", *CHAPTER) == 0
    assert "pages [2, 3], printed [1, 10], 1 sections, Two" in capsys.readouterr().out
    assert run(folder, "guardrail", *CHAPTER) == 0
    out = capsys.readouterr().out
    assert '"pdf_tokens": 9, "md_tokens": 10, "matched_blocks": 2, "unmatched_blocks": 1' in out and "1:1, 2:1" in out and "layer:  here" in out
    assert run(folder, "report", *CHAPTER) == 0
    assert '"diff_hunks": 2' in capsys.readouterr().out
    report = spark.read.json(f"{folder}/work/book=b/chapter=ch02/report").first()
    assert report["status"] == "pending_review" and [f["reason"] for f in report["flagged_blocks"]] == ["running_matter_suspect"]
    assert run(folder, "split", *TABLES, "--book", "b", "--chapter", "9", "--work", "@/work") == 1
    assert run(folder, "split", *TABLES, "--book", "x", "--chapter", "2", "--work", "@/work") == 1
    assert run(folder, "split", *TABLES, "--book", "b", "--chapter", "two", "--work", "@/work") == 1


def test_books_commands(folder, capsys):
    assert run(folder, "probe", *TABLES, "--book", "b") == 0
    assert '"entries": 2' in capsys.readouterr().out
    assert run(folder, "probe", *TABLES, "--book", "b", "--check") == 0
    assert "2 chapters, 0 failures" in capsys.readouterr().out
    assert run(folder, "intake", *TABLES, "--out", "@/manifest") == 0
    assert "OK b: 4 pages, text 4/4, 3 entries" in capsys.readouterr().out
    own = ["--config", "@/books.yaml", "--outline", "@/outline", "--book", "b", "--versions", "@/versions"]
    assert run(folder, "patch", *own) == 0 and "dry run: 2 changes (renamed: 2)" in capsys.readouterr().out
    assert run(folder, "patch", *own, "--apply") == 0 and "applied: 2 changes" in capsys.readouterr().out
    assert run(folder, "patch", *own, "--apply") == 1
    assert run(folder, "extract", "--config", "@/books.yaml", "--url", "http://127.0.0.1:9", *CHAPTER) == 1
