import json

import pytest

from quire.errors import ConfigError, ExtractError, PatchError
from quire.operators import external
from quire.sources import readers, sinks

BOOKS = """
books:
 bma:
  title: A book
  edition: 13
  pdf: bma.pdf
  body_range: {begin: 3, end: 90}
  toc: {source: outline, chapter_level: 2, chapter_pattern: '^(\\d+): ', page_offset: 4, patches: [{rule: rename, level: 1, match: a, replace: b}]}
  chapter_ranges: {ch02: [5, 9]}
  routing: {table: true}
 bkm:
  title: Another
"""


def test_books(spark, tmp_path):
    (tmp_path / "books.yaml").write_text(BOOKS)
    df = readers.books(spark, str(tmp_path / "books.yaml"))
    c = readers.book_config(df, "bma")
    assert c["chapter_level"] == 2 and c["body_range"]["end"] == 90 and json.loads(c["patches"])[0]["rule"] == "rename"
    assert [tuple(r) for r in readers.overrides(df).collect()] == [("bma", 2, 5, 9)]
    with pytest.raises(ConfigError, match="bkm, bma"):
        readers.book_config(df, "x")
    (tmp_path / "bare.yaml").write_text("bma: {title: A book}")
    with pytest.raises(ConfigError, match="no books"):
        readers.books(spark, str(tmp_path / "bare.yaml"))
    (tmp_path / "mitx.yaml").write_text("bma: [6, 5]\nbkm:\n")
    assert [tuple(r) for r in readers.readings(spark, "mitx", str(tmp_path)).collect()] == [("bma", [6, 5]), ("bkm", [])]
    assert readers.readings(spark, "none", str(tmp_path)).count() == 0


def test_page_files(spark, tmp_path):
    own = tmp_path / "book=bma" / "chapter=ch01"
    own.mkdir(parents=True)
    page = [[{"type": "title", "bbox": [1, 2, 3, 4], "content": {"title_content": [{"type": "text", "content": "é"}], "level": 1}}], []]
    (own / "s_content_list_v2.json").write_text(json.dumps(page))
    (own / "s_middle.json").write_text(json.dumps({"pdf_info": [{"page_size": [10.5, 20], "x": 1}] * 2, "_effort": "high", "_version_name": "3"}))
    (own / "s_content_list.json").write_text(json.dumps([{"page_idx": 0, "type": "text"}, {"page_idx": 1}]))
    got = readers.page_json(spark, f"{tmp_path}/*/*/*_content_list_v2.json").orderBy("page_idx").collect()
    assert [(r["book"], r["chapter"], r["id"], r["page_idx"]) for r in got] == [("bma", "ch01", "p000-b000", 0), ("bma", "ch01", None, 1)]
    m = readers.middle_json(spark, str(own / "s_middle.json")).first()
    assert m["pages"] == 2 and m["sizes"][0] == [10.5, 20.0] and m["effort"] == "high"
    assert readers.content_list(spark, str(own / "s_content_list.json")).count() == 2
    d = readers.file_digests(spark, str(own / "s_middle.json")).first()
    assert len(d["sha256"]) == 64 and d["modified"] is not None


def test_paths(monkeypatch):
    assert readers.page_file("d", "s") == "d/s_content_list_v2.json" and readers.work_dir("w", "b", "ch01") == "w/book=b/chapter=ch01"
    assert readers.extraction_dir("o", "s") == "o/s/hybrid_auto"
    monkeypatch.setenv("MINERU_TOOLS_CONFIG_JSON", "/etc/m.json")
    assert readers.model_config_path() == "/etc/m.json"


def test_pdf_needs_a_library(spark):
    try:
        import pymupdf  # noqa: F401
    except ImportError:
        with pytest.raises(ConfigError):
            readers.pdf_outline(spark, "x.pdf")


def test_chapter_pages(spark):
    pages = spark.createDataFrame([("b", i) for i in range(6)], "book string, page_idx int")
    chapters = spark.createDataFrame([("b", "ch02", 2, 3, None), ("b", "ch09", 0, 1, "bad")], "book string, slug string, first int, last int, error string")
    assert sorted(tuple(r) for r in sinks.chapter_pages(pages, chapters).select("chapter", "page_idx").collect()) == [("ch02", 0), ("ch02", 1)]


def test_patches_stack_only_by_force(spark, tmp_path):
    path = str(tmp_path / "outline")
    outline = spark.createDataFrame([("b", 0, 1, "a one", 1), ("b", 1, 1, "a two", 5)], "book string, idx int, level int, title string, page int")
    rename = lambda match, replace: [{"rule": "rename", "level": 1, "match": match, "replace": replace}]
    titles = lambda v: [r["title"] for r in sinks.outline_version(outline, path, v).orderBy("idx").collect()]
    assert sinks.apply_patches(outline, rename("a", "a"), path).count() == 0 and sinks.versions(spark, path) == []
    assert sinks.apply_patches(outline, rename("a", "b"), path).count() == 2 and titles(1) == ["b one", "b two"]
    with pytest.raises(PatchError, match="already"):
        sinks.apply_patches(outline, rename("b", "c"), path)
    assert sinks.apply_patches(outline, rename("b", "c"), path, force=True).count() == 2
    assert titles(0) == ["a one", "a two"] and titles(2) == ["c one", "c two"]


def test_external(tmp_path):
    got = external.command("a.pdf", "out", "http://x", {"table": True, "inline_formula": False, "lang": "en", "other": 1})
    assert got[-6:] == ["-f", "false", "-t", "true", "-l", "en"] and got[:2] == ["mineru", "-p"]
    assert external.environment({"A": "1"})["A"] == "1"
    settings = tmp_path / "m.json"
    for text, message in ((None, "lacks models"), ("{}", "lacks models"), (json.dumps({"models-dir": {"pipeline": str(tmp_path)}}), None)):
        if text is not None:
            settings.write_text(text)
        if message:
            with pytest.raises(ExtractError, match=message):
                external.preflight("http://x/", str(settings), lambda u: u == "http://x/health")
        else:
            external.preflight("http://x/", str(settings), lambda u: True)
    for url, probe in ((None, True), ("http://x", False)):
        with pytest.raises(ExtractError):
            external.preflight(url, str(settings), lambda u, p=probe: p)
    ran = []
    assert not external.extract(lambda: True, lambda: ran.append(1), lambda: None)
    assert external.extract(lambda: True, lambda: ran.append(1), lambda: None, force=True) and ran == [1]
    with pytest.raises(ExtractError):
        external.extract(lambda: False, ["false"], lambda: None)
    assert not external.http_ok("nonsense")


def test_chapters_share_files(spark, tmp_path):
    path = f"file://{tmp_path}/documents"
    rows = spark.range(500).selectExpr("concat('b', id % 2) AS book", "concat('0', id) AS chapter", "id AS n", "CASE WHEN id % 3 = 0 THEN 'x\\ny' END AS note", "array(id) AS pages")
    sinks.write_documents(rows.repartition(4), path)
    assert 2 <= sum(1 for _ in (tmp_path / "documents").rglob("part-*.json")) <= 8
    key = lambda r: r["n"]
    assert sorted(sinks.read_documents(spark, path, rows.schema).collect(), key=key) == sorted(rows.collect(), key=key)
