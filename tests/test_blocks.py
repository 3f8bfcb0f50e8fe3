import json

import pytest
from pyspark.errors import PySparkException

from quire.errors import ReportError
from quire.operators import blocks as B
from quire.operators import report, validate
from quire.schemas import BODY, CAPTIONED, FIGURES, MASKED, MODEL_MADE, REPORT_TYPE, RUNNING, TEXT
from quire.sources import sinks

T = lambda x: {"type": "text", "content": x}
M = lambda x: {"type": "equation_inline", "content": x}


def block(kind, content, **more):
    return {"type": kind, "bbox": [0.5, 1.5, 2.4, 3.6], "content": content, **more}


PAGES = [
    [
        block("paragraph", {"paragraph_content": [T("where "), M("C _ { 0 } = 1"), T(""), T("million.")]}),
        block("title", {"title_content": [T("6.1 Self-Test")], "level": 2}),
        block("list", {"list_items": [{"item_content": [T("a")]}, {"item_content": []}, {"item_content": [T("b "), M("x")]}]}),
        block("table", {"html": "<t/>", "image_source": {"path": "images/t.jpg"}, "table_caption": [T("Cap")], "table_footnote": [T("Note")]}),
        block("equation_interline", {"math_content": "E=mc^2"}),
    ],
    [],
    [block("image", {"content": "a flow chart", "image_caption": [T("Source: x")]}, sub_type="flowchart"), block("image", {"content": " "}), block("chart", {"content": "d", "chart_caption": []}), block("page_header", {"page_header_content": [T("Head")]})],
]


def parsed(spark, pages=PAGES):
    return B.parse(B.raw_blocks(spark.createDataFrame([("b", json.dumps(pages))], "book string, value string")))


def test_classes():
    assert not set(TEXT) & (set(MODEL_MADE) | set(FIGURES)) and set(RUNNING) < set(TEXT) and set(BODY) == set(TEXT) - set(RUNNING)
    assert set(MASKED) == set(MODEL_MADE) | {"image"} == set(REPORT_TYPE) and set(CAPTIONED) == set(FIGURES) | {"table"}


def test_parse(spark):
    rows = parsed(spark).withColumn("text", B.text()).withColumn("caption", B.caption_text()).withColumn("im", B.inline_math()).withColumn("made", B.model_made()).withColumn("shown", B.block_text())
    by = {r["id"]: r for r in rows.collect()}
    assert None in by and by[None]["page_idx"] == 1  # the blank page
    p = by["p000-b000"]
    assert p["bbox"] == [0, 2, 2, 4] and len(p["spans"]) == 3 and p["text"] == "where million." and p["im"] == ["C _ { 0 } = 1"] and p["shown"] == "where  C0=1 million."
    assert by["p000-b001"]["level"] == 2 and by["p000-b001"]["text"] == "6.1 Self-Test"
    assert by["p000-b002"]["text"] == "a\nb " and by["p000-b002"]["im"] == ["x"] and by["p000-b002"]["shown"] == "a \n b  x"
    t = by["p000-b003"]
    assert t["caption"] == "Cap\nNote" and t["crop"] == "images/t.jpg" and t["html"] == "<t/>" and t["made"] and t["shown"] == "Cap \n Note"
    assert by["p000-b004"]["math"] == "E=mc^2" and by["p000-b004"]["made"]
    assert by["p002-b000"]["made"] and by["p002-b000"]["sub_type"] == "flowchart" and by["p002-b000"]["caption"] == "Source: x" and not by["p002-b001"]["made"]
    assert B.on_page(parsed(spark), 2).count() == 4


@pytest.mark.parametrize("bad, message", [(block("code", {}), "unknown type code at page 0 block 0"), ({"type": "title", "content": {}}, "no box at page 0 block 0")])
def test_parse_is_loud(spark, bad, message):
    with pytest.raises(PySparkException, match=message):
        parsed(spark, [[bad]]).select("id").collect()


def test_tokens(spark):
    got = B.with_tokens(parsed(spark)).filter("id = 'p000-b000'").first()
    assert got["tokens"] == ["where", "C0=1", "million."]


# report


def matter(spark, rows):
    return spark.createDataFrame([("b", "ch01", f"p{p:03d}-b{i:03d}", t, p, x) for i, (p, t, x) in enumerate(rows)], "book string, chapter string, id string, type string, page_idx int, text string")


def test_suspects(spark):
    rows = [
        (0, "page_header", "Page 81"), (0, "page_header", "xiv"), (0, "page_footer", "C H A P T E R 3 Bonds"), (0, "page_number", " "), (0, "page_header", "The Time Value of Money, again"),
        (0, "page_header", "Same Head"), (1, "page_header", "same  head"), (1, "page_footer", "Partial text of the body"), (2, "page_header", "twice here"), (2, "page_header", "Twice here"), (0, "paragraph", "body"),
    ]
    titles = spark.createDataFrame([("b", "ch01", "The Time Value of Money")], "book string, chapter string, title string")
    got = {r["text"] for r in report.running_matter_suspects(matter(spark, rows), titles).collect()}
    assert got == {"Partial text of the body", "twice here", "Twice here"}


@pytest.mark.parametrize("n, size", [(0, 0), (2, 2), (50, 3), (70, 4), (310, 16), (391, 20)])
def test_sample_size(spark, n, size):
    rows = spark.range(n).selectExpr("'b' AS book", "'c' AS chapter", "concat('id', id) AS id")
    got = report.spot_sample(rows)
    assert got.count() == size and {r["id"] for r in got.collect()} == {r["id"] for r in report.spot_sample(rows.repartition(3)).collect()}


def good():
    return {
        "book": "b", "chapter": "ch05", "pages": [119, 148], "extraction": {"backend": "x", "effort": "high", "mineru_version": "3", "timestamp": "t"},
        "counts": {"blocks": 3, "tables": 0, "formulas": 0, "figures": 0, "diff_hunks": 1}, "diff_hunks": [{"page": 119, "anchor": "p000-b000", "pdf_text": "a", "md_text": ""}],
        "flagged_blocks": [{"id": "p000-b001", "type": "chart", "crop": "c", "reason": "vlm_generated"}], "spot_check": [{"id": "x", "crop": "y"}], "status": "pending_review", "more": None,
    }


def broken(change):
    r = good()
    change(r)
    return r


CASES = [
    ("$", lambda r: r.pop("status")), ("book", lambda r: r.update(book=1)), ("pages", lambda r: r.update(pages=[1])), ("pages[1]", lambda r: r.update(pages=[1, True])), ("pages[0]", lambda r: r.update(pages=[-1, 3])),
    ("pages", lambda r: r.update(pages=[9, 3])), ("extraction", lambda r: r["extraction"].pop("effort")), ("extraction.effort", lambda r: r["extraction"].update(effort=None)), ("counts.blocks", lambda r: r["counts"].update(blocks=True)),
    ("counts.tables", lambda r: r["counts"].update(tables=1.5)), ("diff_hunks[0].page", lambda r: r["diff_hunks"][0].update(page="1")), ("diff_hunks[0]", lambda r: r["diff_hunks"][0].pop("anchor")),
    ("flagged_blocks[0].type", lambda r: r["flagged_blocks"][0].update(type="photo")), ("flagged_blocks[0].reason", lambda r: r["flagged_blocks"][0].update(reason="x")), ("spot_check[0].id", lambda r: r["spot_check"][0].update(id=3)),
    ("status", lambda r: r.update(status="done")), ("counts.diff_hunks", lambda r: r["counts"].update(diff_hunks=4)), ("diff_hunks", lambda r: r.update(diff_hunks={})),
]


def test_validator(spark):
    texts = [json.dumps(good())] + [json.dumps(broken(c)) for _, c in CASES] + ["{", "[]", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, json string")
    got = {r["i"]: r["path"] for r in validate.violations(df).collect()}
    assert got == {**{i + 1: p for i, (p, _) in enumerate(CASES)}, len(CASES) + 1: "$", len(CASES) + 2: "$", len(CASES) + 3: "$"}
    validate.require_valid(df.filter("i = 0"))
    with pytest.raises(ReportError):
        validate.require_valid(df)


def test_build_and_write(spark, tmp_path):
    blocks = parsed(spark).withColumn("chapter", __import__("pyspark").sql.functions.lit("ch01")).withColumn("text", B.text())
    meta = spark.createDataFrame([("b", "ch01", "Title", [1, 3])], "book string, chapter string, title string, printed_pages array<int>")
    hunks = spark.createDataFrame([("b", "ch01", 0, 1, "p000-b000", "x", "y")], "book string, chapter string, seq int, page int, anchor string, pdf_text string, md_text string")
    run = spark.createDataFrame([("b", "ch01", "hybrid-http-client", "high", "3", 0)], "book string, chapter string, backend string, effort string, version string, t long").selectExpr("*", "timestamp_seconds(t) AS modified").drop("t")
    got = report.build(meta, blocks, hunks, run)
    r = got.first()
    assert r["counts"].asDict() == {"blocks": 9, "tables": 1, "formulas": 1, "figures": 3, "diff_hunks": 1} and r["extraction"]["timestamp"] == "1970-01-01T00:00:00+00:00"
    assert [f["id"] for f in r["flagged_blocks"]] == ["p000-b003", "p000-b004", "p002-b000", "p002-b002", "p002-b003"] and len(r["spot_check"]) == 3
    assert [f["crop"] for f in r["flagged_blocks"]][:2] == ["images/t.jpg", "crops/p000-b004.png"]
    path = f"file://{tmp_path}/reports"
    sinks.write_reports(got, path)
    assert spark.read.json(path).count() == 1
    with pytest.raises(ReportError):
        sinks.write_reports(got.withColumn("status", __import__("pyspark").sql.functions.lit("x")), path + "2")
