import random
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quire.errors import PatchError, SplitError
from quire.operators import checks, order, patches
from quire.operators import outline as O
from quire.plans.adapters import relation
from quire.sources import sinks

BOOK = [(1, "Part One", 1), (2, "1: First", 1), (3, "1-1: A", 1), (2, "2: Second", 3), (3, " 2-1 : B", 3), (4, "Deep", 4), (3, "Key Takeaways", 4), (1, "Part Two", 5), (2, "3: Third", 5)]
CONFIG = [("b", 2, r"^(\d+):\s*"), ("none", None, None)]


def frame(spark, rows, book="b"):
    return spark.createDataFrame([(book, i, *r) for i, r in enumerate(rows)], "book string, idx int, level int, title string, page int")


def config(spark):
    return spark.createDataFrame(CONFIG, "book string, chapter_level int, chapter_pattern string")


def pages(spark, n=6):
    return spark.createDataFrame([("b", n)], "book string, page_count int")


def titles(df):
    return [(r["level"], r["title"], r["page"]) for r in df.orderBy("idx").collect()]


def test_slugs(spark):
    df = spark.createDataFrame([("5",), ("ch5",), ("ch05",), ("012",)], "x string")
    assert [tuple(r) for r in df.select(O.chapter_number(F.col("x")), O.chapter_slug(F.col("x"))).collect()] == [(5, "ch05")] * 3 + [(12, "ch12")]
    with pytest.raises(PySparkException, match="not a chapter"):
        spark.createDataFrame([("five",)], "x string").select(O.chapter_slug(F.col("x"))).collect()


def test_entries_and_levels(spark):
    got = O.chapter_entries(frame(spark, BOOK), config(spark)).orderBy("idx").collect()
    assert [tuple(r) for r in got] == [("b", 1, 1, "First"), ("b", 3, 2, "Second"), ("b", 8, 3, "Third")]
    assert O.chapter_entries(frame(spark, BOOK, "none"), config(spark)).count() == 0
    inner = spark.createDataFrame([("b", 2, r"chapter (\d+)\W*")], "book string, chapter_level int, chapter_pattern string")
    got = O.chapter_entries(frame(spark, [(2, "The chapter 4: or chapter 5: x", 1)]), inner).first()
    assert (got["number"], got["title"]) == (4, "The or chapter 5: x")
    stats = {r["level"]: (r["entries"], r["numbered"]) for r in O.level_stats(frame(spark, BOOK)).collect()}
    assert stats == {1: (2, 0), 2: (3, 3), 3: (3, 2), 4: (1, 0)}


def test_children_on_random_outlines(spark):
    random.seed(3)
    rows, want = [], set()
    for b in range(40):
        levels = [random.randrange(1, 5) for _ in range(25)]
        rows += [(str(b), i, v, "t", 1) for i, v in enumerate(levels)]
        for i, v in enumerate(levels):
            for j in range(i + 1, len(levels)):
                if levels[j] <= v:
                    break
                if levels[j] == v + 1:
                    want.add((str(b), i, j))
    df = spark.createDataFrame(rows, "book string, idx int, level int, title string, page int")
    assert {tuple(r) for r in O.children(df).collect()} == want


def test_ranges(spark):
    got = O.resolve_chapters(frame(spark, BOOK), config(spark), pages(spark)).orderBy("number").collect()
    assert [(r["slug"], r["title"], r["first"], r["last"], r["toc_index"], r["error"]) for r in got] == [
        ("ch01", "First", 0, 1, 1, None), ("ch02", "Second", 2, 3, 3, None), ("ch03", "Third", 4, 5, 8, None),
    ]
    over = spark.createDataFrame([("b", 2, 1, 9), ("b", 9, 0, 1)], "book string, number int, first int, last int")
    got = {r["number"]: (r["title"], r["first"], r["last"], r["toc_index"]) for r in O.resolve_chapters(frame(spark, BOOK), config(spark), pages(spark), over).collect()}
    assert got[2] == ("Second", 1, 9, 3) and got[9] == ("Chapter 9", 0, 1, None) and got[1] == ("First", 0, 1, 1)
    assert O.chapter(frame(spark, BOOK), config(spark), pages(spark), "b", 2)["last"] == 3


@pytest.mark.parametrize(
    "rows, n, book, message",
    [([*BOOK, (2, "2: Again", 6)], 6, "b", "2 entries"), (BOOK, 6, "none", "not configured"), (BOOK[:3], 6, "b", "no outline entry"), ([], 6, "b", "empty"), ([(2, "2: X", 9)], 6, "b", "outside")],
)
def test_range_errors(spark, rows, n, book, message):
    with pytest.raises(SplitError, match=message):
        O.chapter(frame(spark, rows), config(spark), pages(spark, n), book, 2)


def test_sections_and_meta(spark):
    df, cfg = frame(spark, BOOK), config(spark)
    found = O.resolve_chapters(df, cfg, pages(spark))
    labels = spark.createDataFrame([("b", i, str(101 + i) if i < 5 else "x", 1) for i in range(6)], "book string, page_idx int, label string, page_offset int")
    got = O.sections(df, found, cfg, labels).filter("number = 2").orderBy("idx").collect()
    assert [(r["section"], r["title"], r["pdf_page"], r["printed_page"]) for r in got] == [("2-1", "B", 2, 103), (None, "Key Takeaways", 3, 104)]
    meta = {r["number"]: r for r in O.build_meta(df, found, cfg, labels).collect()}
    assert meta[2]["pdf_pages"] == [2, 3] and meta[2]["printed_pages"] == [103, 104] and len(meta[2]["toc_subtree"]) == 3
    assert meta[3]["printed_pages"] == [105, 5] and meta[3]["sections"] == []
    with pytest.raises(PySparkException, match="label or offset"):
        spark.range(1).select(O.printed_page(F.lit("x"), F.lit(1), F.lit(None).cast("int"))).collect()


def test_scope(spark):
    df, cfg = frame(spark, BOOK), config(spark)
    none = spark.createDataFrame([], "book string, chapters array<int>")
    over = spark.createDataFrame([("b", 9, 0, 1)], "book string, number int, first int, last int")
    numbers = lambda x: sorted(r["number"] for r in x.collect())
    assert numbers(O.list_chapters(df, cfg, none)) == [1, 2, 3] and numbers(O.list_chapters(df, cfg, none, over)) == [1, 2, 3, 9]
    assert numbers(O.list_chapters(df, cfg, spark.createDataFrame([("b", [6, 5, 5])], none.schema), over)) == [5, 6]


def test_offsets(spark):
    texts = ["2  PART I\nbody 77 x\n\nline", "Head 3\nbody\nmore\n3", "no number", "", "CHAPTER 1  4\n12345"]
    df = spark.createDataFrame([("b", i + 3, t) for i, t in enumerate(texts)], "book string, page_idx int, text string")
    assert {r["offset"]: r["pages"] for r in O.offset_candidates(df).collect()} == {2: 2, 4: 1}
    assert {r["offset"]: r["pages"] for r in O.offset_candidates(df, 4, 4).collect()} == {2: 1}


# rules

LOOSE = [
    (1, "Foreword", 1), (2, "0.1", 1), (2, "Thanks", 1), (1, "Chapter 1 Start", 2), (2, "1.1 Ready", 2), (2, "Taxes", 3), (2, "1.2", 3), (3, "detail", 3), (2, "Bonds", 4), (2, "Loans", 4), (2, "1.3", 5), (2, "1.4", 5),
    (2, "A box", 5), (2, "Options 2.1", 6), (3, "of options", 6), (1, "Chapter 2 More", 7), (2, "Heading", 7), (2, "2.2 Swaps", 8),
]


def test_rebuild(spark):
    new, changes = patches.rebuild_numbered_sections(frame(spark, LOOSE), 2)
    assert titles(new) == [
        (1, "Foreword", 1), (2, "0.1", 1), (2, "Thanks", 1), (1, "Chapter 1 Start", 2), (2, "1.1 Ready", 2), (2, "1.2 Taxes", 3), (3, "detail", 3), (2, "1.3 Bonds", 4), (2, "1.4 Loans", 4), (3, "A box", 5),
        (1, "Chapter 2 More", 7), (2, "2.1 Options", 6), (3, "of options", 6), (3, "Heading", 7), (2, "2.2 Swaps", 8),
    ]
    notes = {r["note"]: r["n"] for r in patches.changes_by_note(changes).collect()}
    assert notes == {"merged": 3, "merged, moved to chapter 2": 1, "demoted to level 3": 2, "unpaired id": 1}
    again, none = patches.rebuild_numbered_sections(new, 2)
    assert titles(again) == titles(new) and {r["note"] for r in none.collect()} == {"unpaired id"}


def test_numbers_from_children(spark):
    rows = [(1, " Data", 1), (2, "Intro", 1), (2, "1.1 A", 1), (1, "Chapter 1 Appendix", 2), (2, "1-9 Z", 2), (1, "Methods", 3), (2, "2.1: B", 3), (1, "End", 4), (3, "7.1 skipped", 4)]
    new, changes = patches.number_from_children(frame(spark, rows), 1)
    assert [t for lvl, t, _ in titles(new) if lvl == 1] == ["1: Data", "Chapter 1 Appendix", "2: Methods", "End"]
    assert changes.count() == 2 and patches.number_from_children(new, 1)[1].count() == 0


def test_rename_and_insert(spark):
    df = frame(spark, [(1, "Ch 1 and Ch 2", 1), (1, "x$1", 2), (2, "Ch 3", 3)])
    new, changes = patches.rename(df, 1, r"Ch (\d)", r"$\1:")
    assert titles(new)[0] == (1, "$1: and Ch 2", 1) and titles(new)[2] == (2, "Ch 3", 3) and changes.count() == 1
    assert patches.rename(df, 1, "x", "x")[1].count() == 0
    with pytest.raises(PatchError):
        patches.rename(df, 1, "nothing", "x")
    new, changes = patches.insert(df, 2, "New", 9, {"level": 1, "match": "^x"})
    assert titles(new) == [(1, "Ch 1 and Ch 2", 1), (1, "x$1", 2), (2, "New", 9), (2, "Ch 3", 3)] and changes.first()["note"] == "inserted"
    for match in ("zzz", "."):
        with pytest.raises(PatchError):
            patches.insert(df, 2, "New", 9, {"level": 1, "match": match})


def test_rules_in_order_and_versions(spark, tmp_path):
    df = frame(spark, [(1, "One", 1), (2, "1.1 a", 1)])
    rules = [{"rule": "number_from_children", "level": 1}, {"rule": "rename", "level": 1, "match": "^1: ", "replace": "Chapter 1 "}]
    new, changes = patches.patch(df, rules)
    assert titles(new)[0][1] == "Chapter 1 One" and [r["new"] for r in changes.orderBy("seq").collect()] == ["1: One", "Chapter 1 One"]
    assert patches.patch(df, [])[1].count() == 0
    for bad in ([{"rule": "nope"}], [{"rule": "rename", "levels": 1}]):
        with pytest.raises(PatchError):
            patches.patch(df, bad)
    path = f"file://{tmp_path}/outline"
    assert sinks.apply_patches(df, rules, path).count() == 2
    assert titles(spark.read.parquet(sinks.version_path(path, 0))) == titles(df) and titles(spark.read.parquet(sinks.version_path(path, 1))) == titles(new)
    with pytest.raises(PatchError, match="already"):
        sinks.apply_patches(df, rules, path)
    assert sinks.apply_patches(df, rules, path, force=True).count() == 2


def test_books_in_chunks(spark, data, monkeypatch):
    world, bare = relation(spark, data, "detached"), relation(spark, data, "unnumbered")
    rules = [{"rule": "rebuild_numbered_sections", "level": 2}, {"rule": "insert", "level": 1, "title": "X", "page": 1, "after": {"level": 1, "match": "^Chapter 3 "}}]

    def made():
        (new, changes), (numbered, more) = patches.patch(world, rules), patches.number_from_children(bare, 1)
        plan = new._jdf.queryExecution().optimizedPlan().toString()
        return [sorted(map(tuple, df.collect())) for df in (new, changes, numbered, more)], plan

    whole, plan = made()
    # positions are found per bucket, so no task holds a book
    specs = re.findall(r"row_number\(\) windowspecdefinition\(book#\d+, (\w+)", plan)
    assert specs and set(specs) == {"bucket0_"}
    monkeypatch.setattr(order, "BITS", 1)
    assert made()[0] == whole and [r[1] for r in whole[0]] == list(range(len(whole[0]))) and [r[1] for r in whole[1]] == list(range(len(whole[1])))


def test_running_values_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(order, "BITS", 1)
    df = spark.createDataFrame([(b, i, 1 if i % 4 == 1 else None) for b in ("a", None) for i in range(9)], "book string, idx int, v int")
    got = order.running(df, ["idx"], {"newest": F.when(F.col("v") == 1, F.col("idx"))}, {"n": F.col("v")})
    want = {(b, i, max((k for k in range(i) if k % 4 == 1), default=None), sum(k % 4 == 1 for k in range(i))) for b in ("a", None) for i in range(9)}
    assert {(r["book"], r["idx"], r["newest"], r["n"]) for r in got.collect()} == want


# contracts and intake


def test_artifacts(spark):
    keys = [("b", f"ch0{i}") for i in range(5)]
    chapters = spark.createDataFrame([(*k, "s", 34) for k in keys], "book string, chapter string, stem string, pages int")
    names = [n.format(stem="s") for n in checks.REQUIRED]
    present = spark.createDataFrame([(*k, n) for k in keys for n in names if not (k[1] == "ch01" and n in ("images", "s.md"))], "book string, chapter string, name string")
    middle = spark.createDataFrame([(*k, 33 if k[1] == "ch02" else 34) for k in keys if k[1] != "ch04"], "book string, chapter string, pages int")
    content = spark.createDataFrame([(*k, 34 if k[1] == "ch03" else 32) for k in keys], "book string, chapter string, page_idx int")
    got = {r["chapter"]: r["fault"] for r in checks.artifact_faults(chapters, present, middle, content).collect()}
    assert got == {"ch01": "missing images, s.md", "ch02": "33 pages extracted, 34 expected", "ch03": "page 34 beyond 34 pages", "ch04": "0 pages extracted, 34 expected"}


def test_intake_and_probe(spark):
    pages_ = spark.createDataFrame([("b", i, "" if i == 50 else "text") for i in range(100)], "book string, page_idx int, text string")
    books = spark.createDataFrame([("b", 0, 100, False), ("c", 0, 10, False)], "book string, begin int, end int, has_ranges boolean")
    got = {r["book"]: r for r in checks.intake(books, pages_, frame(spark, BOOK)).collect()}
    assert got["b"]["text_layer_sample"] == "19/20" and got["b"]["first_titles"] == ["Part One", "Part Two"] and len(got["b"]["faults"]) == 1
    assert got["c"]["faults"] == ["no pages", "no outline and no chapter ranges"]
    readings = spark.createDataFrame([("b", [1, 8])], "book string, chapters array<int>")
    found = checks.probe(frame(spark, BOOK), config(spark), pages(spark), readings)
    assert {r["number"]: r["fault"] for r in found.collect()} == {1: None, 8: "not in the outline"}
