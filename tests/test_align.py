import random

import pytest
from pyspark.sql import functions as F

from quire.errors import AlignError
from quire.operators import align as A


def plain_align(hay, blocks):
    """Places by walking over all positions."""
    used, at, out = set(), 0, []
    for b in blocks:
        spots = [i for i in range(len(hay) - len(b) + 1) if hay[i : i + len(b)] == b and not used & set(range(i, i + len(b)))] if b else []
        spot = next((i for i in spots if i >= at), spots[0] if spots else None)
        if spot is None:
            out.append(None)
            continue
        used |= set(range(spot, spot + len(b)))
        at = spot + len(b)
        out.append((spot, at))
    return out


def frames(spark, pages):
    tokens = spark.createDataFrame([("b", i, h) for i, (h, _) in enumerate(pages)], "book string, page_idx int, tokens array<string>")
    rows = [("b", i, k, f"p{i:03d}-b{k:03d}", b, k % 2 == 1) for i, (_, bs) in enumerate(pages) for k, b in enumerate(bs)]
    return tokens, spark.createDataFrame(rows, "book string, page_idx int, index int, id string, tokens array<string>, math boolean")


def hunks(spark, *pages):
    found = A.hunks(A.aligned(A.pages_of(*frames(spark, pages))))
    return [tuple(r[c] for c in ("page_idx", "anchor", "pdf_text", "md_text")) for r in found.orderBy("page_idx", "seq").collect()]


def test_align_on_random_pages(spark):
    random.seed(4)
    pages = []
    for _ in range(300):
        hay = [random.choice("abc") for _ in range(random.randrange(20))]
        pages.append((hay, [[random.choice("abc") for _ in range(random.randrange(5))] for _ in range(random.randrange(7))]))
    got = {r["page_idx"]: [(s["s"], s["e"]) if s else None for s in r["spans"]] for r in A.aligned(A.pages_of(*frames(spark, pages))).collect()}
    assert got == {i: plain_align(*p) for i, p in enumerate(pages)}


def test_counts(spark):
    pages = [("a b c d".split(), [["c", "d"], ["a", "b"], [], ["x"]]), ([], [["y"]]), (["z"], [])]
    got = {r["page_idx"]: tuple(r)[2:] for r in A.counts(A.aligned(A.pages_of(*frames(spark, pages)))).collect()}
    assert got == {0: (4, 5, 2, 1), 1: (0, 1, 0, 1), 2: (1, 0, 0, 0)}


def test_out_of_order_blocks_leave_no_hunk(spark):
    assert hunks(spark, ("a b c d e f g h".split(), ["e f g h".split(), "a b c d".split()])) == []


def test_substitution_deletion_and_anchors(spark):
    assert hunks(spark, ("one two three four".split(), ["one two three fuor".split()])) == [(0, "p000-b000", "one two three four", "one two three fuor")]
    deleted = hunks(spark, ("alpha beta gamma delta epsilon".split(), [["alpha", "beta"], ["epsilon"]]))
    assert deleted == [(0, "p000-b000", "gamma delta", "")]
    assert hunks(spark, (["x"], [])) == [(0, "p000-none", "x", "")]
    assert hunks(spark, (["x", "a"], [[], ["a"]])) == [(0, "p000-b001", "x", "")]


def test_close_differences_are_one_hunk(spark):
    left = "k1 k2 k3 k4 A m1 m2 B k5 k6 k7 k8 k9 C z".split()
    right = "k1 k2 k3 k4 X m1 m2 Y k5 k6 k7 k8 k9 Z z".split()
    assert hunks(spark, (left, [right])) == [(0, "p000-b000", "k2 k3 k4 A m1 m2 B k5 k6 k7", "k2 k3 k4 X m1 m2 Y k5 k6 k7"), (0, "p000-b000", "k7 k8 k9 C z", "k7 k8 k9 Z z")]


def test_masks_and_text(spark):
    blocks = spark.createDataFrame([("b", 0, "table", [100, 100, 500, 200]), ("b", 0, "paragraph", [0, 0, 1000, 1000])], "book string, page_idx int, type string, bbox array<int>")
    sizes = spark.createDataFrame([("b", 0, 200.0, 400.0)], "book string, page_idx int, width double, height double")
    m = A.masks(blocks, sizes)
    assert tuple(m.first())[2:] == (18.0, 38.0, 102.0, 82.0)
    rows = [("b", 0, 0, 0.0, 0.0, 10.0, 10.0, "keep", 0, 0), ("b", 0, 1, 16.0, 36.0, 20.0, 40.0, "edge", 0, 0), ("b", 0, 2, 100.0, 40.0, 104.0, 60.0, "far", 0, 0), ("b", 0, 3, 0.0, 90.0, 9.0, 99.0, "next", 1, 0), ("b", 1, 0, 20.0, 40.0, 21.0, 41.0, "other", 0, 0)]
    words = spark.createDataFrame(rows, "book string, page_idx int, ord int, x0 double, y0 double, x1 double, y1 double, word string, block_no int, line_no int")
    left = A.unmasked(words, m)
    assert {r["page_idx"]: r["text"] for r in A.page_text(left).collect()} == {0: "keep far\nnext", 1: "other"}
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_page_guards(spark):
    tokens, blocks = frames(spark, [(["a"], [["a"]]), (["b"], [])])
    with pytest.raises(AlignError, match="2 pages of text and 1"):
        A.check_pages(tokens, blocks)
    sizes = spark.createDataFrame([("b", 0, 100.0, 100.0)], "book string, page_idx int, width double, height double")
    A.check_pages(tokens.limit(1), blocks, sizes, sizes.withColumn("width", F.lit(100.9)))
    with pytest.raises(AlignError, match="two sizes"):
        A.check_pages(tokens.limit(1), blocks, sizes, sizes.withColumn("width", F.lit(102.0)))


def test_no_broadcast_or_collect_in_the_main_path(spark):
    plan = A.aligned(A.pages_of(*frames(spark, [(["a"], [["a"]])])))._jdf.queryExecution().optimizedPlan().toString()
    assert "PythonUDF" not in plan


def test_result(spark):
    pages = [("alpha beta gamma delta epsilon".split(), [["alpha", "beta"], ["epsilon"]]), (["x"], [["y"]]), (["z"], [["z"]])]
    aligned = A.aligned(A.pages_of(*frames(spark, pages)))
    r = A.result(aligned, spark.createDataFrame([("b", 119)], "book string, first int")).first()
    assert r["pages"] == 3 and r["counts"].asDict() == {"pdf_tokens": 7, "md_tokens": 5, "matched_blocks": 3, "unmatched_blocks": 1, "hunks": 2, "hunks_inline_math": 0}
    assert [h["page"] for h in r["hunks"]] == [119, 120]
    assert A.first_hunks(A.hunks(aligned), 1).first()["page_idx"] == 0 and A.hunks_per_page(A.hunks(aligned)).count() == 2
    clean = A.result(A.aligned(A.pages_of(*frames(spark, pages[2:])))).first()
    assert clean["hunks"] == [] and clean["counts"]["hunks"] == 0


def test_classes(spark):
    from quire.operators.classify import classify

    rows = [("b", 0, 0, True, "x", "y"), ("b", 0, 1, False, "moved text", ""), ("b", 3, 0, False, "", "moved text"), ("b", 1, 0, False, "", "same"), ("b", 1, 1, False, "same", ""), ("b", 2, 0, False, "capital", "capi tal"), ("b", 2, 1, False, "a b", "ab"), ("b", 2, 2, False, "a,", "a."), ("b", 2, 3, False, "a +", "a ="), ("b", 2, 4, False, "a", "b"), ("b", 2, 5, False, "gone", ""), ("b", 2, 6, False, "", "new"), ("c", 0, 0, False, "", "gone")]
    df = spark.createDataFrame(rows, "book string, page_idx int, seq int, math boolean, pdf_part string, md_part string")
    got = {tuple(r)[:3]: r["kind"] for r in classify(df).collect()}
    want = ["inline-math", "move across pages", "move across pages", "move", "move", "split", "joined", "punctuation", "symbol", "replace", "deletion", "insertion", "insertion"]
    assert [got[r[:3]] for r in rows] == want


def test_tokens_with_spaces_align_by_tokens(spark):
    pages = [(["a b", "c", "a", "b"], [["a", "b"], ["a b"]]), (["", "x"], [["x"], [""]]), (["x", "x", "x"], [["x", "x"], ["x"], ["x"]])]
    got = {r["page_idx"]: [(s["s"], s["e"]) if s else None for s in r["spans"]] for r in A.aligned(A.pages_of(*frames(spark, pages))).collect()}
    assert got == {i: plain_align(*p) for i, p in enumerate(pages)} and got[2] == [(0, 2), (2, 3), None]


def test_words_of_many_letters_align_in_text(spark):
    random.seed(5)
    words = ["ab", "b", "abc", "é", "東京", "$1", "c"]
    pages = [([random.choice(words) for _ in range(random.randrange(40))], [[random.choice(words) for _ in range(random.randrange(4))] for _ in range(random.randrange(9))]) for _ in range(300)]
    got = {r["page_idx"]: [(s["s"], s["e"]) if s else None for s in r["spans"]] for r in A.aligned(A.pages_of(*frames(spark, pages))).collect()}
    assert got == {i: plain_align(*p) for i, p in enumerate(pages)}


def test_a_worker_holds_few_pages_as_objects(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    limit = A.PAGES_AT_ONCE

    def counting(page, plain=A._hunks):
        seen.add(1)
        return plain(page)

    monkeypatch.setattr(A, "_hunks", counting)
    pages = [(["x", str(i)], [["y"]]) for i in range(3 * limit + 5)]
    own = A.aligned(A.pages_of(*frames(spark, pages))).coalesce(1)
    assert A.with_hunks(own).count() == len(pages)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").removesuffix("b")) <= A.ARROW_BYTES


def test_hunks_are_found_once_for_classes(spark):
    from quire.operators.classify import classify

    found = A.hunks(A.aligned(A.pages_of(*frames(spark, [("a b c".split(), [["a", "x", "c"]])]))))
    plan = classify(found)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("Relation") == 3
