"""The registered queries: operators over the adapters' relations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import align as A
from quire.operators import blocks as B
from quire.operators import checks as K
from quire.operators import classify as C
from quire.operators import outline as O
from quire.operators import patches as P
from quire.operators import report as R
from quire.operators import validate as V
from quire.plans import adapters
from quire.plans.adapters import relation
from quire.sources.scratch import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# outline


def _outline(s, d):
    """The outline is read by many branches of a plan; it is small beside the texts that it is made from."""
    return materialize(relation(s, d, "outline"), "outline")


@query
def outline_chapter_entries(s, d):
    return O.chapter_entries(_outline(s, d), relation(s, d, "config"))


@query
def outline_children(s, d):
    return O.children(relation(s, d, "world"))


@query
def outline_level_stats(s, d):
    return O.level_stats(_outline(s, d))


@query
def outline_offset_candidates(s, d):
    return O.offset_candidates(relation(s, d, "page_text"))


@query
def chapter_ranges(s, d):
    return O.resolve_chapters(_outline(s, d), relation(s, d, "config"), relation(s, d, "book_pages"))


@query
def chapter_ranges_with_override(s, d):
    return _chapters(s, d).withColumn("toc_index", F.coalesce("toc_index", F.lit(-1)))


@query
def chapter_slug_numbers(s, d):
    k = F.col("p_partkey")
    spelled = F.when(k % 4 == 0, k.cast("string")).when(k % 4 == 1, F.concat(F.lit("ch"), k)).when(k % 4 == 2, F.concat(F.lit("ch00"), k)).otherwise(F.concat(F.lit("0"), k))
    parts = relation(s, d, "part").select("p_partkey", spelled.alias("spelled"))
    return parts.select("p_partkey", O.chapter_number(F.col("spelled")).alias("number"), O.chapter_slug(F.col("spelled")).alias("slug"))


@query
def printed_pages(s, d):
    return relation(s, d, "page_labels").select("book", "page_idx", O.printed_page(F.col("label"), F.col("page_idx"), F.col("page_offset")).alias("printed"))


def _chapters(s, d, outline=None):
    return O.resolve_chapters(_outline(s, d) if outline is None else outline, relation(s, d, "config"), relation(s, d, "book_pages"), relation(s, d, "overrides"))


@query
def chapter_subtree(s, d):
    outline = _outline(s, d)
    return O.subtree(outline, _chapters(s, d, outline), relation(s, d, "config"))


def _labels(s, d):
    """A label for every page of a book, so that sections have one."""
    pages = relation(s, d, "book_pages").select("book", F.explode(F.sequence(F.lit(0), F.col("page_count"))).alias("page_idx"))
    label = F.when(F.col("page_idx") % 3 == 0, (F.col("page_idx") + 100).cast("string")).when(F.col("page_idx") % 3 == 1, F.lit("iv"))
    return pages.select("book", "page_idx", label.alias("label"), F.lit(7).alias("page_offset"))


@query
def chapter_sections(s, d):
    outline = _outline(s, d)
    return O.sections(outline, _chapters(s, d, outline), relation(s, d, "config"), _labels(s, d))


def meta(s, d):
    """The meta documents of all chapters."""
    outline = _outline(s, d)
    return O.build_meta(outline, _chapters(s, d, outline), relation(s, d, "config"), _labels(s, d))


@query
def chapter_meta(s, d):
    return flat_meta(meta(s, d))


def flat_meta(documents):
    return documents.select(
        "book", "chapter", "number", "title", F.col("pdf_pages")[0].alias("first_page"), F.col("pdf_pages")[1].alias("last_page"), F.coalesce(F.col("printed_pages")[0], F.lit(-1)).alias("first_printed"),
        F.coalesce(F.col("printed_pages")[1], F.lit(-1)).alias("last_printed"),
        F.size("sections").alias("n_sections"), F.md5(F.array_join(F.transform("sections", lambda x: F.concat_ws("|", x["number"], x["title"], x["pdf_page"], x["printed_page"], x["level"])), "\n")).alias("sections"),
        F.size("toc_subtree").alias("n_subtree"), F.md5(F.array_join(F.transform("toc_subtree", lambda x: F.concat_ws("|", x["level"], x["title"], x["page"])), "\n")).alias("subtree"),
    )


def _readings(s, d):
    return relation(s, d, "readings").groupBy("book").agg(F.sort_array(F.collect_list("number")).alias("chapters"))


@query
def chapter_scope(s, d):
    return O.list_chapters(_outline(s, d), relation(s, d, "config"), _readings(s, d), relation(s, d, "overrides"))


# outline rules


@query
def patch_number_from_children(s, d):
    return P.number_from_children(relation(s, d, "unnumbered"), 1)[0]


@query
def patch_rename(s, d):
    return P.rename(relation(s, d, "world"), 2, r"^([0-9]+) (.)", r"Nation \1: \2")[0]


@query
def patch_insert(s, d):
    return P.insert(relation(s, d, "world"), 2, "99 NOWHERE", 42, {"level": 1, "match": "^ASIA$"})[0]


@query
def patch_rebuild_sections(s, d):
    return P.rebuild_numbered_sections(relation(s, d, "detached"), 2)[0]


@query
def patch_changes(s, d):
    return P.rebuild_numbered_sections(relation(s, d, "detached"), 2)[1].select("level", "page", "old", "new", "note")


@query
def patch_changes_by_note(s, d):
    return P.changes_by_note(P.patch(relation(s, d, "detached"), [{"rule": "rebuild_numbered_sections", "level": 2}, {"rule": "rename", "level": 1, "match": "^Chapter ", "replace": ""}])[1])


# blocks


def _blocks(s, d):
    return B.parse(B.raw_blocks(adapters.page_json(s, d)))


@query
def blocks_from_pages(s, d):
    b = _blocks(s, d)
    box = [F.coalesce(F.get("bbox", F.lit(i)), F.lit(-1)).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))]
    return b.select(
        "doc_id", "page_idx", "id", "type", *box, F.coalesce("level", F.lit(-1)).alias("level"), "math", "html", "content", "crop", "sub_type",
    )


@query
def block_text_math(s, d):
    b = _blocks(s, d).filter("id is not null")
    return b.select(
        "doc_id", "id", B.text().alias("text"), B.caption_text().alias("caption_text"), F.array_join(B.inline_math(), "|").alias("inline_math"), B.block_text().alias("block_text"), B.model_made().alias("model_made"),
    )


@query
def vlm_flags(s, d):
    b = _blocks(s, d).filter("id is not null").withColumn("chapter", F.col("doc_id").cast("string"))
    return R.model_flags(b)


@query
def report_counts(s, d):
    return R.counts(_blocks(s, d).withColumn("chapter", F.col("doc_id").cast("string")))


# normalization


@query
def normalize_pdf_tokens(s, d):
    t = relation(s, d, "glyphs").withColumn("t", X.tokenize(X.normalize(F.col("text"), X.MD_RULES)))
    return t.select("doc_id", F.size("t").cast("long").alias("tokens"), F.md5(F.array_join("t", " ")).alias("digest"))


@query
def normalize_nfkc(s, d):
    docs = relation(s, d, "documents").select("doc_id", F.concat(F.lit("ﬁn ½ Å "), "text").alias("text"))
    return docs.select("doc_id", F.md5(X.nfkc(F.col("text"))).alias("digest"))


@query
def spaced_caps(s, d):
    heads = relation(s, d, "documents").select("doc_id", F.concat(F.lit("PA R T I I I of "), "lang", F.lit(" the US GDP A B "), F.upper(F.substring("lang", 1, 1)), F.lit(" x")).alias("text"))
    return heads.select("doc_id", X.join_spaced_caps(F.col("text")).alias("joined"))


@query
def flatten_latex(s, d):
    c = relation(s, d, "customer").select("c_custkey", F.concat(F.lit("\\$ "), "c_custkey", F.lit(" \\frac{C_"), F.col("c_nationkey"), F.lit("}{1 + r}^{2}")).alias("m"))
    return c.select("c_custkey", X.flatten_latex(F.col("m")).alias("flat"))


# masks and alignment


def _boxes(s, d):
    return relation(s, d, "regions").withColumn("bbox", F.array("b0", "b1", "b2", "b3").cast("array<int>"))


def _sizes(s, d):
    return relation(s, d, "documents").select(F.col("source").alias("book"), F.col("doc_id").cast("int").alias("page_idx"), F.lit(612.0).alias("width"), F.lit(792.0).alias("height"))


@query
def page_masks(s, d):
    return A.masks(_boxes(s, d), _sizes(s, d))


@query
def masked_page_text(s, d):
    left = A.unmasked(relation(s, d, "boxed"), A.masks(_boxes(s, d), _sizes(s, d)))
    return A.page_text(left).select("book", "page_idx", F.md5("text").alias("digest"), F.length("text").cast("long").alias("n"))


#: Tokens of a passage by which its places are looked for; a shorter one is looked for by all of its tokens.
START = 5
#: So many keys are looked up within each text; more are joined.
FEW_KEYS = 10_000


@query
def passage_first_match(s, d):
    """Where each benchmark passage first stands in each document: candidates by their first tokens, then compared whole."""
    docs = relation(s, d, "documents").select("doc_id", X.tokenize(F.col("text")).alias("hay"))
    passages = relation(s, d, "benchmark").select("item_id", X.tokenize(F.col("text")).alias("needle")).filter(F.size("needle") > 0)
    n = F.least(F.size("needle"), F.lit(START))
    keys = passages.select("item_id", n.alias("n"), F.xxhash64(F.slice("needle", 1, n)).alias("key"))

    def candidates(k: int):
        """Pairs that share the key of a passage of k tokens, or of START and more; None if there is no such passage."""
        own = keys.filter(F.col("n") == k).select("item_id", "key")
        few = [r["key"] for r in own.select("key").distinct().limit(FEW_KEYS + 1).collect()]
        if not few:
            return None
        places = F.when(F.size("hay") >= k, F.sequence(F.lit(1), F.greatest(F.size("hay") - k + 1, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        grams = F.transform(places, lambda i: F.xxhash64(F.slice("hay", i, k)))
        if len(few) <= FEW_KEYS:
            grams = F.filter(grams, lambda g: g.isin(few))
        # keys go to the join, texts do not
        return docs.select("doc_id", F.explode(F.array_distinct(grams)).alias("key")).join(own, "key").select("doc_id", "item_id")

    near = None
    for found in filter(None, map(candidates, range(1, START + 1))):
        near = found if near is None else near.unionByName(found)
    if near is None:
        near = docs.join(passages, F.lit(False)).select("doc_id", "item_id")
    pairs = near.join(docs, "doc_id").join(passages, "item_id")
    none = F.array().cast("array<struct<s:int,e:int>>")
    found = pairs.select("item_id", "doc_id", A.first_free(F.col("hay"), F.col("needle"), none, F.lit(0)).alias("pos"))
    return found.filter("pos is not null").select("item_id", "doc_id", F.col("pos").cast("long").alias("pos")).distinct()


#: Markup that is not text, tags within a line, and what opens a block; once the tags within lines are gone a block's text has no tag.
HTML_HIDDEN = r"(?s)<script.*?</script>|<style.*?</style>|<title.*?</title>|<!--.*?-->"
HTML_INLINE = r"</?(a|b|br|i|em|span|strong)( [^>]*)?>"
HTML_BLOCK = r"<(p|h1|li|footer)>([^<]+)"
#: Pages of a book.
BOOK = 100


def _book():
    return F.concat(F.lit("web"), F.floor(F.col("page_id") / BOOK))


def _sides(s, d):
    """Both extractions of each web page: its text layer, and its blocks; a page without blocks is a row with a null index."""
    pages = relation(s, d, "pages").select(_book().alias("book"), F.col("page_id").cast("int").alias("page_idx"), F.regexp_replace("html", HTML_HIDDEN, " ").alias("html"))
    tokens = pages.select("book", "page_idx", A.page_tokens(F.regexp_replace("html", r"<[^>]*>", "\n")).alias("tokens"))
    flat = F.regexp_replace("html", HTML_INLINE, " ")
    found = pages.withColumn("html", flat).select("book", "page_idx", F.posexplode_outer(F.expr("regexp_extract_all(html, '" + HTML_BLOCK + "', 2)")).alias("index", "text"))
    text = F.when(F.col("index") % 4 == 3, F.concat(F.col("text"), F.lit(" odd"))).otherwise(F.col("text"))
    blocks = found.select("book", "page_idx", "index", B.block_id(F.col("page_idx"), F.col("index")).alias("id"), X.tokenize(X.normalize(text, X.MD_RULES)).alias("tokens"), (F.col("index") % 5 == 3).alias("math"))
    return tokens, blocks


@query
def page_token_counts(s, d):
    tokens, blocks = _sides(s, d)
    md = blocks.groupBy("page_idx").agg(F.sum(F.size("tokens")).cast("long").alias("md_tokens"), F.count("index").alias("blocks"))
    return tokens.select("page_idx", F.size("tokens").cast("long").alias("pdf_tokens")).join(md, "page_idx", "left")


def _aligned(s, d):
    return A.aligned(A.pages_of(*_sides(s, d)))


@query
def align_blocks(s, d):
    rows = _aligned(s, d)
    return rows.select("page_idx", F.posexplode(F.arrays_zip(F.transform("blocks", lambda b: b["id"]).alias("id"), F.col("spans").alias("span"))).alias("k", "x")).select("page_idx", "x.id", F.coalesce("x.span.s", F.lit(-1)).alias("s"), F.coalesce("x.span.e", F.lit(-1)).alias("e"))


@query
def guardrail_counts(s, d):
    return A.counts(_aligned(s, d))


@query
def diff_hunks(s, d):
    return A.hunks(_aligned(s, d))


def comparison(s, d):
    """The results of the comparison of all books; page sizes that agree are checked on the way."""
    pages = relation(s, d, "pages").select(_book().alias("book"), F.col("page_id").cast("int").alias("page_idx"))
    first = pages.select("book", F.lit(101).alias("first")).distinct()
    sizes = pages.select("book", "page_idx", F.lit(612.0).alias("width"), F.lit(792.0).alias("height"), F.lit(612.4).alias("model_width"), F.lit(791.6).alias("model_height"))
    return A.result(_aligned(s, d), first, sizes)


@query
def guardrail_result(s, d):
    return flat_comparison(comparison(s, d))


def flat_comparison(found):
    hunk = lambda h: F.concat_ws("|", h["page"].cast("string"), h["anchor"], h["pdf_text"], h["md_text"])
    return found.select("book", "pages", "counts.*", F.md5(F.array_join(F.transform("hunks", hunk), "\n")).alias("digest"))


@query
def hunks_per_page(s, d):
    return A.hunks_per_page(A.hunks(_aligned(s, d)))


@query
def hunks_with_math(s, d):
    return A.hunks(_aligned(s, d)).groupBy("page_idx").agg(F.count(F.lit(1)).alias("hunks"), F.count_if("math").alias("hunks_inline_math"))


@query
def hunk_classes(s, d):
    return C.classify(A.hunks(_aligned(s, d))).groupBy("book", "kind").agg(F.count(F.lit(1)).alias("hunks"))


# report


def _titles(s, d):
    return relation(s, d, "documents").select(F.col("source").alias("book"), F.lit("ch01").alias("chapter")).distinct().withColumn("title", F.lit("The and"))


@query
def running_matter_suspects(s, d):
    return R.running_matter_suspects(relation(s, d, "running"), _titles(s, d)).select("book", "id")


@query
def spot_sample(s, d):
    return R.spot_sample(R.candidates(relation(s, d, "heads"))).select("book", "id")


def _report_documents(s, d):
    """A report per customer, most of them broken in one way."""
    # keys are few bytes, so a small file would be one task; the work is what is made of them
    keys = relation(s, d, "customer").select("c_custkey").repartition(int(s.conf.get("spark.sql.shuffle.partitions")))
    c = keys.select("c_custkey", (F.col("c_custkey") % 13).cast("int").alias("w"))
    w = F.col("w")
    hunk = F.struct(F.lit(5).alias("page"), F.lit("p000-b001").alias("anchor"), F.lit("a").alias("pdf_text"), F.lit("b").alias("md_text"))
    bad_hunk = F.struct(F.lit(-1).alias("page"), F.lit("p000-b001").alias("anchor"), F.lit("a").alias("pdf_text"), F.lit("b").alias("md_text"))
    flag = F.struct(F.lit("x").alias("id"), F.when(w == 7, "picture").otherwise("table").alias("type"), F.lit("c").alias("crop"), F.lit("vlm_generated").alias("reason"))
    report = F.struct(
        F.when(w != 1, F.lit("bma")).alias("book"),
        F.lit("ch05").alias("chapter"),
        F.when(w == 2, F.array(F.lit(9), F.lit(3))).when(w == 3, F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(3))).alias("pages"),
        F.struct(F.lit("b").alias("backend"), F.lit("e").alias("effort"), F.lit("v").alias("mineru_version"), F.when(w != 4, F.lit("t")).alias("timestamp")).alias("extraction"),
        F.struct(*(F.lit(1).alias(k) for k in V.COUNTS[:4]), F.when(w == 5, 7).otherwise(2).alias("diff_hunks")).alias("counts"),
        F.when(w == 6, F.array(hunk, bad_hunk)).otherwise(F.array(hunk, hunk)).alias("diff_hunks"),
        F.array(flag).alias("flagged_blocks"),
        F.array(F.struct(F.lit("x").alias("id"), F.when(w != 8, F.lit("c")).alias("crop"))).alias("spot_check"),
        F.when(w == 9, "done").otherwise("certified").alias("status"),
    )
    json = F.to_json(report)
    json = F.when(w == 10, F.replace(json, F.lit('"tables":1'), F.lit('"tables":true'))).when(w == 11, F.lit("{broken")).when(w == 12, F.lit("[1]")).otherwise(json)
    return c.select("c_custkey", json.alias("json"))


@query
def report_violations(s, d):
    return V.violations(_report_documents(s, d)).select("c_custkey", "path")


def reports(s, d):
    """Whole reports of the web pages, a chapter per page; they pass the validator."""
    tokens, sides = _sides(s, d)
    sides = materialize(sides, "sides")  # read for the comparison, the flags, the counts and the sample
    found = A.hunks(A.aligned(A.pages_of(tokens, sides))).select("book", F.col("page_idx").cast("string").alias("chapter"), "seq", F.col("page_idx").alias("page"), "anchor", "pdf_text", "md_text")
    docs = relation(s, d, "pages").select(F.col("page_id"), _book().alias("book"), F.col("page_id").cast("string").alias("chapter"))
    meta = docs.select("book", "chapter", F.lit("").alias("title"), F.array(F.col("page_id").cast("int"), F.col("page_id").cast("int")).alias("printed_pages"))
    blocks = sides.filter("index is not null")
    kind = F.element_at(F.array(*(F.lit(t) for t in ("paragraph", "title", "table", "page_header", "image"))), (F.col("index") % 5 + 1).cast("int"))
    blocks = blocks.select("book", F.col("page_idx").cast("string").alias("chapter"), "page_idx", "index", "id", kind.alias("type"), F.lit("").alias("content"), F.lit("").alias("crop"), F.array_join("tokens", " ").alias("text"))
    run = docs.select("book", "chapter", F.lit("hybrid-http-client").alias("backend"), F.lit("high").alias("effort"), F.lit("1").alias("version"), F.timestamp_seconds(F.col("page_id")).alias("modified"))
    return R.build(meta, blocks, found, run)


@query
def chapter_reports(s, d):
    return flat_reports(reports(s, d))


def flat_reports(report):
    checked = report.withColumn("json", F.to_json(F.struct(*report.columns)))
    flag = lambda x: F.concat_ws(":", x["id"], x["type"], x["crop"], x["reason"])
    flags = F.array_join(F.transform("flagged_blocks", flag), "|").alias("flagged")
    return checked.select("book", "chapter", "counts.*", flags, F.size("spot_check").alias("spots"), "extraction.timestamp", V.first_violation(F.col("json"))["path"].alias("violation"))


# contracts and profiling


@query
def artifact_contract(s, d):
    docs = relation(s, d, "documents").select("source", "doc_id", "n_chars", F.lit("src").alias("book"), F.col("doc_id").cast("string").alias("chapter"))
    chapters = docs.select("book", "chapter", F.lit("c").alias("stem"), (F.col("n_chars") % 40 + 1).cast("int").alias("pages"))
    names = [n.format(stem="c") for n in K.REQUIRED]
    present = docs.select("book", "chapter", "doc_id", F.explode(F.array(*map(F.lit, names))).alias("name")).filter("not (doc_id % 5 = 0 and name = 'images') and not (doc_id % 10 = 0 and name = 'c.md')")
    middle = docs.filter("doc_id % 9 <> 0").select("book", "chapter", (F.col("n_chars") % 40 + 1 - F.when(F.col("doc_id") % 7 == 0, 1).otherwise(0)).cast("int").alias("pages"))
    content = docs.select("book", "chapter", (F.col("n_chars") % 40 + F.when(F.col("doc_id") % 8 == 0, 2).otherwise(-1)).cast("int").alias("page_idx"))
    return K.artifact_faults(chapters, present.drop("doc_id"), middle, content)


def manifest(s, d):
    """The intake's manifest: a row per book."""
    pages = relation(s, d, "page_text")
    books = pages.groupBy("book").agg(F.lit(1).alias("begin"), (F.max("page_idx") + 1).alias("end")).withColumn("has_ranges", F.lit(False))
    return K.intake(books, pages, _outline(s, d).filter("book <> 'src4'"))


@query
def intake_check(s, d):
    return flat_manifest(manifest(s, d))


def flat_manifest(found):
    return found.select("book", "pages", "text_layer_sample", "outline_entries", "outline_top_level", F.array_join("first_titles", "|").alias("first_titles"), F.array_join("faults", "|").alias("faults"))


@query
def probe_check(s, d):
    listed = _readings(s, d).withColumn("chapters", F.array_append("chapters", F.lit(77777)))
    labels = _labels(s, d).withColumn("page_offset", F.when(F.col("book") != "src5", F.col("page_offset")))
    return K.probe(_outline(s, d), relation(s, d, "config"), relation(s, d, "book_pages"), listed, relation(s, d, "overrides"), labels)


@query
def probe_evidence(s, d):
    return K.evidence(_outline(s, d), relation(s, d, "page_text"))["offsets"].select("book", "offset", "pages", F.col("k").cast("long").alias("k"))
