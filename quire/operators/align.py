"""Masking, verbatim alignment and residual diff of two extractions of a page."""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quire.errors import AlignError
from quire.functions.text import PDF_RULES, Rule, normalize, tokenize
from quire.schemas import MASKED

#: Tokens around a hunk, and the gap up to which neighbouring differences are one.
CONTEXT, GAP, PAD = 3, 2, 2.0
KEYS = ("book", "page_idx")


def masks(blocks: DataFrame, pages: DataFrame, pad: float = PAD) -> DataFrame:
    """Rows (book, page_idx, x0, y0, x1, y1): boxes of masked blocks in points, padded.

    Boxes count thousandths of the page; pages: (book, page_idx, width, height).
    """
    own = blocks.filter(F.col("type").isin(*MASKED)).join(pages.select(*KEYS, "width", "height"), list(KEYS))
    at = lambda i, side: F.col("bbox")[i] * F.col(side) / 1000
    return own.select(*KEYS, (at(0, "width") - pad).alias("x0"), (at(1, "height") - pad).alias("y0"), (at(2, "width") + pad).alias("x1"), (at(3, "height") + pad).alias("y1"))


def unmasked(words: DataFrame, rects: DataFrame) -> DataFrame:
    """Words whose centre lies in no mask; an equi anti-join per page with the box as its condition."""
    w, m = words.alias("w"), rects.alias("m")
    x, y = (F.col("w.x0") + F.col("w.x1")) / 2, (F.col("w.y0") + F.col("w.y1")) / 2
    same = (F.col("w.book") == F.col("m.book")) & (F.col("w.page_idx") == F.col("m.page_idx"))
    inside = (x >= F.col("m.x0")) & (x < F.col("m.x1")) & (y >= F.col("m.y0")) & (y < F.col("m.y1"))
    return w.join(m, same & inside, "left_anti")


def page_text(words: DataFrame) -> DataFrame:
    """Rows (book, page_idx, text): words in order, a space within a line and a line end between lines."""
    order = W.partitionBy(*KEYS).orderBy("ord")
    line = F.struct("block_no", "line_no")
    gap = F.when(F.lag("ord").over(order).isNull(), "").when(line == F.lag(line).over(order), " ").otherwise("\n")
    pieces = words.withColumn("piece", F.concat(gap, F.col("word")))
    return pieces.groupBy(*KEYS).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "piece"))), lambda s: s["piece"]), "").alias("text"))


def page_tokens(c: Column, rules: tuple[Rule, ...] = PDF_RULES) -> Column:
    """The tokens of a page's text; the whole page is normalized, since rules work across lines."""
    return tokenize(normalize(c, rules))


def first_free(hay: Column, needle: Column, taken: Column, start: Column) -> Column:
    """The first place from ``start`` where needle stands in hay and touches no taken [s, e), or null."""
    n, m = F.size(hay), F.size(needle)
    places = F.when((m > 0) & (m <= n), F.sequence(F.lit(0), F.greatest(n - m, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    free = lambda i: ~F.exists(taken, lambda q: (q["s"] < i + m) & (i < q["e"]))
    return F.get(F.filter(places, lambda i: (i >= start) & (F.slice(hay, i + 1, m) == needle) & free(i)), 0)


def align(hay: Column, blocks: Column) -> Column:
    """For each block (array of tokens) the [s, e) where it stands verbatim in hay, or null.

    Blocks are placed in order, each at the first free place at or after the end of
    the one placed before it, else at the first free place at all. Blocks without
    tokens are not placed. Tokens without spaces, as all that tokenize() makes, are looked for in the joined
    text; others are compared token by token.
    """
    odd = lambda c: F.exists(c, lambda t: t.isNull() | (t == "") | F.contains(t, F.lit(" ")))
    return F.when(odd(hay) | F.exists(blocks, odd), _align_tokens(hay, blocks)).otherwise(_align_text(hay, blocks))


def _align_text(hay: Column, blocks: Column) -> Column:
    """align() by searches in the page's text, a space around each token; what is placed is struck out by spaces, which no block has in a row."""
    kind = "array<struct<s:int,e:int>>"
    whole = F.concat(F.lit(" "), F.array_join(hay, " "), F.lit(" "))
    at = lambda sub, text, pos: F.call_function("locate", sub, text, pos)
    bound = lambda c, f: F.get(F.transform(F.array(c), f), 0)

    def walk(orig: Column) -> Column:
        start = F.struct(orig.alias("left"), F.lit(1).alias("cur"), F.array().cast(kind).alias("spans"))

        def step(acc: Column, b: Column) -> Column:
            def put(p: Column, own: Column) -> Column:
                n = F.length(own) - 2
                before = orig.substr(F.lit(1), p)
                s = F.length(before) - F.length(F.replace(before, F.lit(" "), F.lit(""))) - 1
                struck = F.concat(acc["left"].substr(F.lit(1), p), F.repeat(F.lit(" "), n), acc["left"].substr(p + 1 + n, F.length(orig)))
                found = bound(s, lambda i: F.struct(i.cast("int").alias("s"), (i + F.size(b)).cast("int").alias("e")))
                return F.when(p > 0, F.struct(struck.alias("left"), (p + n + 1).alias("cur"), F.concat(acc["spans"], F.array(found)).alias("spans"))).otherwise(
                    F.struct(acc["left"].alias("left"), acc["cur"].alias("cur"), F.concat(acc["spans"], F.array(F.lit(None).cast("struct<s:int,e:int>"))).alias("spans"))
                )

            def search(own: Column) -> Column:
                later = F.nullif(at(own, acc["left"], acc["cur"]), F.lit(0))
                place = F.when(F.size(b) > 0, F.coalesce(later, at(own, acc["left"], F.lit(1)))).otherwise(F.lit(0))
                return bound(place, lambda p: put(p, own))

            return bound(F.concat(F.lit(" "), F.array_join(b, " "), F.lit(" ")), search)

        return F.aggregate(blocks, start, step, lambda acc: acc["spans"])

    return bound(whole, walk)


def _align_tokens(hay: Column, blocks: Column) -> Column:
    """align() by comparing slices of tokens, whatever they hold."""
    kind = "array<struct<s:int,e:int>>"
    start = F.struct(F.lit(0).alias("cur"), F.array().cast(kind).alias("spans"))

    def step(acc: Column, b: Column) -> Column:
        taken = F.filter(acc["spans"], lambda q: q.isNotNull())
        every = F.when((F.size(b) > 0) & (F.size(b) <= F.size(hay)), F.sequence(F.lit(0), F.greatest(F.size(hay) - F.size(b), F.lit(0)))).otherwise(F.array().cast("array<int>"))
        fits = F.filter(every, lambda i: (F.get(hay, i) == F.get(b, 0)) & (F.slice(hay, i + 1, F.size(b)) == b) & ~F.exists(taken, lambda q: (q["s"] < i + F.size(b)) & (i < q["e"])))
        chosen = F.transform(F.array(fits), lambda c: F.coalesce(F.get(F.filter(c, lambda i: i >= acc["cur"]), 0), F.get(c, 0)))
        placed = F.transform(
            chosen,
            lambda h: F.struct(
                F.when(h.isNull(), acc["cur"]).otherwise(h + F.size(b)).alias("cur"),
                F.concat(acc["spans"], F.array(F.when(h.isNotNull(), F.struct(h.cast("int").alias("s"), (h + F.size(b)).cast("int").alias("e"))))).alias("spans"),
            ),
        )
        return F.get(placed, 0)

    return F.aggregate(blocks, start, step, lambda acc: acc["spans"])


def pages_of(tokens: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows (book, page_idx, hay, blocks): a page's tokens and its blocks (index, id, tokens, math) in order.

    tokens: (book, page_idx, tokens); blocks: (book, page_idx, index, id, tokens, math).
    A page without blocks may be a row with a null index. ``text_page`` and ``block_page`` tell which side has the page.
    """
    own = F.when(F.col("index").isNotNull(), F.struct("index", "id", "tokens", "math"))
    listed = blocks.groupBy(*KEYS).agg(F.array_sort(F.collect_list(own)).alias("blocks"))  # nulls are not collected
    kind = "array<struct<index:int,id:string,tokens:array<string>,math:boolean>>"
    rows = tokens.withColumnRenamed("tokens", "hay").join(listed, list(KEYS), "full_outer")
    sides = [F.col("hay").isNotNull().alias("text_page"), F.col("blocks").isNotNull().alias("block_page")]
    return rows.select(*KEYS, F.coalesce("hay", F.array().cast("array<string>")).alias("hay"), F.coalesce(F.col("blocks").cast(kind), F.array().cast(kind)).alias("blocks"), *sides)


def aligned(pages: DataFrame) -> DataFrame:
    """pages_of() rows with ``spans``: one [s, e) or null per block.

    The array of one result is exploded, so that no later expression, least of all
    the body of a lambda, can be given the alignment itself to compute again.
    """
    spans = align(F.col("hay"), F.transform("blocks", lambda b: b["tokens"]))
    return pages.select("*", F.explode(F.array(spans)).alias("spans"))


COUNTS = ("pdf_tokens", "md_tokens", "matched_blocks", "unmatched_blocks")


def counts(aligned_pages: DataFrame) -> DataFrame:
    """Rows (book, page_idx, pdf_tokens, md_tokens, matched_blocks, unmatched_blocks)."""
    return _counted(aligned_pages).select(*KEYS, *COUNTS)


def _counted(aligned_pages: DataFrame) -> DataFrame:
    sizes = F.aggregate("blocks", F.lit(0), lambda a, b: a + F.size(b["tokens"]))
    rows = aligned_pages.withColumn("pairs", F.zip_with("blocks", "spans", lambda b, q: F.struct(F.size(b["tokens"]).alias("n"), q.alias("q"))))
    return rows.select(
        *aligned_pages.columns,
        F.size("hay").alias("pdf_tokens"),
        sizes.alias("md_tokens"),
        F.size(F.filter("pairs", lambda x: x["q"].isNotNull())).alias("matched_blocks"),
        F.size(F.filter("pairs", lambda x: (x["n"] > 0) & x["q"].isNull())).alias("unmatched_blocks"),
    )


def _merge(changes: list[tuple]) -> list[list[int]]:
    """Differing ranges, joined where at most GAP tokens of the first sequence lie between them."""
    out: list[list[int]] = []
    for kind, i1, i2, j1, j2 in changes:
        if kind != "equal":
            if out and i1 <= out[-1][1] + GAP:
                out[-1][1], out[-1][3] = i2, j2
            else:
                out.append([i1, i2, j1, j2])
    return out


def _hunks(page: dict) -> Iterator[tuple]:
    """The hunks of one page: position, anchor, both texts with context, whether the anchor has inline math, both texts without."""
    hay, blocks, spans = page["hay"], page["blocks"], page["spans"]
    placed = [(s["e"], b["id"], s["s"]) for b, s in zip(blocks, spans) if s is not None]
    covered = {i for e, _, s in placed for i in range(s, e)}
    left = [(i, t) for i, t in enumerate(hay) if i not in covered]
    right = [(b["id"], t) for b, s in zip(blocks, spans) if s is None for t in b["tokens"]]
    p, m = [t for _, t in left], [t for _, t in right]
    with_math = {b["id"] for b in blocks if b["math"]}
    for i1, i2, j1, j2 in _merge(difflib.SequenceMatcher(None, p, m, autojunk=False).get_opcodes()):
        behind = max(((e, b) for e, b, _ in placed if e <= left[i1][0]), default=None) if i1 < len(left) else None
        if j1 < j2:
            anchor = right[j1][0]
        elif behind:
            anchor = behind[1]
        elif j1:
            anchor = right[j1 - 1][0]
        else:
            anchor = next((b["id"] for b in blocks if len(b["tokens"])), f"p{page['page_idx']:03d}-none")
        yield i1, anchor, " ".join(p[max(0, i1 - CONTEXT) : i2 + CONTEXT]), " ".join(m[max(0, j1 - CONTEXT) : j2 + CONTEXT]), anchor in with_math, " ".join(p[i1:i2]), " ".join(m[j1:j2])


#: Pages that are Python objects at a time, and bytes of one Arrow batch: these bound a worker's memory, whatever the input.
PAGES_AT_ONCE, ARROW_BYTES = 64, 16 << 20
HUNK = "struct<seq:int,anchor:string,pdf_text:string,md_text:string,math:boolean,pdf_part:string,md_part:string>"


def _residue() -> Column:
    """Whether alignment leaves tokens on either side of a page."""
    placed = F.aggregate(F.filter("spans", lambda s: s.isNotNull()), F.lit(0), lambda a, s: a + s["e"] - s["s"])
    unplaced = F.exists(F.zip_with("blocks", "spans", lambda b, q: (F.size(b["tokens"]) > 0) & q.isNull()), lambda x: x)
    return (placed < F.size("hay")) | unplaced


def _bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ARROW_BYTES; a smaller bound of the session's stays."""
    own = int(spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch())
    if not 0 < own <= ARROW_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def with_hunks(aligned_pages: DataFrame) -> DataFrame:
    """aligned_pages, its array columns replaced by the hunks of each page: one evaluation for whatever is counted of them.

    The matching blocks of the longest-matching-subsequence differ have no simple
    relational form, so pages go to Python in Arrow batches, the texts only of those with
    a residue on either side; no shuffle, since a row holds its page.
    """
    parts = ["hay", "blocks", "spans"]
    kept = [c for c in aligned_pages.columns if c not in (*parts, *KEYS)]
    _bounded_batches(aligned_pages.sparkSession)
    work = aligned_pages.withColumn("work", _residue())
    work = work.select(*KEYS, *kept, *(F.when(F.col("work"), F.col(c)).alias(c) for c in parts))
    out = T.StructType([*work.select(*KEYS, *kept).schema.fields, T.StructField("hunks", T.ArrayType(T._parse_datatype_string(HUNK)))])
    kind = to_arrow_type(out["hunks"].dataType)
    fields = [f.name for f in out["hunks"].dataType.elementType.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(k, PAGES_AT_ONCE) for whole in batches for k in range(0, whole.num_rows, PAGES_AT_ONCE)):
            same = batch.select([*KEYS, *kept])
            pages = batch.select(["page_idx", *parts]).to_pylist()
            found = [[dict(zip(fields, (k, *h[1:]), strict=True)) for k, h in enumerate(_hunks(page))] if page["hay"] is not None else [] for page in pages]
            yield pa.RecordBatch.from_arrays([*same.columns, pa.array(found, type=kind)], names=[*same.schema.names, "hunks"])

    return work.mapInArrow(run, out)


def hunks(aligned_pages: DataFrame) -> DataFrame:
    """Rows (book, page_idx, seq, anchor, pdf_text, md_text, math, pdf_part, md_part): what is left after alignment, as differences.

    The texts have context around the parts that differ; math tells whether the
    anchor has inline math.
    """
    work = aligned_pages.filter(_residue()).select(*KEYS, "hay", "blocks", "spans")
    return with_hunks(work).select(*KEYS, F.explode("hunks").alias("h")).select(*KEYS, "h.*")


def hunks_per_page(found: DataFrame) -> DataFrame:
    return found.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("hunks"))


def result(aligned_pages: DataFrame, first_printed: DataFrame | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """One row per book: its number of pages, the six counts, and its hunks in page order.

    first_printed: (book, first); a hunk's page is printed from there, else counted from 0.
    sizes: (book, page_idx, width, height, model_width, model_height). A book whose sides have
    different numbers of pages, or a page whose two sizes differ by more than a point, is
    an error when its row is evaluated.
    """
    rows = with_hunks(_counted(aligned_pages))
    off = F.lit(None).cast("int")
    if sizes is not None:
        rows = rows.join(sizes.select(*KEYS, "width", "height", "model_width", "model_height"), list(KEYS), "left")
        off = F.when((F.abs(F.col("width") - F.col("model_width")) > 1) | (F.abs(F.col("height") - F.col("model_height")) > 1), F.col("page_idx"))
    own = F.struct("page_idx", F.col("hunks").alias("h"))
    per = rows.groupBy("book").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if("text_page").alias("text_pages"), F.count_if("block_page").alias("block_pages"), F.min(off).alias("off"),
        *(F.sum(c).alias(c) for c in COUNTS), F.array_sort(F.collect_list(F.when(F.size("hunks") > 0, own))).alias("listed"),
    )
    if first_printed is not None:
        per = per.join(first_printed.select("book", "first"), "book", "left")
    else:
        per = per.withColumn("first", F.lit(0))
    problem = F.when(F.col("text_pages") != F.col("block_pages"), F.format_string("%s: %d pages of text and %d of blocks", "book", "text_pages", "block_pages")).when(
        F.col("off").isNotNull(), F.format_string("%s: page %d has two sizes", "book", "off")
    )
    first = F.coalesce("first", F.lit(0))
    flat = F.flatten(F.transform("listed", lambda p: F.transform(p["h"], lambda x: F.struct((first + p["page_idx"]).alias("page"), x["anchor"].alias("anchor"), x["pdf_text"].alias("pdf_text"), x["md_text"].alias("md_text"), x["math"].alias("math")))))
    per = per.withColumn("all", flat)
    with_math = F.size(F.filter("all", lambda x: x["math"]))
    return per.select(
        "book",
        # checked where the pages are counted, so no projection can lose the check while it keeps them
        F.when(problem.isNotNull(), F.raise_error(problem).cast("long")).otherwise(F.col("pages")).alias("pages"),
        F.struct(*COUNTS, F.size("all").alias("hunks"), with_math.alias("hunks_inline_math")).alias("counts"),
        F.transform("all", lambda x: F.struct(x["page"].alias("page"), x["anchor"].alias("anchor"), x["pdf_text"].alias("pdf_text"), x["md_text"].alias("md_text"))).alias("hunks"),
    )


def first_hunks(found: DataFrame, n: int = 20) -> DataFrame:
    """The first n hunks in book and page order, for display."""
    return found.orderBy("book", "page_idx", "seq").limit(n)


def check_pages(tokens: DataFrame, blocks: DataFrame, page_sizes: DataFrame | None = None, boxes: DataFrame | None = None) -> None:
    """Both extractions of a book have the same number of pages, and page sizes agree within a point; else AlignError."""
    a = tokens.groupBy("book").agg(F.countDistinct("page_idx").alias("a"))
    b = blocks.groupBy("book").agg(F.countDistinct("page_idx").alias("b"))
    bad = a.join(b, "book", "full_outer").filter("not (a <=> b)").limit(1).collect()
    if bad:
        raise AlignError(f"{bad[0]['book']}: {bad[0]['a']} pages of text and {bad[0]['b']} of blocks")
    if page_sizes is not None and boxes is not None:
        o = boxes.select(*KEYS, F.col("width").alias("w"), F.col("height").alias("h"))
        off = page_sizes.join(o, list(KEYS)).filter("abs(width - w) > 1 or abs(height - h) > 1").limit(1).collect()
        if off:
            raise AlignError(f"{off[0]['book']}: page {off[0]['page_idx']} has two sizes")
