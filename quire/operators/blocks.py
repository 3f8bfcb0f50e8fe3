"""Typed blocks and spans from per-page JSON.

A page file is an array of pages, a page an array of blocks. It is parsed with a
declared schema; a block's nested content stays text until its type says which
key holds spans, captions, math, markup or a crop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.errors import BlockError
from quire.functions.text import MD_RULES, Rule, flatten_latex, normalize, tokenize
from quire.schemas import CAPTIONED, MODEL_MADE, RAW_PAGES, SPANS, TEXT, TYPES

#: All the keys that a block's content can have, read at once.
CONTENT = (
    "paragraph_content {s}, title_content {s}, level int, list_type string, table_type string, list_items array<struct<item_content:{s}>>, "
    "page_header_content {s}, page_footer_content {s}, page_number_content {s}, page_footnote_content {s}, page_aside_text_content {s}, "
    "math_content string, html string, content string, image_source struct<path:string>, "
    "table_caption {s}, table_footnote {s}, chart_caption {s}, chart_footnote {s}, image_caption {s}, image_footnote {s}"
).format(s=SPANS)


def block_id(page_idx: Column, index: Column) -> Column:
    return F.format_string("p%03d-b%03d", page_idx, index)


def spans(c: Column) -> Column:
    """Without spans that have no content; null gives none."""
    return F.coalesce(F.filter(c, lambda s: F.coalesce(s["content"], F.lit("")) != ""), F.array().cast(SPANS))


def joined(groups: Column) -> Column:
    """Groups of spans in one array, with a line end as a text span between groups that are not empty."""
    line = F.array(F.struct(F.lit("text").alias("type"), F.lit("\n").alias("content")))
    full = F.filter(groups, lambda g: F.size(g) > 0)
    return F.flatten(F.transform(full, lambda g, i: F.when(i > 0, F.concat(line, g)).otherwise(g)))


def raw_blocks(files: DataFrame, json: str = "value") -> DataFrame:
    """files with page_idx, index and the raw block; a page without blocks is one row with a null block.

    Text that is not a list of pages (each a list of blocks) is an error when evaluated.
    """
    read = F.from_json(json, RAW_PAGES)
    listed = F.try_parse_json(json)
    # from_json reads a single value as a list of one; the text itself tells
    pages = F.try_variant_get(listed, "$", "array<variant>")
    shaped = F.schema_of_variant(listed).startswith("ARRAY") & ~F.exists(pages, lambda p: ~F.coalesce(F.schema_of_variant(p), F.lit("")).startswith("ARRAY"))
    sound = F.coalesce(shaped, F.lit(False)) & read.isNotNull()
    checked = F.when(sound, read).otherwise(F.raise_error(F.concat(F.lit(f"{BlockError.__name__}: not a list of pages: "), F.substring(F.coalesce(F.col(json), F.lit("null")), 1, 80))).cast(RAW_PAGES))
    pages = files.select(*(c for c in files.columns if c != json), F.posexplode_outer(checked).alias("page_idx", "blocks_"))
    return pages.select(*(c for c in pages.columns if c != "blocks_"), F.posexplode_outer("blocks_").alias("index", "raw"))


def parse(raw: DataFrame) -> DataFrame:
    """raw_blocks() rows as blocks; an unknown type or a missing box is an error that names page and block.

    Pages without blocks are kept, with a null type.
    """
    c = F.from_json("raw.content", CONTENT)
    rows = raw.withColumn("c", c).withColumn("type", F.col("raw.type"))
    own = {t: spans(F.col(f"c.{t}_content")) for t in TEXT if t != "list"}
    listed = joined(F.transform(F.coalesce("c.list_items", F.array().cast(f"array<struct<item_content:{SPANS}>>")), lambda i: spans(i["item_content"])))
    none = F.array().cast(SPANS)
    body, captions = F.when(F.col("type") == "list", listed), none
    for t, s in own.items():
        body = body.when(F.col("type") == t, s)
    for t in CAPTIONED:
        both = joined(F.array(spans(F.col(f"c.{t}_caption")), spans(F.col(f"c.{t}_footnote"))))
        captions = F.when(F.col("type") == t, both).otherwise(captions)
    here = F.concat(F.lit("page "), F.col("page_idx"), F.lit(" block "), F.col("index"))
    problem = (
        F.when(F.col("raw").isNull(), F.lit(None))
        .when(F.col("type").isNull() | ~F.col("type").isin(*TYPES), F.concat(F.lit("unknown type "), F.coalesce("type", F.lit("null")), F.lit(" at "), here))
        .when(F.col("raw.bbox").isNull() | (F.size("raw.bbox") != 4), F.concat(F.lit("no box at "), here))
    )
    # checked where the id is made, so no projection can lose the check while it keeps the block
    identity = F.when(problem.isNotNull(), F.raise_error(F.concat(F.lit(f"{BlockError.__name__}: "), problem)).cast("string")).when(F.col("raw").isNotNull(), block_id(F.col("page_idx"), F.col("index")))
    of_type = lambda *types: F.col("type").isin(*types)
    return rows.select(
        *(x for x in raw.columns if x not in ("raw", "page_idx", "index")),
        identity.alias("id"),
        "index",
        "type",
        "page_idx",
        F.transform("raw.bbox", lambda v: F.bround(v).cast("int")).alias("bbox"),
        F.coalesce(body, none).alias("spans"),
        captions.alias("captions"),
        F.when(of_type("title"), F.col("c.level")).alias("level"),
        F.coalesce(F.when(of_type("equation_interline"), F.col("c.math_content")), F.lit("")).alias("math"),
        F.coalesce(F.when(of_type("table"), F.col("c.html")), F.lit("")).alias("html"),
        F.coalesce(F.when(of_type("chart", "image"), F.col("c.content")), F.lit("")).alias("content"),
        F.coalesce(F.when(of_type("table", "equation_interline", "chart", "image"), F.col("c.image_source.path")), F.lit("")).alias("crop"),
        F.when(of_type("list"), F.col("c.list_type")).when(of_type("table"), F.col("c.table_type")).otherwise(F.col("raw.sub_type")).alias("sub_type"),
    )


def _texts(c: Column) -> Column:
    return F.array_join(F.transform(F.filter(c, lambda s: s["type"] == "text"), lambda s: s["content"]), "")


def text(spans_: str = "spans") -> Column:
    """The text spans of a block, joined by nothing."""
    return _texts(F.col(spans_))


def caption_text() -> Column:
    return _texts(F.col("captions"))


def inline_math() -> Column:
    return F.transform(F.filter(F.concat("spans", "captions"), lambda s: s["type"] == "equation_inline"), lambda s: s["content"])


def model_made() -> Column:
    """Blocks whose content a model wrote: some types, and images with a description."""
    return F.col("type").isin(*MODEL_MADE) | ((F.col("type") == "image") & (F.trim("content") != ""))


def block_text() -> Column:
    """Body spans of a text block, captions of a captioned one; math flattened, spans joined by a space."""
    own = F.when(F.col("type").isin(*TEXT), F.col("spans")).when(F.col("type").isin(*CAPTIONED), F.col("captions"))
    shown = F.transform(own, lambda s: F.when(s["type"] == "equation_inline", flatten_latex(s["content"])).otherwise(s["content"]))
    return F.coalesce(F.array_join(shown, " "), F.lit(""))


def with_tokens(blocks: DataFrame, rules: tuple[Rule, ...] = MD_RULES, out: str = "tokens") -> DataFrame:
    """blocks with their normalized tokens, computed once."""
    named = blocks.withColumn("text_", block_text())
    return named.withColumn(out, tokenize(normalize(F.col("text_"), rules))).drop("text_")


def on_page(blocks: DataFrame, page_idx: int) -> DataFrame:
    return blocks.filter(F.col("page_idx") == page_idx)
