"""The engine's input tables made from the test tables.

The SQL is shared by Spark and the oracle; only what the dialects write
differently (unnesting) is given twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

LINES_SPARK = "SELECT doc_id, lang, source, n_chars, n, line FROM documents LATERAL VIEW posexplode(split(text, '\\n')) AS n, line"
LINES_DUCK = "SELECT doc_id, lang, source, n_chars, unnest(range(len(l)))::INT AS n, unnest(l) AS line FROM (SELECT *, string_split(text, chr(10)) AS l FROM documents)"

#: A book per source: parts by language, chapters by document, sections by line.
OUTLINE = """
SELECT book, CAST(row_number() OVER w - 1 AS INT) AS idx, CAST(level AS INT) AS level, title,
  CAST(1 + floor(coalesce(sum(chars) OVER (PARTITION BY book ORDER BY lang, doc_id, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 2000) AS INT) AS page
FROM (
  SELECT source AS book, lang, -1 AS doc_id, 0 AS ord, 1 AS level, 'Part ' || lang AS title, 0 AS chars FROM documents GROUP BY source, lang
  UNION ALL SELECT source, lang, doc_id, 1, 2, CAST(k AS STRING) || ': ' || lang || ' document ' || CAST(doc_id AS STRING), n_chars FROM numbered
  UNION ALL SELECT l.source, l.lang, l.doc_id, 2 + n, 3, CASE n % 3 WHEN 0 THEN CAST(k AS STRING) || '-' || CAST(n + 1 AS STRING) || ': ' WHEN 1 THEN ' ' || CAST(k AS STRING) || '.' || CAST(n + 1 AS STRING) || ' ' ELSE '' END || line, 0
    FROM doc_lines l JOIN numbered c ON l.doc_id = c.doc_id WHERE trim(line) <> ''
) WINDOW w AS (PARTITION BY book ORDER BY lang, doc_id, ord)"""
NUMBERED = "SELECT doc_id, source, lang, n_chars, row_number() OVER (PARTITION BY source ORDER BY lang, doc_id) AS k FROM documents"
BOOK_PAGES = "SELECT source AS book, CAST(1 + floor(sum(n_chars) / 2000) AS INT) AS page_count FROM documents GROUP BY source"
CONFIG = "SELECT DISTINCT source AS book, 2 AS chapter_level, '^([0-9]+): *' AS chapter_pattern FROM documents"
#: Chapters whose range is given: one that the outline has, and one that it lacks.
OVERRIDES = " UNION ALL ".join(f"SELECT DISTINCT source AS book, {n} AS number, {n} AS first, {n + 4} AS last FROM documents WHERE source IN ('src1', 'src2')" for n in (2, 99999))
#: Reading lists of every third book: chapters whose document has a good label.
READINGS = """SELECT n.source AS book, CAST(n.k AS INT) AS number FROM numbered n JOIN labels l ON n.doc_id = l.doc_id
WHERE l.quality = 1 AND n.source IN ('src0', 'src3', 'src6', 'src9', 'src12')"""
#: Regions, nations and customers as an outline that skips levels.
WORLD = """
SELECT 'world' AS book, CAST(row_number() OVER (ORDER BY r, n, c) - 1 AS INT) AS idx, CAST(level AS INT) AS level, title, CAST(1 + r * 100 + n AS INT) AS page FROM (
  SELECT r_regionkey AS r, -1 AS n, -1 AS c, 1 AS level, r_name AS title FROM region
  UNION ALL SELECT n_regionkey, n_nationkey, -1, 2, CAST(n_nationkey AS STRING) || ' ' || n_name FROM nation
  UNION ALL SELECT n_regionkey, n_nationkey, c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 4 ELSE 3 END,
    CASE WHEN c_custkey % 3 = 0 THEN CAST(n_nationkey AS STRING) || '.' || CAST(c_custkey AS STRING) || ' ' ELSE '' END || c_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""
#: The same hierarchy with unnumbered regions, whose first numbered child gives the number.
UNNUMBERED = """
SELECT 'world' AS book, CAST(row_number() OVER (ORDER BY r, n, c) - 1 AS INT) AS idx, CAST(level AS INT) AS level, title, CAST(1 + r * 100 + n AS INT) AS page FROM (
  SELECT r_regionkey AS r, -1 AS n, -1 AS c, 1 AS level, CASE WHEN r_regionkey = 2 THEN 'Chapter 2 ' ELSE ' ' END || r_name AS title FROM region
  UNION ALL SELECT n_regionkey, n_nationkey, -1, 2, CASE WHEN n_nationkey % 4 = 0 THEN n_name ELSE CAST(n_regionkey + 1 AS STRING) || '.' || CAST(n_nationkey AS STRING) || ' ' || n_name END FROM nation
  UNION ALL SELECT n_regionkey, n_nationkey, c_custkey, 3, c_name FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""
#: Nations as chapters whose customers' numbers stand apart from their names, some under the wrong chapter.
DETACHED = """
SELECT 'world' AS book, CAST(row_number() OVER (ORDER BY n, c, o) - 1 AS INT) AS idx, CAST(level AS INT) AS level, title, CAST(1 + n AS INT) AS page FROM (
  SELECT n_nationkey AS n, -1 AS c, 0 AS o, 1 AS level, CASE WHEN n_nationkey % 7 = 6 THEN n_name ELSE 'Chapter ' || CAST(n_nationkey AS STRING) || ' ' || n_name END AS title FROM nation
  UNION ALL SELECT c_nationkey, c_custkey, 0, 2, CASE WHEN c_custkey % 4 = 0 THEN c_name || ' ' || CAST(c_nationkey AS STRING) || '.' || CAST(c_custkey AS STRING) ELSE c_name || '  heading' END FROM customer
  UNION ALL SELECT c_nationkey, c_custkey, 1, 2, CAST((CASE WHEN c_custkey % 11 = 1 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END) AS STRING) || '.' || CAST(c_custkey AS STRING) FROM customer WHERE c_custkey % 4 = 1
  UNION ALL SELECT c_nationkey, c_custkey, 2, 3, 'detail of ' || c_name FROM customer WHERE c_custkey % 6 = 1
  UNION ALL SELECT c_nationkey, c_custkey, 3, 2, CAST(c_nationkey AS STRING) || '.' || CAST(c_custkey + 1 AS STRING) || ' ' || CAST(c_nationkey AS STRING) || '.' || CAST(c_custkey + 2 AS STRING) FROM customer WHERE c_custkey % 13 = 5
)"""
#: Pages of text with a printed number in front and behind.
PAGE_TEXT = """
SELECT source AS book, CAST(k - 1 AS INT) AS page_idx, CASE WHEN k % 10 = 0 THEN '' ELSE CAST(k - 3 AS STRING) || chr(10) || text || chr(10) || 'Chapter ' || CAST(k % 9 AS STRING) || ' Some head ' || CAST(k - 3 AS STRING) END AS text
FROM (SELECT source, text, row_number() OVER (PARTITION BY source ORDER BY lang, doc_id) AS k FROM documents)"""
LABELS = "SELECT source AS book, CAST(k - 1 AS INT) AS page_idx, CASE WHEN k % 3 = 0 THEN CAST(k + 100 AS STRING) WHEN k % 3 = 1 THEN 'iv' END AS label, 7 AS page_offset FROM numbered"
#: Documents with the glyphs that the rules are about.
GLYPHS = """
SELECT doc_id, '•' || ' item' || chr(10) || 'P A R' || chr(9) || 'T  I I' || chr(10) || 'ﬁn ½ Å a​b' || chr(10) || '- ' || replace(replace(text, ' the ', ' “the” '), ' of ', ' soft' || chr(173) || chr(10) || 'hyphen ex-' || chr(10) || 'ample a-b-c – <sup>2</sup> ') AS text FROM documents"""
#: Typed blocks from lines: the type goes by the line's place.
BLOCKS = """
SELECT source AS book, doc_id, n,
  CASE n % 10 WHEN 0 THEN 'title' WHEN 1 THEN 'paragraph' WHEN 2 THEN 'list' WHEN 3 THEN 'page_header' WHEN 4 THEN 'page_footer' WHEN 5 THEN 'page_number'
    WHEN 6 THEN 'table' WHEN 7 THEN 'equation_interline' WHEN 8 THEN 'image' ELSE 'chart' END AS type, line FROM doc_lines"""
#: Running lines: the first line of a document as its page's head.
HEADS = """
SELECT source AS book, 'ch01' AS chapter, 'p' || CAST(doc_id AS STRING) || '-' || CAST(n AS STRING) AS id, CASE WHEN n = 0 THEN 'page_header' WHEN n = 1 THEN 'page_footer' ELSE 'paragraph' END AS type,
  CAST(doc_id AS INT) AS page_idx, CASE WHEN n = 0 AND doc_id % 17 = 0 THEN 'Page ' || CAST(doc_id AS STRING) WHEN n = 0 AND doc_id % 19 = 0 THEN 'Chapter 3 ' || line ELSE line END AS text FROM doc_lines"""
#: The running lines alone: no other line is split off.
RUNNING_SPARK = """
SELECT source AS book, 'ch01' AS chapter, 'p' || CAST(doc_id AS STRING) || '-' || CAST(n AS STRING) AS id, CASE WHEN n = 0 THEN 'page_header' ELSE 'page_footer' END AS type, CAST(doc_id AS INT) AS page_idx,
  CASE WHEN n = 0 AND doc_id % 17 = 0 THEN 'Page ' || CAST(doc_id AS STRING) WHEN n = 0 AND doc_id % 19 = 0 THEN 'Chapter 3 ' || line ELSE line END AS text
FROM (SELECT source, doc_id, slice(split(text, '\\n', 3), 1, 2) AS two FROM documents) LATERAL VIEW posexplode(two) AS n, line"""
WORDS_SPARK = "SELECT CAST(source AS STRING) AS book, CAST(doc_id AS INT) AS page_idx, n, k, word FROM doc_lines LATERAL VIEW posexplode(split(line, ' ')) AS k, word"
WORDS_DUCK = "SELECT source AS book, doc_id::INT AS page_idx, n, unnest(range(len(w)))::INT AS k, unnest(w) AS word FROM (SELECT *, string_split(line, ' ') AS w FROM doc_lines)"
#: Words on a grid, and a box on every fourth page that masks some.
BOXED = "SELECT book, page_idx, n * 100000 + k AS ord, 10.0 * k AS x0, 12.0 * n AS y0, 10.0 * k + 8 AS x1, 12.0 * n + 10 AS y1, word, CAST(floor(n / 3) AS INT) AS block_no, n AS line_no FROM words"
REGIONS = "SELECT source AS book, CAST(doc_id AS INT) AS page_idx, CASE WHEN doc_id % 8 = 0 THEN 'table' WHEN doc_id % 8 = 4 THEN 'chart' ELSE 'paragraph' END AS type, doc_id % 300 AS b0, 10 AS b1, 500 + doc_id % 300 AS b2, 200 AS b3 FROM documents WHERE doc_id % 2 = 0"

#: Places of the last sort key that one part of a book of customers has.
PART = 1 << 14


def _dealt(text: str, groups: str, order: str) -> str:
    """The same rows, numbered in parts (by the groups and the first key of the order) instead of in one task."""
    select, inner = text.split(" FROM (\n", 1)
    whole = f"row_number() OVER (ORDER BY {groups}, {order})"
    if whole not in select:
        raise ValueError(f"no {whole}")
    parts = [*groups.split(", "), "part"]
    keys, named = ", ".join(parts), ", ".join(f"{p} AS {p}_" for p in parts)
    return (
        f"WITH dealt AS (SELECT *, CAST(floor({order.split(',')[0]} / {PART}) AS INT) AS part FROM (\n{inner}), sizes AS (SELECT {keys}, count(*) AS size FROM dealt GROUP BY {keys}), "
        f"starts AS (SELECT {named}, coalesce(sum(size) OVER (ORDER BY {keys} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM sizes) "
        + select.replace(whole, f"start + row_number() OVER (PARTITION BY {keys} ORDER BY {order})")
        + f" FROM dealt JOIN starts ON {' AND '.join(f'{p} <=> {p}_' for p in parts)}"
    )


#: Relations that others read, in order.
SHARED = {"numbered": NUMBERED, "outline": OUTLINE, "book_pages": BOOK_PAGES, "config": CONFIG, "overrides": OVERRIDES, "readings": READINGS, "world": WORLD, "unnumbered": UNNUMBERED, "detached": DETACHED, "page_text": PAGE_TEXT, "page_labels": LABELS, "glyphs": GLYPHS, "typed": BLOCKS, "heads": HEADS, "boxed": BOXED, "regions": REGIONS}
READS = {
    "doc_lines": ["documents"], "numbered": ["documents"], "outline": ["documents", "doc_lines", "numbered"], "book_pages": ["documents"], "config": ["documents"], "overrides": ["documents"],
    "readings": ["numbered", "labels"], "world": ["region", "nation", "customer"], "unnumbered": ["region", "nation", "customer"], "detached": ["nation", "customer"], "page_text": ["documents"],
    "page_labels": ["numbered"], "glyphs": ["documents"], "typed": ["doc_lines"], "heads": ["doc_lines"], "running": ["documents"], "words": ["doc_lines"], "boxed": ["words"], "regions": ["documents"],
}
SPARK = {"doc_lines": LINES_SPARK, "words": WORDS_SPARK, "running": RUNNING_SPARK, "world": _dealt(WORLD, "r, n", "c"), "unnumbered": _dealt(UNNUMBERED, "r, n", "c"), "detached": _dealt(DETACHED, "n", "c, o")}
DUCK = {"doc_lines": LINES_DUCK, "words": WORDS_DUCK}


def _order(name: str, seen: list[str]) -> list[str]:
    if name in READS and name not in seen:
        for r in READS[name]:
            _order(r, seen)
        seen.append(name)
    return seen


def with_clause(*names: str) -> str:
    """The WITH list of DuckDB SQL that defines relations and all that they read."""
    seen: list[str] = []
    for n in names:
        _order(n, seen)
    return ",\n".join(f"{n} AS ({(SHARED | DUCK)[n]})" for n in seen)


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A relation as a DataFrame, by the same SQL."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    seen = _order(name, [])
    defined = ", ".join(f"{n} AS ({(SHARED | SPARK)[n]})" for n in seen)
    base = sorted({r for n in seen for r in READS[n] if r in TABLES})
    text = f"WITH {defined} SELECT * FROM {name}"
    views = {t: f"quire_{t}" for t in base}
    for t, v in views.items():
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(v)
    inner = ", ".join(f"{t} AS (SELECT * FROM {v})" for t, v in views.items())
    return spark.sql(text.replace("WITH ", f"WITH {inner}, ", 1))


def page_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page file per document, its lines as typed blocks; every seventh document has a second page, which is blank."""
    t = relation(spark, sf_dir, "typed")
    text = lambda c: F.struct(F.lit("text").alias("type"), c.alias("content"))
    line = F.array(text(F.col("line")))
    math = F.array(text(F.col("line")), F.struct(F.lit("equation_inline").alias("type"), F.concat(F.lit("x _ {"), "n", F.lit("}")).alias("content")), text(F.lit(" end")), text(F.lit("")))
    of = lambda kind, v: F.when(F.col("type") == kind, v)
    path = F.when((F.col("type").isin("table", "equation_interline", "image", "chart")) & (F.col("n") % 4 != 0), F.struct(F.concat(F.lit("images/"), "n", F.lit(".jpg")).alias("path")))
    content = F.struct(
        of("title", line).alias("title_content"), of("title", F.col("n") % 3 + 1).alias("level"), of("paragraph", math).alias("paragraph_content"),
        of("list", F.array(F.struct(line.alias("item_content")), F.struct(F.array(text(F.lit("x"))).alias("item_content")))).alias("list_items"),
        of("list", F.lit("bulleted")).alias("list_type"), of("table", F.lit("grid")).alias("table_type"),
        of("page_header", line).alias("page_header_content"), of("page_footer", line).alias("page_footer_content"), of("page_number", line).alias("page_number_content"),
        of("equation_interline", F.col("line")).alias("math_content"), of("table", F.concat(F.lit("<t>"), "line")).alias("html"),
        F.when(F.col("type") == "chart", F.col("line")).when((F.col("type") == "image") & (F.col("doc_id") % 2 == 0), F.col("line")).alias("content"),
        of("table", line).alias("table_caption"), of("table", F.array(text(F.lit("note")))).alias("table_footnote"), of("image", line).alias("image_caption"), of("chart", line).alias("chart_footnote"), path.alias("image_source"),
    )
    box = F.array(F.col("n") % 50 + 0.5, F.col("n") % 40 + 1.5, F.col("n") + 2.4, F.col("n") + 100.5).cast("array<double>")
    sub = F.when(F.col("type") == "image", F.lit("photo")).when(F.col("type") == "title", F.lit("head")).when(F.col("type").isin("list", "table"), F.lit("not this"))
    block = F.struct("n", F.struct("type", box.alias("bbox"), sub.alias("sub_type"), content.alias("content")).alias("b"))
    pages = t.groupBy("book", "doc_id").agg(F.transform(F.array_sort(F.collect_list(block)), lambda x: x["b"]).alias("page"))
    both = F.when(F.col("doc_id") % 7 == 0, F.array("page", F.slice("page", 1, 0))).otherwise(F.array("page"))
    return pages.select("book", "doc_id", F.to_json(both).alias("value"))
