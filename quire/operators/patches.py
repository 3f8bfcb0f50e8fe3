"""Outline rewrite rules, applied in order; each takes an outline and gives the new one and its changes.

Rules never change a row in place: they compute new sort keys and titles, and
positions are numbered again. A rule that cannot apply raises PatchError before
anything else runs.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.errors import PatchError
from quire.functions.text import collapse, strip
from quire.operators.order import chunk, numbered, running
from quire.operators.outline import NUMBERED, SECTION, with_parent
from quire.sources.scratch import materialize

COLUMNS = ["book", "idx", "level", "title", "page"]
Result = tuple[DataFrame, DataFrame]


def _renumbered(rows: DataFrame, buckets: list[Column], *keys: str) -> DataFrame:
    return numbered(rows, "idx_", buckets, list(keys)).select("book", F.col("idx_").alias("idx"), "level", "title", "page")


def _changes(rows: DataFrame, *keys: str, first: str | None = None) -> DataFrame:
    """rows (book, level, page, old, new, note and sort keys) as numbered changes; keys are integers, in chunks by the first after ``first``."""
    buckets = [F.col(first)] if first else []
    return numbered(rows, "seq_", [*buckets, chunk(F.col(keys[0]))], list(keys)).select("book", F.col("seq_").alias("seq"), "level", "page", "old", "new", "note")


def number_from_children(outline: DataFrame, level: int) -> Result:
    """Titles without a number at a level get that of their first numbered section, as in ``5: Title``."""
    kids = with_parent(outline).filter("parent is not null").filter(F.col("title").rlike(SECTION))
    prefix = kids.groupBy("book", F.col("parent").alias("idx")).agg(F.min_by(F.regexp_extract("title", SECTION, 1).cast("int"), "idx").alias("n"))
    rows = outline.join(prefix, ["book", "idx"], "left")
    hit = (F.col("level") == level) & F.col("n").isNotNull() & ~F.col("title").rlike(NUMBERED)
    new = F.when(hit, F.format_string("%d: %s", "n", strip(F.col("title"))))
    rows = rows.withColumn("new", new)
    changes = _changes(rows.filter("new is not null").withColumn("old", F.col("title")).withColumn("note", F.lit("")), "idx")
    return rows.withColumn("title", F.coalesce("new", "title")).select(*COLUMNS), changes


def _java_replacement(replace: str) -> str:
    """Group references as in ``\\1`` become ``$1``; a dollar sign stays one."""
    out = replace.replace("$", "\\$")
    return re.sub(r"\\(?:g<(\w+)>|(\d+))", lambda m: f"${{{m[1]}}}" if m[1] and not m[1].isdigit() else f"${m[1] or m[2]}", out)


def rename(outline: DataFrame, level: int, match: str, replace: str) -> Result:
    """The first match of a pattern in each title at a level is replaced; no matching title at all is an error."""
    hit = (F.col("level") == level) & F.col("title").rlike(match)
    without = outline.groupBy("book").agg(F.max(hit).alias("any")).filter("not any").limit(1).collect()
    if without or outline.isEmpty():
        raise PatchError(f"no title at level {level} fits {match!r}, so there is nothing to rename")
    groups = re.compile(match).groups
    # everything before the first match is lazy and everything after it greedy, so one replacement hits the first match only
    shifted = re.sub(r"\$(\d+)", lambda m: f"${int(m[1]) + 1}" if m[1] != "0" else "$0", _java_replacement(replace))
    whole = rf"(?s)\A(.*?)(?:{match})(.*)\z"
    new = F.regexp_replace("title", whole, f"$1{shifted}${groups + 2}")
    rows = outline.withColumn("new", F.when(hit, new).otherwise(F.col("title")))
    changes = _changes(rows.filter("new <> title").withColumn("old", F.col("title")).withColumn("note", F.lit("")), "idx")
    return rows.withColumn("title", F.col("new")).select(*COLUMNS), changes


def insert(outline: DataFrame, level: int, title: str, page: int, after: dict) -> Result:
    """A new entry right after the only entry that matches ``after`` ({level, match}) in each book."""
    hit = (F.col("level") == after["level"]) & F.col("title").rlike(after["match"])
    bad = outline.groupBy("book").agg(F.count_if(hit).alias("n")).filter("n <> 1").limit(1).collect()
    if bad or outline.isEmpty():
        raise PatchError(f"{title!r} needs one place to follow, {after} gives {bad[0]['n'] if bad else 0}")
    new = outline.filter(hit).select("book", "idx", F.lit(level).alias("level"), F.lit(title).alias("title"), F.lit(page).alias("page"), F.lit(1).alias("later"))
    rows = _renumbered(outline.withColumn("later", F.lit(0)).unionByName(new), [chunk(F.col("idx"))], "idx", "later")
    made = new.select("book", "idx", "level", "page", F.lit("").alias("old"), F.col("title").alias("new"), F.lit("inserted").alias("note"))
    return rows, _changes(made, "idx")


def rebuild_numbered_sections(outline: DataFrame, level: int, id_pattern: str = r"(\d+)\.(\d+)") -> Result:
    """Sections whose numbers stand apart from their titles get them back.

    Entries at the level are cut into text and number tokens. A run of numbers
    belongs to the last texts before it, in order. A numbered text becomes one
    entry, under the chapter of its number; a text left over within a numbered
    chapter goes down one level; a number left over stays, and is reported.
    """
    parent = level - 1
    digits = F.nullif(F.regexp_extract("title", r"(\d+)", 1), F.lit("")).cast("int")
    at_level, none = F.col("level") == level, F.array().cast("array<string>")
    ids = F.transform(F.expr(f"regexp_extract_all(title, {_quoted(id_pattern)}, 0)"), lambda x: F.regexp_replace(x, rf"\A{id_pattern}\z", "$1.$2"))
    text = collapse(F.regexp_replace("title", id_pattern, " "))
    # tokens of the level: the text first, then the numbers
    rows = outline.withColumns({"own_number": F.when(F.col("level") == parent, digits), "text": F.when(at_level, F.nullif(text, F.lit(""))), "ids": F.when(at_level, ids).otherwise(none)})
    has_text = F.col("text").isNotNull().cast("int")
    # the chapter row before each row, and how many texts and numbers stand before it
    rows = running(rows, ["idx"], {"chapter_row": F.when(F.col("level") == parent, F.struct("idx", "own_number"))}, {"texts": has_text, "numbers": F.size("ids")})
    rows = materialize(rows.withColumn("host", F.when(F.col("level") > parent, F.col("chapter_row"))), "patch-rows")
    where = ["book", "idx", "page", "host", "chapter_row"]
    has_text = F.col("text").isNotNull().cast("int")
    own_texts = rows.filter("text is not null").select(*where, "title", F.lit(0).alias("sub"), F.col("text").alias("value"), (F.col("texts") + 1).alias("nth"), F.col("numbers").alias("numbers_before"))
    own_ids = rows.select(*where, (F.col("texts") + has_text).alias("texts_before"), F.col("numbers").alias("first"), has_text.alias("sub0"), F.posexplode("ids").alias("k", "value"))
    own_ids = own_ids.select(*where, "texts_before", "value", (F.col("first") + F.col("k") + 1).alias("nth"), (F.col("sub0") + F.col("k")).alias("sub"))
    # a group is a run of texts and the run of numbers behind it: the last texts and the first numbers are pairs
    text_runs = own_texts.groupBy("book", F.col("numbers_before").alias("start")).agg(F.count(F.lit(1)).alias("n_text"))
    id_runs = own_ids.groupBy("book", "texts_before").agg(F.count(F.lit(1)).alias("n_id"), (F.min("nth") - 1).alias("start"))
    runs = id_runs.join(text_runs, ["book", "start"], "left").select("book", "texts_before", "start", F.least(F.coalesce("n_text", F.lit(0)), "n_id").alias("pairs"))
    own_ids = own_ids.join(runs, ["book", "texts_before"]).withColumn("pair", F.col("nth") - F.col("start"))
    numbers = own_ids.filter("pair <= pairs").select("book", (F.col("texts_before") - F.col("pairs") + F.col("pair")).alias("nth"), F.col("value").alias("sid"), F.col("idx").alias("sid_idx"))
    texts = own_texts.join(numbers, ["book", "nth"], "left")
    parents = rows.filter((F.col("level") == parent) & F.col("own_number").isNotNull()).groupBy("book", F.col("own_number").alias("chapter")).agg(F.max("idx").alias("target"))
    texts = texts.withColumn("chapter", F.split_part("sid", F.lit("."), F.lit(1)).cast("int")).join(parents, ["book", "chapter"], "left")
    moved = F.col("target").isNotNull() & ~F.col("target").eqNullSafe(F.col("host.idx"))
    merged = F.concat_ws(" ", "sid", "value")
    same = F.col("sid_idx") == F.col("idx")
    texts = texts.withColumn("moved", F.coalesce(moved, F.lit(False)) & F.col("sid").isNotNull())
    demoted = F.col("sid").isNull() & F.col("host.own_number").isNotNull()
    texts = texts.withColumn("new", F.when(F.col("sid").isNotNull(), merged).otherwise(F.col("value"))).withColumn("demoted", F.coalesce(demoted, F.lit(False)))
    texts = texts.withColumn(
        "note",
        F.when(F.col("moved"), F.format_string("merged, moved to chapter %d", "chapter"))
        .when(F.col("sid").isNotNull() & ~(same & (strip(F.col("title")) == F.col("new"))), F.lit("merged"))
        .when(F.col("demoted"), F.lit(f"demoted to level {level + 1}")),
    ).withColumn("old", F.when(F.col("sid").isNull(), F.col("value")).when(same, strip(F.col("title"))).otherwise(F.concat_ws(" | ", "value", "sid")))
    # the new outline: rows keep (idx, sub), a moved section takes along the deeper rows behind it
    place = ["book", "idx", "sub", "page", "chapter_row"]
    nothing, nowhere = F.lit(None).cast("string"), F.lit(None).cast("int").alias("target")
    made = texts.select(*place, F.when(F.col("demoted"), F.lit(level + 1)).otherwise(F.lit(level)).alias("level"), F.col("new").alias("title"), F.when(F.col("moved"), F.col("target")).alias("target"), "old", "note")
    kept = own_ids.filter("pair > pairs").select(*place, F.lit(level).alias("level"), F.col("value").alias("title"), nowhere, F.col("value").alias("old"), F.lit("unpaired id").alias("note"))
    other = rows.filter(F.col("level") != level).withColumn("sub", F.lit(0)).select(*place, "level", "title", nowhere, nothing.alias("old"), nothing.alias("note"))
    rows = materialize(made.unionByName(kept).unionByName(other), "patch-made")
    change_rows = rows.filter("note is not null").select("book", "idx", "sub", F.lit(level).alias("level"), "page", "old", F.col("title").alias("new"), "note")
    rows = running(rows, ["idx", "sub"], {"leader": F.when(F.col("level") <= level, F.struct("target", "idx", "sub"))}, own=True)
    away = F.coalesce(F.col("leader.target").isNotNull(), F.lit(False))
    # between two chapter rows stand what moved behind the first of them and what was there, each in its old order
    after = F.when(away, F.col("leader.target")).otherwise(F.coalesce("chapter_row.idx", F.lit(-1)))
    stayed = F.when(away, F.lit(0)).otherwise(F.lit(1))
    return _renumbered(rows, [after, stayed, chunk(F.col("idx"))], "idx", "sub"), _changes(change_rows, "idx", "sub")


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


RULES: dict[str, Callable[..., Result]] = {f.__name__: f for f in (number_from_children, rename, insert, rebuild_numbered_sections)}


def patch(outline: DataFrame, rules: list[dict]) -> Result:
    """Apply rules ({rule, arguments}) in order; the new outline, and all changes in order."""
    changes = None
    done = 0
    for spec in rules:
        name = spec.get("rule")
        if name not in RULES:
            raise PatchError(f"there is no rule {name!r}, only {', '.join(sorted(RULES))}")
        try:
            outline, made = RULES[name](outline, **{k: v for k, v in spec.items() if k != "rule"})
        except TypeError as error:
            raise PatchError(f"{name} cannot take {sorted(k for k in spec if k != 'rule')}") from error
        made = made.withColumn("rule_no", F.lit(done))
        changes = made if changes is None else changes.unionByName(made)
        done += 1
    if changes is None:
        empty = outline.limit(0).select("book", F.lit(0).alias("rule_no"), F.lit(0).alias("idx_"))
        changes = empty.select("book", F.lit(0).alias("seq"), F.lit(0).alias("level"), F.lit(0).alias("page"), F.lit("").alias("old"), F.lit("").alias("new"), F.lit("").alias("note"), "rule_no")
    return outline, _changes(changes, "seq", first="rule_no")


def changes_by_note(changes: DataFrame) -> DataFrame:
    return changes.groupBy("book", F.col("note")).agg(F.count(F.lit(1)).alias("n"))

