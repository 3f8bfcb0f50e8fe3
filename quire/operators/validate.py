"""Validation of report documents: the path and text of the first violation, in a fixed order.

A document is JSON text, read as a variant, so that a boolean never passes for a
number and missing keys differ from wrong ones. Rules form one ordered array per
document; its first entry that is not null is the answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.errors import ReportError

#: What a report may hold.
KEYS = ("book", "chapter", "pages", "extraction", "counts", "diff_hunks", "flagged_blocks", "spot_check", "status")
EXTRACTION = ("backend", "effort", "mineru_version", "timestamp")
COUNTS = ("blocks", "tables", "formulas", "figures", "diff_hunks")
HUNK = ("page", "anchor", "pdf_text", "md_text")
FLAG = ("id", "type", "crop", "reason")
SPOT = ("id", "crop")
TYPES = ("table", "formula", "chart", "figure", "text")
REASONS = ("vlm_generated", "running_matter_suspect")
STATUSES = ("pending_review", "certified", "needs_attention")


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _fault(bad: Column, path: Column, message: Column) -> Column:
    return F.when(F.coalesce(bad, F.lit(True)), F.struct(path.alias("path"), message.alias("message")))


def _object(v: Column, path: Column, keys: tuple[str, ...]) -> Column:
    """An object that has the keys."""
    held = F.coalesce(F.json_object_keys(F.to_json(v)), F.array().cast("array<string>"))
    missing = F.array_except(F.lit(list(keys)), held)
    shape = _fault(~_kind(v).startswith("OBJECT"), path, F.lit("expected an object"))
    return F.coalesce(shape, _fault(F.size(missing) > 0, path, F.concat(F.lit("missing "), F.array_join(missing, ", "))))


def _string(v: Column, path: Column) -> Column:
    return _fault(_kind(v) != "STRING", path, F.lit("expected a string"))


def _count(v: Column, path: Column) -> Column:
    """A whole number from 0; true and false are none."""
    whole = (_kind(v) == "BIGINT") & (F.try_variant_get(v, "$", "bigint") >= 0)
    return _fault(~whole, path, F.lit("expected a number from 0"))


def _one_of(v: Column, path: Column, allowed: tuple[str, ...]) -> Column:
    return _fault((_kind(v) != "STRING") | ~F.try_variant_get(v, "$", "string").isin(*allowed), path, F.concat(F.lit("not one of "), F.lit(", ".join(allowed))))


def _get(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$.{key}", "variant")


def _items(v: Column) -> Column:
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array().cast("array<variant>"))


def _first(*faults: Column) -> Column:
    return F.coalesce(*faults)


def _each(v: Column, path: str, check) -> Column:
    """The first fault among the items of an array; an element's path is path[i]."""
    shape = _fault(~_kind(v).startswith("ARRAY"), F.lit(path), F.lit("expected an array"))
    faults = F.transform(_items(v), lambda x, i: check(x, F.concat(F.lit(f"{path}["), i.cast("string"), F.lit("]"))))
    return F.coalesce(shape, F.get(F.filter(faults, lambda f: f.isNotNull()), 0))


def _at(path: Column, key: str) -> Column:
    return F.concat(path, F.lit(f".{key}"))


def first_violation(json: Column) -> Column:
    """struct<path, message> of the first violation, or null; text that is no JSON fails at ``$``.

    The document is parsed once: the rules see it as a lambda's variable.
    """
    return F.get(F.transform(F.array(F.try_parse_json(json)), _rules), F.lit(0))


def _rules(v: Column) -> Column:
    root, extraction, counts, pages = F.lit("$"), _get(v, "extraction"), _get(v, "counts"), _get(v, "pages")
    number = lambda c: F.try_variant_get(c, "$", "bigint")
    pair = F.transform(_items(pages), number)
    hunk = lambda x, p: _first(_object(x, p, HUNK), _count(_get(x, "page"), _at(p, "page")), *(_string(_get(x, k), _at(p, k)) for k in HUNK[1:]))
    flag = lambda x, p: _first(
        _object(x, p, FLAG), _string(_get(x, "id"), _at(p, "id")), _string(_get(x, "crop"), _at(p, "crop")),
        _one_of(_get(x, "type"), _at(p, "type"), TYPES), _one_of(_get(x, "reason"), _at(p, "reason"), REASONS),
    )
    spot = lambda x, p: _first(_object(x, p, SPOT), *(_string(_get(x, k), _at(p, k)) for k in SPOT))
    return _first(
        _fault(v.isNull(), root, F.lit("not JSON")),
        _object(v, root, KEYS),
        _string(_get(v, "book"), F.lit("book")),
        _string(_get(v, "chapter"), F.lit("chapter")),
        _fault(~_kind(pages).startswith("ARRAY") | (F.size(_items(pages)) != 2), F.lit("pages"), F.lit("expected the first and last printed page")),
        _each(pages, "pages", _count),
        _fault(pair[0] > pair[1], F.lit("pages"), F.lit("first > last")),
        _object(extraction, F.lit("extraction"), EXTRACTION),
        *(_string(_get(extraction, k), F.lit(f"extraction.{k}")) for k in EXTRACTION),
        _object(counts, F.lit("counts"), COUNTS),
        *(_count(_get(counts, k), F.lit(f"counts.{k}")) for k in COUNTS),
        _each(_get(v, "diff_hunks"), "diff_hunks", hunk),
        _each(_get(v, "flagged_blocks"), "flagged_blocks", flag),
        _each(_get(v, "spot_check"), "spot_check", spot),
        _one_of(_get(v, "status"), F.lit("status"), STATUSES),
        _fault(number(_get(counts, "diff_hunks")) != F.size(_items(_get(v, "diff_hunks"))), F.lit("counts.diff_hunks"), F.lit("differs from the number of hunks")),
    )


def violations(reports: DataFrame, json: str = "json") -> DataFrame:
    """The rows of reports that break the schema, with path and message."""
    found = reports.withColumn("fault_", first_violation(F.col(json))).filter("fault_ is not null")
    return found.select(*reports.columns, "fault_.path", "fault_.message")


def require_valid(reports: DataFrame, json: str = "json") -> None:
    """Raise ReportError if any report breaks the schema."""
    bad = violations(reports, json).limit(1).collect()
    if bad:
        raise ReportError(f"{bad[0]['path']}: {bad[0]['message']}")
