"""Command lines of the stages: ``python -m quire COMMAND --help``. Errors of the engine end with status 1 and one line."""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quire import stages
from quire.errors import ConfigError, QuireError
from quire.operators import checks, external, patches
from quire.operators.outline import chapter_number
from quire.sources import readers, sinks


def _number(spark: SparkSession, chapter: str) -> int:
    try:
        return spark.range(1).select(chapter_number(F.lit(chapter))).first()[0]
    except Exception as error:
        raise ConfigError(f"{chapter!r} is no chapter") from error


def _books(a: argparse.Namespace, spark: SparkSession) -> stages.Books:
    return stages.Books(spark, a.config, a.outline, a.pages, getattr(a, "words", None))


def split(a, spark) -> int:
    meta = stages.split(_books(a, spark), a.book, _number(spark, a.chapter), a.work)
    print(f"{a.book} {meta['chapter']}: pages {meta['pdf_pages']}, printed {meta['printed_pages']}, {len(meta['sections'])} sections, {meta['title']}")
    return 0


def extract(a, spark) -> int:
    slug = f"ch{_number(spark, a.chapter):02d}"
    work = readers.work_dir(a.work, a.book, slug)
    out = f"{work}/mineru"
    external.preflight(a.url, readers.model_config_path())
    routing = readers.book_config(readers.books(spark, a.config), a.book)["routing"]
    pages = spark.read.parquet(f"{work}/pages").count()
    found = readers.extraction_dir(out, stages.STEM)

    def check() -> None:
        read = readers.middle_json(spark, f"{found}/{stages.STEM}_middle.json").first()
        if read["pages"] != pages:
            raise external.ExtractError(f"{found}: {read['pages']} pages, {pages} expected")

    ran = external.extract(lambda: os.path.exists(readers.page_file(found, stages.STEM)), external.command(f"{work}/{stages.STEM}.pdf", out, a.url, routing), check, a.force)
    print(f"{a.book} {slug}: {'extracted' if ran else 'reused'}")
    return 0


def guardrail(a, spark) -> int:
    slug = f"ch{_number(spark, a.chapter):02d}"
    found = stages.compare(spark, a.book, slug, a.work)
    print(f"{a.book} {slug}: {found['pages']} pages, {json.dumps(found['counts'])}")
    per: dict[int, int] = {}
    for h in found["hunks"]:
        per[h["page"]] = per.get(h["page"], 0) + 1
    print("hunks by printed page: " + ", ".join(f"{p}:{n}" for p, n in sorted(per.items())))
    for h in found["hunks"][: a.show]:
        print(f"  p{h['page']} {h['anchor']}\n    layer:  {h['pdf_text']}\n    blocks: {h['md_text']}")
    return 0


def report(a, spark) -> int:
    slug = f"ch{_number(spark, a.chapter):02d}"
    found = stages.review(spark, a.book, slug, a.work)
    print(f"{a.book} {slug}: {json.dumps(found['counts'])}, {len(found['flagged_blocks'])} flagged, {len(found['spot_check'])} to review")
    return 0


def patch(a, spark) -> int:
    rules = json.loads(readers.book_config(readers.books(spark, a.config), a.book)["patches"])
    if not rules:
        print(f"{a.book}: no patches are configured")
        return 0
    own = readers.outline(spark, a.outline).filter(F.col("book") == a.book)
    changes = sinks.apply_patches(own, rules, a.versions, a.force) if a.apply else patches.patch(own, rules)[1]
    rows = changes.orderBy("seq").collect()
    for c in rows:
        print(f"  L{c['level']} p{c['page']}  {c['old']!r} -> {c['new']!r}" + (f"  [{c['note']}]" if c["note"] else ""))
    notes = ", ".join(f"{r['note'] or 'renamed'}: {r['n']}" for r in patches.changes_by_note(changes).orderBy("note").collect())
    print(f"{'applied' if a.apply else 'dry run'}: {len(rows)} changes ({notes})")
    return 0


def probe(a, spark) -> int:
    b = _books(a, spark)
    cfg = readers.book_config(b.config, a.book)
    one = lambda df: df.filter(F.col("book") == a.book)
    if not a.check:
        for name, rows in checks.evidence(one(b.outline), one(b.pages), one(b.config), one(b.labels), a.samples).items():
            print(name)
            for r in rows.collect():
                print("  " + json.dumps(r.asDict(recursive=True), ensure_ascii=False))
        return 0
    found = checks.probe(one(b.outline), one(b.config), one(b.counts), one(b.readings(cfg["course"], a.readings)), one(b.overrides), one(b.labels)).orderBy("number").collect()
    for r in found:
        print(f"{'FAIL' if r['fault'] else 'OK'} ch{r['number']:02d}" + (f": {r['fault']}" if r["fault"] else ""))
    bad = sum(r["fault"] is not None for r in found)
    print(f"{a.book}: {len(found)} chapters, {bad} failures")
    return 1 if bad or not found else 0


def intake(a, spark) -> int:
    rows = stages.intake(_books(a, spark), a.out)
    for r in rows:
        print(f"{'FAIL' if r['faults'] else 'OK'} {r['book']}: {r['pages']} pages, text {r['text_layer_sample']}, {r['outline_entries']} entries" + "".join(f"; {x}" for x in r["faults"]))
    return 1 if any(r["faults"] for r in rows) else 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quire", description=__doc__)
    commands = parser.add_subparsers(required=True)

    def command(f, tables: bool = True, chapter: bool = True, **flags) -> None:
        p = commands.add_parser(f.__name__)
        p.set_defaults(run=f)
        if tables:
            for name in ("config", "outline", "pages"):
                p.add_argument(f"--{name}", required=True)
        if chapter:
            for name in ("book", "chapter"):
                p.add_argument(f"--{name}", required=True)
            p.add_argument("--work", default="work")
        for name, kind in flags.items():
            p.add_argument(f"--{name}", **({"action": "store_true"} if kind is bool else {"required": True} if kind is str else {"default": kind, "type": type(kind) if kind is not None else str}))

    command(split, words=None)
    command(extract, tables=False, config=str, url=str, force=bool)
    command(guardrail, tables=False, show=20)
    command(report, tables=False)
    command(patch, tables=False, chapter=False, config=str, outline=str, book=str, versions="versions", apply=bool, force=bool)
    command(probe, chapter=False, book=str, readings=None, samples=6, check=bool)
    command(intake, chapter=False, out=str)
    a = parser.parse_args(argv)
    try:
        return a.run(a, SparkSession.builder.appName("quire").getOrCreate())
    except QuireError as error:
        print(f"{a.run.__name__}: {error}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
