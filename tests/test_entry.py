from collections import Counter

import pytest

import __spark_entry__ as entry
from quire.plans import adapters, files, oracles, queries

QUERIES, ORACLES = queries.QUERIES | files.QUERIES, oracles.ORACLES | files.ORACLES


def test_entry(spark):
    found = entry.entry(spark)
    assert found.count() > 0 and "matched_blocks" in found.columns


def test_registry():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck(data):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in adapters.TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, data, duck, name):
    got = QUERIES[name](spark, data)
    cols = sorted(got.columns)
    want = duck.sql(ORACLES[name])
    assert sorted(want.columns) == cols
    quoted = ", ".join(f'"{c}"' for c in cols)
    assert Counter(tuple(r[c] for c in cols) for r in got.collect()) == Counter(duck.sql(f"SELECT {quoted} FROM ({ORACLES[name]})").fetchall())


def test_reports_pass_the_validator(spark, data):
    rows = QUERIES["chapter_reports"](spark, data).collect()
    assert rows and all(r["violation"] is None for r in rows) and sum(r["diff_hunks"] for r in rows) > 0


def test_report_documents_are_checked_in_many_tasks(spark, data):
    assert queries._report_documents(spark, data).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_sides_of_reports_are_made_once(spark, data):
    plan = queries.reports(spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan


def test_chapters_of_a_book_share_page_files(spark, data, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "new_path", lambda s, name: f"file://{tmp_path}/{name}")
    chapters = QUERIES["page_files"](spark, data).count()
    written = [p.relative_to(tmp_path / "pages").parts for p in tmp_path.rglob("*.json")]
    assert all(len(p) == 2 and p[0].startswith("book=") for p in written) and 0 < len(written) < chapters
