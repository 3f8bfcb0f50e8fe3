"""The registered queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per license found in a document."""
    from quire.llm import license_scan

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan(docs).select("doc_id", F.explode("licenses").alias("x")).select("doc_id", "x.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import quality_rules

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.score(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_chars", "base_failed", "kept"
    )


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import topk

    return topk.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op4_byte_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    from quire.llm import bpe

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bpe.digest(docs, path or public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return found.drop("text")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import simhash

    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, bits=3)
    return found.select("doc_id", simhash.hex_digits("fingerprint").alias("fingerprint"), "component_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import line_dedup

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return line_dedup.dedup(docs, n_chars="n_chars", removed="removed_lines")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document, with the words of it that the mix takes, and the shard and position of each copy."""
    from quire.llm import common, mixing

    planned = common.materialize(mixing.plan(_table(spark, sf_dir, "documents")), "mix-plan")
    rows = mixing.dealt(planned).withColumn("each", F.explode(F.sequence(F.lit(1).cast("long"), "m")))
    return rows.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("dealt")).alias("taken"),
        F.col("dealt.shard").alias("shards"), F.col("dealt.position").alias("positions"),
    )


#: The documents come in as so many arrivals.
ARRIVALS = 16


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, appended in arrivals, compacted in tiers, and read through the manifest."""
    from quire.llm import common, shard_store

    docs = _table(spark, sf_dir, "documents")
    store = shard_store.ShardStore(spark, common.new_path(spark, "shards"))
    store.append_all(docs, F.col("doc_id"), ARRIVALS)
    store.compact(vacuum=True)
    return store.read().select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


URL_RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import url_filter

    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(_table(spark, sf_dir, "pages"), rules, keep=("page_id",))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm import html_extract

    return html_extract.main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_quality_rules": op2_quality_rules,
    "op3_topk": op3_topk,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_simhash": op5_simhash,
    "op6_line_dedup": op6_line_dedup,
    "op7_mixing": op7_mixing,
    "op8_sharding": op8_sharding,
    "op9_url_filter": op9_url_filter,
    "op10_html": op10_html,
}


def _url_oracle() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return f"""
WITH rules(rh, rp, verdict) AS (VALUES {rules}),
rests AS (SELECT page_id, row_number() OVER () AS n, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, n, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests
),
fits AS (
  SELECT p.*, rh || rp AS rule, r.verdict,
    row_number() OVER (PARTITION BY n ORDER BY length(rh || rp) DESC NULLS LAST, length(rh) DESC) AS k
  FROM parts p LEFT JOIN rules r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE k = 1"""


def oracles() -> dict[str, str]:
    from quire.llm import quality_rules

    return {
        "op2_quality_rules": quality_rules.ORACLE,
        "op8_sharding": "SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(text) AS text_sha256 FROM documents",
        "op9_url_filter": _url_oracle(),
        "op3_topk": """
WITH good AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM good q JOIN good c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 5""",
    }
