import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from quire.llm import mixing, quality_rules, simhash
from tests.llm.test_table_operators import brute_whole

COLUMNS = {
    "op2_": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op3_": {"query_id", "rank", "vec_id", "score"},
    "op4_": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op5_": {"doc_id", "fingerprint", "component_id"},
    "op7_": {"doc_id", "size", "source_size", "target", "taken"},
    "op9_": {"page_id", "host", "path", "rule", "verdict"},
    "op10_": {"page_id", "url", "text", "n_chars"},
}


def test_registry():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("start", sorted(COLUMNS))
def test_columns_and_rows(spark, data, start):
    name = next(n for n in entry.queries() if n.startswith(start))
    got = entry.queries()[name](spark, data)
    assert COLUMNS[start] <= set(got.columns)
    table = {"op3_": None, "op9_": "pages", "op10_": "pages"}.get(start, "documents")
    if table:
        assert got.count() == spark.read.parquet(f"{data}/{table}.parquet").count()
    else:
        assert got.count() > 0


@pytest.mark.parametrize("name", ["op2_quality_rules", "op3_topk", "op8_sharding", "op9_url_filter"])
def test_against_sql(spark, data, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    got = entry.queries()[name](spark, data)
    cols = sorted(got.columns)
    want = c.sql(entry.oracle_sql()[name])
    assert sorted(want.columns) == cols
    assert Counter(tuple(r[x] for x in cols) for r in got.collect()) == Counter(want.select(*cols).fetchall())


def test_op5_is_brute_force(spark, data):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    prints = {i: simhash.fingerprint(t.encode(), 3) for i, t in docs.items()}
    ids, root = sorted(prints), {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = entry.queries()["op5_simhash"](spark, data).collect()
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got} == {(i, f"{p:016x}", find(i)) for i, p in prints.items()}


def test_op7_deals_every_copy(spark, data):
    """Each taken copy has a shard and a position; the shards' block counts are those of the splitting tree over single sources."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    planned = mixing.plan(docs).cache()
    copies = {r["doc_id"]: r["copies"] for r in planned.collect()}
    got = {r["doc_id"]: r for r in entry.queries()["op7_mixing"](spark, data).collect()}
    assert {i: len(r["shards"]) for i, r in got.items()} == copies
    assert all(len(r["positions"]) == len(r["shards"]) and r["taken"] == r["size"] * len(r["shards"]) for r in got.values())
    blocks = {}
    for r in planned.collect():
        for c in range(r["copies"]):
            blocks.setdefault(r["source"], {})[c + 1, r["h"] >> 54] = got[r["doc_id"]]["shards"][c]
    names = sorted(blocks)
    want = mixing.split_counts(np.array([len(blocks[s]) for s in names]), mixing.SHARDS, mixing.SEED)
    for s, row in zip(names, want):
        dealt = Counter(blocks[s].values())
        assert [dealt[k] for k in range(mixing.SHARDS)] == row.tolist()


def shingle_sets(texts, n=5):
    """Of each text the set of its word shingles (lower-case A-Z; fewer words: all of them)."""
    out = []
    for t in texts:
        words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
        out.append({tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set())
    return out


def near_firsts(docs, similarity=0.8):
    """The smallest doc_id of each group of documents whose shingle sets have that similarity, over all pairs."""
    ids = sorted(docs)
    sets, root = dict(zip(ids, shingle_sets(docs[i] for i in ids))), {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {find(i) for i in ids}


def test_pipeline_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").cache()
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "line dedup", "simhash near-dedup", "mixing", "byte-level bpe"]
    kept = stages["quality rules"](spark, docs, data).cache()
    want = {r["doc_id"]: quality_rules.judge(r["text"].encode()) for r in docs.collect()}
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == {i: w[9] for i, w in want.items() if w[8]}
    lines = stages["line dedup"](spark, kept, data).cache()
    texts = {r["doc_id"]: r["text"] for r in lines.collect()}
    assert texts == brute_whole({r["doc_id"]: r["text"] for r in kept.collect()})
    single = stages["simhash near-dedup"](spark, lines, data).cache()
    left = {r["doc_id"] for r in single.collect()}
    assert single.count() == len(left) and left == near_firsts(texts)
    mixed = stages["mixing"](spark, single, data).cache()
    copies = {r["doc_id"]: r["copies"] for r in mixing.plan(single).collect()}
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({i: n for i, n in copies.items() if n})
    for stage in (kept, lines, single, mixed):
        assert stage.columns == columns
    assert stages["byte-level bpe"](spark, mixed, data).count() == mixed.count()
    assert corpus_pipeline.run(spark, data).count() == mixed.count()


def test_pipeline_lays_rows_out_by_shard(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    planned = mixing.assign_shards(mixing.plan(docs))
    shards = {}
    for r in planned.collect():
        shards.setdefault(r["shard"], []).append((r["position"], r["doc_id"]))
    mixed = dict(corpus_pipeline.STAGES)["mixing"](spark, docs, data)
    parts = [[r["doc_id"] for r in part] for part in mixed.select("doc_id").rdd.glom().collect()]
    per = len(parts) // mixing.SHARDS
    assert per >= 1 and {k: sum(parts[k * per : (k + 1) * per], []) for k in range(mixing.SHARDS) if any(parts[k * per : (k + 1) * per])} == {
        k: [i for _, i in sorted(v)] for k, v in shards.items()
    }


def test_pipeline_odd_rows(spark, data):
    """Nulls, empty and repeated rows, shared ids and clashing names go through every stage; an empty table gives an empty one."""
    good = " ".join(f"word{i} goes on." for i in range(60))
    other = " ".join(f"other{i} stays here." for i in range(60))
    rows = [(1, good, "s"), (1, good, "s"), (1, other, None), (None, good, "s"), (2, None, "s"), (3, "", "t"), (4, "\n\n", None), (None, None, None), (5, f"{other} and more of it", "t")]
    df = spark.createDataFrame([(i, t, "en", s, 9, 7, "x", "y", "z") for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long, _q_id long, h string, shard string, kept string")
    for frame, some in ((df, True), (df.limit(0), False)):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, data)
            if name == "byte-level bpe":
                assert (docs.count() > 0) == some
            else:
                assert docs.columns == df.columns
                docs = spark.createDataFrame(docs.collect(), df.schema)
            if name == "simhash near-dedup" and some:
                assert sorted((r["doc_id"] or 0, r["text"]) for r in docs.collect()) == [(0, good), (1, other), (1, good)]
