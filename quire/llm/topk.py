"""Exact top-k search by tiled matrix products.

Rows are numbered once. Queries are dealt into tiles and candidates into shards, by
hash and of bounded size; every tile meets every shard once, by an equi-join on the
pair's number (a stated query set against all rows, in blocks). A task holds the
tile of its pair and streams the shard: matrix products of bounded size, a partial
selection that leaves at most k (and its ties) per query and product, and a running
merge; so a pair gives k rows per query however long its shard is. The lists of a
query are then merged in a tree: within groups of shards, then across groups.
Nothing reaches the driver but three counts.

Components are floor(scale * x); scores are exact integers (float64 products
while every partial sum fits in 53 bits, Python integers beyond that; a score
outside the range of a long is held at its end).

Defined results: vectors that are null or hold a null or non-finite component,
and rows with a null id, take no part; only vectors of one length are compared;
every row is a query and a candidate of its own, whatever ids repeat: a query's
own row is no candidate, another row with its id is; ties go to the smaller
candidate id; a query without candidates has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm.common import bounded_batches, materialize, scratch

#: Components of a query tile (8 bytes each), and of a shard; candidates of one matrix product.
TILE_COMPONENTS, SHARD_COMPONENTS, PRODUCT_ROWS = 2 << 20, 16 << 20, 2048
#: Rows below which a shard is not split further, only to keep all cores busy.
SHARD_ROWS = 4096
#: Shards whose lists are merged by one node of the tree's first level.
FAN_IN = 32
MOST_TASKS = 20_000
_EXACT = 2.0**53


def scores(queries: np.ndarray, tile: np.ndarray) -> np.ndarray:
    """Integer inner products as int64, exact."""
    most = np.abs(queries).sum(axis=1).max(initial=0) * np.abs(tile).max(initial=0)
    if most < _EXACT:
        return (queries @ tile.T).astype(np.int64)
    big = np.vectorize(int, otypes=[object])
    low, high = -(1 << 63), (1 << 63) - 1
    out = big(queries) @ big(tile).T if queries.shape[1] else np.zeros((len(queries), len(tile)), object)
    return np.array([[min(max(int(x), low), high) for x in row] for row in out], np.int64).reshape(len(queries), len(tile))


def best(values: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest values, ties to smaller ids."""
    if len(values) > k:
        least = np.partition(values, len(values) - k)[len(values) - k]
        at = np.flatnonzero(values >= least)
    else:
        at = np.arange(len(values))
    return at[np.lexsort((ids[at], -values[at].astype(object) if values[at].min(initial=0) == np.iinfo(np.int64).min else -values[at]))][:k]


class _Pair:
    """A query tile and the lists that its shard has given so far, by length of the vectors."""

    def __init__(self, k: int, scale: int) -> None:
        self.k, self.scale = k, scale
        self.queries: dict[int, list] = {}  # per length: rows, ids, components
        self.lists: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def _parts(self, rows: np.ndarray, ids: np.ndarray, vectors: pa.Array):
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        for d in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == d)
            for s in range(0, len(at), PRODUCT_ROWS):
                own = at[s : s + PRODUCT_ROWS]
                yield d, rows[own], ids[own], np.floor(flat[starts[own][:, None] + np.arange(d)] * self.scale) if d else np.zeros((len(own), 0))

    def ask(self, rows: np.ndarray, ids: np.ndarray, vectors: pa.Array) -> None:
        for d, *part in self._parts(rows, ids, vectors):
            old = self.queries.get(d)
            self.queries[d] = [np.concatenate(x) for x in zip(old, part, strict=True)] if old else part

    def offer(self, rows: np.ndarray, ids: np.ndarray, vectors: pa.Array) -> None:
        for d, own, names, tile in self._parts(rows, ids, vectors):
            if d not in self.queries:
                continue
            q_rows, _, q = self.queries[d]
            lists = self.lists.setdefault(d, [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(q))
            for i, row in enumerate(scores(q, tile)):
                old_ids, old = lists[i]
                # only what beats the current k-th value can enter; equal values compete by id
                enter = np.flatnonzero(row >= old[-1]) if len(old) >= self.k else np.arange(len(row))
                enter = enter[own[enter] != q_rows[i]]
                if len(enter):
                    v, n = np.concatenate([old, row[enter]]), np.concatenate([old_ids, names[enter]])
                    top = best(v, n, self.k)
                    lists[i] = (n[top], v[top])

    def result(self, shard: int) -> Iterator[pa.RecordBatch]:
        for d, lists in self.lists.items():
            n = [len(x[0]) for x in lists]
            q_rows, q_ids, _ = self.queries[d]
            columns = [np.repeat(q_rows, n), np.repeat(q_ids, n), np.concatenate([x[0] for x in lists]), np.concatenate([x[1] for x in lists]), np.full(sum(n), shard, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row", "query_id", "vec_id", "score", "shard"])


def _search(batches: Iterator[pa.RecordBatch], k: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Top lists of the pairs of one task; rows (shard, tile, offered, row, vec_id, v) are sorted, a pair's queries come first."""
    pair, at = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        shard, tile, offered, rows, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        cut = np.flatnonzero((np.diff(shard) != 0) | (np.diff(tile) != 0) | (np.diff(offered) != 0)) + 1
        for s, e in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows], strict=True):
            if (shard[s], tile[s]) != at:
                if pair:
                    yield from pair.result(at[0])
                pair, at = _Pair(k, scale), (shard[s], tile[s])
            (pair.offer if offered[s] else pair.ask)(rows[s:e], ids[s:e], batch.column(5).slice(s, e - s))
    if pair:
        yield from pair.result(at[0])


def _ranked(df: DataFrame, k: int, *by: str) -> DataFrame:
    order = W.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(df: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """Rows (query_id, rank from 1, vec_id, score) of each query's k best candidates among all rows of df but its own."""
    spark = df.sparkSession
    bounded_batches(spark)
    usable = F.col(vector).isNotNull() & F.col(vec_id).isNotNull() & F.forall(
        F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    good = df.filter(F.coalesce(usable, F.lit(False)))
    with scratch(spark):
        # written before it is read twice, so a row keeps its number whatever is computed again
        rows = good.select(F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
        rows = materialize(rows, "topk-rows")
        n, asked, longest = rows.agg(F.count(F.lit(1)), F.count_if("asks"), F.max(F.size("v"))).first()
        longest = max(1, longest or 1)
        tiles = max(1, -(-asked * longest // TILE_COMPONENTS))
        shards = max(1, -(-n * longest // SHARD_COMPONENTS), min(spark.sparkContext.defaultParallelism, n // SHARD_ROWS))
        every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
        queries = rows.filter("asks").select(every(shards).alias("shard"), F.pmod(F.xxhash64("row"), F.lit(tiles)).cast("int").alias("tile"), F.lit(0).alias("offered"), "row", "vec_id", "v")
        offers = rows.select(F.pmod(F.xxhash64("row", F.lit(1)), F.lit(shards)).cast("int").alias("shard"), every(tiles).alias("tile"), F.lit(1).alias("offered"), "row", "vec_id", "v")
        pairs = queries.unionByName(offers).repartition(min(shards * tiles, MOST_TASKS), "shard", "tile").sortWithinPartitions("shard", "tile", "offered", "row")
        lists = pairs.mapInArrow(lambda it: _search(it, k, scale), "row long, query_id long, vec_id long, score long, shard long")
        # the tree's first level: lists of FAN_IN shards meet, spread by query and group
        lists = _ranked(lists.withColumn("group", F.floor(F.col("shard") / FAN_IN)), k, "row", "group")
        lists = materialize(lists.select("row", "query_id", "vec_id", "score"), "topk-lists", result=True)
    return _ranked(lists, k, "row").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
