"""Mixing sources to target weights, with exact quotas.

Targets. ``share`` times the total size is split over the sources by weight; a
target stops at ``most`` times its source's size and the excess is shared again
by weight, until no target is above its stop.

Quotas. Every document is taken floor(target / source size) times, and the
remainder of the target is an exact quota, filled with whole documents in a
seeded random order: a radix search over digits of the documents' hashes finds
the bucket in which the quota ends, by sums per bucket only; buckets before it
are taken whole, and from there on documents (up to ``FEW``, or one bucket) are
taken in order as long as they still fit, then the one that brings the sum nearest to the
quota, if any does.

Order. The taken documents of a source form blocks (hash buckets). A
multivariate-hypergeometric splitting tree splits the exact block counts of the
sources recursively over the output shards: at each node the blocks of the left
half are drawn from the node's counts. Each shard then draws its blocks, in
permuted order and disjoint, and its rows are shuffled locally by a seeded hash.
Sources are the tree's strata; beyond ``STRATA`` of them they are pooled by hash. The
counts it works on have at most that many rows and ``LEAVES`` columns (8 MB), whatever the
size of the data. Documents come to a shard only through its blocks, so the words that
each source gives each shard are what the tree drew.

Everything depends on the seed and the rows only, so reruns agree.

Defined results: size is the number of words (null text: 0); a null source is a
source of its own, last in order; rows equal in doc_id, source and size share
one decision; a source of size zero has target 0 and is not taken; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import WORD, materialize, private, scratch

#: The weights repeat over the sources in code point order.
WEIGHTS = (3.0, 1.0, 2.0)
SHARE, MOST, SEED = 1.5, 2.0, 20
#: The radix search reads this many bits of a hash at a time, until a bucket has at most FEW documents.
DIGIT, DIGITS, FEW = 10, 6, 512
STRATA, LEAVES, SHARDS = 1024, 1024, 64
#: Tables with at most so many rows are broadcast; larger ones are joined by shuffle.
SMALL = 10_000


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def _ordered(df: DataFrame, by: str, out: str) -> DataFrame:
    """df with each row's position from 0 in the order of its distinct ``by``, nulls last; no task sees more than its range."""
    ranged = materialize(
        df.repartitionByRange(F.asc_nulls_last(by)).withColumn("_part", F.spark_partition_id()), "mix-order"
    )
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    offsets = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(W.partitionBy("_part").orderBy(F.asc_nulls_last(by))) - 1
    return ranged.withColumn("_rank", rank).join(F.broadcast(offsets), "_part").withColumn(out, F.col("_rank") + F.col("_before")).drop("_part", "_rank", "_before")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Rows (source, source_size, docs, target), one per source of sizes (source, size, m)."""
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.sum("m").alias("docs"))
    weight = F.get(F.lit(list(weights)), F.pmod("at", F.lit(len(weights))).cast("int"))
    rows = materialize(_ordered(per, "source", "at").withColumn("weight", weight).drop("at"), "mix-sources")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    stop = F.col("source_size") * most
    level, done = 0.0, -1
    while True:  # a higher level only stops more sources; two numbers a round reach the driver
        stopped = F.col("weight") * level >= stop
        n, held, rest = rows.agg(
            F.count(F.when(stopped, 1)), F.sum(F.when(stopped, stop).otherwise(0.0)), F.sum(F.when(stopped, 0.0).otherwise(F.col("weight")))
        ).first()
        if n == done or not rest:
            break
        done, level = n, max(level, (share * total - held) / rest)
    target = F.least(stop, F.col("weight") * level) if level else F.lit(0.0)
    return rows.select("source", "source_size", "docs", target.cast("double").alias("target"))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _digit(level: int) -> Column:
    return F.shiftright("h", 62 - DIGIT * (level + 1)).bitwiseAND(F.lit((1 << DIGIT) - 1)).cast("int")


def _cut(buckets: str) -> Column:
    """Folds a source's buckets, in order: the sum before the bucket ``at`` in which the quota ``left`` ends, and the
    run of buckets from there to ``stop`` that hold at most FEW documents (n), at least that bucket."""

    def state(total: Column, at: Column, stop: Column, n: Column, shut: Column) -> Column:
        return F.struct(total.cast("long").alias("sum"), at.cast("int").alias("at"), stop.cast("int").alias("stop"), n.cast("long").alias("n"), shut.alias("shut"))

    def step(a: Column, r: Column) -> Column:
        searching, fits = a["at"] < 0, a["sum"] + r["size"] <= F.col("left")
        more = ~a["shut"] & (a["n"] + r["n"] <= FEW)
        return (
            F.when(searching & fits, state(a["sum"] + r["size"], a["at"], a["stop"], a["n"], a["shut"]))
            .when(searching, state(a["sum"], r["d"], r["d"], r["n"], a["shut"]))
            .when(more, state(a["sum"], a["at"], r["d"], a["n"] + r["n"], a["shut"]))
            .otherwise(state(a["sum"], a["at"], a["stop"], a["n"], F.lit(True)))
        )

    return F.aggregate(buckets, state(F.lit(0), F.lit(-1), F.lit(-1), F.lit(0), F.lit(False)), step)


def _fill(units: DataFrame, quotas: DataFrame) -> DataFrame:
    """Rows (source, upto, extra): documents of a source with hash below ``upto`` are taken once more, and those in ``extra``.

    units: (doc_id, source, size, m, h), quotas: (source, left); h has 62 bits.
    """
    open_ = quotas.filter("left > 0").select("source", F.lit(0).cast("long").alias("upto"), F.col("left").cast("long").alias("left"))
    state = None
    for level in range(DIGITS):
        width = 1 << (62 - DIGIT * (level + 1))
        s = _small(open_.withColumnRenamed("source", "s"))
        inside = units.join(s, _same(F.col("source"), F.col("s"))).filter(F.col("h").between(F.col("upto"), F.col("upto") + (width << DIGIT) - 1))
        sums = inside.groupBy("source", "upto", "left", _digit(level).alias("d")).agg(F.sum(F.col("size") * F.col("m")).alias("size"), F.count(F.lit(1)).alias("n"))
        buckets = sums.groupBy("source", "upto", "left").agg(F.array_sort(F.collect_list(F.struct("d", "size", "n"))).alias("b"))  # 1024 at most
        found = buckets.withColumn("cut", _cut("b")).filter("cut.at >= 0")
        found = found.select(
            "source",
            (F.col("upto") + F.col("cut.at") * F.lit(width)).alias("upto"),
            (F.col("left") - F.col("cut.sum")).alias("left"),
            (F.col("upto") + (F.col("cut.stop") + 1) * F.lit(width)).alias("end"),
            F.col("cut.n").alias("n"),
        )
        found = materialize(found, "mix-quota")
        done = found if level == DIGITS - 1 else found.filter(F.col("n") <= FEW)
        state = done if state is None else state.unionByName(done)
        open_ = found.filter(F.col("n") > FEW).select("source", "upto", "left")
        if open_.isEmpty():
            break
    s = _small(state.withColumnRenamed("source", "s"))
    inside = units.join(s, _same(F.col("source"), F.col("s"))).filter("h >= upto and h < end")
    last = inside.groupBy("source", "upto", "left").agg(F.array_sort(F.collect_list(F.struct("h", "doc_id", "size", (F.col("size") * F.col("m")).alias("all")))).alias("rows"))
    start = F.struct(F.col("left").alias("left"), F.array().cast("array<struct<h:bigint,doc_id:bigint,size:bigint>>").alias("got"))
    took = F.aggregate(
        "rows",
        start,
        lambda a, r: F.when(
            (r["all"] <= a["left"]) & (r["all"] > 0),
            F.struct((a["left"] - r["all"]).alias("left"), F.concat(a["got"], F.array(F.struct(r["h"].alias("h"), r["doc_id"].alias("doc_id"), r["size"].alias("size")))).alias("got")),
        ).otherwise(a),
        lambda a: a,
    )
    last = last.withColumn("took", took)
    passed = F.filter("rows", lambda r: ~F.array_contains("took.got", F.struct(r["h"].alias("h"), r["doc_id"].alias("doc_id"), r["size"].alias("size"))))
    nearest = F.array_min(F.transform(passed, lambda r: F.struct(F.abs(r["all"] - F.col("took.left")).alias("off"), r["h"].alias("h"), r["doc_id"].alias("doc_id"), r["size"].alias("size"))))
    last = last.withColumn("nearest", nearest)
    one = F.array(F.struct(F.col("nearest.h").alias("h"), F.col("nearest.doc_id").alias("doc_id"), F.col("nearest.size").alias("size")))
    extra = F.when(F.col("nearest.off") < F.col("took.left"), F.concat("took.got", one)).otherwise(F.col("took.got"))
    return last.select("source", "upto", extra.alias("extra"))


def split_counts(counts: np.ndarray, leaves: int, seed: int) -> np.ndarray:
    """Block counts per stratum and leaf, drawn by the multivariate-hypergeometric splitting tree; rows sum to counts."""
    out = np.zeros((len(counts), leaves), np.int64)

    def split(own: np.ndarray, low: int, high: int) -> None:
        if high - low == 1:
            out[:, low] = own
            return
        middle, total = (low + high) // 2, int(own.sum())
        left = total * (middle - low) // (high - low)
        rng = np.random.default_rng([seed, low, high])
        drawn = rng.multivariate_hypergeometric(own, left, method="marginals") if total else own
        split(drawn, low, middle)
        split(own - drawn, middle, high)

    split(counts.astype(np.int64), 0, leaves)
    return out


def plan(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """Rows (doc_id, source, size, m, source_size, target, copies), one per distinct (doc_id, source, size); m is its number of rows."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    sizes = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), size.alias("size"))
    hashed = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.coalesce("doc_id", F.lit(-1)), "source", "size"), 2)
    with scratch(docs.sparkSession):
        units = materialize(sizes.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("m")).withColumn("h", hashed), "mix-units", result=True)
        per = materialize(targets(units, weights, share, most).withColumn("base", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")), "mix-targets")
        quotas = per.select("source", F.round(F.col("target") - F.col("base") * F.col("source_size")).cast("long").alias("left"))
        filled = materialize(_fill(units, quotas), "mix-filled", result=True)
        whole = quotas.filter("left > 0").select("source")
        per = per.join(_small(whole.withColumnRenamed("source", "w").withColumn("asks", F.lit(True))), _same(F.col("source"), F.col("w")), "left").drop("w")
        cuts = filled.select(F.col("source").alias("c"), "upto")
        per = per.join(_small(cuts), _same(F.col("source"), F.col("c")), "left").drop("c")
        # a source that asks for more and has no cut is taken whole once more
        per = per.withColumn("upto", F.when(F.col("upto").isNotNull(), F.col("upto")).when(F.coalesce("asks", F.lit(False)), F.lit(1 << 62)).otherwise(F.lit(0))).drop("asks")
        per = materialize(per.withColumnRenamed("source", "p"), "mix-per", result=True)
        extra = filled.select("source", F.explode("extra").alias("e")).select(
            F.col("source").alias("xs"), F.col("e.h").alias("xh"), F.col("e.doc_id").alias("xd"), F.col("e.size").alias("xz"), F.lit(1).alias("more")
        )
        joined = units.join(_small(per), _same(F.col("source"), F.col("p"))).drop("p")
        joined = joined.join(
            _small(extra.distinct()), (F.col("h") == F.col("xh")) & _same(F.col("doc_id"), F.col("xd")) & (F.col("size") == F.col("xz")) & _same(F.col("source"), F.col("xs")), "left"
        )
        once = F.when((F.col("h") < F.col("upto")) | F.col("more").isNotNull(), 1).otherwise(0)
        return joined.select("doc_id", "source", "size", "m", "h", "source_size", "target", (F.col("base") + once).cast("int").alias("copies"))


def assign_shards(planned: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """planned, a row per taken copy, with its output shard and its position key within the shard."""
    if not 1 <= shards <= LEAVES:
        raise ValueError(f"between 1 and {LEAVES} shards; arrange splits each into as many files as are wanted")
    taken = planned.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies")
    bits = max(8, (4 * shards - 1).bit_length())  # four blocks or more of a source and copy for each shard
    taken = taken.withColumn("block", F.shiftright("h", 62 - bits).cast("int"))
    blocks = materialize(taken.select("source", "copy", "block").distinct(), "mix-blocks")
    sources = blocks.select("source").distinct().limit(STRATA + 1).collect()  # a bounded number of names
    if len(sources) <= STRATA:
        names = sorted((r["source"] for r in sources), key=lambda s: (s is None, str(s)))
        kind = T.StructType([T.StructField("ss", blocks.schema["source"].dataType), T.StructField("stratum", T.IntegerType())])
        own = F.broadcast(planned.sparkSession.createDataFrame([(s, i) for i, s in enumerate(names)], kind))
        blocks = blocks.join(own, _same(F.col("source"), F.col("ss"))).drop("ss")
    else:
        blocks = blocks.withColumn("stratum", F.pmod(F.xxhash64("source"), F.lit(STRATA)).cast("int"))
    counts = {r["stratum"]: r["n"] for r in blocks.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")).collect()}  # STRATA rows at most
    strata = sorted(counts)
    quotas = split_counts(np.array([counts[s] for s in strata]), shards, seed)
    stops = np.cumsum(quotas, axis=1)
    ranges = [(s, [int(x) for x in stops[i]]) for i, s in enumerate(strata)]
    quota = F.broadcast(planned.sparkSession.createDataFrame(ranges, "stratum int, stops array<bigint>"))
    order = W.partitionBy("stratum").orderBy(F.xxhash64(F.lit(seed), "source", "copy", "block"), "source", "copy", "block")
    dealt = blocks.withColumn("k", F.row_number().over(order)).join(quota, "stratum")
    dealt = dealt.select(F.col("source").alias("bs"), F.col("copy").alias("bc"), F.col("block").alias("bb"), F.size(F.filter("stops", lambda x: x < F.col("k"))).alias("shard"))
    out = taken.join(dealt, _same(F.col("source"), F.col("bs")) & (F.col("copy") == F.col("bc")) & (F.col("block") == F.col("bb"))).drop("bs", "bc", "bb", "block")
    return out.withColumn("position", F.xxhash64(F.lit(seed), "shard", "h", "copy"))


def dealt(planned: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """planned, each row with an array of (copy, shard, position) for its taken copies; empty if it has none."""
    rows = [c for c in planned.columns if c != "copies"]
    each = assign_shards(planned, shards, seed).groupBy(*rows).agg(F.array_sort(F.collect_list(F.struct("copy", "shard", "position"))).alias("dealt"))
    none = planned.filter("copies <= 0").select(*rows)
    return each.unionByName(none.withColumn("dealt", F.array().cast(each.schema["dealt"].dataType)))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", shards: int = SHARDS, seed: int = SEED, arrange: int = 0, **how) -> DataFrame:
    """The mixed corpus: the rows of docs, each as often as it is taken; columns of docs, shard and position last
    (a column of docs with one of these names is replaced).

    With arrange, rows are also laid out that way: sorted by position in ``arrange`` partitions per shard, ready to be written.
    """
    names = private(docs, "d", "s", "z", "shard", "position")
    planned = materialize(plan(docs, doc_id, source, text, seed=seed, **how), "mix-plan")
    dealt = assign_shards(planned, shards, seed).select(
        F.col("doc_id").alias(names["d"]), F.col("source").alias(names["s"]), F.col("size").alias(names["z"]), F.col("shard").alias(names["shard"]), F.col("position").alias(names["position"])
    )
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    joined = docs.join(
        dealt, _same(docs[doc_id].cast("long"), F.col(names["d"])) & _same(docs[source], F.col(names["s"])) & (size == F.col(names["z"]))
    )
    own = [docs[c] for c in docs.columns if c.lower() not in ("shard", "position")]
    out = joined.select(*own, F.col(names["shard"]).alias("shard"), F.col(names["position"]).alias("position"))
    if arrange:
        # positions are hashes, so their order cuts a shard into equal parts
        part = F.floor((F.col("position") / 2.0**63 + 1) * arrange / 2).cast("int")
        place = F.col("shard") * arrange + F.least(part, F.lit(arrange - 1))
        out = out.repartitionById(shards * arrange, place).sortWithinPartitions("position")
    return out
