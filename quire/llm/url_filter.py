"""URL filter lists as a sort-merge range join.

Canonical keys. A host's labels are reversed and each is ended by a zero byte, so
a host and all its subdomains are the keys that start with its key: one interval.
A path prefix is the interval of the paths it starts. Two intervals of the same
kind nest or are disjoint.

Sweep over hosts. The distinct hosts of the urls and the ends of the rules'
host intervals are sorted by key, and one sweep keeps the stack of open
intervals: a running sum gives the stack's height at every row, and what is on
top at height h is the interval that was opened to height h last. The stack below a
rule's host is the same everywhere, so it is worked out once, from the rules.

Sweep over paths. A url meets the rules of each host in its stack: it is keyed by
that host's key and its path, the rules are intervals of such keys, and a second
sweep finds the innermost. Of these, one per host in the stack, the longest wins.

Both sweeps run over ranges of the sorted keys, of equal size whatever the keys
are (equal keys are spread by a hash), so no host and no path is a hot key. A
range begins with the intervals that are open where it begins: those whose key
is a prefix of its first key.

Defined results: a null url, or one without ``://``, has an empty host and path
and no rule; rules with a null or empty host or a null path are ignored; of equal
rules with different verdicts ``block`` wins; of the fitting rules the one with
the most characters wins, then the one with the longer host; repeated rows stay
repeated; without rules, or for an empty table, nothing fits; columns in ``keep``
that have the name of a computed one are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm.common import materialize, scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A table is broadcast only if it has at most so many rows; a larger one is joined by shuffle.
SMALL = 10_000
OPEN, POINT, CLOSE = 0, 1, 2


def host(url: Column) -> Column:
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    return F.when(F.contains(url, F.lit("://")), F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)).otherwise(F.lit(""))


def path(url: Column) -> Column:
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    return F.when(F.contains(url, F.lit("://")), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def host_key(host_: Column) -> Column:
    """The labels, last first, each ended by a zero byte; what could be mistaken for an end is escaped."""
    plain = host_
    for char, code in (("\x02", "\x02\x05"), ("\x01", "\x02\x04"), ("\x00", "\x02\x03")):
        plain = F.replace(plain, F.lit(char), F.lit(code))
    ended = F.transform(F.reverse(F.split(plain, r"\.")), lambda x: F.concat(x, F.lit("\x00")))
    return F.encode(F.array_join(ended, ""), "UTF-8")


def path_key(host_key_: Column, path_: Column) -> Column:
    """Keys of one host's paths: no host's key goes on with byte 1."""
    return F.concat(host_key_, F.unhex(F.lit("01")), F.encode(path_, "UTF-8"))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def sweep(points: DataFrame, intervals: DataFrame, top: str, ranges: int | None = None) -> DataFrame:
    """points (key, ...) with ``top``: the value of the innermost interval around its key, or null.

    intervals: (key, value), each key once; an interval holds the keys that start with its own.
    """
    nothing = [F.lit(None).cast(points.schema[c].dataType).alias(c) for c in points.columns if c != "key"]
    nulls = F.lit(None).cast(intervals.schema["value"].dataType).alias("value")
    ends = intervals.select("key", F.lit(OPEN).alias("kind"), "value", *nothing).unionByName(
        intervals.select(F.concat("key", F.unhex(F.lit("FF"))).alias("key"), F.lit(CLOSE).alias("kind"), nulls, *nothing)
    )
    rows = points.withColumn("kind", F.lit(POINT)).withColumn("value", nulls).unionByName(ends)
    by = ["key", "kind", F.xxhash64(*(c for c in points.columns if c != "key")) if nothing else F.lit(0)]
    sorted_ = rows.repartitionByRange(ranges, *by) if ranges else rows.repartitionByRange(*by)
    ranged = materialize(sorted_.withColumn("part", F.spark_partition_id()), "url-ranges")
    # what is open where a range begins, as rows that come first in it
    first = ranged.groupBy("part").agg(F.min("key").alias("first"))
    heads = first.select("part", F.explode(F.transform(F.sequence(F.lit(1), F.octet_length("first")), lambda n: F.substring("first", F.lit(1), n))).alias("key"))
    opened = ranged.filter(F.col("kind") == OPEN).select("key", F.col("part").alias("own"), "value")
    carried = opened.join(_small(heads), "key").filter("own < part").select("key", F.lit(OPEN).alias("kind"), "value", *nothing, "part")
    order = W.partitionBy("part").orderBy("key", "kind").rowsBetween(W.unboundedPreceding, 0)
    step = F.when(F.col("kind") == OPEN, 1).when(F.col("kind") == CLOSE, -1).otherwise(0)
    events = ranged.unionByName(carried).withColumn("height", F.sum(step).over(order))
    level = W.partitionBy("part", "height").orderBy("key", "kind").rowsBetween(W.unboundedPreceding, 0)
    last = F.last(F.when(F.col("kind") == OPEN, F.col("value")), ignorenulls=True).over(level)
    # at height 0 nothing is open, whatever was opened to it before
    found = events.withColumn(top, F.when(F.col("height") > 0, last)).filter(F.col("kind") == POINT)
    return found.select(*points.columns, top)


def judge(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", keep: tuple[str, ...] = (), ranges: int | None = None) -> DataFrame:
    """Rows (*keep, host, path, rule, verdict), one for each row of df.

    rules: columns host, path, verdict (block or allow). ranges: of the sorted keys, by default the session's shuffle partitions.
    """
    made = ("host", "path", "rule", "verdict")
    named = {f"k{i}": c for i, c in enumerate(keep) if c.lower() not in made}
    spark = df.sparkSession
    with scratch(spark):
        rules = (
            rules.filter("host is not null and host <> '' and path is not null and verdict is not null")
            .groupBy("host", "path")
            .agg(F.max("verdict").alias("verdict"))
            .withColumn("node", host_key(F.col("host")))
        )
        rules = materialize(rules, "url-rules")
        base = df.select(*(F.col(c).alias(k) for k, c in named.items()), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
        base = materialize(base.withColumn("rid", F.monotonically_increasing_id()), "url-base", result=True)
        # each rule's host with its stack: those of its own labels' ends that are hosts of rules
        nodes = rules.select("node").distinct()
        heads = nodes.select("node", F.explode(F.transform(F.sequence(F.lit(1), F.octet_length("node")), lambda n: F.substring("node", F.lit(1), n))).alias("above"))
        stacks = heads.filter(F.substring("above", -1, 1) == F.unhex(F.lit("00"))).join(nodes.select(F.col("node").alias("above")), "above")
        stacks = stacks.groupBy("node").agg(F.collect_list("above").alias("value"))  # as many as a host has labels
        hosts = base.select("host").distinct().filter("host <> ''").select("host", host_key(F.col("host")).alias("key"))
        swept = sweep(hosts, stacks.select(F.col("node").alias("key"), "value"), "stack", ranges).filter("stack is not null")
        swept = materialize(swept.select("host", "stack"), "url-stacks")
        below = base.join(_small(swept), "host").select("rid", "path", F.explode("stack").alias("node"))
        points = below.select(path_key(F.col("node"), F.col("path")).alias("key"), "rid")
        rule = F.struct(F.length(F.concat("host", "path")).alias("n"), F.length("host").alias("h"), F.concat("host", "path").alias("rule"), "verdict")
        found = sweep(points, rules.select(path_key(F.col("node"), F.col("path")).alias("key"), rule.alias("value")), "top", ranges)
        best = materialize(found.filter("top is not null").groupBy("rid").agg(F.max("top").alias("best")), "url-best", result=True)
    return base.join(best, "rid", "left").select(
        *(F.col(k).alias(c) for k, c in named.items()),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
