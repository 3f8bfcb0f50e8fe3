"""Running values and positions within a book, in chunks: no task holds a whole book.

A window over a book would sort all of its rows in one task. Here a task has a chunk of places
at a time, and what the chunks before it add up to comes from a table of a row per chunk.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Places of a chunk, as a power of two.
BITS = 14


def chunk(c: Column) -> Column:
    """The chunk of a place: as many as there are 2 ** BITS places."""
    return F.shiftright(c, BITS)


def _joined(rows: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """rows with the columns of other, which has a row for each of their keys (nulls are equal)."""
    named = other.withColumnsRenamed({k: f"{k}_of" for k in keys})
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"{k}_of")) for k in keys))
    return rows.join(named, same).drop(*(f"{k}_of" for k in keys))


def running(rows: DataFrame, order: list[str], last: dict[str, Column] | None = None, total: dict[str, Column] | None = None, own: bool = False) -> DataFrame:
    """rows with, by name, the last value that is not null, and the sum, over a book's rows before each (and its own, if ``own``).

    order: columns that number the rows of a book, the first of them an integer.
    """
    last, total = last or {}, total or {}
    values = {f"{n}_value": c for n, c in (last | total).items()}
    rows = rows.withColumns(values | {"chunk_": chunk(F.col(order[0]))})
    keys = ["book", "chunk_"]
    value = lambda n: F.col(f"{n}_value")
    newest = (F.max(F.when(value(n).isNotNull(), F.struct(*order, value(n).alias("v"))))["v"].alias(n) for n in last)
    per = rows.groupBy(*keys).agg(*newest, *(F.sum(value(n)).alias(n) for n in total))
    before = W.partitionBy("book").orderBy("chunk_").rowsBetween(W.unboundedPreceding, -1)
    carried = per.select(*keys, *(F.last(n, ignorenulls=True).over(before).alias(f"{n}_before") for n in last), *(F.sum(n).over(before).alias(f"{n}_before") for n in total))
    inside = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0 if own else -1)
    out = {n: F.coalesce(F.last(value(n), ignorenulls=True).over(inside), f"{n}_before") for n in last}
    out |= {n: F.coalesce(F.sum(value(n)).over(inside), F.lit(0)) + F.coalesce(f"{n}_before", F.lit(0)) for n in total}
    return _joined(rows, carried, keys).withColumns(out).drop("chunk_", *values, *(f"{n}_before" for n in (*last, *total)))


def numbered(rows: DataFrame, out: str, buckets: list[Column], order: list[str]) -> DataFrame:
    """rows with their position (from 0) within a book in a column ``out``.

    buckets: no row of a bucket stands between those of another; buckets stand in the order of these columns, rows of one in ``order``.
    """
    keys = ["book", *(f"bucket{i}_" for i in range(len(buckets)))]
    rows = rows.withColumns(dict(zip(keys[1:], buckets, strict=True)))
    before = W.partitionBy("book").orderBy(*keys[1:]).rowsBetween(W.unboundedPreceding, -1)
    starts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("size_")).select(*keys, F.coalesce(F.sum("size_").over(before), F.lit(0)).alias("start_"))
    at = F.col("start_") + F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1
    return _joined(rows, starts, keys).withColumn(out, at.cast("int")).drop("start_", *keys[1:])
