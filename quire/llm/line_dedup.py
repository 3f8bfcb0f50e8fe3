"""Line dedup by content-defined chunks of lines.

A text is cut into chunks of whole lines. A chunk ends after a line if the
rolling hash over that line and the one before it falls into one of ``SPREAD``
classes, so that the same passage gets the same cuts wherever it stands, as
soon as two of its lines agree. A line with ``LONG`` or more words is a passage
by itself and always a chunk of its own. Chunks of two or more lines that hold
a word, and those long lines, are compared over all documents, by the SHA-256 of
their lines' SHA-256. Of equal chunks the first (smallest doc_id,
then position) stays; the others are removed, and the lines around them join.

Chunks miss a passage's edges, and a short passage as a whole. With ``whole``
every run of lines with ``LONG`` words in all is found: from each line with a word the
shortest run of so many words that begins there, and the one that ends there, are
compared over all documents in the same way. In a passage of LONG words or more these runs
cover every line, wherever it stands. Runs that an earlier place has are
removed, so each line removed has an equal one before it, and the first of them stays.
Lines without words do not count in a run; those inside it go with it.

Chunks and runs come from one pass over the texts and are one table. A chunk
with the lines of a run has its key; wherever such a chunk stands, the run is found
too, so neither changes what goes of the other.

The rolling hash has a window of two lines: it is the hash of both lines' hashes.

DataFrame functions only. Counting pre-aggregates on the key, so a passage
that a third of all documents share is one partial row per task; marking joins
on it, where Spark's adaptive execution splits hot keys. What goes is a list of
line runs per document, and a text is put together from the runs between them,
in time linear in its length.

Defined results: a null text stays null and has no chunks; an empty one stays
empty; a text whose lines are all removed becomes empty; rows without doc_id
are neither counted nor changed; rows that share doc_id and text are one document, so
equal chunks at the same place in both are one occurrence, and repeated rows stay
repeated; rows that share a doc_id and differ in text are documents of their own; a
column that has the name given for the count of removed lines is replaced by it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm.common import materialize, private, scratch

#: Chunks hold SPREAD lines on average; a line of LONG words or more is one chunk.
SPREAD, LONG = 3, 50
#: A place is a decimal of doc_id, nine digits of the text's hash, and nine of the line's number.
PLACE = 1_000_000_000
KEYS = ["doc_id", "t"]


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use)[0]


def counts(lines: Column) -> Column:
    """The number of words of each of an array of lines, as longs: that of the matches of WORD, by searches for bytes, since matches are objects."""

    def plain(x: Column) -> Column:
        """The line with words parted by one space, so that a word less than their number are its spaces."""
        odd = [F.contains(x, F.lit(c)) for c in ("  ", "\t", "\x0b", "\x0c", "\r")]
        return F.trim(F.when(reduce(or_, odd), single(x)).otherwise(x))

    def single(x: Column) -> Column:
        """Runs of white space as one space; the mark is a character of words, so one that is there may be another."""
        space = [(c, " ") for c in "\t\x0b\x0c\r"]
        for old, to in (*space, ("\x01", "x"), (" ", " \x01"), ("\x01 ", ""), (" \x01", " ")):
            x = F.replace(x, F.lit(old), F.lit(to))
        return x

    def count(x: Column) -> Column:
        size = F.octet_length(x)
        return F.when(size == 0, F.lit(0)).otherwise(size - F.octet_length(F.replace(x, F.lit(" "), F.lit(""))) + 1).cast("long")

    return F.transform(F.transform(lines, plain), count)


def _run(digests: Column, at: Column, n: Column, start: Column, end: Column) -> Column:
    """The run of lines from start to end, by the n digests from ``at`` on."""
    key = F.unhex(F.sha2(F.array_join(F.slice(digests, at + 1, n), "\n"), 256))
    return F.struct(key.alias("key"), start.cast("int").alias("start"), end.cast("int").alias("end"))


def _ends(h: Column, n: Column) -> Column:
    """The last lines of the chunks, from the lines' hashes and numbers of words."""
    last = F.size(h) - 1
    return F.filter(
        F.sequence(F.lit(0), last),
        lambda i: (i == last)
        | (F.get(n, i) >= LONG)
        | F.coalesce(F.get(n, i + 1) >= LONG, F.lit(False))
        | ((i > 0) & (F.pmod(F.xxhash64(F.get(h, i - 1), F.get(h, i)), F.lit(SPREAD)) == 0)),
    )


def chunks(lines: Column, n: Column, d: Column) -> Column:
    """The array of (key, start, end) of the chunks that are compared: two lines with words, or a long line."""

    def compared(first: Column, size: Column) -> Column:
        several = (size > 1) & (F.size(F.filter(F.slice(n, first + 1, size), lambda x: x > 0)) > 1)
        return several | ((size == 1) & (F.get(n, first) >= LONG))

    def runs(e: Column) -> Column:
        def one(x: Column, k: Column) -> Column:
            first = F.when(k == 0, F.lit(0)).otherwise(F.get(e, k - 1) + 1)
            return _bind(first, lambda f: F.when(compared(f, x - f + 1), _run(d, f, x - f + 1, f, x)))

        return F.filter(F.transform(e, one), lambda c: c.isNotNull())

    return _bind(F.transform(lines, lambda x: F.xxhash64(x)), lambda h: _bind(_ends(h, n), runs))


def windows(n: Column, d: Column) -> Column:
    """The array of (key, start, end) of a text's shortest runs of LONG words, from each line with a word onwards and backwards.

    A run of one line is a chunk already and left out.
    """
    # words and lines as one number, words * step + lines, since a sum of structs makes one per line
    step = LONG + 1
    enough = F.lit(LONG * step).cast("long")
    # (place, length) as one number: Spark compares arrays of structs pair by pair
    both = lambda p, m: p.cast("long") * (LONG + 1) + m

    def reach(own: Column) -> Column:
        """How many of these lines, from the first on, have LONG words; 0 if all of them have fewer."""
        add = lambda a, c: F.when(a >= enough, a).otherwise(a + c)
        return F.aggregate(own, F.lit(0).cast("long"), add, lambda a: F.when(a >= enough, a % step).otherwise(F.lit(0).cast("long")))

    def found(c: Column, at: Column, w: Column) -> Column:
        onward = F.transform(c, lambda x, p: F.when(x < enough, _bind(reach(F.slice(c, p + 1, LONG)), lambda m: both(p, m))))

        def back(x: Column, p: Column) -> Column:
            low = F.greatest(p - (LONG - 1), F.lit(0))
            return F.when(x < enough, _bind(reach(F.reverse(F.slice(c, low + 1, p - low + 1))), lambda m: both(p - m + 1, m)))

        every = F.array_distinct(F.concat(onward, F.transform(c, back)))
        several = F.filter(every, lambda b: b % (LONG + 1) > 1)

        def run(p: Column, m: Column) -> Column:
            return _run(w, p, m, F.get(at, p), F.get(at, p + m - 1))

        return F.transform(several, lambda b: run(F.floor(b / (LONG + 1)).cast("int"), (b % (LONG + 1)).cast("int")))

    def worded(at: Column) -> Column:
        c = F.transform(at, lambda i: F.get(n, i) * step + 1)
        return _bind(c, lambda c: _bind(F.transform(at, lambda i: F.get(d, i)), lambda w: found(c, at, w)))

    return _bind(F.filter(F.sequence(F.lit(0), F.size(n) - 1), lambda i: F.get(n, i) > 0), worded)


def compared(text: Column, whole: bool) -> Column:
    """The array of (key, start, end) of a text's chunks that are compared and, if ``whole``, its shortest runs of LONG words.

    All in one expression over the text, so that lines are cut, counted and digested
    once for both, and a long text is never copied into each of its runs' rows.
    """

    def runs(lines: Column, n: Column, d: Column) -> Column:
        return F.concat(chunks(lines, n, d), windows(n, d)) if whole else chunks(lines, n, d)

    def digests(lines: Column, n: Column) -> Column:
        """Lines without words stand for themselves: many empty ones take no more room than they do, and none looks like a digest."""
        return F.transform(lines, lambda x, i: F.when(F.get(n, i) > 0, F.sha2(x, 256)).otherwise(x))

    return _bind(F.split(text, "\n"), lambda lines: _bind(counts(lines), lambda n: _bind(digests(lines, n), lambda d: runs(lines, n, d))))


def _place() -> Column:
    return (F.col("doc_id").cast("decimal(38,0)") * PLACE + F.pmod("t", F.lit(PLACE))) * PLACE + F.col("start")


def repeats(docs: DataFrame, whole: bool) -> DataFrame:
    """Rows (*KEYS, start, end) of runs to remove; docs has KEYS (doc_id, and t to tell texts of one doc_id apart) and text."""
    rows = docs.filter("doc_id is not null and text is not null").select(*KEYS, F.explode(compared(F.col("text"), whole)).alias("w"))
    rows = materialize(rows.select(*KEYS, "w.*"), "line-runs")
    first = rows.groupBy("key").agg(F.min(_place()).alias("first"), F.max(_place()).alias("last")).filter("first < last")
    first = materialize(first.select("key", "first"), "line-first")
    marked = rows.join(first.hint("shuffle_hash"), "key").filter(_place() > F.col("first"))
    return materialize(marked.select(*KEYS, "start", "end").distinct(), "line-repeats")


def _merged(runs: DataFrame) -> DataFrame:
    """A row per document of runs: its runs in order, overlapping and adjoining ones joined, as an array (start, end)."""
    order = W.partitionBy(*KEYS).orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    rows = runs.withColumn("fresh", F.coalesce(F.col("start") > before + 1, F.lit(True)).cast("int"))
    rows = rows.withColumn("island", F.sum("fresh").over(order.rowsBetween(W.unboundedPreceding, 0)))
    rows = rows.groupBy(*KEYS, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return rows.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("runs"))


def _without(lines: Column, runs: Column) -> Column:
    """lines (an array) but those of runs, in one pass."""
    from_ = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(runs, i - 1)["end"] + 1)
    to = lambda i: F.when(i == F.size(runs), F.size(lines)).otherwise(F.get(runs, i)["start"])
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(runs)), lambda i: F.slice(lines, from_(i) + 1, to(i) - from_(i))))


def dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = None, removed: str | None = None, whole: bool = True) -> DataFrame:
    """df with repeated chunks removed from its text, and if ``whole`` every repeated run of lines with LONG words.

    n_chars names a column to hold the new length, removed one to append with the number of lines that went.
    """
    key = F.xxhash64(F.col(text))
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), key.alias("t"), F.col(text).alias("text"))
    names = private(df, "id", "t", "d", "u", "gone", "new")
    with scratch(df.sparkSession):
        gone = _merged(repeats(docs, whole)).select(F.col("doc_id").alias(names["d"]), F.col("t").alias(names["u"]), F.col("runs").alias(names["gone"]))
        gone = materialize(gone, "line-gone", result=True)
    rows = df.withColumn(names["id"], F.col(doc_id).cast("long")).withColumn(names["t"], key)
    joined = rows.join(gone.hint("shuffle_hash"), (F.col(names["id"]) == F.col(names["d"])) & (F.col(names["t"]) == F.col(names["u"])), "left")
    cut = F.col(names["gone"])
    new = _bind(F.split(F.col(text), "\n"), lambda lines: F.array_join(_without(lines, cut), "\n"))
    # a column of its own: text and length come from one evaluation
    joined = joined.withColumn(names["new"], F.when(cut.isNull(), F.col(text)).otherwise(new))
    out = []
    for c in df.columns:
        if c == text:
            out.append(F.col(names["new"]).alias(c))
        elif c == n_chars:
            out.append(F.coalesce(F.length(names["new"]), F.lit(0)).cast(df.schema[c].dataType).alias(c))
        elif removed is None or c.lower() != removed.lower():
            out.append(F.col(c))
    if removed:
        out.append(F.coalesce(F.aggregate(cut, F.lit(0), lambda n, r: n + r["end"] - r["start"] + 1), F.lit(0)).alias(removed))
    return joined.select(*out)
