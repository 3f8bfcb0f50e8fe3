"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a maximal run of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of one Arrow batch handed to a Python worker: this bounds its memory, however long single texts are.
ARROW_BYTES = 16 << 20
#: Paths of intermediate tables, by the innermost scratch() they were made in.
_scratch: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local master gets a new local folder (tests); on a cluster
    that would be another folder on each machine, so it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
        found = "file://" + tempfile.mkdtemp(prefix="quire-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str, result: bool = False) -> str:
    """A new path in the shared folder; a result of the innermost scratch() belongs to the one around it."""
    path = f"{shared_folder(spark)}/quire-{name}-{uuid.uuid4().hex}"
    owners = _scratch[:-1] if result else _scratch
    if owners:
        owners[-1].append(path)
    return path


def materialize(df: DataFrame, name: str, result: bool = False) -> DataFrame:
    """Write df to the shared folder and read it back: the lineage ends in files that outlive any executor."""
    path = new_path(df.sparkSession, name, result)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.quire_path = path
    return out


def remove(*frames: DataFrame) -> None:
    """Delete the files behind frames that materialize() returned and that nothing lazy reads any more."""
    for df in frames:
        _delete(df.sparkSession, df.quire_path)


def _delete(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are deleted at its end, so results must have been written by then."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            _delete(spark, path)


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, to one value that no operator changes; a smaller bound of the session's own stays."""
    own = str(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")).lower().removesuffix("b")
    if not own.isdigit() or int(own) > ARROW_BYTES or int(own) <= 0:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def arrow_map(
    df: DataFrame, columns: list[str], schema: T.StructType, rows: Callable[..., dict[str, list]]
) -> DataFrame:
    """Append to each row the columns that rows(*lists of columns) computes for a batch.

    The input columns in ``columns`` are given as Python lists (strings as UTF-8
    bytes); all other columns pass through untouched. A column of df that has the
    name of a computed one (in any case) is replaced by it.
    """
    names = [f.name for f in schema.fields]
    inner = list(private(df, *names).values())
    out = T.StructType(df.schema.fields + [T.StructField(i, f.dataType) for i, f in zip(inner, schema.fields, strict=True)])
    at = [df.columns.index(c) for c in columns]
    kinds = [_arrow(f.dataType) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = [texts(c) if pa.types.is_string(c.type) or pa.types.is_large_string(c.type) else c.to_pylist() for c in map(batch.column, at)]
            made = rows(*given)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(made[n], type=k) for n, k in zip(names, kinds, strict=True))],
                names=[*batch.schema.names, *inner],
            )

    taken = {n.lower() for n in names}
    kept = [f"`{c}`" for c in df.columns if c.lower() not in taken]
    return df.mapInArrow(run, out).select(*kept, *(F.col(i).alias(n) for i, n in zip(inner, names, strict=True)))


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def private(df: DataFrame, *names: str) -> dict[str, str]:
    """For each name, one that no column of df has (any case), so that extra columns never clash."""
    taken = {c.lower() for c in df.columns}
    out = {}
    for n in names:
        new = f"_q_{n}"
        while new.lower() in taken:
            new = "_" + new
        out[n] = new
        taken.add(new.lower())
    return out
