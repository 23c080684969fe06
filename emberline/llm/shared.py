"""What the operators of this subpackage share: numbered tables, Arrow maps, byte classes."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..shipping import ship
from ..tables import materialise, new_path

#: Rows and bytes of one Arrow batch at most, so that a batch of long texts fits in a worker.
BATCH_ROWS, BATCH_BYTES = 256, 8 << 20


#: Bits of a row's number within its task, below the task's number (monotonically_increasing_id).
TASK_BITS = 33


def numbered(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder with two more columns, ``task`` and ``n`` (the row's number, which holds its
    task's), as a table in buckets by task: what is later known of a row can come to it, and the row stays in place."""
    spark = df.sparkSession
    path = new_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    rows = df.withColumn("n", F.monotonically_increasing_id())
    rows = rows.withColumn("task", F.shiftright("n", TASK_BITS))
    rows.write.bucketBy(n_parts(spark), "task").option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def told(rows: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """rows (of ``numbered``) with the column ``name``: the array of all values (int) that ``found`` (n, value) has of the
    row, null if it has none.

    Only found is shuffled, by task: a task's values become one array over its rows, as many as one task read. rows stay in
    their buckets; each takes its own out of its task's array.
    """

    def dense(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        at = pdf["n"].to_numpy() & ((1 << TASK_BITS) - 1)
        order = np.argsort(at, kind="stable")
        at, value = at[order], pdf["value"].to_numpy()[order]
        starts = np.nonzero(np.diff(at, prepend=-1))[0]
        out: list = [None] * (int(at[-1]) + 1)
        for i, own in zip(at[starts].tolist(), np.split(value, starts[1:])):
            out[i] = own
        return pd.DataFrame({"task": [key[0]], "all": [out]})

    ship(rows.sparkSession)
    by_task = found.select(F.shiftright("n", TASK_BITS).alias("task"), "n", F.col("value").cast("int").alias("value")).groupBy("task")
    arrays = by_task.applyInPandas(dense, "task long, all array<array<int>>").withColumnRenamed("task", "of_task").hint("shuffle_hash")
    both = rows.join(arrays, F.col("task") == F.col("of_task"), "left")
    own = F.get(F.col("all"), F.col("n").bitwiseAND(F.lit((1 << TASK_BITS) - 1)).cast("int"))
    return both.select(*[quoted(c) for c in rows.columns], own.alias(name))


_RESIDENT: dict = {}


def resident(make: Callable, *key):
    """make(*key), kept for the worker's later tasks. A worker keeps one such object: before another is made, the one of
    an earlier stage is freed and its memory goes back to the system, as workers serve all stages of an application."""
    name = (make, *key)
    found = _RESIDENT.get(name)
    if found is None:
        _RESIDENT.clear()
        gc.collect()
        trim()
        found = _RESIDENT[name] = make(*key)
    return found


def trim() -> None:
    """Gives memory that this process has freed back to the system (where the C library has a call for that)."""
    pa.default_memory_pool().release_unused()
    if give_back := getattr(ctypes.CDLL(None), "malloc_trim", None):
        give_back(0)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with batches of bounded rows and bytes; a worker between tasks holds no memory that it has freed."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        trim()

    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def appended(df: DataFrame, column: str, out: list[tuple[str, str, pa.DataType]], fn: Callable[[pa.Array], list], keep: bool = True, at_once: int | None = None) -> DataFrame:
    """df with new columns made from one of its columns, row by row; without that column if keep is false. fn gets rows of
    about ``at_once`` bytes at a time (one row at least), where what it makes is much larger than what it gets.

    out has (name, Spark type, Arrow type); fn takes the column of a batch and gives the new columns, as lists or arrays.
    A column of df with a new column's name, in any case of letters, is replaced. Columns go through the workers under their positions, so they
    may bear any name; the column itself goes there once.
    """
    names, at = {n.lower() for n, _, _ in out}, df.columns.index(column)
    inner = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    others = [i for i, c in enumerate(df.columns) if c.lower() not in names and i != at]
    stays = keep and column.lower() not in names
    rows = inner.select(F.col(f"c{at}").alias("value"), *([F.struct(*[F.col(f"c{i}") for i in others]).alias("row")] if others else []))
    types, passed = [t for _, _, t in out], [*(["value"] if stays else []), *(["row"] if others else [])]
    first = 0 if stays else 1
    header = [*passed, *[n for n, _, _ in out]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches if at_once is None else (p for whole in batches for p in pieces(whole, at_once)):
            arrays = [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(fn(b.column(0)), types)]
            yield pa.RecordBatch.from_arrays([*b.columns[first:], *arrays], names=header)

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    done = arrow_map(rows, run, ", ".join([*[f"{n} {kinds[n]}" for n in passed], *[f"`{n}` {t}" for n, t, _ in out]]))
    own = {i: F.col("row")[f"c{i}"] for i in others} | ({at: F.col("value")} if stays else {})
    return done.select(*[own[i].alias(df.columns[i]) for i in sorted(own)], *[F.col(f"`{n}`") for n, _, _ in out])


def pieces(b: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``most`` bytes of its first column (text or binary), one row at least."""
    size = pc.binary_length(b.column(0)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.nonzero(np.diff(np.cumsum(size) // most, prepend=-1))[0].tolist()
    for a, e in zip(starts, [*starts[1:], b.num_rows]):
        yield b.slice(a, e - a)


def utf8(text: str | None) -> bytes:
    """The UTF-8 of a text; null is empty."""
    return b"" if text is None else text.encode("utf-8")


def named(df: DataFrame) -> list[Column]:
    """df's columns, whatever characters are in their names."""
    return [quoted(c) for c in df.columns]


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores after it as it takes to be no column of df (in any case of letters)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


def n_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
