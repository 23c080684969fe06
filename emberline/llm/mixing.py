"""Mixing sources to target weights by hash-threshold histograms.

Each document has a 64-bit hash of its id. For each source, sizes are summed by bucket of the hash's leading bits;
the running sum over the buckets finds the bucket in which the source's budget is reached. Only that bucket is
summed again by its next bits, and so on, until the bucket is a single hash value in practice. What is left is one
threshold for each source, and a filter on the hash; nothing is sorted and no text is shuffled. Budgets are nested:
a larger budget of the same source takes a superset of a smaller one's documents.

There may be any number of sources: sums, targets and thresholds are tables with a row for each source, and the driver gets
only sums over all of them. Spark sends such a table to all tasks while it is below its broadcast limit
(spark.sql.autoBroadcastJoinThreshold; the tables are files, so their sizes are known) and joins by source beyond it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import TASK_BITS, arrow_map, materialise, named, quoted

#: Bits of a bucket at each level; the last level's buckets hold 2**-48 of a source.
LEVELS = (12, 12, 12, 12)
SEED = 10
WEIGHTS = (3.0, 1.0, 2.0)
#: What the sources share, in sizes of the whole table, and the most that a source gives, in its own size.
SHARE, MOST = 1.5, 2.0

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def count_words(col: pa.Array) -> np.ndarray:
    """Runs of bytes outside space and tab to carriage return, for each text of a column; null has none."""
    col = col.cast(pa.large_binary())
    out = np.zeros(len(col), np.int64)
    if not len(col):
        return out
    ends = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    first, last = int(ends[0]), int(ends[-1])
    if last > first:
        space = _SPACE[np.frombuffer(col.buffers()[2], np.uint8)[first:last]]
        begins = ~space
        begins[1:] &= space[:-1]
        starts = ends - first
        inner = starts[:-1][(np.diff(starts) > 0)]
        begins[inner] = ~space[inner]
        sums = np.concatenate([[0], np.cumsum(begins, dtype=np.int64)])
        out = sums[starts[1:]] - sums[starts[:-1]]
    if col.null_count:
        out[col.is_null().to_numpy(zero_copy_only=False)] = 0
    return out


def weighted(sums: DataFrame, weights: Sequence[float]) -> DataFrame:
    """sums (source, size) with the weight of each source: the weights in turn over the sources in order of their code
    points, null last. The driver gets one number for each partition."""
    order = [F.col("source").isNull(), F.col("source")]
    ordered = sums.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(ordered.withColumn("at", F.monotonically_increasing_id()), "mix-sources")
    task, before, offsets = F.shiftright("at", TASK_BITS), 0, []
    for p, n in sorted(map(tuple, placed.groupBy(task.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())):
        offsets += [F.lit(p), F.lit(before)]
        before += n
    rank = F.element_at(F.create_map(*offsets), task) + F.col("at").bitwiseAND(F.lit((1 << TASK_BITS) - 1)) if offsets else F.lit(0)
    turn = F.array(*[F.lit(float(w)) for w in weights])
    return placed.withColumn("weight", F.get(turn, (rank % len(weights)).cast("int"))).drop("at")


def with_targets(sources: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """sources (source, size, weight) with their targets: shares of share * sum(sizes) by weight, none above most * its
    size; the excess is shared anew by weight among the others until none is above.

    What a weight of 1 gets only grows from round to round, so it alone says which sources are full; a round is one
    aggregation.
    """
    shares = (F.col("size") > 0) & (F.col("weight") > 0)
    total = share * (sources.where(shares | (F.col("size") > 0)).agg(F.sum("size")).first()[0] or 0)
    unit, last = 0.0, None
    while unit != last:
        last = unit
        full = F.col("weight") * F.lit(unit) > F.lit(most) * F.col("size")
        held, left = sources.where(shares).agg(F.coalesce(F.sum(F.when(full, F.lit(most) * F.col("size"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        unit = max(unit, (total - held) / left) if left else float("inf")
    return sources.withColumn("target", F.when(shares, F.least(F.col("weight") * F.lit(unit), F.lit(most) * F.col("size"))).otherwise(F.lit(0.0)))


def sized(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """doc_id, source, size, h: one small row for each document, written to the shared folder."""
    rows = docs.select(quoted(id_col).alias("doc_id"), quoted(source_col).alias("source"), quoted(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(count_words(b.column(2)))], names=["doc_id", "source", "size"])

    out = arrow_map(rows, run, f"doc_id {id_type}, source string, size long")
    return materialise(out.withColumn("h", hashed()), "mix")


def hashed() -> Column:
    return F.xxhash64(F.lit(SEED), F.col("doc_id"))


def bucket(bits_before: int, bits: int) -> Column:
    """Of h, the bits after the leading bits_before."""
    return F.shiftrightunsigned("h", 64 - bits_before - bits).bitwiseAND(F.lit((1 << bits) - 1))


def thresholds(sizes: DataFrame, budgets: DataFrame, levels: Sequence[int] = LEVELS) -> DataFrame:
    """source, prefix: for each source the prefix (of sum(levels) bits) below which its documents fill its budget, from
    budgets (source, left), which are above 0 and below the source's size. One aggregation for each level; a source has at
    most 2 ** bits rows in it."""
    before, whole = 0, sum(levels)
    state = budgets.select(F.col("source").alias("s"), F.lit(0).cast("long").alias("p"), F.col("left").cast("double").alias("left"))
    for bits in levels:
        prefix = F.shiftrightunsigned("h", 64 - before) if before else F.lit(0)
        cells = sizes.select("source", "size", prefix.alias("prefix"), bucket(before, bits).alias("b"))
        inside = cells.join(state, cells["source"].eqNullSafe(state["s"]) & (cells["prefix"] == state["p"]))
        hist = inside.groupBy("s", "p", "left", "b").agg(F.sum("size").alias("size"))
        upto = F.sum("size").over(Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, 0))
        reached = hist.withColumn("upto", upto).where(F.col("upto") > F.col("left")).groupBy("s", "p", "left").agg(F.min(F.struct("b", "upto", "size")).alias("cell"))
        before += bits
        left = F.col("left") - F.col("cell.upto") + F.col("cell.size")
        # at the last level the boundary cell goes in whole if that brings the sum nearer to the budget
        more = (F.col("cell.size") - left < left).cast("long") if before == whole else F.lit(0)
        state = materialise(reached.select("s", (F.shiftleft("p", bits) + F.col("cell.b") + more).alias("p"), left.alias("left")), "mix-level")
    return state.select(F.col("s").alias("source"), F.col("p").alias("prefix"))


def mix_plan(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, levels: Sequence[int] = LEVELS) -> DataFrame:
    """source, source_size, target, repeats, prefix: one row for each source."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("size"))
    want = with_targets(weighted(sums, weights), share, most)
    repeats = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(F.lit(0)).cast("int")
    want = materialise(want.withColumn("repeats", repeats).withColumn("left", F.col("target") - F.col("repeats") * F.col("size")), "mix-targets")
    cut = thresholds(sizes, want.where("left > 0").select("source", "left"), levels).withColumnRenamed("source", "s")
    both = want.join(cut, F.col("source").eqNullSafe(F.col("s")), "left")
    return materialise(both.select("source", F.col("size").alias("source_size"), "target", "repeats", F.coalesce("prefix", F.lit(0)).alias("prefix")), "mix-plan")


def copies(levels: Sequence[int] = LEVELS) -> Column:
    """How often the mix takes a document, where h is its hash."""
    return F.col("repeats") + (F.shiftrightunsigned("h", 64 - sum(levels)) < F.col("prefix")).cast("int")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, levels: Sequence[int] = LEVELS) -> DataFrame:
    """What a mix of all documents takes: doc_id, size, source_size, target, copies, taken (words, copies counted).

    Size: words of the text (null: 0). Sources in order of their code points, null last, have the weights in turn
    and share ``share`` of all sizes; a target is at most ``most`` times its source's size and the excess is reshared.
    Documents of one hash (repeated ids, null ids) are taken or left together. Sources without words have target 0 and
    are not taken. An empty table gives an empty result; other columns of docs are ignored.
    """
    sizes = sized(docs, id_col, source_col, text_col)
    plan = mix_plan(sizes, weights, share, most, levels).alias("p")
    both = sizes.alias("d").join(plan, F.col("d.source").eqNullSafe(F.col("p.source")))
    return both.select("doc_id", "size", "source_size", "target", copies(levels).alias("copies")).withColumn("taken", F.col("size") * F.col("copies"))


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The documents that the mix takes, with all their columns, each as often as it is taken.

    Null texts have no words but are taken by their hash like others of their source; documents of one hash (repeated ids, null
    ids) are taken or left together; sources without words are not taken; an empty table gives an empty result. Columns may
    have any names.
    """
    plan = mix_plan(sized(docs, id_col, source_col, text_col)).select("source", "repeats", "prefix")
    keyed = docs.select(F.struct(*named(docs)).alias("row"), F.col(source_col).alias("s"), F.col(id_col).alias("doc_id")).withColumn("h", hashed())
    both = keyed.join(plan, F.col("s").eqNullSafe(F.col("source")))
    often = both.select("row", F.explode(F.array_repeat(F.lit(1), copies())))
    return often.select("row.*")
