"""Exact dedup by content sort, with DataFrame operations only.

Normalised texts are range-partitioned by splitters that Spark samples, sorted within the partitions (an external
sort), and neighbours are compared in full. The range key is short (leading bytes and a hash), so the sampled
splitters stay small however long the texts are; the sort key and the comparison are the whole text. Texts are read and
normalised once and written to the shared folder; splitters, frequent texts and the sort take them from there.

A text that holds a large share of all rows would fill one range. Such texts are found in a bounded sample and
get more than one range (a salt); only their few partial results, one for each salt, are then merged by digest.
The sample decides only where a salt is used, never which texts are equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import materialise, n_parts, quoted

#: What normalisation deletes: space and the five ASCII controls from tab to carriage return.
DELETED = r"[\x20\x09-\x0D]+"
#: Leading characters of a text in the range key.
LEAD = 24
#: Rows of the sample that shows frequent texts, and the least sightings of one in it.
SAMPLE_ROWS, SIGHTINGS = 20_000, 8


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), DELETED, "")


def frequent_texts(work: DataFrame, parts: int, sample_rows: int = SAMPLE_ROWS) -> list[tuple[int, int]]:
    """(hash, salts) of texts with over half a partition's share of rows, as a sample shows; 2 * parts entries at most.
    Only the rows' numbers and hashes are read."""
    rows = work.count()
    step = max(1, rows // sample_rows)
    seen = work.where(F.pmod(F.xxhash64("row"), F.lit(step)) == 0) if step > 1 else work
    floor = max(SIGHTINGS, -(-min(rows, sample_rows) // (2 * parts)))
    found = seen.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= floor).orderBy(F.desc("n"), "h").limit(2 * parts).collect()
    return [(r.h, 1 + -(-r.n // floor)) for r in found]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS, parts: int | None = None) -> DataFrame:
    """Groups of equal texts: one row for each row of docs, with its group's representative.

    Texts are equal when identical after deleting every character of ``DELETED``; null counts as empty. Of a group,
    the row with the most code points in the original text stays, then the one with the smallest id.

    Returns doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text). Nulls: a null id sorts after
    every other id, so it represents a group only if no row of greatest length has an id. Repeated rows (same id and
    text) are members of their own; all rows with keep_id count as kept. An empty table gives an empty result. Other
    columns of docs are ignored, whatever their names.
    """
    spark = docs.sparkSession
    parts = parts or n_parts(spark)
    rows = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text"))
    work = rows.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n"), normalised(F.col("text")).alias("norm"))
    work = materialise(work.withColumns({"lead": F.substring("norm", 1, LEAD), "h": F.xxhash64("norm"), "row": F.monotonically_increasing_id()}), "exact-norm")
    hot = frequent_texts(work, parts, sample_rows)
    extra = []
    if hot:
        salts = F.broadcast(spark.createDataFrame(hot, "h long, salts int"))
        salt = F.coalesce(F.pmod(F.xxhash64("row"), F.col("salts")), F.lit(0))
        work = work.join(salts, "h", "left").withColumn("salt", salt.cast("int"))
        extra = ["salt"]
    # the windows' keys hold the range's, so what the range put together is not dealt again
    ranged = work.repartitionByRange(parts, "lead", "h", *extra)
    equal = Window.partitionBy("lead", "h", *extra, "norm")
    ordered = equal.orderBy(F.desc("n"), F.col("doc_id").asc_nulls_last())
    near = ranged.select(
        "doc_id", F.sha2("norm", 256).alias("text_sha256"), *(["salts"] if hot else []),
        F.first("doc_id").over(ordered).alias("best_id"), F.first("n").over(ordered).alias("best_n"),
        F.count(F.lit(1)).over(equal).alias("members"), F.row_number().over(ordered).alias("rank"),
    )
    if hot:
        near = materialise(near, "exact")
        heads = near.where(F.col("salts").isNotNull() & (F.col("rank") == 1))
        order = F.struct((-F.col("best_n")).alias("n"), F.col("best_id").isNull().alias("no_id"), F.col("best_id").alias("id"))
        merged = heads.groupBy("text_sha256").agg(F.min(order).alias("best"), F.sum("members").alias("all"))
        whole = F.broadcast(merged.select("text_sha256", F.col("best.id").alias("all_id"), "all"))
        near = near.join(whole, "text_sha256", "left")
        keep, size = F.when(F.col("all").isNull(), F.col("best_id")).otherwise(F.col("all_id")), F.coalesce("all", "members")
    else:
        keep, size = F.col("best_id"), F.col("members")
    return near.select("doc_id", keep.alias("keep_id"), size.alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


#: The same for the table ``documents``, for an engine with regexp_replace, sha256 and windows.
SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_chars DESC, doc_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_chars DESC, doc_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS kept,
       sha256(norm) AS text_sha256
FROM n"""
