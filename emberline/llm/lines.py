"""Line dedup by a sharded minimal perfect hash.

Every distinct line key that more than one document holds goes, by its 128-bit hash, into one of many shards. A shard
is a minimal perfect hash (bit levels with ranks) over its keys and three arrays in its order: the other half of the
hash as fingerprint, the number of documents, and the smallest document id. Documents hash their lines and probe the
arrays; lines and texts are never joined.

There is no bound on the index: no task holds more than one shard. The probes (16 bytes of hash, the row's number, a
line's number, the id) are dealt to the shards, those of a shard with frequent keys by a salt as well, and only the
numbers of the lines that go come back. The texts stay where they were read: they are in buckets by the task that wrote
them, and a task gets the answers of its rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .shared import arrow_map, materialise, n_parts, numbered, quoted, told, utf8

#: Keys with fewer code points are left alone.
MIN_CHARS = 10
#: Keys of a shard and probes of a task, at most about.
SHARD_KEYS, TASK_PROBES = 500_000, 1_000_000
#: Stands for a null id, and for what an index doesn't hold.
NO_ID = (1 << 63) - 1
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def key(line: bytes) -> bytes:
    """The line without [\\x20\\x09-\\x0D] at either end, A-Z in lower case (what strip() and lower() of bytes do)."""
    return line.strip().lower()


def long_enough(k: bytes, least: int = MIN_CHARS) -> bool:
    return len(k) >= least and (len(k) >= 4 * least or len(k.decode("utf-8", "replace")) >= least)


def hashes(keys: list[bytes]) -> np.ndarray:
    """n x 2 halves of the keys' 128-bit hashes."""
    raw = b"".join([xxhash.xxh3_128_digest(k) for k in keys])
    return np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, 2)


def spread(h: np.ndarray, level: int) -> np.ndarray:
    """Another hash of h's rows for each level."""
    x = h[:, 0] + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1)) ^ (h[:, 1] * _M2)
    x ^= x >> np.uint64(33)
    x *= _M1
    x ^= x >> np.uint64(29)
    return x * _M2


class PerfectHash:
    """A minimal perfect hash: at each level keys that meet no other key of the level are placed, the rest go on."""

    def __init__(self, h: np.ndarray, gamma: float = 2.0):
        self.n, self.levels, left = len(h), [], h
        while len(left):
            m = max(64, int(gamma * len(left)))
            pos = (spread(left, len(self.levels)) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(pos, minlength=m) == 1
            self.levels.append((m, np.packbits(alone)))
            left = left[~alone[pos]]
            if len(self.levels) > 200:
                raise ValueError("two keys have one hash")

    def ready(self) -> PerfectHash:
        """Unpacks the bits and counts their ranks."""
        self.bits, self.ranks, base = [], [], 0
        for m, packed in self.levels:
            bits = np.unpackbits(packed, count=m).astype(bool)
            self.bits.append(bits)
            self.ranks.append((base + np.cumsum(bits) - 1).astype(np.uint32))
            base += int(bits.sum())
        return self

    def __call__(self, h: np.ndarray) -> np.ndarray:
        """The slots of h's rows; any slot or -1 for a key that is not in the index."""
        out, at = np.full(len(h), -1, np.int64), np.arange(len(h))
        for level, (m, _) in enumerate(self.levels):
            if not len(at):
                break
            pos = (spread(h[at], level) % np.uint64(m)).astype(np.int64)
            hit = self.bits[level][pos]
            out[at[hit]] = self.ranks[level][pos[hit]]
            at = at[~hit]
        return out


class Shard:
    """A perfect hash with arrays of fingerprints, smallest ids and counts."""

    def __init__(self, h: np.ndarray, first: np.ndarray, count: np.ndarray):
        self.index = PerfectHash(h)
        slot = self.index.ready()(h)
        self.prints, self.first, self.count = np.empty(len(h), np.uint64), np.empty(len(h), np.int64), np.empty(len(h), np.uint32)
        self.prints[slot], self.first[slot], self.count[slot] = h[:, 1], first, np.minimum(count, 2**32 - 1)
        del self.index.bits, self.index.ranks

    def probe(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of h the number of documents that hold the key and the smallest of their ids; 0 and NO_ID where
        the key is not in the index."""
        if not hasattr(self.index, "bits"):
            self.index.ready()
        slot = self.index(h)
        hit = slot >= 0
        hit[hit] = self.prints[slot[hit]] == h[hit, 1]
        count, first = np.zeros(len(h), np.int64), np.full(len(h), NO_ID, np.int64)
        count[hit], first[hit] = self.count[slot[hit]], self.first[slot[hit]]
        return count, first


def as_number(column: str, kind: str) -> Column:
    """An id as a whole number: itself, a hash where it is of another type, NO_ID where it is null."""
    own = F.col(column).cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else F.when(F.col(column).isNotNull(), F.xxhash64(column))
    return F.coalesce(own, F.lit(NO_ID))


def keys_of(rows: DataFrame, least: int) -> DataFrame:
    """h1, h2, id of each distinct long enough key of each row (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in batches:
            of, keys = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                own = {k for k in map(key, utf8(t).split(b"\n")) if long_enough(k, least)}
                keys += own
                of += [i] * len(own)
            h = hashes(keys).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), b.column(0).take(pa.array(of, pa.int64()))], names=["h1", "h2", "id"])

    return arrow_map(rows, run, f"h1 long, h2 long, id {rows.schema['id'].dataType.simpleString()}")


def repeated_keys(rows: DataFrame, least: int) -> DataFrame:
    """h1, h2, first (smallest id), count (of rows) of each key that at least two documents (ids) hold; null ids are one
    document, after all others. Sums are made before the shuffle."""
    held = keys_of(rows, least).groupBy("h1", "h2").agg(
        F.min("id").alias("first"), F.max("id").alias("last"), F.count("id").alias("ids"), F.count(F.lit(1)).alias("count"))
    return held.where((F.col("first") < F.col("last")) | (F.col("ids") > 0) & (F.col("ids") < F.col("count"))).drop("last", "ids")


def build_index(rows: DataFrame, least: int = MIN_CHARS, shard_keys: int = SHARD_KEYS, task_probes: int = TASK_PROBES) -> tuple[DataFrame, int]:
    """The table (shard, weight, blob) in the shared folder, and the number of shards. Weight: documents of its keys."""
    kind = rows.schema["id"].dataType.simpleString()
    keys = materialise(repeated_keys(rows, least).withColumn("first", as_number("first", kind)), "line-keys")
    n, held = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("count"), F.lit(0))).first()
    shards = max(1, n_parts(rows.sparkSession), -(-n // shard_keys), -(-held // task_probes))
    which = F.pmod(F.shiftrightunsigned("h1", 32), F.lit(shards))

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        h = pdf[["h1", "h2"]].to_numpy().astype(np.int64).view(np.uint64)
        made = Shard(h, pdf["first"].to_numpy(), pdf["count"].to_numpy())
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "weight": [int(pdf["count"].sum())], "blob": [pickle.dumps(made)]})

    built = keys.withColumn("shard", which).groupBy("shard").applyInPandas(make, "shard long, weight long, blob binary")
    return materialise(built, "line-shards"), shards


def rebuilt(text: str | None, gone: Sequence[int] | None) -> tuple[str, int, int]:
    """The text without the lines that have a key of those numbered; its lines before, and how many went."""
    own = utf8(text).split(b"\n")
    if gone is None:
        return text or "", len(own), 0
    drop = {key(own[j]) for j in gone}
    kept = [x for x in own if key(x) not in drop]
    return b"\n".join(kept).decode("utf-8"), len(own), len(own) - len(kept)


def dropped(rows: DataFrame, index: DataFrame, shards: int, least: int, task_probes: int) -> DataFrame:
    """n, value: of each row (id, text, n) of another document than the first that holds a key, the number of the first
    line with that key."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in batches:
            keys, of, line = [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                own: dict[bytes, int] = {}
                for j, k in enumerate(map(key, utf8(t).split(b"\n"))):
                    if k not in own and long_enough(k, least):
                        own[k] = j
                keys += own
                line += own.values()
                of += [i] * len(own)
            h, at = hashes(keys), pa.array(of, pa.int64())
            halves = [pa.array(np.ascontiguousarray(h[:, i]).view(np.int64)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*halves, b.column(2).take(at), pa.array(line, pa.int32()), b.column(0).take(at)], names=["h1", "h2", "n", "line", "id"])

    probes = arrow_map(rows.select("id", "text", "n"), asked, "h1 long, h2 long, n long, line int, id long")
    probes = probes.withColumn("shard", F.pmod(F.shiftrightunsigned("h1", 32), F.lit(shards)))
    # only a shard with frequent keys gets more than one task; the list has a row for each task_probes probes at most
    salts = F.least(F.floor(F.col("weight") / task_probes) + 1, F.lit(1 << 20)).cast("int")
    arrays = index.select("shard", "blob", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    hot = F.broadcast(index.select("shard", salts.alias("salts")).where("salts > 1"))
    probes = probes.join(hot, "shard", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("n", "line"), F.col("salts")), F.lit(0)).cast("int")).drop("salts")

    def answer(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"n": pd.Series([], dtype="int64"), "value": pd.Series([], dtype="int32")})
        h = left[["h1", "h2"]].to_numpy().astype(np.int64).view(np.uint64)
        count, first = pickle.loads(right["blob"].iloc[0]).probe(h)
        return left.loc[(count > 1) & (first != left["id"].to_numpy()), ["n", "line"]].rename(columns={"line": "value"})

    return probes.groupBy("shard", "salt").cogroup(arrays.groupBy("shard", "salt")).applyInPandas(answer, "n long, value int")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_CHARS, shard_keys: int = SHARD_KEYS, task_probes: int = TASK_PROBES, counts: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """docs with its text without repeated lines, and the columns ``counts``: lines before, lines dropped.

    A text is split at \\n; null or empty is one empty line. Lines whose key (``key``) has at least ``least`` code
    points and is held by two documents go, except from the document of the smallest id that holds it, where all
    stay. Ids are of any type that has an order. Null ids count as one document after all others; rows of one id are one
    document. All columns of docs stay (but those with the names in ``counts``, in any case of letters, are replaced); the
    text of a document that loses nothing is unchanged, except that null becomes empty. An empty table gives an empty result.
    """
    replaced = {c.lower() for c in counts}
    docs = docs.select(*[quoted(c) for c in docs.columns if c.lower() not in replaced])
    at_text = docs.columns.index(text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    index, shards = build_index(docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")), least, shard_keys, task_probes)
    inner = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    row = F.struct(*[F.col(c) for i, c in enumerate(inner.columns) if i != at_text], F.lit(0).alias("none"))
    rows = numbered(inner.select(row.alias("row"), as_number(f"c{docs.columns.index(id_col)}", kind).alias("id"), F.col(f"c{at_text}").alias("text")), "line-rows")
    all_ = told(rows, dropped(rows, index, shards, least, task_probes), "gone").select("row", "text", "gone")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in batches:
            made = [rebuilt(t, gone) for t, gone in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            arrays = [pa.array([m[i] for m in made], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays], names=["row", "text", "n_lines", "n_dropped"])

    done = arrow_map(all_, apply, f"row {rows.schema['row'].dataType.simpleString()}, text string, n_lines long, n_dropped long")
    fields = [F.col("row")[f"c{i}"].alias(c) if i != at_text else F.col("text").alias(c) for i, c in enumerate(docs.columns)]
    return done.select(*fields, F.col("n_lines").alias(counts[0]), F.col("n_dropped").alias(counts[1]))


#: The same for the table ``documents``: one row for each document, the digest of what stays.
SQL = r"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
arr AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM doc),
line AS (SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line FROM arr),
keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM line),
held AS (SELECT k, min(doc_id) AS first_id FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT a.doc_id, a.pos, a.line, h.first_id IS NOT NULL AND h.first_id <> a.doc_id AS gone
  FROM keyed a LEFT JOIN held h ON a.k = h.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""
