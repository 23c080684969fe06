"""SimHash near-dedup by a Gray-order hierarchical index.

Fingerprints (64 bits) are linked at RADIUS or fewer differing bits; classes are the connected components.

Deal: the 64 bits are cut into RADIUS + 1 blocks. Of two fingerprints that differ in RADIUS bits or fewer, some block is
equal, so each fingerprint goes once for each block to the group of those that agree in it. No pair is missed.

Index: every group, whatever its size, is a hierarchical index. Its fingerprints are sorted by Gray rank, so that
neighbours share long bit patterns. Leaves take LEAF neighbours, upper nodes FANOUT nodes below; a node keeps the bits
that all below it share (mask and pattern). Two nodes are compared by the differing bits among those that both share:
this accumulated difference is a lower bound for all pairs below, so beyond RADIUS the whole pair of nodes is pruned.
Nodes whose members are already in one class are pruned too; so a large class costs no pair for each pair of its
members. In a group of n unlike fingerprints each meets about C(log n, RADIUS) leaves, not n. A group yields the links
of a spanning forest, one for each member at most. All groups of a batch are walked together.

Hot groups: a sample of fingerprints shows groups far above a task's share; those are cut in chunks and each
pair of chunks is a task of its own. Links are joined to classes by large-star / small-star rounds over tables in the
shared folder; neither links nor fingerprints go to the driver. Joins by a fingerprint or a class send what belongs to
its few frequent ones (their number is bounded) to all tasks instead of all its rows to one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .shared import appended, arrow_map, materialise, n_parts, numbered, quoted, told, utf8

#: Words of a shingle, seed of its XXH64, differing bits of a link.
WORDS, SEED, RADIUS = 4, 42, 4
LEAF, FANOUT = 2, 4
#: Fingerprints of the sample that shows hot groups; fingerprints of a chunk at least; node pairs looked at together.
SAMPLE, CHUNK, FRONTIER = 20_000, 16_384, 1 << 18


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """A bit is set if it is set in over half of the shingles' hashes. Words are runs outside [\\x20\\x09-\\x0D], A-Z in
    lower case; with fewer than ``words`` the whole sequence is the only shingle; without any the fingerprint is 0."""
    own = utf8(text).lower().split()
    if not own:
        return 0
    line = b" ".join(own)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
    n = max(1, len(own) - words + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    stops = ends[-n:].tolist()
    return majority([line[a:b] for a, b in zip(starts, stops)], seed)


def majority(shingles: list[bytes], seed: int) -> int:
    n = len(shingles)
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        part = h[at : at + 4096].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The position of x in the reflected Gray code."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def block_masks(radius: int = RADIUS) -> list[int]:
    """The masks of radius + 1 blocks of bits."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]


class Forest:
    """Union-find over 0..n-1; the root of a class is its smallest member."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def flatten(self) -> np.ndarray:
        while not np.array_equal(up := self.root[self.root], self.root):
            self.root = up
        return self.root

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Joins the classes of a[i] and b[i], all at once: roots hook to smaller roots until none is left to hook."""
        while True:
            ra, rb = self.flatten()[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            hi, lo = np.maximum(ra[apart], rb[apart]), np.minimum(ra[apart], rb[apart])
            np.minimum.at(self.root, hi, lo)


def cut(group: np.ndarray, size: int) -> np.ndarray:
    """Where nodes of ``size`` members begin, from the members' sorted group numbers; no node crosses a group's end."""
    at = np.arange(len(group))
    new = np.diff(group, prepend=-1) != 0
    return np.nonzero((at - np.maximum.accumulate(np.where(new, at, 0))) % size == 0)[0]


class GrayIndex:
    """The hierarchical index over fingerprints in Gray order, one tree for each group (numbers from 0, sorted)."""

    def __init__(self, prints: np.ndarray, group: np.ndarray | None = None, leaf: int = LEAF, fanout: int = FANOUT):
        group = np.zeros(len(prints), np.int64) if group is None else group
        order = np.lexsort((gray_rank(prints), group))
        self.x, of = prints[order], group[order]
        self.groups = len(cut(of, len(of) + 1))
        ones, zeros, size = self.x, ~self.x, leaf
        self.levels = []  # of each level's nodes: where those below begin and end, mask of shared bits, their values
        while not self.levels or len(ones) > self.groups:
            below, starts = len(ones), cut(of, size)
            ones, zeros, of = np.bitwise_and.reduceat(ones, starts), np.bitwise_and.reduceat(zeros, starts), of[starts]
            self.levels.append((starts, np.append(starts[1:], below), ones | zeros, ones))
            size = fanout
        self.group = group[order]

    def deepen(self, depth: int) -> None:
        """More levels on top, of one node for each group."""
        every = np.arange(self.groups)
        while len(self.levels) < depth:
            self.levels.append((every, every + 1, *self.levels[-1][2:]))

    def classes(self, root: np.ndarray) -> list[np.ndarray]:
        """For each level the class that all below a node are in, or -1."""
        out, low, high = [], root, root
        for starts, *_ in self.levels:
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            out.append(np.where(low == high, low, -1))
        return out


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def link(left: GrayIndex, right: GrayIndex | None, radius: int = RADIUS, frontier: int = FRONTIER, seen: Counter | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) of a spanning forest over the fingerprints of left and right (which have the same groups), or of left
    alone. Only pairs of one group are linked.

    Pairs of nodes go down together; a pair is pruned by its accumulated difference or because both are in one class
    already. ``seen`` counts the pairs of nodes met and pruned, and the pairs of fingerprints compared.
    """
    same = right is None
    right = left if same else right
    n, m = len(left.x), 0 if same else len(right.x)
    depth = max(len(left.levels), len(right.levels))
    left.deepen(depth)
    right.deepen(depth)
    prints = left.x if same else np.concatenate([left.x, right.x])
    forest, shift = Forest(n + m), 0 if same else n
    if same and n > 1:  # neighbours in Gray order first: most of a class is then one before pairs of nodes are looked at
        near = np.nonzero((popcount(left.x[1:] ^ left.x[:-1]) <= radius) & (left.group[1:] == left.group[:-1]))[0]
        forest.join(near, near + 1)
    every = np.arange(left.groups)
    stack = [(depth - 1, every, every)]
    root = forest.flatten()
    known = (left.classes(root[:n]), right.classes(root[shift : shift + len(right.x)]))
    fresh = 0
    while stack:
        level, a, b = stack.pop()
        (sa, ea, ma, va), (sb, eb, mb, vb) = left.levels[level], right.levels[level]
        near = popcount((va[a] ^ vb[b]) & ma[a] & mb[b]) <= radius
        ca, cb = known[0][level][a], known[1][level][b]
        keep = near & ((ca < 0) | (ca != cb))
        if seen is not None:
            seen.update(nodes=len(a), far=int((~near).sum()), joined=int((near & ~keep).sum()))
        a, b = a[keep], b[keep]
        if not len(a):
            continue
        below = (eb - sb)[b]
        many = (ea - sa)[a] * below
        upto = np.cumsum(many)
        if upto[-1] > frontier and len(a) > 1:  # the rest waits
            first = max(1, int(np.searchsorted(upto, frontier, side="right")))
            stack.append((level, a[first:], b[first:]))
            a, b, below, many, upto = a[:first], b[:first], below[:first], many[:first], upto[:first]
            if seen is not None:
                seen["nodes"] -= len(stack[-1][1])
        p = np.repeat(np.arange(len(a)), many)
        i, j = np.divmod(np.arange(upto[-1]) - np.repeat(upto - many, many), below[p])
        i, j = i + sa[a][p], j + sb[b][p]
        if same:
            ordered = i <= j if level else i < j
            i, j = i[ordered], j[ordered]
        if level:
            stack.append((level - 1, i, j))
            continue
        hit = popcount(left.x[i] ^ right.x[j]) <= radius
        if seen is not None:
            seen["compared"] += len(i)
        forest.join(i[hit], j[hit] + shift)
        fresh += 1
        if stack and (fresh & (fresh - 1) == 0 or fresh % 16 == 0):
            root = forest.flatten()
            known = (left.classes(root[:n]), right.classes(root[shift : shift + len(right.x)]))
    root = forest.flatten()
    child = np.nonzero(root != np.arange(n + m))[0]
    return prints[child], prints[root[child]]


def linked(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """From rows (table, key, i, j, side, fp) sorted by all but fp: links (u, v), u > v. A batch's groups are walked together;
    its last one waits for its end, as the next batch may go on with it."""

    def emit(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        a, b = a.view(np.int64), b.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["u", "v"])

    def walk(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        t, k, i, j, side, fp = rows
        new = (np.diff(t) != 0) | (np.diff(k) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)
        group = np.concatenate([[0], np.cumsum(new)])
        size = np.bincount(group)
        alone = (i == j) & (size[group] > 1)
        if alone.any():
            yield emit(*link(GrayIndex(fp[alone], np.unique(group[alone], return_inverse=True)[1]), None))
        for g in np.unique(group[i != j]).tolist():
            a, b = fp[(group == g) & (side == 0)], fp[(group == g) & (side == 1)]
            if len(a) and len(b):
                yield emit(*link(GrayIndex(a), GrayIndex(b)))

    held: list[list[np.ndarray]] = []
    for b in batches:
        if not b.num_rows:
            continue
        rows = [b.column(c).to_numpy(zero_copy_only=False) for c in range(6)]
        rows[5] = rows[5].view(np.uint64)
        differs = np.logical_or.reduce([r[1:] != r[:-1] for r in rows[:4]]) if b.num_rows > 1 else np.zeros(0, bool)
        last = int(np.nonzero(differs)[0][-1]) + 1 if differs.any() else 0
        if held and any(h[0] != r[0] for h, r in zip(held[-1][:4], rows[:4])):  # what was held has ended
            yield from walk([np.concatenate(x) for x in zip(*held)])
            held = []
        if last:
            held.append([r[:last] for r in rows])
            yield from walk([np.concatenate(x) for x in zip(*held)])
            held = []
        held.append([r[last:].copy() for r in rows])
    if held:
        yield from walk([np.concatenate(x) for x in zip(*held)])


def links(prints: DataFrame, distinct: int, radius: int = RADIUS, parts: int | None = None, chunk: int = CHUNK, sample: int = SAMPLE) -> DataFrame:
    """u, v (signed fingerprints, u > v): links that connect every class of the distinct fingerprints fp."""
    spark = prints.sparkSession
    masks = block_masks(radius)
    parts = parts or n_parts(spark)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for t, m in enumerate(signed)])
    dealt = prints.select("fp", F.inline(tables).alias("t", "k"))
    # a group is cut if it holds more than a chunk and more than a quarter of a task's even share
    limit = max(chunk, distinct * len(masks) // (4 * parts))
    step = max(1, distinct // sample)
    floor = max(2, limit // step)
    hot = []
    if distinct > limit:
        some = dealt.where(F.pmod(F.xxhash64("fp"), F.lit(step)) == 0)
        found = some.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > floor)
        hot = [(r.t, r.k, 1 + r.n // floor) for r in found.orderBy(F.desc("n"), "t", "k").limit(8 * parts * len(masks)).collect()]
    if hot:
        few = F.broadcast(spark.createDataFrame(hot, "t int, k long, c int"))
        dealt = dealt.join(few, ["t", "k"], "left").withColumn("c", F.coalesce("c", F.lit(1)))
    else:
        dealt = dealt.withColumn("c", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), F.col("c")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("c") - 1), lambda o: F.struct(F.least(own, o).alias("i"), F.greatest(own, o).alias("j"), (own > o).cast("int").alias("side")))
    rows = dealt.select("t", "k", F.inline(pairs), "fp").select("t", "k", "i", "j", "side", "fp")
    rows = rows.repartition(parts, "t", "k", "i", "j").sortWithinPartitions("t", "k", "i", "j")
    conf, name = spark.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)
    conf.set(name, "65536")
    try:
        return materialise(rows.mapInArrow(linked, "u long, v long").distinct(), "sim-links")
    finally:
        conf.set(name, before)


def join_frequent(rows: DataFrame, of: DataFrame, on: str, total: int) -> DataFrame:
    """rows.join(of, on): of has each key once, and in ``n`` how many of the ``total`` rows have it. What of has of the keys
    with more than a quarter of a task's share (4 for each task at most) goes to all tasks, so none gets all their rows."""
    parts = n_parts(rows.sparkSession)
    limit = max(10_000, total // (4 * parts))
    if total <= limit:
        return rows.join(of, on)
    few = F.broadcast(of.where(F.col("n") > limit))
    rest = rows.join(few.select(on), on, "left_anti").join(of.where(F.col("n") <= limit), on)
    return rows.join(few, on).unionByName(rest)


def components(edges: DataFrame) -> DataFrame:
    """node, root for each node of edges (u > v), root the smallest node of its component: large-star / small-star.

    A round is two aggregations and two joins; each is written to the shared folder and the rounds end when one
    changes nothing, after about the logarithm of the longest chain.
    """
    sign = lambda e: e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    last = sign(edges)
    while last.n:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.sum((F.col("v") > F.col("u")).cast("long")).alias("n"))
        large = join_frequent(both.where("v > u"), least, "u", last.n).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = join_frequent(large, least, "u", last.n).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u > v").distinct()
        edges = materialise(small, "sim-star")
        if (now := sign(edges)) == last:
            break
        last = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def classes(printed: DataFrame, parts: int | None = None, chunk: int = CHUNK, radius: int = RADIUS) -> DataFrame:
    """fp, n (rows), root (least fingerprint of its class), component_id (smallest id of the class), members (rows of the
    class), from rows of doc_id and fp."""
    nodes = materialise(printed.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "sim-nodes")
    distinct = nodes.count()
    roots = components(links(nodes.select("fp"), distinct, radius, parts, chunk))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.col("n").alias("own"), F.coalesce("root", "fp").alias("root"))
    rooted = materialise(rooted, "sim-roots")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("own").alias("members"), F.count(F.lit(1)).alias("n"))
    return materialise(join_frequent(rooted, ids, "root", distinct).select("fp", F.col("own").alias("n"), "root", "component_id", "members"), "sim-classes")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs, with all its columns, for each class: the one with the smallest id; of several rows with that id
    the one with the smallest hash of its columns, equal rows being the same. A class without ids keeps one row.

    docs is written once more with its fingerprints; no text is shuffled, only the numbers of the rows that go. Null,
    empty and blank texts are one class; an empty table gives an empty result; columns may have any names.
    """

    def fn(texts: pa.Array) -> list:
        return [np.array([fingerprint(t) for t in texts.to_pylist()], np.uint64).view(np.int64)]

    inner = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at_id, at_text = (F.col(f"c{docs.columns.index(c)}") for c in (id_col, text_col))
    hashable = [f.name for f in inner.schema if "map<" not in f.dataType.simpleString()]
    keyed = inner.select(at_text.alias("text"), F.struct(*inner.columns).alias("row"), at_id.alias("doc_id"), F.xxhash64(*hashable).alias("hash"))
    rows = numbered(appended(keyed, "text", [("fp", "long", pa.int64())], fn, keep=False), "sim-docs")
    of = classes(rows.select("doc_id", "fp"))
    small = rows.select("n", "doc_id", "fp", "hash").withColumnRenamed("n", "row_n")
    more = of.where("members > 1").select("fp", "n", "root")
    members = materialise(join_frequent(small, more, "fp", rows.count()).select("row_n", "doc_id", "hash", "root"), "sim-members")
    best = members.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash", "row_n")).alias("best"))
    gone = members.join(best.select(F.col("best.row_n").alias("row_n")), "row_n", "left_anti")
    kept = told(rows, gone.select(F.col("row_n").alias("n"), F.lit(0).alias("value")), "gone").where(F.col("gone").isNull())
    return kept.select(*[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(docs.columns)])


def near_dups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """doc_id, fp (signed), fingerprint (16 hex digits), root (the class's least fingerprint), component_id.

    component_id is the smallest doc_id of the class, null if no member has one. Null, empty and blank texts have
    fingerprint 0 and are linked like any other; repeated rows are members of their own; an empty table gives an empty
    result. Whole texts count, however long. Other columns of docs are ignored.
    """
    rows = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    printed = materialise(arrow_map(rows, run, f"doc_id {id_type}, fp long"), "sim-prints")
    joined = join_frequent(printed, classes(printed, parts, chunk), "fp", printed.count())
    return joined.select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "root", "component_id")
