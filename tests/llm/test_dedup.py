"""Exact, near and line dedup against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from emberline.llm import exact, lines, simhash

from .texts import LONG, ROWS, copies, frame

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def plain_exact(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[SPACE.sub("", t or "")].append((i, t or ""))
    out = []
    for norm, own in groups.items():
        keep = min(own, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))[0]
        out += [(i, keep, len(own), i == keep, hashlib.sha256(norm.encode()).hexdigest()) for i, _ in own]
    return out


def key(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.mark.parametrize("rows", [ROWS, copies(400, 3), []])
def test_exact_dedup(spark, rows):
    got = exact.exact_dedup(frame(spark, rows, ("h", "norm", "keep_id")), parts=5)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain_exact(rows), key=key)


def test_exact_dedup_salts_frequent_texts(spark):
    work = frame(spark, copies(400, 3)).select(F.monotonically_increasing_id().alias("row"), F.xxhash64(exact.normalised(F.col("text"))).alias("h"))
    assert len(exact.frequent_texts(work, 8)) == 1
    plan = exact.exact_dedup(frame(spark, copies(50, 60)), parts=5)._jdf.queryExecution().toString()
    assert "rangepartitioning" in plan and "hashpartitioning" not in plan and "Python" not in plan


def plain_print(text):
    own = [w for w in SPACE.split("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    grams = [" ".join(own[i : i + 4]) for i in range(max(1, len(own) - 3))] if own else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def plain_components(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def expected_near(rows):
    prints = [plain_print(t) for _, t, *_ in rows]
    roots = plain_components(prints)
    least = {}
    for (i, *_), r in zip(rows, roots):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return [(i, f"{p:016x}", least[r]) for (i, *_), p, r in zip(rows, prints, roots)]


def near_rows():
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(base[:k] + [f"new{i}"] + base[k + 1 :]), "en", "s", 1) for i, k in enumerate(range(0, 300, 3))]
    return rows + [(200 + i, f"lonely text {i} of {i * 7} things and {i * 3} more", "en", "s", 1) for i in range(80)]


@pytest.mark.parametrize("rows", [ROWS, near_rows(), []])
def test_simhash(spark, rows):
    got = simhash.near_dups(frame(spark, rows, ("fp", "root")), parts=3).select("doc_id", "fingerprint", "component_id")
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected_near(rows), key=key)


def test_simhash_cuts_hot_groups(spark):
    rows = near_rows()
    got = simhash.near_dups(frame(spark, rows), parts=40, chunk=8).select("doc_id", "fingerprint", "component_id")
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected_near(rows), key=key)


@pytest.mark.parametrize("seed", range(4))
def test_gray_index_finds_every_class(seed):
    rng = np.random.default_rng(seed)
    centers = rng.integers(0, 2**63, 30, dtype=np.uint64)
    x = np.unique(np.concatenate([centers, *[centers ^ (np.uint64(1) << rng.integers(0, 64, 30).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 30).astype(np.uint64)) for _ in range(30)]]))
    a, b = simhash.link(simhash.GrayIndex(x), None, frontier=64)
    assert (np.bitwise_count(a ^ b) >= 1).all() and len(a) < len(x)
    at = {int(v): i for i, v in enumerate(x)}
    forest = simhash.Forest(len(x))
    forest.join(np.array([at[int(v)] for v in a]), np.array([at[int(v)] for v in b]))
    want = plain_components([int(v) for v in x])
    assert len({*zip(forest.flatten().tolist(), want)}) == len(set(want)) == len(set(forest.root.tolist()))
    half = len(x) // 2
    c, e = simhash.link(simhash.GrayIndex(x[:half]), simhash.GrayIndex(x[half:]))
    linked = simhash.Forest(len(x))
    for part in (x[:half], x[half:]):
        p, q = simhash.link(simhash.GrayIndex(part), None)
        linked.join(np.array([at[int(v)] for v in p], int), np.array([at[int(v)] for v in q], int))
    linked.join(np.array([at[int(v)] for v in c]), np.array([at[int(v)] for v in e]))
    assert len({*zip(linked.flatten().tolist(), want)}) == len(set(want))


def test_index_prunes_pairs_of_real_fingerprints(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    x = np.unique(np.array([simhash.fingerprint(t) for t in texts], np.uint64))
    seen = Counter()
    a, b = simhash.link(simhash.GrayIndex(x), None, seen=seen)
    pairs = len(x) * (len(x) - 1) // 2
    assert 0 < seen["far"] < seen["nodes"] < pairs and seen["compared"] < pairs // 10
    assert links_of(x, a, b) == links_of(x, *all_links(x))
    # the same by blocks, all groups of a block in one walk
    found = []
    for mask in simhash.block_masks():
        key_ = x & np.uint64(mask)
        order = np.argsort(key_, kind="stable")
        group = np.unique(key_[order], return_inverse=True)[1]
        found.append(simhash.link(simhash.GrayIndex(x[order], group), None, frontier=500))
    assert links_of(x, *[np.concatenate(c) for c in zip(*found)]) == links_of(x, a, b)


def all_links(x):
    i, j = np.nonzero(np.triu(np.bitwise_count(x[:, None] ^ x[None, :]) <= 4, 1))
    return x[i], x[j]


def links_of(x, a, b):
    """The classes that links make, as the least member of each fingerprint's."""
    forest, at = simhash.Forest(len(x)), {int(v): i for i, v in enumerate(x)}
    forest.join(np.array([at[int(v)] for v in a], int), np.array([at[int(v)] for v in b], int))
    return forest.flatten().tolist()


def test_blocks_miss_no_pair():
    rng = np.random.default_rng(1)
    assert sum(simhash.block_masks()) == 2**64 - 1
    for _ in range(2000):
        flipped = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(not flipped & mask for mask in simhash.block_masks())


def test_join_frequent_is_a_join(spark):
    rows = spark.range(60_000).selectExpr("id", "if(id % 3 = 0, 7, id) AS k")
    of = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.col("k") * 2)
    got = simhash.join_frequent(rows, of, "k", 60_000)
    assert got.agg(F.count(F.lit(1)), F.sum((F.col("v") == 2 * F.col("k")).cast("int"))).first() == (60_000, 60_000)


def test_one_of_each_takes_one_of_repeated_rows(spark):
    rows = [(1, "same words in both rows", "en", "a", 1), (1, "SAME words in both rows", "en", "b", 2), (1, "same words in both rows", "en", "c", 3)]
    got = {tuple(simhash.one_of_each(frame(spark, rows).repartition(k)).first()) for k in (1, 2)}
    assert len(got) == 1 and next(iter(got))[0] == 1


def test_no_text_is_shuffled_for_one_of_each(spark):
    df = simhash.one_of_each(frame(spark))
    df.collect()
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    moved = re.findall(r"(?ms)^\(\d+\) (?:Broadcast)?Exchange$.*?^Input \[\d+\]: \[(.*?)\]", df._jdf.queryExecution().explainString(mode))
    assert moved and not any("row#" in m or "text" in m for m in moved)


def test_one_of_each(spark):
    got = simhash.one_of_each(frame(spark, ROWS, ("fp", "__note")))
    want = {(i, c) for i, _, c in expected_near(ROWS)}
    assert got.columns == [*frame(spark).columns, "fp", "__note"]
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(map(str, {c for _, c in want}))


def plain_lines(rows, least=10):
    def key_of(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    far = float("inf")
    held = defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            held[key_of(line)].add(far if i is None else i)
    out = []
    for i, t, *_ in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if not (len(k := key_of(x)) >= least and len(held[k]) > 1 and min(held[k]) != (far if i is None else i))]
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("how", [{}, {"shard_keys": 1, "task_probes": 2}])
@pytest.mark.parametrize("rows", [ROWS, [(i, f"a common line of all\nline {i // 3} of three rows\n{'é' * 9}\n{'é' * 10}", "en", "s", 1) for i in range(60)], []])
def test_line_dedup(spark, rows, how):
    got = lines.dedup_lines(frame(spark, rows, ("row", "n_lines", "h1")), **how)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "h1", "n_lines", "n_dropped"]
    assert sorted([(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()], key=key) == sorted(plain_lines(rows), key=key)


def test_perfect_hash_is_minimal():
    h = lines.hashes([f"key {i}".encode() for i in range(5000)])
    slots = lines.PerfectHash(h).ready()(h)
    assert sorted(slots.tolist()) == list(range(5000))
    shard = lines.Shard(h, np.arange(5000), np.full(5000, 2))
    count, first = shard.probe(h)
    assert (first == np.arange(5000)).all() and (count == 2).all()
    count, first = shard.probe(lines.hashes([f"other {i}".encode() for i in range(5000)]))
    assert (first == lines.NO_ID).all() and not count.any()


def test_texts_of_line_dedup_stay_in_place(spark):
    rows = [(i, f"a common line of all\nline {i // 3} of three rows", "en", "s", 1) for i in range(60)]
    done = lines.dedup_lines(frame(spark, rows))
    done.collect()
    plan = done._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in plan.split("\n") if "Exchange" in x]
    assert moved and "Bucketed: true" in plan
    for node in re.findall(r"(?ms)^\(\d+\) (?:Broadcast)?Exchange$.*?^Input \[\d+\]: \[(.*?)\]", done._jdf.queryExecution().explainString(done.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))):
        assert "text#" not in node and "row#" not in node


def test_line_dedup_with_ids_of_text_and_columns_in_other_case(spark):
    rows = [(i, f"a common line of all\nline {i // 3} of three rows", "en", "s", 1) for i in range(12)] + [(None, "a common line of all", "en", "s", 1)]
    df = frame(spark, rows, ("N_Lines", "Kept"))
    want = lines.dedup_lines(df).collect()
    as_text = df.withColumn("doc_id", F.lpad(F.col("doc_id").cast("string"), 4, "0"))
    got = lines.dedup_lines(as_text).collect()
    assert got[0].asDict().keys() == want[0].asDict().keys() and "N_Lines" not in want[0].asDict()
    assert sorted((str(r.doc_id and int(r.doc_id)), r.text) for r in got) == sorted((str(r.doc_id or (None if r.doc_id is None else 0)), r.text) for r in want)


def test_long_text_counts_whole():
    assert simhash.fingerprint(LONG) == plain_print(LONG) != simhash.fingerprint(LONG[: len(LONG) // 2])


def test_links_are_not_kept_on_one_executor(spark):
    df = simhash.near_dups(frame(spark, ROWS))
    assert "LocalCheckpoint" not in df._jdf.queryExecution().toString() and df.agg(F.count(F.lit(1))).first()[0] == len(ROWS)
