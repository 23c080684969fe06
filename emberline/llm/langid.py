"""Language identification by a linear-chain conditional random field over words.

States are the languages. A word's features are its character n-grams with marks at both ends (so those that touch a
mark are its affixes) and its entry in a lexicon of training words. Learned transitions tie neighbouring words; forward
and backward passes give each word's distribution over the languages, also in texts that switch between them. A text's
language is the one with the greatest sum over its distinct words (each with its mean, so that what a text repeats
counts once), its score the mean over the distinct words.

The model is fitted on the driver on a bounded sample of labelled rows; spliced chains of several languages are added,
so that the transitions learn that a text may switch. Passages of SHINGLE words that the sample has under more than one
language (boilerplate) tell nothing and are left out of the fit.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .shared import appended, arrow_map, quoted, resident

#: The bound of the training sample: labelled rows of each language, characters of a row, chains taken from a row.
ROWS, CHARS, CHAINS = 150, 200_000, 16
#: Words that show that a passage is shared between languages.
SHINGLE = 3
#: Bytes of texts whose words a worker holds together (one text at least).
AT_ONCE = 2 << 20
#: Segments of texts that are worked on together (a text's always are), and new words.
TOGETHER, AT_A_TIME = 2048, 5_000
#: Words of a chain of the fit and of a segment of a text, hashed n-gram features, lengths of n-grams, steps of the fit,
#: words in a worker's cache.
CHAIN, BUCKETS, GRAMS, STEPS, CACHE = 64, 1 << 17, (1, 2, 3, 4), 25, 150_000
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    """Runs of letters and marks of number other than digits, in lower case; a run without a letter (a fraction) is no word."""
    if not text:
        return []
    found = WORD.findall(text.lower())
    return found if text.isascii() else [w for w in found if w.isalpha() or any(map(str.isalpha, w))]


def grams(own: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of words with end marks, as one flat array, and where each word's begin."""
    flat = np.frombuffer(("\x02" + "\x03\x02".join(own) + "\x03").encode("utf-32-le"), "<u4").astype(np.uint64)
    begins = np.nonzero(flat == 2)[0]
    size = np.diff(np.append(begins, len(flat)))
    word = np.repeat(np.arange(len(own)), size)
    end = (begins + size)[word]
    at = np.arange(len(flat))
    h, hashes, owners = np.zeros(len(flat), np.uint64), [], []
    for n in range(1, max(GRAMS) + 1):
        h = (h[: len(flat) - n + 1] * np.uint64(0x100000001B3) + flat[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
        if n in GRAMS:
            ok = at[: len(h)] + n <= end[: len(h)]
            hashes.append((h[ok] ^ (h[ok] >> np.uint64(29))) >> np.uint64(7) & np.uint64(BUCKETS - 1))
            owners.append(word[: len(h)][ok])
    order = np.argsort(np.concatenate(owners), kind="stable")
    return np.concatenate(hashes)[order].astype(np.int64), np.searchsorted(np.concatenate(owners)[order], np.arange(len(own)))


@dataclass(eq=False)
class Model:
    labels: list[str]
    grams: np.ndarray  # BUCKETS x labels
    lexicon: dict[str, int]
    words: np.ndarray  # lexicon's entries x labels, the last for words outside it
    moves: np.ndarray  # labels x labels
    start: np.ndarray

    def emissions(self, own: Sequence[str]) -> np.ndarray:
        g, begins = grams(own)
        known = np.fromiter((self.lexicon.get(w, len(self.lexicon)) for w in own), np.int64, len(own))
        return np.add.reduceat(self.grams[g], begins, axis=0) + self.words[known]


def segments(lengths: np.ndarray, size: int = CHAIN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts of the given lengths cut in segments: first position of each segment, its length, its text, its number there."""
    count = -(-lengths // size)
    text = np.repeat(np.arange(len(lengths)), count)
    step = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    first = (np.cumsum(lengths) - lengths)[text] + step * size
    return first, np.minimum(size, lengths[text] - step * size), text, step


def messages(e: np.ndarray, n: np.ndarray, text: np.ndarray, step: np.ndarray, moves: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What reaches each segment of a text from the segments before it (weights of the states before its first word is
    seen) and from those after it (of the states of its last word). e and n as of forward_backward, all texts' segments in
    order.

    A segment's words together move a distribution linearly: its matrix is the product of its words'. The matrices of all
    segments are made side by side; only the few products from segment to segment go one by one along a text.
    """
    e = np.exp((e - e.max(axis=2, keepdims=True)).astype(np.float64))
    a, k = np.exp(moves.astype(np.float64)), e.shape[2]
    through = e[:, 0, :, None] * np.eye(k)  # from the state of the first word to that of the last
    for t in range(1, e.shape[1]):
        on = n > t
        now = (through[on] @ a) * e[on, t, None, :]
        through[on] = now / now.max(axis=(1, 2), keepdims=True)
    into, out_of = np.empty((len(e), k)), np.ones((len(e), k))
    first, last = np.nonzero(step == 0)[0], np.nonzero(np.append(step[1:], 0) == 0)[0]
    into[first] = np.exp(start.astype(np.float64))
    longest = int(step.max(initial=0))
    order = np.argsort(step, kind="stable")
    by_step = np.split(order, np.searchsorted(step[order], np.arange(1, longest + 1)))
    for of in by_step[1:]:
        now = np.einsum("ni,nij->nj", into[of - 1], through[of - 1]) @ a
        into[of] = now / now.sum(axis=1, keepdims=True)
    left = np.zeros(len(e), np.int64)  # segments of the text after each
    left[:] = step[last][np.searchsorted(last, np.arange(len(e)))] - step
    order = np.argsort(left, kind="stable")
    by_left = np.split(order, np.searchsorted(left[order], np.arange(1, longest + 1)))
    for of in by_left[1:]:
        now = np.einsum("nij,nj->ni", through[of + 1], out_of[of + 1]) @ a.T
        out_of[of] = now / now.sum(axis=1, keepdims=True)
    return into, out_of


def forward_backward(e: np.ndarray, n: np.ndarray, moves: np.ndarray, start: np.ndarray, pairs: bool = False, into: np.ndarray | None = None, out_of: np.ndarray | None = None):
    """Marginals of chains: e is chains x steps x labels (logs), n the chains' lengths. With pairs also the expected
    number of each move, over all chains. Chains that are segments of texts begin and end with the messages into and out of
    them instead of with the start weights and with no preference."""
    e = np.exp(e - e.max(axis=2, keepdims=True))
    a, size = np.exp(moves), e.shape[1]
    alpha, beta = np.empty_like(e), np.ones_like(e)
    if out_of is not None:
        beta[:, -1] = out_of
    now = e[:, 0] * (np.exp(start) if into is None else into)
    alpha[:, 0] = now / now.sum(axis=1, keepdims=True)
    for t in range(1, size):
        now = (alpha[:, t - 1] @ a) * e[:, t]
        alpha[:, t] = np.where((t < n)[:, None], now / now.sum(axis=1, keepdims=True), alpha[:, t - 1])
    for t in range(size - 2, -1, -1):
        now = (e[:, t + 1] * beta[:, t + 1]) @ a.T
        beta[:, t] = np.where((t + 1 < n)[:, None], now / now.sum(axis=1, keepdims=True), beta[:, t + 1])
    both = alpha * beta
    both /= both.sum(axis=2, keepdims=True)
    if not pairs:
        return both
    left, right = alpha[:, :-1], e[:, 1:] * beta[:, 1:]
    joint = np.einsum("nti,ij,ntj->nt", left, a, right)
    inside = (np.arange(1, size)[None, :] < n[:, None]) / np.maximum(joint, 1e-30)
    return both, a * np.einsum("nti,ntj->ij", left * inside[:, :, None], right)


def fit(texts: Sequence[str], labels: Sequence[str], steps: int = STEPS, seed: int = 6, rate: float = 0.4, weak: float = 1e-4) -> Model:
    """The model from labelled texts, by full-batch steps of AdaGrad on the chains' conditional likelihood."""
    names, rng = sorted(set(labels)), np.random.default_rng(seed)
    pool: dict[str, list[list[str]]] = {x: [] for x in names}
    for own, x in zip(own_words([words(t) for t in texts], labels), labels):
        cut = [own[i : i + CHAIN] for i in range(0, len(own), CHAIN)]
        pool[x] += [cut[i] for i in (rng.permutation(len(cut))[:CHAINS] if len(cut) > CHAINS else range(len(cut)))]
    data = [(c, [names.index(x)] * len(c)) for x in names for c in pool[x]]
    filled = [x for x in names if pool[x]]
    for _ in range(len(data) // 3 if len(filled) > 1 else 0):  # chains that switch, of parts of other chains
        own, tags = [], []
        while len(own) < CHAIN:
            x = filled[rng.integers(len(filled))]
            part = pool[x][rng.integers(len(pool[x]))]
            at = int(rng.integers(len(part)))
            part = part[at : at + int(rng.integers(4, 25))]
            own, tags = own + part, tags + [names.index(x)] * len(part)
        data.append((own[:CHAIN], tags[:CHAIN]))
    k = len(names)
    counts = Counter(w for c, _ in data for w in c)
    lexicon = {w: i for i, (w, c) in enumerate(sorted(counts.items())) if c >= 3}
    lexicon = {w: i for i, w in enumerate(lexicon)}
    model = Model(names, np.zeros((BUCKETS, k), np.float32), lexicon, np.zeros((len(lexicon) + 1, k), np.float32), np.zeros((k, k), np.float32), np.zeros(k, np.float32))
    if not counts or k < 2:
        return model
    vocab = {w: i for i, w in enumerate(sorted(counts))}
    g, begins = grams(list(vocab))
    owner = np.repeat(np.arange(len(vocab)), np.diff(np.append(begins, len(g))))
    known = np.array([lexicon.get(w, len(lexicon)) for w in vocab])
    n = np.array([len(c) for c, _ in data])
    word, gold = np.zeros((len(data), CHAIN), np.int64), np.zeros((len(data), CHAIN), np.int64)
    for i, (c, tags) in enumerate(data):
        word[i, : len(c)], gold[i, : len(c)] = [vocab[w] for w in c], tags
    inside = np.arange(CHAIN)[None, :] < n[:, None]
    pair = inside[:, 1:]
    seen = np.zeros((k, k))
    np.add.at(seen, (gold[:, :-1][pair], gold[:, 1:][pair]), 1)
    params = [model.grams, model.words, model.moves, model.start]
    squares = [np.full(p.shape, 1e-6, np.float32) for p in params]
    hot = np.eye(k, dtype=np.float32)[gold]
    total = float(n.sum())
    for _ in range(steps):
        e_word = np.add.reduceat(model.grams[g], begins, axis=0) + model.words[known]
        post, moved = forward_backward(e_word[word], n, model.moves, model.start, pairs=True)
        diff = (hot - post)[inside]
        d_word = np.stack([np.bincount(word[inside], diff[:, j], len(vocab)) for j in range(k)], axis=1)
        d_lex = np.stack([np.bincount(known, d_word[:, j], len(lexicon) + 1) for j in range(k)], axis=1)
        d_grams = np.stack([np.bincount(g, d_word[owner, j], BUCKETS) for j in range(k)], axis=1)
        for p, q, d in zip(params, squares, (d_grams, d_lex, seen - moved, (hot - post)[:, 0].sum(axis=0))):
            d = d / total - weak * p / len(p)
            q += d * d
            p += (rate * d / np.sqrt(q)).astype(np.float32)
    return model


def own_words(texts: list[list[str]], labels: Sequence[str]) -> list[list[str]]:
    """The texts without the words of passages that are seen under more than one label."""
    first: dict[tuple, str] = {}
    shared = set()
    for own, x in zip(texts, labels):
        for g in zip(*[own[i:] for i in range(SHINGLE)]):
            if first.setdefault(g, x) != x:
                shared.add(g)
    out = []
    for own in texts:
        drop = {i + j for i, g in enumerate(zip(*[own[k:] for k in range(SHINGLE)])) if g in shared for j in range(SHINGLE)}
        out.append([w for i, w in enumerate(own) if i not in drop])
    return out


class Tagger:
    """Applies a model to batches of texts, with a bounded cache of words' emissions."""

    def __init__(self, model: Model):
        self.model, self.rows, self.table = model, {}, np.zeros((1024, max(1, len(model.labels))), np.float32)

    def ids(self, own: list[str]) -> np.ndarray:
        rows = self.rows
        fresh = [w for w in dict.fromkeys(own) if w not in rows]
        if len(rows) + len(fresh) > CACHE:
            rows.clear()
            fresh = list(dict.fromkeys(own))
        if fresh:
            at = len(rows)
            rows.update(zip(fresh, range(at, at + len(fresh))))
            while len(rows) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            for i in range(0, len(fresh), AT_A_TIME):
                self.table[at + i : at + min(i + AT_A_TIME, len(fresh))] = self.model.emissions(fresh[i : i + AT_A_TIME])
        return np.fromiter(map(rows.__getitem__, own), np.int64, len(own))

    def marginals(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The words' distributions, of all texts in a row, and the number of words of each text."""
        n = np.array([len(t) for t in texts], np.int64)
        flat = [w for t in texts for w in t]
        if not flat or not self.model.labels:
            return np.zeros((len(flat), len(self.model.labels))), n
        at = self.ids(flat)
        first, size, text, step = segments(n)
        out = np.empty((len(flat), len(self.model.labels)), np.float32)
        ends = np.append(np.nonzero(step == 0)[0][1:], len(first))  # where texts' segments end
        i = 0
        while i < len(first):  # whole texts, some thousands of segments at a time
            j = int(ends[np.searchsorted(ends, min(i + TOGETHER, len(first)))])
            f, s = first[i:j], size[i:j]
            spot = np.minimum(f[:, None] + np.arange(CHAIN), len(flat) - 1)
            e = self.table[at[spot]]
            into, out_of = messages(e, s, text[i:j], step[i:j], self.model.moves, self.model.start)
            post = forward_backward(e, s, self.model.moves, self.model.start, into=into, out_of=out_of)
            ok = np.arange(CHAIN)[None, :] < s[:, None]
            out[spot[ok]] = post[ok]
            i = j
        return out, n

    def languages(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        own, k = [words(t) for t in texts], len(self.model.labels)
        post, n = self.marginals(own)
        if not k:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        text = np.repeat(np.arange(len(texts)), n)
        at = np.fromiter((self.rows[w] for t in own for w in t), np.int64, len(text))
        kinds, kind = np.unique(text * len(self.table) + at, return_inverse=True)
        count = np.bincount(kind, minlength=len(kinds))
        of = kinds // len(self.table)
        distinct = np.maximum(1, np.bincount(of, minlength=len(texts)))
        mean = np.stack([np.bincount(of, np.bincount(kind, post[:, j], len(kinds)) / np.maximum(count, 1), len(texts)) / distinct for j in range(k)], axis=1)
        best = mean.argmax(axis=1)
        return [self.model.labels[j] if c else UNKNOWN for j, c in zip(best, n)], [float(min(1.0, max(0.0, m[j]))) if c else 0.0 for m, j, c in zip(mean, best, n)]


def tagger_of(model: Model) -> Tagger:
    """A worker's tagger of a broadcast model; it and its cache serve all tasks of the worker, until another model comes."""
    return resident(Tagger, model)


def held_out(id_col: Column) -> Column:
    """Rows that are not learned from: crc32 of the id as text, modulo 4, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = ROWS, chars: int = CHARS) -> Model:
    """Fits the model on about ``rows`` labelled rows of each language that are not held out, chosen by a hash of their
    id, of at most ``chars`` characters. Without such rows the model knows no language."""
    may = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r.lang: r.n for r in may.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return fit([], [])
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, rows / n))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1 << 20)) / (1 << 20)
    some = may.withColumn("draw", draw).where((F.col("draw") < F.element_at(share, F.col("lang"))) & (F.length("text") <= chars))
    # the least draws, so that the bound cuts the same rows whatever the order of files
    found = sorted((r.lang, r.text) for r in some.orderBy("draw", "doc_id", F.xxhash64("text")).limit(2 * rows * len(counts)).collect())
    return fit([t for _, t in found], [x for x, _ in found])


def identify(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """docs with its predicted language and score, from the text alone.

    ``und`` with score 0 if the text is null or has no letter; else one of the model's languages and the mean
    probability of its words, 0 to 1. Whole texts count. Repeated rows are predicted each; an empty table gives an empty
    result; columns named like the new ones are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def fn(texts: pa.Array) -> list:
        return list(tagger_of(shared.value).languages(texts.to_pylist()))

    return appended(docs, text_col, [(lang_col, "string", pa.string()), (score_col, "double", pa.float64())], fn, at_once=AT_ONCE)


def tag_words(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, words, langs, probs: each word of a text with its language and probability (code-switched text).

    Null and empty texts, and texts without a letter, have empty arrays; so have all texts if the model knows no language,
    but for their words. Whole texts are one chain, however long. Repeated rows are tagged each; an empty table gives an
    empty result; other columns of docs are ignored, whatever their names.
    """
    rows = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        tagger = tagger_of(shared.value)
        for b in batches:
            own = [words(t) for t in b.column(1).to_pylist()]
            post, n = tagger.marginals(own)
            ends = np.cumsum(n)
            langs, probs = [], []
            for stop, c in zip(ends, n):
                p = post[stop - c : stop]
                langs.append([tagger.model.labels[j] for j in p.argmax(axis=1)] if p.size else [])
                probs.append(p.max(axis=1).astype(float).tolist() if p.size else [])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own, pa.list_(pa.string())), pa.array(langs, pa.list_(pa.string())), pa.array(probs, pa.list_(pa.float64()))], names=["doc_id", "words", "langs", "probs"])

    return arrow_map(rows, run, f"doc_id {id_type}, words array<string>, langs array<string>, probs array<double>")
