"""BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a pre-token there is exactly one last token. It is a vocabulary entry that ends there (an automaton
with suffix links reports all of them in one pass), and it fits the last token of the prefix before it: the two, side
by side, would not be merged across their border. So each prefix stores its one last token, and following the
back-pointers from the end gives the ids. No merge is ever replayed on the text.

Whether two tokens fit is read from the merges alone: undoing both tokens from the newest merge back, a merge across the
border must never be older than what has been undone.
"""

from __future__ import annotations

from array import array
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .shared import appended, resident
from .words import Splitter, bounded, byte_chars, spec_of

#: Entries of a worker's caches of pre-tokens and of pairs, and the longest pre-token that is kept.
CACHE, PAIRS, CACHED_CHARS = 200_000, 200_000, 64
#: Bytes of texts that are encoded and decoded together (one text at least).
AT_ONCE = 4 << 20
#: Added to a character's code where it ends a word.
END = 0x1000


class Encoder(dict):
    """Token ids (tuples) by pre-token; a miss is encoded and kept."""

    def __init__(self, path: str):
        super().__init__()
        self.splitter = Splitter(path)
        model = spec_of(path)["model"]
        suffix = model.get("end_of_word_suffix") or ""
        self.vocab = vocab = model["vocab"]
        self.chars = byte_chars()
        ends = lambda t: bool(suffix) and t.endswith(suffix) and len(t) > len(suffix)
        marked = {t: t[: -len(suffix) - 1] + chr(ord(t[-len(suffix) - 1]) + END) if ends(t) else t for t in vocab}
        self.has_end = bool(suffix)
        self.parts: dict[int, tuple[int, int, int]] = {}  # token: rank of the merge that makes it, left, right
        self.rank: dict[tuple[int, int], int] = {}
        for r, (a, b) in enumerate(model["merges"]):
            ia, ib = vocab[a], vocab[b]
            made = vocab[(a[: -len(suffix)] if suffix and a.endswith(suffix) and len(a) > len(suffix) else a) + b]
            self.rank[ia, ib] = r
            self.parts.setdefault(made, (r, ia, ib))
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_STRING)
        self.length = {vocab[t]: len(m) for t, m in marked.items()}
        self.pairs: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        for t, m in marked.items():
            if self.reachable(i := vocab[t]):  # entries that the merges never make end no prefix
                self.automaton.add_word(m, (i, len(m)))
        self.automaton.make_automaton()
        self.whole.clear()

    def border(self, a: int, b: int) -> bool:
        """Whether a and b fit: no merge across their border comes before the merges that make them."""
        newest = len(self.rank)
        while True:
            across = self.rank.get((a, b))
            # at equal rank the left place merges first: newest is one higher where the right token was undone
            if across is not None and across < newest:
                return False
            ra, rb = self.parts.get(a, (-1,))[0], self.parts.get(b, (-1,))[0]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                newest, a = ra, self.parts[a][2]
            else:
                newest, b = rb + 1, self.parts[b][1]

    def reachable(self, t: int) -> bool:
        """Whether the merges make t from its characters: its two parts are made and fit until t's own merge."""
        known = self.whole.get(t)
        if known is None:
            made = self.parts.get(t)
            known = made is None and self.length[t] == 1
            if made is not None:
                r, a, b = made
                known = self.reachable(a) and self.reachable(b) and self.meets(a, b, r)
            self.whole[t] = known
        return known

    def meets(self, a: int, b: int, r: int) -> bool:
        """Below the merge (a, b) itself, of rank r, nothing merges across the border."""
        own = self.rank.pop((a, b))
        try:
            return r == own and self.border(a, b)
        finally:
            self.rank[a, b] = own

    def __missing__(self, piece) -> tuple[int, ...]:
        ids = (piece,) if isinstance(piece, int) else self.encode(piece)
        if isinstance(piece, int) or len(piece) <= CACHED_CHARS:
            self[piece] = ids
        return ids

    def encode(self, piece: str) -> tuple[int, ...]:
        """The piece's ids: for every prefix its one last token, then back from the end."""
        s = "".join([self.chars[b] for b in piece.encode("utf-8", "surrogatepass")])
        if self.has_end:
            s = s[:-1] + chr(ord(s[-1]) + END)
        n = len(s)
        last: list[int] = [-1] * (n + 1)
        known, border = self.pairs, self.border
        for at, (t, size) in self.automaton.iter(s):
            if last[at + 1] >= 0:
                continue
            start = at + 1 - size
            if start:
                before = last[start]
                if before < 0:
                    continue
                pair = before << 20 | t
                fits = known.get(pair)
                if fits is None:
                    fits = known[pair] = border(before, t)
                if not fits:
                    continue
            last[at + 1] = t
        out, at = [], n
        while at:
            out.append(last[at])
            at -= self.length[last[at]]
        return tuple(out[::-1])

    def ids(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, self.splitter.pieces(text))))


def encoder_of(path: str) -> Encoder:
    """A worker's encoder; it and its cache serve all tasks of the worker."""
    return resident(Encoder, path)


@lru_cache(1)
def tokens_of(path: str) -> pa.Array:
    """The tokens by id."""
    spec = spec_of(path)
    by_id = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return pa.array([by_id.get(i, "") for i in range(max(by_id) + 1)], pa.string())


def ids_of(texts: pa.Array, vocabulary: str) -> pa.ListArray:
    encoder = encoder_of(vocabulary)
    bounded(encoder, CACHE)
    bounded(encoder.pairs, PAIRS)
    of, pieces, flat, ends = encoder.__getitem__, encoder.splitter.pieces, array("i"), [0]
    for t in texts.to_pylist():
        flat.extend(chain.from_iterable(map(of, pieces(t))))
        ends.append(len(flat))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32)))


def texts_of(ids: pa.ListArray, vocabulary: str) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, tokens_of(vocabulary).take(ids.values)), " ")


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """docs with the column ``ids_col`` (array<int>): the text's token ids, as the library gives them without begin, end
    or padding tokens and without truncation; special strings inside a text are their special tokens.

    Null and empty texts have no tokens (an empty array); repeated rows are encoded each; an empty table gives an empty
    result; a column named ``ids_col`` is replaced. ``vocabulary`` is a path that each executor has.
    """
    return appended(docs, text_col, [(ids_col, "array<int>", pa.list_(pa.int32()))], lambda texts: [ids_of(texts, vocabulary)])


def decode(docs: DataFrame, vocabulary: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """docs with the column ``text_col``: the tokens of ``ids_col`` as the library's decode gives them, special tokens
    too. This vocabulary has no decoder, so tokens stay as they are, joined by spaces. Null ids give an empty text."""
    return appended(docs, ids_col, [(text_col, "string", pa.string())], lambda ids: [texts_of(ids, vocabulary)])


def round_trip(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """docs without its text, with ``ids`` as of encode and ``decoded`` as of decode, in one pass and one worker for each task."""

    def fn(texts: pa.Array) -> list:
        ids = ids_of(texts, vocabulary)
        return [ids, texts_of(ids, vocabulary)]

    return appended(docs, text_col, [("ids", "array<int>", pa.list_(pa.int32())), ("decoded", "string", pa.string())], fn, keep=False, at_once=AT_ONCE)


def digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of what encode and decode give."""
    both = round_trip(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), vocabulary)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
