"""Token counts by a map-side two-tier lookup; no pre-token is shuffled.

Tier 1: a compact table of frequent pre-tokens and their lengths in tokens, made on the driver from a bounded sample
of texts and broadcast (one blob of text, one byte for each length). Tier 2: what the table lacks is encoded by the
library in the worker and kept in a bounded cache of the worker. The sample decides which tier answers, never the
count, which is exact for every text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import arrow_map, resident, utf8
from .words import Splitter, bounded

#: Texts of the sample, the most characters of one, entries of the broadcast table, entries of a worker's cache.
SAMPLE_TEXTS, SAMPLE_CHARS, TABLE, CACHE = 2_000, 50_000, 50_000, 200_000


class Lengths(dict):
    """Tokens of each pre-token: the broadcast table, and a cache of misses."""

    def __init__(self, splitter: Splitter, table: tuple[str, bytes]):
        words, lengths = table
        super().__init__(zip(words.split("\n"), lengths) if lengths else ())
        self.splitter = splitter

    def __missing__(self, piece) -> int:
        n = 1 if isinstance(piece, int) else self.splitter.tokens_of(piece)
        if isinstance(piece, int) or len(piece) <= 64:
            self[piece] = n
        return n


def made(path: str, table: tuple[str, bytes]) -> Lengths:
    return Lengths(Splitter(path), table)


def lengths_of(path: str, table: tuple[str, bytes]) -> Lengths:
    """A worker's table and cache; they serve all tasks of the worker."""
    return resident(made, path, table)


def frequent(docs: DataFrame, text_col: str, vocabulary: str, entries: int = TABLE, texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> tuple[str, bytes]:
    """The broadcast table from a bounded sample: pre-tokens joined by newlines, and their lengths (255 at most)."""
    splitter, counts = Splitter(vocabulary), Counter()
    some = docs.select(F.col(text_col).alias("text")).where(F.length("text") <= chars).limit(texts)
    for (text,) in some.toLocalIterator():
        counts.update(p for p in splitter.pieces(text) if isinstance(p, str) and len(p) <= 64)
    words = [w for w, _ in counts.most_common(entries)]
    kept = [(w, n) for w, n in zip(words, map(splitter.tokens_of, words)) if n <= 255]
    return "\n".join(w for w, _ in kept), bytes(n for _, n in kept)


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit) for each row.

    Tokens are those that the library gives without begin, end or padding tokens and without truncation. Null counts
    as empty (0 bytes, 0 tokens); repeated rows are counted each; an empty table gives an empty result; other columns
    of docs are ignored. ``vocabulary`` is a path that each executor has.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent(docs, text_col, vocabulary))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        lengths = lengths_of(vocabulary, table.value)
        of, splitter = lengths.__getitem__, lengths.splitter
        for b in batches:
            texts = b.column(1).to_pylist()
            n = np.array([sum(map(of, splitter.pieces(t))) for t in texts], np.int64)
            size = np.array([len(utf8(t)) for t in texts], np.int64)
            bounded(lengths, 2 * TABLE + CACHE)  # the table came first, so it stays
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return arrow_map(rows, run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
