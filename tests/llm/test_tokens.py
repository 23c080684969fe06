"""Tokenizer operators against the library itself."""

import hashlib
import random
import unicodedata

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from emberline.llm import bpe, tokens
from emberline.llm.words import Splitter

from .texts import ROWS, frame

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", "don't I'LL we'VE it’s 'S", "İ ΑΣΣ ς", "e\u0301 Å Ω ﬁ ŉ", "½²③ ٣٤ 0123", "a\u200bb c\x1c\x1d\x85\xa0d", "<|startoftext|>X<|endoftext|><|endoftext", "한국어 ㄱ क्षि ก็",
    "Yaran Ɓangaren yau ƊAKI KƐ aƁb", "rİ\u0336d", "İ\u031f4", "\U0001f469\u200d\U0001f4bb \x00\x7f", "a" * 700, "ab" * 400 + "!?" * 300, "ǅ ẞ K ᾳ", "—–“”€", "\n\n\t ", "É È é",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(PATH)


def test_encoder_equals_library(library, encoder):
    rng = random.Random(8)
    vocab = [t.replace("</w>", "") for t in encoder.vocab]
    made = ["".join(rng.choice(vocab) for _ in range(rng.randint(1, 5))) for _ in range(1500)]
    made += ["".join(rng.choice("abcdefgháéß'’019 .,-\n") for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    for text in [*ODD, *made]:
        assert encoder.ids(text) == library.encode(text, add_special_tokens=False).ids, repr(text)[:80]


def same_as_library(library, encoder, texts):
    lengths = tokens.Lengths(encoder.splitter, ("", b""))
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert encoder.ids(text) == want.ids, ascii(text)
        assert sum(map(lengths.__getitem__, encoder.splitter.pieces(text))) == len(want.ids), ascii(text)


def test_every_code_point(library, encoder):
    """Alone and inside words of both cases; surrogates are no characters."""
    chars = [chr(c) for c in range(0x11000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(chars), 4096):
        same_as_library(library, encoder, [t for c in chars[at : at + 4096] for t in (c, f"a{c}b", f"A{c}B")])


def test_random_letters_and_marks(library, encoder):
    rng = random.Random(3)
    pool = [chr(c) for c in range(0x2100) if unicodedata.category(chr(c))[0] in "LMN"]
    near = [chr(c) for c in [*range(0x20, 0x250), *range(0x300, 0x370), *range(0x2010, 0x2030)]]
    same_as_library(library, encoder, ["".join(rng.choice(p) for _ in range(rng.randint(1, 12))) for p in (pool, near) for _ in range(10_000)])


def test_every_vocabulary_entry(library, encoder):
    texts = [t.replace("</w>", "") for t in list(encoder.vocab)[::7]]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert encoder.ids(text) == want.ids, text


def test_pieces_cover_the_text(library):
    splitter = Splitter(PATH)
    for text in ODD:
        # pieces are normalised: the library's encode would do it again and put marks in another order
        count = sum(1 if isinstance(p, int) else splitter.tokens_of(p) for p in splitter.pieces(text))
        assert count == len(library.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("rows", [ROWS, [(i, t, None, None, None) for i, t in enumerate(ODD)], []])
def test_columns(spark, library, rows):
    want = {}
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[i, t] = len((t or "").encode()), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
    df = frame(spark, rows, ("ids", "n_tokens"))
    counted = tokens.count_tokens(df, PATH, limit=100).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in counted) == sorted((str(i), w[0], w[1], w[1] > 100) for i, t, *_ in rows for w in [want[i, t]])
    digests = bpe.digests(df, PATH).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests) == sorted((str(i), *want[i, t][1:]) for i, t, *_ in rows)
    assert bpe.encode(df, PATH).columns == [*[c for c in df.columns if c != "ids"], "ids"]


def test_decode_null_ids(spark):
    df = spark.createDataFrame([(1, [49407, 568]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(df, PATH).collect()} == {1: "<|endoftext|> 's</w>", 2: "", 3: ""}


def test_table_is_only_a_shortcut(spark):
    df = frame(spark)
    splitter = Splitter(PATH)
    with_table = tokens.Lengths(splitter, tokens.frequent(df, "text", PATH, entries=5))
    without = tokens.Lengths(splitter, ("", b""))
    for _, t, *_ in ROWS:
        assert sum(with_table[p] for p in splitter.pieces(t)) == sum(without[p] for p in splitter.pieces(t))
