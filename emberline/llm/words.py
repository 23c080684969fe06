"""Pre-tokens of a word-level BPE tokenizer file, split as its library splits them.

The file's normaliser (NFC, white space, lower case) and its pre-tokenizer (contractions, runs of letters, single
digits, runs of other marks) are applied in two ways. Texts of characters for which Python's tables are known to agree
go through one compiled pattern; any other text goes through the library's own normaliser and pre-tokenizer. Special
strings inside a text are cut out first, as the library does by default.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache
from itertools import islice

from tokenizers import Tokenizer

#: Characters whose normal form, lower case and class agree everywhere: Latin, dashes and quotes, currency, Han.
PLAIN = r"\x00-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf\u4e00-\u9fa5"
_OTHER = re.compile(f"[^{PLAIN}]")
#: White space as Unicode has it (its property White_Space).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def char_class(kind: str) -> str:
    """The plain characters of a major Unicode category, as ranges of a regular expression's class."""
    plain, out, run = re.compile(f"[{PLAIN}]"), [], None
    for code in [*range(0x10000), -1]:
        c = chr(code) if code >= 0 else ""
        if c and unicodedata.category(c)[0] == kind and plain.match(c):
            run = (run[0], code) if run and run[1] == code - 1 else (out.append(run) if run else None, (code, code))[1]
    out.append(run)
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in out if a is not None)


@lru_cache(1)
def pattern() -> re.Pattern:
    letters, digits = char_class("L"), char_class("N")
    return re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{letters}]+|[{digits}]|[^{SPACE}{letters}{digits}]+")


@lru_cache(1)
def byte_chars() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, hidden = {b: chr(b) for b in shown}, 0
    for b in range(256):
        if b not in table:
            table[b], hidden = chr(0x100 + hidden), hidden + 1
    return [table[b] for b in range(256)]


def spec_of(path: str) -> dict:
    """What the file says."""
    with open(path, encoding="utf-8") as f:
        return json.load(f)


class Splitter:
    """Cuts texts into pre-tokens (str) and special tokens (int ids)."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = {t["content"]: t["id"] for t in spec_of(path)["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.find = pattern().findall
        self.library, self.to_chars = self.tokenizer.model, byte_chars()
        self.from_bytes = {c: b for b, c in enumerate(self.to_chars)}

    def pieces(self, text: str | None) -> list:
        """The text's pre-tokens in order; a special string's id stands for it."""
        if not text:
            return []
        if self.cut is None or not any(s in text for s in self.special):
            return self.plain(text)
        out: list = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += self.plain(part)
        return out

    def plain(self, text: str) -> list[str]:
        low = text.lower()
        # lower case may lead out of the plain characters (U+0130, U+0181), so it is looked at too
        if text.isascii() or not (_OTHER.search(text) or _OTHER.search(low)) and unicodedata.is_normalized("NFC", text):
            return self.find(low)
        return self.by_library(text)

    def tokens_of(self, piece: str) -> int:
        """How many tokens the library's model makes of a pre-token. It is normalised already, and doing that twice may
        put its marks in another order."""
        chars = self.to_chars
        return len(self.library.tokenize("".join([chars[b] for b in piece.encode("utf-8", "surrogatepass")])))

    def by_library(self, text: str) -> list[str]:
        found = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))
        back = self.from_bytes
        return [bytes(back[c] for c in s).decode("utf-8", "surrogatepass") for s, _ in found]


def bounded(cache: dict, most: int) -> None:
    """Of a worker's cache that has grown beyond most entries the older half stays: what came first comes often. What
    goes is worked out again when it is met."""
    if len(cache) > most:
        for k in list(islice(cache, most // 2, None)):
            del cache[k]
