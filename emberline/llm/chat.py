"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string. The formatter knows nothing about it: it
renders every successive prefix of a conversation, however long, and compares consecutive outputs. What a longer prefix
adds is the added turn's span. Where a longer prefix changes what was there before, at whatever turn, the template rewrites
history; spans can't be had that way, and the conversation is marked as rewritten.

The texts within the spans are found by two more renderings of the whole conversation, each text between two markers
that differ between the two: where the outputs differ, texts begin and end. A template for which that doesn't add up
(one that hides or changes a text) is asked turn by turn, with other markers in that turn alone.

A conversation of n turns costs n + 3 renderings, none of which is kept but the last two.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import arrow_map, n_parts

Turn = tuple[str, str]
Template = Callable[[Sequence[Turn]], str]

#: Marks of the house template, and the character that breaks a mark.
OPEN, CLOSE, ESCAPE = "<s>", "</s>", "\\"
#: Put around texts to find them in the output.
MARKERS = ("A", "B")
#: What is followed by ESCAPE in a text or role: ESCAPE itself and whatever a mark or control string could begin with.
#: So "</s>" becomes "<\\/s>" and "[INST]" becomes "[\\INST]": no control string is left for a tokenizer to find.
CONTROL = re.compile(r"[\\<\[\]]")


@lru_cache(256)  # successive prefixes escape the same texts
def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0] + ESCAPE, text)


def unescape(text: str) -> str:
    return re.sub(r"([\\<\[\]])\\", r"\1", text)


def house_template(turns: Sequence[Turn]) -> str:
    """<s>[role] text</s> and a newline for each turn, with role and text escaped."""
    return "".join([f"{OPEN}[{escape(r)}] {escape(t)}{CLOSE}\n" for r, t in turns])


_BODY = r"((?:[^\\<\[\]]++|[\\<\[\]]\\)*+)"
_TURN = re.compile(rf"<s>\[{_BODY}\] {_BODY}</s>\n")


def parse_house(formatted: str) -> list[Turn]:
    """The turns back from a string of the house template; raises ValueError if it isn't one."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


@dataclass
class Rendered:
    text: str
    #: Of each turn, where its span begins and ends, and where its text does. Empty if history was rewritten.
    spans: list[tuple[int, int, int, int]]
    rewritten: bool


def shared_ends(a: str, b: str) -> tuple[int, int]:
    """Lengths of the longest common prefix and, of what is left, suffix."""
    n, lo, hi = min(len(a), len(b)), 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    head, lo, hi = lo, 0, n - lo
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[len(a) - mid :] == b[len(b) - mid :] else (lo, mid - 1)
    return head, lo


def render(turns: Sequence[Turn], template: Template) -> Rendered:
    """Renders every prefix, locates each turn's span and text, and detects a template that rewrites history."""
    before, ends = template(turns[:0]), []
    for k in range(len(turns)):
        now = template(turns[: k + 1])
        if not now.startswith(before):
            return Rendered(template(turns), [], True)
        ends.append(len(now))
        before = now
    spans = list(zip([0, *ends[:-1]], ends))
    texts = texts_within(turns, before, spans, template)
    if texts is None:
        texts = [text_within(turns[:k], *turns[k], before[: ends[k]], template) for k in range(len(turns))]
    return Rendered(before, [(*s, *t) for s, t in zip(spans, texts)], False)


def texts_within(turns: Sequence[Turn], full: str, spans: list[tuple[int, int]], template: Template) -> list[tuple[int, int]] | None:
    """Where each turn's text begins and ends in full, from two renderings with markers around every text; None if the
    markers don't come back as two in each span with nothing else changed."""
    one, other = (template([(r, m + t + m) for r, t in turns]) for m in MARKERS)
    if len(one) != len(other) or len(one) != len(full) + 2 * len(turns):
        return None
    a, b = (np.frombuffer(x.encode("utf-32-le", "surrogatepass"), "<u4") for x in (one, other))
    at = np.nonzero(a != b)[0]
    if len(at) != 2 * len(turns) or any((x[at] != ord(m)).any() for x, m in zip((a, b), MARKERS)):
        return None
    if not np.array_equal(np.delete(a, at), np.frombuffer(full.encode("utf-32-le", "surrogatepass"), "<u4")):
        return None
    places = (at - np.arange(len(at))).reshape(-1, 2).tolist()  # without the markers before
    if any(not begin <= x <= y <= end for (begin, end), (x, y) in zip(spans, places)):
        return None
    return [(x, y) for x, y in places]


def text_within(history: Sequence[Turn], role: str, text: str, now: str, template: Template) -> tuple[int, int]:
    """Where the last turn's text begins and ends in now: the frame is what a rendering with the text between two
    plain markers, and one with other markers, have in common around them."""
    other = [template([*history, (role, m + text + m)]) for m in MARKERS]
    head, _ = shared_ends(*other)
    tail, _ = shared_ends(other[0][::-1], other[1][::-1])
    return head, len(now) - tail


def loss_text(r: Rendered, turns: Sequence[Turn], role: str = "assistant") -> list[str]:
    """The pieces of the rendered text under the loss mask: the texts of the role's turns."""
    return [r.text[a:b] for (_, _, a, b), (who, _) in zip(r.spans, turns) if who == role]


def conversations_of(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[Turn]]]:
    """(conversation, turns) from rows that are sorted by conversation; one conversation is in memory at a time."""
    now, turns, begun = None, [], False
    for b in rows:
        for c, role, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            if begun and c != now:
                yield now, turns
                turns = []
            now, begun = c, True
            turns.append((role or "", text or ""))
    if begun:
        yield now, turns


def format_chats(rows: DataFrame, template: Template = house_template, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row for each conversation: conv_id, formatted, spans (array of begin, end, text_begin, text_end in code
    points, and role), rewritten.

    Turns are in order of their number, ties by role and text, so reruns agree; repeated rows are turns of their own.
    A null role or text is empty, a null number comes first, null conversations are one conversation. An empty table
    gives an empty result; other columns are ignored. Conversations are sorted within partitions, never collected
    as one group.
    """
    own = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = own.schema["conv_id"].dataType.simpleString()
    dealt = own.repartition(n_parts(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    span = pa.struct([(n, pa.int64()) for n in ("begin", "end", "text_begin", "text_end")] + [("role", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        ids, texts, spans, flags = [], [], [], []
        type_: pa.DataType | None = None

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal type_
            for b in batches:
                type_ = b.schema.field(0).type
                yield b

        def out() -> pa.RecordBatch:
            arrays = [pa.array(ids, type_), pa.array(texts, pa.string()), pa.array(spans, pa.list_(span)), pa.array(flags, pa.bool_())]
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "formatted", "spans", "rewritten"])

        for conv, turns in conversations_of(typed()):
            r = render(turns, template)
            ids.append(conv)
            texts.append(r.text)
            spans.append([dict(zip(("begin", "end", "text_begin", "text_end"), s)) | {"role": who} for s, (who, _) in zip(r.spans, turns)])
            flags.append(r.rewritten)
            if len(ids) >= 256:
                yield out()
                ids, texts, spans, flags = [], [], [], []
        if ids:
            yield out()

    schema = f"conv_id {id_type}, formatted string, spans array<struct<begin:long,end:long,text_begin:long,text_end:long,role:string>>, rewritten boolean"
    return arrow_map(dealt, run, schema)


def digests(chats: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Read back from the formatted strings of the house template and their spans: conv_id, n_turns, turns_sha256 (role,
    newline, text, newline for each turn), loss_chars, loss_sha256, formatted_chars, rewritten.

    A rewritten conversation has no spans, so its loss_chars and loss_sha256 are null; a string that isn't of the house
    template raises ValueError; an empty table gives an empty result; other columns are ignored.
    """
    id_type = chats.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewritten"]

    def row(formatted: str, spans: list[dict], rewritten: bool) -> tuple:
        turns = parse_house(formatted)
        every = hashlib.sha256("".join([f"{r}\n{t}\n" for r, t in turns]).encode()).hexdigest()
        if rewritten:
            return len(turns), every, None, None, len(formatted), True
        loss = "".join([unescape(formatted[s["text_begin"] : s["text_end"]]) for s in spans if s["role"] == loss_role])
        return len(turns), every, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted), False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        for b in batches:
            rows = [row(*r) for r in zip(*[b.column(i).to_pylist() for i in (1, 2, 3)])]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]], names=names)

    schema = f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewritten boolean"
    return arrow_map(chats.select("conv_id", "formatted", "spans", "rewritten"), run, schema)
