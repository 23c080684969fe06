"""Telephony audio in columns: mu-law and A-law by lookup tables, IMA ADPCM across blocks, resampled PCM.

A media value is a WAVE file in a binary column. ``store`` puts any bytes into a column as such a file without loss: as
8-bit mu-law or A-law samples, or as the nibbles of IMA ADPCM blocks. ``to_pcm`` decodes the files of all formats and
stores them as linear PCM of one rate in another column; the ADPCM blocks of many files are decoded together.
``inspect`` reads both columns back.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import appended, arrow_map, quoted, utf8

#: WAVE format numbers.
PCM, ALAW, MULAW, IMA_ADPCM = 1, 6, 7, 17
RATE, OUT_RATE, PAD = 8000, 16000, 64
NAMES = {PCM: "pcm", ALAW: "alaw", MULAW: "mulaw", IMA_ADPCM: "ima-adpcm"}
#: Bytes of an ADPCM block: a header of HEADER bytes, and nibbles. Blocks decoded together, bytes of files at once.
HEADER, BLOCK, BLOCKS_AT_ONCE, BYTES_AT_ONCE = 4, 4 + PAD, 1 << 14, 4 << 20
#: Fixed values of the IMA ADPCM format: how an index moves by a nibble's magnitude.
MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)


@lru_cache(1)
def mulaw_table() -> np.ndarray:
    """Linear 16-bit value of each mu-law byte: inverted bits, sign, 3 bits of exponent, 4 of mantissa, bias 132."""
    b = ~np.arange(256, dtype=np.uint8)
    exponent, mantissa = (b >> 4 & 7).astype(np.int32), (b & 15).astype(np.int32)
    level = ((2 * mantissa + 33) << (exponent + 2)) - 132
    return np.where(b & 128, -level, level).astype(np.int16)


@lru_cache(1)
def alaw_table() -> np.ndarray:
    """Linear 16-bit value of each A-law byte: even bits inverted, positive where the sign bit is set."""
    b = np.arange(256, dtype=np.uint8) ^ 0x55
    exponent, mantissa = (b >> 4 & 7).astype(np.int32), (b & 15).astype(np.int32)
    level = np.where(exponent == 0, 16 * mantissa + 8, (16 * mantissa + 264) << np.maximum(exponent - 1, 0))
    return np.where(b & 128, level, -level).astype(np.int16)


@lru_cache(1)
def adpcm_steps() -> np.ndarray:
    """Fixed values of the IMA ADPCM format: the 89 step sizes."""
    return np.array(
        "7 8 9 10 11 12 13 14 16 17 19 21 23 25 28 31 34 37 41 45 50 55 60 66 73 80 88 97 107 118 130 143 157 173 190 209 230 253 279 307 "
        "337 371 408 449 494 544 598 658 724 796 876 963 1060 1166 1282 1411 1552 1707 1878 2066 2272 2499 2749 3024 3327 3660 4026 4428 "
        "4871 5358 5894 6484 7132 7845 8630 9493 10442 11487 12635 13899 15289 16818 18500 20350 22385 24623 27086 29794 32767".split(),
        np.int64,
    )


def decode_blocks(raw: np.ndarray) -> np.ndarray:
    """The samples of mono IMA ADPCM blocks (blocks x bytes), a row for each: a 4-byte header (first sample, step index)
    and nibbles, low one first. All blocks go forward together, one nibble of each at a time."""
    whole, block = raw.shape
    out = np.empty((whole, 1 + 2 * (block - HEADER)), np.int16)
    steps = adpcm_steps().astype(np.int32)
    for at in range(0, whole, BLOCKS_AT_ONCE):
        part, made = raw[at : at + BLOCKS_AT_ONCE], out[at : at + BLOCKS_AT_ONCE]
        value = part[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
        index = np.minimum(part[:, 2], 88).astype(np.int32)
        made[:, 0] = value
        for k in range(2 * (block - HEADER)):
            byte = part[:, HEADER + k // 2]
            nibble = (byte >> 4 if k % 2 else byte & 15).astype(np.int32)
            step = steps[index]
            diff = (step >> 3) + (step >> 2) * (nibble & 1) + (step >> 1) * (nibble >> 1 & 1) + step * (nibble >> 2 & 1)
            value = np.clip(value + diff * (1 - (nibble >> 3) * 2), -32768, 32767)
            index = np.clip(index + MOVES[nibble & 7], 0, 88)
            made[:, 1 + k] = value
    return out


def blocks_of(data: bytes, block: int) -> np.ndarray:
    """The blocks of a file's data; a last short one is filled up."""
    whole = -(-len(data) // block)
    return np.frombuffer(data + bytes(whole * block - len(data)), np.uint8).reshape(whole, block)


def kept_samples(size: int, block: int, samples: int | None) -> int:
    """How many of the samples of ``size`` bytes of blocks count: what a last short block lacks is cut."""
    whole = -(-size // block)
    most = whole * (1 + 2 * (block - HEADER))
    return max(0, most - 2 * (whole * block - size)) if samples is None else min(samples, most)


def decode_adpcm(data: bytes, block: int, samples: int | None = None) -> np.ndarray:
    """The samples of one file's mono IMA ADPCM blocks."""
    return decode_blocks(blocks_of(data, block)).reshape(-1)[: kept_samples(len(data), block, samples)]


def encode_adpcm(pcm: np.ndarray, block: int = 256) -> bytes:
    """Mono IMA ADPCM blocks of 16-bit samples; the last block is filled up with its last sample."""
    per = 1 + 2 * (block - 4)
    whole = -(-len(pcm) // per)
    if not whole:
        return b""
    x = np.concatenate([pcm, np.full(whole * per - len(pcm), pcm[-1], pcm.dtype)]).astype(np.int64).reshape(whole, per)
    steps, value, index = adpcm_steps(), x[:, 0].copy(), np.zeros(whole, np.int64)
    out = np.zeros((whole, block), np.uint8)
    out[:, :2] = value.astype("<i2").view(np.uint8).reshape(whole, 2)
    for at in range(per - 1):
        step, diff = steps[index], x[:, 1 + at] - value
        left, nibble, made = np.abs(diff), np.where(diff < 0, 8, 0), step >> 3
        for bit, part in ((4, step), (2, step >> 1), (1, step >> 2)):
            hit = left >= part
            nibble, left, made = nibble | np.where(hit, bit, 0), left - np.where(hit, part, 0), made + np.where(hit, part, 0)
        value = np.clip(np.where(nibble & 8, value - made, value + made), -32768, 32767)
        index = np.clip(index + MOVES[nibble & 7], 0, 88)
        out[:, 4 + at // 2] |= (nibble << (4 if at % 2 else 0)).astype(np.uint8)
    return out.tobytes()


@dataclass
class Wave:
    format: int
    rate: int
    bits: int
    block: int
    samples: int | None
    data: bytes


def write_wave(data: bytes, format: int = MULAW, rate: int = RATE, bits: int = 8, block: int = 1, samples: int | None = None) -> bytes:
    """A mono WAVE file; other formats than PCM get a fact chunk with the number of samples."""
    extra = struct.pack("<HH", 2, 1 + 2 * (block - 4)) if format == IMA_ADPCM else b"" if format == PCM else struct.pack("<H", 0)
    per_second = rate * block if format != IMA_ADPCM else rate * block // (1 + 2 * (block - 4))
    fmt = struct.pack("<HHIIHH", format, 1, rate, per_second, block, bits) + extra
    fact = b"" if format == PCM else b"fact" + struct.pack("<II", 4, (len(data) // block if samples is None else samples) & 0xFFFFFFFF)
    body = b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + fact + b"data" + struct.pack("<I", len(data) & 0xFFFFFFFF) + data + b"\0" * (len(data) % 2)
    return b"RIFF" + struct.pack("<I", len(body) & 0xFFFFFFFF) + body


def read_wave(media: bytes) -> Wave:
    """The format and data of a mono WAVE file. Other chunks are passed over; a broken file raises ValueError."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at, form, samples = 12, None, None
    while at + 8 <= len(media):
        name, (size,) = media[at : at + 4], struct.unpack_from("<I", media, at + 4)
        if name == b"fmt ":
            form = struct.unpack_from("<HHIIHH", media, at + 8)
        elif name == b"fact":
            (samples,) = struct.unpack_from("<I", media, at + 8)
        elif name == b"data" and form:
            if at + 8 + size > len(media):
                raise ValueError("the data chunk is cut off")
            if form[1] != 1:
                raise ValueError("more than one channel")
            return Wave(form[0], form[2], form[5], form[4], samples, media[at + 8 : at + 8 + size])
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def decode(wave: Wave) -> np.ndarray:
    """Linear 16-bit samples of a file of any of the four formats."""
    if wave.format == MULAW:
        return mulaw_table()[np.frombuffer(wave.data, np.uint8)]
    if wave.format == ALAW:
        return alaw_table()[np.frombuffer(wave.data, np.uint8)]
    if wave.format == IMA_ADPCM:
        return decode_adpcm(wave.data, wave.block, wave.samples)
    if wave.format == PCM and wave.bits == 16:
        return np.frombuffer(wave.data, "<i2").astype(np.int16)
    if wave.format == PCM and wave.bits == 8:
        return ((np.frombuffer(wave.data, np.uint8).astype(np.int16) - 128) << 8).astype(np.int16)
    raise ValueError(f"format {wave.format} of {wave.bits} bits")


def decode_all(waves: Sequence[Wave]) -> list[np.ndarray]:
    """Each file's samples; the ADPCM blocks of one size, of all files, are decoded in one go."""
    out = [np.zeros(0, np.int16) if w.format == IMA_ADPCM else decode(w) for w in waves]
    for block in {w.block for w in waves if w.format == IMA_ADPCM}:
        of = [i for i, w in enumerate(waves) if w.format == IMA_ADPCM and w.block == block]
        parts = [blocks_of(waves[i].data, block) for i in of]
        made = decode_blocks(np.concatenate(parts))
        ends = np.cumsum([len(p) for p in parts])
        for i, p, end in zip(of, parts, ends.tolist()):
            out[i] = made[end - len(p) : end].reshape(-1)[: kept_samples(len(waves[i].data), block, waves[i].samples)]
    return out


def resample(pcm: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Linear interpolation between neighbours in exact integer arithmetic; n samples become ceil(n * to / rate)."""
    if rate == to or not len(pcm):
        return pcm
    g = gcd(rate, to)
    up, down = to // g, rate // g
    x = pcm.astype(np.int32)
    after = np.concatenate([x[1:], x[-1:]])
    if down == 1:  # one row of up samples for each input sample
        share = np.arange(up, dtype=np.int32)
        return ((x[:, None] * (up - share) + after[:, None] * share) // up).astype(np.int16).reshape(-1)
    pos = np.arange(-(-len(pcm) * up // down), dtype=np.int64) * down
    i, share = pos // up, pos % up
    return ((x[i] * (up - share) + after[i] * share) // up).astype(np.int16)


def padded(data: bytes, to: int = PAD) -> bytes:
    """data with bytes 0 up to a positive multiple of ``to``."""
    return data + bytes(-len(data) % to or (0 if data else to))


def wrap(payload: bytes) -> bytes:
    """A file that holds the payload (a positive multiple of PAD bytes) without loss, in the format that the payload's
    checksum deals it: as mu-law or A-law samples, or as the nibbles of ADPCM blocks that begin at sample 0, step 0."""
    form = (MULAW, ALAW, IMA_ADPCM)[zlib.crc32(payload) % 3]
    if form != IMA_ADPCM:
        return write_wave(payload, form)
    raw = np.frombuffer(payload, np.uint8).reshape(-1, BLOCK - HEADER)
    data = np.concatenate([np.zeros((len(raw), HEADER), np.uint8), raw], axis=1).tobytes()
    return write_wave(data, form, bits=4, block=BLOCK, samples=len(raw) * (1 + 2 * (BLOCK - HEADER)))


def payload_of(wave: Wave) -> bytes:
    """The samples of a file as bytes, of ADPCM the nibbles without the blocks' headers."""
    return np.ascontiguousarray(blocks_of(wave.data, wave.block)[:, HEADER:]).tobytes() if wave.format == IMA_ADPCM else wave.data


def features(pcm: np.ndarray, rate: int) -> str:
    """Rate, samples, root mean square, peak, sign changes and checksum of 16-bit samples, in integers."""
    wide = pcm.astype(np.int64)
    square = int(np.dot(wide, wide)) // max(1, len(pcm))
    sign = pcm < 0
    return f"pcm16 rate={rate} n={len(pcm)} rms={int(square**0.5)} peak={int(np.abs(wide).max(initial=0))} turns={int(np.count_nonzero(sign[1:] != sign[:-1]))} crc={zlib.crc32(pcm.astype('<i2').tobytes()):08x}"


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pad: int = PAD) -> DataFrame:
    """doc_id, n_bytes (of the UTF-8), media: an 8 kHz telephony file that holds the text's bytes, padded by bytes 0 to a
    positive multiple of ``pad`` (itself a multiple of PAD), in the format that ``wrap`` deals it.

    Null and empty texts give ``pad`` bytes 0; equal texts give equal files; repeated rows give a file each; an empty
    table gives an empty result; other columns of docs are ignored.
    """
    rows = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in batches:
            raw = [utf8(t) for t in b.column(1).to_pylist()]
            media = pa.array([wrap(padded(x, pad)) for x in raw], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) for x in raw], pa.int64()), media], names=["doc_id", "n_bytes", "media"])

    return arrow_map(rows, run, f"doc_id {id_type}, n_bytes long, media binary")


def to_pcm(files: DataFrame, media_col: str = "media", pcm_col: str = "pcm", to: int = OUT_RATE) -> DataFrame:
    """files with one more column: its media as a 16-bit PCM file at the rate ``to``, for all four formats.

    Null media give null; a file that isn't a mono WAVE file of these formats raises ValueError; repeated rows are decoded
    each; an empty table gives an empty result; a column named ``pcm_col`` (in any case of letters) is replaced.
    """

    def fn(column: pa.Array) -> list:
        media = column.to_pylist()
        waves = [read_wave(m) for m in media if m is not None]
        made = iter([write_wave(resample(x, w.rate, to).astype("<i2").tobytes(), PCM, to, 16, 2) for x, w in zip(decode_all(waves), waves)])
        return [[None if m is None else next(made) for m in media]]

    return appended(files, media_col, [(pcm_col, "binary", pa.binary())], fn, at_once=BYTES_AT_ONCE)


def inspect(files: DataFrame) -> DataFrame:
    """What the files of the columns media and pcm hold, read back from their bytes: doc_id, n_bytes, payload_bytes,
    payload_sha256, tail_crc32 (of the last 64 bytes), media_bytes, media_sha256, feature (the format, and measures of the
    PCM samples), pcm_bytes. All but doc_id and n_bytes are null where media is null, the last two where pcm is."""
    id_type = files.schema["doc_id"].dataType.simpleString()
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "pcm_bytes"]

    def row(media: bytes | None, pcm: bytes | None) -> tuple:
        if media is None:
            return (None,) * len(names)
        wave = read_wave(media)
        data = payload_of(wave)
        held = len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]), len(media), hashlib.sha256(media).hexdigest()
        if pcm is None:
            return (*held, None, None)
        linear = read_wave(pcm)
        return (*held, f"{NAMES[wave.format]} {wave.rate} {features(decode(linear), linear.rate)}", len(pcm))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in batches:
            rows = [row(m.as_py(), p.as_py()) for m, p in zip(b.column(2), b.column(3))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]], names=["doc_id", "n_bytes", *names])

    schema = f"doc_id {id_type}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, pcm_bytes long"
    return arrow_map(files.select("doc_id", "n_bytes", "media", "pcm"), run, schema)
