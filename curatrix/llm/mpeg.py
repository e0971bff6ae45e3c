"""Media columns: MPEG audio files in a binary column, parsed back to exact facts.

Writer: an ID3v2 tag, a Xing table frame and checksum-protected Layer III frames carry a
payload of whole 576-byte units, one unit a frame. Reader: skips and parses tags, finds
frame headers (and finds them again after damage), reads Xing and VBRI tables with their
seek tables and holds these against the frames found, verifies the CRC-16 of protected
frames of all three layers and gives exact durations and seek offsets. The column of files
is written to a table and read back before it is parsed.

Defined results: null and empty texts are one unit of padding; a stream without frames
parses to zero frames, duration 0 and no offsets; texts of any length are stored whole;
repeated rows repeat their values; an empty table gives no rows; other columns, whatever
their names, are ignored; nothing is ranked, so nothing ties.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import struct
import zlib
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import canonical, documents, materialize

UNIT = 576

# Fixed values of the MPEG audio standard: kbit/s by (version 1 or not, layer), index 1 to 14.
BITRATES = {
    (True, 1): (32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (True, 2): (32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (True, 3): (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (False, 1): (32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (False, 2): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (False, 3): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
# Hz by the two version bits (3: version 1, 2: version 2, 0: version 2.5).
SAMPLE_RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}


@functools.cache
def _crc_table() -> tuple[int, ...]:
    table = []
    for i in range(256):
        c = i << 8
        for _ in range(8):
            c = (c << 1) ^ (0x8005 if c & 0x8000 else 0)
        table.append(c & 0xFFFF)
    return tuple(table)


@functools.lru_cache(4096)
def crc16(data: bytes) -> int:
    """The frame checksum: polynomial 0x8005, start 0xFFFF."""
    c, table = 0xFFFF, _crc_table()
    for b in data:
        c = ((c << 8) & 0xFFFF) ^ table[(c >> 8) ^ b]
    return c


@dataclass(frozen=True)
class Header:
    version: int
    layer: int
    protected: bool
    bitrate: int
    rate: int
    padding: int
    mono: bool
    bound: int
    size: int
    samples: int

    @property
    def side(self) -> int:
        """Bytes of Layer III side information."""
        if self.layer != 3:
            return 0
        return (17 if self.mono else 32) if self.version == 3 else (9 if self.mono else 17)


@functools.lru_cache(4096)
def parse_header(four: bytes) -> Header | None:
    """A frame header, or None where the bytes are none (free format counts as none)."""
    if len(four) < 4 or four[0] != 0xFF or four[1] & 0xE0 != 0xE0:
        return None
    version, layer_bits = four[1] >> 3 & 3, four[1] >> 1 & 3
    rate_index, bit_index = four[2] >> 2 & 3, four[2] >> 4
    if version == 1 or layer_bits == 0 or rate_index == 3 or bit_index in (0, 15) or four[3] & 3 == 2:
        return None
    layer, pad = 4 - layer_bits, four[2] >> 1 & 1
    bitrate, rate = BITRATES[version == 3, layer][bit_index - 1] * 1000, SAMPLE_RATES[version][rate_index]
    samples = 384 if layer == 1 else 576 if layer == 3 and version != 3 else 1152
    size = (12 * bitrate // rate + pad) * 4 if layer == 1 else samples // 8 * bitrate // rate + pad
    return Header(version, layer, not four[1] & 1, bitrate, rate, pad, four[3] >> 6 == 3, 4 * (four[3] >> 4 & 3) + 4 if four[3] >> 6 == 1 else 32, size, samples)


# Fixed values of the standard, Layer II: for each allocation table the (last subband, bits of
# allocation) steps.
LAYER2 = (((3, 4), (11, 4), (23, 3), (27, 2)), ((3, 4), (11, 4), (23, 3), (30, 2)), ((2, 4), (8, 3)), ((2, 4), (12, 3)), ((4, 4), (11, 3), (30, 2)))


def _layer2_table(h: Header) -> int:
    each = h.bitrate // (1 if h.mono else 2) // 1000
    if h.version != 3:
        return 4
    if 56 <= each <= 80 or h.rate == 48000 and each >= 56:
        return 0
    if h.rate != 48000 and each >= 96:
        return 1
    return 2 if h.rate != 32000 and each <= 48 else 3


def covered_bits(data: bytes, at: int, h: Header) -> int:
    """Bits behind the checksum that it covers: side information (III), allocation (I), or
    allocation and scale factor selection (II)."""
    if h.layer == 3:
        return 8 * h.side
    channels = 1 if h.mono else 2
    if h.layer == 1:
        bound = 32 if h.mono else h.bound
        return 4 * (channels * bound + 32 - bound)
    steps = LAYER2[_layer2_table(h)]
    bits = int.from_bytes(data[at + 6 : at + 6 + 64].ljust(64, b"\0"), "big")
    place = chosen = 0
    for band in range(steps[-1][0]):
        width = next(w for last, w in steps if band < last)
        shared = not h.mono and band >= h.bound
        for _ in range(1 if shared else channels):
            value = bits >> (512 - place - width) & ((1 << width) - 1)
            place += width
            chosen += bool(value) * (channels if shared else 1)
    return place + 2 * chosen


def frame_crc(data: bytes, at: int, h: Header) -> int:
    """The checksum that the frame at ``at`` should carry."""
    n = covered_bits(data, at, h)
    c = crc16(data[at + 2 : at + 4] + data[at + 6 : at + 6 + n // 8])
    for i in range(n % 8):
        bit = data[at + 6 + n // 8] >> (7 - i) & 1
        c = ((c << 1) ^ (0x8005 if (c >> 15) ^ bit else 0)) & 0xFFFF
    return c


# The writer's frames: version 1, Layer III, 48 kHz, stereo, 224 kbit/s, protected.
_HEAD = bytes((0xFF, 0xFA, 12 << 4 | 1 << 2, 0x00))
_SIDE = bytes(32)
_START = _HEAD + struct.pack(">H", crc16(_HEAD[2:] + _SIDE)) + _SIDE
_FRAME = parse_header(_HEAD).size


def _syncsafe(n: int) -> bytes:
    return bytes(n >> s & 0x7F for s in (21, 14, 7, 0))


def write_mpeg(payload: bytes, text_bytes: int) -> bytes:
    """The stored form of a payload of whole units; the unpadded length goes to a tag."""
    body = b"\x03TEXT_BYTES\x00" + str(text_bytes).encode()
    tag_frame = b"TXXX" + _syncsafe(len(body)) + b"\x00\x00" + body
    tag = b"ID3\x04\x00\x00" + _syncsafe(len(tag_frame)) + tag_frame
    n = len(payload) // UNIT
    frames = np.zeros((n + 1, _FRAME), np.uint8)
    frames[:, : len(_START)] = np.frombuffer(_START, np.uint8)
    frames[1:, len(_START) : len(_START) + UNIT] = np.frombuffer(payload, np.uint8).reshape(n, UNIT)
    toc = bytes(min(255, 256 * (1 + n * i // 100) // (n + 1)) for i in range(100))
    xing = b"Xing" + struct.pack(">III", 7, n, (n + 1) * _FRAME) + toc
    frames[0, len(_START) : len(_START) + len(xing)] = np.frombuffer(xing, np.uint8)
    return tag + frames.tobytes()


@dataclass
class Parsed:
    offsets: list[int] = field(default_factory=list)
    duration: Fraction = Fraction(0)
    tags: dict[str, str] = field(default_factory=dict)
    table: dict[str, object] = field(default_factory=dict)
    checked: int = 0
    bad_crc: int = 0
    skipped: int = 0
    bitrates: set[int] = field(default_factory=set)
    rate: int = 0
    table_at: int = -1


def _id3v2(data: bytes, at: int, tags: dict[str, str]) -> int:
    """The end of the tag at ``at``, or ``at``."""
    if data[at : at + 3] != b"ID3" or len(data) < at + 10 or max(data[at + 6 : at + 10]) > 127:
        return at
    major, flags = data[at + 3], data[at + 5]
    size = int.from_bytes(bytes(4), "big")
    for b in data[at + 6 : at + 10]:
        size = size << 7 | b
    end = min(len(data), at + 10 + size)
    p = at + 10
    while major in (3, 4) and p + 10 <= end and data[p] != 0:
        name, raw = data[p : p + 4].decode("latin-1"), data[p + 4 : p + 8]
        n = functools.reduce(lambda a, b: a << 7 | b, raw, 0) if major == 4 else int.from_bytes(raw, "big")
        body = data[p + 10 : min(end, p + 10 + n)]
        if name[0] == "T" and body:
            text = body[1:].decode({0: "latin-1", 1: "utf-16", 2: "utf-16-be"}.get(body[0], "utf-8"), "replace").rstrip("\0")
            key, _, value = text.partition("\0") if name == "TXXX" else (name, "", text)
            tags[key] = value
        p += 10 + n
    return end + (10 if flags & 0x10 else 0)


def _table(data: bytes, at: int, h: Header) -> dict[str, object]:
    """Xing/Info or VBRI facts of the frame, or nothing."""
    p = at + 4 + (2 if h.protected else 0) + h.side
    if data[p : p + 4] in (b"Xing", b"Info"):
        flags = int.from_bytes(data[p + 4 : p + 8], "big")
        out: dict[str, object] = {"kind": data[p : p + 4].decode()}
        p += 8
        for bit, name, n in ((1, "frames", 4), (2, "bytes", 4), (4, "toc", 100), (8, "quality", 4)):
            if flags & bit:
                out[name] = list(data[p : p + n]) if name == "toc" else int.from_bytes(data[p : p + n], "big")
                p += n
        return out
    p = at + 4 + 32
    if data[p : p + 4] == b"VBRI":
        size, frames, entries, scale, width, step = struct.unpack(">IIHHHH", data[p + 10 : p + 26].ljust(16, b"\0"))
        steps = [scale * int.from_bytes(data[p + 26 + k * width : p + 26 + (k + 1) * width], "big") for k in range(entries)]
        return {"kind": "VBRI", "bytes": size, "frames": frames, "step": step, "seek": list(itertools.accumulate(steps))}
    return {}


def seek_table_holds(parsed: Parsed, size: int) -> bool | None:
    """Whether the file's seek table names the frames found: a Xing table each hundredth of
    the duration within a frame and its own grain (1/256 of the size), a VBRI table each
    step's start. None without a table or frames."""
    offsets, table = parsed.offsets, parsed.table
    if not offsets or not (table.get("toc") or table.get("seek")):
        return None
    first = parsed.table_at if parsed.table_at >= 0 else offsets[0]
    total = int(table.get("bytes") or size - first)
    if "toc" in table:
        frame = max(np.diff([*offsets, first + total]), default=0)
        wanted = [offsets[len(offsets) * i // 100] - first for i in range(100)]
        return all(abs(t * total / 256 - w) <= frame + total / 256 for t, w in zip(table["toc"], wanted, strict=True))
    starts = [o - first for o in offsets[int(table["step"]) :: int(table["step"]) or 1]] if table["step"] else []
    return all(a == b for a, b in zip(table["seek"], starts)) and len(starts) <= len(table["seek"])


def parse_mpeg(data: bytes) -> Parsed:
    """All facts of a stream; a header counts where the next frame follows it or the data ends."""
    out = Parsed()
    at = 0
    while (after := _id3v2(data, at, out.tags)) > at:
        at = after
    end = len(data)
    if end - at >= 128 and data[end - 128 : end - 125] == b"TAG":
        end -= 128
        out.tags.setdefault("TIT2", data[end + 3 : end + 33].rstrip(b"\0 ").decode("latin-1"))
    locked = False
    while at + 4 <= end:
        h = parse_header(data[at : at + 4])
        if h is not None and not locked:
            nxt = at + h.size
            if nxt < end and (nxt + 4 > end or parse_header(data[nxt : nxt + 4]) is None):
                h = None
        if h is None or at + h.size > end:
            found = data.find(b"\xff", at + 1, end)
            found = end if found < 0 else found
            out.skipped += found - at
            at, locked = found, False
            continue
        locked = True
        if h.protected:
            out.checked += 1
            out.bad_crc += frame_crc(data, at, h) != int.from_bytes(data[at + 4 : at + 6], "big")
        if not out.offsets and not out.table and (table := _table(data, at, h)):
            out.table, out.table_at = table, at
        else:
            out.offsets.append(at)
            out.duration += Fraction(h.samples, h.rate) if h.rate != out.rate and out.rate else 0
            if not out.rate:
                out.rate, out.table = h.rate, {**out.table, "samples": h.samples}
            if h.rate == out.rate:
                out.table["n"] = int(out.table.get("n", 0)) + h.samples
            out.bitrates.add(h.bitrate)
        at += h.size
    out.skipped += max(0, end - at)
    if out.rate:
        out.duration += Fraction(int(out.table.pop("n", 0)), out.rate)
    return out


def read_payload(data: bytes, parsed: Parsed | None = None) -> bytes:
    """The units that the writer's frames carry."""
    parsed = parsed or parse_mpeg(data)
    if not parsed.offsets:
        return b""
    first = parsed.offsets[0]
    n = len(parsed.offsets)
    if parsed.offsets[-1] - first == (n - 1) * _FRAME:
        grid = np.frombuffer(data, np.uint8, n * _FRAME, first).reshape(n, _FRAME)
        return grid[:, len(_START) : len(_START) + UNIT].tobytes()
    return b"".join(data[p + len(_START) : p + len(_START) + UNIT] for p in parsed.offsets)


def padded(raw: bytes) -> bytes:
    """Bytes 255 up to a positive multiple of the unit."""
    return raw + b"\xff" * (-len(raw) % UNIT if raw else UNIT)


STORED = "n_bytes long, media binary"
FACTS = "payload_sha256 string, payload_bytes long, tail_crc32 long, media_bytes long, media_sha256 string, duration_num long, duration_den long, seek_offsets array<long>, bad_crc long, feature string"


def stored(text: str) -> tuple[int, bytes]:
    raw = text.encode("utf-8", "surrogatepass")
    return len(raw), write_mpeg(padded(raw), len(raw))


def facts(media: bytes) -> tuple:
    """The values of FACTS, all from the stored bytes."""
    parsed = parse_mpeg(media)
    payload = read_payload(media, parsed)
    levels = np.frombuffer(payload, np.uint8)
    rms = float(np.sqrt(np.mean((levels.astype(np.float32) - 128.0) ** 2))) if len(levels) else 0.0
    d = parsed.duration
    feature = f"kind=mpeg1-layer3;frames={len(parsed.offsets)};rate={parsed.rate};duration={d.numerator}/{d.denominator};kbps={','.join(str(b // 1000) for b in sorted(parsed.bitrates))};table={parsed.table.get('kind', 'none')}:{parsed.table.get('frames', 0)};table_holds={seek_table_holds(parsed, len(media))};crc={parsed.checked - parsed.bad_crc}/{parsed.checked};text_bytes={parsed.tags.get('TEXT_BYTES', '')};rms={rms:.3f}"
    return (hashlib.sha256(payload).hexdigest(), len(payload), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), d.numerator, d.denominator, parsed.offsets, parsed.bad_crc, feature)


def media_column(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the file of every text."""

    @F.pandas_udf(STORED)
    def store(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([stored(t) for t in texts], columns=["n_bytes", "media"])

    return canonical(docs).select("doc_id", store("text").alias("m")).select("doc_id", "m.*")


def media_facts(media: DataFrame) -> DataFrame:
    """The columns of media but the file itself, and FACTS."""

    @F.pandas_udf(FACTS)
    def parse(files: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([facts(f) for f in files], columns=[x.split()[0] for x in FACTS.split(", ")])

    others = [c for c in media.columns if c != "media"]
    return media.select(*others, parse("media").alias("f")).select(*others, "f.*")


def op5_mpeg_audio(spark, sf_dir: str) -> DataFrame:
    return media_facts(materialize(media_column(documents(spark, sf_dir)), "media")).drop("bad_crc")
