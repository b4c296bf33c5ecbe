"""Media columns, MPEG audio: resynchronising frame parser, tags, variable-bitrate tables, checksums, exact durations
and frame seek offsets, and a writer that stores bytes losslessly as the ancillary data of valid MPEG-2 Layer III frames.

The unit of this format is the frame of 576 samples; each frame's body carries 576 payload bytes, so a payload is a
positive multiple of 576 bytes. Decoders play such a stream as silence (no main data is granted to any granule).
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame

from quillmesh.llm import common

UNIT = 576
# Fixed values of the MPEG audio frame header (ISO 11172-3, 13818-3): kbit/s by index 1-14, Hz by index, samples a frame.
KBPS = {
    (1, 1): (32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
HZ = {1: (44100, 48000, 32000), 2: (22050, 24000, 16000), 2.5: (11025, 12000, 8000)}
SAMPLES = {(1, 1): 384, (1, 2): 1152, (1, 3): 1152, (2, 1): 384, (2, 2): 1152, (2, 3): 576}


@dataclass(frozen=True)
class Frame:
    """What a header says. side: bytes of Layer III side information; length: of the whole frame."""

    version: float
    layer: int
    crc: bool
    kbps: int
    hz: int
    channels: int
    length: int
    samples: int
    side: int


@dataclass
class Stream:
    """What a file holds. offsets: of the audio frames, without the table frame."""

    kind: Frame | None = None
    offsets: list[int] = field(default_factory=list)
    lengths: list[int] = field(default_factory=list)
    samples: int = 0
    duration: Fraction = Fraction(0)
    crc_good: int = 0
    crc_bad: int = 0
    skipped: int = 0
    tags: dict[str, str] = field(default_factory=dict)
    table: dict = field(default_factory=dict)

    def seek(self, seconds: float) -> int | None:
        """Offset of the frame that sounds at this time; None outside the stream."""
        if not self.offsets or not 0 <= seconds < self.duration:
            return None
        return self.offsets[int(Fraction(seconds) * self.kind.hz // self.kind.samples)]


_headers: dict[bytes, Frame | None] = {}


def header(four: bytes) -> Frame | None:
    """The frame that these four bytes announce; None if they are no header (free-format rates are not taken)."""
    if four not in _headers:
        if len(_headers) > 100_000:
            _headers.clear()
        _headers[four] = _read_header(four)
    return _headers[four]


def _read_header(four: bytes) -> Frame | None:
    if len(four) < 4 or four[0] != 0xFF or four[1] & 0xE0 != 0xE0:
        return None
    version, layer = {0: 2.5, 2: 2, 3: 1}.get(four[1] >> 3 & 3), 4 - (four[1] >> 1 & 3)
    rate, hz, pad = four[2] >> 4, four[2] >> 2 & 3, four[2] >> 1 & 1
    if version is None or layer == 4 or rate in (0, 15) or hz == 3:
        return None
    family = (1 if version == 1 else 2, layer)
    kbps, hz, channels = KBPS[family][rate - 1], HZ[version][hz], 1 if four[3] >> 6 == 3 else 2
    samples = SAMPLES[family]
    length = (12_000 * kbps // hz + pad) * 4 if layer == 1 else samples // 8 * 1000 * kbps // hz + pad
    side = 0 if layer < 3 else {(1, 1): 17, (1, 2): 32, (2, 1): 9, (2, 2): 17}[family[0], channels]
    return Frame(version, layer, not four[1] & 1, kbps, hz, channels, length, samples, side)


_CRC = [0] * 256
for _i in range(256):
    _c = _i << 8
    for _ in range(8):
        _c = (_c << 1 ^ (0x8005 if _c & 0x8000 else 0)) & 0xFFFF
    _CRC[_i] = _c
_crcs: dict[bytes, int] = {}


def checksum(protected: bytes) -> int:
    """The frame checksum: CRC-16, polynomial 8005, start FFFF."""
    if (c := _crcs.get(protected)) is None:
        c = 0xFFFF
        for b in protected:
            c = (c << 8 ^ _CRC[c >> 8 ^ b]) & 0xFFFF
        if len(_crcs) > 100_000:
            _crcs.clear()
        _crcs[protected] = c
    return c


def _same(a: Frame, b: Frame | None) -> bool:
    return b is not None and (a.version, a.layer, a.hz) == (b.version, b.layer, b.hz)


def _synchsafe(four: bytes) -> int:
    return four[0] << 21 | four[1] << 14 | four[2] << 7 | four[3]


def _tags(data: bytes, out: Stream) -> tuple[int, int]:
    """Reads ID3 tags; returns where the audio starts and ends."""
    start, end = 0, len(data)
    while data[start : start + 3] == b"ID3" and len(data) >= start + 10:
        size, at = _synchsafe(data[start + 6 : start + 10]), start + 10
        stop = min(at + size, end)
        while at + 10 <= stop and data[at] != 0:
            name = data[at : at + 4].decode("latin-1")
            n = _synchsafe(data[at + 4 : at + 8]) if data[start + 3] == 4 else struct.unpack(">I", data[at + 4 : at + 8])[0]
            value = data[at + 10 : min(at + 10 + n, stop)]
            if name[0] == "T" and value:
                text = value[1:].decode({0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(value[0], "latin-1"), "replace")
                key, _, rest = text.partition("\0")
                out.tags[f"TXXX:{key}" if name == "TXXX" else name] = (rest if name == "TXXX" else text).rstrip("\0")
            at += 10 + n
        start = min(start + 10 + size + (10 if data[start + 5] & 0x10 else 0), end)
    if end - start >= 128 and data[end - 128 : end - 125] == b"TAG" and not _framed(data, start, end):
        end -= 128
        for name, a, b in (("title", 3, 33), ("artist", 33, 63), ("album", 63, 93)):
            if value := data[end + a : end + b].split(b"\0")[0].strip().decode("latin-1"):
                out.tags.setdefault(f"ID3v1:{name}", value)
    return start, end


def _framed(data: bytes, at: int, end: int) -> bool:
    """Whether frames follow each other from `at` to the very end, so that no tag stands there."""
    first = None
    while at + 4 <= end and (f := header(data[at : at + 4])) and (first is None or _same(first, f)):
        first, at = first or f, at + f.length
    return first is not None and at == end


def _table(data: bytes, at: int, f: Frame) -> dict:
    """The variable-bitrate table (Xing, Info or VBRI) of a first frame; empty if it holds none."""
    body = at + 4 + (2 if f.crc else 0) + f.side
    for place in {body, at + 4 + f.side}:
        if data[place : place + 4] in (b"Xing", b"Info"):
            flags, p = struct.unpack(">I", data[place + 4 : place + 8])[0], place + 8
            got: dict = {"kind": data[place : place + 4].decode()}
            for bit, name in ((1, "frames"), (2, "bytes")):
                if flags & bit:
                    got[name], p = struct.unpack(">I", data[p : p + 4])[0], p + 4
            if flags & 4:
                got["toc"], p = list(data[p : p + 100]), p + 100
            return got
    if data[at + 36 : at + 40] == b"VBRI" and at + 62 <= len(data):
        size, frames, n, scale, width, each = struct.unpack(">IIHHHH", data[at + 46 : at + 62])
        raw = data[at + 62 : at + 62 + n * width]
        return {"kind": "VBRI", "bytes": size, "frames": frames, "toc": [int.from_bytes(raw[i : i + width], "big") * scale for i in range(0, len(raw), max(1, width))], "step": each}
    return {}


def parse(data: bytes) -> Stream:
    """Walks a whole file. Bytes that are no frame are skipped until a header whose successor (or the end) agrees with it."""
    out = Stream()
    at, end = _tags(data, out)
    first, locked = True, False
    while at + 4 <= end:
        f = header(data[at : at + 4])
        ok = f is not None and at + f.length <= end and (out.kind is None or _same(out.kind, f))
        if ok and not locked:
            after = at + f.length
            ok = after + 4 > end or _same(f, header(data[after : after + 4]))
        if not ok:
            nxt = data.find(b"\xff", at + 1, end)
            nxt = end if nxt < 0 else nxt
            out.skipped += nxt - at
            at, locked = nxt, False
            continue
        locked, out.kind = True, out.kind or f
        if f.crc and f.layer == 3:
            good = checksum(data[at + 2 : at + 4] + data[at + 6 : at + 6 + f.side]) == int.from_bytes(data[at + 4 : at + 6], "big")
            out.crc_good += good
            out.crc_bad += not good
        if first and (table := _table(data, at, f)):
            out.table = table
        else:
            out.offsets.append(at)
            out.lengths.append(f.length)
            out.samples += f.samples
        first = False
        at += f.length
    out.skipped += max(0, end - at)
    out.duration = Fraction(out.samples, out.kind.hz) if out.kind else Fraction(0)
    return out


#: MPEG-2 Layer III, checksum, 144 kbit/s, 16 kHz, mono: frames of 648 bytes.
_HEAD = bytes([0xFF, 0xF2, 13 << 4 | 2 << 2, 0xC0])
_FRAME = _read_header(_HEAD)
_BODY = 6 + _FRAME.side
_PREFIX = _HEAD + checksum(_HEAD[2:] + bytes(_FRAME.side)).to_bytes(2, "big") + bytes(_FRAME.side)
_REST = bytes(_FRAME.length - _BODY - UNIT)


def padded(raw: bytes) -> bytes:
    """raw with bytes 255 behind, up to a positive multiple of 576."""
    return raw + b"\xff" * (-len(raw) % UNIT if raw else UNIT)


def encode(payload: bytes, tags: dict[str, str] | None = None) -> bytes:
    """The payload as a stream: ID3v2 tag, table frame with seek points, one frame for each 576 bytes."""
    if not payload or len(payload) % UNIT:
        raise ValueError(f"a payload is a positive multiple of {UNIT} bytes")
    parts = b""
    for k, v in (tags or {}).items():
        text = b"\3" + k.encode() + b"\0" + v.encode()
        n = len(text)
        parts += b"TXXX" + bytes([n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127]) + b"\0\0" + text
    n, frames = len(parts), len(payload) // UNIT
    tag = b"ID3\4\0\0" + bytes([n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127]) + parts
    size = (frames + 1) * _FRAME.length
    # seek points: share of the bytes (of 256) at each hundredth of the time
    toc = bytes(min(255, (1 + i * frames // 100) * 256 // (frames + 1)) for i in range(100))
    table = b"Info" + struct.pack(">III", 7, frames, size) + toc
    out = [tag, (_PREFIX + table).ljust(_FRAME.length, b"\0")]
    for i in range(0, len(payload), UNIT):
        out += (_PREFIX, payload[i : i + UNIT], _REST)
    return b"".join(out)


def decode(data: bytes, stream: Stream | None = None) -> bytes:
    """The payload that encode() stored, read from the bodies of the parsed frames."""
    stream = stream or parse(data)
    return b"".join([data[o + _BODY : o + _BODY + UNIT] for o in stream.offsets])


SCHEMA = pa.schema([
    ("n_bytes", pa.int64()), ("media", pa.binary()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()),
    ("frames", pa.int64()), ("samples", pa.int64()), ("duration_s", pa.float64()), ("crc_good", pa.int64()), ("crc_bad", pa.int64()), ("skipped_bytes", pa.int64()), ("seek_offsets", pa.list_(pa.int64())), ("feature", pa.string()),
])
_DDL = "n_bytes long, media binary, media_bytes long, media_sha256 string, payload_bytes long, payload_sha256 string, tail_crc32 long, frames long, samples long, duration_s double, crc_good long, crc_bad long, skipped_bytes long, seek_offsets array<long>, feature string"


def _row(text: str | None, media: bool, seek: bool) -> dict:
    raw = (text or "").encode("utf-8", "surrogatepass")
    data = encode(padded(raw), {"n_bytes": str(len(raw))})
    s = parse(data)
    back = decode(data, s)
    return {
        "n_bytes": int(s.tags["TXXX:n_bytes"]), "media": data if media else None, "media_bytes": len(data), "media_sha256": hashlib.sha256(data).hexdigest(), "payload_bytes": len(back), "payload_sha256": hashlib.sha256(back).hexdigest(), "tail_crc32": zlib.crc32(back[-32:]),
        "frames": len(s.offsets), "samples": s.samples, "duration_s": float(s.duration), "crc_good": s.crc_good, "crc_bad": s.crc_bad, "skipped_bytes": s.skipped, "seek_offsets": s.offsets if seek else None,
        "feature": f"mpeg{s.kind.version:g}-layer{s.kind.layer} {s.kind.kbps}kbps {s.kind.hz}Hz ch={s.kind.channels} frames={len(s.offsets)} duration={s.duration} crc={s.crc_good}/{s.crc_good + s.crc_bad} table={s.table['kind']}:{s.table['frames']} first={s.offsets[0]} last={s.offsets[-1]}",
    }


def media_column(docs: DataFrame, text: str = "text", id_col: str = "doc_id", media: bool = True, seek: bool = True) -> DataFrame:
    """Stores each text as an MPEG audio column, reads it back, and returns the id with what was read.

    media=False and seek=False leave these two large columns null. Null text counts as empty; an empty text is one frame
    of padding. Repeated rows give repeated rows, an empty table an empty one; other columns of docs are not read, so
    their names can't clash. One text is in memory at a time, besides its Arrow batch.
    """
    id_field = docs.schema[id_col]
    schema = f"{id_col} {id_field.dataType.simpleString()}, {_DDL}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, text, 4_000_000):
            rows = [_row(t, media, seek) for t in b.column(1).to_pylist()]
            got = pa.RecordBatch.from_pylist(rows, SCHEMA)
            yield pa.RecordBatch.from_arrays([b.column(0), *got.columns], names=[id_col, *SCHEMA.names])

    return docs.select(id_col, text).mapInArrow(run, schema)


def op10(docs: DataFrame) -> DataFrame:
    """The digest columns of the query."""
    return media_column(docs, media=False, seek=False).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "frames", "duration_s")
