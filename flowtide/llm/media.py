"""Operator 8, Ogg media columns.

A payload is kept as two logical streams of unsigned 8-bit mono samples at 8 kHz, multiplexed in one
physical Ogg stream (RFC 3533). Packets of PACKET bytes go to the two streams in turn. Each stream starts
with a page of its own that holds an identification packet, and its last page is marked as the end.
Reading checks the checksum and the sequence number of each page, reassembles packets from lacing values
(across pages where they continue), takes the streams apart by serial number and derives each packet's
time from granule positions, which count a stream's samples up to the last packet that ends on a page.

A page whose checksum, sequence or framing is wrong raises ValueError: damaged media never passes silently.
Defined cases: null text is an empty payload; an empty payload is padded to 64 bytes; no payload is too long. Rows that
repeat have equal media and equal digests; an empty table gives an empty one. The functions are Columns, so no name clashes.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import slices

RATE, PACKET, BLOCK = 8000, 4096, 64
SERIALS = (1, 2)
IDENT = b"PCMu8mono" + struct.pack("<I", RATE)
#: Page flags, and the segments that a page can hold.
CONTINUED, FIRST, LAST, SEGMENTS = 1, 2, 4, 255
_MIRROR = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def page_crc(page: bytes) -> int:
    """Ogg's checksum: polynomial 0x04C11DB7, no reflection, no initial or final inversion.

    zlib computes the reflected form with both inversions; mirroring bits going in and out and undoing the inversions gives Ogg's.
    """
    reflected = zlib.crc32(page.translate(_MIRROR), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(reflected.to_bytes(4, "little").translate(_MIRROR), "big")


def _page(serial: int, number: int, flags: int, granule: int, lacing: bytes, body: bytes) -> bytes:
    head = struct.pack("<4sBBqII", b"OggS", 0, flags, granule, serial, number)
    tail = bytes([len(lacing)]) + lacing + body
    return head + struct.pack("<I", page_crc(head + b"\0\0\0\0" + tail)) + tail


def _data_pages(serial: int, packets: list[bytes]) -> list[bytes]:
    """The pages after the identification page; a packet that doesn't fit goes on on the next page."""
    lacing, ends, granule = bytearray(), [], 0
    for p in packets:
        lacing += b"\xff" * (len(p) // 255) + bytes([len(p) % 255])
        granule += len(p)
        ends.append((len(lacing), granule))
    body, pages, at, e, continued = b"".join(packets), [], 0, 0, 0
    for k in range(0, max(1, len(lacing)), SEGMENTS):
        part = bytes(lacing[k : k + SEGMENTS])
        done = -1
        while e < len(ends) and ends[e][0] <= k + len(part):
            done, e = ends[e][1], e + 1
        last = LAST if k + SEGMENTS >= len(lacing) else 0
        pages.append(_page(serial, len(pages) + 1, continued | last, done if packets else 0, part, body[at : at + sum(part)]))
        at += sum(part)
        continued = CONTINUED if part and part[-1] == 255 else 0
    return pages


def write(payload: bytes) -> bytes:
    """Payload to a physical Ogg stream."""
    packets = [payload[k : k + PACKET] for k in range(0, len(payload), PACKET)]
    streams = [_data_pages(s, packets[i :: len(SERIALS)]) for i, s in enumerate(SERIALS)]
    out = [_page(s, 0, FIRST, 0, bytes([len(IDENT)]), IDENT) for s in SERIALS]
    for k in range(max(map(len, streams))):
        out += [pages[k] for pages in streams if k < len(pages)]
    return b"".join(out)


@dataclass
class Stream:
    packets: list[bytes] = field(default_factory=list)
    #: Seconds at which each packet ends.
    times: list[float] = field(default_factory=list)
    pages: int = 0
    ended: bool = False
    open_: list[bytes] = field(default_factory=list)


def read(media: bytes) -> dict[int, Stream]:
    """A physical Ogg stream to its logical streams by serial number. Raises ValueError on damage."""
    streams: dict[int, Stream] = {}
    at = 0
    while at < len(media):
        if len(media) - at < 27:
            raise ValueError("a page header is cut short")
        mark, version, flags, granule, serial, number, crc = struct.unpack_from("<4sBBqIII", media, at)
        lacing = media[at + 27 : at + 27 + media[at + 26]]
        start, size = at + 27 + media[at + 26], sum(lacing)
        if mark != b"OggS" or version or len(lacing) < media[at + 26] or start + size > len(media):
            raise ValueError("a page is malformed or cut short")
        if page_crc(media[at : at + 22] + b"\0\0\0\0" + media[at + 26 : start + size]) != crc:
            raise ValueError("a page's checksum is wrong")
        if bool(flags & FIRST) == (serial in streams):
            raise ValueError("a stream starts twice or not at all")
        s = streams.setdefault(serial, Stream())
        if number != s.pages or s.ended or bool(flags & CONTINUED) != bool(s.open_):
            raise ValueError("a page is missing or out of order")
        s.pages, s.ended, first = s.pages + 1, bool(flags & LAST), len(s.packets)
        length = 0
        for lace in lacing:
            length += lace
            if lace < 255:
                s.packets.append(b"".join([*s.open_, media[start : start + length]]))
                s.open_, start, length = [], start + length, 0
        if length:
            s.open_.append(media[start : start + length])
            start += length
        if len(s.packets) > first:
            # the granule position belongs to the last packet that ends here; earlier ones are a packet's samples before
            ends, left = [], granule
            for p in reversed(s.packets[first:]):
                ends.append(left / RATE)
                left -= 0 if flags & FIRST else len(p)
            s.times += ends[::-1]
        at = start
    if any(s.open_ or not s.ended for s in streams.values()):
        raise ValueError("a stream is cut short")
    return streams


def payload_of(streams: dict[int, Stream]) -> bytes:
    """The payload of a read stream: the data packets of the logical streams in turn."""
    each = [streams[s].packets[1:] for s in SERIALS]
    return b"".join(p[k] for k in range(max(map(len, each), default=0)) for p in each if k < len(p))


def padded(raw: bytes) -> bytes:
    return raw + bytes(-len(raw) % BLOCK or (BLOCK if not raw else 0))


def describe(text: str | None) -> dict:
    """The digest of a text's media form; payload values come from what was read back."""
    raw = (text or "").encode("utf-8", "replace")
    media = write(padded(raw))
    streams = read(media)
    back = payload_of(streams)
    n = [sum(map(len, streams[s].packets[1:])) for s in SERIALS]
    times = [streams[s].times[-1] for s in SERIALS]
    return {
        "n_bytes": len(raw), "payload_bytes": len(back), "payload_sha256": hashlib.sha256(back).hexdigest(), "tail_crc32": zlib.crc32(back[-BLOCK:]),
        "media_bytes": len(media), "media_sha256": hashlib.sha256(media).hexdigest(),
        "feature": f"ogg streams={len(streams)} pages={sum(s.pages for s in streams.values())} packets={sum(len(s.packets) for s in streams.values())} samples={n[0]}+{n[1]} seconds={times[0]:.6f}+{times[1]:.6f}",
    }


DIGEST = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
_ARROW = pa.struct([(n, pa.string() if k == "string" else pa.int64()) for n, k in (x.split() for x in DIGEST.split(", "))])


def media_digest(text: Column) -> Column:
    """Text to the struct DIGEST."""

    @F.arrow_udf(f"struct<{DIGEST.replace(' ', ':').replace(',:', ',')}>")
    def digest(text: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array([describe(x) for x in part.to_pylist()], _ARROW) for part in slices(text)] or [pa.array([], _ARROW)])

    return digest(text)


def to_media(text: Column) -> Column:
    """Text to its Ogg bytes: the media column itself."""

    @F.arrow_udf("binary")
    def media(text: pa.Array) -> pa.Array:
        return pa.array([write(padded((x or "").encode("utf-8", "replace"))) for x in text.to_pylist()], pa.binary())

    return media(text)


def from_media(media: Column) -> Column:
    """Ogg bytes to the payload; null for null."""

    @F.arrow_udf("binary")
    def payload(media: pa.Array) -> pa.Array:
        return pa.array([None if x is None else payload_of(read(x)) for x in media.to_pylist()], pa.binary())

    return payload(media)
