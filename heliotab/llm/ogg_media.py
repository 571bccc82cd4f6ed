"""Media columns in Ogg: pages with checksums, packets in lacing values, several logical streams, and times from granule positions.

A clip holds 8-bit samples in interleaved channels; each channel is a logical stream of its own. Each stream begins with a header packet of 8 bytes (MAGIC, channel, channels) on a page of its own; after it come packets of PACKET samples, whose granule position is the number of the channel's samples so far.
"""

import struct
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from heliotab.llm.common import map_texts

MAGIC = b"PCM8\x00\x01"
#: Samples a packet; segments a page at most; samples a second that the times assume.
PACKET, SEGMENTS, RATE = 4096, 64, 8000
CHANNELS = 2
_HEAD = struct.Struct("<4sBBqIIIB")
_MIRROR = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


class OggError(ValueError):
    """Bytes that aren't whole and unhurt Ogg."""


def checksum(data: bytes) -> int:
    """The page checksum: CRC-32 with polynomial 0x04C11DB7, high bits first, from 0 and not inverted. zlib has the mirror image of it."""
    mirrored = zlib.crc32(data.translate(_MIRROR), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int(f"{mirrored:032b}"[::-1], 2)


def page(serial: int, number: int, granule: int, flags: int, lacing: bytes, body: bytes) -> bytes:
    head = bytearray(_HEAD.pack(b"OggS", 0, flags, granule, serial, number, 0, len(lacing)) + lacing)
    head[22:26] = checksum(bytes(head) + body).to_bytes(4, "little")
    return bytes(head) + body


def stream_pages(serial: int, packets: list[tuple[bytes, int]]) -> list[bytes]:
    """The pages of one logical stream of (packet, granule position after it). The first packet has a page of its own; packets may run over pages."""
    pages: list[bytes] = []
    lacing, body, granule, goes_on = bytearray(), bytearray(), -1, False

    def flush(last: bool) -> None:
        nonlocal lacing, body, granule, goes_on
        flags = (1 if goes_on else 0) | (2 if not pages else 0) | (4 if last else 0)
        pages.append(page(serial, len(pages), granule, flags, bytes(lacing), bytes(body)))
        goes_on = bool(lacing) and lacing[-1] == 255
        lacing, body, granule = bytearray(), bytearray(), -1

    for k, (packet, after) in enumerate(packets):
        values = [255] * (len(packet) // 255) + [len(packet) % 255]
        at = 0
        for i, v in enumerate(values):
            if len(lacing) == SEGMENTS:
                flush(False)
            lacing.append(v)
            body += packet[at : at + v]
            at += v
            if i == len(values) - 1:
                granule = after
        if k == 0 and len(packets) > 1:
            flush(False)
    flush(True)
    return pages


def write(samples: bytes, channels: int = CHANNELS) -> bytes:
    """One Ogg clip. The number of samples must be a multiple of the channels; serial numbers come from the samples alone."""
    if len(samples) % channels:
        raise OggError("the samples don't fill the channels")
    all_samples = np.frombuffer(samples, dtype=np.uint8)
    serial = zlib.crc32(samples)
    streams = []
    for c in range(channels):
        own = all_samples[c::channels].tobytes()
        packets = [(MAGIC + bytes([c, channels]), 0)]
        packets += [(own[i : i + PACKET], min(i + PACKET, len(own))) for i in range(0, len(own), PACKET)]
        streams.append(stream_pages((serial + c) & 0xFFFFFFFF, packets))
    longest = max(map(len, streams))
    return b"".join(s[i] for i in range(longest) for s in streams if i < len(s))


@dataclass
class Stream:
    packets: list[bytes]
    granules: list[int]
    open_packet: bytearray | None = None
    pages: int = 0
    ended: bool = False


def demultiplex(data: bytes) -> dict[int, Stream]:
    """The logical streams by serial number, each page's checksum, sequence number and continuation verified. Raises OggError."""
    streams: dict[int, Stream] = {}
    at = 0
    while at < len(data):
        if at + 27 > len(data):
            raise OggError("a page head is cut off")
        capture, version, flags, granule, serial, number, told, segments = _HEAD.unpack_from(data, at)
        if capture != b"OggS" or version:
            raise OggError(f"no page at byte {at}")
        lacing = data[at + 27 : at + 27 + segments]
        start = at + 27 + segments
        end = start + sum(lacing)
        if len(lacing) < segments or end > len(data):
            raise OggError("a page is cut off")
        whole = bytearray(data[at:end])
        whole[22:26] = b"\0\0\0\0"
        if checksum(bytes(whole)) != told:
            raise OggError(f"checksum of the page at byte {at}")
        if bool(flags & 2) != (serial not in streams):
            raise OggError("a stream begins twice or without its first page")
        s = streams.setdefault(serial, Stream([], []))
        if s.ended or number != s.pages or bool(flags & 1) != (s.open_packet is not None):
            raise OggError("a page is missing or out of order")
        s.pages += 1
        current = s.open_packet
        for v in lacing:
            current = bytearray() if current is None else current
            current += data[start : start + v]
            start += v
            if v < 255:
                s.packets.append(bytes(current))
                s.granules.append(-1)
                current = None
        s.open_packet = current
        if granule >= 0 and s.granules:
            s.granules[-1] = granule
        s.ended = bool(flags & 4)
        at = end
    if any(not s.ended or s.open_packet is not None for s in streams.values()):
        raise OggError("a stream has no last page")
    return streams


def times(stream: Stream, rate: int = RATE) -> list[float | None]:
    """The second at which each packet ends, by its granule position; None where its page ends later packets too."""
    return [None if g < 0 else g / rate for g in stream.granules]


def read(data: bytes) -> tuple[bytes, dict[int, Stream]]:
    """The samples of a clip that write() made, interleaved again, and its streams."""
    streams = demultiplex(data)
    channels: dict[int, bytes] = {}
    count = 0
    for s in streams.values():
        if not s.packets or s.packets[0][:6] != MAGIC or len(s.packets[0]) != 8:
            raise OggError("a stream isn't of 8-bit samples")
        channels[s.packets[0][6]] = b"".join(s.packets[1:])
        count = s.packets[0][7]
        if s.granules[-1] != len(channels[s.packets[0][6]]):
            raise OggError("the last granule position isn't the number of samples")
    if sorted(channels) != list(range(count)) or len(set(map(len, channels.values()))) > 1:
        raise OggError("a channel is missing or short")
    out = np.empty((len(channels[0]), count), dtype=np.uint8)
    for c, own in channels.items():
        out[:, c] = np.frombuffer(own, dtype=np.uint8)
    return out.tobytes(), streams


def payload(text: str | None) -> bytes:
    """UTF-8 and zeros up to a positive multiple of 64."""
    data = (text or "").encode()
    return data + bytes(-len(data) % 64 if data else 64)


def feature(samples: bytes, streams: dict[int, Stream]) -> str:
    """Figures of a clip as it was read back: streams, pages, packets, seconds, the mean sample and crossings of the middle (128)."""
    x = np.frombuffer(samples, dtype=np.uint8)
    seconds = max(t for s in streams.values() for t in times(s) if t is not None)
    high = x >= 128
    return f"streams={len(streams)};pages={sum(s.pages for s in streams.values())};packets={sum(len(s.packets) for s in streams.values())};seconds={seconds:.6f};mean={x.mean():.4f};crossings={int((high[1:] != high[:-1]).sum())}"


def media_column(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns in keep, `media` (binary, an Ogg clip of the column `text`) and `timestamps` (array of seconds at which the packets of the first channel end).

    Null and empty texts give a clip of 64 zeros, equal texts equal clips, and texts of any length one clip each.
    """

    def setup():
        def each(texts):
            clips = [write(payload(x)) for x in texts]
            return clips, [[t for t in times(next(iter(demultiplex(c).values()))) if t is not None] for c in clips]

        return each

    return map_texts(docs, setup, "media binary, timestamps array<double>", *keep)


def digest(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns in keep and figures of each text's clip after it was stored and read back; text as in media_column()."""

    def setup():
        from hashlib import sha256

        def one(text):
            stored = write(payload(text))
            back, streams = read(stored)
            return len((text or "").encode()), len(back), sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(stored), sha256(stored).hexdigest(), feature(back, streams)

        return lambda texts: list(zip(*map(one, texts)))

    return map_texts(docs, setup, "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string", *keep)
