"""Ogg: pages with checksums, lacing, multiplexed logical streams and granule positions.

``store_as_ogg`` keeps each text as a physical Ogg stream of two logical streams and reads it back. ``read_ogg`` reads
media from elsewhere: a stream that does not follow the format, or whose checksums are wrong, gives its error, and the
other rows their packets.

A page's granule position is where the last packet that ends on it ends; the packets before it on the page end where
the next one begins. So each packet has its times, once its page has ended.

Edge cases: a null or empty text is one block of padding, and null media have no packets; a null doc_id is carried
along; repeated rows give repeated rows; very long texts have as many pages as they need; an empty table gives an empty
table; other columns, whatever their names, are left out.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK, FILL, RATE = 192, b"\x20", 8000
#: Fixed values of the format: capture pattern, header layout, flags.
CAPTURE, HEADER, CONTINUED, FIRST, LAST = b"OggS", struct.Struct("<4sBBqIIIB"), 1, 2, 4
_REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))
#: Serial numbers of the two logical streams of a stored text: its even and its odd packets.
SERIALS = (1, 2)
PACKET = 6 * BLOCK  # of several lacing values, so packets cross pages
NO_GRANULE = -1


class OggError(ValueError):
    """A page or packet that does not follow the format."""


def checksum(page: bytes) -> int:
    """CRC with polynomial 0x04c11db7, not reflected, start 0: zlib's over bit-reversed bytes, bit-reversed."""
    x = zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(x.to_bytes(4, "little").translate(_REVERSED), "big")


@dataclass
class Packet:
    serial: int
    data: bytes
    granule: int | None
    index: int
    page: int = 0  # of its stream, where the packet ends


@dataclass(frozen=True)
class Timed:
    """A packet and the samples of its stream at which it starts and ends."""

    packet: Packet
    start: int
    end: int


@dataclass
class _Open:
    sequence: int = 0
    parts: list[bytes] = field(default_factory=list)
    packets: int = 0
    ended: bool = False


def _page(serial: int, sequence: int, flags: int, granule: int, lacing: bytes, body: bytes) -> bytes:
    head = HEADER.pack(CAPTURE, 0, flags, granule, serial, sequence, 0, len(lacing)) + lacing
    return head[:22] + struct.pack("<I", checksum(head + body)) + head[26:] + body


def pages_of(serial: int, packets: list[bytes], granules: list[int]) -> Iterator[tuple[int, bytes]]:
    """The pages of one logical stream, each with the index of the last packet begun in it."""
    lacing, body, sequence, done, flags = bytearray(), bytearray(), 0, NO_GRANULE, FIRST
    for k, data in enumerate(packets):
        left, at = [255] * (len(data) // 255) + [len(data) % 255], 0
        for i, value in enumerate(left):
            if len(lacing) == 255:
                yield k, _page(serial, sequence, flags, done, bytes(lacing), bytes(body))
                sequence, done, flags = sequence + 1, NO_GRANULE, CONTINUED if i else 0
                lacing.clear()
                body.clear()
            lacing.append(value)
            body += data[at : at + value]
            at += value
        done = granules[k]
    yield len(packets), _page(serial, sequence, flags | LAST, done, bytes(lacing), bytes(body))


def write(streams: dict[int, tuple[list[bytes], list[int]]]) -> bytes:
    """A physical stream: every logical stream's first page, then the rest interleaved by packet."""
    own = [list(pages_of(serial, *x)) for serial, x in streams.items()]
    rest = sorted((k, s, i) for s, pages in enumerate(own) for i, (k, _) in enumerate(pages) if i)
    return b"".join([x[0][1] for x in own] + [own[s][i][1] for _, s, i in rest])


def read(data: bytes) -> Iterator[Packet]:
    """Packets in the order in which they end; every page's checksum, sequence number and flags are verified."""
    streams: dict[int, _Open] = {}
    at = 0
    while at < len(data):
        if data[at : at + 4] != CAPTURE or at + 27 > len(data):
            raise OggError(f"no page at byte {at}")
        _, version, flags, granule, serial, sequence, crc, n = HEADER.unpack_from(data, at)
        lacing = data[at + 27 : at + 27 + n]
        end = at + 27 + n + sum(lacing)
        if version or len(lacing) < n or end > len(data):
            raise OggError(f"bad page at byte {at}")
        if checksum(data[at : at + 22] + b"\0\0\0\0" + data[at + 26 : end]) != crc:
            raise OggError(f"wrong checksum at byte {at}")
        if (serial not in streams) != bool(flags & FIRST):
            raise OggError(f"stream {serial} begins wrongly at byte {at}")
        s = streams.setdefault(serial, _Open())
        if s.ended or sequence != s.sequence or bool(flags & CONTINUED) != bool(s.parts):
            raise OggError(f"page out of order at byte {at}")
        s.sequence += 1
        body, ends = at + 27 + n, [i for i, x in enumerate(lacing) if x < 255]
        start = 0
        for i in ends:
            size = sum(lacing[start : i + 1])
            s.parts.append(data[body : body + size])
            body, start = body + size, i + 1
            yield Packet(serial, b"".join(s.parts), granule if i == ends[-1] else None, s.packets, sequence)
            s.packets += 1
            s.parts = []
        if start < n:
            s.parts.append(data[body:end])
        s.ended = bool(flags & LAST)
        at = end
    for serial, s in streams.items():
        if s.parts or not s.ended:
            raise OggError(f"stream {serial} ends early")


def timed(packets: Iterable[Packet], samples: Callable[[bytes], int] = len) -> Iterator[Timed]:
    """Packets with their times, from the granule positions of the pages; samples tells a packet's length."""
    waiting: dict[int, list[Packet]] = {}
    for p in packets:
        waiting.setdefault(p.serial, []).append(p)
        if p.granule is not None and p.granule != NO_GRANULE:
            mine = waiting.pop(p.serial)
            ends = [p.granule]
            for later in reversed(mine[1:]):
                ends.append(ends[-1] - samples(later.data))
            for q, end in zip(mine, reversed(ends), strict=True):
                yield Timed(q, end - samples(q.data), end)
    if waiting:
        raise OggError(f"no granule position for the last packets of streams {sorted(waiting)}")


def store(payload: bytes) -> bytes:
    """The payload's packets in turn to two logical streams; granule positions count samples (bytes) of the stream."""
    packets = [payload[i : i + PACKET] for i in range(0, len(payload), PACKET)]
    streams = {}
    for k, serial in enumerate(SERIALS):
        mine, granules, total = packets[k :: len(SERIALS)], [], 0
        for x in mine:
            total += len(x)
            granules.append(total)
        if mine:
            streams[serial] = (mine, granules)
    return write(streams)


def load(media: bytes) -> tuple[bytes, str]:
    """The payload, and features: streams, pages, packets, samples, length in ms, mean sample, how often the samples cross it."""
    by: dict[int, list[Timed]] = {}
    for t in timed(read(media)):
        mine = by.setdefault(t.packet.serial, [])
        if t.start != (mine[-1].end if mine else 0):
            raise OggError("granule positions do not match the samples")
        mine.append(t)
    order = sorted(by)
    count, pages = sum(map(len, by.values())), sum(x[-1].packet.page + 1 for x in by.values())
    payload = b"".join(by[order[i % len(order)]][i // len(order)].packet.data for i in range(count))
    samples = np.frombuffer(payload, np.uint8)
    total, n = int(samples.sum(dtype=np.int64)), len(samples)
    above = samples.astype(np.int64) * n > total
    crossings = int((above[1:] != above[:-1]).sum())
    ms = max(x[-1].end for x in by.values()) * 1000 // RATE
    return payload, f"ogg;streams={len(by)};pages={pages};packets={count};samples={n};ms={ms};mean={total * 1000 // n};crossings={crossings}"


def _outside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("serial", pa.int64()), ("index", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("data", pa.binary())]))
    for batch in batches:
        for at in range(0, len(batch), 64):
            part = batch.slice(at, 64)
            packets, errors = [], []
            for media in part.column(1).to_pylist():
                try:
                    packets.append([{"serial": t.packet.serial, "index": t.packet.index, "start": t.start, "end": t.end, "data": t.packet.data} for t in timed(read(media or b""))])
                    errors.append(None)
                except OggError as e:
                    packets.append(None)
                    errors.append(str(e))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packets, kind), pa.array(errors, pa.string())], ["doc_id", "packets", "error"])


def read_ogg(rows: DataFrame, media: str = "media", key: str = "doc_id") -> DataFrame:
    """Per row: doc_id, packets (serial, index, start and end in samples, data; null for a bad stream), error (null for a good one)."""
    kind = "doc_id long, packets array<struct<serial: long, index: long, start: long, end: long, data: binary>>, error string"
    return rows.select(F.col(key).cast("long").alias("doc_id"), F.col(media).cast("binary").alias("media")).mapInArrow(_outside, kind)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 256):  # what is stored is larger than the text
            part = batch.slice(at, 256)
            out = {k: [] for k in ("n_bytes", "payload", "media", "feature")}
            for x in part.column(1).to_pylist():
                raw = x or b""
                payload = raw + FILL * (-len(raw) % BLOCK or (0 if raw else BLOCK))
                media = store(payload)
                back, feature = load(media)
                for k, v in zip(out, (len(raw), back, media, feature), strict=True):
                    out[k].append(v)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out["n_bytes"], pa.int64()), pa.array(out["payload"], pa.binary()), pa.array(out["media"], pa.binary()), pa.array(out["feature"], pa.string())], ["doc_id", "n_bytes", "payload", "media", "feature"])


def store_as_ogg(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_bytes, payload (read back), media (the Ogg file), feature."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("raw")).mapInArrow(_rows, "doc_id long, n_bytes long, payload binary, media binary, feature string")


def op3_ogg_media(spark, sf_dir: str) -> DataFrame:
    made = store_as_ogg(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    n = F.octet_length("payload")
    return made.select("doc_id", "n_bytes", n.cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(F.substring("payload", -16, 16)).alias("tail_crc32"), F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "feature")
