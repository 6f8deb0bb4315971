"""Media columns: payloads stored as MPEG transport streams and read back.

A stream is 188-byte packets: a program association table and a program map table, which come again every few units, and one
elementary stream in packetised (PES) units with a presentation time stamp each; every unit's first packet is a random-access
point and carries the program's clock reference. Reading takes any stream: tables may stand anywhere, repeat, span packets and
name several programs; it checks their CRC, sync bytes and each PID's continuity counter (packets without payload, permitted
duplicates and marked discontinuities allowed), reassembles the elementary packets and returns time stamps, clock and access points.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import cache, lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.llm.frames import lean
from cartorio.llm.text import chunks, utf8

# Fixed values of the transport stream format.
SYNC, PACKET, BODY, NULL_PID = 0x47, 188, 184, 0x1FFF
PMT_PID, STREAM_PID, PROGRAM, STREAM_TYPE, STREAM_ID = 0x100, 0x101, 1, 0x06, 0xBD
CRC_POLYNOMIAL = 0x04C11DB7
CLOCK = 90_000
#: Stream ids whose elementary packets have no further header.
BARE_IDS = {0xBC, 0xBE, 0xBF, 0xF0, 0xF1, 0xF2, 0xF8, 0xFF}

#: A full unit: 64 packets, of which the first has eight bytes of adaptation field, less 14 bytes of header. Tables come every few units.
UNIT_PACKETS, FIELD, PES_HEADER, TABLES_EVERY = 64, 8, 14, 8
UNIT = UNIT_PACKETS * BODY - FIELD - PES_HEADER
#: Ticks from unit to unit, and by how much the clock runs ahead of presentation.
TICKS, LEAD = CLOCK // 25, CLOCK // 10


@cache
def _crc_table() -> list[int]:
    out = []
    for byte in range(256):
        crc = byte << 24
        for _ in range(8):
            crc = ((crc << 1) ^ CRC_POLYNOMIAL if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
        out.append(crc)
    return out


def section_crc(data: bytes) -> int:
    """0 for a whole section with its CRC."""
    crc, table = 0xFFFFFFFF, _crc_table()
    for byte in data:
        crc = (crc << 8) & 0xFFFFFFFF ^ table[crc >> 24 ^ byte]
    return crc


def _table(pid: int, table_id: int, extension: int, body: bytes) -> bytes:
    length = 5 + len(body) + 4
    section = bytes([table_id, 0xB0 | length >> 8, length & 255, extension >> 8, extension & 255, 0xC1, 0, 0]) + body
    section += section_crc(section).to_bytes(4, "big")
    return (bytes([SYNC, 0x40 | pid >> 8, pid & 255, 0x10, 0]) + section).ljust(PACKET, b"\xff")


@cache
def program_tables() -> np.ndarray:
    pat = PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big")
    pmt = (0xE000 | STREAM_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([STREAM_TYPE]) + (0xE000 | STREAM_PID).to_bytes(2, "big") + b"\xf0\x00"
    return np.frombuffer(_table(0, 0, 1, pat) + _table(PMT_PID, 2, PROGRAM, pmt), np.uint8).reshape(2, PACKET)


def _stamp(pts: int) -> bytes:
    return bytes([0x21 | (pts >> 29) & 0x0E, (pts >> 22) & 255, 1 | (pts >> 14) & 0xFE, (pts >> 7) & 255, 1 | (pts << 1) & 0xFE])


def _clock(base: int) -> bytes:
    return (base << 15 | 0x3F << 9).to_bytes(6, "big")


def pack(payload: bytes) -> bytes:
    """A transport stream that carries the payload, one time stamp and clock reference for each unit of it."""
    units = []
    for k, at in enumerate(range(0, max(len(payload), 1), UNIT)):
        data = payload[at : at + UNIT]
        length = len(data) + PES_HEADER - 6
        units.append(b"\0\0\1" + bytes([STREAM_ID]) + length.to_bytes(2, "big") + b"\x84\x80\x05" + _stamp(LEAD + k * TICKS) + data)
    sizes = np.array([len(u) for u in units])
    packets = (sizes + FIELD + BODY - 1) // BODY
    total = int(packets.sum())
    out = np.full((total, PACKET), 0xFF, np.uint8)
    first = np.zeros(total, bool)
    first[np.cumsum(packets) - packets] = True
    out[:, 0] = SYNC
    out[:, 1] = STREAM_PID >> 8 | np.where(first, 0x40, 0)
    out[:, 2] = STREAM_PID & 255
    counter = (np.arange(total) % 16).astype(np.uint8)
    # Stuffing is needed in the last unit's last packet only: all units before are full.
    spare = int(packets[-1]) * BODY - FIELD - int(sizes[-1])
    field = np.where(first, FIELD, 0)
    field[-1] += spare
    out[:, 3] = np.where(field > 0, 0x30, 0x10) | counter
    out[field > 0, 4] = field[field > 0] - 1
    flags = field > 1
    out[flags, 5] = np.where(first[flags], 0x50, 0)
    out[first, 6:12] = np.frombuffer(b"".join(_clock(k * TICKS) for k in range(len(units))), np.uint8).reshape(-1, 6)
    body = np.arange(PACKET) >= (4 + field)[:, None]
    out[body] = np.frombuffer(b"".join(units), np.uint8)
    # Tables before the first unit and then every few.
    often = -(-len(units) // TABLES_EVERY)
    tables = np.tile(program_tables(), (often, 1))
    tables[:, 3] |= (np.repeat(np.arange(often), 2) % 16).astype(np.uint8)
    at = np.repeat((np.cumsum(packets) - packets)[::TABLES_EVERY], 2)
    return np.insert(out, at, tables, axis=0).tobytes()


class Stream(NamedTuple):
    """An elementary stream: its payload, time stamps, packet numbers of random-access points, and clock references."""

    payload: bytes
    stamps: list[int]
    points: list[int]
    clocks: list[int]


class Packets:
    """The packets of a stream, checked: `bodies` start at `begin`, and `good` leaves out permitted duplicates."""

    def __init__(self, media: bytes):
        one, = checked([media])
        self.__dict__ = one.__dict__

    def of(self, pid: int) -> np.ndarray:
        """Numbers of the packets with payload of a PID."""
        return np.flatnonzero((self.pid == pid) & self.good & self.carries)

    def sections(self, pid: int) -> Iterator[bytes]:
        """Whole sections of a table PID, wherever they start and end."""
        held, inside = b"", False
        for k in self.of(pid):
            body = self.data[k, self.begin[k] :].tobytes()
            parts = [body]
            if self.starts[k]:
                skip = 1 + (body[0] if body else 0)
                parts = [body[1:skip], body[skip:]]
            for i, part in enumerate(parts):
                if i == len(parts) - 1 and self.starts[k]:
                    held, inside = b"", True
                if not inside:
                    continue
                held += part
                while len(held) >= 3 and held[0] != 0xFF and len(held) >= (size := 3 + ((held[1] & 15) << 8 | held[2])):
                    yield held[:size]
                    held = held[size:]


def checked(streams: list[bytes]) -> list[Packets]:
    """The packets of each stream, looked at all together; ValueError if one is damaged."""
    sizes = np.array([len(m) // PACKET for m in streams], np.int64)
    if any(len(m) % PACKET for m in streams):
        raise ValueError("not whole packets")
    p = np.frombuffer(b"".join(streams), np.uint8).reshape(-1, PACKET)
    if (p[:, 0] != SYNC).any():
        raise ValueError("sync byte missing")
    control = p[:, 3] >> 4
    if (p[:, 1] & 0x80).any() or (control & 12).any() or not control.all():
        raise ValueError("packets marked as damaged, scrambled or reserved")
    pid = (p[:, 1].astype(np.int32) & 0x1F) << 8 | p[:, 2]
    starts, carries = (p[:, 1] & 0x40) > 0, (control & 1) > 0
    field = np.where((control & 2) > 0, 1 + p[:, 4].astype(np.int32), 0)
    if (field > BODY).any():
        raise ValueError("adaptation field too long")
    begin, flags = 4 + field, np.where(field > 1, p[:, 5], 0)
    good = pid != NULL_PID
    # Of one stream and PID: with payload the counter goes up by one, without it stays; a packet may come twice.
    group = np.repeat(np.arange(len(streams), dtype=np.int64), sizes) << 13 | pid
    own = np.flatnonzero(good)
    own = own[np.argsort(group[own], kind="stable")]
    within = group[own[1:]] == group[own[:-1]]
    step = np.diff((p[own, 3] & 15).astype(np.int16)) % 16
    twice = np.flatnonzero(within & (step == 0) & carries[own[1:]] & carries[own[:-1]])
    same = p[own[twice]] == p[own[twice + 1]]
    same[:, 6:12] |= ((flags[own[twice]] & 0x10) > 0)[:, None]
    twice = twice[same.all(1)]
    wrong = within & (step != carries[own[1:]]) & ((flags[own[1:]] & 0x80) == 0)
    wrong[twice] = False
    if wrong.any() or (np.diff(twice) == 1).any():
        raise ValueError("continuity counter jumps")
    good[own[twice + 1]] = False
    out, lo = [], 0
    for n in sizes.tolist():
        one = Packets.__new__(Packets)
        one.data, one.pid, one.starts, one.carries, one.begin, one.flags, one.good = (a[lo : lo + n] for a in (p, pid, starts, carries, begin, flags, good))
        out.append(one)
        lo += n
    return out


@lru_cache(1024)
def _checked(section: bytes) -> bytes:
    """The body of a section whose CRC is right."""
    if len(section) < 12 or section_crc(section):
        raise ValueError("section damaged")
    return section[8:-4]


def programs(packets: Packets) -> dict[int, list[tuple[int, int]]]:
    """(pid, stream type) of the elementary streams of each program, as the current tables have them."""
    places: dict[int, int] = {}
    for s in packets.sections(0):
        body = _checked(s)
        if s[0] == 0 and s[5] & 1:
            places |= {n: (body[i + 2] & 0x1F) << 8 | body[i + 3] for i in range(0, len(body) - 3, 4) if (n := body[i] << 8 | body[i + 1])}
    out: dict[int, list[tuple[int, int]]] = {}
    for number, pid in places.items():
        for s in packets.sections(pid):
            body = _checked(s)
            if s[0] == 2 and s[5] & 1 and s[3] << 8 | s[4] == number:
                i, streams = 4 + ((body[2] & 15) << 8 | body[3]), []
                while i + 5 <= len(body):
                    streams.append(((body[i + 1] & 0x1F) << 8 | body[i + 2], body[i]))
                    i += 5 + ((body[i + 3] & 15) << 8 | body[i + 4])
                out[number] = streams
    if not out:
        raise ValueError("no program in the tables")
    return out


def unpack(media: bytes | Packets, program: int | None = None, pid: int | None = None) -> Stream:
    """The elementary stream of a PID, by default the first one of a program (the lowest) that has private data like pack()'s, or
    else its first; ValueError if the stream is damaged."""
    packets = media if isinstance(media, Packets) else Packets(media)
    known = programs(packets)
    if pid is None:
        streams = known[min(known) if program is None else program]
        pid = next((p for p, kind in streams if kind == STREAM_TYPE), streams[0][0] if streams else -1)
    own = packets.of(pid)
    if not len(own) or not packets.starts[own[0]]:
        raise ValueError("the elementary stream does not start")
    p, begin, flags = packets.data[own], packets.begin[own], packets.flags[own]
    data = p[np.arange(PACKET) >= begin[:, None]].tobytes()
    begins = (np.cumsum(PACKET - begin) - (PACKET - begin))[packets.starts[own]].tolist()
    payload, stamps = [], []
    for at, to in zip(begins, [*begins[1:], len(data)], strict=True):
        h = data[at : at + PES_HEADER]
        length = h[4] << 8 | h[5] if len(h) > 8 else 0
        if h[:3] != b"\0\0\1" or length and 6 + length != to - at:
            raise ValueError("elementary packet damaged")
        bare = h[3] in BARE_IDS
        if not bare and h[7] & 0x80:
            stamps.append((h[9] & 0x0E) << 29 | h[10] << 22 | (h[11] & 0xFE) << 14 | h[12] << 7 | h[13] >> 1)
        payload.append(data[at + (6 if bare else 9 + h[8]) : to])
    clock = p[(flags & 0x10) > 0, 6:12].astype(np.int64) @ (1 << np.arange(40, -1, -8)) >> 15
    return Stream(b"".join(payload), stamps, own[(flags & 0x40) > 0].tolist(), clock.tolist())


def padded(text: bytes) -> bytes:
    """Zero bytes up to a positive multiple of 64."""
    return text.ljust(max(64, -(-len(text) // 64) * 64), b"\0")


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media): each whole text, however long, as a transport stream; null texts are empty ones, and equal texts have
    equal streams. Null and repeated ids stay; no rows give none. Only the two named columns are read."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = utf8(b.column(1))
            for lo, hi in chunks(offsets):
                media = [pack(padded(data[offsets[i] : offsets[i + 1]].tobytes())) for i in range(lo, hi)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(np.diff(offsets[lo : hi + 1])), pa.array(media, pa.binary())], ["id", "n_bytes", "media"])

    kind = docs.schema[id_col].dataType.simpleString()
    return lean(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        write, f"id {kind}, n_bytes long, media binary").withColumnRenamed("id", id_col)


def features(stream: Stream) -> str:
    payload, stamps, points, clocks = stream
    counts = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    return (f"units={len(stamps)};last_pts={stamps[-1]};points={len(points)};last_clock={clocks[-1]};distinct={int((counts > 0).sum())};"
            f"peak={int(counts.argmax())};sum={int(counts @ np.arange(256))}")


def read_back(stored: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """From store(): digests of the stored form and of the payload read from it, and features of the latter. A row for each
    stored one; a damaged stream fails the job, so nothing is lost unseen."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, every = [], b.column(2).to_pylist()
            ends = np.r_[0, np.cumsum([len(m) for m in every], dtype=np.int64)]
            packets = (p for lo, hi in chunks(ends) for p in checked(every[lo:hi]))
            for raw, one in zip(every, packets, strict=True):
                stream = unpack(one)
                payload, stamps, points, _ = stream
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(raw),
                             hashlib.sha256(raw).hexdigest(), features(stream), stamps, points))
            cols = list(zip(*rows, strict=True)) or [[]] * 8
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                                             ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "pts", "access_points"])

    kind = stored.schema[id_col].dataType.simpleString()
    return stored.select(F.col(id_col).alias("id"), "n_bytes", "media").mapInArrow(
        read, f"id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, pts array<long>, access_points array<long>"
    ).withColumnRenamed("id", id_col)
