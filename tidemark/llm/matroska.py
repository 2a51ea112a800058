"""Matroska files as packet tables.

A parser of EBML, the variable-length element format of Matroska: element ids
keep their length marker, sizes drop it, and a size of all ones is unknown (the
element then ends where an element of its parents' level begins, or with the
data).  Clusters, simple blocks and block groups, the three kinds of lacing
(Xiph, fixed, EBML) and cues are read into rows with times, tracks and byte
ranges; frames stay where they are, only their ranges are taken.

The writer stores a payload of whole 576-sample frames as 8-bit PCM, in
clusters of laced simple blocks with a cue for each cluster.  Media of equal
payloads are equal byte for byte: there are no dates and no random ids.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .session import id_text, new_path

#: Element ids, as they stand in the file (fixed values of the format).
EBML, VERSION, READ_VERSION, MAX_ID, MAX_SIZE, DOCTYPE, DOC_VERSION, DOC_READ = 0x1A45DFA3, 0x4286, 0x42F7, 0x42F2, 0x42F3, 0x4282, 0x4287, 0x4285
SEGMENT, INFO, SCALE, DURATION, MUXER, WRITER = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACKS, TRACK, NUMBER, UID, TYPE, LACING, CODEC, AUDIO, RATE, CHANNELS, DEPTH = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x9C, 0x86, 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, TIME, SIMPLE_BLOCK, GROUP, BLOCK, LENGTH = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1, 0x9B
CUES, CUE, CUE_TIME, CUE_PLACE, CUE_TRACK, CUE_CLUSTER = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
VOID, CRC = 0xEC, 0xBF
#: Elements that hold elements, and the level each stands at.
MASTERS = {EBML: 0, SEGMENT: 0, INFO: 1, TRACKS: 1, TRACK: 2, AUDIO: 3, CLUSTER: 1, GROUP: 2, CUES: 1, CUE: 2, CUE_PLACE: 3}
PCM = b"A_PCM/INT/LIT"
#: Samples (bytes) a frame, frames a laced block, blocks a cluster, samples a second.
FRAME, LACED, BLOCKS, HERTZ = 576, 8, 16, 8000
#: Nanoseconds of a tick; a frame lasts 72 ms.
TICK = 1_000_000


class Packet(NamedTuple):
    track: int
    time: int  # ticks; of frames after the first in a lace it is what the default duration gives, or the block's
    start: int
    end: int
    key: bool
    cluster: int
    lace: int


class Cue(NamedTuple):
    time: int
    track: int
    cluster: int


class Media(NamedTuple):
    doctype: str
    scale: int
    duration: float
    tracks: dict[int, dict]
    packets: list[Packet]
    cues: list[Cue]


def size_bytes(n: int) -> bytes:
    """The shortest size field for n (all ones means unknown and is not used)."""
    width = 1
    while n >= (1 << (7 * width)) - 1:
        width += 1
    return ((1 << (7 * width)) | n).to_bytes(width, "big")


def id_bytes(i: int) -> bytes:
    return i.to_bytes((i.bit_length() + 7) // 8, "big")


def element(i: int, body: bytes) -> bytes:
    return id_bytes(i) + size_bytes(len(body)) + body


def number(i: int, n: int) -> bytes:
    return element(i, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def read_vint(data, at: int, keep_marker: bool = False) -> tuple[int | None, int]:
    """(value, next place) of a variable-length integer; None for the unknown size."""
    first = data[at]
    if not first:
        raise ValueError(f"no variable-length integer at byte {at}")
    width = 9 - first.bit_length()
    if at + width > len(data):
        raise ValueError(f"variable-length integer cut off at byte {at}")
    value = int.from_bytes(data[at : at + width], "big")
    if keep_marker:
        return value, at + width
    value &= (1 << (7 * width)) - 1
    return (None if value == (1 << (7 * width)) - 1 else value), at + width


def elements(data, at: int, end: int, level: int) -> Iterator[tuple[int, int, int, int]]:
    """(id, place, body start, body end) of the elements between two places of a master at level - 1."""
    while at < end:
        i, body = read_vint(data, at, keep_marker=True)
        if level and MASTERS.get(i, 9) < level:
            return  # an element of a level above ends a master of unknown size
        size, body = read_vint(data, body)
        stop = end if size is None else body + size
        if stop > end:
            raise ValueError(f"element {i:#x} at byte {at} goes beyond its parent")
        if size is None:
            if i not in MASTERS:
                raise ValueError(f"element {i:#x} at byte {at} has no size")
            stop = _unknown_end(data, body, end, MASTERS[i] + 1)
        yield i, at, body, stop
        at = stop


def _unknown_end(data, at: int, end: int, level: int) -> int:
    while at < end:
        i, body = read_vint(data, at, keep_marker=True)
        if MASTERS.get(i, 9) < level:
            return at
        size, body = read_vint(data, body)
        at = body + size if size is not None else _unknown_end(data, body, end, MASTERS.get(i, level) + 1)
    return end


def _uint(data, a: int, b: int) -> int:
    return int.from_bytes(data[a:b], "big")


def _float(data, a: int, b: int) -> float:
    return {0: lambda _: 0.0, 4: lambda x: struct.unpack(">f", x)[0], 8: lambda x: struct.unpack(">d", x)[0]}[b - a](bytes(data[a:b]))


def lace_sizes(data, at: int, end: int, kind: int) -> tuple[list[int], int]:
    """Sizes of a block's frames, and where the first one starts.  kind: 0 none, 1 Xiph, 2 fixed, 3 EBML."""
    if not kind:
        return [end - at], at
    frames, at = data[at] + 1, at + 1
    if kind == 2:
        each, rest = divmod(end - at, frames)
        if rest:
            raise ValueError("fixed lacing does not divide the block")
        return [each] * frames, at
    sizes = []
    for n in range(frames - 1):
        if kind == 1:
            size = 0
            while True:
                byte, at = data[at], at + 1
                size += byte
                if byte != 255:
                    break
        else:
            before = at
            value, at = read_vint(data, at)
            size = value if not n else sizes[-1] + value - ((1 << (7 * (at - before) - 1)) - 1)
        sizes.append(size)
    last = end - at - sum(sizes)
    if last < 0 or min(sizes, default=0) < 0:
        raise ValueError("laced sizes go beyond the block")
    return [*sizes, last], at


def parse(data: bytes) -> Media:
    """Everything but the frames themselves.  Raises ValueError on what is not Matroska, or is cut off."""
    doctype, scale, duration, tracks, packets, cues = "", TICK, 0.0, {}, [], []
    data = memoryview(data)

    def block(a: int, b: int, base: int, cluster: int, keyed: bool | None) -> None:
        track, at = read_vint(data, a)
        relative, flags = struct.unpack(">hB", data[at : at + 3])
        sizes, at = lace_sizes(data, at + 3, b, (flags >> 1) & 3)
        step = tracks.get(track, {}).get("frame_ticks", 0)
        for n, size in enumerate(sizes):
            packets.append(Packet(track, base + relative + round(n * step), at, at + size, bool(flags & 0x80) if keyed is None else keyed, cluster, n))
            at += size

    try:
        top = list(elements(data, 0, len(data), 0))
        if not top or top[0][0] != EBML:
            raise ValueError("no EBML header")
        for i, _, a, b in top:
            if i == EBML:
                for j, _, c, d in elements(data, a, b, 1):
                    if j == DOCTYPE:
                        doctype = bytes(data[c:d]).rstrip(b"\0").decode("ascii")
            if i != SEGMENT:
                continue
            for j, place, c, d in elements(data, a, b, 1):
                if j == INFO:
                    for k, _, e, f in elements(data, c, d, 2):
                        if k == SCALE:
                            scale = _uint(data, e, f)
                        elif k == DURATION:
                            duration = _float(data, e, f)
                elif j == TRACKS:
                    for k, _, e, f in elements(data, c, d, 2):
                        if k == TRACK:
                            _track(data, e, f, tracks, scale)
                elif j == CLUSTER:
                    base = 0
                    for k, _, e, f in elements(data, c, d, 2):
                        if k == TIME:
                            base = _uint(data, e, f)
                        elif k == SIMPLE_BLOCK:
                            block(e, f, base, place, None)
                        elif k == GROUP:
                            inner = {x: (y, z) for x, _, y, z in elements(data, e, f, 3)}
                            if BLOCK in inner:
                                block(*inner[BLOCK], base, place, 0xFB not in inner)
                elif j == CUES:
                    for k, _, e, f in elements(data, c, d, 2):
                        if k == CUE:
                            time = 0
                            for x, _, y, z in elements(data, e, f, 3):
                                if x == CUE_TIME:
                                    time = _uint(data, y, z)
                                elif x == CUE_PLACE:
                                    at = {u: _uint(data, v, w) for u, _, v, w in elements(data, y, z, 4)}
                                    cues.append(Cue(time, at.get(CUE_TRACK, 0), a + at.get(CUE_CLUSTER, 0)))
    except (IndexError, struct.error) as error:
        raise ValueError(f"cut off: {error}") from error
    return Media(doctype, scale, duration, tracks, packets, cues)


def _track(data, a: int, b: int, tracks: dict, scale: int) -> None:
    track: dict = {"number": 0, "type": 0, "codec": "", "rate": 8000.0, "channels": 1, "depth": 0, "frame_ticks": 0.0}
    for k, _, e, f in elements(data, a, b, 3):
        if k == NUMBER:
            track["number"] = _uint(data, e, f)
        elif k == TYPE:
            track["type"] = _uint(data, e, f)
        elif k == CODEC:
            track["codec"] = bytes(data[e:f]).decode("ascii")
        elif k == 0x23E383:  # default duration of a frame, nanoseconds
            track["frame_ticks"] = _uint(data, e, f) / scale
        elif k == AUDIO:
            for x, _, y, z in elements(data, e, f, 4):
                if x == RATE:
                    track["rate"] = _float(data, y, z)
                elif x == CHANNELS:
                    track["channels"] = _uint(data, y, z)
                elif x == DEPTH:
                    track["depth"] = _uint(data, y, z)
    tracks[track["number"]] = track


def padded(data: bytes) -> bytes:
    """data and bytes 255 up to a positive multiple of FRAME."""
    return data + b"\xff" * (max(FRAME, -(-len(data) // FRAME) * FRAME) - len(data))


def write(payload: bytes) -> bytes:
    """A Matroska file of one 8-bit mono PCM track; payload must be whole frames, one at least."""
    frames, rest = divmod(len(payload), FRAME)
    if rest or not frames:
        raise ValueError("the payload is not whole frames")
    ticks = FRAME * 1_000_000_000 // HERTZ // TICK
    head = element(EBML, b"".join([number(VERSION, 1), number(READ_VERSION, 1), number(MAX_ID, 4), number(MAX_SIZE, 8), element(DOCTYPE, b"matroska"), number(DOC_VERSION, 4), number(DOC_READ, 2)]))
    info = element(INFO, number(SCALE, TICK) + element(DURATION, struct.pack(">d", float(frames * ticks))) + element(MUXER, b"tidemark") + element(WRITER, b"tidemark"))
    audio = element(AUDIO, element(RATE, struct.pack(">d", float(HERTZ))) + number(CHANNELS, 1) + number(DEPTH, 8))
    track = element(TRACK, number(NUMBER, 1) + number(UID, 1) + number(TYPE, 2) + number(LACING, 1) + number(0x23E383, ticks * TICK) + element(CODEC, PCM) + audio)
    body, cues = [info, element(TRACKS, track)], []
    at = sum(map(len, body))
    for first in range(0, frames, LACED * BLOCKS):
        time = first * ticks
        parts = [number(TIME, time)]
        for f in range(first, min(frames, first + LACED * BLOCKS), LACED):
            n = min(LACED, frames - f)
            flags = 0x80 | (0x04 if n > 1 else 0)
            parts.append(element(SIMPLE_BLOCK, b"\x81" + struct.pack(">hB", (f - first) * ticks, flags) + (bytes([n - 1]) if n > 1 else b"") + payload[f * FRAME : (f + n) * FRAME]))
        cluster = element(CLUSTER, b"".join(parts))
        cues.append(element(CUE, number(CUE_TIME, time) + element(CUE_PLACE, number(CUE_TRACK, 1) + number(CUE_CLUSTER, at))))
        body.append(cluster)
        at += len(cluster)
    body.append(element(CUES, b"".join(cues)))
    return head + element(SEGMENT, b"".join(body))


_PACKET = "track int, time_ns long, byte_start long, byte_end long, keyframe boolean, cluster_start long, lace int, cued boolean"
_PACKET_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.bool_()]


def with_packets(media: DataFrame, column: str = "media") -> DataFrame:
    """media with a column packets (an array, in file order) and cues (their number), read from the binary column.

    A packet has its track, time, byte range, cluster, place in its lace, and
    whether a cue names its cluster.  Null media have null packets; what is not
    Matroska raises.
    """
    names = [f.split()[0] for f in _PACKET.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in names]
            ends, cues, duration = [0], [], []
            for data in batch.column(column):
                m = parse(data.as_py()) if data.is_valid else None
                cued = {(c.track, c.cluster) for c in m.cues} if m else set()
                for p in m.packets if m else ():
                    for col, v in zip(cols, (p.track, p.time * m.scale, p.start, p.end, p.key, p.cluster, p.lace, (p.track, p.cluster) in cued)):
                        col.append(v)
                ends.append(len(cols[0]))
                cues.append(len(m.cues) if m else None)
                duration.append(round(m.duration * m.scale) if m else None)
            flat = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cols, _PACKET_TYPES)], names)
            packets = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, mask=pa.array([c is None for c in cues]))
            yield pa.record_batch([*batch.columns, packets, pa.array(cues, pa.int64()), pa.array(duration, pa.int64())], [*batch.schema.names, "packets", "cues", "duration_ns"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in media.schema)
    return media.mapInArrow(run, f"{fields}, packets array<struct<{_PACKET.replace(' ', ':').replace(',:', ',')}>>, cues long, duration_ns long")


def packet_table(media: DataFrame) -> DataFrame:
    """A row per packet of (media_id, media binary): media_id and the fields of with_packets.  Extra columns are ignored."""
    each = with_packets(media.select(F.col("media_id").cast("long"), F.col("media").cast("binary")))
    return each.select("media_id", F.explode("packets").alias("p")).select("media_id", "p.*")


_STORED = "doc_id long, n_bytes long, media binary"
_FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, packets long, clusters long, cues long, duration_ns long"


def encoded(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: every text as a Matroska file.  A null or empty text is one frame of padding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").cast(pa.binary())
            for i in range(0, batch.num_rows, 500):
                raw = [t.as_py() for t in texts.slice(i, 500)]
                yield pa.record_batch([ids.slice(i, 500), pa.array(map(len, raw), pa.int64()), pa.array([write(padded(r)) for r in raw], pa.binary())], ["doc_id", "n_bytes", "media"])

    return id_text(docs).mapInArrow(run, _STORED)


def stored(docs: DataFrame) -> DataFrame:
    """encoded(docs), written as a table to the shared folder and read back."""
    spark = docs.sparkSession
    path = new_path(spark, "media")
    encoded(docs).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(_STORED).parquet(path)


def features(media: DataFrame) -> DataFrame:
    """What the stored bytes of (doc_id, n_bytes, media) hold, read back through the byte ranges of their packets.

    feature: for each of the track's 8 equal time slices the mean sample, then
    packets:clusters, all of them whole numbers, comma-joined.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            rows, packets = [], batch.column("packets")
            ends = packets.offsets.to_numpy()
            flat = packets.values
            start, end, cluster = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("byte_start", "byte_end", "cluster_start"))
            for i, data in enumerate(batch.column("media")):
                data, some = data.as_py(), slice(ends[i], ends[i + 1])
                payload = b"".join([data[a:b] for a, b in zip(start[some].tolist(), end[some].tolist())])
                level = np.frombuffer(payload, np.uint8).reshape(8, -1).sum(axis=1, dtype=np.int64) * 8 // len(payload)
                count, clusters = int(ends[i + 1] - ends[i]), len(np.unique(cluster[some]))
                feature = ",".join(map(str, level.tolist())) + f",{count}:{clusters}"
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), feature, count, clusters))
            cols = list(zip(*rows)) if rows else [()] * 8
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.record_batch([batch.column("doc_id"), batch.column("n_bytes"), *[pa.array(c, t) for c, t in zip(cols, types)], batch.column("cues"), batch.column("duration_ns")], [f.split()[0] for f in _FEATURES.split(", ")])

    return with_packets(media).mapInArrow(run, _FEATURES)
