"""Media columns: Matroska files as binary cells, parsed into packet tables.

Parsing follows variable-length EBML elements down through Segment, Tracks, Cues and Clusters, undoes block lacing
(none, Xiph, EBML, fixed size) and yields one row per packet with track, timestamp and byte range in the file.
Writing gives a small lossless file: one 8-bit mono PCM track, clusters with laced blocks, and a cue per cluster.
Work is per cell inside tasks, so Spark spreads files over them; a cell is never split.

Clusters and segments of unknown size, as live writers leave them, end where an element follows that cannot stand in
them. The frames of a laced block follow each other by their track's default duration; without one they share the
block's time.

Defined results: null text is empty; an empty payload is one unit of zero bytes; a cell that is null or damaged gives
no packets, and its row of features has the feature `damaged` and nulls for its payload (the rest of the column goes
on); repeated rows are handled separately; files of any length are read whole; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from .common import small_batches, with_computed

# Element ids of the format.
EBML, SEGMENT, INFO, TRACKS, TRACK, CUES, CLUSTER = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x1654AE6B, 0xAE, 0x1C53BB6B, 0x1F43B675
DOC_TYPE, SCALE, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC, AUDIO, RATE, CHANNELS, DEPTH = 0x4282, 0x2AD7B1, 0xD7, 0x73C5, 0x83, 0x86, 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER_TIME, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK = 0xE7, 0xA3, 0xA0, 0xA1
CUE_POINT, CUE_TIME, CUE_TRACKS, CUE_TRACK, CUE_CLUSTER = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
DEFAULT_DURATION, SEEK_HEAD, CHAPTERS, TAGS, ATTACHMENTS = 0x23E383, 0x114D9B74, 0x1043A770, 0x1254C367, 0x1941A469
#: Elements of a segment: any of them ends a cluster of unknown size.
OF_SEGMENT = {INFO, TRACKS, CUES, CLUSTER, SEEK_HEAD, CHAPTERS, TAGS, ATTACHMENTS}
PARENTS = {SEGMENT, INFO, TRACKS, TRACK, AUDIO, CUES, CLUSTER, BLOCK_GROUP, CUE_POINT, CUE_TRACKS}
#: Payload unit; sample rate; bytes of a frame, frames of a laced block and blocks of a cluster when writing.
UNIT, SAMPLE_RATE, FRAME, LACED, BLOCKS = 64, 8000, 800, 8, 16
NO_LACING, XIPH, FIXED, EBML_LACING = 0, 1, 2, 3
PACKETS = "doc_id {key}, packet int, track int, cluster int, timestamp_ms long, lacing int, keyframe boolean, start long, end long, cued boolean"


def vint(n: int) -> bytes:
    """n as a variable-length size of the fewest bytes."""
    k = 1
    while n >= (1 << 7 * k) - 1:
        k += 1
    return (n | 1 << 7 * k).to_bytes(k, "big")


def element(kind: int, body: bytes) -> bytes:
    return kind.to_bytes((kind.bit_length() + 7) // 8, "big") + vint(len(body)) + body


def number(n: int) -> bytes:
    return n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big")


def read_vint(data: bytes, at: int, marker: bool = False) -> tuple[int, int, int]:
    """(value, next place, bytes); marker: keep the length marker, as in ids."""
    n = 9 - data[at].bit_length()
    if n > 8 or at + n > len(data):
        raise ValueError("damaged variable-length number")
    v = int.from_bytes(data[at : at + n], "big")
    return v if marker else v & (1 << 7 * n) - 1, at + n, n


def walk(data: bytes) -> Iterator[tuple[int, int, int, int]]:
    """(id, start, body start, body end) of all elements of a file in order, parents before what they hold."""
    at, ends = 0, [(len(data), 0, True)]  # of the open parents: end, id, whether the size is known
    while at < len(data):
        while at >= ends[-1][0] and len(ends) > 1:
            ends.pop()
        kind, body, _ = read_vint(data, at, marker=True)
        n, body, k = read_vint(data, body)
        while not ends[-1][2] and (kind in OF_SEGMENT if ends[-1][1] == CLUSTER else kind in (EBML, SEGMENT)):
            ends.pop()
        end, _, _ = ends[-1]
        known = n != (1 << 7 * k) - 1
        if not known and kind not in (SEGMENT, CLUSTER):
            raise ValueError("element of unknown size")
        stop = body + n if known else end
        if stop > end:
            raise ValueError("element reaches beyond its parent")
        yield kind, at, body, stop
        if kind in PARENTS:
            ends.append((stop, kind, known))
            at = body
        else:
            at = stop


def laced(frames: list[bytes], how: int) -> bytes:
    """A block's lacing header and frames."""
    if how == NO_LACING:
        return frames[0]
    sizes, head = [len(x) for x in frames], bytes([len(frames) - 1])
    if how == XIPH:
        head += b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    elif how == EBML_LACING:
        head += vint(sizes[0])
        for a, b in zip(sizes, sizes[1:-1], strict=False):
            k = next(k for k in range(1, 9) if abs(b - a) < (1 << 7 * k - 1))
            head += (b - a + (1 << 7 * k - 1) - 1 | 1 << 7 * k).to_bytes(k, "big")
    return head + b"".join(frames)


def unlaced(data: bytes, at: int, end: int, how: int) -> list[tuple[int, int]]:
    """Byte ranges of a block's frames."""
    if how == NO_LACING:
        return [(at, end)]
    n, at, sizes = data[at] + 1, at + 1, []
    if how == FIXED:
        sizes = [(end - at) // n] * (n - 1)
    elif how == XIPH:
        for _ in range(n - 1):
            size = 0
            while data[at] == 255:
                size, at = size + 255, at + 1
            sizes.append(size + data[at])
            at += 1
    else:
        for i in range(n - 1):
            v, at, k = read_vint(data, at)
            sizes.append(v if i == 0 else sizes[-1] + v - ((1 << 7 * k - 1) - 1))
    out = []
    for size in sizes:
        out.append((at, at + size))
        at += size
    if at > end or min(sizes, default=0) < 0:
        raise ValueError("damaged lacing")
    return [*out, (at, end)]


def mux(payload: bytes) -> bytes:
    """A Matroska file of one PCM track whose packets, joined, are the payload."""
    frames = [payload[i : i + FRAME] for i in range(0, len(payload), FRAME)]
    clusters, times = [], []
    for c in range(0, len(frames), LACED * BLOCKS):
        body = element(CLUSTER_TIME, number(c * FRAME * 1000 // SAMPLE_RATE))
        times.append(c * FRAME * 1000 // SAMPLE_RATE)
        for b in range(c, min(len(frames), c + LACED * BLOCKS), LACED):
            group = frames[b : b + LACED]
            how = NO_LACING if len(group) == 1 else FIXED if len({*map(len, group)}) == 1 else (EBML_LACING, XIPH)[b // LACED % 2]
            head = vint(1) + ((b - c) * FRAME * 1000 // SAMPLE_RATE).to_bytes(2, "big") + bytes([0x80 | how << 1])
            body += element(SIMPLE_BLOCK, head + laced(group, how))
        clusters.append(element(CLUSTER, body))
    info = element(INFO, element(SCALE, number(1_000_000)))
    audio = element(AUDIO, element(RATE, b"\x45\xfa\x00\x00") + element(CHANNELS, b"\x01") + element(DEPTH, b"\x08"))
    tracks = element(TRACKS, element(TRACK, element(TRACK_NUMBER, b"\x01") + element(TRACK_UID, b"\x01") + element(TRACK_TYPE, b"\x02") + element(DEFAULT_DURATION, number(FRAME * 1_000_000_000 // SAMPLE_RATE)) + element(CODEC, b"A_PCM/INT/LIT") + audio))
    # cues stand after the clusters, whose places are then known
    at, cues = len(info) + len(tracks), b""
    for t, c in zip(times, clusters, strict=True):
        cues += element(CUE_POINT, element(CUE_TIME, number(t)) + element(CUE_TRACKS, element(CUE_TRACK, b"\x01") + element(CUE_CLUSTER, number(at))))
        at += len(c)
    return element(EBML, element(DOC_TYPE, b"matroska")) + element(SEGMENT, info + tracks + b"".join(clusters) + element(CUES, cues))


def packets(data: bytes) -> list[tuple]:
    """(track, cluster, timestamp_ms, lacing, keyframe, start, end, cued) of each packet in file order."""
    found, cued, starts, durations = [], set(), [], {}
    scale, base, segment, track, duration = 1_000_000, 0, 0, None, None
    for kind, start, body, stop in walk(data):
        if kind == SEGMENT:
            segment = body
        elif kind == CLUSTER:
            starts.append(start - segment)
        elif kind == TRACK:
            track = duration = None
        elif kind in (SCALE, CLUSTER_TIME, CUE_CLUSTER, TRACK_NUMBER, DEFAULT_DURATION):
            value = int.from_bytes(data[body:stop], "big")
            if kind == SCALE:
                scale = value
            elif kind == CLUSTER_TIME:
                base = value
            elif kind == CUE_CLUSTER:
                cued.add(value)
            else:
                track, duration = (value, duration) if kind == TRACK_NUMBER else (track, value)
                if track is not None and duration is not None:
                    durations[track] = duration
        elif kind in (SIMPLE_BLOCK, BLOCK):
            number_, head, _ = read_vint(data, body)
            if head + 3 > stop:
                raise ValueError("damaged block")
            time, flags = int.from_bytes(data[head : head + 2], "big", signed=True), data[head + 2]
            how, each = flags >> 1 & 3, durations.get(number_, 0)
            for i, (a, b) in enumerate(unlaced(data, head + 3, stop, how)):
                found.append((number_, len(starts) - 1, ((base + time) * scale + i * each) // 1_000_000, how, kind == SIMPLE_BLOCK and flags >= 0x80, a, b))
    return [(*p, starts[p[1]] in cued if p[1] >= 0 else False) for p in found]


def payload_of(text: str | None) -> tuple[bytes, int]:
    """UTF-8 of a text filled with zero bytes up to a positive multiple of UNIT, and its own length."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(-len(raw) % UNIT if raw else UNIT), len(raw)


def media_column(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, media: each text stored as a Matroska file."""

    def make():
        return lambda texts: {"n_bytes": [n for _, n in p], "media": [mux(x) for x, _ in p]} if (p := [*map(payload_of, texts)]) else {"n_bytes": [], "media": []}

    return with_computed(docs.selectExpr(f"`{key}` AS doc_id", f"`{text}` AS text"), "text", make, {"n_bytes": "long", "media": "binary"})


def packet_table(media: DataFrame, column: str = "media", key: str = "doc_id") -> DataFrame:
    """One row per packet of a column of Matroska files: its track, cluster, time, lacing and byte range."""
    small_batches(media.sparkSession)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc_id", "packet", "track", "cluster", "timestamp_ms", "lacing", "keyframe", "start", "end", "cued"]
        for x in batches:
            out = []
            for k, data in zip(x["doc_id"], x["media"], strict=True):
                try:
                    out += [(k, i, *p) for i, p in enumerate(packets(bytes(data or b"")))]
                except (ValueError, IndexError):
                    continue
            yield pd.DataFrame(out, columns=names)

    return media.selectExpr(f"`{key}` AS doc_id", f"`{column}` AS media").mapInPandas(rows, PACKETS.format(key=dict(media.dtypes)[key]))


def media_features(media: DataFrame, column: str = "media", key: str = "doc_id") -> DataFrame:
    """Per file: doc_id, n_bytes, payload (bytes of all packets read back): size, SHA-256, CRC-32 of the last UNIT; the
    file's size and SHA-256; feature (packets, clusters, cued clusters, tracks, last timestamp, lacing kinds, mean sample;
    `damaged` for a cell that is null or no whole file)."""

    def row(data: bytes | None) -> tuple:
        try:
            got = packets(data or b"\x00")
        except (ValueError, IndexError):
            file = (None, None) if data is None else (len(data), hashlib.sha256(data).hexdigest())
            return None, None, None, *file, "damaged"
        payload = b"".join([data[p[5] : p[6]] for p in got])
        kinds = "".join(str(k) for k in sorted({p[3] for p in got}))
        cued = len({p[1] for p in got if p[7]})
        feature = f"packets={len(got)};clusters={len({p[1] for p in got})};cued={cued};tracks={len({p[0] for p in got})};last_ms={got[-1][2] if got else 0};lacing={kinds};mean={sum(payload) / max(1, len(payload)):.4f}"
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(data), hashlib.sha256(data).hexdigest(), feature

    fields = {"payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long", "media_sha256": "string", "feature": "string"}

    def make():
        return lambda cells: {f: [r[i] for r in rows] for rows in [[row(m) for m in cells]] for i, f in enumerate(fields)}

    slim = media.selectExpr(f"`{key}` AS doc_id", "n_bytes", f"`{column}` AS media")
    return with_computed(slim, "media", make, fields)
