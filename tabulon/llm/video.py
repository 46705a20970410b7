"""Motion-JPEG clips in AVI files: writing payloads losslessly, reading frames back, and finding shots.

A payload is cut into frames of 24 x 24 samples. A frame is one lossless JPEG image (process 14: samples predicted
from the left, first column from above, Huffman-coded differences), stored as an uncompressed-index AVI chunk:
RIFF header, stream list, the frames in the movi list, and the idx1 index. Reading parses the RIFF tree and its
index, checks each frame's markers and decodes it. Frames are decoded in step: one pass over the samples of a frame
serves thousands of frames at once.

Shots start where the difference of neighbouring frames' histograms stands out from the differences before it.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow

SIDE, RATE = 24, 25
FRAME = SIDE * SIDE
FILL = 255
#: Frames coded in one step.
STEP = 2048
#: Huffman code lengths of the difference categories 0 to 8: seven of 3 bits, then 4 and 5.
_ORDER = (0, 1, 2, 3, 4, 5, 7, 6, 8)
_LENGTHS = (3, 3, 3, 3, 3, 3, 3, 4, 5)
#: A shot starts where a difference exceeds the mean before it by this many deviations and by ``FLOOR`` of the samples.
DEVIATIONS, FLOOR, BINS = 3.0, 0.15, 16


def _codes() -> dict[int, tuple[int, int]]:
    """(code, length) of each category: canonical, shortest first."""
    out, code, before = {}, 0, _LENGTHS[0]
    for category, n in zip(_ORDER, _LENGTHS):
        code <<= n - before
        out[category], before, code = (code, n), n, code + 1
    return out


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For encoding, bits and their number of each difference from -255; for decoding, both of each 16-bit window."""
    bits, sizes = np.zeros(511, np.uint32), np.zeros(511, np.int64)
    value, used = np.zeros(65536, np.int16), np.zeros(65536, np.int64)
    codes = _codes()
    for d in range(-255, 256):
        category = abs(d).bit_length()
        code, n = codes[category]
        extra = d if d >= 0 else d + (1 << category) - 1
        word, size = code << category | extra, n + category
        bits[d + 255], sizes[d + 255] = word, size
        first = word << (16 - size)
        value[first : first + (1 << (16 - size))] = d
        used[first : first + (1 << (16 - size))] = size
    return bits, sizes, value, used


_BITS, _SIZES, _VALUE, _USED = _tables()


def _marker(kind: int, body: bytes = b"") -> bytes:
    return struct.pack(">BB", 0xFF, kind) + (struct.pack(">H", len(body) + 2) + body if body else b"")


#: Start of image, frame header, Huffman table, scan header with predictor 1.
_COUNTS = bytes(_LENGTHS.count(n) for n in range(1, 17))
HEAD = (
    _marker(0xD8)
    + _marker(0xC3, struct.pack(">BHHB3B", 8, SIDE, SIDE, 1, 1, 0x11, 0))
    + _marker(0xC4, b"\x00" + _COUNTS + bytes(_ORDER))
    + _marker(0xDA, bytes((1, 1, 0, 1, 0, 0)))
)
TAIL = _marker(0xD9)


def encode_frames(samples: np.ndarray) -> list[bytes]:
    """JPEG images of ``samples`` (frames, 24, 24)."""
    out = []
    for k in range(0, len(samples), STEP):
        x = samples[k : k + STEP].astype(np.int16)
        diff = np.empty_like(x)
        diff[:, :, 1:] = x[:, :, 1:] - x[:, :, :-1]
        diff[:, 1:, 0] = x[:, 1:, 0] - x[:, :-1, 0]
        diff[:, 0, 0] = x[:, 0, 0] - 128
        diff = diff.reshape(len(x), -1) + 255
        word, size = _BITS[diff], _SIZES[diff]
        ends = np.cumsum(size, axis=1)
        total = (ends[:, -1] + 7) // 8
        start = np.concatenate([[0], np.cumsum(total)])
        # A word of at most 13 bits lies in the three bytes from its first; words that start in one byte are merged.
        at = (ends - size) + start[:-1, None] * 8
        shifted = (word << (24 - size - (at & 7)).astype(np.uint32)).ravel()
        byte = (at >> 3).ravel()
        first = np.flatnonzero(np.diff(byte, prepend=-1))
        merged, byte = np.bitwise_or.reduceat(shifted, first), byte[first]
        data = np.zeros(int(start[-1]) + 3, np.uint8)
        for j in range(3):
            data[byte + j] |= (merged >> np.uint32(16 - 8 * j)).astype(np.uint8)
        pad = (total * 8 - ends[:, -1]).astype(np.uint8)
        data[start[1:] - 1] |= ((1 << pad) - 1).astype(np.uint8)
        raw = data[: int(start[-1])]
        full = np.flatnonzero(raw == 255)
        stuffed = np.insert(raw, full + 1, 0).tobytes()
        moved = start + np.searchsorted(full, start)
        out += [HEAD + stuffed[a:b] + TAIL for a, b in zip(moved[:-1].tolist(), moved[1:].tolist())]
    return out


def decode_frames(images: list[bytes]) -> np.ndarray:
    """The samples (frames, 24, 24) of JPEG ``images``; raises ValueError for any other form of image."""
    out = np.empty((len(images), SIDE, SIDE), np.uint8)
    for k in range(0, len(images), STEP):
        part = images[k : k + STEP]
        if any(not i.startswith(HEAD) or not i.endswith(TAIL) for i in part):
            raise ValueError("not a lossless JPEG frame of this size and table")
        scans = [i[len(HEAD) : -len(TAIL)].replace(b"\xff\x00", b"\xff") for i in part]
        start = np.concatenate([[0], np.cumsum([len(s) for s in scans])])
        data = np.frombuffer(b"".join(scans) + b"\0\0\0", np.uint8).astype(np.uint32)
        window = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
        pos, diff = start[:-1] * 8, np.empty((FRAME, len(part)), np.int16)
        limit = len(window) * 8 - 1
        for j in range(FRAME):
            w = window[pos >> 3] >> (8 - (pos & 7)).astype(np.uint32) & 0xFFFF
            diff[j] = _VALUE[w]
            pos = np.minimum(pos + _USED[w], limit)
        d = diff.T.reshape(len(part), SIDE, SIDE)
        d[:, 0, 0] += 128
        d[:, :, 0] = np.cumsum(d[:, :, 0], axis=1)
        out[k : k + STEP] = np.cumsum(d, axis=2, dtype=np.int16).astype(np.uint8)
    return out


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def write_avi(images: list[bytes]) -> bytes:
    """An AVI file of JPEG ``images``, with its index.

    A RIFF file holds at most 4 GiB; longer payloads raise ValueError rather than lose data.
    """
    n, most = len(images), max(map(len, images), default=0)
    main = struct.pack("<14I", 1_000_000 // RATE, most * RATE, 0, 0x10, n, 0, 1, most, SIDE, SIDE, 0, 0, 0, 0)
    strh = struct.pack("<4s4sIHHIIIIIIII4H", b"vids", b"MJPG", 0, 0, 0, 0, 1, RATE, 0, n, most, 0xFFFFFFFF, 0, 0, 0, SIDE, SIDE)
    strf = struct.pack("<IiiHH4sIiiII", 40, SIDE, SIDE, 1, 8, b"MJPG", FRAME, 0, 0, 0, 0)
    head = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", main) + _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf)))
    at, index, movi = 4, [], [b"movi"]
    for i in images:
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(i)))
        movi.append(_chunk(b"00dc", i))
        at += len(movi[-1])
    body = b"AVI " + head + _chunk(b"LIST", b"".join(movi)) + _chunk(b"idx1", b"".join(index))
    if len(body) >= 1 << 32:
        raise ValueError("an AVI file holds less than 4 GiB")
    return _chunk(b"RIFF", body)


def _chunks(data: memoryview, start: int, stop: int) -> Iterator[tuple[bytes, int, int]]:
    """(name, first byte, end) of the chunks between two offsets."""
    while start + 8 <= stop:
        size = struct.unpack_from("<I", data, start + 4)[0]
        yield bytes(data[start : start + 4]), start + 8, min(stop, start + 8 + size)
        start += 8 + size + (size & 1)


def read_avi(media: bytes) -> tuple[list[bytes], float]:
    """(images, frames a second) of an AVI file, by its index where it has one, else in the movi list's order."""
    data = memoryview(media)
    if bytes(data[:4]) != b"RIFF" or bytes(data[8:12]) != b"AVI ":
        raise ValueError("not an AVI file")
    top = list(_chunks(data, 12, len(data)))
    lists = {bytes(data[a : a + 4]): (a, b) for name, a, b in top if name == b"LIST"}
    if b"movi" not in lists:
        raise ValueError("no movi list")
    rate = float(RATE)
    if b"hdrl" in lists:
        for name, a, _ in _chunks(data, lists[b"hdrl"][0] + 4, lists[b"hdrl"][1]):
            if name == b"avih":
                rate = 1e6 / max(1, struct.unpack_from("<I", data, a)[0])
    first, last = lists[b"movi"]
    index = next(((a, b) for name, a, b in top if name == b"idx1"), None)
    if index:
        found = [struct.unpack_from("<4sIII", data, k) for k in range(index[0], index[1] - 15, 16)]
        return [bytes(data[first + at + 8 : first + at + 8 + size]) for name, _, at, size in found if name[2:] in (b"dc", b"db")], rate
    return [bytes(data[a:b]) for name, a, b in _chunks(data, first + 4, last) if name[2:] in (b"dc", b"db")], rate


def store(texts: list[bytes]) -> list[bytes]:
    """The AVI file of each text's payload: its bytes, padded by 255 to a positive multiple of a frame."""
    padded = [t + bytes([FILL]) * (-len(t) % FRAME or (0 if t else FRAME)) for t in texts]
    images, at, out = encode_frames(np.frombuffer(b"".join(padded), np.uint8).reshape(-1, SIDE, SIDE)), 0, []
    for p in padded:
        out.append(write_avi(images[at : at + len(p) // FRAME]))
        at += len(p) // FRAME
    return out


def load(media: list[bytes]) -> list[tuple[np.ndarray, float]]:
    """(frames, frames a second) of each AVI file."""
    read = [read_avi(m) for m in media]
    frames = decode_frames([i for images, _ in read for i in images])
    ends = np.cumsum([len(images) for images, _ in read])
    return [(frames[end - len(images) : end], rate) for end, (images, rate) in zip(ends, read)]


def _groups(items: list[bytes]) -> Iterator[list[bytes]]:
    """Neighbouring items together, up to a few thousand frames."""
    group, size = [], 0
    for x in items:
        group.append(x)
        size += len(x)
        if size >= 2 * STEP * FRAME:
            yield group
            group, size = [], 0
    if group:
        yield group


def histogram_differences(frames: np.ndarray) -> np.ndarray:
    """The share of samples that change their bin from each frame to the next."""
    bins = frames.reshape(len(frames), -1) >> 4
    flat = (np.arange(len(frames))[:, None] * BINS + bins).ravel()
    counts = np.bincount(flat, minlength=len(frames) * BINS).reshape(-1, BINS)
    return np.abs(np.diff(counts, axis=0)).sum(axis=1) / (2.0 * FRAME)


def shots(frames: np.ndarray) -> list[tuple[int, int, float]]:
    """(first frame, end, difference at its start) of each shot.

    The limit adapts: the mean of the shot's differences so far plus ``DEVIATIONS`` of their deviations, and at
    least ``FLOOR``. A shot's first difference is held against the floor alone.
    """
    if not len(frames):
        return []
    out, start, cut_at = [], 0, 0.0
    n, total, squares = 0, 0.0, 0.0
    for k, d in enumerate(histogram_differences(frames).tolist(), 1):
        mean = total / n if n else 0.0
        limit = max(FLOOR, mean + DEVIATIONS * max(0.0, squares / n - mean * mean) ** 0.5) if n else FLOOR
        if d > limit:
            out.append((start, k, cut_at))
            start, cut_at, n, total, squares = k, d, 0, 0.0, 0.0
        else:
            n, total, squares = n + 1, total + d, squares + d * d
    return [*out, (start, len(frames), cut_at)]


_CLIPS = "clip int, first_frame int, end_frame int, start_s double, end_s double, difference double"


def clips(df: DataFrame, id_col: str, media_col: str) -> DataFrame:
    """A row for each shot of every AVI file: the id column, clip (from 0), first_frame, end_frame (exclusive),
    start_s, end_s and the histogram difference at its start.

    Null media give no rows; files that are no such AVI give one row with a null clip.
    """
    kind = df.select(id_col).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for key, media in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not media.is_valid:
                    continue
                try:
                    [(frames, rate)] = load([media.as_py()])
                    rows = [(k, a, b, a / rate, b / rate, d) for k, (a, b, d) in enumerate(shots(frames))]
                except (ValueError, struct.error):
                    rows = [(None,) * 6]
                for row in rows:
                    for column, x in zip(out, (key, *row)):
                        column.append(x)
            types = [batch.schema.field(0).type, pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["id", "clip", "first_frame", "end_frame", "start_s", "end_s", "difference"])

    rows = df.select(F.col(id_col).alias("id"), F.col(media_col).cast("binary").alias("media"))
    return in_arrow(rows, run, f"id {kind}, {_CLIPS}").withColumnRenamed("id", id_col)


def stored(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, media): the AVI file of every row's text. A null text counts as empty, which makes one frame."""
    kind = df.select(id_col).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(1).cast(pa.large_binary())]
            media = [m for group in _groups(texts) for m in store(group)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(media, pa.binary())], ["id", "media"])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return in_arrow(rows, run, f"id {kind}, media binary").withColumnRenamed("id", id_col)


_DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_clips int"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[] for _ in range(8)]
        texts = [t.as_py() or b"" for t in batch.column(1).cast(pa.large_binary())]
        for group in _groups(texts):
            files = store(group)
            for text, media, (frames, rate) in zip(group, files, load(files)):
                payload, found = frames.tobytes(), shots(frames)
                times = ";".join(f"{a / rate:.2f}-{b / rate:.2f}" for a, b, _ in found)
                row = (
                    len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media),
                    hashlib.sha256(media).hexdigest(), f"mean={frames.mean():.3f},clips={times}", len(found),
                )
                for column, x in zip(out, row):
                    column.append(x)
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32()]
        names = [p.split()[0] for p in _DIGEST.split(", ")]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(out, types))], names)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row of ``docs``, what its stored clip and the payload read back from it amount to.

    The files of a few thousand frames at a time are held in memory and not returned; ``stored`` returns them. A
    null text counts as empty; equal texts give equal values; no rows give none.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return in_arrow(rows, _digests, _DIGEST)
