import struct

import numpy as np
import pytest

from tabulon.llm import video

TEXTS = [b"", b"a", b"\xff" * 576, b"x" * 577, bytes(range(256)) * 9, np.random.default_rng(0).integers(0, 256, 60000, dtype=np.uint8).tobytes()]


def test_lossless():
    for text, (frames, rate) in zip(TEXTS, video.load(video.store(TEXTS))):
        payload = frames.tobytes()
        assert payload == text + b"\xff" * (len(payload) - len(text)) and len(payload) % 576 == 0 and payload and rate == 25
    assert video.store([TEXTS[4]]) == video.store(TEXTS)[4:5]


def read_bits(image):
    """A frame decoded symbol by symbol from its own Huffman table."""
    counts, symbols = list(image[39 - 16 - 9 + 3 : 0] or []), None
    at = image.index(b"\xff\xc4") + 5
    counts, symbols = image[at : at + 16], image[at + 16 : at + 16 + sum(image[at : at + 16])]
    table, code, k = {}, 0, 0
    for n, c in enumerate(counts, 1):
        for _ in range(c):
            table[(n, code)] = symbols[k]
            code, k = code + 1, k + 1
        code <<= 1
    scan = image[image.index(b"\xff\xda") + 10 : -2].replace(b"\xff\x00", b"\xff")
    bits = "".join(f"{b:08b}" for b in scan)
    pos, diffs = 0, []
    for _ in range(576):
        n = 1
        while (n, int(bits[pos : pos + n], 2)) not in table:
            n += 1
        size = table[(n, int(bits[pos : pos + n], 2))]
        pos += n
        extra = int(bits[pos : pos + size] or "0", 2)
        pos += size
        diffs.append(extra if size == 0 or extra >> (size - 1) else extra - (1 << size) + 1)
    out = np.zeros((24, 24), int)
    for y in range(24):
        for x in range(24):
            before = out[y, x - 1] if x else out[y - 1, 0] if y else 128
            out[y, x] = before + diffs[y * 24 + x]
    return out


def test_frames_against_a_plain_decoder():
    samples = np.random.default_rng(3).integers(0, 256, (3, 24, 24), dtype=np.uint8)
    samples[1] = 65
    for image, frame in zip(video.encode_frames(samples), samples):
        assert (read_bits(image) == frame).all()


def test_files_without_index_and_broken_files():
    media = video.store([b"some text" * 200])[0]
    cut = media[: media.index(b"idx1")]
    assert video.read_avi(cut)[0] == video.read_avi(media)[0] and len(video.read_avi(media)[0]) == 4
    for bad in (b"", b"RIFF", b"RIFF\0\0\0\0WAVE", media[:100]):
        with pytest.raises((ValueError, struct.error)):
            video.read_avi(bad)


def test_shots_start_where_frames_change():
    frames = np.concatenate([np.full((6, 24, 24), 40), np.full((5, 24, 24), 200), np.full((4, 24, 24), 90)]).astype(np.uint8)
    assert [(a, b) for a, b, _ in video.shots(frames)] == [(0, 6), (6, 11), (11, 15)]
    assert video.shots(frames[:0]) == []


def test_frames_in_spark(spark):
    rows = [(k, t.decode("latin-1"), "x") for k, t in enumerate(TEXTS)] + [(None, None, "x"), (1, "a", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, media string")
    got = video.digests(docs).collect()
    assert len(got) == len(rows) and len({tuple(r)[1:] for r in got if r["doc_id"] == 1}) == 1
    assert next(r for r in got if r["doc_id"] is None)["payload_bytes"] == 576
    clips = video.clips(video.stored(docs, "doc_id", "text"), "doc_id", "media")
    assert clips.groupBy("doc_id").count().count() == len(TEXTS) + 1
    assert sum(r["n_clips"] for r in got) == clips.count()
    bad = video.clips(spark.createDataFrame([(1, b"no"), (2, None)], "id long, media binary"), "id", "media").collect()
    assert [(r["id"], r["clip"]) for r in bad] == [(1, None)]
    assert video.digests(docs.limit(0)).collect() == []
