"""GIF decoding against files made by hand: palettes, disposal, transparency, interlace, broken and hostile headers."""

from __future__ import annotations

import random
import struct

import numpy as np
import pytest

from foliant.llm import gif, media

RED, GREEN, BLUE, BLACK = (255, 0, 0), (0, 255, 0), (0, 0, 255), (0, 0, 0)
SHARED = [BLACK, RED, GREEN, BLUE]


def slow_codes(data: bytes, least: int) -> list[tuple[int, int]]:
    """(code, bits) of a plain LZW encoder that looks phrases up as bytes."""
    clear = 1 << least
    table, bits, out, w = {}, least + 1, [(clear, least + 1)], b""
    fresh = lambda: {bytes([i]): i for i in range(clear)}
    table, free = fresh(), clear + 2
    for b in data:
        if w + bytes([b]) in table:
            w += bytes([b])
            continue
        out.append((table[w], bits))
        if free < 4096:
            table[w + bytes([b])] = free
            free += 1
            if free > 1 << bits and bits < 12:
                bits += 1
        else:
            out.append((clear, bits))
            table, free, bits = fresh(), clear + 2, least + 1
        w = bytes([b])
    if w:
        out.append((table[w], bits))
        free += 1
        if free > 1 << bits and bits < 12:
            bits += 1
    return [*out, (clear + 1, bits)]


def pack(codes: list[tuple[int, int]]) -> bytes:
    value = at = 0
    for code, bits in codes:
        value |= code << at
        at += bits
    return value.to_bytes((at + 7) // 8, "little")


@pytest.mark.parametrize("least", [2, 4, 8])
def test_streams_of_a_plain_encoder_are_read(least):
    rng = random.Random(least)
    for n in (0, 1, 2, 50, 3000, 40_000):
        data = bytes(rng.randrange(1 << least) if rng.random() < 0.4 else 0 for _ in range(n))
        assert gif.lzw_decode(pack(slow_codes(data, least)), least, n) == data


def blocks(stream: bytes) -> bytes:
    return b"".join(bytes([len(stream[i : i + 255])]) + stream[i : i + 255] for i in range(0, len(stream), 255)) + b"\0"


def frame(samples: list[int], left=0, top=0, width=2, height=2, delay=1, disposal=0, transparent=None, local=None, interlaced=False) -> bytes:
    control = struct.pack("<BBBBHBB", 0x21, 0xF9, 4, disposal << 2 | (transparent is not None), delay, transparent or 0, 0)
    flags = (0x40 if interlaced else 0) | (0x81 if local else 0)
    colours = b"".join(map(bytes, local or []))
    return control + struct.pack("<BHHHHB", 0x2C, left, top, width, height, flags) + colours + b"\x02" + blocks(pack(slow_codes(bytes(samples), 2)))


def file(*frames: bytes, width=2, height=2, shared=True, version=b"GIF89a") -> bytes:
    head = version + struct.pack("<HHBBB", width, height, 0x81 if shared else 0, 0, 0)
    return head + (b"".join(map(bytes, SHARED)) if shared else b"") + b"".join(frames) + b"\x3b"


def canvases(data: bytes) -> list:
    w, h, frames = gif.parse(data)
    return [[[tuple(int(v) for v in p) for p in row] for row in c] for c in gif.render(w, h, frames)]


def opaque(*rows) -> list:
    return [[(*p, 255) if p else (0, 0, 0, 0) for p in row] for row in rows]


def test_disposal_two_clears_the_frame():
    data = file(frame([1, 1, 1, 1]), frame([2], width=1, height=1, disposal=2), frame([3], left=1, width=1, height=1))
    assert canvases(data) == [opaque([RED, RED], [RED, RED]), opaque([GREEN, RED], [RED, RED]), opaque([None, BLUE], [RED, RED])]


def test_disposal_three_restores_what_was_there():
    data = file(frame([1, 1, 1, 1], disposal=1), frame([2, 2, 2, 2], disposal=3), frame([3], width=1, height=1))
    assert canvases(data)[2] == opaque([BLUE, RED], [RED, RED])


def test_transparency_and_local_palettes():
    data = file(frame([1, 1, 1, 1]), frame([0, 1, 2, 3], transparent=0, local=[(9, 9, 9), (1, 2, 3), (4, 5, 6), (7, 8, 9)]), frame([0, 0, 1, 2], transparent=1))
    assert canvases(data)[1] == opaque([RED, (1, 2, 3)], [(4, 5, 6), (7, 8, 9)])
    assert canvases(data)[2] == opaque([BLACK, BLACK], [(4, 5, 6), GREEN])


def test_interlaced_rows_are_put_in_order():
    rows = [k % 4 for k in range(11)]
    order = [0, 8, 4, 2, 6, 10, 1, 3, 5, 7, 9]
    data = file(frame([rows[k] for k in order], width=1, height=11, interlaced=True), width=1, height=11)
    assert [c[0][:3] for c in canvases(data)[0]] == [SHARED[k] for k in rows]


def test_frames_beyond_the_screen_are_clipped():
    assert canvases(file(frame([1, 2, 3, 1], left=1, top=1)))[0] == opaque([None, None], [None, RED])


def test_timing_and_histogram(spark):
    good = file(frame([1, 1, 2, 3], delay=7), frame([0, 0, 0, 0], delay=5))
    bad = {1: b"", 2: b"GIF89a", 3: good[:-9], 4: file(), 5: file(frame([1, 1, 1, 1]), shared=False), 6: file(width=65535, height=65535), 7: file(frame([1], width=65535, height=65535)), 8: b"PNG" + good, 9: good[:13] + good[25:]}
    rows = [(0, bytearray(good), "x"), (0, bytearray(good), "x"), (None, None, "y"), *[(k, bytearray(v), "z") for k, v in bad.items()]]
    held = spark.createDataFrame(rows, "media_id long, content binary, frame string")
    got = media.gif_frames(held).collect()
    fine = sorted((r.frame, r.start_cs, r.delay_cs, r.width, r.disposal) for r in got if r.error is None)
    assert fine == [(0, 0, 7, 2, 0), (0, 0, 7, 2, 0), (1, 7, 5, 2, 0), (1, 7, 5, 2, 0)]
    first = next(r for r in got if r.frame == 0)
    assert {i: n for i, n in enumerate(first.histogram) if n} == {48: 2, 12: 1, 3: 1}
    assert len(first.pixels) == 16
    broken = {r.media_id: r.error for r in got if r.frame == -1}
    assert broken.keys() == {None, *bad}
    assert broken[4] == "no frames" and "too large" in broken[6] and "too large" in broken[7]
    assert media.gif_frames(held.limit(0)).count() == 0


def test_random_damage_never_crashes():
    rng = random.Random(3)
    good = file(frame([1, 2, 3, 0]), frame([0, 1, 1, 2], disposal=3, local=SHARED))
    for _ in range(2000):
        data = bytearray(good)
        for _ in range(rng.randint(1, 4)):
            data[rng.randrange(6, len(data))] = rng.randrange(256)
        try:
            w, h, frames = gif.parse(bytes(data[: rng.randint(10, len(data))]))
        except ValueError:
            continue
        if w * h < 10_000:
            assert all(isinstance(c, np.ndarray) for c in gif.render(w, h, frames))
