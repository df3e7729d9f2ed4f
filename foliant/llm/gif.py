"""GIF streams: LZW codes, palettes, disposal, transparency and timing."""

from __future__ import annotations

import functools
import struct
from dataclasses import dataclass

import numpy as np

CLEAR_BITS = 12
#: Pixels of a screen or frame above which a file counts as broken: a few header bytes must not claim a task's memory.
MAX_PIXELS = 1 << 25


@functools.lru_cache(maxsize=16)
def _widths(least: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the i-th code after a clear code, and the bit at which it starts."""
    free = (1 << least) + 2 + np.maximum(np.arange(n) - 1, 0)
    widths = np.clip(np.floor(np.log2(free)).astype(np.int64) + 1, least + 1, CLEAR_BITS)
    return widths, np.concatenate([[0], np.cumsum(widths)])


def lzw_encode(data: bytes, least: int = 8) -> bytes:
    """Variable-width LZW codes, with a clear code whenever the table is full."""
    clear, codes, starts = 1 << least, [1 << least + 8], [0]
    # codes are held eight bits up, so that a code and the next byte make a key in one step
    table: dict[int, int] = {}
    get, put, free, full = table.get, codes.append, clear + 2 << 8, 1 << CLEAR_BITS + 8
    stream = iter(data)
    first = next(stream, None)
    prefix = 0 if first is None else first << 8
    for b in stream:
        if code := get(prefix | b):
            prefix = code
            continue
        put(prefix)
        if free < full:
            table[prefix | b] = free
            free += 256
        else:
            starts.append(len(codes))
            put(clear << 8)
            table.clear()
            free = clear + 2 << 8
        prefix = b << 8
    if first is not None:
        put(prefix)
    put(clear + 1 << 8)
    return _packed(np.array(codes, dtype=np.int64) >> 8, np.array(starts, dtype=np.int64), least)


def _packed(codes: np.ndarray, clears: np.ndarray, least: int) -> bytes:
    # a clear code is written at the width of its place after the clear before it
    place = np.arange(len(codes)) - 1
    after = np.searchsorted(clears, np.arange(len(codes)), side="left") - 1
    place = np.where(after >= 0, np.arange(len(codes)) - clears[np.maximum(after, 0)] - 1, 0)
    widths = _widths(least, (1 << CLEAR_BITS) + 8)[0][np.maximum(place, 0)]
    bits = np.arange(CLEAR_BITS)
    return np.packbits(((codes[:, None] >> bits) & 1).astype(np.uint8)[bits < widths[:, None]], bitorder="little").tobytes()


def lzw_decode(stream: bytes, least: int, wanted: int) -> bytes:
    """The first ``wanted`` samples of a code stream; raises ValueError if it is broken."""
    raw = np.frombuffer(stream + b"\0\0\0\0", dtype=np.uint8).astype(np.int64)
    clear, total, at, got = 1 << least, len(stream) * 8, 0, 0
    root = [bytes([i]) for i in range(clear)] + [b"", b""]
    full, out = (1 << CLEAR_BITS) - clear - 2, []
    while got < wanted:
        take = 4200
        while True:
            widths, begins = _widths(least, take)
            n = int(np.searchsorted(begins, total - at, side="right")) - 1
            n = min(n, take)
            bit = at + begins[:n]
            byte = bit >> 3
            window = raw[byte] | raw[byte + 1] << 8 | raw[byte + 2] << 16
            codes = (window >> (bit & 7)) & ((1 << widths[:n]) - 1)
            stops = np.flatnonzero((codes == clear) | (codes == clear + 1))
            if len(stops) or n < take:
                break
            take *= 4
        end = int(stops[0]) if len(stops) else n
        part = codes[:end].tolist()
        if part:
            if part[0] >= clear:
                raise ValueError("a code stream starts with a code that is not in its table")
            table = root.copy()
            add = table.append
            prior = table[part[0]]
            pieces = [prior]
            keep = pieces.append
            for code in part[1 : full + 1]:
                try:
                    entry = table[code]
                except IndexError:
                    if code != len(table):
                        raise ValueError("a code is ahead of its table") from None
                    entry = prior + prior[:1]
                add(prior + entry[:1])
                keep(entry)
                prior = entry
            try:
                pieces.extend([table[c] for c in part[full + 1 :]])
            except IndexError:
                raise ValueError("a code is ahead of its table") from None
            joined = b"".join(pieces)
            out.append(joined)
            got += len(joined)
        if not len(stops) or codes[end] == clear + 1:
            break
        at += int(begins[end + 1])
    data = b"".join(out)
    if len(data) < wanted:
        raise ValueError("a code stream ends early")
    return data[:wanted]


@dataclass
class Frame:
    left: int
    top: int
    width: int
    height: int
    delay: int
    disposal: int
    transparent: int | None
    palette: np.ndarray
    samples: bytes


def _sub_blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while n := data[at]:
        if at + 1 + n >= len(data):
            raise ValueError("a block ends early")
        parts.append(data[at + 1 : at + 1 + n])
        at += 1 + n
    return b"".join(parts), at + 1


def _palette(data: bytes, at: int, flags: int) -> tuple[np.ndarray | None, int]:
    if not flags & 0x80:
        return None, at
    n = 2 << (flags & 7)
    return np.frombuffer(data[at : at + 3 * n], dtype=np.uint8).reshape(n, 3), at + 3 * n


def _deinterlaced(samples: bytes, width: int, height: int) -> bytes:
    order = [*range(0, height, 8), *range(4, height, 8), *range(2, height, 4), *range(1, height, 2)]
    rows = np.frombuffer(samples, dtype=np.uint8).reshape(height, width)
    out = np.empty_like(rows)
    out[order] = rows
    return out.tobytes()


def parse(data: bytes) -> tuple[int, int, list[Frame]]:
    """Screen width and height, and frames; raises ValueError on a broken file."""
    try:
        return _parse(data)
    except (IndexError, struct.error) as e:
        raise ValueError("the file ends early") from e


def _parse(data: bytes) -> tuple[int, int, list[Frame]]:
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags = struct.unpack_from("<HHB", data, 6)
    if width * height > MAX_PIXELS:
        raise ValueError("the screen is too large")
    shared, at = _palette(data, 13, flags)
    delay, disposal, transparent, frames = 0, 0, None, []
    while data[at] != 0x3B:
        if data[at] == 0x21:
            block, after = _sub_blocks(data, at + 2)
            if data[at + 1] == 0xF9:
                packed, delay, index = struct.unpack_from("<BHB", block)
                disposal, transparent = packed >> 2 & 7, index if packed & 1 else None
            at = after
        elif data[at] == 0x2C:
            left, top, w, h, local = struct.unpack_from("<HHHHB", data, at + 1)
            own, at = _palette(data, at + 10, local)
            least = data[at]
            if w * h > MAX_PIXELS:
                raise ValueError("a frame is too large")
            if not 2 <= least <= 8:
                raise ValueError("a code size is out of range")
            stream, at = _sub_blocks(data, at + 1)
            samples = lzw_decode(stream, least, w * h)
            if local & 0x40:
                samples = _deinterlaced(samples, w, h)
            colours = own if own is not None else shared
            if colours is None:
                raise ValueError("a frame has no palette")
            frames.append(Frame(left, top, w, h, delay, disposal, transparent, colours, samples))
            delay, disposal, transparent = 0, 0, None
        else:
            raise ValueError("an unknown block")
    return width, height, frames


def render(width: int, height: int, frames: list[Frame]):
    """Yield the canvas (height, width, RGBA) at each frame, disposal and transparency applied."""
    canvas = np.zeros((height, width, 4), dtype=np.uint8)
    for f in frames:
        kept = canvas.copy() if f.disposal == 3 else None
        rows, cols = slice(f.top, min(height, f.top + f.height)), slice(f.left, min(width, f.left + f.width))
        index = np.frombuffer(f.samples, dtype=np.uint8).reshape(f.height, f.width)[: max(0, rows.stop - f.top), : max(0, cols.stop - f.left)]
        colours = np.zeros((256, 4), dtype=np.uint8)
        colours[: len(f.palette), :3] = f.palette
        colours[:, 3] = 255
        if index.size:
            drawn = colours[index]
            canvas[rows, cols] = drawn if f.transparent is None else np.where((index == f.transparent)[:, :, None], canvas[rows, cols], drawn)
        yield canvas.copy()
        if f.disposal == 2:
            canvas[rows, cols] = 0
        elif kept is not None:
            canvas = kept


def colour_histogram(canvas: np.ndarray) -> np.ndarray:
    """Counts of opaque pixels in 4 x 4 x 4 colour cells."""
    seen = canvas[canvas[:, :, 3] > 0].astype(np.int64) >> 6
    return np.bincount(seen[:, 0] << 4 | seen[:, 1] << 2 | seen[:, 2], minlength=64)


_GREY = bytes(v for i in range(256) for v in (i, i, i))


def store_samples(payload: bytes, width: int = 64, rows: int = 256, delay: int = 4) -> bytes:
    """A GIF whose frames hold ``payload`` (a multiple of ``width``) as grey samples."""
    step = width * rows
    out = [b"GIF89a", struct.pack("<HHBBB", width, min(rows, len(payload) // width), 0xF7, 0, 0), _GREY]
    for at in range(0, len(payload), step):
        part = payload[at : at + step]
        stream = lzw_encode(part)
        out.append(struct.pack("<BBBBHBB", 0x21, 0xF9, 4, 1 << 2, delay, 0, 0))
        out.append(struct.pack("<BHHHHBB", 0x2C, 0, 0, width, len(part) // width, 0, 8))
        out.extend(bytes([len(b)]) + b for b in (stream[i : i + 255] for i in range(0, len(stream), 255)))
        out.append(b"\0")
    out.append(b"\x3b")
    return b"".join(out)
