"""Images as arrays: PNG files read and written, shrunk, turned grey. Plain numpy, for use within tasks."""

from __future__ import annotations

import zlib

import numpy as np

_SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Samples of a pixel for each kind of PNG: grey, colour, palette, grey and colour with transparency.
_SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
# fixed values: weights of red, green and blue in grey, of 2^15
_GREY = (9798, 19235, 3735)


def _parts(content: bytes):
    """(kind, data) of a PNG file's chunks; checksums must fit."""
    at = len(_SIGNATURE)
    while at + 12 <= len(content):
        size = int.from_bytes(content[at : at + 4], "big")
        kind, data = content[at + 4 : at + 8], content[at + 8 : at + 8 + size]
        if len(data) < size or zlib.crc32(kind + data) != int.from_bytes(content[at + 8 + size : at + 12 + size], "big"):
            raise ValueError("damaged PNG")
        yield kind, data
        at += 12 + size


def _paeth(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Of left, upper and upper left neighbours the one nearest to left + upper - upper left."""
    pa, pb, pc = np.abs(b - c), np.abs(a - c), np.abs(a + b - 2 * c)
    return np.where((pa <= pb) & (pa <= pc), a, np.where(pb <= pc, b, c))


def _unfiltered(kinds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Samples (height, width, bytes) from filtered ones. Rows without a mean or Paeth filter are summed up one by one; otherwise a
    diagonal is done at once, as a sample needs its left and upper neighbours only."""
    height, width, _ = rows.shape
    if kinds.max(initial=0) > 4:
        raise ValueError("unknown PNG filter")
    if not (kinds > 2).any():
        out = rows.copy()
        for y, kind in enumerate(kinds):
            if kind == 1:
                out[y] = np.cumsum(rows[y], 0, dtype=np.uint8)
            elif kind == 2 and y:
                out[y] += out[y - 1]
        return out
    whole = np.zeros((height + 1, width + 1, rows.shape[2]), np.int16)
    for d in range(height + width - 1):
        y = np.arange(max(0, d - width + 1), min(height - 1, d) + 1)
        x = d - y
        a, b, c = whole[y + 1, x], whole[y, x + 1], whole[y, x]
        kind = kinds[y][:, None]
        guess = np.select([kind == 1, kind == 2, kind == 3, kind == 4], [a, b, (a + b) >> 1, _paeth(a, b, c)], 0)
        whole[y + 1, x + 1] = (rows[y, x] + guess) & 255
    return whole[1:, 1:].astype(np.uint8)


def decoded(content: bytes) -> np.ndarray:
    """Pixels (height, width, channels) of a PNG file: one channel if grey, else red, green and blue; transparency is left out, 16 bits
    are cut to 8. Other files, damaged or interlaced ones raise ValueError."""
    if not content.startswith(_SIGNATURE):
        raise ValueError("not a PNG file")
    chunks: dict[bytes, bytes] = {}
    for kind, data in _parts(content):
        chunks[kind] = chunks.get(kind, b"") + data
    head = chunks.get(b"IHDR", b"")
    if len(head) != 13 or b"IDAT" not in chunks:
        raise ValueError("damaged PNG")
    width, height = int.from_bytes(head[:4], "big"), int.from_bytes(head[4:8], "big")
    depth, kind, interlaced = head[8], head[9], head[12]
    if interlaced or kind not in _SAMPLES or depth not in (1, 2, 4, 8, 16) or not width or not height:
        raise ValueError("unsupported PNG")
    bits = depth * _SAMPLES[kind]
    line, unit = -(-width * bits // 8), max(1, bits // 8)
    data = zlib.decompress(chunks[b"IDAT"])
    if len(data) < height * (line + 1):
        raise ValueError("damaged PNG")
    raw = np.frombuffer(data, np.uint8, height * (line + 1)).reshape(height, line + 1)
    samples = _unfiltered(raw[:, 0], raw[:, 1:].reshape(height, line // unit, unit)).reshape(height, line)
    if depth == 16:
        samples = samples[:, ::2]
    elif depth < 8:
        steps = np.unpackbits(samples, axis=1).reshape(height, -1, depth)
        samples = (steps @ (1 << np.arange(depth - 1, -1, -1))).astype(np.uint8)[:, :width]
        if kind == 0:
            samples = samples * (255 // (2**depth - 1))
    pixels = samples.reshape(height, width, _SAMPLES[kind])
    if kind == 3:
        palette = np.frombuffer(chunks.get(b"PLTE", b""), np.uint8).reshape(-1, 3)
        if pixels.max() >= len(palette):
            raise ValueError("damaged PNG")
        return palette[pixels[..., 0]]
    return pixels[..., :1] if kind in (0, 4) else pixels[..., :3]


def gray_of(image: np.ndarray) -> np.ndarray:
    """Grey levels of pixels with one channel or red, green and blue."""
    if image.ndim == 2 or image.shape[2] == 1:
        return image.reshape(image.shape[:2])
    red, green, blue = (image[..., i].astype(np.int32) for i in range(3))
    return ((red * _GREY[0] + green * _GREY[1] + blue * _GREY[2] + (1 << 14)) >> 15).astype(np.uint8)


def shrunk(image: np.ndarray, scale: float) -> np.ndarray:
    """Area-averaged to a smaller size, each channel by itself."""
    if image.ndim == 3:
        return np.stack([shrunk(image[..., i], scale) for i in range(image.shape[2])], -1)
    h, w = max(1, round(image.shape[0] * scale)), max(1, round(image.shape[1] * scale))
    rows, columns = np.linspace(0, image.shape[0], h + 1), np.linspace(0, image.shape[1], w + 1)
    total = np.pad(np.cumsum(np.cumsum(image.astype(float), 0), 1), ((1, 0), (1, 0)))

    def along(t: np.ndarray, at: np.ndarray, axis: int) -> np.ndarray:
        low = np.floor(at).astype(int)
        upper, lower = t.take(np.minimum(low + 1, t.shape[axis] - 1), axis), t.take(low, axis)
        return lower + np.expand_dims(at % 1, 1 - axis) * (upper - lower)

    area = along(along(total, rows, 0), columns, 1)
    sums = np.diff(np.diff(area, axis=0), axis=1)
    return np.rint(sums / np.outer(np.diff(rows), np.diff(columns))).astype(np.uint8)


def png(image: np.ndarray) -> bytes:
    """A PNG file of 8 bits a sample, grey or in colour."""
    h, w = image.shape[:2]
    flat = image.reshape(h, -1)
    rows = np.insert(flat, 0, 0, axis=1).tobytes()
    chunk = lambda kind, data: len(data).to_bytes(4, "big") + kind + data + zlib.crc32(kind + data).to_bytes(4, "big")
    head = w.to_bytes(4, "big") + h.to_bytes(4, "big") + bytes([8, 0 if flat.shape[1] == w else 2, 0, 0, 0])
    return _SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")
