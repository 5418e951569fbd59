"""Pictures as numpy arrays inside Arrow batches: reading, converting, marking and writing.

PNG is read and written here; other formats come by a plug-in, ``register``ed under the
first bytes of their files. A picture is an array (height, width) or (height, width,
channels) of 8 or 16 bits.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Fixed value: how a PNG file begins.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
RGB = {"red": (255, 0, 0), "blue": (0, 0, 255), "green": (0, 128, 0), "pink": (255, 105, 180), "yellow": (255, 255, 0), "orange": (255, 165, 0), "purple": (128, 0, 128), "brown": (139, 69, 19)}
DECODERS: dict[bytes, Callable[[bytes], np.ndarray]] = {}


def register(magic: bytes, decode: Callable[[bytes], np.ndarray]) -> None:
    """Files that begin with ``magic`` are read by ``decode``."""
    DECODERS[magic] = decode


def decode(data: bytes) -> np.ndarray:
    """The picture in a file; an unknown format is an error that says so."""
    if data.startswith(SIGNATURE):
        return decode_png(data)
    for magic, f in DECODERS.items():
        if data.startswith(magic):
            return f(data)
    raise ValueError(f"no decoder for a picture that begins with {data[:8].hex()}")


def _chunks(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    at = 8
    while at + 8 <= len(data):
        (n,) = struct.unpack(">I", data[at : at + 4])
        yield data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        at += 12 + n


def _unfiltered(raw: np.ndarray, step: int) -> np.ndarray:
    """Rows (filter byte first) as the bytes they stand for; ``step``: bytes of a pixel."""
    out = np.zeros((len(raw), raw.shape[1] - 1), np.uint8)
    above = np.zeros(raw.shape[1] - 1, np.uint8)
    for y, row in enumerate(raw):
        kind, line = row[0], row[1:]
        if kind == 1:
            line = np.add.accumulate(line.reshape(-1, step), axis=0, dtype=np.uint8).ravel()
        elif kind == 2:
            line = line + above
        elif kind in (3, 4):
            pixels, up = line.reshape(-1, step).astype(np.int32), above.reshape(-1, step).astype(np.int32)
            left, corner = np.zeros(step, np.int32), np.zeros(step, np.int32)
            for x in range(len(pixels)):
                if kind == 3:
                    guess = (left + up[x]) // 2
                else:
                    p = left + up[x] - corner
                    a, b, c = np.abs(p - left), np.abs(p - up[x]), np.abs(p - corner)
                    guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, up[x], corner))
                pixels[x] = left = (pixels[x] + guess) & 255
                corner = up[x]
            line = pixels.astype(np.uint8).ravel()
        elif kind:
            raise ValueError(f"PNG row with filter {kind}")
        out[y] = above = line
    return out


def decode_png(data: bytes) -> np.ndarray:
    """A PNG file that is not interlaced; a palette is written out."""
    head, palette, body = None, None, b""
    for name, chunk in _chunks(data):
        if name == b"IHDR":
            head = struct.unpack(">IIBBBBB", chunk)
        elif name == b"PLTE":
            palette = np.frombuffer(chunk, np.uint8).reshape(-1, 3)
        elif name == b"IDAT":
            body += chunk
    if head is None or head[6]:
        raise ValueError("not a PNG file, or an interlaced one")
    width, height, depth, color = head[:4]
    bits = depth * CHANNELS[color]
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, 1 + (width * bits + 7) // 8)
    rows = _unfiltered(raw, max(1, bits // 8))
    if depth == 16:
        out = rows.view(">u2").astype(np.uint16)
    elif depth < 8:
        out = np.unpackbits(rows, axis=1).reshape(height, -1, depth)
        out = (out * (1 << np.arange(depth)[::-1])).sum(2).astype(np.uint8)[:, :width]
        out = out if color == 3 else out * (255 // ((1 << depth) - 1))
    else:
        out = rows
    if color == 3:
        return palette[out]
    return out.reshape(height, width) if CHANNELS[color] == 1 else out.reshape(height, width, -1)


def encode_png(picture: np.ndarray) -> bytes:
    """A picture of 1 to 4 channels as a PNG file."""
    height, width = picture.shape[:2]
    channels = 1 if picture.ndim == 2 else picture.shape[2]
    depth = 16 if picture.dtype == np.uint16 else 8
    color = {1: 0, 2: 4, 3: 2, 4: 6}[channels]
    body = picture.astype(">u2" if depth == 16 else np.uint8).reshape(height, -1).view(np.uint8)
    raw = np.concatenate([np.zeros((height, 1), np.uint8), body], axis=1).tobytes()

    def chunk(name: bytes, value: bytes) -> bytes:
        return struct.pack(">I", len(value)) + name + value + struct.pack(">I", zlib.crc32(name + value))

    head = struct.pack(">IIBBBBB", width, height, depth, color, 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def rgb(picture: np.ndarray) -> np.ndarray:
    """A picture in three channels of 8 bits; alpha lies on white."""
    out = (picture >> 8).astype(np.uint8) if picture.dtype == np.uint16 else picture
    if out.ndim == 2:
        out = out[:, :, None]
    if out.shape[2] in (2, 4):
        alpha = out[:, :, -1:].astype(np.float64) / 255
        out = np.round(out[:, :, :-1] * alpha + 255 * (1 - alpha)).astype(np.uint8)
    return np.repeat(out, 3, axis=2) if out.shape[2] == 1 else out


def resized(picture: np.ndarray, width: int, height: int) -> np.ndarray:
    """Bilinear, with pixel centres at halves."""
    h, w = picture.shape[:2]
    y = np.clip((np.arange(height) + 0.5) * h / height - 0.5, 0, h - 1)
    x = np.clip((np.arange(width) + 0.5) * w / width - 0.5, 0, w - 1)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    extra = (1,) * (picture.ndim - 2)
    fy, fx = (y - y0).reshape(-1, 1, *extra), (x - x0).reshape(1, -1, *extra)
    p = picture.astype(np.float64)
    top = p[y0][:, x0] * (1 - fx) + p[y0][:, x1] * fx
    low = p[y1][:, x0] * (1 - fx) + p[y1][:, x1] * fx
    return np.round(top * (1 - fy) + low * fy).astype(picture.dtype)


def marked(picture: np.ndarray, boxes: list[tuple[int, int, int, int]], colors: list[str], line: int) -> np.ndarray:
    """A picture with rectangles ``line`` pixels wide, drawn inwards from the given pixels."""
    out = rgb(picture).copy()
    h, w = out.shape[:2]
    for (x1, y1, x2, y2), color in zip(boxes, colors, strict=True):
        x1, x2 = sorted((min(max(int(x1), 0), w - 1), min(max(int(x2), 0), w - 1)))
        y1, y2 = sorted((min(max(int(y1), 0), h - 1), min(max(int(y2), 0), h - 1)))
        inner = out[y1 + line : y2 + 1 - line, x1 + line : x2 + 1 - line].copy()
        out[y1 : y2 + 1, x1 : x2 + 1] = RGB[color]
        if inner.size:
            out[y1 + line : y2 + 1 - line, x1 + line : x2 + 1 - line] = inner
    return out


def render(rows: DataFrame, key: str, content: str = "content", boxes: str = "boxes", colors: str = "colors", scale: int = 1000) -> DataFrame:
    """(key, content, width, height) of pictures with their boxes drawn: arrays of normalised boxes and of colour names, as PNG files."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, data, at, named in zip(b[key], b[content], b[boxes], b[colors], strict=True):
                picture = decode(bytes(data))
                h, w = picture.shape[:2]
                px = [(x1 * w // scale, y1 * h // scale, x2 * w // scale, y2 * h // scale) for x1, y1, x2, y2 in at]
                drawn = marked(picture, px, list(named), max(2, round(min(w, h) * 0.004)))
                out.append((k, encode_png(drawn), w, h))
            yield pd.DataFrame(out, columns=[key, "content", "width", "height"])

    return rows.select(key, content, boxes, colors).mapInPandas(run, f"{key} {kind}, content binary, width int, height int")


def converted(rows: DataFrame, key: str, content: str = "content", width: int | None = None, height: int | None = None) -> DataFrame:
    """(key, content, width, height) of pictures as RGB PNG files, resized if asked for."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, data in zip(b[key], b[content], strict=True):
                picture = rgb(decode(bytes(data)))
                if width and height:
                    picture = resized(picture, width, height)
                out.append((k, encode_png(picture), picture.shape[1], picture.shape[0]))
            yield pd.DataFrame(out, columns=[key, "content", "width", "height"])

    return rows.select(key, content).mapInPandas(run, f"{key} {kind}, content binary, width int, height int")


def pixel_table(rows: DataFrame, key: str, content: str = "content") -> DataFrame:
    """(key, u, v, values) of every pixel, its channels as an array."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k, data in zip(b[key], b[content], strict=True):
                p = decode(bytes(data))
                v, u = np.indices(p.shape[:2])
                yield pd.DataFrame({key: k, "u": u.ravel().astype(np.int32), "v": v.ravel().astype(np.int32), "values": list(p.reshape(p.shape[0] * p.shape[1], -1).astype(np.int32))})

    return rows.select(key, content).mapInPandas(run, f"{key} {kind}, u int, v int, values array<int>")


def mask_pictures(masks: DataFrame, key: str, runs: str = "runs", width: str = "width", height: str = "height") -> DataFrame:
    """(key, content): run-length masks as grey PNG files, 255 inside and 0 outside."""
    kind = masks.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, r, w, h in zip(b[key], b[runs], b[width], b[height], strict=True):
                flat = np.zeros(w * h, np.uint8)
                for x in r:
                    flat[x["start"] : x["start"] + x["length"]] = 255
                out.append((k, encode_png(flat.reshape(h, w))))
            yield pd.DataFrame(out, columns=[key, "content"])

    return masks.select(key, runs, width, height).mapInPandas(run, f"{key} {kind}, content binary")


def tonemapped(color: np.ndarray, valid: np.ndarray, percentile: float = 90, brightness: float = 0.8, gamma: float = 1 / 2.2) -> np.ndarray:
    """Light values (height, width, 3) as an 8-bit picture: the brightness at a percentile of the valid pixels is taken to a fixed one, then the gamma."""
    scale = 1.0
    if valid.any():
        now = np.percentile((color @ np.array([0.3, 0.59, 0.11]))[valid], percentile)
        scale = 0.0 if now < 1e-4 else brightness ** (1 / gamma) / now
    return np.clip(np.clip(np.maximum(scale * color, 0) ** gamma, 0, 1) * 255 + 0.5, 0, 255).astype(np.uint8)
