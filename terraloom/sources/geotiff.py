"""The small part of the GeoTIFF format the raster scans read: strips or tiles, raw or deflate."""

from __future__ import annotations

import struct
import zlib

import numpy as np

# Tag numbers, field type codes and key numbers of the TIFF and GeoTIFF formats.
WIDTH, HEIGHT, BITS, COMPRESSION = 256, 257, 258, 259
PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, STRIP_ROWS, STRIP_BYTES = 262, 273, 277, 278, 279
PREDICTOR = 317
PLANAR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_BYTES, SAMPLE_FORMAT = 284, 322, 323, 324, 325, 339
PIXEL_SCALE, TIEPOINT, TRANSFORM, GEO_KEYS, GDAL_NODATA = 33550, 33922, 34264, 34735, 42113
FIELD = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d"}
KIND = {1: "u", 2: "i", 3: "f"}
GEOGRAPHIC_KEY, PROJECTED_KEY = 2048, 3072
RAW, DEFLATE, OLD_DEFLATE = 1, 8, 32946


def _tags(data: bytes) -> tuple[str, dict]:
    order = {b"II": "<", b"MM": ">"}.get(bytes(data[:2]))
    if order is None or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    at = struct.unpack_from(order + "I", data, 4)[0]
    tags = {}
    for i in range(struct.unpack_from(order + "H", data, at)[0]):
        entry = at + 2 + 12 * i
        tag, kind, count = struct.unpack_from(order + "HHI", data, entry)
        if kind not in FIELD:
            continue
        code = f"{order}{count}{FIELD[kind]}"
        where = entry + 8
        if struct.calcsize(code) > 4:
            where = struct.unpack_from(order + "I", data, where)[0]
        values = struct.unpack_from(code, data, where)
        tags[tag] = values[0].rstrip(b"\0").decode("ascii", "replace") if kind == 2 else values
    return order, tags


def _crs(tags: dict) -> str | None:
    keys = tags.get(GEO_KEYS, ())
    codes = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4)}
    code = codes.get(PROJECTED_KEY) or codes.get(GEOGRAPHIC_KEY)
    return f"EPSG:{code}" if code else None


def read_header(data: bytes) -> dict:
    """Grid, type and georeference; fails on files whose pixels could not be read."""
    order, tags = _tags(data)
    bits = tags.get(BITS, (8,))
    kind = KIND.get(tags.get(SAMPLE_FORMAT, (1,))[0])
    if kind is None or len(set(bits)) != 1:
        raise ValueError("unsupported sample layout")
    packing, predictor = tags.get(COMPRESSION, (RAW,))[0], tags.get(PREDICTOR, (1,))[0]
    if packing not in (RAW, DEFLATE, OLD_DEFLATE) or predictor != 1:
        raise ValueError(f"unsupported compression {packing}, predictor {predictor}")
    starts = tags[TILE_OFFSETS] if TILE_OFFSETS in tags else tags[STRIP_OFFSETS]
    sizes = tags[TILE_BYTES] if TILE_OFFSETS in tags else tags[STRIP_BYTES]
    if any(at + size > len(data) for at, size in zip(starts, sizes)):
        raise ValueError("truncated pixel data")
    a, e, c, f = 1.0, 1.0, 0.0, 0.0
    b = d = 0.0
    if TRANSFORM in tags:
        m = tags[TRANSFORM]
        a, b, c, d, e, f = m[0], m[1], m[3], m[4], m[5], m[7]
    elif PIXEL_SCALE in tags and TIEPOINT in tags:
        sx, sy = tags[PIXEL_SCALE][:2]
        i, j, _, x, y = tags[TIEPOINT][:5]
        a, e, c, f = sx, -sy, x - i * sx, y + j * sy
    nodata = tags.get(GDAL_NODATA)
    return {
        "width": tags[WIDTH][0],
        "height": tags[HEIGHT][0],
        "band_count": tags.get(SAMPLES, (1,))[0],
        "dtype": np.dtype(f"{kind}{bits[0] // 8}").name,
        "crs": _crs(tags),
        "nodata": None if nodata in (None, "") else float(nodata),
        "a": float(a), "b": float(b), "c": float(c), "d": float(d), "e": float(e), "f": float(f),
    }


def read_array(data: bytes) -> np.ndarray:
    """All pixels, shaped (band, row, column)."""
    order, tags = _tags(data)
    head = read_header(data)
    packing = tags.get(COMPRESSION, (RAW,))[0]
    width, height, bands = head["width"], head["height"], head["band_count"]
    separate = tags.get(PLANAR, (1,))[0] == 2
    if TILE_OFFSETS in tags:
        cw, ch = tags[TILE_WIDTH][0], tags[TILE_HEIGHT][0]
        offsets, sizes = tags[TILE_OFFSETS], tags[TILE_BYTES]
    else:
        cw, ch = width, min(tags.get(STRIP_ROWS, (height,))[0], height)
        offsets, sizes = tags[STRIP_OFFSETS], tags[STRIP_BYTES]
    across, down = -(-width // cw), -(-height // ch)
    dtype = np.dtype(head["dtype"]).newbyteorder(order)
    depth = 1 if separate else bands
    if min(len(offsets), len(sizes)) < across * down * (bands if separate else 1):
        raise ValueError(f"{min(len(offsets), len(sizes))} of {across * down * (bands if separate else 1)} chunks")
    out = np.zeros((bands, down * ch, across * cw), head["dtype"])
    for n, (at, size) in enumerate(zip(offsets, sizes)):
        chunk = bytes(data[at : at + size])
        if packing != RAW:
            chunk = zlib.decompress(chunk)
        plane, rest = divmod(n, across * down) if separate else (0, n)
        row, col = divmod(rest, across)
        lines = ch if TILE_OFFSETS in tags else min(ch, height - row * ch)
        if len(chunk) < lines * cw * depth * dtype.itemsize:
            raise ValueError(f"chunk {n} holds {len(chunk)} of {lines * cw * depth * dtype.itemsize} bytes")
        cell = np.frombuffer(chunk, dtype, lines * cw * depth).reshape(lines, cw, depth)
        target = slice(plane, plane + 1) if separate else slice(None)
        out[target, row * ch : row * ch + cell.shape[0], col * cw : (col + 1) * cw] = np.moveaxis(cell, -1, 0)
    return out[:, :height, :width]


def write(array: np.ndarray, a: float, c: float, e: float, f: float, epsg: int | None = None,
          nodata: float | None = None, deflate: bool = False) -> bytes:
    """Encode (band, row, column) pixels as a planar little-endian file, one strip per band."""
    bands, height, width = array.shape
    dtype = array.dtype.newbyteorder("<")
    strips = [np.ascontiguousarray(band, dtype).tobytes() for band in array]
    if deflate:
        strips = [zlib.compress(s) for s in strips]
    kind = {v: k for k, v in KIND.items()}[array.dtype.kind]
    offsets, at = [], 8
    for s in strips:
        offsets.append(at)
        at += len(s) + len(s) % 2
    tags = {
        WIDTH: (4, [width]), HEIGHT: (4, [height]), BITS: (3, [array.dtype.itemsize * 8] * bands),
        COMPRESSION: (3, [DEFLATE if deflate else RAW]), PHOTOMETRIC: (3, [1]), STRIP_OFFSETS: (4, offsets),
        SAMPLES: (3, [bands]), STRIP_ROWS: (4, [height]), STRIP_BYTES: (4, [len(s) for s in strips]),
        PLANAR: (3, [2]), SAMPLE_FORMAT: (3, [kind] * bands),
        PIXEL_SCALE: (12, [a, -e, 0.0]), TIEPOINT: (12, [0.0, 0.0, 0.0, c, f, 0.0]),
    }
    if epsg is not None:
        key = GEOGRAPHIC_KEY if 4000 <= epsg < 5000 else PROJECTED_KEY
        model = 2 if key == GEOGRAPHIC_KEY else 1
        tags[GEO_KEYS] = (3, [1, 1, 0, 2, 1024, 0, 1, model, key, 0, 1, epsg])
    if nodata is not None:
        tags[GDAL_NODATA] = (2, repr(float(nodata)).encode() + b"\0")
    body = b"".join(s + b"\0" * (len(s) % 2) for s in strips)
    directory, extra = struct.pack("<H", len(tags)), b""
    extra_at = at + 2 + 12 * len(tags) + 4
    for tag in sorted(tags):
        field, values = tags[tag]
        raw = values if field == 2 else struct.pack(f"<{len(values)}{FIELD[field]}", *values)
        if len(raw) <= 4:
            slot = raw.ljust(4, b"\0")
        else:
            slot = struct.pack("<I", extra_at + len(extra))
            extra += raw + b"\0" * (len(raw) % 2)
        directory += struct.pack("<HHI", tag, field, len(values)) + slot
    return b"II*\0" + struct.pack("<I", at) + body + directory + struct.pack("<I", 0) + extra
