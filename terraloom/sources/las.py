"""The small part of the LAS format the point scans read: uncompressed records of all point formats."""

from __future__ import annotations

import struct

import numpy as np

# Byte positions of the public LAS 1.2-1.4 header.
VERSION_MINOR_AT, HEADER_SIZE_AT, POINTS_AT, FORMAT_AT, RECORD_SIZE_AT = 25, 94, 96, 104, 105
COUNT_AT, SCALE_AT, OFFSET_AT, COUNT64_AT = 107, 131, 155, 247
HEADER_SIZE = 227
# The fields of the public point formats, as (name, type, byte position), and the size of each format's record.
OLD_FIELDS = (
    ("intensity", "<u2", 12), ("returns", "u1", 14), ("class", "u1", 15), ("angle", "i1", 16), ("user_data", "u1", 17), ("point_source_id", "<u2", 18),
)
NEW_FIELDS = (
    ("intensity", "<u2", 12), ("returns", "u1", 14), ("flags", "u1", 15), ("class", "u1", 16), ("user_data", "u1", 17), ("angle", "<i2", 18),
    ("point_source_id", "<u2", 20), ("gps_time", "<f8", 22),
)
GPS_AT = {1: 20, 3: 20, 4: 20, 5: 20}
COLOUR_AT = {2: 20, 3: 28, 5: 28, 7: 30, 8: 30, 10: 30}
NIR_AT = {8: 36, 10: 36}
RECORD_SIZES = {0: 20, 1: 28, 2: 26, 3: 34, 4: 57, 5: 63, 6: 30, 7: 36, 8: 38, 9: 59, 10: 67}
ANGLE_STEP = 0.006


def read_header(data: bytes) -> dict:
    if bytes(data[:4]) != b"LASF":
        raise ValueError("not a LAS file")
    if data[FORMAT_AT] & 0x80:
        raise ValueError("compressed LAS is not supported")
    count = struct.unpack_from("<I", data, COUNT_AT)[0]
    if data[VERSION_MINOR_AT] >= 4 and not count:
        count = struct.unpack_from("<Q", data, COUNT64_AT)[0]
    return {
        "points_at": struct.unpack_from("<I", data, POINTS_AT)[0],
        "record_size": struct.unpack_from("<H", data, RECORD_SIZE_AT)[0],
        "format": data[FORMAT_AT],
        "count": count,
        "scale": np.array(struct.unpack_from("<3d", data, SCALE_AT)),
        "offset": np.array(struct.unpack_from("<3d", data, OFFSET_AT)),
    }


def read_points(data: bytes, first: int, count: int, head: dict) -> np.ndarray:
    """``count`` points from record ``first`` on, shaped (point, 3)."""
    layout = np.dtype({"names": ["xyz"], "formats": [("<i4", 3)], "offsets": [0], "itemsize": head["record_size"]})
    raw = np.frombuffer(data, layout, count, head["points_at"] + first * head["record_size"])["xyz"]
    return raw * head["scale"] + head["offset"]


def read_dimensions(data: bytes, first: int, count: int, head: dict) -> dict[str, np.ndarray]:
    """The dimensions a file's point format has besides the coordinates, by name; bytes behind the format's own are ``extra_bytes``.

    Packed fields are taken apart, scan angles are in degrees, and ``class_flags`` has bit 0 for synthetic, 1 for
    key point, 2 for withheld and 3 for overlap, whatever the format.
    """
    kind, size = head["format"], head["record_size"]
    if kind not in RECORD_SIZES or size < RECORD_SIZES[kind]:
        raise ValueError(f"point format {kind} with records of {size} bytes")
    new = kind >= 6
    fields = list(NEW_FIELDS if new else OLD_FIELDS)
    fields += [("gps_time", "<f8", GPS_AT[kind])] if kind in GPS_AT else []
    fields += [(c, "<u2", COLOUR_AT[kind] + 2 * k) for k, c in enumerate(("red", "green", "blue"))] if kind in COLOUR_AT else []
    fields += [("nir", "<u2", NIR_AT[kind])] if kind in NIR_AT else []
    fields += [("extra_bytes", f"V{size - RECORD_SIZES[kind]}", RECORD_SIZES[kind])] if size > RECORD_SIZES[kind] else []
    names, types, places = zip(*fields)
    layout = np.dtype({"names": names, "formats": types, "offsets": places, "itemsize": size})
    raw = np.frombuffer(data, layout, count, head["points_at"] + first * size)
    out = {n: raw[n] for n in names if n not in ("returns", "flags", "class", "angle")}
    returns, flags = raw["returns"], raw["flags"] if new else raw["returns"]
    low = 4 if new else 3
    out["return_number"], out["number_of_returns"] = returns & ((1 << low) - 1), (returns >> low) & ((1 << low) - 1)
    out["scan_direction"], out["edge_of_flight_line"] = (flags >> 6) & 1, flags >> 7
    out["classification"] = raw["class"] if new else raw["class"] & 31
    out["class_flags"] = flags & 15 if new else raw["class"] >> 5
    out["scan_angle"] = raw["angle"] * (ANGLE_STEP if new else 1.0)
    if new:
        out["scanner_channel"] = (flags >> 4) & 3
    return out


def write(points: np.ndarray, scale: float = 0.01, dimensions: dict[str, np.ndarray] | None = None) -> bytes:
    """Encode (point, 3) coordinates as LAS 1.2; format 0, or 3 where dimensions (whole fields of that format) are given."""
    kind = 3 if dimensions else 0
    offset = np.floor(points.min(axis=0)) if len(points) else np.zeros(3)
    fields = [("xyz", ("<i4", 3), 0), *OLD_FIELDS]
    if dimensions:
        fields += [("gps_time", "<f8", GPS_AT[3]), *[(c, "<u2", COLOUR_AT[3] + 2 * k) for k, c in enumerate(("red", "green", "blue"))]]
    names, types, places = zip(*fields)
    records = np.zeros(len(points), np.dtype({"names": names, "formats": types, "offsets": places, "itemsize": RECORD_SIZES[kind]}))
    records["xyz"] = np.rint((points - offset) / scale)
    for name, values in (dimensions or {}).items():
        records["class" if name == "classification" else name] = values
    head = bytearray(HEADER_SIZE)
    head[:4] = b"LASF"
    head[24:26] = bytes((1, 2))
    struct.pack_into("<HIIBHI", head, HEADER_SIZE_AT, HEADER_SIZE, HEADER_SIZE, 0, kind, RECORD_SIZES[kind], len(points))
    struct.pack_into("<3d3d", head, SCALE_AT, scale, scale, scale, *offset)
    return bytes(head) + records.tobytes()
