"""Writes small shapefiles byte by byte, after the published format description."""

import os
import struct


def write_shapefile(stem, records, null_attributes=()):
    """``records``: (attributes, rings or None); attributes: OBJECTID, PARCEL_NO, SHAPEarea, SHAPElen."""
    os.makedirs(os.path.dirname(stem), exist_ok=True)
    shapes, index = b"", b""
    for number, (_, rings) in enumerate(records, 1):
        if rings is None:
            content = struct.pack("<i", 0)
        else:
            points = [p for ring in rings for p in ring]
            xs, ys = [p[0] for p in points], [p[1] for p in points]
            starts, at = [], 0
            for ring in rings:
                starts.append(at)
                at += len(ring)
            content = struct.pack("<i4d2i", 5, min(xs), min(ys), max(xs), max(ys), len(rings), len(points))
            content += struct.pack(f"<{len(starts)}i", *starts)
            content += b"".join(struct.pack("<2d", *p) for p in points)
        index += struct.pack(">2i", (100 + len(shapes)) // 2, len(content) // 2)
        shapes += struct.pack(">2i", number, len(content) // 2) + content
    for suffix, body in ((".shp", shapes), (".shx", index)):
        header = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(body)) // 2)
        header += struct.pack("<2i8d", 1000, 5, *([0.0] * 8))
        with open(stem + suffix, "wb") as out:
            out.write(header + body)
    fields = [("OBJECTID", "N", 10, 0), ("PARCEL_NO", "C", 20, 0), ("SHAPEarea", "N", 19, 11), ("SHAPElen", "F", 19, 11)]
    width = 1 + sum(f[2] for f in fields)
    head = struct.pack("<4BIHH20x", 3, 121, 5, 26, len(records), 32 + 32 * len(fields) + 1, width)
    for name, kind, size, places in fields:
        head += name.encode().ljust(11, b"\0") + kind.encode() + b"\0" * 4 + bytes([size, places]) + b"\0" * 14
    body = b"\r"
    for values, _ in records:
        body += b" "
        for value, (_, kind, size, _) in zip(values, fields):
            text = "" if value is None else str(value)
            body += (text.rjust(size) if kind != "C" else text.ljust(size)).encode()
    with open(stem + ".dbf", "wb") as out:
        out.write(head + body)
