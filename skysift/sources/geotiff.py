"""GeoTIFF files: headers as a catalogue, pixels in long form, and a plain writer.

Only what the format's public specification says is used. Strips and tiles,
no compression, LZW or deflate, 8 to 64 bits, chunky or planar samples.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skysift.operators.catalog import acquisition_time, vendor

_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 16: 8}
_CODES = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}


def tags(data: bytes) -> dict[int, tuple | str]:
    """The tags of the first image of a classic TIFF."""
    order = {b"II": "<", b"MM": ">"}[data[:2]]
    magic, at = struct.unpack_from(order + "HI", data, 2)
    if magic != 42:
        raise ValueError("not a classic TIFF")
    (n,) = struct.unpack_from(order + "H", data, at)
    out: dict[int, tuple | str] = {0: (order,)}
    for i in range(n):
        tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
        size, place = _SIZES.get(kind, 1) * count, at + 10 + 12 * i
        if size > 4:
            (place,) = struct.unpack_from(order + "I", data, place)
        if kind == 2:
            out[tag] = data[place : place + count].split(b"\0")[0].decode("latin-1")
        elif kind in _CODES:
            out[tag] = struct.unpack_from(f"{order}{count}{_CODES[kind]}", data, place)
    return out


def header(data: bytes) -> dict:
    """width, height, bands, transform (a, b, c, d, e, f), epsg, nodata, datetime."""
    t = tags(data)
    if 34264 in t:
        m = t[34264]
        transform = [m[0], m[1], m[3], m[4], m[5], m[7]]
    elif 33550 in t and 33922 in t:
        (sx, sy, _), (i, j, _, x, y, _) = t[33550][:3], t[33922][:6]
        transform = [sx, 0.0, x - i * sx, 0.0, -sy, y + j * sy]
    else:
        transform = [1.0, 0.0, 0.0, 0.0, 1.0, 0.0]
    keys = t.get(34735, ())
    geo = {keys[k]: keys[k + 3] for k in range(4, len(keys), 4)}
    nodata = str(t.get(42113, "")).strip()
    return {
        "width": int(t[256][0]), "height": int(t[257][0]), "bands": int(t.get(277, (1,))[0]), "transform": [float(v) for v in transform],
        "epsg": geo.get(3072) or geo.get(2048), "nodata": float(nodata) if nodata else None, "datetime": t.get(306),
    }


def _lzw(data: bytes) -> bytes:
    out, table, width, bits, have, last = bytearray(), [], 9, 0, 0, b""
    for byte in data:
        bits, have = bits << 8 | byte, have + 8
        while have >= width:
            have -= width
            code = bits >> have & ((1 << width) - 1)
            bits &= (1 << have) - 1
            if code == 257:
                return bytes(out)
            if code == 256:
                table, width, last = [bytes([i]) for i in range(256)] + [b"", b""], 9, b""
                continue
            entry = table[code] if code < len(table) else last + last[:1]
            out += entry
            if last:
                table.append(last + entry[:1])
            last = entry
            width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return bytes(out)


def read_bands(data: bytes) -> np.ndarray:
    """All samples as (bands, height, width)."""
    t = tags(data)
    w, h, n = t[256][0], t[257][0], t.get(277, (1,))[0]
    bits, form, planar = t.get(258, (8,))[0], t.get(339, (1,))[0], t.get(284, (1,))[0]
    kind = np.dtype(f"{t[0][0]}{'ui f'[form - 1 if form < 3 else 3]}{bits // 8}")
    unpack = {1: lambda b: b, 5: _lzw, 8: zlib.decompress, 32946: zlib.decompress}[t.get(259, (1,))[0]]
    tiled = 324 in t
    offsets, counts = (t[324], t[325]) if tiled else (t[273], t[279])
    bw, bh = (t[322][0], t[323][0]) if tiled else (w, t.get(278, (h,))[0])
    across, down = -(-w // bw), -(-h // bh)
    per = 1 if planar == 2 else n
    out = np.zeros((n, h, w), kind.newbyteorder("="))
    for k, (o, c) in enumerate(zip(offsets, counts, strict=True)):
        block = np.frombuffer(unpack(data[o : o + c]), kind)
        plane, k = (k // (across * down), k % (across * down)) if planar == 2 else (0, k)
        y, x = k // across * bh, k % across * bw
        rows = len(block) // (bw * per)
        block = block[: rows * bw * per].reshape(rows, bw, per)
        if t.get(317, (1,))[0] == 2:
            block = np.cumsum(block, axis=1, dtype=block.dtype)
        block = block[: h - y, : w - x]
        out[plane : plane + per, y : y + block.shape[0], x : x + block.shape[1]] = np.moveaxis(block, 2, 0)
    return out


def encode(bands: np.ndarray, transform: list[float], epsg: int, nodata: float | None = None) -> bytes:
    """A deflate-compressed GeoTIFF of (bands, height, width) with one strip."""
    n, h, w = bands.shape
    body = zlib.compress(np.ascontiguousarray(np.moveaxis(bands, 0, 2)).tobytes())
    form = {"u": 1, "i": 2, "f": 3}[bands.dtype.kind]
    key = 2048 if epsg == 4326 else 3072
    a, b, c, d, e, f = transform
    entries: list[tuple[int, int, tuple | bytes]] = [
        (256, 4, (w,)), (257, 4, (h,)), (258, 3, (bands.itemsize * 8,) * n), (259, 3, (8,)), (262, 3, (1,)), (273, 4, (8,)), (277, 3, (n,)),
        (278, 4, (h,)), (279, 4, (len(body),)), (339, 3, (form,) * n), (34264, 12, (a, b, 0.0, c, d, e, 0.0, f, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)),
        (34735, 3, (1, 1, 0, 2, 1024, 0, 1, 2 if epsg == 4326 else 1, key, 0, 1, epsg)),
    ]
    if nodata is not None:
        entries.append((42113, 2, f"{nodata:g}".encode() + b"\0"))
    at = 8 + len(body) + len(body) % 2
    extra, table = b"", struct.pack("<H", len(entries))
    base = at + 2 + 12 * len(entries) + 4
    for tag, kind, values in entries:
        raw = values if isinstance(values, bytes) else struct.pack(f"<{len(values)}{_CODES[kind]}", *values)
        if len(raw) > 4:
            table += struct.pack("<HHII", tag, kind, len(values), base + len(extra))
            extra += raw + b"\0" * (len(raw) % 2)
        else:
            table += struct.pack("<HHI", tag, kind, len(values)) + raw.ljust(4, b"\0")
    return struct.pack("<2sHI", b"II", 42, at) + body + b"\0" * (len(body) % 2) + table + struct.pack("<I", 0) + extra


_HEADER = "path string, width int, height int, bands int, transform array<double>, epsg int, nodata double, datetime string, modified timestamp"


def scan(spark: SparkSession, folder: str, *, recursive: bool = True) -> DataFrame:
    """The header of every TIFF below a folder; files that cannot be read, or without a CRS, are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.[tT][iI][fF]*").load(folder)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, modified, content in zip(batch.path, batch.modificationTime, batch.content, strict=True):
                try:
                    h = header(content)
                except Exception:  # not a TIFF after all
                    continue
                if h["epsg"]:
                    rows.append([path, *[h[k] for k in ("width", "height", "bands", "transform", "epsg", "nodata", "datetime")], modified])
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _HEADER.split(", ")])

    return files.select("path", "modificationTime", "content").mapInPandas(run, _HEADER)


def catalogue(headers: DataFrame) -> DataFrame:
    """Catalogue rows of scanned headers: bounds in the file's CRS, pixel size, vendor, modality, time."""
    t = [F.get("transform", F.lit(i)) for i in range(6)]
    name = F.element_at(F.split("path", "/"), -1)
    xs = [t[0] * c + t[1] * r + t[2] for c in (F.lit(0), F.col("width")) for r in (F.lit(0), F.col("height"))]
    ys = [t[3] * c + t[4] * r + t[5] for c in (F.lit(0), F.col("width")) for r in (F.lit(0), F.col("height"))]
    provider, modality = vendor(name, F.col("path"), F.col("bands"))
    return headers.select(
        F.col("path").alias("filepath"), name.alias("filename"), provider.alias("provider"), modality.alias("modality"), "bands", "height", "width",
        F.bround((F.abs(t[0]) + F.abs(t[4])) / 2, 3).alias("gsd_meters"), F.when(F.col("epsg") == 4326, "degree").otherwise("metre").alias("gsd_unit"),
        F.concat(F.lit("EPSG:"), F.col("epsg").cast("string")).alias("crs"), F.coalesce("datetime", acquisition_time(name, modified=F.col("modified"))).alias("ts"),
        F.least(*xs).alias("xmin"), F.least(*ys).alias("ymin"), F.greatest(*xs).alias("xmax"), F.greatest(*ys).alias("ymax"),
    )


def read_pixels(spark: SparkSession, folder: str) -> DataFrame:
    """(path, band, row, values): one row a line of a band, to be exploded where pixels are wanted."""
    return band_lines(spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.[tT][iI][fF]*").load(folder))


def band_lines(files: DataFrame, key: str = "path") -> DataFrame:
    """(key, band, row, values) of files given by their `content`."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch[key], batch.content, strict=True):
                for k, plane in enumerate(read_bands(content)):
                    yield pd.DataFrame({key: name, "band": k, "row": np.arange(len(plane)), "values": list(plane.astype(float))})

    return files.select(key, "content").mapInPandas(run, f"{key} {files.schema[key].dataType.simpleString()}, band int, row long, values array<double>")


def long_pixels(lines: DataFrame, key: str = "path") -> DataFrame:
    return lines.select(key, "band", "row", F.posexplode("values").alias("col", "value"))


def encoded_tiles(pixels: DataFrame, key: str, transform: list[float], epsg: int, *, nodata: float = 0) -> DataFrame:
    """(key, content): each tile of long uint8 pixels (key, band, row, col, value) as a file's bytes."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        bands = np.zeros((int(rows.band.max()) + 1, int(rows.row.max()) + 1, int(rows.col.max()) + 1), np.uint8)
        bands[rows.band, rows.row, rows.col] = rows.value
        return pd.DataFrame({key: [rows[key].iloc[0]], "content": [encode(bands, transform, epsg, nodata)]})

    return pixels.groupBy(key).applyInPandas(run, f"{key} {pixels.schema[key].dataType.simpleString()}, content binary")


def manifest(tiles: DataFrame, path: str) -> None:
    """Writes tiles as JSON lines: filename, row_idx, col_idx, window, padding, world_bounds, transform."""
    tiles.write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Tiles of a manifest in one JSON object with `tiles`, or of JSON lines."""
    raw = spark.read.option("multiLine", True).json(path)
    if "tiles" in raw.columns:
        return raw.select("source_raster", "crs", F.explode("tiles").alias("t")).select("source_raster", "crs", "t.*")
    return spark.read.json(path)


def summary(tiles: DataFrame) -> str:
    return json.dumps(tiles.agg(F.count(F.lit(1)).alias("tiles")).first().asDict())
