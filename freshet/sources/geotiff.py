"""GeoTIFF tiles to pixel tables and back: first band, strips or tiles, plain, deflate or LZW, predictor 2."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.session import ensure_importable

_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
_CODES = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d"}
HEADER = "name string, width int, height int, gt array<double>, crs string, nodata double, dtype string, bands int"


def _entries(data: bytes) -> tuple[str, dict[int, tuple]]:
    order = "<" if data[:2] == b"II" else ">"
    at = struct.unpack_from(order + "I", data, 4)[0]
    out = {}
    for i in range(struct.unpack_from(order + "H", data, at)[0]):
        tag, kind, n = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
        size, place = _SIZES[kind] * n, at + 10 + 12 * i
        if size > 4:
            place = struct.unpack_from(order + "I", data, place)[0]
        if kind == 2:
            out[tag] = (data[place : place + n].split(b"\0")[0].decode("latin-1"),)
        elif kind in _CODES:
            out[tag] = struct.unpack_from(f"{order}{n}{_CODES[kind]}", data, place)
    return order, out


def _lzw(data: bytes) -> bytes:
    table = [bytes([i]) for i in range(256)] + [b"", b""]
    out, width, last, buffer, bits = [], 9, None, 0, 0
    for byte in data:
        buffer, bits = buffer << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, buffer = buffer >> bits, buffer & ((1 << bits) - 1)
        if code == 256:
            table, width, last = table[:258], 9, None
            continue
        if code == 257:
            break
        word = table[code] if code < len(table) else last + last[:1]
        out.append(word)
        if last is not None:
            table.append(last + word[:1])
        last = word
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return b"".join(out)


def header(name: str, data: bytes) -> dict:
    order, e = _entries(data)
    kind = {1: "uint", 2: "int", 3: "float"}[e.get(339, (1,))[0]]
    scale, tie = e.get(33550, (1.0, 1.0, 0.0)), e.get(33922, (0.0,) * 6)
    keys = e.get(34735, ())
    codes = {keys[i]: keys[i + 3] for i in range(4, len(keys), 4)}
    epsg = codes.get(3072) or codes.get(2048)
    nodata = e.get(42113, ("",))[0].strip()
    return {
        "name": name, "width": e[256][0], "height": e[257][0], "gt": [tie[3] - tie[0] * scale[0], scale[0], 0.0, tie[4] + tie[1] * scale[1], 0.0, -scale[1]],
        "crs": f"EPSG:{epsg}" if epsg else None, "nodata": float(nodata) if nodata else None, "dtype": f"{kind}{e.get(258, (8,))[0]}", "bands": e.get(277, (1,))[0],
    }


def blocks(data: bytes) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, column, pixels) of each block of the first band."""
    order, e = _entries(data)
    width, height, bands = e[256][0], e[257][0], e.get(277, (1,))[0]
    kind = {1: "u", 2: "i", 3: "f"}[e.get(339, (1,))[0]]
    dtype = np.dtype(f"{order}{kind}{e.get(258, (8,))[0] // 8}")
    chunky = e.get(284, (1,))[0] == 1
    if 322 in e:
        bw, bh, offsets, sizes = e[322][0], e[323][0], e[324], e[325]
    else:
        bw, bh, offsets, sizes = width, min(e.get(278, (height,))[0], height), e[273], e[279]
    across = -(-width // bw)
    for k in range(across * -(-height // bh)):
        raw = data[offsets[k] : offsets[k] + sizes[k]]
        how = e.get(259, (1,))[0]
        raw = raw if how == 1 else _lzw(raw) if how == 5 else zlib.decompress(raw) if how in (8, 32946) else None
        if raw is None:
            raise ValueError(f"TIFF compression {how} is not supported")
        n = bands if chunky else 1
        rows = len(raw) // (bw * n * dtype.itemsize)
        a = np.frombuffer(raw, dtype=dtype, count=rows * bw * n).reshape(rows, bw, n)
        if e.get(317, (1,))[0] == 2:
            a = np.cumsum(a, axis=1, dtype=a.dtype.newbyteorder("="))
        r, c = k // across * bh, k % across * bw
        yield r, c, a[: height - r, : width - c, 0].astype(a.dtype.newbyteorder("="))


def _files(spark: SparkSession, path: str) -> DataFrame:
    ensure_importable(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tif").load(path).select("path", "content")
    if not files.inputFiles():
        raise FileNotFoundError(f"no *.tif under {path}")
    return files


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row for each tile: ``name, width, height, gt, crs, nodata, dtype, bands``; ``FileNotFoundError`` if there is
    no tile."""
    files = _files(spark, path)

    def rows(batches):
        for pdf in batches:
            yield pd.DataFrame([header(p.rsplit("/", 1)[-1], bytes(b)) for p, b in zip(pdf["path"], pdf["content"])])

    return files.mapInPandas(rows, HEADER)


def read_pixels(spark: SparkSession, path: str) -> DataFrame:
    """``tile, row, col, value, minx, miny, maxx, maxy`` of every pixel of every tile under ``path``; ``tile`` numbers
    the file by its path, and ``row, col`` count within it (:func:`on_grid` counts over all tiles). A task holds one block at a time beside its file. ``FileNotFoundError`` if there is no tile."""
    files = _files(spark, path)

    def rows(batches):
        for pdf in batches:
            for p, b in zip(pdf["path"], pdf["content"]):
                gt = header(p, bytes(b))["gt"]
                for r, c, a in blocks(bytes(b)):
                    row, col = np.mgrid[r : r + a.shape[0], c : c + a.shape[1]].reshape(2, -1)
                    x, y = gt[0] + col * gt[1], gt[3] + row * gt[5]
                    yield pd.DataFrame({"path": p, "row": row.astype("int32"), "col": col.astype("int32"), "value": a.reshape(-1).astype(float), "minx": x, "miny": y + gt[5], "maxx": x + gt[1], "maxy": y})

    out = files.mapInPandas(rows, "path string, row int, col int, value double, minx double, miny double, maxx double, maxy double")
    return out.withColumn("tile", F.xxhash64("path"))


def on_grid(pixels: DataFrame, gt: list[float]) -> DataFrame:
    """Pixels of tiles with ``row`` and ``col`` in the grid that ``gt`` describes, as :func:`write_tiles` takes them."""
    row, col = F.round((F.col("maxy") - gt[3]) / gt[5]), F.round((F.col("minx") - gt[0]) / gt[1])
    return pixels.withColumns({"row": row.cast("int"), "col": col.cast("int")})


def write_tiles(pixels: DataFrame, path: str, gt: list[float], side: int = 1024, dtype: str = "uint8", epsg: int = 4326, nodata: float = 0) -> None:
    """``row, col, value`` pixels as one-band GeoTIFFs of ``side`` by ``side`` pixels under ``path``, written through
    the Hadoop file system that ``path`` names. Places without a pixel, and null values, are ``nodata``; of repeated
    pixels the greatest counts. Tiles are made by tasks, one each, and come to the driver one by one."""
    spark = ensure_importable(pixels.sparkSession)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)

    def tile(table: pa.Table) -> pa.Table:
        top, left = table["tr"][0].as_py(), table["tc"][0].as_py()
        image = np.full((side, side), nodata, dtype=dtype)
        some = table.filter(pc.is_valid(table["value"]))
        order = np.argsort(some["value"].to_numpy(), kind="stable")
        image[some["row"].to_numpy()[order] - top * side, some["col"].to_numpy()[order] - left * side] = some["value"].to_numpy()[order]
        place = [gt[0] + left * side * gt[1], gt[1], 0.0, gt[3] + top * side * gt[5], 0.0, gt[5]]
        return pa.table({"name": [f"tile-{top}-{left}.tif"], "content": pa.array([encode(image, place, epsg, nodata)], pa.binary())})

    placed = pixels.select(F.floor(F.col("row") / side).alias("tr"), F.floor(F.col("col") / side).alias("tc"), F.col("row").cast("long"), F.col("col").cast("long"), F.col("value").cast("double"))
    tiles = placed.groupBy("tr", "tc").applyInArrow(tile, "name string, content binary")
    for row in tiles.toLocalIterator():  # one tile at a time: Spark has no writer of files by name
        out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(spark._jvm.org.apache.hadoop.fs.Path(target, row["name"]), True)
        out.write(bytes(row["content"]))
        out.close()


def encode(pixels: np.ndarray, gt: list[float], epsg: int = 4326, nodata: float | None = 0, block: int = 256) -> bytes:
    """A deflated, tiled, one-band GeoTIFF."""
    height, width = pixels.shape
    code = {"u": 1, "i": 2, "f": 3}[pixels.dtype.kind]
    tiles = []
    for r in range(0, height, block):
        for c in range(0, width, block):
            part = np.zeros((block, block), dtype=pixels.dtype.newbyteorder("<"))
            cut = pixels[r : r + block, c : c + block]
            part[: cut.shape[0], : cut.shape[1]] = cut
            tiles.append(zlib.compress(part.tobytes()))
    keys = (1, 1, 0, 3, 1024, 0, 1, 2 if epsg == 4326 else 1, 1025, 0, 1, 1, 2048 if epsg == 4326 else 3072, 0, 1, epsg)
    fields = [
        (256, "I", (width,)), (257, "I", (height,)), (258, "H", (pixels.dtype.itemsize * 8,)), (259, "H", (8,)), (262, "H", (1,)), (277, "H", (1,)),
        (322, "H", (block,)), (323, "H", (block,)), (324, "I", tuple(0 for _ in tiles)), (325, "I", tuple(map(len, tiles))), (339, "H", (code,)),
        (33550, "d", (gt[1], -gt[5], 0.0)), (33922, "d", (0.0, 0.0, 0.0, gt[0], gt[3], 0.0)), (34735, "H", keys),
    ]
    if nodata is not None:
        fields.append((42113, "s", (f"{nodata:g}".encode() + b"\0",)))
    kinds = {"H": 3, "I": 4, "d": 12, "s": 2}
    extra_at = 8 + 2 + 12 * len(fields) + 4
    sizes = [len(v[0]) if k == "s" else struct.calcsize(f"<{len(v)}{k}") for _, k, v in fields]
    data_at = extra_at + sum(s + s % 2 for s in sizes if s > 4)
    places = np.concatenate(([0], np.cumsum([len(t) for t in tiles])[:-1])) + data_at
    out, extra = [struct.pack("<2sHI", b"II", 42, 8), struct.pack("<H", len(fields))], []
    for (tag, k, v), size in zip(fields, sizes):
        if tag == 324:
            v = tuple(int(x) for x in places)
        raw = v[0] if k == "s" else struct.pack(f"<{len(v)}{k}", *v)
        out.append(struct.pack("<HHI", tag, kinds[k], len(raw) if k == "s" else len(v)))
        if size > 4:
            out.append(struct.pack("<I", extra_at))
            extra.append(raw + b"\0" * (size % 2))
            extra_at += size + size % 2
        else:
            out.append(raw.ljust(4, b"\0"))
    return b"".join([*out, struct.pack("<I", 0), *extra, *tiles])
