"""dBase III tables and shapefile polygons, read through Spark and decoded in Arrow batches.

Files come by Spark's own reader, so any path that the cluster can read will do, a folder of files as well, and no task opens a
path itself. A task that holds a file cuts it at record bounds; the pieces are dealt out by their bytes and decoded as whole columns.
Spark holds a file as one value, of 2 GB at most, which is also what a dBase offset reaches.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

PIECE = 4 << 20         # bytes of records decoded at a time
LONGEST_HEADER = 33 + 32 * 255
POLYGONS = (5, 15, 25)  # shapes with rings: plain, with heights, with measures
EDGES = "record_number long, ring int, x1 double, y1 double, x2 double, y2 double"
LITTLE_INT, DOUBLE = np.dtype("<i4"), np.dtype("<f8")


def contents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _dealt(pieces: DataFrame, spark: SparkSession) -> DataFrame:
    """Pieces of one file spread over as many tasks as a shuffle has, so that none decodes a file alone."""
    return pieces.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


# ---- dBase III ----

def dbf_header(raw: bytes) -> tuple[int, int, int, list[tuple[str, str, int, int]]]:
    """(records, header length, record length, [(name, type, width, decimals)])."""
    if len(raw) < 33:
        raise ValueError("a dBase file ends in its header")
    n, header_len, record_len = struct.unpack("<IHH", raw[4:12])
    fields = []
    for at in range(32, min(header_len - 1, len(raw) - 31), 32):
        d = raw[at:at + 32]
        if d[:1] == b"\r":
            break
        fields.append((d[:11].split(b"\0")[0].decode("ascii").lower(), chr(d[11]), d[16], d[17]))
    return n, header_len, record_len, fields


def dbf_type(kind: str, decimals: int) -> str:
    if kind in "NF":
        return "double" if decimals or kind == "F" else "long"
    return {"L": "boolean", "D": "date"}.get(kind, "string")


def _whole(text: str) -> int:
    number = Decimal(text)
    if number % 1:
        raise ValueError(f"{text} in a field of whole numbers")
    return int(number)


def dbf_column(cells: np.ndarray, kind: str, decimals: int) -> pa.Array:
    """One field of many records, each a row of bytes, as a column. Blank numbers, stars and blank dates are missing; blank text is text."""
    raw = np.ascontiguousarray(cells).view(f"S{cells.shape[1]}").ravel() if cells.shape[1] else np.zeros(len(cells), "S1")
    texts = np.char.strip(np.char.strip(np.char.decode(raw, "latin-1")), "\0") if len(raw) else np.zeros(0, "U1")
    if kind in "NF":
        column = pa.array(texts, pa.string(), mask=np.char.replace(texts, "*", "") == "")
        if decimals or kind == "F":
            return pc.cast(column, pa.float64())
        try:
            return pc.cast(column, pa.int64())
        except pa.ArrowInvalid:     # 12.0 is a whole number as well, 12.5 is not
            return pa.array([None if t is None else _whole(t) for t in column.to_pylist()], pa.int64())
    column = pa.array(texts, pa.string())
    if kind == "L":
        upper = pc.utf8_upper(column)
        yes, no = pc.is_in(upper, pa.array(["T", "Y"])), pc.is_in(upper, pa.array(["F", "N"]))
        return pc.if_else(pc.or_(yes, no), yes, pa.scalar(None, pa.bool_()))
    if kind == "D":
        days = pc.if_else(pc.equal(column, ""), pa.scalar(None, pa.string()), column)
        return pc.cast(pc.strptime(days, "%Y%m%d", "s"), pa.date32())
    return column


def _cut_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            raw = memoryview(content.as_buffer())
            n, header_len, record_len, _ = dbf_header(bytes(raw[:LONGEST_HEADER]))
            if header_len + n * record_len > len(raw):
                raise ValueError(f"{path.as_py()} ends before record {(len(raw) - header_len) // max(record_len, 1) + 1} of {n}")
            step = max(1, PIECE // max(record_len, 1))
            for first in range(0, n, step):
                piece = bytes(raw[header_len + first * record_len:header_len + min(first + step, n) * record_len])
                yield pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([piece], pa.binary())], names=["first", "piece"])


def _decoded(fields: list[tuple[str, str, int, int]], record_len: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, piece in zip(batch.column("first").to_pylist(), batch.column("piece"), strict=True):
                rows = np.frombuffer(piece.as_buffer(), np.uint8).reshape(-1, record_len)
                there = np.flatnonzero(rows[:, 0] != ord("*"))      # others are deleted
                columns, at = [pa.array(first + there)], 1
                for _, kind, width, decimals in fields:
                    columns.append(dbf_column(rows[there, at:at + width], kind, decimals))
                    at += width
                yield pa.RecordBatch.from_arrays(columns, names=["record_number", *[f[0] for f in fields]])
    return run


def read_dbf(spark: SparkSession, path: str) -> DataFrame:
    """The records of a dBase file, or of the files of a folder that have the same fields: columns in lower case, the number of the record
    in its file first. A file that is shorter than it says stops the job, as does a fraction in a field of whole numbers."""
    files = contents(spark, path)
    heads = [dbf_header(bytes(r["head"])) for r in files.select(F.substring("content", 1, LONGEST_HEADER).alias("head")).distinct().collect()]
    shapes = {(h[2], tuple(h[3])) for h in heads}
    if len(shapes) != 1:
        raise ValueError(f"{path} holds {len(shapes)} kinds of dBase files")
    record_len, fields = shapes.pop()
    schema = "record_number long, " + ", ".join(f"`{n}` {dbf_type(k, d)}" for n, k, _, d in fields)
    pieces = files.mapInArrow(_cut_records, "first long, piece binary")
    return _dealt(pieces, spark).mapInArrow(_decoded(list(fields), record_len), schema)


# ---- shapefile polygons ----

def _cut_rings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of points of one ring each; neighbouring stretches share a point."""
    step = max(1, PIECE // 16)
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            raw = memoryview(content.as_buffer())
            if len(raw) < 100 or struct.unpack(">i", raw[:4])[0] != 9994:
                raise ValueError(f"{path.as_py()} is no shapefile")
            end, at, number = struct.unpack(">i", raw[24:28])[0] * 2, 100, 0
            while at + 8 <= end:
                start, at = at + 8, at + 8 + struct.unpack(">i", raw[at + 4:at + 8])[0] * 2
                if at > len(raw):
                    raise ValueError(f"{path.as_py()} ends before the end of shape {number + 1}")
                if at > start and struct.unpack("<i", raw[start:start + 4])[0] in POLYGONS:
                    n_rings, n_points = struct.unpack("<ii", raw[start + 36:start + 44])
                    points = start + 44 + 4 * n_rings
                    bounds = np.append(np.frombuffer(raw, LITTLE_INT, n_rings, start + 44), n_points)
                    rows = [(ring, a, min(a + step, int(last) - 1)) for ring, (first, last) in enumerate(zip(bounds, bounds[1:], strict=False))
                            for a in range(int(first), int(last) - 1, step)]
                    if rows:
                        yield pa.RecordBatch.from_arrays([
                            pa.array([number] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int32()),
                            pa.array([bytes(raw[points + 16 * a:points + 16 * (b + 1)]) for _, a, b in rows], pa.binary())], names=["record_number", "ring", "piece"])
                number += 1


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, ring, piece in zip(batch.column("record_number"), batch.column("ring"), batch.column("piece"), strict=True):
            xy = np.frombuffer(piece.as_buffer(), DOUBLE).reshape(-1, 2)
            n = len(xy) - 1
            ends = [xy[:-1, 0], xy[:-1, 1], xy[1:, 0], xy[1:, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, number.as_py(), np.int64)), pa.array(np.full(n, ring.as_py(), np.int32)),
                                              *[pa.array(np.ascontiguousarray(e)) for e in ends]], names=["record_number", "ring", "x1", "y1", "x2", "y2"])


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """The edges of every ring of every polygon of a shapefile, or of those of a folder, with the number of the shape in its file."""
    pieces = contents(spark, path).mapInArrow(_cut_rings, "record_number long, ring int, piece binary")
    return _dealt(pieces, spark).mapInArrow(_edges, EDGES)


def national_grid(description: str) -> bool:
    """Whether the outermost reference system of a description is the British National Grid, by its name or its code."""
    name = re.match(r'\s*PROJ(?:CS|CRS)\s*\[\s*"([^"]*)"', description)
    named = name is not None and re.sub(r"[^a-z]", "", name[1].lower()).endswith("britishnationalgrid")
    return named or re.search(r'(?:AUTHORITY\s*\[\s*"EPSG"\s*,\s*"27700"\s*\]|ID\s*\[\s*"EPSG"\s*,\s*27700\s*\])\s*\]\s*$', description) is not None


def description_of(spark: SparkSession, path: str) -> str:
    """The text beside a layer that names its reference system; empty if there is none."""
    folder, _, name = os.path.splitext(path)[0].rpartition("/")
    glob = re.sub(r"([\[\]{}*?\\])", r"\\\1", name) + ".prj"
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder or ".").select("content").head(1)
    return bytes(found[0]["content"]).decode("latin-1") if found else ""


def read_layer(spark: SparkSession, path: str, version) -> tuple[DataFrame, list[str], int | None]:
    """The edges of one classification layer with its two codes, the attribute columns found, and the
    reference system's code if its description names the British National Grid."""
    attributes = read_dbf(spark, os.path.splitext(path)[0] + ".dbf")
    found = {c.lower(): c for c in attributes.columns}
    names = [c for c in (version.sixfold, version.eightfold) if c.lower() in found]
    codes = attributes.select("record_number", *[
        (F.col(c.lower()).cast("int") if c.lower() in found else F.lit(None).cast("int")).alias(n)
        for c, n in ((version.sixfold, "sixfold"), (version.eightfold, "eightfold"))])
    # A layer has eight polygons by contract, so its codes are the small side of this join.
    out = codes.join(read_edges(spark, path), "record_number", "left").select(
        F.lit(version.key).alias("version"), F.col("record_number").alias("poly"), "sixfold", "eightfold", "ring", "x1", "y1", "x2", "y2")
    return out, names, 27700 if national_grid(description_of(spark, path)) else None
