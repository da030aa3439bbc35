"""Writing item images as PNG files below a folder that every task can reach."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.sources.headers import PNG


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def gray_png(pixels: np.ndarray) -> bytes:
    """A PNG file of rows of gray values below 256."""
    height, width = pixels.shape
    rows = np.zeros((height, 1 + width), np.uint8)  # each row begins with the number of its filter, 0 for none
    rows[:, 1:] = pixels
    header = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return PNG + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(rows.tobytes())) + _chunk(b"IEND", b"")


def _filesystem(root: str) -> tuple[fs.FileSystem, str]:
    parts = urlparse(root)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path)
    return fs.FileSystem.from_uri(root)


def write_gray_images(rows: DataFrame, root: str) -> int:
    """Writes (path, width, pixels, keep) as files; returns how many.

    ``path`` lies below the root, ``pixels`` are row after row, ``keep`` is the share of the
    file's bytes that is written (1: all). A task that runs again writes the same files.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = _filesystem(root)
        made: set[str] = set()
        for batch in batches:
            for row in batch.to_pylist():
                data = gray_png(np.array(row["pixels"], np.uint8).reshape(-1, row["width"]))
                path = f"{top}/{row['path']}"
                folder = path.rsplit("/", 1)[0]
                if folder not in made:
                    files.create_dir(folder, recursive=True)
                    made.add(folder)
                with files.open_output_stream(path) as out:
                    out.write(data[: int(len(data) * row["keep"])])
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    done = rows.select("path", "width", "pixels", "keep").mapInArrow(write, "n bigint")
    return done.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
