"""Sizes of images from their headers, without decoding a pixel.

Readable is a file whose header states a size and whose end is there: the last
chunk of a PNG, the end marker of a JPEG, the trailer of a GIF, the counted
bytes of a WebP. A file that was cut off counts as unreadable.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEAD = 4096
TAIL = 64
SIZE = T.StructType([T.StructField(c, T.IntegerType()) for c in ("width", "height")])

PNG = b"\x89PNG\r\n\x1a\n"
PNG_END = b"IEND\xaeB`\x82"
JPEG_END = b"\xff\xd9"
# Markers C0 to CF open a frame, but for tables (C4, CC) and the reserved C8.
FRAMES = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}
# Markers without a length: TEM and the restarts.
BARE = frozenset([0x01, *range(0xD0, 0xD8)])

UNREADABLE = (0, 0)


def _jpeg(head: bytes, whole: bool) -> tuple[int, int] | None:
    """Size of the first frame; None if it lies beyond the bytes that are known."""
    at = 2
    while at + 9 <= len(head):
        if head[at] != 0xFF:
            return UNREADABLE
        marker = head[at + 1]
        if marker == 0xFF:
            at += 1
        elif marker in BARE:
            at += 2
        elif marker in FRAMES:
            return int.from_bytes(head[at + 7 : at + 9], "big"), int.from_bytes(head[at + 5 : at + 7], "big")
        elif marker in (0xD9, 0xDA):
            return UNREADABLE
        else:
            at += 2 + max(2, int.from_bytes(head[at + 2 : at + 4], "big"))
    return UNREADABLE if whole else None


def _webp(head: bytes) -> tuple[int, int]:
    kind = head[12:16]
    if kind == b"VP8X" and len(head) >= 30:
        return 1 + int.from_bytes(head[24:27], "little"), 1 + int.from_bytes(head[27:30], "little")
    if kind == b"VP8L" and len(head) >= 25 and head[20] == 0x2F:
        bits = int.from_bytes(head[21:25], "little")
        return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
    if kind == b"VP8 " and head[23:26] == b"\x9d\x01\x2a" and len(head) >= 30:
        return int.from_bytes(head[26:28], "little") & 0x3FFF, int.from_bytes(head[28:30], "little") & 0x3FFF
    return UNREADABLE


def image_size(head: bytes, tail: bytes, length: int) -> tuple[int, int] | None:
    """(width, height) of a file from its first and last bytes; 0 x 0 if unreadable, None if more bytes are needed."""
    found: tuple[int, int] | None = UNREADABLE
    if head.startswith(PNG):
        if head[12:16] == b"IHDR" and tail.endswith(PNG_END):
            found = int.from_bytes(head[16:20], "big"), int.from_bytes(head[20:24], "big")
    elif head.startswith(b"\xff\xd8"):
        if JPEG_END in tail:
            found = _jpeg(head, len(head) >= length)
    elif head[:6] in (b"GIF87a", b"GIF89a"):
        if tail.rstrip(b"\0").endswith(b";"):
            found = int.from_bytes(head[6:8], "little"), int.from_bytes(head[8:10], "little")
    elif head[:4] == b"RIFF" and head[8:12] == b"WEBP" and int.from_bytes(head[4:8], "little") + 8 <= length:
        found = _webp(head)
    return UNREADABLE if found and 0 in found else found


@F.pandas_udf(SIZE)
def _sizes(head: pd.Series, tail: pd.Series, length: pd.Series) -> pd.DataFrame:
    found = [
        (None if h is None else image_size(bytes(h), bytes(t), int(n))) or (None, None)
        for h, t, n in zip(head, tail, length, strict=True)
    ]
    return pd.DataFrame(found, columns=["width", "height"]).astype("Int32")


def size_columns(content: Column, length: Column) -> dict[str, Column]:
    """width and height of binary files; the few whose header is longer than ``HEAD`` send all their bytes."""
    tail = F.substring(content, -TAIL, TAIL)
    near = _sizes(F.substring(content, 1, HEAD), F.when(length > TAIL, tail).otherwise(content), length)
    far = _sizes(F.when(near["width"].isNull(), content), tail, length)
    return {c: F.coalesce(near[c], far[c], F.lit(0)) for c in ("width", "height")}
