"""Header probe and stacked sharpness against decoders and single crops."""

import zlib

import numpy as np
import pandas as pd
import pytest

from corpusmill.operators import quality
from corpusmill.sources import corpus
from corpusmill.sources.headers import HEAD, TAIL, image_size
from corpusmill.sources.images import gray_png


def size(data):
    return image_size(data[:HEAD], data[-TAIL:], len(data))


def encoded(spark, kind, width, height):
    jvm = spark._jvm
    image = jvm.java.awt.image.BufferedImage(width, height, jvm.java.awt.image.BufferedImage.TYPE_INT_RGB)
    for x in range(0, width, 3):
        image.setRGB(x, x % height, 0x80FF10 + x)
    out = jvm.java.io.ByteArrayOutputStream()
    assert jvm.javax.imageio.ImageIO.write(image, kind, out)
    return bytes(out.toByteArray())


@pytest.mark.parametrize("kind", ["png", "jpg", "gif"])
def test_sizes_of_encoded_files(spark, kind):
    data = encoded(spark, kind, 37, 21)
    assert size(data) == (37, 21)
    for cut in (0, 1, 5, 20, len(data) // 2, len(data) - 3):
        assert size(data[:cut]) == (0, 0)


def test_sizes_agree_with_the_decoder(spark, tmp_path):
    for i, kind in enumerate(["png", "jpg", "png", "jpg"]):
        data = encoded(spark, kind, 10 + i, 20 + i)
        folder = tmp_path / "train" / "robin"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{i}.{kind}").write_bytes(data)
        (folder / f"cut{i}.{kind}").write_bytes(data[: len(data) // 2])
    (folder / "empty.png").write_bytes(b"")
    names = ["name", "width", "height"]
    by_header = corpus.probe_items(spark, str(tmp_path)).select(*names).collect()
    decoded = corpus.probe_items(spark, str(tmp_path), keep_pixels=True).select(*names).collect()
    assert {r for r in by_header if "cut" not in r["name"]} == {r for r in decoded if "cut" not in r["name"]}
    assert all(r["width"] == r["height"] == 0 for r in by_header if "cut" in r["name"])
    assert len(by_header) == 8  # Spark passes over empty files


def test_header_beyond_the_first_bytes(spark, tmp_path):
    plain = encoded(spark, "jpg", 40, 30)
    comment = b"\xff\xfe" + (60_000).to_bytes(2, "big") + bytes(59_998)
    data = plain[:2] + comment + plain[2:]
    assert size(data) is None and image_size(data, data[-TAIL:], len(data)) == (40, 30)
    (tmp_path / "train" / "wren").mkdir(parents=True)
    (tmp_path / "train" / "wren" / "far.jpg").write_bytes(data)
    row = corpus.probe_items(spark, str(tmp_path)).first()
    assert (row["width"], row["height"]) == (40, 30)


def webp(kind, body):
    chunk = kind + len(body).to_bytes(4, "little") + body
    return b"RIFF" + (4 + len(chunk)).to_bytes(4, "little") + b"WEBP" + chunk


def test_webp_headers():
    lossy = webp(b"VP8 ", b"\x30\x01\x00\x9d\x01\x2a" + (800).to_bytes(2, "little") + (600 | 1 << 14).to_bytes(2, "little") + bytes(20))
    lossless = webp(b"VP8L", b"\x2f" + (799 | 599 << 14).to_bytes(4, "little") + bytes(20))
    extended = webp(b"VP8X", bytes(4) + (799).to_bytes(3, "little") + (599).to_bytes(3, "little") + bytes(20))
    for data in (lossy, lossless, extended):
        assert size(data) == (800, 600) and size(data[:-4]) == (0, 0)


def test_gray_png_holds_its_pixels():
    pixels = np.arange(64, dtype=np.uint8).reshape(4, 16)
    data = gray_png(pixels)
    at = data.index(b"IDAT")
    rows = np.frombuffer(zlib.decompress(data[at + 4 : -16]), np.uint8).reshape(4, 17)
    assert size(data) == (16, 4) and (rows[:, 1:] == pixels).all() and not rows[:, 0].any()


@pytest.mark.parametrize("limit", [1, 500, 1 << 21])
def test_stacks_equal_single_crops(monkeypatch, limit):
    monkeypatch.setattr(quality, "STACK_PIXELS", limit)
    rng = np.random.default_rng(3)
    images, boxes = [], []
    for i in range(60):
        width, height, channels = (int(rng.integers(a, b)) for a, b in ((3, 6), (3, 6), (1, 4)))
        channels = 1 if channels == 2 else channels
        data = rng.integers(0, 256, width * height * channels, dtype=np.uint8).tobytes()
        images.append((data, None if i == 7 else 0 if i == 8 else width, height, channels))
        boxes.append((0.0, -1.0, float(rng.integers(0, 9)), None if i == 9 else 2.7))
    images = pd.DataFrame(images, columns=["data", "width", "height", "nChannels"])
    boxes = pd.DataFrame(boxes, columns=list("xywh")).astype(float)
    found = quality.crop_variances(images, boxes)
    for i, (image, box) in enumerate(zip(images.itertuples(), boxes.itertuples(index=False), strict=True)):
        bad = i in (7, 8, 9)
        assert found[i] == pytest.approx(0.0 if bad else quality.crop_variance(image.data, int(image.width), image.height, image.nChannels, box))
