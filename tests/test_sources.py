"""Files in and out: images, annotations, labels, reports, manifests."""

import json
import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import boxes, quality
from corpusmill.sources import annotations as A
from corpusmill.sources import catalog, coco, corpus, embeddings, labels, manifests, reports, truth


def png(path, pixels):
    """Write an RGB array as a PNG file."""
    height, width, _ = pixels.shape
    raw = b"".join(b"\0" + pixels[i].astype(np.uint8).tobytes() for i in range(height))

    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    base = str(tmp_path_factory.mktemp("corpus"))
    rng = np.random.default_rng(1)
    for split, label, name in [("train", "robin", "1.png"), ("train", "robin", "2 b.PNG"), ("test", "wren", "3.png")]:
        png(f"{base}/{split}/{label}/{name}", rng.integers(0, 256, (40, 64, 3)))
    png(f"{base}/other/wren/9.png", rng.integers(0, 256, (4, 4, 3)))
    with open(f"{base}/train/robin/bad.jpg", "wb") as f:
        f.write(b"not an image")
    with open(f"{base}/train/robin/annotations.json", "w") as f:
        json.dump({"1.png": {"bbox": [10, 10, 40, 20], "score": 0.95}, "2 b.PNG": None}, f, indent=2)
    return base


def test_scan_and_probe(spark, root):
    names = {(r["split"], r["label"], r["name"]) for r in corpus.scan_items(spark, root).collect()}
    assert names == {("train", "robin", "1.png"), ("train", "robin", "2 b.PNG"), ("train", "robin", "bad.jpg"), ("test", "wren", "3.png")}
    sizes = {r["name"]: (r["width"], r["height"]) for r in corpus.probe_items(spark, root).collect()}
    assert sizes == {"1.png": (64, 40), "2 b.PNG": (64, 40), "3.png": (64, 40), "bad.jpg": (0, 0)}


def test_annotations_round_trip(spark, root, tmp_path):
    rows = A.read_annotations(spark, root)
    found = {r["name"]: r for r in rows.collect()}
    assert found["1.png"]["bbox"].asDict() == {"x": 10.0, "y": 10.0, "w": 40.0, "h": 20.0}
    assert found["2 b.PNG"]["bbox"] is None and found["2 b.PNG"]["label"] == "robin"
    A.write_annotations(rows, f"{tmp_path}/ann", per_object=1)
    again = A.read_written_annotations(spark, f"{tmp_path}/ann").select(*rows.columns)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.collect()))
    A.write_missing(rows, f"{tmp_path}/missing")
    assert [r[0] for r in spark.read.text(f"{tmp_path}/missing").collect()] == ["robin/2 b.PNG"]


def test_sharpness_and_scores_of_images(spark, root):
    items = corpus.probe_items(spark, root, keep_pixels=True)
    scored = quality.score_items(items, A.read_annotations(spark, root))
    got = {r["name"]: r for r in scored.collect()}
    assert len(got) == 4 and got["2 b.PNG"]["composite_score"] == 0 and got["bad.jpg"]["sharpness"] == 0
    best = got["1.png"]
    assert best["bbox_pct"] == 31.25 and best["sharpness"] > 500 and best["composite_score"] == round(0.3 * 0.95 + 0.4 + 0.3, 4)


def test_laplacian_against_loops():
    rng = np.random.default_rng(2)
    gray = rng.integers(0, 256, (5, 7)).astype(float)
    h, w = gray.shape
    mirror = lambda i, n: -i if i < 0 else 2 * n - 2 - i if i >= n else i
    out = [[sum(gray[mirror(y + dy, h), mirror(x + dx, w)] for dy, dx in ((0, 1), (1, 0), (0, -1), (-1, 0))) - 4 * gray[y, x]
            for x in range(w)] for y in range(h)]
    assert abs(quality.laplacian_variance(gray) - np.var(out)) < 1e-9
    assert quality.crop_variance(bytes(12), 2, 2, 3, (5, 5, 4, 4)) == 0.0
    assert quality.crop_variance(bytes(12), 2, 2, 3, (0, 0, 2, 2)) == 0.0


def test_label_documents(spark, tmp_path):
    label_map = spark.createDataFrame([("b", 1), ("a", 0)], "label string, idx int")
    labels.write_label_map(label_map, f"{tmp_path}/map")
    assert sorted(labels.read_label_map(spark, f"{tmp_path}/map").collect()) == [("a", 0), ("b", 1)]
    meta = spark.createDataFrame(
        [("a", "A a", "Fam", None, "nom")],
        "label string, scientific_name string, family string, english_name string, french_name string",
    )
    labels.write_label_metadata(meta, f"{tmp_path}/meta")
    assert labels.read_label_metadata(spark, f"{tmp_path}/meta").collect() == meta.collect()


def test_catalog_and_embeddings(spark, tmp_path):
    for name, schema in catalog.SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/cat/{name}")
    taxa, observations, photos = catalog.read_catalog(spark, f"{tmp_path}/cat")
    assert "ancestry" in taxa.columns and "observed_on" in observations.columns and photos.count() == 0
    vecs = spark.createDataFrame([("train", "a", "1", [1.0]), ("train", "a", "2", [])], "split string, label string, item_id string, embedding array<float>")
    embeddings.write_embeddings(vecs, f"{tmp_path}/emb")
    assert [r["item_id"] for r in embeddings.read_embeddings(spark, f"{tmp_path}/emb").collect()] == ["1"]


def test_coco_numbers(spark, tmp_path):
    items = spark.createDataFrame([("a", "x.jpg", 10, 10), ("a", "b.jpg", 0, 0)], "label string, name string, width int, height int")
    dets = spark.createDataFrame(
        [("a", "x.jpg", 2, (1, 1, 3, 2), 0.5), ("a", "x.jpg", 1, (0, 0, 4, 4), 0.6)],
        "label string, name string, det_idx int, bbox struct<x:bigint,y:bigint,w:bigint,h:bigint>, score double",
    )
    tables = coco.coco_export(items, dets)
    assert sorted((r["id"], r["file_name"], r["width"]) for r in tables[0].collect()) == [(1, "b.jpg", 0), (2, "x.jpg", 10)]
    assert sorted((r["id"], r["image_id"], r["area"]) for r in tables[1].collect()) == [(1, 2, 16), (2, 2, 6)]
    coco.write_coco(tables, f"{tmp_path}/coco")
    assert spark.read.json(f"{tmp_path}/coco/categories").first()["name"] == "bird"


def test_coco_makes_its_detections_once(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    items = spark.createDataFrame([("a", f"{i:03d}.jpg", 10, 10) for i in range(50)], "label string, name string, width int, height int")
    dets = items.selectExpr(
        "label", "name", "explode(array(1, 2)) AS det_idx",
        "named_struct('x', 1L, 'y', 1L, 'w', 3L, 'h', 2L) AS bbox", "0.5D AS score",
    )
    rows = coco.coco_export(items, dets.mapInArrow(counted, dets.schema))[1]
    assert sorted((r["id"], r["image_id"]) for r in rows.collect()) == [(i + 1, i // 2 + 1) for i in range(100)]
    assert made.value == 100


def test_reports(spark, tmp_path):
    items = spark.createDataFrame(
        [("a", f"{i}.jpg", "good", 0.2, {"good": 0.2}, 0.1, i == 1) for i in range(5)],
        "label string, item_id string, category string, confidence double, scores map<string,double>, distance double, is_outlier boolean",
    )
    summary = spark.createDataFrame([("a", 5, 5)], "label string, total bigint, good bigint")
    reports.write_report(f"{tmp_path}/flat", items, summary)
    flat = reports.read_report(spark, f"{tmp_path}/flat")
    assert flat["items"].agg(F.sum("composite_score")).first()[0] == 0 and flat["duplicates"].count() == 0
    dups = spark.createDataFrame([("a", "0.jpg", "4.jpg", 0.97)], "label string, kept string, removed string, similarity double")
    nested = reports.nested_report(reports.with_quality(items), summary, dups, per_object=2)
    nested.write.json(f"{tmp_path}/nested")
    back = reports.read_nested_report(spark, f"{tmp_path}/nested")
    assert back["items"].count() == 5 and back["items"].filter("is_outlier").count() == 1
    assert back["duplicates"].first()["removed"] == "4.jpg" and back["summary"].first()["summary"]["total"] == 5
    os.makedirs(f"{tmp_path}/old")
    with open(f"{tmp_path}/old/robin.json", "w") as f:
        json.dump({"summary": {"total": 1}, "images": {"1.jpg": {"category": "good", "confidence": 0.2, "scores": {}}}}, f, indent=2)
    old = reports.read_nested_report(spark, f"{tmp_path}/old", lines=False)
    row = old["items"].first()
    assert row["label"] == "robin" and row["composite_score"] == 0.0 and row["is_outlier"] is False


def test_manifest_resume(spark, tmp_path):
    plan = lambda: spark.createDataFrame(
        [("a", 1, 2, 1, 0, [("europe", 5, "JPG")])], manifests.ROW)
    first = manifests.plan_or_resume(spark, f"{tmp_path}/m", plan, 10)
    again = manifests.plan_or_resume(spark, f"{tmp_path}/m", lambda: 1 / 0, 10)
    assert first.select("label", "photos").collect() == again.select("label", "photos").collect()
    with open(f"{tmp_path}/doc.json", "w") as f:
        json.dump({"created": "x", "target": 3, "species": {"a": {"scientific_name": "A", "existing": 1, "needed": 2, "found_europe": 1,
                   "found_worldwide": 0, "photos": [{"photo_id": 5, "extension": "jpg", "source": "europe"}]}}}, f, indent=2)
    row = manifests.read_manifest_document(spark, f"{tmp_path}/doc.json").first()
    assert row["photos"][0]["photo_id"] == 5 and row["photos"][0]["source"] == "europe" and row["target"] == 3


def test_truth_last_write_wins(spark, tmp_path):
    old = spark.createDataFrame([("p", "bad", "kept", "s", None, 0)], truth.TRUTH)
    new = spark.createDataFrame([("p", "good", "kept", "s", None, 2), ("p", "bad", "kept", "s", None, 1)], truth.TRUTH)
    truth.write_ground_truth(truth.add_labels(old, new), f"{tmp_path}/gt")
    assert [r["label"] for r in truth.read_ground_truth(spark, f"{tmp_path}/gt").collect()] == ["good"]


def test_unknown_image_size_lets_the_score_decide(spark):
    dets = spark.createDataFrame(
        [("a", "x", 0, (0, 0, 9, 9), 0.4, None, None), ("a", "x", 1, (0, 0, 2, 2), 0.7, None, None),
         ("a", "y", 0, (0, 0, 5, 5), 0.4, 10, 10), ("a", "y", 1, (1, 1, 5, 5), 0.7, 10, 10), ("a", "y", 2, (0, 0, 9, 9), 0.9, 10, 10)],
        "label string, name string, det_idx int, bbox struct<x:bigint,y:bigint,w:bigint,h:bigint>, score double, width int, height int",
    )
    got = {r["name"]: r["score"] for r in boxes.best_detection(dets).collect()}
    assert got == {"x": 0.7, "y": 0.4}


def test_one_layout_at_every_size(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", "1", (1.0, 2.0, 3.0, 4.0), 0.5), ("a", "2", None, None), ("b", "3", None, None)],
        "label string, name string, bbox struct<x:double,y:double,w:double,h:double>, score double",
    )
    for per_object, parts in ((1, 2), (100, 1)):
        A.write_annotations(rows, path := f"{tmp_path}/ann{per_object}", ["label"], per_object)
        assert all(p.startswith("part=") for p in os.listdir(f"{path}/label=b") if "=" in p)
        assert len(A.read_written_annotations(spark, path).collect()) == 3
        assert len([p for p in os.listdir(f"{path}/label=a") if "=" in p]) <= parts


def test_label_document_is_one_json_object(spark, tmp_path):
    names = ['q"uote', "back\\slash", "é", "a b"]
    label_map = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "label string, idx int")
    for rows in (label_map, label_map.filter("idx < 0")):
        labels.write_label_map(rows, f"{tmp_path}/map", "overwrite")
        (file,) = [f for f in os.listdir(f"{tmp_path}/map") if f.startswith("part-")]
        with open(f"{tmp_path}/map/{file}", encoding="utf-8") as f:
            assert json.load(f) == {r["label"]: r["idx"] for r in rows.collect()}
        assert sorted(labels.read_label_map(spark, f"{tmp_path}/map").collect()) == sorted(rows.collect())


def test_interrupted_manifest_is_planned_again(spark, tmp_path):
    plan = lambda: spark.createDataFrame([("a", 1, 2, 1, 0, [("europe", 5, "JPG")])], manifests.ROW)
    manifests.write_manifest(plan().limit(0), f"{tmp_path}/m", 10)
    os.rename(f"{tmp_path}/m/_SUCCESS", f"{tmp_path}/kept-marker")
    assert manifests.plan_or_resume(spark, f"{tmp_path}/m", plan, 10).count() == 1
    manifests.write_manifest_document(plan(), f"{tmp_path}/doc", 7)
    row = manifests.read_manifest_document(spark, f"{tmp_path}/doc").first()
    assert (row["label"], row["needed"], row["found_primary"], row["target"]) == ("a", 2, 1, 7) and row["photos"][0]["photo_id"] == 5
