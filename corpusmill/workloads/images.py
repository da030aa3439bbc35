"""Image queries: PNG files of 16 x 4 gray pixels made from embedding rows, below the shared checkpoint folder.

Some files are cut off, some lie in no split, some have another extension.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusmill.operators import quality
from corpusmill.plans.lineage import ensure_checkpoint_dir
from corpusmill.sources import corpus
from corpusmill.sources.images import write_gray_images
from corpusmill.workloads.tables import table

WIDTH, HEIGHT = 16, 4


def written_images(spark, sf_dir) -> str:
    """The folder of the written files."""
    root = f"{ensure_checkpoint_dir(spark)}/images-{uuid.uuid4().hex}"
    key = F.col("vec_id")
    split = F.when(key % 17 == 0, "staged").when(key % 5 == 0, "test").otherwise("train")
    name = F.concat(key.cast("string"), F.when(key % 13 == 0, ".txt").otherwise(".png"))
    gray = F.transform("embedding", lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor(x.cast("double") * 64 + 128))))
    rows = table(spark, sf_dir, "embeddings").select(
        F.concat_ws("/", split, F.col("label").cast("string"), name).alias("path"),
        F.lit(WIDTH).alias("width"),
        gray.alias("pixels"),
        F.when(key % 11 == 0, 0.5).otherwise(1.0).alias("keep"),
    )
    write_gray_images(rows, root)
    return root


def scanned_images(spark, sf_dir):
    return corpus.scan_items(spark, written_images(spark, sf_dir)).select("split", "label", "name")


def probed_images(spark, sf_dir):
    """Sizes from the headers; files that were cut off have 0 x 0."""
    found = corpus.probe_items(spark, written_images(spark, sf_dir))
    return found.select("split", "label", "name", "width", "height")


def image_sharpness(spark, sf_dir):
    """Sharpness of a box in every decoded image, clipped at its right edge."""
    items = corpus.probe_items(spark, written_images(spark, sf_dir), keep_pixels=True)
    key = F.regexp_extract("name", r"^(\d+)", 1).cast("bigint")
    boxed = items.withColumn("item_id", key).withColumn(
        "bbox",
        F.struct(
            (F.col("item_id") % 13).alias("x"), (F.col("item_id") % 2).alias("y"),
            (3 + F.col("item_id") % 6).alias("w"), (2 + F.col("item_id") % 2).alias("h"),
        ),
    )
    return boxed.select("label", "item_id", F.round(quality.crop_sharpness(), 4).alias("sharpness"))


QUERIES = {"scanned_images": scanned_images, "probed_images": probed_images, "image_sharpness": image_sharpness}

ITEMS_SQL = """
items AS (SELECT CASE WHEN vec_id % 5 = 0 THEN 'test' ELSE 'train' END AS split, label::VARCHAR AS label,
                 vec_id || '.png' AS name, vec_id, vec_id % 11 = 0 AS cut_off,
                 list_transform(embedding, lambda x: greatest(0, least(255, floor(x::DOUBLE * 64 + 128)))) AS p
          FROM embeddings WHERE vec_id % 17 <> 0 AND vec_id % 13 <> 0)
"""

ORACLES = {
    "scanned_images": f"WITH {ITEMS_SQL} SELECT split, label, name FROM items",
    "probed_images": f"""WITH {ITEMS_SQL}
      SELECT split, label, name, CASE WHEN cut_off THEN 0 ELSE 16 END AS width, CASE WHEN cut_off THEN 0 ELSE 4 END AS height
      FROM items""",
    "image_sharpness": f"""WITH {ITEMS_SQL},
      box AS (SELECT *, vec_id % 13 AS x, vec_id % 2 AS y, least(16 - vec_id % 13, 3 + vec_id % 6) AS w, 2 + vec_id % 2 AS h FROM items),
      rows_of AS (SELECT *, unnest(range(h)) AS r FROM box),
      cells AS (SELECT *, unnest(range(w)) AS c FROM rows_of),
      near AS (SELECT *, CASE WHEN r = 0 THEN 1 ELSE r - 1 END AS up, CASE WHEN r = h - 1 THEN h - 2 ELSE r + 1 END AS down,
                      CASE WHEN c = 0 THEN 1 ELSE c - 1 END AS before, CASE WHEN c = w - 1 THEN w - 2 ELSE c + 1 END AS after
               FROM cells),
      response AS (SELECT label, vec_id, cut_off,
                          p[1 + 16 * (y + up) + x + c] + p[1 + 16 * (y + down) + x + c] + p[1 + 16 * (y + r) + x + before]
                            + p[1 + 16 * (y + r) + x + after] - 4 * p[1 + 16 * (y + r) + x + c] AS v
                   FROM near)
      SELECT label, vec_id AS item_id, round(CASE WHEN bool_or(cut_off) THEN 0 ELSE var_pop(v) END, 4) AS sharpness
      FROM response GROUP BY label, vec_id""",
}
