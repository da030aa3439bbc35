"""Box and quality queries: orders are images, their line items are detections."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import boxes as O
from corpusmill.operators import quality as Q
from corpusmill.sources import coco
from corpusmill.workloads.tables import table

KEY = ("item_id",)


def items(spark, sf_dir):
    """Images; cheap pending orders cannot be read (0 x 0)."""
    broken = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 100000)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("label"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".jpg")).alias("name"),
        F.col("o_orderkey").alias("item_id"),
        F.when(broken, 0).otherwise(400 + F.col("o_orderkey") * 37 % 900).alias("width"),
        F.when(broken, 0).otherwise(300 + F.col("o_orderkey") * 53 % 700).alias("height"),
        (F.col("o_totalprice") / 1000).alias("sharpness"),
    )


def detections(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS item_id",
        "((l_linenumber * 1000000 + l_partkey) * 10000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT) AS det_idx",
        "l_partkey % 500 - 30 + l_discount AS x1",
        "l_suppkey * 7 % 400 - 20 + l_tax AS y1",
        "l_partkey % 500 - 30 + l_discount + l_quantity * 12.5D AS x2",
        "l_suppkey * 7 % 400 - 20 + l_tax + l_extendedprice / 150 AS y2",
        "(l_suppkey * 31 + l_linenumber * 17 + l_partkey * 7) % 1000 / 1000.0D AS score",
    )


def _clipped(spark, sf_dir, ratio=0.01):
    return O.clip_boxes(detections(spark, sf_dir), items(spark, sf_dir), ratio, KEY)


def annotations(spark, sf_dir, ratio=0.05):
    """Boxes below 5 % of the image are too small for the first pass."""
    return O.best_detection(_clipped(spark, sf_dir, ratio), items(spark, sf_dir), keys=KEY)


def _flat(df, *more):
    return df.select("item_id", *[F.col(f"bbox.{c}").alias(c) for c in "xywh"], "score", *more)


def clipped_boxes(spark, sf_dir):
    return _flat(_clipped(spark, sf_dir), "det_idx")


def best_detections(spark, sf_dir):
    return _flat(annotations(spark, sf_dir))


def annotation_rollup(spark, sf_dir):
    return O.annotation_rollup(annotations(spark, sf_dir))


def pending_items(spark, sf_dir):
    """Priorities whose finished orders exceed half a million are done."""
    done = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F' AND o_totalprice > 499900").select(
        F.col("o_orderpriority").alias("label")
    )
    return O.pending(items(spark, sf_dir), done).select("label", "item_id")


def missing_detections(spark, sf_dir):
    return O.missing_detections(annotations(spark, sf_dir)).select("label", "name")


def _retried(spark, sf_dir):
    second = O.best_detection(_clipped(spark, sf_dir, 0.001), keys=KEY)
    return O.retry_merge(annotations(spark, sf_dir), second, 0.15, KEY)


def retry_merge(spark, sf_dir):
    return _flat(_retried(spark, sf_dir), "retry_threshold", "recovered")


def retry_stats(spark, sf_dir):
    return O.retry_stats(_retried(spark, sf_dir))


def review_sample(spark, sf_dir):
    return O.review_sample(annotations(spark, sf_dir), items(spark, sf_dir), 7, 4).select(
        "label", "name", "missing"
    )


def first_names(spark, sf_dir):
    return O.first_n(items(spark, sf_dir), 10).select("label", "name", "rn")


def random_label_items(spark, sf_dir):
    return O.random_labels(items(spark, sf_dir), 2).select("label", "name")


def _validated(spark, sf_dir):
    """Finished orders were validated earlier."""
    return table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(
        F.col("o_orderpriority").alias("label"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".jpg")).alias("name"),
        F.struct(*[F.lit(v).cast("bigint").alias(c) for c, v in zip("xywh", (1, 2, 30, 40))]).alias("bbox"),
        F.lit("accepted").alias("status"),
    )


def _decisions(spark, sf_dir):
    """Line items are decisions on their order's image, in det_idx order."""
    box = F.struct(
        (F.col("l_partkey") % 500).alias("x"), (F.col("l_suppkey") % 400).alias("y"),
        F.col("l_quantity").cast("bigint").alias("w"), F.lit(9).cast("bigint").alias("h"),
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_returnflag") == "R", "reject").when(F.col("l_returnflag") == "N", "correct")
        .when(F.col("l_linestatus") == "O", "accept").otherwise("skip").alias("action"),
        box.alias("bbox"),
        (((F.col("l_linenumber") * 1000000 + F.col("l_partkey")) * 10000 + F.col("l_suppkey")) * 100
         + F.col("l_quantity").cast("bigint")).alias("seq"),
    )
    return lines.join(items(spark, sf_dir), F.col("l_orderkey") == F.col("item_id")).select(
        "label", "name", "action", "bbox", "seq"
    )


def validation_queue(spark, sf_dir):
    return O.validation_queue(items(spark, sf_dir), _validated(spark, sf_dir), 25).select("label", "name")


def applied_decisions(spark, sf_dir):
    rows = O.apply_decisions(_validated(spark, sf_dir), _decisions(spark, sf_dir))
    return rows.select("label", "name", F.col("bbox.x").alias("x"), F.col("bbox.w").alias("w"), "status")


def validation_stats(spark, sf_dir):
    return O.validation_stats(O.apply_decisions(_validated(spark, sf_dir), _decisions(spark, sf_dir)))


def normalised_drags(spark, sf_dir):
    """A detection's corners dragged the wrong way round."""
    drags = detections(spark, sf_dir).join(items(spark, sf_dir), "item_id").filter("width > 0").select(
        "item_id", "det_idx", F.col("x2").alias("x1"), F.col("y1"), F.col("x1").alias("x2"),
        F.least(F.col("y2"), F.col("y1") + F.col("score") * 40).alias("y2"), "width", "height",
    )
    return O.normalise_drag(drags).select(
        "item_id", "det_idx", *[F.col(f"bbox.{c}").alias(c) for c in "xywh"]
    )


def annotation_qa(spark, sf_dir):
    expected = items(spark, sf_dir).withColumn("subjects", F.when(F.col("width") > 600, 1).otherwise(0))
    return O.annotation_qa(_clipped(spark, sf_dir), expected, KEY)


def small_boxes(spark, sf_dir):
    return O.small_boxes(annotations(spark, sf_dir), items(spark, sf_dir), 8.0, KEY)


def quality_scores(spark, sf_dir):
    return Q.score_items(items(spark, sf_dir), annotations(spark, sf_dir).filter("score > 0.1")).select(
        "label", "name", *Q.COLUMNS
    )


def coco_images(spark, sf_dir):
    return coco.coco_export(items(spark, sf_dir), _named(spark, sf_dir))[0]


def coco_annotations(spark, sf_dir):
    rows = coco.coco_export(items(spark, sf_dir), _named(spark, sf_dir))[1]
    return rows.select(
        "label", "id", "image_id", "category_id", *[F.col("bbox")[i].alias(c) for i, c in enumerate("xywh")],
        "area", "score", "iscrowd",
    )


def _named(spark, sf_dir):
    return _clipped(spark, sf_dir).join(items(spark, sf_dir).select("item_id", "label", "name"), "item_id")


QUERIES = {
    f.__name__: f
    for f in (
        clipped_boxes, best_detections, annotation_rollup, pending_items, missing_detections, retry_merge,
        retry_stats, review_sample, first_names, random_label_items, validation_queue, applied_decisions,
        validation_stats, normalised_drags, annotation_qa, small_boxes, quality_scores, coco_images,
        coco_annotations,
    )
}

IMAGES_SQL = """
img AS (SELECT o_orderkey AS item_id, o_orderpriority AS label, o_orderkey || '.jpg' AS name, o_totalprice / 1000 AS sharpness,
               CASE WHEN o_orderstatus = 'P' AND o_totalprice < 100000 THEN 0 ELSE 400 + o_orderkey * 37 % 900 END AS width,
               CASE WHEN o_orderstatus = 'P' AND o_totalprice < 100000 THEN 0 ELSE 300 + o_orderkey * 53 % 700 END AS height
        FROM orders),
det AS (SELECT l_orderkey AS item_id,
               ((l_linenumber * 1000000 + l_partkey) * 10000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT) AS det_idx,
               l_partkey % 500 - 30 + l_discount AS x1, l_suppkey * 7 % 400 - 20 + l_tax AS y1,
               l_partkey % 500 - 30 + l_discount + l_quantity * 12.5::DOUBLE AS x2,
               l_suppkey * 7 % 400 - 20 + l_tax + l_extendedprice / 150 AS y2,
               CAST((l_suppkey * 31 + l_linenumber * 17 + l_partkey * 7) % 1000 AS DOUBLE) / 1000 AS score FROM lineitem),
cut AS (SELECT *, greatest(x1, 0) AS x, greatest(y1, 0) AS y FROM det JOIN img USING (item_id)),
sized AS (SELECT *, least(x2, width) - x AS bw, least(y2, height) - y AS bh FROM cut),
boxed AS (SELECT item_id, label, name, det_idx, round(score, 4) AS score, width, height, bw * bh / (width * height) AS raw_ratio,
                 CAST(round_even(x, 0) AS BIGINT) AS x, CAST(round_even(y, 0) AS BIGINT) AS y,
                 CAST(round_even(bw, 0) AS BIGINT) AS w, CAST(round_even(bh, 0) AS BIGINT) AS h
          FROM sized WHERE bw > 0 AND bh > 0)
"""


def _best_sql(name: str, ratio: float) -> str:
    return f"""
{name}_r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY w * h / (width * height) <= 0.5 DESC,
               CASE WHEN w * h / (width * height) <= 0.5 THEN w * h ELSE score END DESC, det_idx) AS rn
        FROM boxed WHERE raw_ratio >= {ratio}),
{name} AS (SELECT i.item_id, i.label, i.name, i.width, i.height, i.sharpness, b.x, b.y, b.w, b.h, b.score
        FROM img i LEFT JOIN {name}_r b ON b.item_id = i.item_id AND b.rn = 1)
"""


def _exact_round(column: str, digits: int) -> str:
    """Half-even rounding of the exact binary value by the formatter, not by the operator's arithmetic."""
    return f"CAST(format('{{:.{digits}f}}', {column}) AS DOUBLE)"


ANN_SQL = f"{IMAGES_SQL}, {_best_sql('ann', 0.05)}"
RETRY_SQL = f"""{ANN_SQL}, {_best_sql('ann2', 0.001)},
merged AS (SELECT a.item_id, coalesce(a.x, b.x) AS x, coalesce(a.y, b.y) AS y, coalesce(a.w, b.w) AS w, coalesce(a.h, b.h) AS h,
                  coalesce(a.score, b.score) AS score, CASE WHEN a.x IS NULL AND b.x IS NOT NULL THEN 0.15 END::DOUBLE AS retry_threshold,
                  a.x IS NULL AND b.x IS NOT NULL AS recovered
           FROM ann a JOIN ann2 b USING (item_id))
"""

DECISIONS_SQL = """
dec AS (SELECT l_orderkey AS item_id, l_partkey % 500 AS x, CAST(l_quantity AS BIGINT) AS w,
               CASE WHEN l_returnflag = 'R' THEN 'rejected' WHEN l_returnflag = 'N' THEN 'corrected'
                    WHEN l_linestatus = 'O' THEN 'accepted' END AS status,
               ((l_linenumber * 1000000 + l_partkey) * 10000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT) AS seq FROM lineitem),
lastd AS (SELECT * FROM dec WHERE status IS NOT NULL AND item_id IN (SELECT o_orderkey FROM orders)
          QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY seq DESC) = 1),
val AS (SELECT o_orderpriority AS label, o_orderkey || '.jpg' AS name,
               CASE WHEN l.item_id IS NULL THEN 1 WHEN status <> 'rejected' THEN x END AS x,
               CASE WHEN l.item_id IS NULL THEN 30 WHEN status <> 'rejected' THEN w END AS w,
               coalesce(status, 'accepted') AS status
        FROM orders LEFT JOIN lastd l ON l.item_id = o_orderkey WHERE o_orderstatus = 'F' OR l.item_id IS NOT NULL)
"""

COCO_SQL = f"""{IMAGES_SQL},
ci AS (SELECT label, name, item_id, width, height, row_number() OVER (PARTITION BY label ORDER BY name) AS id FROM img)
"""

ORACLES = {
    "clipped_boxes": f"WITH {IMAGES_SQL} SELECT item_id, x, y, w, h, score, det_idx FROM boxed WHERE raw_ratio >= 0.01",
    "best_detections": f"WITH {ANN_SQL} SELECT item_id, x, y, w, h, score FROM ann",
    "annotation_rollup": f"""WITH {ANN_SQL}
      SELECT label, count(*) AS items, count(x) AS detected, round(count(x) / count(*) * 100, 1) AS pct FROM ann GROUP BY ROLLUP (label)""",
    "pending_items": """SELECT o_orderpriority AS label, o_orderkey AS item_id FROM orders WHERE o_orderpriority NOT IN
      (SELECT o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 499900)""",
    "missing_detections": f"WITH {ANN_SQL} SELECT label, name FROM ann WHERE x IS NULL",
    "retry_merge": f"WITH {RETRY_SQL} SELECT * FROM merged",
    "retry_stats": f"""WITH {RETRY_SQL}
      SELECT count(*) FILTER (WHERE recovered OR x IS NULL) AS retried, count(*) FILTER (WHERE recovered) AS recovered,
             count(*) FILTER (WHERE x IS NULL) AS still_missing FROM merged""",
    "review_sample": f"""WITH {ANN_SQL},
      p AS (SELECT label, name, width, x IS NULL AS missing,
                   row_number() OVER (PARTITION BY label, x IS NULL ORDER BY md5(name || ':42'), name) AS rn FROM ann)
      SELECT label, name, missing FROM p WHERE rn <= CASE WHEN missing THEN 4 ELSE 7 END AND width > 0""",
    "first_names": f"""WITH {IMAGES_SQL}
      SELECT label, name, CAST(row_number() OVER (PARTITION BY label ORDER BY name) AS INTEGER) AS rn FROM img QUALIFY rn <= 10""",
    "random_label_items": f"""WITH {IMAGES_SQL},
      l AS (SELECT DISTINCT label FROM img ORDER BY md5(label || ':42'), label LIMIT 2)
      SELECT label, name FROM img WHERE label IN (SELECT label FROM l)""",
    "validation_queue": """SELECT o_orderpriority AS label, o_orderkey || '.jpg' AS name FROM orders WHERE o_orderstatus <> 'F'
      QUALIFY row_number() OVER (PARTITION BY label ORDER BY md5(o_orderkey || '.jpg:42'), o_orderkey || '.jpg') <= 25""",
    "applied_decisions": f"WITH {DECISIONS_SQL} SELECT label, name, x, w, status FROM val",
    "validation_stats": f"""WITH {DECISIONS_SQL}
      SELECT count(*) AS total_validated, count(*) FILTER (WHERE status = 'corrected') AS total_corrected,
             count(*) FILTER (WHERE status = 'rejected') AS total_rejected FROM val""",
    "normalised_drags": f"""WITH {IMAGES_SQL},
      d AS (SELECT item_id, det_idx, width, height, x1, x2, y1, least(y2, y1 + score * 40) AS y2 FROM det JOIN img USING (item_id) WHERE width > 0),
      c AS (SELECT *, greatest(0, least(x1, x2)) AS x, greatest(0, least(y1, y2)) AS y FROM d),
      s AS (SELECT *, least(abs(x2 - x1), width - x) AS w, least(abs(y2 - y1), height - y) AS h FROM c)
      SELECT item_id, det_idx, CAST(round_even(x, 0) AS BIGINT) AS x, CAST(round_even(y, 0) AS BIGINT) AS y,
             CAST(round_even(w, 0) AS BIGINT) AS w, CAST(round_even(h, 0) AS BIGINT) AS h FROM s WHERE w >= 5 AND h >= 5""",
    "annotation_qa": f"""WITH {IMAGES_SQL},
      k AS (SELECT *, w * h / (width * height) AS r FROM boxed WHERE raw_ratio >= 0.01),
      q AS (SELECT (SELECT count(*) FROM img WHERE width > 600 AND item_id IN (SELECT item_id FROM k))
                   / (SELECT count(*) FROM img WHERE width > 600) AS rate,
                   (SELECT count(*) FROM k WHERE r > 0.95) AS giant, (SELECT count(*) FROM k WHERE r < 0.01) AS micro,
                   (SELECT avg(score) FROM k) AS mean)
      SELECT 'detection_rate' AS rule, round(rate, 4) AS value, rate >= 0.7 AS passed FROM q
      UNION ALL SELECT 'giant_boxes', giant, giant = 0 FROM q UNION ALL SELECT 'micro_boxes', micro, micro = 0 FROM q
      UNION ALL SELECT 'mean_score', round(mean, 4), mean > 0.6 FROM q""",
    "small_boxes": f"WITH {ANN_SQL} SELECT item_id FROM ann WHERE x IS NOT NULL AND w * h / (width * height) * 100 < 8",
    "quality_scores": f"""WITH {ANN_SQL},
      u AS (SELECT *, coalesce(score > 0.1 AND width > 0, false) AS ok, w * h / (width * height) * 100 AS pct FROM ann),
      k AS (SELECT *, 0.3::DOUBLE * least(score, 1) + 0.4::DOUBLE * least(pct / 30, 1) + 0.3::DOUBLE * least(sharpness / 500, 1) AS comp FROM u)
      SELECT label, name, CASE WHEN ok THEN {_exact_round("score", 4)} ELSE 0 END AS detection_score,
             CASE WHEN ok THEN {_exact_round("pct", 4)} ELSE 0 END AS bbox_pct,
             CASE WHEN ok THEN {_exact_round("sharpness", 2)} ELSE 0 END AS sharpness,
             CASE WHEN ok THEN {_exact_round("comp", 4)} ELSE 0 END AS composite_score FROM k""",
    "coco_images": f"WITH {COCO_SQL} SELECT label, id, name AS file_name, width, height FROM ci",
    "coco_annotations": f"""WITH {COCO_SQL}
      SELECT b.label, row_number() OVER (PARTITION BY b.label ORDER BY ci.id, det_idx) AS id, ci.id AS image_id, 1 AS category_id,
             x, y, w, h, w * h AS area, score, 0 AS iscrowd
      FROM boxed b JOIN ci USING (item_id) WHERE raw_ratio >= 0.01""",
}
