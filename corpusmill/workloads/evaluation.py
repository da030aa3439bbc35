"""Evaluation queries: logits are cosines to all centroids, times ten."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import evaluation as O
from corpusmill.operators import vectors as VO
from corpusmill.plans.ranking import range_rank
from corpusmill.workloads import vectors as VW
from corpusmill.workloads.tables import table

SCALE = 10.0


def logits(spark, sf_dir):
    vecs = VW.vectors(spark, sf_dir)
    return vecs.select(
        "item_id", F.col("label").alias("label_idx"), VO.class_scores(vecs, VO.centroids(vecs)).alias("_s")
    ).select("item_id", "label_idx", F.transform("_s", lambda x: x * SCALE).alias("logits"))


def _label_map(spark, sf_dir):
    """Names of the classes: regions and nations, with some classes unnamed."""
    return table(spark, sf_dir, "nation").filter("n_nationkey < 8").select(
        F.col("n_nationkey").alias("idx"), F.col("n_name").alias("label")
    )


def _full_map(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("idx"), F.col("n_name").alias("label")
    )


def _meta(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("label"),
        F.when(F.col("n_regionkey") < 3, F.concat(F.lit("nom "), F.col("n_nationkey").cast("string"))).alias("french_name"),
    )


def accuracy_and_loss(spark, sf_dir):
    row = O.accuracy_loss(logits(spark, sf_dir))
    return row.withColumns({"loss": F.round("loss", 6), "accuracy": F.round("accuracy", 6)})


def classification_report(spark, sf_dir):
    return O.classification_report(O.predictions(logits(spark, sf_dir)), _label_map(spark, sf_dir))


def confusion_matrix(spark, sf_dir):
    return O.confusion_matrix(O.predictions(logits(spark, sf_dir)))


def confusion_table(spark, sf_dir):
    wide = O.confusion_table(O.confusion_matrix(O.predictions(logits(spark, sf_dir))), range(10))
    return wide.select("truth", *[F.col(str(i)).alias(f"pred_{i}") for i in range(10)])


def loss_outliers(spark, sf_dir):
    named = O.with_class_names(
        O.item_losses(logits(spark, sf_dir)), _label_map(spark, sf_dir),
        {"truth": "label_name", "pred": "predicted_name"},
    )
    return O.loss_outliers(named, 1.5).withColumns({"loss": F.round("loss", 6), "confidence": F.round("confidence", 6)})


def loss_summary(spark, sf_dir):
    row = O.loss_summary(O.item_losses(logits(spark, sf_dir)))
    return row.select("total_items", "sigma_k", "problematic_count", *[F.round(c, 6).alias(c) for c in ("mean_loss", "std_loss", "threshold")])


def top_classes(spark, sf_dir):
    return O.top_k(logits(spark, sf_dir), _label_map(spark, sf_dir), _meta(spark, sf_dir)).withColumn(
        "probability", F.round("probability", 6)
    )


def frame_carry_forward(spark, sf_dir):
    """Events of a user are the frames of a source, in time order; weak ones were dropped on the way.

    A click is a frame in which nothing was recognised.
    """
    frames = range_rank(
        table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value"),
        ["user_id"], [F.col("ts"), F.col("event_id")],
    ).filter("value >= 20").select(
        "event_id", F.col("user_id").alias("source"), (F.col("rn") - 1).alias("frame"),
        F.when(F.col("event_type") != "click", F.col("event_type")).alias("prediction"),
    )
    return O.decimate_and_fill(frames).select("event_id", "source", "frame", "shown", "predicted")


def model_comparison(spark, sf_dir):
    """The logits as they are against logits that favour later classes."""
    base = logits(spark, sf_dir)
    tilted = base.withColumn("logits", F.transform("logits", lambda x, i: x + i * 0.1))
    first = O.top_k(base, _full_map(spark, sf_dir), k=1).withColumn("model", F.lit("plain"))
    second = O.top_k(tilted, _full_map(spark, sf_dir), k=1).withColumn("model", F.lit("tilted"))
    return O.compare_models(first.unionByName(second), ["plain", "tilted"])


def best_checkpoints(spark, sf_dir):
    """Orders are checkpoints: a run per month, an architecture per priority."""
    arch = (
        F.when(F.col("o_orderpriority") == "2-HIGH", "efficientnet_b0")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "mobilenetv2")
        .when(F.col("o_orderpriority") == "5-LOW", "efficientnetv2_b2")
        .otherwise(F.concat(F.lit("other_"), "o_orderpriority"))
    )
    rows = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("run"),
        F.concat(F.lit("best_"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"), F.lit(".pth")).alias("path"),
        arch.alias("arch"),
    )
    return O.best_checkpoint(rows)


def _history(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("run"), (F.dayofmonth("ts") - 1).alias("epoch")
    ).agg(F.round(F.avg("value"), 6).alias("val_loss"))


def early_stops(spark, sf_dir):
    return O.early_stop(_history(spark, sf_dir), patience=5)


def epoch_improvements(spark, sf_dir):
    return O.improvements(_history(spark, sf_dir)).select("run", "epoch", "improved", "stale")


def best_epochs(spark, sf_dir):
    return O.best_epoch(_history(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        accuracy_and_loss, classification_report, confusion_matrix, confusion_table, loss_outliers,
        loss_summary, top_classes, frame_carry_forward, model_comparison, best_checkpoints,
        early_stops, epoch_improvements, best_epochs,
    )
}

LOGITS_SQL = f"""{VW.VECTORS_SQL},
lg AS (SELECT v.vec_id AS item_id, v.label AS truth, c.label AS k, 10 * list_dot_product(v.u, c.c) AS z FROM v CROSS JOIN cents c),
sm AS (SELECT item_id, truth, k, z, exp(z) / sum(exp(z)) OVER (PARTITION BY item_id) AS p FROM lg),
ev AS (SELECT item_id, truth, arg_max(k, z) AS pred, ln(sum(exp(z))) - max(z) FILTER (WHERE k = truth) AS loss, max(p) AS confidence
       FROM sm GROUP BY item_id, truth)
"""

NAME_SQL = "lmap AS (SELECT n_nationkey AS idx, n_name AS label FROM nation WHERE n_nationkey < 8)"

HISTORY_SQL = """
h AS (SELECT event_type AS run, CAST(day(ts) - 1 AS INTEGER) AS epoch, round(avg(value), 6) AS val_loss FROM events GROUP BY 1, 2),
i AS (SELECT *, coalesce(val_loss < min(val_loss) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS improved,
             row_number() OVER (PARTITION BY run ORDER BY epoch) AS seq FROM h),
st AS (SELECT *, seq - max(CASE WHEN improved THEN seq END) OVER (PARTITION BY run ORDER BY epoch) AS stale FROM i)
"""

ORACLES = {
    "accuracy_and_loss": f"""WITH {LOGITS_SQL}
      SELECT count(*) AS items, count(*) FILTER (WHERE pred = truth) AS correct, round(avg(loss), 6) AS loss,
             round(avg(CASE WHEN pred = truth THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM ev""",
    "classification_report": f"""WITH {LOGITS_SQL}, {NAME_SQL},
      c AS (SELECT c, (SELECT count(*) FROM ev WHERE truth = c) AS support, (SELECT count(*) FROM ev WHERE pred = c) AS predicted,
                   (SELECT count(*) FROM ev WHERE truth = c AND pred = c) AS tp
            FROM (SELECT truth AS c FROM ev UNION SELECT pred FROM ev)),
      m AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS p, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS r FROM c),
      f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM m)
      SELECT coalesce(label, 'class_' || c) AS name, round(p, 4) AS "precision", round(r, 4) AS recall, round(f, 4) AS f1, support
      FROM f LEFT JOIN lmap ON idx = c
      UNION ALL SELECT 'accuracy', a, a, a, s FROM (SELECT round(sum(tp) / sum(support), 4) AS a, CAST(sum(support) AS BIGINT) AS s FROM f)
      UNION ALL SELECT 'macro avg', round(avg(p), 4), round(avg(r), 4), round(avg(f), 4), CAST(sum(support) AS BIGINT) FROM f
      UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 4), round(sum(r * support) / sum(support), 4),
                       round(sum(f * support) / sum(support), 4), CAST(sum(support) AS BIGINT) FROM f""",
    "confusion_matrix": f"WITH {LOGITS_SQL} SELECT truth, pred, count(*) AS items FROM ev GROUP BY truth, pred",
    "confusion_table": f"WITH {LOGITS_SQL} SELECT truth, "
    + ", ".join(f"count(*) FILTER (WHERE pred = {i}) AS pred_{i}" for i in range(10))
    + " FROM ev GROUP BY truth",
    "loss_outliers": f"""WITH {LOGITS_SQL}, {NAME_SQL}
      SELECT item_id, round(loss, 6) AS loss, truth, pred, round(confidence, 6) AS confidence, truth = pred AS correct,
             loss > (SELECT avg(loss) + 1.5 * stddev_pop(loss) FROM ev) AS problematic,
             coalesce(a.label, 'class_' || truth) AS label_name, coalesce(b.label, 'class_' || pred) AS predicted_name
      FROM ev LEFT JOIN lmap a ON a.idx = truth LEFT JOIN lmap b ON b.idx = pred""",
    "loss_summary": f"""WITH {LOGITS_SQL}
      SELECT count(*) AS total_items, round(avg(loss), 6) AS mean_loss, round(stddev_pop(loss), 6) AS std_loss,
             round(avg(loss) + 3 * stddev_pop(loss), 6) AS threshold, 3::DOUBLE AS sigma_k,
             count(*) FILTER (WHERE loss > (SELECT avg(loss) + 3 * stddev_pop(loss) FROM ev)) AS problematic_count FROM ev""",
    "top_classes": f"""WITH {LOGITS_SQL},
      t AS (SELECT item_id, k, p, row_number() OVER (PARTITION BY item_id ORDER BY p DESC, k) AS rk FROM sm)
      SELECT item_id, CAST(rk AS INTEGER) AS rank, k AS idx, coalesce(n_name, 'class_' || k) AS label,
             CASE WHEN n_regionkey < 3 THEN 'nom ' || n_nationkey ELSE coalesce(n_name, 'class_' || k) END AS display_name, round(p, 6) AS probability,
             CASE WHEN rk = 1 AND p * 100 > 60 THEN 'high' WHEN rk = 1 AND p * 100 > 30 THEN 'medium' ELSE 'low' END AS band
      FROM t LEFT JOIN nation ON n_nationkey = k AND n_nationkey < 8 WHERE rk <= 5""",
    "frame_carry_forward": """WITH f AS (SELECT event_id, user_id AS source, event_type, value,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame FROM events)
      SELECT event_id, source, frame, frame % 3 = 0 AS predicted,
             last_value(CASE WHEN frame % 3 = 0 AND event_type <> 'click' THEN event_type END IGNORE NULLS)
               OVER (PARTITION BY source ORDER BY frame) AS shown
      FROM f WHERE value >= 20""",
    "model_comparison": f"""WITH {LOGITS_SQL},
      b AS (SELECT item_id, arg_max(k, z) AS a, arg_max(k, z + k * 0.1) AS b FROM lg GROUP BY item_id)
      SELECT item_id, x.n_name AS plain, y.n_name AS tilted, a = b AS agree
      FROM b JOIN nation x ON x.n_nationkey = a JOIN nation y ON y.n_nationkey = b""",
    "best_checkpoints": """WITH c AS (SELECT strftime(o_orderdate, '%Y-%m') AS run, 'best_' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '.pth' AS path,
        CASE o_orderpriority WHEN '2-HIGH' THEN 'efficientnet_b0' WHEN '3-MEDIUM' THEN 'mobilenetv2'
             WHEN '5-LOW' THEN 'efficientnetv2_b2' ELSE 'other_' || o_orderpriority END AS arch FROM orders),
      r AS (SELECT *, CASE arch WHEN 'vit_b_16' THEN 0 WHEN 'efficientnetv2_b2' THEN 1 WHEN 'efficientnet_b0' THEN 2 WHEN 'mobilenetv2' THEN 3 ELSE 4 END AS rk FROM c),
      b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY run ORDER BY rk, path) = 1)
      SELECT run, path, arch, CASE arch WHEN 'efficientnetv2_b2' THEN 'EfficientNetV2-B2' WHEN 'efficientnet_b0' THEN 'EfficientNet-B0'
             WHEN 'mobilenetv2' THEN 'MobileNetV2' ELSE arch END AS display FROM b ORDER BY run DESC LIMIT 4""",
    "early_stops": f"""WITH {HISTORY_SQL},
      s AS (SELECT run, min(epoch) FILTER (WHERE stale >= 5) AS stop_epoch FROM st GROUP BY run)
      SELECT run, stop_epoch, max(epoch) FILTER (WHERE improved AND (stop_epoch IS NULL OR epoch <= stop_epoch)) AS best_epoch
      FROM st JOIN s USING (run) GROUP BY run, stop_epoch""",
    "epoch_improvements": f"WITH {HISTORY_SQL} SELECT run, epoch, improved, stale FROM st",
    "best_epochs": f"""WITH {HISTORY_SQL}
      SELECT run, epoch AS best_epoch, val_loss AS best_value FROM h
      QUALIFY row_number() OVER (PARTITION BY run ORDER BY val_loss, epoch) = 1""",
}
