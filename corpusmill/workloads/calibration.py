"""Calibration queries: documents are items, labels are the human verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import calibration as O
from corpusmill.workloads.tables import table

KEPT_CHARS = 900


def _scored(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("label"),
        F.col("doc_id").alias("item_id"),
        "n_chars",
        "lang",
        F.least(F.col("n_chars") / 3000, F.lit(1.0)).alias("composite_score"),
    )


def _pool(spark, sf_dir):
    rows = _scored(spark, sf_dir)
    long = F.col("n_chars") >= KEPT_CHARS
    return O.scored_pool(rows.filter(long), rows.filter(~long))


def _ground_truth(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = F.col("n_chars") >= KEPT_CHARS
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        F.col("doc_id").alias("item_id"),
        F.when(F.col("quality") == 1, "good").otherwise("bad").alias("label"),
        F.when(kept, O.KEPT).otherwise(O.REJECTED).alias("source"),
        F.when(~kept, F.col("lang")).alias("reject_reason"),
    )


def scored_pool(spark, sf_dir):
    return _pool(spark, sf_dir).select("label", "item_id", "source", "composite_score")


def _sample(mode):
    def query(spark, sf_dir):
        return O.stratified_sample(_pool(spark, sf_dir), 5, mode).select("label", "item_id", "source", "rn")

    return query


def restricted_sample(spark, sf_dir):
    """Only labels named after a toxic document's source."""
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1 AND quality = 0").join(
        table(spark, sf_dir, "documents"), "doc_id"
    ).select(F.col("source").alias("label"))
    return O.stratified_sample(_pool(spark, sf_dir), 3, "random", toxic).select("label", "item_id", "rn")


def review_pages(spark, sf_dir):
    sample = O.stratified_sample(_pool(spark, sf_dir), 5, "random")
    return O.review_queue(sample, _ground_truth(spark, sf_dir)).select("item_id", "position", "page")


def filter_metrics(spark, sf_dir):
    return O.filter_metrics(_ground_truth(spark, sf_dir))


def reason_metrics(spark, sf_dir):
    return O.metrics_by_reason(_ground_truth(spark, sf_dir))


def scored_truth(spark, sf_dir):
    return O.attach_scores(_ground_truth(spark, sf_dir), _scored(spark, sf_dir)).select(
        "item_id", "label", F.round("composite_score", 6).alias("composite_score")
    )


def _sweep(spark, sf_dir):
    return O.sweep(O.attach_scores(_ground_truth(spark, sf_dir), _scored(spark, sf_dir)))


def threshold_sweep(spark, sf_dir):
    return _sweep(spark, sf_dir)


def threshold_choice(spark, sf_dir):
    return O.recommend(_sweep(spark, sf_dir))


def threshold_curve(spark, sf_dir):
    return O.threshold_curve(O.attach_scores(_ground_truth(spark, sf_dir), _scored(spark, sf_dir)))


QUERIES = {
    "scored_pool": scored_pool,
    "sample_random": _sample("random"),
    "sample_borderline": _sample("borderline"),
    "sample_worst_kept": _sample("worst_kept"),
    "sample_best_rejected": _sample("best_rejected"),
    "restricted_sample": restricted_sample,
    "review_pages": review_pages,
    "filter_metrics": filter_metrics,
    "reason_metrics": reason_metrics,
    "scored_truth": scored_truth,
    "threshold_sweep": threshold_sweep,
    "threshold_choice": threshold_choice,
    "threshold_curve": threshold_curve,
}

POOL_SQL = """
pool AS (SELECT source AS label, doc_id AS item_id, least(n_chars / 3000.0, 1.0) AS composite_score,
                CASE WHEN n_chars >= 900 THEN 'kept' ELSE 'rejected' END AS source FROM documents)
"""

TRUTH_SQL = """
gt AS (SELECT doc_id AS item_id, CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS label,
              CASE WHEN n_chars >= 900 THEN 'kept' ELSE 'rejected' END AS source,
              CASE WHEN n_chars < 900 THEN lang END AS reject_reason, least(n_chars / 3000.0, 1.0) AS score
       FROM labels JOIN documents USING (doc_id))
"""

SWEEP_SQL = """
grid AS (SELECT unnest([0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4]::DOUBLE[]) AS t),
cnt AS (SELECT t, count(*) FILTER (WHERE score >= t AND label = 'good') AS tp,
               count(*) FILTER (WHERE score >= t AND label <> 'good') AS fp,
               count(*) FILTER (WHERE score < t AND label = 'good') AS fn,
               count(*) FILTER (WHERE score < t AND label <> 'good') AS tn
        FROM gt CROSS JOIN grid GROUP BY t),
pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p,
              CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r FROM cnt),
swept AS (SELECT t AS min_composite, tp, fp, fn, tn, round(p, 4) AS "precision", round(r, 4) AS recall,
                 round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 4) AS f1 FROM pr)
"""


def _sample_sql(where: str, order: str) -> str:
    return f"""WITH {POOL_SQL}
      SELECT label, item_id, source, CAST(row_number() OVER (PARTITION BY label ORDER BY {order}, source, item_id) AS INTEGER) AS rn
      FROM pool WHERE {where} QUALIFY rn <= 5"""


ORACLES = {
    "scored_pool": f"WITH {POOL_SQL} SELECT * FROM pool",
    "sample_random": _sample_sql("true", "md5(item_id || ':42')"),
    "sample_borderline": _sample_sql("true", "abs(composite_score - 0.3)"),
    "sample_worst_kept": _sample_sql("source = 'kept'", "composite_score"),
    "sample_best_rejected": _sample_sql("source = 'rejected'", "-composite_score"),
    "restricted_sample": f"""WITH {POOL_SQL}
      SELECT label, item_id, CAST(row_number() OVER (PARTITION BY label ORDER BY md5(item_id || ':42'), source, item_id) AS INTEGER) AS rn
      FROM pool WHERE label IN (SELECT source FROM labels JOIN documents USING (doc_id) WHERE toxic = 1 AND quality = 0)
      QUALIFY rn <= 3""",
    "review_pages": f"""WITH {POOL_SQL},
      s AS (SELECT label, item_id, row_number() OVER (PARTITION BY label ORDER BY md5(item_id || ':42'), source, item_id) AS rn
            FROM pool QUALIFY rn <= 5),
      q AS (SELECT item_id, row_number() OVER (ORDER BY label, rn, item_id) AS position
            FROM s WHERE item_id NOT IN (SELECT doc_id FROM labels))
      SELECT item_id, position, CAST(floor((position - 1) / 12) AS BIGINT) AS page FROM q""",
    "filter_metrics": f"""WITH {TRUTH_SQL},
      c AS (SELECT count(*) FILTER (WHERE source = 'kept' AND label = 'good') AS tp,
                   count(*) FILTER (WHERE source = 'kept' AND label <> 'good') AS fp,
                   count(*) FILTER (WHERE source <> 'kept' AND label = 'good') AS fn,
                   count(*) FILTER (WHERE source <> 'kept' AND label <> 'good') AS tn FROM gt),
      m AS (SELECT *, tp / (tp + fp) AS p, tp / (tp + fn) AS r FROM c)
      SELECT tp, fp, fn, tn, round(p, 4) AS "precision", round(r, 4) AS recall,
             round(2 * p * r / (p + r), 4) AS f1, round(fp / (fp + tp), 4) AS false_positive_rate,
             round(fn / (fn + tn), 4) AS false_negative_rate FROM m""",
    "reason_metrics": f"""WITH {TRUTH_SQL}
      SELECT reject_reason, count(*) AS total, count(*) FILTER (WHERE label = 'good') AS false_negative_count,
             count(*) FILTER (WHERE label <> 'good') AS true_negative_count
      FROM gt WHERE source = 'rejected' AND reject_reason IS NOT NULL GROUP BY reject_reason""",
    "scored_truth": f"WITH {TRUTH_SQL} SELECT item_id, label, round(score, 6) AS composite_score FROM gt",
    "threshold_sweep": f"WITH {TRUTH_SQL}, {SWEEP_SQL} SELECT * FROM swept",
    "threshold_choice": f"""WITH {TRUTH_SQL}, {SWEEP_SQL}
      SELECT min_composite, f1 FROM swept ORDER BY f1 DESC, min_composite LIMIT 1""",
    "threshold_curve": f"""WITH {TRUTH_SQL},
      each_score AS (SELECT score::DOUBLE AS t, count(*) FILTER (WHERE label = 'good') AS g, count(*) FILTER (WHERE label <> 'good') AS b
             FROM gt GROUP BY 1),
      cnt AS (SELECT t, sum(g) OVER (ORDER BY t DESC)::BIGINT AS tp, sum(b) OVER (ORDER BY t DESC)::BIGINT AS fp,
                     (sum(g) OVER () - sum(g) OVER (ORDER BY t DESC))::BIGINT AS fn,
                     (sum(b) OVER () - sum(b) OVER (ORDER BY t DESC))::BIGINT AS tn FROM each_score),
      pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p,
                    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r FROM cnt)
      SELECT t AS min_composite, tp, fp, fn, tn, p AS "precision", r AS recall,
             CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM pr""",
}
