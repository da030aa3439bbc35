"""Training-set queries over documents (label = source or language)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import trainset as O
from corpusmill.operators.catalog import dense_label_map
from corpusmill.workloads.splits import _corpus
from corpusmill.workloads.tables import table


def _label_map(spark, sf_dir):
    """Sources in order; the last of them is unknown to the map."""
    sources = table(spark, sf_dir, "documents").filter("source <> 'src9'")
    return dense_label_map(sources.select(F.col("source").alias("label")))


def training_samples(spark, sf_dir):
    items, annotations = _corpus(spark, sf_dir)
    boxed = annotations.withColumn("bbox", F.col("score"))
    return O.samples(items, _label_map(spark, sf_dir), boxed).select("label", "name", "label_idx", "bbox")


def unknown_labels(spark, sf_dir):
    return O.unknown_labels(_corpus(spark, sf_dir)[0], _label_map(spark, sf_dir))


def _flawed_map(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("label"), (F.col("n_nationkey") * 3 % 23).alias("idx")
    )


def label_map_check(spark, sf_dir):
    return O.validate_label_map(_flawed_map(spark, sf_dir))


def label_map_problems(spark, sf_dir):
    return O.label_map_problems(_flawed_map(spark, sf_dir))


def _by_language(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.col("lang").alias("label"), F.col("doc_id").alias("item_id")
    )


def class_weights(spark, sf_dir):
    """Source and language of toxic documents, weighted against all of them."""
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").join(
        table(spark, sf_dir, "documents"), "doc_id"
    ).select(F.concat_ws("_", "source", "lang").alias("label"))
    whole = table(spark, sf_dir, "documents").select(F.concat_ws("_", "source", "lang").alias("label"))
    return O.class_weights(toxic, dense_label_map(whole)).withColumn("weight", F.round("weight", 6))


def balanced_resample(spark, sf_dir):
    return O.balanced_resample(_by_language(spark, sf_dir))


def calibration_sample(spark, sf_dir):
    return O.calibration_sample(_by_language(spark, sf_dir), 200)


def label_coverage(spark, sf_dir):
    return O.coverage(_corpus(spark, sf_dir)[0], _label_map(spark, sf_dir))


def corrupt_accounting(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(
        F.col("source").alias("label"),
        F.when(F.col("n_chars") >= 500, F.col("n_chars")).otherwise(0).alias("width"),
    )
    return O.corrupt_accounting(rows)


QUERIES = {
    f.__name__: f
    for f in (
        training_samples, unknown_labels, label_map_check, label_map_problems, class_weights,
        balanced_resample, calibration_sample, label_coverage, corrupt_accounting,
    )
}

MAP_SQL = """
lm AS (SELECT source AS label, CAST(row_number() OVER (ORDER BY source) - 1 AS INTEGER) AS idx
       FROM (SELECT DISTINCT source FROM documents WHERE source <> 'src9'))
"""

FLAWED_SQL = "fm AS (SELECT n_nationkey * 3 % 23 AS idx FROM nation)"

ORACLES = {
    "training_samples": f"""WITH {MAP_SQL}
      SELECT source AS label, doc_id || '.jpg' AS name, idx AS label_idx,
             CASE WHEN n_chars >= 500 THEN 0.5::DOUBLE END AS bbox FROM documents JOIN lm ON source = label""",
    "unknown_labels": "SELECT source AS label, count(*) AS items FROM documents WHERE source = 'src9' GROUP BY source",
    "label_map_check": f"""WITH {FLAWED_SQL}
      SELECT count(*) AS labels, count(DISTINCT idx) AS distinct_indices, min(idx) AS min_index, max(idx) AS max_index,
             count(DISTINCT idx) = count(*) AND min(idx) = 0 AND max(idx) = count(*) - 1 AS valid FROM fm""",
    "label_map_problems": f"""WITH {FLAWED_SQL}
      SELECT CAST(idx AS BIGINT) AS idx, 'duplicate' AS problem FROM fm GROUP BY idx HAVING count(*) > 1
      UNION ALL
      SELECT i, 'missing' FROM (SELECT unnest(range(count(*))) AS i FROM fm) WHERE i NOT IN (SELECT idx FROM fm)""",
    "class_weights": """WITH a AS (SELECT DISTINCT source || '_' || lang AS label FROM documents),
      m AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS idx FROM a),
      c AS (SELECT source || '_' || lang AS label, count(*) AS items FROM labels JOIN documents USING (doc_id)
            WHERE toxic = 1 GROUP BY 1)
      SELECT label, idx, coalesce(items, 0) AS items, CASE WHEN items > 0 THEN round(1 / items, 6) ELSE 0 END AS weight
      FROM m LEFT JOIN c USING (label)""",
    "balanced_resample": """WITH rk AS (
        SELECT lang AS label, doc_id AS item_id,
               row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id || ':42'), doc_id) AS rn FROM documents),
      cl AS (SELECT label, max(rn) AS n, row_number() OVER (ORDER BY label) - 1 AS k FROM rk GROUP BY label),
      dr AS (SELECT doc_id AS draw_id, md5('draw:' || doc_id || ':42') AS h FROM documents),
      pk AS (SELECT draw_id, ('0x' || substr(h, 1, 8))::BIGINT % (SELECT count(*) FROM cl) AS k,
                    ('0x' || substr(h, 9, 15))::BIGINT AS r FROM dr)
      SELECT draw_id, cl.label, rk.item_id FROM pk JOIN cl USING (k) JOIN rk ON rk.label = cl.label AND rk.rn = r % n + 1""",
    "calibration_sample": """SELECT lang AS label, doc_id AS item_id FROM documents
      ORDER BY md5(doc_id || ':42'), doc_id LIMIT 200""",
    "label_coverage": f"""WITH {MAP_SQL},
      c AS (SELECT CASE lang WHEN 'en' THEN 'train' WHEN 'fr' THEN 'validation' ELSE 'test' END AS split, source FROM documents)
      SELECT split, count(*) AS items, count(DISTINCT source) AS labels_with_items, (SELECT count(*) FROM lm) AS labels_in_map
      FROM c JOIN lm ON source = label GROUP BY split""",
    "corrupt_accounting": """SELECT source AS label, count(*) FILTER (WHERE n_chars >= 500) AS readable,
      count(*) FILTER (WHERE n_chars < 500) AS corrupted FROM documents GROUP BY source""",
}
