"""Verdict queries: the embedding signals turned into keep/reject decisions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusmill.operators import vectors as VO
from corpusmill.operators import verdict as O
from corpusmill.operators.catalog import dense_label_map
from corpusmill.plans.lineage import cut, ensure_checkpoint_dir
from corpusmill.sources import applied
from corpusmill.workloads import vectors as VW
from corpusmill.workloads.tables import table

MARGIN = 0.02
CAP = 20


def _verdicts(spark, sf_dir):
    vecs = VW.vectors(spark, sf_dir)
    scores = VW.scores(vecs)
    cents = cut(VO.centroids(vecs))
    return O.verdict(
        scores,
        classified=VO.zero_shot(vecs, VW.prototypes(vecs, cents)),
        outliers=VO.outliers(vecs, cents=cents),
        duplicates=VO.near_duplicates(vecs, scores, VW.PAIR_THRESHOLD),
        mislabels=VO.mislabeled(vecs, MARGIN, cents=cents),
        reject_categories=("illustration", "screen_scan"),
    )


def _flat(verdicts):
    return verdicts.select("label", "item_id", F.concat_ws(",", "reasons").alias("reasons"), "removed")


def verdict_reasons(spark, sf_dir):
    return _flat(_verdicts(spark, sf_dir))


def verdict_capped(spark, sf_dir):
    return _flat(O.cap_per_label(_verdicts(spark, sf_dir), CAP))


def verdict_partition(spark, sf_dir):
    kept, rejected = O.partition(_verdicts(spark, sf_dir))
    return kept.select("label", "item_id", F.lit("kept").alias("side")).unionByName(
        rejected.select("label", "item_id", F.lit("rejected").alias("side"))
    )


def _published(spark, sf_dir):
    folder = f"{ensure_checkpoint_dir(spark)}/applied-{uuid.uuid4().hex}"
    applied.publish(_verdicts(spark, sf_dir).select("label", "item_id", "removed"), folder)
    return folder


def published_verdicts(spark, sf_dir):
    return applied.read_published(spark, _published(spark, sf_dir)).select("label", "item_id", "side")


def published_totals(spark, sf_dir):
    """The totals that the writing job observed."""
    return applied.published_runs(spark, _published(spark, sf_dir)).select("kept", "removed")


def verdict_stats(spark, sf_dir):
    return O.verdict_stats(_verdicts(spark, sf_dir))


def verdict_reason_counts(spark, sf_dir):
    return O.removed_by_reason(_verdicts(spark, sf_dir))


def _document_verdicts(spark, sf_dir):
    """Documents by source and language; short ones are removed."""
    turn = F.floor(F.col("doc_id") / 20) % 10
    return table(spark, sf_dir, "documents").select(
        F.concat_ws("_", "source", "lang").alias("label"),
        F.col("doc_id").alias("item_id"),
        F.when(turn < 8, "train").when(turn == 8, "validation").otherwise("test").alias("split"),
        (F.col("n_chars") < 2000).alias("removed"),
    )


def emptied_in_any_split(spark, sf_dir):
    return O.emptied_labels(_document_verdicts(spark, sf_dir), split="split")


def emptied_in_all_splits(spark, sf_dir):
    return O.emptied_labels(_document_verdicts(spark, sf_dir), split="split", drop_when="all_splits")


def reindexed_label_map(spark, sf_dir):
    rows = _document_verdicts(spark, sf_dir)
    return O.reindex_label_map(dense_label_map(rows), O.emptied_labels(rows, split="split"))


def pruned_metadata(spark, sf_dir):
    rows = _document_verdicts(spark, sf_dir)
    meta = table(spark, sf_dir, "documents").select(
        F.concat_ws("_", "source", "lang").alias("label"), F.col("lang").alias("family")
    ).distinct()
    return O.prune_metadata(meta, O.emptied_labels(rows, split="split"))


def _split_vectors(spark, sf_dir):
    return VW.vectors(spark, sf_dir).withColumn(
        "split",
        F.when(F.col("item_id") % 10 < 8, "train")
        .when(F.col("item_id") % 10 == 8, "validation").otherwise("test"),
    )


def _dataset(spark, sf_dir):
    vecs = _split_vectors(spark, sf_dir)
    verdicts = O.verdict(
        vecs.select("split", "label", "item_id"),
        outliers=VO.outliers(vecs, group=("split", "label")),
        keys=("split", "label", "item_id"),
    )
    labels = vecs.select("label").distinct()
    return O.apply_dataset(verdicts, dense_label_map(labels), labels)


def dataset_stats(spark, sf_dir):
    return _dataset(spark, sf_dir)["stats"]


def dataset_rejected(spark, sf_dir):
    return _dataset(spark, sf_dir)["rejected"].select("split", "label", "item_id")


def _report(spark, sf_dir):
    vecs = VW.vectors(spark, sf_dir)
    scores = VW.scores(vecs)
    done = vecs.filter("label < 2").select("label").distinct()
    cents = cut(VO.centroids(vecs))
    return O.quality_report(
        vecs, VO.zero_shot(vecs, VW.prototypes(vecs, cents)), VO.outliers(vecs, cents=cents),
        scores.withColumns({c: F.col("composite_score") for c in ("detection_score", "bbox_pct", "sharpness")}),
        VO.near_duplicates(vecs, scores, VW.PAIR_THRESHOLD), done,
    )


def report_items(spark, sf_dir):
    return _report(spark, sf_dir)[0].drop("scores")


def report_summary(spark, sf_dir):
    return _report(spark, sf_dir)[1]


QUERIES = {
    f.__name__: f
    for f in (
        verdict_reasons, verdict_capped, verdict_partition, published_verdicts, published_totals, verdict_stats, verdict_reason_counts,
        emptied_in_any_split, emptied_in_all_splits, reindexed_label_map, pruned_metadata,
        dataset_stats, dataset_rejected, report_items, report_summary,
    )
}

VERDICT_SQL = f"""{VW.VECTORS_SQL}, {VW.ZERO_SHOT_SQL}, {VW.OUTLIERS_SQL}, {VW.MISLABEL_SQL}, {VW.PAIRS_SQL}, {VW.GREEDY_SQL},
flags AS (SELECT e.label, e.vec_id AS item_id, (e.vec_id * 37 % 101) / 100.0 AS score,
            cls.category IN ('illustration', 'screen_scan') AS f1, outl.is_outlier AS f2,
            e.vec_id IN (SELECT removed FROM dups) AS f3, mis.own - mis.nearest > {MARGIN} AS f4
          FROM embeddings e JOIN cls USING (vec_id) JOIN outl USING (vec_id) JOIN mis USING (vec_id)),
ver AS (SELECT label, item_id, score,
          list_filter([CASE WHEN f1 THEN 'category' END, CASE WHEN f2 THEN 'outlier' END,
                       CASE WHEN f3 THEN 'duplicate' END, CASE WHEN f4 THEN 'mislabel' END],
                      lambda r: r IS NOT NULL) AS reasons, f1 OR f2 OR f3 OR f4 AS removed FROM flags)
"""

DOCUMENTS_SQL = """
dv AS (SELECT source || '_' || lang AS label, doc_id AS item_id, n_chars < 2000 AS removed, lang,
              CASE WHEN doc_id // 20 % 10 < 8 THEN 'train' WHEN doc_id // 20 % 10 = 8 THEN 'validation' ELSE 'test' END AS split
       FROM documents),
gone AS (SELECT DISTINCT label FROM (SELECT label, split FROM dv GROUP BY ALL HAVING bool_and(removed)))
"""

SPLIT_SQL = """
raw AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
               CASE WHEN vec_id % 10 < 8 THEN 'train' WHEN vec_id % 10 = 8 THEN 'validation' ELSE 'test' END AS split
        FROM embeddings),
v AS (SELECT vec_id, label, split, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS u FROM raw),
long AS (SELECT split, label, generate_subscripts(u, 1) AS pos, unnest(u) AS val FROM v),
tot AS (SELECT split, label, list(s ORDER BY pos) AS t
        FROM (SELECT split, label, pos, sum(val) AS s FROM long GROUP BY ALL) GROUP BY split, label),
cents AS (SELECT split, label, list_transform(t, lambda x: x / sqrt(list_dot_product(t, t))) AS c FROM tot),
dist AS (SELECT v.vec_id, v.label, v.split, 1 - list_dot_product(v.u, c.c) AS d FROM v JOIN cents c USING (split, label)),
sv AS (SELECT vec_id AS item_id, label, split,
              d > avg(d) OVER (PARTITION BY split, label) + 1.5 * stddev_pop(d) OVER (PARTITION BY split, label)
                AND count(*) OVER (PARTITION BY split, label) >= 3 AS removed FROM dist)
"""

ORACLES = {
    "verdict_reasons": f"""WITH RECURSIVE {VERDICT_SQL}
      SELECT label, item_id, array_to_string(reasons, ',') AS reasons, removed FROM ver""",
    "verdict_capped": f"""WITH RECURSIVE {VERDICT_SQL},
      r AS (SELECT *, row_number() OVER (PARTITION BY label, removed ORDER BY score DESC, item_id) AS rn FROM ver)
      SELECT label, item_id,
             array_to_string(CASE WHEN NOT removed AND rn > {CAP} THEN list_append(reasons, 'over_cap') ELSE reasons END, ',') AS reasons,
             removed OR rn > {CAP} AS removed FROM r""",
    "verdict_partition": f"""WITH RECURSIVE {VERDICT_SQL}
      SELECT label, item_id, CASE WHEN removed THEN 'rejected' ELSE 'kept' END AS side FROM ver""",
    "published_verdicts": f"""WITH RECURSIVE {VERDICT_SQL}
      SELECT label, item_id, CASE WHEN removed THEN 'rejected' ELSE 'kept' END AS side FROM ver""",
    "published_totals": f"""WITH RECURSIVE {VERDICT_SQL}
      SELECT count(*) FILTER (WHERE NOT removed) AS kept, count(*) FILTER (WHERE removed) AS removed FROM ver""",
    "verdict_stats": f"""WITH RECURSIVE {VERDICT_SQL}
      SELECT label, count(*) FILTER (WHERE removed) AS removed, count(*) FILTER (WHERE NOT removed) AS kept
      FROM ver GROUP BY ROLLUP (label)""",
    "verdict_reason_counts": f"""WITH RECURSIVE {VERDICT_SQL}
      SELECT reason, count(*) AS items FROM (SELECT unnest(reasons) AS reason FROM ver) GROUP BY reason""",
    "emptied_in_any_split": f"WITH {DOCUMENTS_SQL} SELECT label FROM gone",
    "emptied_in_all_splits": f"WITH {DOCUMENTS_SQL} SELECT label FROM dv GROUP BY label HAVING bool_and(removed)",
    "reindexed_label_map": f"""WITH {DOCUMENTS_SQL}
      SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS idx
      FROM (SELECT DISTINCT label FROM dv) ANTI JOIN gone USING (label)""",
    "pruned_metadata": f"""WITH {DOCUMENTS_SQL}
      SELECT label, family FROM (SELECT DISTINCT label, lang AS family FROM dv) ANTI JOIN gone USING (label)""",
    "dataset_stats": f"""WITH {SPLIT_SQL}
      SELECT split, label, count(*) FILTER (WHERE removed) AS removed, count(*) FILTER (WHERE NOT removed) AS kept
      FROM sv GROUP BY GROUPING SETS ((split, label), ())""",
    "dataset_rejected": f"WITH {SPLIT_SQL} SELECT split, label, item_id FROM sv WHERE removed",
    "report_items": f"""WITH {VW.VECTORS_SQL}, {VW.ZERO_SHOT_SQL}, {VW.OUTLIERS_SQL}
      SELECT cls.label, vec_id AS item_id, category, confidence, round(d, 4) AS distance, is_outlier,
             (vec_id * 37 % 101) / 100.0 AS detection_score, (vec_id * 37 % 101) / 100.0 AS bbox_pct,
             (vec_id * 37 % 101) / 100.0 AS sharpness, (vec_id * 37 % 101) / 100.0 AS composite_score
      FROM cls JOIN outl USING (vec_id) WHERE cls.label >= 2""",
    "report_summary": f"""WITH RECURSIVE {VERDICT_SQL},
      d AS (SELECT label, count(*) AS duplicates, count(DISTINCT removed) AS distinct_removed FROM dups GROUP BY label)
      SELECT cls.label, count(*) AS total,
             count(*) FILTER (WHERE category = 'good') AS good,
             count(*) FILTER (WHERE category = 'dead_specimen') AS dead_specimen,
             count(*) FILTER (WHERE category = 'illustration') AS illustration,
             count(*) FILTER (WHERE category = 'screen_scan') AS screen_scan,
             count(*) FILTER (WHERE category = 'not_bird') AS not_bird,
             count(*) FILTER (WHERE category = 'poor_quality') AS poor_quality,
             count(*) FILTER (WHERE is_outlier) AS outliers,
             coalesce(any_value(d.duplicates), 0) AS duplicates,
             coalesce(any_value(d.distinct_removed), 0) AS distinct_removed
      FROM cls JOIN outl USING (vec_id) LEFT JOIN d ON d.label = cls.label
      WHERE cls.label >= 2 GROUP BY cls.label""",
}
