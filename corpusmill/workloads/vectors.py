"""Embedding queries: label = embeddings.label, item = embeddings.vec_id."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.constants import CATEGORIES
from corpusmill.functions.vectors import l2_normalise
from corpusmill.operators import pivots as P
from corpusmill.operators import vectors as O
from corpusmill.workloads.tables import table

PAIR_THRESHOLD = 0.3

# Unit vectors and unit centroids in SQL, shared by several oracles.
VECTORS_SQL = """
raw AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
v AS (SELECT vec_id, label, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS u FROM raw),
long AS (SELECT vec_id, label, generate_subscripts(u, 1) AS pos, unnest(u) AS val FROM v),
tot AS (SELECT label, list(s ORDER BY pos) AS t
        FROM (SELECT label, pos, sum(val) AS s FROM long GROUP BY label, pos) GROUP BY label),
cents AS (SELECT label, list_transform(t, lambda x: x / sqrt(list_dot_product(t, t))) AS c FROM tot)
"""

OUTLIERS_SQL = """
dist AS (SELECT v.vec_id, v.label, 1 - list_dot_product(v.u, c.c) AS d FROM v JOIN cents c USING (label)),
outl AS (SELECT vec_id, label, d,
                d > avg(d) OVER (PARTITION BY label) + 1.5 * stddev_pop(d) OVER (PARTITION BY label)
                  AND count(*) OVER (PARTITION BY label) >= 3 AS is_outlier
         FROM dist)
"""

MISLABEL_SQL = """
alld AS (SELECT v.vec_id, v.label, c.label AS other, 1 - list_dot_product(v.u, c.c) AS d FROM v CROSS JOIN cents c),
mis AS (SELECT vec_id, label,
               min(d) FILTER (WHERE other = label) AS own,
               arg_min(other, d) FILTER (WHERE other <> label) AS nearest_label,
               min(d) FILTER (WHERE other <> label) AS nearest
        FROM alld GROUP BY vec_id, label)
"""

PAIRS_SQL = """
reps AS (SELECT label, e, min(vec_id) AS vec_id FROM raw GROUP BY label, e),
ru AS (SELECT v.vec_id, v.label, v.u FROM v JOIN reps USING (vec_id)),
pairs AS (SELECT a.label, a.vec_id AS item_a, b.vec_id AS item_b, list_dot_product(a.u, b.u) AS sim
          FROM ru a JOIN ru b ON a.label = b.label AND a.vec_id < b.vec_id
          WHERE list_dot_product(a.u, b.u) > 0.3)
"""

COPIES_SQL = """
withc AS (SELECT label, vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
          UNION ALL SELECT label, vec_id + 1000000, CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id % 7 = 0),
cset AS (SELECT *, first_value(item_id) OVER (PARTITION BY label, e ORDER BY (item_id * 37 % 101) DESC, item_id) AS kept FROM withc)
"""

# Greedy walk over the ranked pairs of each label.
GREEDY_SQL = """
scored AS (SELECT vec_id, (vec_id * 37 % 101) / 100.0 AS score FROM embeddings),
ranked AS (SELECT p.label, item_a, item_b, sim,
                  CASE WHEN sb.score > sa.score THEN item_a ELSE item_b END AS loser,
                  row_number() OVER (PARTITION BY p.label ORDER BY sim DESC, item_a, item_b) AS rn
           FROM pairs p JOIN scored sa ON sa.vec_id = item_a JOIN scored sb ON sb.vec_id = item_b),
walk AS (
  SELECT label, CAST(0 AS BIGINT) AS rn, CAST([] AS BIGINT[]) AS gone,
         CAST(NULL AS BIGINT) AS kept, CAST(NULL AS BIGINT) AS removed, CAST(NULL AS DOUBLE) AS sim
  FROM (SELECT DISTINCT label FROM ranked)
  UNION ALL
  SELECT r.label, r.rn,
         CASE WHEN list_contains(w.gone, r.item_a) OR list_contains(w.gone, r.item_b)
              THEN w.gone ELSE list_append(w.gone, r.loser) END,
         CASE WHEN list_contains(w.gone, r.item_a) AND list_contains(w.gone, r.item_b) THEN NULL
              WHEN list_contains(w.gone, r.item_a) THEN r.item_b
              WHEN list_contains(w.gone, r.item_b) THEN r.item_a
              WHEN r.loser = r.item_a THEN r.item_b ELSE r.item_a END,
         CASE WHEN list_contains(w.gone, r.item_a) THEN r.item_a
              WHEN list_contains(w.gone, r.item_b) THEN r.item_b ELSE r.loser END,
         r.sim
  FROM walk w JOIN ranked r ON r.label = w.label AND r.rn = w.rn + 1),
dups AS (SELECT label, kept, removed, round(sim, 4) AS similarity FROM walk WHERE kept IS NOT NULL)
"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "item_id")


def scores(vecs: DataFrame) -> DataFrame:
    return vecs.select(
        "label", "item_id", (F.col("item_id") * 37 % 101 / 100.0).alias("composite_score")
    )


def prototypes(vecs: DataFrame, cents: DataFrame | None = None) -> DataFrame:
    """Centroids of labels 0..5 stand for the six categories."""
    names = F.array(*[F.lit(c) for c in CATEGORIES])
    return (
        (O.centroids(vecs) if cents is None else cents)
        .filter(F.col("label") < len(CATEGORIES))
        .select(F.element_at(names, F.col("label") + 1).alias("category"),
                F.col("centroid").alias("embedding"))
    )


def unit_vectors(spark, sf_dir):
    return vectors(spark, sf_dir).select(
        "item_id", F.posexplode(l2_normalise(F.col("embedding"))).alias("pos", "value")
    ).select("item_id", "pos", F.round("value", 6).alias("value"))


def label_centroids(spark, sf_dir):
    return O.centroids(vectors(spark, sf_dir)).select(
        "label", "n", F.posexplode("centroid").alias("pos", "value")
    ).select("label", "n", "pos", F.round("value", 6).alias("value"))


def zero_shot_categories(spark, sf_dir):
    vecs = vectors(spark, sf_dir)
    return O.zero_shot(vecs, prototypes(vecs)).select(
        "item_id", "label", "category", "confidence",
        *[F.col("scores")[c].alias(f"p_{c}") for c in CATEGORIES],
    )


def _readable_items(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.col("lang").alias("label"), F.col("doc_id").alias("item_id"),
        F.when(F.col("n_chars") < 500, 0).otherwise(F.col("n_chars")).alias("width"),
    )


def classified_with_corrupted(spark, sf_dir):
    vecs, items = vectors(spark, sf_dir), _readable_items(spark, sf_dir)
    readable = vecs.drop("label").join(items.filter("width > 0"), "item_id")
    return O.with_corrupted(O.zero_shot(readable, prototypes(vecs)), items).select(
        "label", "item_id", "category", "confidence"
    )


def category_counts(spark, sf_dir):
    return O.category_summary(classified_with_corrupted(spark, sf_dir))


def label_outliers(spark, sf_dir):
    return O.outliers(vectors(spark, sf_dir))


def near_duplicate_pairs(spark, sf_dir):
    distinct, _, sizes = O.split_copies(vectors(spark, sf_dir))
    return O.near_pairs(distinct, PAIR_THRESHOLD, sizes=sizes).withColumn(
        "similarity", F.round("similarity", 4)
    )


def duplicate_resolution(spark, sf_dir):
    vecs = vectors(spark, sf_dir)
    return O.near_duplicates(vecs, scores(vecs), PAIR_THRESHOLD)


def mislabel_candidates(spark, sf_dir):
    return O.mislabeled(vectors(spark, sf_dir), margin=0.02)


def _with_copies(spark, sf_dir):
    """The vectors and a second item for some of them, with the same vector."""
    vecs = vectors(spark, sf_dir).select("label", "item_id", "embedding")
    return vecs.unionByName(vecs.filter("item_id % 7 = 0").withColumn("item_id", F.col("item_id") + 1_000_000))


def copied_members(spark, sf_dir):
    """Members of every set of copies with the item that stands for it."""
    vecs = _with_copies(spark, sf_dir)
    return O.split_copies(vecs, score="composite_score", scores=scores(vecs))[1]


def copied_pairs(spark, sf_dir):
    """Near pairs between the representatives of a table with copies."""
    vecs = _with_copies(spark, sf_dir)
    distinct, _, sizes = O.split_copies(vecs, score="composite_score", scores=scores(vecs))
    return O.near_pairs(distinct, PAIR_THRESHOLD, sizes=sizes).withColumn("similarity", F.round("similarity", 6))


def pruned_pairs(spark, sf_dir):
    """Near pairs of the vectors' first four places, through the pivot index."""
    short = vectors(spark, sf_dir).withColumn("embedding", F.slice("embedding", 1, 4))
    distinct = O.split_copies(short)[0]
    return P.pruned_pairs(distinct, 0.95).withColumn("similarity", F.round("similarity", 4))


def mislabel_totals(spark, sf_dir):
    return O.mislabel_summary(O.mislabeled(vectors(spark, sf_dir), margin=0.02))


def _text_encoder(texts: pd.Series) -> np.ndarray:
    return np.stack(
        [texts.str.len(), texts.str.count("e"), texts.str.count(" ")], axis=1
    ).astype(np.float32)


def encoded_items(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "item_id")
    return O.encode(docs, _text_encoder, "text", keys=("item_id",)).select(
        "item_id",
        *[F.col("embedding")[i].cast("bigint").alias(n) for i, n in enumerate(("chars", "es", "blanks"))],
    )


QUERIES = {
    "unit_vectors": unit_vectors,
    "label_centroids": label_centroids,
    "zero_shot_categories": zero_shot_categories,
    "classified_with_corrupted": classified_with_corrupted,
    "category_counts": category_counts,
    "label_outliers": label_outliers,
    "near_duplicate_pairs": near_duplicate_pairs,
    "duplicate_resolution": duplicate_resolution,
    "mislabel_candidates": mislabel_candidates,
    "mislabel_totals": mislabel_totals,
    "copied_members": copied_members,
    "copied_pairs": copied_pairs,
    "encoded_items": encoded_items,
    "pruned_pairs": pruned_pairs,
}

# Softmax over the six prototypes, then the margin rule, in SQL.
ZERO_SHOT_SQL = """
sims AS (SELECT v.vec_id, v.label, c.label AS cat, exp(list_dot_product(v.u, c.c)) AS x
         FROM v JOIN cents c ON c.label < 6),
probs AS (SELECT vec_id, label, cat, x / sum(x) OVER (PARTITION BY vec_id) AS p FROM sims),
picked AS (SELECT vec_id, label,
                  max(p) FILTER (WHERE cat = 0) AS pg,
                  max(p) FILTER (WHERE cat <> 0) AS pn,
                  arg_max(cat, p) FILTER (WHERE cat <> 0) AS neg,
                  list(round(p, 4) ORDER BY cat) AS ps
           FROM probs GROUP BY vec_id, label),
cls AS (SELECT vec_id, label,
               ['good', 'dead_specimen', 'illustration', 'screen_scan', 'not_bird', 'poor_quality']
                 [CASE WHEN pn - pg < 0.005 THEN 1 ELSE neg + 1 END] AS category,
               round(CASE WHEN pn - pg < 0.005 THEN pg ELSE pn END, 4) AS confidence, ps
        FROM picked)
"""

CORRUPTED_SQL = """
allc AS (SELECT d.lang AS label, d.doc_id AS item_id, cls.category, cls.confidence
         FROM cls JOIN documents d ON d.doc_id = cls.vec_id WHERE d.n_chars >= 500
         UNION ALL
         SELECT lang, doc_id, 'corrupted', 1.0 FROM documents WHERE n_chars < 500)
"""

ORACLES = {
    "unit_vectors": f"WITH {VECTORS_SQL} SELECT vec_id AS item_id, CAST(pos - 1 AS INTEGER) AS pos, round(val, 6) AS value FROM long",
    "label_centroids": f"""WITH {VECTORS_SQL},
      sizes AS (SELECT label, count(*) AS n FROM raw GROUP BY label),
      flat AS (SELECT label, generate_subscripts(c, 1) AS pos, unnest(c) AS val FROM cents)
      SELECT label, n, CAST(pos - 1 AS INTEGER) AS pos, round(val, 6) AS value FROM flat JOIN sizes USING (label)""",
    "zero_shot_categories": f"""WITH {VECTORS_SQL}, {ZERO_SHOT_SQL}
      SELECT vec_id AS item_id, label, category, confidence, ps[1] AS p_good, ps[2] AS p_dead_specimen,
             ps[3] AS p_illustration, ps[4] AS p_screen_scan, ps[5] AS p_not_bird, ps[6] AS p_poor_quality
      FROM cls""",
    "classified_with_corrupted": f"WITH {VECTORS_SQL}, {ZERO_SHOT_SQL}, {CORRUPTED_SQL} SELECT * FROM allc",
    "category_counts": f"""WITH {VECTORS_SQL}, {ZERO_SHOT_SQL}, {CORRUPTED_SQL}
      SELECT label, count(*) AS total,
             count(*) FILTER (WHERE category = 'good') AS good,
             count(*) FILTER (WHERE category = 'dead_specimen') AS dead_specimen,
             count(*) FILTER (WHERE category = 'illustration') AS illustration,
             count(*) FILTER (WHERE category = 'screen_scan') AS screen_scan,
             count(*) FILTER (WHERE category = 'not_bird') AS not_bird,
             count(*) FILTER (WHERE category = 'poor_quality') AS poor_quality
      FROM allc GROUP BY label""",
    "label_outliers": f"""WITH {VECTORS_SQL}, {OUTLIERS_SQL}
      SELECT label, vec_id AS item_id, round(d, 4) AS distance, is_outlier FROM outl""",
    "near_duplicate_pairs": f"""WITH {VECTORS_SQL}, {PAIRS_SQL}
      SELECT label, item_a, item_b, round(sim, 4) AS similarity FROM pairs""",
    "duplicate_resolution": f"""WITH RECURSIVE {VECTORS_SQL}, {PAIRS_SQL}, {GREEDY_SQL}
      SELECT label, kept, removed, similarity FROM dups""",
    "mislabel_candidates": f"""WITH {VECTORS_SQL}, {MISLABEL_SQL}
      SELECT label, vec_id AS item_id, round(own, 4) AS own_distance, nearest_label,
             round(nearest, 4) AS nearest_distance, own - nearest > 0.02 AS suspected FROM mis""",
    "copied_members": f"WITH {COPIES_SQL} SELECT label, kept, item_id AS removed FROM cset WHERE item_id <> kept",
    "copied_pairs": f"""WITH {VECTORS_SQL}, {COPIES_SQL},
      rep AS (SELECT DISTINCT kept AS item_id, label, e FROM cset),
      ru2 AS (SELECT item_id, label, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS u FROM rep)
      SELECT a.label, a.item_id AS item_a, b.item_id AS item_b, round(list_dot_product(a.u, b.u), 6) AS similarity
      FROM ru2 a JOIN ru2 b ON a.label = b.label AND a.item_id < b.item_id WHERE list_dot_product(a.u, b.u) > 0.3""",
    "pruned_pairs": """WITH four AS (SELECT label, vec_id, CAST(embedding AS DOUBLE[])[1:4] AS e FROM embeddings),
      one AS (SELECT label, e, min(vec_id) AS item_id FROM four GROUP BY label, e),
      u4 AS (SELECT label, item_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS u FROM one)
      SELECT a.label, a.item_id AS item_a, b.item_id AS item_b, round(list_dot_product(a.u, b.u), 4) AS similarity
      FROM u4 a JOIN u4 b ON a.label = b.label AND a.item_id < b.item_id WHERE list_dot_product(a.u, b.u) > 0.95""",
    "mislabel_totals": f"""WITH {VECTORS_SQL}, {MISLABEL_SQL}
      SELECT label, count(*) AS suspected_count FROM mis WHERE own - nearest > 0.02 GROUP BY ROLLUP (label)""",
    "encoded_items": """SELECT doc_id AS item_id, length(text) AS chars,
      length(text) - length(replace(text, 'e', '')) AS es,
      length(text) - length(replace(text, ' ', '')) AS blanks FROM documents""",
}
