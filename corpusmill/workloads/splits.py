"""Split and merge queries over documents (label = source, or source and language)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import splits as O
from corpusmill.workloads.tables import table


def _items(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.concat_ws("_", "source", "lang").alias("label"), F.col("doc_id").alias("item_id")
    )


def _rule(rule):
    def query(spark, sf_dir):
        return O.assign_splits(_items(spark, sf_dir), rule).select("label", "item_id", "split")

    return query


def split_report(spark, sf_dir):
    return O.split_report(O.assign_splits(_items(spark, sf_dir)))


def split_sizes(spark, sf_dir):
    return O.split_sizes(O.assign_splits(_items(spark, sf_dir), "merge"))


def split_guard(spark, sf_dir):
    """Splits already present: orders carry theirs in the order status."""
    return O.existing_splits(
        table(spark, sf_dir, "orders").select(
            F.when(F.col("o_orderstatus") == "F", "train")
            .when(F.col("o_orderstatus") == "O", "validation").otherwise("spare").alias("split")
        )
    )


def _name():
    return F.concat(F.col("doc_id").cast("string"), F.lit(".jpg")).alias("name")


def _corpus(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    items = docs.select(
        F.when(F.col("lang") == "en", "train").when(F.col("lang") == "fr", "validation")
        .otherwise("test").alias("split"),
        F.col("source").alias("label"), _name(), "n_chars",
    )
    annotations = items.filter("n_chars >= 500").select(
        "split", "label", "name", F.lit(0.5).alias("score")
    )
    return items.drop("n_chars"), annotations


def _staged(spark, sf_dir):
    """Labelled documents come in again, good ones with a better annotation."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")
    items = rows.select(F.col("source").alias("label"), _name())
    annotations = rows.filter("quality = 1").select(
        F.col("source").alias("label"), _name(), F.lit(0.9).alias("score")
    )
    return items, annotations


def merged_items(spark, sf_dir):
    return O.merge_corpus(*_corpus(spark, sf_dir), *_staged(spark, sf_dir))[0]


def merged_annotations(spark, sf_dir):
    return O.merge_corpus(*_corpus(spark, sf_dir), *_staged(spark, sf_dir))[1]


def merge_sizes(spark, sf_dir):
    return O.merge_corpus(*_corpus(spark, sf_dir), *_staged(spark, sf_dir))[2]


def merged_rejects(spark, sf_dir):
    return O.merge_rejected(*_corpus(spark, sf_dir), *_staged(spark, sf_dir))[1]


def empty_labels(spark, sf_dir):
    staged = table(spark, sf_dir, "labels").filter("toxic = 1 AND quality = 0").join(
        table(spark, sf_dir, "documents"), "doc_id"
    )
    return O.empty_labels(
        table(spark, sf_dir, "documents").select(F.col("source").alias("label")),
        staged.select(F.col("source").alias("label")),
    )


def labels_with_items(spark, sf_dir):
    return O.labels_with_items(_items(spark, sf_dir))


def split_overlaps(spark, sf_dir):
    """Parts shipped in more than one year count as split overlaps."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("label"), F.col("l_partkey").alias("item_id"),
        F.when(F.year("l_shipdate") < 2000, "train").otherwise("test").alias("split"),
    )
    return O.split_overlaps(rows)


def lost_items(spark, sf_dir):
    """Orders none of whose line items were found again."""
    return O.lost_items(
        table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("item_id")),
        table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("item_id")),
        ("item_id",),
    )


QUERIES = {
    "split_dataset_rule": _rule("dataset"),
    "split_merge_rule": _rule("merge"),
    "split_samples_rule": _rule("samples"),
    **{
        f.__name__: f
        for f in (
            split_report, split_sizes, split_guard, merged_items, merged_annotations, merge_sizes,
            merged_rejects, empty_labels, labels_with_items, split_overlaps, lost_items,
        )
    },
}

RANKED_SQL = """
items AS (SELECT source || '_' || lang AS label, doc_id AS item_id FROM documents),
rk AS (SELECT label, item_id,
              row_number() OVER (PARTITION BY label ORDER BY md5(item_id || ':42'), item_id) AS rn,
              count(*) OVER (PARTITION BY label) AS n FROM items)
"""

# Sizes of the dataset and merge rules; 1 - 0.8 - 0.1 is a binary fraction below 0.1.
SIZES_SQL = """
s0 AS (SELECT *, greatest(1, CAST(round_even(n * 0.1::DOUBLE, 0) AS BIGINT)) AS v0,
              greatest(1, CAST(round_even(n * (1 - 0.8::DOUBLE - 0.1::DOUBLE), 0) AS BIGINT)) AS t0 FROM rk),
s AS (SELECT label, item_id, rn, n,
             CASE WHEN n - v0 - t0 < 1 THEN greatest(1, (n - 1) // 2) ELSE v0 END AS v,
             CASE WHEN n - v0 - t0 < 1 THEN greatest(1, n - 1 - greatest(1, (n - 1) // 2)) ELSE t0 END AS t FROM s0)
"""

DATASET_SQL = f"""{RANKED_SQL}, {SIZES_SQL},
done AS (SELECT label, item_id,
                CASE WHEN rn <= v THEN 'validation' WHEN rn <= v + t THEN 'test' ELSE 'train' END AS split FROM s)
"""

MERGE_SQL = f"""{SIZES_SQL},
done AS (SELECT label, item_id,
                CASE WHEN rn <= CASE WHEN n <= 2 THEN 1 ELSE n - v - t END THEN 'train'
                     WHEN rn <= CASE WHEN n <= 2 THEN 1 ELSE n - v - t END + v THEN 'validation' ELSE 'test' END AS split
         FROM s)
"""

STAGED_SQL = f"""
items AS (SELECT source AS label, doc_id || '.jpg' AS item_id, quality FROM labels JOIN documents USING (doc_id)),
rk AS (SELECT label, item_id, quality,
              row_number() OVER (PARTITION BY label ORDER BY md5(item_id || ':42'), item_id) AS rn,
              count(*) OVER (PARTITION BY label) AS n FROM items),
{MERGE_SQL},
corp AS (SELECT CASE lang WHEN 'en' THEN 'train' WHEN 'fr' THEN 'validation' ELSE 'test' END AS split,
                source AS label, doc_id || '.jpg' AS name, n_chars FROM documents),
old AS (SELECT split, label, name, 0.5 AS score FROM corp WHERE n_chars >= 500)
"""

_SIZES = """SELECT label, count(*) AS total, count(*) FILTER (WHERE split = 'train') AS train,
  count(*) FILTER (WHERE split = 'validation') AS validation, count(*) FILTER (WHERE split = 'test') AS test
  FROM done GROUP BY label"""

ORACLES = {
    "split_dataset_rule": f"WITH {DATASET_SQL} SELECT * FROM done",
    "split_merge_rule": f"WITH {RANKED_SQL}, {MERGE_SQL} SELECT * FROM done",
    "split_samples_rule": f"""WITH {RANKED_SQL},
      a AS (SELECT *, greatest(1, CAST(round_even(n * 0.8::DOUBLE, 0) AS BIGINT)) AS tr,
                   greatest(CASE WHEN n < 2 THEN 0 ELSE 1 END, CAST(round_even(n * 0.1::DOUBLE, 0) AS BIGINT)) AS v0 FROM rk),
      b AS (SELECT *, CASE WHEN tr + v0 > n THEN greatest(0, n - tr) ELSE v0 END AS v FROM a)
      SELECT label, item_id, CASE WHEN rn <= tr THEN 'train' WHEN rn <= tr + v THEN 'validation' ELSE 'test' END AS split FROM b""",
    "split_report": f"""WITH {DATASET_SQL}
      SELECT split, count(*) AS items, round(count(*) * 100 / sum(count(*)) OVER (), 0) AS pct FROM done GROUP BY split""",
    "split_sizes": f"WITH {RANKED_SQL}, {MERGE_SQL} {_SIZES}",
    "split_guard": "SELECT DISTINCT 'validation' AS split FROM orders WHERE o_orderstatus = 'O'",
    "merged_items": f"""WITH {STAGED_SQL}
      SELECT split, label, name FROM corp UNION SELECT split, label, item_id FROM done""",
    "merged_annotations": f"""WITH {STAGED_SQL},
      new AS (SELECT d.split, d.label, d.item_id AS name, 0.9 AS score FROM done d JOIN items i USING (label, item_id) WHERE quality = 1)
      SELECT split, label, name, CAST(coalesce(new.score, old.score) AS DOUBLE) AS score
      FROM old FULL JOIN new USING (split, label, name)""",
    "merge_sizes": f"WITH {STAGED_SQL} {_SIZES}",
    "merged_rejects": f"""WITH {STAGED_SQL},
      new AS (SELECT 'train' AS split, label, item_id AS name, 0.9 AS score FROM items WHERE quality = 1)
      SELECT split, label, name, CAST(coalesce(new.score, old.score) AS DOUBLE) AS score
      FROM old FULL JOIN new USING (split, label, name)""",
    "empty_labels": """SELECT DISTINCT source AS label FROM documents WHERE source NOT IN
      (SELECT source FROM labels JOIN documents USING (doc_id) WHERE toxic = 1 AND quality = 0)""",
    "labels_with_items": "SELECT source || '_' || lang AS label, count(*) AS items FROM documents GROUP BY 1",
    "split_overlaps": """SELECT l_suppkey AS label, l_partkey AS item_id FROM lineitem
      GROUP BY 1, 2 HAVING count(DISTINCT year(l_shipdate) < 2000) > 1""",
    "lost_items": "SELECT o_orderkey AS item_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
}
