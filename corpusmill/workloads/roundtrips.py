"""Sinks read back: what a table becomes in files and what the readers make of them.

Files go below the shared checkpoint folder, each call into a folder of its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusmill.operators import catalog as CO
from corpusmill.plans.lineage import ensure_checkpoint_dir
from corpusmill.sources import annotations as A
from corpusmill.sources import embeddings, labels, manifests, reports, truth
from corpusmill.workloads import boxes as BW
from corpusmill.workloads import calibration as KW
from corpusmill.workloads import catalog as CW
from corpusmill.workloads import vectors as VW
from corpusmill.workloads import verdict as QW
from corpusmill.workloads.tables import table


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"


def annotation_files(spark, sf_dir):
    A.write_annotations(BW.annotations(spark, sf_dir), path := _folder(spark), ["label"])
    rows = A.read_written_annotations(spark, path)
    return rows.select("label", "name", *[F.col(f"bbox.{c}").alias(c) for c in "xywh"], "score")


def missing_list(spark, sf_dir):
    A.write_missing(BW.annotations(spark, sf_dir), path := _folder(spark))
    return spark.read.text(path).select(F.col("value").alias("line"))


def label_map_file(spark, sf_dir):
    """Customers as labels."""
    names = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("label"), F.col("c_custkey").cast("int").alias("idx")
    )
    labels.write_label_map(names, path := _folder(spark))
    return labels.read_label_map(spark, path)


def label_metadata_file(spark, sf_dir):
    """Suppliers as labels; some have no family."""
    rows = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("label"),
        F.concat(F.lit('"'), "s_name", F.lit('" s.')).alias("scientific_name"),
        F.when(F.col("s_acctbal") > 0, F.col("s_nationkey").cast("string")).alias("family"),
        F.upper("s_name").alias("english_name"),
        F.lower("s_name").alias("french_name"),
    )
    labels.write_label_metadata(rows, path := _folder(spark))
    return labels.read_label_metadata(spark, path)


def embedding_store(spark, sf_dir):
    embeddings.write_embeddings(VW.vectors(spark, sf_dir), path := _folder(spark), "label")
    return embeddings.read_embeddings(spark, path).select(
        "item_id", F.col("label").cast("int").alias("label"), F.posexplode("embedding").alias("pos", "value")
    )


def _report(spark, sf_dir):
    items, summary = QW._report(spark, sf_dir)[:2]
    return items, summary


def flat_report_files(spark, sf_dir):
    items, summary = _report(spark, sf_dir)
    reports.write_report(path := _folder(spark), items, summary)
    return reports.read_report(spark, path)["items"].drop("scores")


def nested_report_files(spark, sf_dir):
    items, summary = _report(spark, sf_dir)
    reports.nested_report(items, summary, per_object=100).write.json(path := _folder(spark))
    return reports.read_nested_report(spark, path)["items"].drop("scores").withColumn(
        "item_id", F.col("item_id").cast("bigint")
    ).withColumn("label", F.col("label").cast("int"))


def _plan(spark, sf_dir):
    return CO.build_manifest(CW.needs(spark, sf_dir), CW.tier_fill(spark, sf_dir))


def resumed_manifest(spark, sf_dir):
    """Planned once, then found; the second plan would be empty."""
    path = _folder(spark)
    manifests.plan_or_resume(spark, path, lambda: _plan(spark, sf_dir), 10)
    rows = manifests.plan_or_resume(spark, path, lambda: _plan(spark, sf_dir).limit(0), 10)
    return CO.manifest_summary(rows)


def manifest_document(spark, sf_dir):
    manifests.write_manifest_document(_plan(spark, sf_dir), path := _folder(spark), 10)
    return CO.manifest_summary(manifests.read_manifest_document(spark, path))


def sweep_file(spark, sf_dir):
    swept = KW.threshold_sweep(spark, sf_dir)
    truth.write_sweep(swept, path := _folder(spark))
    return spark.read.schema(swept.schema).json(path)


QUERIES = {
    f.__name__: f
    for f in (
        annotation_files, missing_list, label_map_file, label_metadata_file, embedding_store, flat_report_files,
        nested_report_files, resumed_manifest, manifest_document, sweep_file,
    )
}

ORACLES = {
    "annotation_files": f"WITH {BW.ANN_SQL} SELECT label, name, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, CAST(w AS DOUBLE) AS w, CAST(h AS DOUBLE) AS h, score FROM ann",
    "missing_list": f"WITH {BW.ANN_SQL} SELECT label || '/' || name AS line FROM ann WHERE x IS NULL",
    "label_map_file": "SELECT c_name AS label, CAST(c_custkey AS INTEGER) AS idx FROM customer",
    "label_metadata_file": """SELECT s_name AS label, '"' || s_name || '" s.' AS scientific_name,
      CASE WHEN s_acctbal > 0 THEN CAST(s_nationkey AS VARCHAR) END AS family, upper(s_name) AS english_name,
      lower(s_name) AS french_name FROM supplier""",
    "embedding_store": """SELECT vec_id AS item_id, label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, unnest(embedding) AS value
      FROM embeddings""",
    "flat_report_files": QW.ORACLES["report_items"],
    "nested_report_files": QW.ORACLES["report_items"],
    "resumed_manifest": CW.ORACLES["manifest_summary"],
    "manifest_document": CW.ORACLES["manifest_summary"],
    "sweep_file": KW.ORACLES["threshold_sweep"],
}
