"""One JSON document with an entry per label, written line by line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_document(
    rows: DataFrame, value: Column, path: str, mode: str = "errorifexists", head: str = "{", tail: str = "}"
) -> None:
    """``head``, the entries ``"label": value`` in label order, ``tail``.

    The document is a single file by its format, so a single task writes it; it
    streams sorted lines and holds none of them.
    """
    entry = F.to_json(F.create_map("label", value), {"ignoreNullFields": "false"})
    body = rows.withColumn("_e", entry).select(
        F.lit(1).alias("part"), "label", F.substr("_e", F.lit(2), F.length("_e") - 2).alias("value")
    )
    first = rows.select(F.min("label")).scalar()
    body = body.withColumn("value", F.when(F.col("label") == first, F.col("value")).otherwise(F.concat(F.lit(","), "value")))
    spark = rows.sparkSession
    none = F.lit(None).cast(rows.schema["label"].dataType)
    frame = [
        spark.range(1).select(F.lit(part).alias("part"), none.alias("label"), F.lit(text).alias("value"))
        for part, text in ((0, head), (2, tail))
    ]
    lines = body.unionAll(frame[0]).unionAll(frame[1])
    lines.repartition(1).sortWithinPartitions("part", "label").select("value").write.mode(mode).text(path)
