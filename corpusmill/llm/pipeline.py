"""Stages of the corpus pipeline; every stage calls one operator on all its predecessor kept.

All stages but the last return the columns of their input. A document is a row, known
by the hash of its doc_id and text: rows that share a doc_id or have none are told
apart by their texts, and rows that repeat both are copies, of which the
near-duplicate stage keeps one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import decontaminate, language, lines, packing, simhash, simhash_wide
from corpusmill.llm.components import components
from corpusmill.llm.queries import tokenizer_path
from corpusmill.llm.tables import pieces, sized, stored, table


def _row() -> Column:
    return F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the row's key as doc_id."""
    return docs.select(_row().alias("doc_id"), "text")


def _without(docs: DataFrame, gone: DataFrame, label: str) -> DataFrame:
    """The documents whose row key isn't in ``gone``: a broadcast of counted size, else a merge join."""
    ids = stored(gone.select(F.col("doc_id").alias("_gone_row")).distinct(), label)
    return docs.join(sized(ids, 16), _row() == F.col("_gone_row"), "left_anti")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near a known language; those without letters or far from all go."""
    model = language.learn(docs)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            yield part.filter(pa.array(~model.predict(texts)[2]))

    return docs.mapInArrow(known, docs.schema)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat earlier ones; those of which nothing is left go."""
    done = lines.deduplicated(docs)
    empty = (F.col("_dropped") > 0) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    kept = done.filter(~F.coalesce(empty, F.lit(False)))
    if "n_chars" in docs.columns:
        kept = kept.withColumn(
            "n_chars", F.when(F.col("_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("bigint")
        )
    return kept.select(docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row of the smallest doc_id, null last.

    Near are rows whose SimHash fingerprints differ in at most two bits, and rows at
    an exact similarity of 0.8 (five words), which wide fingerprints are the first look for.
    """
    rows = stored(
        docs.groupBy(_row().alias("_row"), F.col("doc_id").alias("_id")).agg(F.count(F.lit(1)).alias("n")), "pipeline-rows"
    )
    keyed = _keyed(docs)
    narrow = simhash.simhash_components(keyed).select(F.col("doc_id").alias("a"), F.col("component_id").alias("b"))
    wide = simhash_wide.similar_groups(keyed).select(F.col("doc_id").alias("a"), F.col("group_id").alias("b"))
    # Each stored by itself, as the driver plans a table anew after each of its stages.
    links = stored(narrow.filter("a <> b"), "pipeline-links").unionAll(stored(wide.filter("a <> b"), "pipeline-links"))
    linked = components(links, "pipeline-groups").withColumnRenamed("u", "_row")
    placed = rows.join(linked, "_row", "left").withColumn("group_id", F.coalesce("root", "_row"))
    place = F.struct(F.col("_id").isNull().alias("unnamed"), "_id", "_row")
    least = placed.groupBy("group_id").agg(F.min(place).getField("_row").alias("_kept"))
    gone = placed.join(least, "group_id").filter("_row <> _kept").select(F.col("_row").alias("doc_id"))
    kept = _without(docs, gone, "pipeline-near")
    again = stored(rows.filter("n > 1").select(F.col("_row").alias("_again")), "pipeline-repeated")
    if again.isEmpty():
        return kept
    # Of rows that repeat both doc_id and text one stays.
    again, same = sized(again, 16), F.col("_again") == _row()
    one = kept.join(again, same, "inner").dropDuplicates(["_again"]).drop("_again")
    return kept.join(again, same, "left_anti").unionAll(one)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    found = decontaminate.contaminated(_keyed(docs), table(spark, sf_dir, "benchmark"))
    return _without(docs, found, "pipeline-leaks")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2048 tokens."""
    return packing.packed(docs, tokenizer_path())


STAGES = [
    ("language", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash", dedup_near),
    ("decontamination", decontaminate_benchmark),
    ("packing", pack),
]

# Fingerprints, the tokenizer and learned models have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
