"""Registered queries of the text operators over the given tables, with SQL where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import bpe, decontaminate, dsir, exact, fim, html, language, lines, packing, pii, ppm, simhash
from corpusmill.llm import toxicity
from corpusmill.llm.tables import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the lines that stay, and how many it had and lost."""
    return lines.deduplicated(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped")
    )


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path())


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(table(spark, sf_dir, "pages"))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.ppm_scores(table(spark, sf_dir, "documents"))


def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dsir.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def bpe_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES = {
    "op1_pii": personal_data,
    "op2_line_dedup": line_dedup,
    "op3_exact_dedup": exact_dedup,
    "op4_html": html_text,
    "op5_toxicity": toxicity_scores,
    "op6_language": language_id,
    "op7_packing": packing_query,
    "op8_simhash": simhash_near_dedup,
    "op9_ppm": ppm_scores,
    "op10_decontamination": decontamination,
    "op11_fim": fill_in_middle,
    "op12_resampling": importance_resampling,
    "op13_bpe": bpe_digests,
}

ORACLES = {"op3_exact_dedup": exact.ORACLE, "op11_fim": fim.ORACLE, "op12_resampling": dsir.ORACLE}
