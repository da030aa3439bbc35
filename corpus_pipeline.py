"""Corpus pipeline: stages over documents, each written as Parquet and read again."""

from __future__ import annotations

from corpusmill.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
