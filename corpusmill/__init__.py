"""Labelled-corpus curation as Spark DataFrame jobs."""

from corpusmill.session import get_session

__all__ = ["get_session"]
