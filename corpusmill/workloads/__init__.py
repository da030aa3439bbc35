"""Registered queries over the given tables, with their SQL oracles."""

from __future__ import annotations

from corpusmill.workloads import (
    boxes,
    calibration,
    catalog,
    evaluation,
    images,
    roundtrips,
    splits,
    streams,
    trainset,
    vectors,
    verdict,
)

MODULES = (vectors, catalog, boxes, verdict, calibration, splits, trainset, evaluation, streams, roundtrips, images)


def all_queries() -> dict:
    found: dict = {}
    for module in MODULES:
        found.update(module.QUERIES)
    return found


def all_oracles() -> dict[str, str]:
    found: dict[str, str] = {}
    for module in MODULES:
        found.update(module.ORACLES)
    return found
