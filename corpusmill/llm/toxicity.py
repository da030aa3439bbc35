"""Counterfactual-regularised toxicity classifier.

A logistic model over the presence of words and word beginnings in a text.
Labelled texts that mention a group are paired with a copy in which the
identity terms are swapped for those of another group; the loss adds a penalty
on the squared difference of the two scores. A term for a group therefore gets
no weight of its own from labels that happen to go with it, and a neutral
mention isn't held against a text.

Learning uses at most ``sample`` labelled rows (the smallest hashes of their
ids) outside the held-out fold. Their texts are read in Spark tasks: class
counts of features are summed by Spark, the ``kept`` features with the highest
log-odds evidence are chosen, and only the numbers of those present in each
sampled text reach the driver, where numpy fits the weights. Scoring is one
Arrow pass over all whole texts.

Defined results: a null or empty text gets the score of the intercept; a null
doc_id counts as held out; rows that repeat a doc_id are scored one by one.
Conflicting labels of one id are all used; labels other than 0 and 1, and those
without a document, are not. With fewer than two classes to learn from, every score is the
share of toxic rows in the sample (0.5 without rows). Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tables import pieces, remainder, smallest_hashes

SAMPLE = 20_000
KEPT = 4096
CACHED_WORDS = 300_000
STRIPPED = ".,;:!?\"'()[]{}<>«»“”„¡¿*_~`|/\\-–—…#$%&+="

# Identity terms (fixed values): each line is one kind of group, terms of a line are swapped for each other.
IDENTITY_GROUPS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male", "transgender", "nonbinary"),
    ("gay", "straight", "lesbian", "bisexual", "queer", "heterosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "hispanic", "african", "european", "indigenous"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("disabled", "blind", "deaf", "autistic"),
    ("elderly", "young"),
)
_SWAP = {term: group[(i + 1) % len(group)] for group in IDENTITY_GROUPS for i, term in enumerate(group)}


def word_features(word: str) -> list[str]:
    """The word without punctuation and its first four and five letters."""
    word = word.strip(STRIPPED)
    if not word:
        return []
    return [word, *(f"{word[:n]}*" for n in (4, 5) if len(word) > n)]


def swapped(words: set[str]) -> set[str]:
    """The same words with every identity term exchanged."""
    return {_SWAP.get(w.strip(STRIPPED), w) for w in words}


class _Numbers(dict):
    """Word to the numbers of its chosen features; forgets all when full."""

    def __init__(self, chosen: list[str]):
        super().__init__()
        self.chosen = {f: i for i, f in enumerate(chosen)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = tuple(self.chosen[f] for f in word_features(word) if f in self.chosen)
        return value

    def present(self, words: set[str]) -> list[int]:
        return sorted({i for numbers in map(self.__getitem__, words) if numbers for i in numbers})


def labelled(docs: DataFrame, labels: DataFrame, held_out_of: int, sample: int) -> DataFrame:
    """(text, toxic) of the sampled learning rows; the sample is broadcast, texts aren't moved."""
    known = labels.filter((remainder("doc_id", held_out_of) != 0) & F.col("toxic").isin(0, 1)).select(
        F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic")
    )
    rows = smallest_hashes(known, ["_id", "toxic"], sample)
    return docs.select("doc_id", "text").join(F.broadcast(rows), F.col("doc_id") == F.col("_id")).select("text", "toxic")


def _evidence(learn: DataFrame, kept: int) -> list[str]:
    """The features whose presence says most about the class."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_class = (Counter(), Counter())
        for part, texts in pieces(batches):
            for text, toxic in zip(texts, part.column("toxic").to_pylist(), strict=True):
                by_class[toxic].update({f for w in set(text.lower().split()) for f in word_features(w)})
        names = list(by_class[0].keys() | by_class[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array([c[x] for x in names], pa.int64()) for c in by_class)],
            ["feature", "clean", "toxic"],
        )

    totals = {r["toxic"]: r["count"] for r in learn.groupBy("toxic").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    rows = (
        learn.mapInArrow(counted, "feature string, clean bigint, toxic bigint")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter(F.col("clean") + F.col("toxic") > 3)
        .withColumn("evidence", F.abs(odds) * F.sqrt(F.col("clean") + F.col("toxic")))
        .orderBy(F.desc("evidence"), "feature")
        .limit(kept)
    )
    return [r["feature"] for r in rows.select("feature").collect()]


def _sampled(learn: DataFrame, chosen: list[str], sample: int) -> pa.Table:
    """(toxic, own, other): feature numbers of the sampled texts and of their counterfactuals, ``sample`` rows at most."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers(chosen)
        for part, texts in pieces(batches):
            words = [set(x.lower().split()) for x in texts]
            own, other = ([numbers.present(f(w)) for w in words] for f in (set, swapped))
            yield pa.RecordBatch.from_arrays(
                [part.column("toxic"), *(pa.array(x, pa.list_(pa.int32())) for x in (own, other))],
                ["toxic", "own", "other"],
            )

    rows = learn.mapInArrow(numbered, "toxic int, own array<int>, other array<int>")
    # A doc_id that many rows repeat brings them all; a hash of what is learnt from them chooses.
    return rows.orderBy(F.xxhash64("toxic", "own", "other"), "toxic", "own").limit(sample).toArrow()


def _matrix(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of every set cell."""
    numbers = lists.to_pylist()
    row = np.repeat(np.arange(len(numbers)), [len(x) for x in numbers])
    return row, np.fromiter((i for x in numbers for i in x), np.int64, len(row))


def fit(
    own: tuple[np.ndarray, np.ndarray],
    other: tuple[np.ndarray, np.ndarray],
    toxic: np.ndarray,
    width: int,
    penalty: float = 1.0,
    ridge: float = 1e-4,
    rounds: int = 400,
    rate: float = 0.1,
) -> tuple[np.ndarray, float]:
    """Weights and intercept by Adam on the whole sample; ``penalty`` weighs the counterfactual term."""
    rows = len(toxic)
    weights = np.zeros(width)
    bias = math.log((toxic.sum() + 1) / (rows - toxic.sum() + 1))
    first, second = np.zeros(width + 1), np.zeros(width + 1)

    def scores(cells: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        return np.bincount(cells[0], weights[cells[1]], rows) + bias

    def back(cells: tuple[np.ndarray, np.ndarray], slope: np.ndarray) -> np.ndarray:
        return np.bincount(cells[1], slope[cells[0]], width)

    for step in range(1, rounds + 1):
        z, z_other = scores(own), scores(other)
        error = (1 / (1 + np.exp(-z)) - toxic) / rows
        gap = 2 * penalty * (z - z_other) / rows
        slope = back(own, error + gap) - back(other, gap) + 2 * ridge * weights
        slope = np.append(slope, error.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, bias


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    held_out_of: int = 5,
    sample: int = SAMPLE,
    kept: int = KEPT,
    penalty: float = 1.0,
) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per document."""
    learn = labelled(docs, labels, held_out_of, sample)
    chosen = _evidence(learn, kept)
    table = _sampled(learn, chosen, sample)
    toxic = table["toxic"].to_numpy().astype(float)
    if 0 < toxic.sum() < len(toxic):
        weights, bias = fit(_matrix(table["own"]), _matrix(table["other"]), toxic, len(chosen), penalty)
    else:
        share = (toxic.sum() + 1) / (len(toxic) + 2) if len(toxic) else 0.5
        weights, bias = np.zeros(len(chosen)), math.log(share / (1 - share))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers(chosen)
        for part, texts in pieces(batches):
            z = np.array([weights[numbers.present(set(x.lower().split()))].sum() for x in texts]) + bias
            score = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    read = docs.select("doc_id", (remainder("doc_id", held_out_of) == 0).alias("held_out"), "text")
    id_type = read.schema["doc_id"].dataType.simpleString()
    return read.mapInArrow(scored, f"doc_id {id_type}, held_out boolean, score double, predicted int")
