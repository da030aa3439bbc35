"""Language identification by the nearest of several centroids per language.

A text becomes the hashed counts of its byte trigrams (letters lower-cased,
ASCII characters that aren't letters as spaces), damped, weighted by inverse
document frequency and normalised. The vectors of each language's sample are
clustered on the sphere into a few centroids; a text gets the language of the
centroid with the largest cosine. It is rejected if that cosine is below the one
that a share ``QUANTILE`` of the sampled texts of the language fall short of, cut to
the least length of the text's class (``EDGES``, in characters). A class of fewer
than ``ENOUGH`` texts takes the quantile of all languages, and if these have too few
the bound of the next shorter class. Below the first edge only texts without a
letter are rejected.

Learning uses at most ``per_language`` rows of each language (the smallest
hashes of their ids) that hold a letter, outside the held-out fold. They are
vectorised in tasks and clustered by one task; the driver receives the centroids
and the quantiles.

Defined results: a null text or one without any letter is ``und`` with score 0
and is rejected; a null doc_id takes part like the empty id; rows that repeat a
doc_id are predicted one by one. Without anything to learn from, every text is
``und``. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tables import pieces, release, remainder, stored
from corpusmill.plans.ranking import top_n

WIDTH = 4096
PER_LANGUAGE = 1000
CENTROIDS = 4
QUANTILE = 0.01
ENOUGH = 20
EDGES = tuple(8 << i for i in range(9))
UNKNOWN = "und"
BLOCK = 256
_LETTERS = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))


def counts(texts: list[str]) -> np.ndarray:
    """Hashed trigram counts, one row per text."""
    data = [b" " + x.lower().encode("utf-8", "replace").translate(_LETTERS) + b"  " for x in texts]
    all_ = np.frombuffer(b"".join(data), np.uint8).astype(np.uint32)
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    code = all_[:-2] * np.uint32(0x9E3779B1) + all_[1:-1] * np.uint32(0x85EBCA6B) + all_[2:] * np.uint32(0xC2B2AE35)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x2C1B3C6D)
    blank = (all_[:-2] == 32) & (all_[1:-1] == 32)
    cell = (code >> np.uint32(20)).astype(np.int64) + np.repeat(np.arange(len(data)) * WIDTH, sizes)[:-2]
    return np.bincount(cell[~blank], minlength=len(data) * WIDTH).reshape(len(data), WIDTH)


def vectors(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.empty(found.shape, np.float32)
    for at in range(0, len(found), BLOCK):
        weighted = np.log1p(found[at : at + BLOCK].astype(np.float32)) * idf
        out[at : at + BLOCK] = weighted / np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-9)
    return out


def cluster(points: np.ndarray, many: int, rounds: int = 12) -> np.ndarray:
    """Centroids of spherical k-means, begun from different points far from each other."""
    points = points[np.linalg.norm(points, axis=1) > 0]
    if not len(points):
        return points
    chosen = [points.mean(axis=0) / max(np.linalg.norm(points.mean(axis=0)), 1e-9)]
    for _ in range(min(many, len(points)) - 1):
        nearest = np.max(points @ np.array(chosen).T, axis=1)
        if nearest.min() > 1 - 1e-5:  # all points are chosen ones
            break
        chosen.append(points[np.argmin(nearest)])
    centres = np.array(chosen)
    for _ in range(rounds):
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
        nearest = np.argmax(points @ centres.T, axis=1)
        centres = np.array(
            [points[nearest == i].sum(axis=0) if (nearest == i).any() else centres[i] for i in range(len(centres))]
        )
    return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)


class Model:
    """Centroids with their languages, document frequencies and rejection bounds."""

    def __init__(self, found: np.ndarray, languages: list[str], many: int = CENTROIDS):
        rows = max(len(languages), 1)
        self.idf = (np.log((1 + rows) / (1 + (found > 0).sum(axis=0))) + 1).astype(np.float32)
        points, own = vectors(found, self.idf), np.array(languages, object)
        self.names: list[str] = []
        parts = []
        for name in sorted(set(languages)):
            mine = points[own == name]
            centres = cluster(mine, many)
            parts.append(centres)
            self.names += [name] * len(centres)
        self.centres = np.concatenate(parts) if parts else np.zeros((0, WIDTH), np.float32)
        # Of each centroid: rejection bounds below the first edge, and of the class from each edge.
        self.bounds = np.zeros((len(self.names), 1 + len(EDGES)))

    def cosines(self, texts: list[str], languages: list[str]) -> list[tuple[str, int, float]]:
        """(language, class, cosine) of texts cut to each edge they reach, by the centroids of their language."""
        out = []
        for edge, at in zip(EDGES, range(1, 1 + len(EDGES)), strict=True):
            own = [(x[:edge], y) for x, y in zip(texts, languages, strict=True) if len(x) >= edge]
            own = [(x, y) for x, y in own if any(map(str.isalpha, x))]
            for start in range(0, len(own), BLOCK):
                block = own[start : start + BLOCK]
                found = vectors(counts([x for x, _ in block]), self.idf) @ self.centres.T
                other = np.array([[name != y for name in self.names] for _, y in block])
                best = np.where(other, -1.0, found).max(axis=1)
                out += [(y, at, float(c)) for (_, y), c in zip(block, best, strict=True)]
        return out

    def bound(self, quantiles: dict[tuple[str | None, int], tuple[int, float]]) -> None:
        """Takes the bounds from the (number, quantile) of each language (None: of all) and class."""
        for i, name in enumerate(self.names):
            for at in range(1, 1 + len(EDGES)):
                n, least = quantiles.get((name, at), (0, 0.0))
                if n < ENOUGH:
                    n, least = quantiles.get((None, at), (0, 0.0))
                before = self.bounds[i, at - 1]
                self.bounds[i, at] = max(before, least) if n >= ENOUGH else before

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and rejection of each text."""
        names, cosines, rejected = [], [], []
        for at in range(0, len(texts), BLOCK):
            block = texts[at : at + BLOCK]
            known = np.array([any(map(str.isalpha, x)) for x in block]) & bool(self.names)
            if not self.names:
                best, cosine = np.zeros(len(block), int), np.zeros(len(block))
            else:
                cosine = vectors(counts(block), self.idf) @ self.centres.T
                best = np.argmax(cosine, axis=1)
                cosine = np.clip(cosine[np.arange(len(block)), best], 0, 1)
            names += [self.names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            cosines.append(np.where(known, cosine, 0.0))
            length = np.searchsorted(EDGES, [len(x) for x in block], side="right")
            rejected.append(~known | (cosine < (self.bounds[best, length] if self.names else 0)))
        return names, np.concatenate(cosines or [[]]).astype(float), np.concatenate(rejected or [[]]).astype(bool)


def learn(docs: DataFrame, fold: int = 4, held_out: int = 2, per_language: int = PER_LANGUAGE) -> Model:
    """Model of the rows whose id isn't in the held-out fold and whose language is known."""
    lettered = docs.filter(F.col("text").rlike(r"\p{L}"))
    own = lettered.filter((remainder("doc_id", fold) != held_out) & F.col("lang").isNotNull()).select(
        "doc_id", F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("text_hash")
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("text_hash")]
    chosen = top_n(own, ["lang"], order, per_language).select(
        F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), F.col("text_hash").alias("_hash")
    )

    def vectorised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            found = np.minimum(counts(texts), 60_000).astype("<u2") if texts else []
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), pa.array([x.tobytes() for x in found], pa.binary())], ["lang", "found"]
            )

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(tuple(r.values()) for batch in batches for r in batch.to_pylist())
        languages, found = [x for x, _ in rows], b"".join(x for _, x in rows)
        del rows
        whole = pickle.dumps(Model(np.frombuffer(found, "<u2").reshape(-1, WIDTH), languages))
        del found
        release()
        yield pa.RecordBatch.from_arrays([pa.array([whole])], ["model"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            rows = model.cosines(texts, part.column("lang").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.float64())],
                ["lang", "class", "cosine"],
            )

    same = (
        F.col("doc_id").eqNullSafe(F.col("_id"))
        & (F.col("lang") == F.col("_lang"))
        & (F.col("text_hash") == F.col("_hash"))
    )
    # Rows that repeat one document are one, so no language has more than its number of rows.
    sample = stored(
        lettered.select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
        .withColumn("text_hash", F.xxhash64("text"))
        .join(F.broadcast(chosen), same, "left_semi")
        .dropDuplicates(["doc_id", "lang", "text_hash"])
        .select("lang", "text"),
        "language-sample",
    )
    found = sample.mapInArrow(vectorised, "lang string, found binary")
    row = found.repartition(1).mapInArrow(fitted, "model binary").first()
    model = pickle.loads(row["model"]) if row else Model(np.zeros((0, WIDTH), "<u2"), [])
    if model.names:
        cosines = sample.mapInArrow(compared, "lang string, class int, cosine double")
        least = cosines.rollup("class", "lang").agg(
            F.count(F.lit(1)).alias("n"), F.percentile("cosine", F.lit(QUANTILE)).alias("least")
        )
        model.bound({(r["lang"], r["class"]): (r["n"], r["least"]) for r in least.collect()})
    return model


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, rejected): one row per document."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            names, cosine, rejected = model.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(names, pa.string()), pa.array(cosine), pa.array(rejected)],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        named, f"doc_id {id_type}, lang_pred string, score double, rejected boolean"
    )


def identified(docs: DataFrame, fold: int = 4, held_out: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learnt from and applied to one table."""
    found = predicted(docs, learn(docs, fold, held_out))
    return found.select("doc_id", (remainder("doc_id", fold) == held_out).alias("held_out"), "lang_pred", "score")
