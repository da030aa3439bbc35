"""SimHash near duplicates through multi-index hashing.

A fingerprint is cut into segments. Two fingerprints that differ in at most r
bits differ in few bits of some segment, so each segment has a table that is
probed with the small Hamming ball around the segment's value; complete
distances of the matches are then verified.

Contents of a crowded table entry are never paired with each other. Members of
one entry agree on a segment, and any two of them within two bits of each other
share a *centre*: a fingerprint at most one bit away from both. Grouping by
centres links each member to the smallest one, which gives the same components
with a number of rows in proportion to the members.

Defined results: a null or empty text has fingerprint zero and is linked like
any other; rows that repeat a doc_id are linked by their fingerprints; rows
with a null doc_id take part, but a null never names a component unless all its
rows have one. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.components import components
from corpusmill.llm.tables import pieces, stored

SEED = 42
CROWDED = 48
BLOCK = 1 << 16


def fingerprint_bits(text: str, width: int, seeds: tuple[int, ...] = (SEED,)) -> bytes:
    """Big-endian fingerprint of 8 bytes a seed over shingles of ``width`` words."""
    joined = b" ".join(words := text.encode("utf-8", "replace").lower().split())
    if not words:
        return bytes(8 * len(seeds))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    if len(words) > width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    total = len(starts)
    parts = []
    for seed in seeds:
        digest = xxhash.xxh64_digest
        counts = np.zeros(64, np.int64)
        for at in range(0, total, BLOCK):
            hashed = b"".join(
                digest(joined[a : b - 1], seed)
                for a, b in zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist(), strict=True)
            )
            bits = np.unpackbits(np.frombuffer(hashed, np.uint8)).reshape(-1, 64)
            counts += bits.sum(axis=0, dtype=np.int64)
        parts.append(np.packbits(counts * 2 > total).tobytes())
    return b"".join(parts)


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the 64 bits as a signed number, one row per document."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            bits = b"".join(fingerprint_bits(x, width) for x in texts)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.frombuffer(bits, ">i8").astype(np.int64))], ["doc_id", "fp"]
            )

    read = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return read.mapInArrow(hashed, "doc_id bigint, fp bigint")


def _flips(value: Column, bits: int = 32) -> Column:
    """All numbers one bit away."""
    return F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), lambda j: value.bitwiseXOR(_one(j)))


def _one(j: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), j)


def bit_links(fps: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that connect all those within two bits.

    Segments are the two halves. Two bits of difference leave at most one in
    the high half or none in the low half, so the high table is probed with a
    ball of radius one and the low table with the value itself. Of a probe and
    its mirror image only the one that sets a bit is made.
    """
    high, low = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit((1 << 32) - 1))
    halves = fps.select("fp", high.alias("hi"), low.alias("lo"))
    unset = F.filter(
        F.sequence(F.lit(0), F.lit(31)), lambda j: F.col("hi").bitwiseAND(_one(j)) == F.lit(0).cast("bigint")
    )
    entry = lambda segment, value, own: F.struct(
        F.lit(segment).alias("segment"), value.alias("value"), F.lit(own).alias("own")
    )
    probes = F.concat(
        F.array(entry(0, F.col("hi"), True), entry(1, F.col("lo"), True)),
        F.transform(unset, lambda j: entry(0, F.col("hi").bitwiseOR(_one(j)), False)),
    )
    postings = halves.select("fp", "hi", "lo", F.explode(probes).alias("e")).select("fp", "hi", "lo", "e.*")
    met = (
        postings.groupBy("segment", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("owned"))
        .filter("n > 1 and owned")
        .drop("owned")
    )
    live = stored(postings.join(met, ["segment", "value"]), "simhash-live")

    few = live.filter(F.col("n") <= CROWDED)
    left = few.filter("own").select("segment", "value", F.col("fp").alias("a"))
    right = few.select("segment", "value", F.col("fp").alias("b"), F.col("own").alias("b_own"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2
    pairs = (
        left.join(right, ["segment", "value"])
        .filter((~F.col("b_own") | (F.col("a") < F.col("b"))) & near)
        .select("a", "b")
    )

    many = live.filter(F.col("n") > CROWDED)
    rest = F.when(F.col("segment") == 0, F.col("lo")).otherwise(F.col("hi"))
    around = F.when(F.col("own"), F.concat(F.array(rest), _flips(rest))).otherwise(F.array(rest))
    centres = many.select("fp", "segment", "value", F.explode(around).alias("rest"))
    least = centres.groupBy("segment", "value", "rest").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n"))
    stars = (
        centres.join(least.filter("n > 1"), ["segment", "value", "rest"])
        .filter("a <> fp")
        .select("a", F.col("fp").alias("b"))
    )
    return pairs.unionAll(stars)


def simhash_components(
    docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per document.

    The component is named by the smallest doc_id that links of at most two
    differing bits reach.
    """
    hashed = stored(fingerprints(docs, width, id_col, text_col), "simhash")
    fps = hashed.groupBy("fp").agg(F.min("doc_id").alias("first"))
    linked = components(bit_links(fps.select("fp")), "simhash-edges")
    rooted = fps.join(linked.withColumnRenamed("u", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return hashed.join(rooted.select("fp", "root").join(named, "root"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
