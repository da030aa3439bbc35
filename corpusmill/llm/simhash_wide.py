"""Groups at an exact word-shingle similarity; wide SimHash fingerprints are the first look.

Two texts are linked if the Jaccard similarity of their shingle sets is at least
``similarity``; groups are the components of these links. Texts of one shingle
set are one node.

Candidates. All shingles have one order, the common ones last: by how many documents
hold a shingle of the same cell, a cell being some bits of the hash. All documents are
counted, in a table of ``CELLS`` numbers at any size; a shingle is known as common as
far as it stands out of the chance variation of a cell. Of n shingles the first ``n - ceil(similarity * n) + 1`` are index keys: two sets at
the similarity share at least one of them, whatever the order is, so every pair
to be linked meets in an entry.

Entries are not paired with themselves at once. In each of ``TURNS`` rounds one
member of an entry is compared with all others, and the components are formed;
entries that lie in one component are done. So copies of one text, however many,
need comparisons in proportion to their number. In what is left all members of
different components are compared: no pair is left out for the size of an entry,
and the work is quadratic in the members of an entry that belong to no common group.

Decision. Pairs that differ in more than ``FAR`` of 256 fingerprint bits go
unread (random texts differ in 128; at a similarity of 0.8 less than one pair
in 10**9 differs in as many); of all others the exact similarity of the
shingle sets decides.

Defined results: as for ``simhash``; texts without a word are all alike. Shingles
are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.components import components
from corpusmill.llm.simhash import BLOCK, SEED
from corpusmill.llm.tables import pieces, sized, stored

WORDS = ("w0", "w1", "w2", "w3")
BITS = 64 * len(WORDS)
FAR = 96
TURNS = 2
CROWDED = 24
CELLS = 1 << 22
PART = 1 << 12
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def shingles_of(text: str, width: int) -> np.ndarray:
    """Hashes of a text's different shingles, in ascending order."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    many = max(1, len(words) - width + 1)
    first, last = starts[:many], ends[-many:] - 1
    digest = xxhash.xxh64_digest
    shingles = b"".join(digest(joined[a:b], SEED) for a, b in zip(first.tolist(), last.tolist(), strict=True))
    return np.unique(np.frombuffer(shingles, ">u8").astype(np.uint64))


def wide_bits(distinct: np.ndarray) -> bytes:
    """The four words of a shingle set, big-endian."""
    counts = np.zeros((len(WORDS), 64), np.int64)
    for at in range(0, len(distinct), BLOCK):
        h = distinct[at : at + BLOCK]
        for i in range(len(WORDS)):
            if i:
                h = (h ^ (h >> np.uint64(31))) * np.uint64(_MIX[i - 1])
                h ^= h >> np.uint64(29)
            bits = np.unpackbits(h.astype(">u8").view(np.uint8)).reshape(-1, 64)
            counts[i] += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(distinct)).tobytes()


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(CELLS - 1)).astype(np.intp)


def index_keys(distinct: np.ndarray, similarity: float, counts: np.ndarray) -> np.ndarray:
    """The first shingles of a set, of which two similar sets share one; those of full cells come last."""
    if not len(distinct):
        return distinct
    many = len(distinct) - math.ceil(similarity * len(distinct) - 1e-9) + 1
    return distinct[np.lexsort((distinct, counts[_cell(distinct)]))[:many]]


def _node(distinct: np.ndarray) -> int:
    return int.from_bytes(xxhash.xxh64_digest(distinct.tobytes(), SEED), "big", signed=True)


def _lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
    values = np.concatenate(found) if found else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))


def _packed(number: int, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int32()), pa.array([pa.compress(counts.tobytes(), codec="lz4", asbytes=True)], pa.binary())],
        ["part", "counts"],
    )


def _unpacked(counts: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(counts, PART * 4, codec="lz4", asbytes=True), np.uint32)


def cell_counts(read: DataFrame, width: int) -> np.ndarray:
    """How many documents hold a shingle of each cell, over all rows; the counts only affect the cost."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, np.uint32)
        for _, texts in pieces(batches):
            for x in texts:
                np.add.at(counts, _cell(shingles_of(x, width)), np.uint32(1))
        for number, part in enumerate(counts.reshape(-1, PART)):
            if part.any():
                yield _packed(number, part)

    def added(key: tuple, found: pa.Table) -> pa.Table:
        total = np.zeros(PART, np.uint32)
        for part in found.column("counts"):
            total += _unpacked(part.as_py())
        return pa.Table.from_batches([_packed(key[0].as_py(), total)])

    schema = "part int, counts binary"
    whole = np.zeros((CELLS // PART, PART), np.uint32)
    for row in read.mapInArrow(counted, schema).groupBy("part").applyInArrow(added, schema).collect():
        whole[row["part"]] = _unpacked(bytes(row["counts"]))
    return whole.reshape(-1)


def _hashed(read: DataFrame, width: int, similarity: float, counts: Broadcast | None = None) -> DataFrame:
    """(doc_id, node, size, w0..w3, keys): the shingle set of every row; ``counts`` are those of the cells."""
    counts = counts or read.sparkSession.sparkContext.broadcast(cell_counts(read, width))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            sets = [shingles_of(x, width) for x in texts]
            found = np.frombuffer(b"".join(map(wide_bits, sets)), ">i8").astype(np.int64).reshape(-1, len(WORDS))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([_node(x) for x in sets], pa.int64()), pa.array([len(x) for x in sets], pa.int32()),
                 *(pa.array(found[:, i]) for i in range(len(WORDS))),
                 _lists([index_keys(x, similarity, counts.value) for x in sets])],
                ["doc_id", "node", "size", *WORDS, "keys"],
            )

    fields = ", ".join(f"{w} bigint" for w in WORDS)
    return read.mapInArrow(words, f"doc_id bigint, node bigint, size int, {fields}, keys array<bigint>")


def _sets(read: DataFrame, width: int, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes whose ``first`` document is wanted, one row each."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in pieces(batches):
            sets = [shingles_of(x, width) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_node(x) for x in sets], pa.int64()), _lists(sets)], ["node", "shingles"]
            )

    ids = stored(wanted.select(F.col("first").alias("_first")).distinct(), "wide-firsts")
    rows = read.join(sized(ids, 16), read["doc_id"].eqNullSafe(F.col("_first")), "left_semi")
    sets = rows.mapInArrow(listed, "node bigint, shingles array<bigint>")
    # Rows that repeat a document leave their tasks as one.
    return stored(sets.dropDuplicates(["node"]), "wide-sets")


def _differing(left: str, right: str) -> Column:
    parts = [F.bit_count(F.col(f"{left}{w}").bitwiseXOR(F.col(f"{right}{w}"))) for w in WORDS]
    return sum(parts[1:], parts[0])


def _verified(pairs: DataFrame, nodes: DataFrame, read: DataFrame, width: int, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) of nodes whose shingle sets are as similar.

    Sets are made anew for the few nodes whose fingerprints are near another's.
    """
    for side, name in (("l_", "a"), ("r_", "b")):
        words = nodes.select(F.col("node").alias(name), *[F.col(w).alias(f"{side}{w}") for w in WORDS])
        pairs = pairs.join(words, name)
    pairs = stored(pairs.filter(_differing("l_", "r_") <= FAR).select("a", "b"), "wide-pairs")
    wanted = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct()
    sets = _sets(read, width, nodes.join(wanted, "node", "left_semi"))
    for side, name in (("l", "a"), ("r", "b")):
        pairs = pairs.join(sets.select(F.col("node").alias(name), F.col("shingles").alias(side)), name)
    both = F.size(F.array_intersect("l", "r"))
    enough = both * (1 + similarity) + 1e-9 >= similarity * (F.size("l") + F.size("r"))
    return pairs.filter(enough).select("a", "b").distinct()


def _open(entries: DataFrame) -> DataFrame:
    """The entries (key, node, size, root) whose members are not all in one component."""
    ends = entries.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n"))
    return entries.join(ends.filter("low <> high").select("key", "n").hint("merge"), "key")


def wide_links(
    postings: DataFrame, nodes: DataFrame, read: DataFrame, width: int, similarity: float, crowded: int = CROWDED
) -> DataFrame | None:
    """Links (a, b) that connect all nodes of the postings (key, node, size, root, n) at the similarity."""
    short = F.least("size", "r_size") + 1e-9 >= similarity * F.greatest("size", "r_size")
    links, left = None, postings
    for turn in range(TURNS + 1):
        if left.isEmpty():
            break
        # The last round, and small entries after the first, compare all that is left.
        whole = F.lit(turn == TURNS) | ((F.col("n") <= crowded) & F.lit(turn > 0))
        order = F.xxhash64("node", F.lit(turn))
        rest = left.withColumn("whole", whole)
        pivots = rest.filter(~F.col("whole")).groupBy("key").agg(
            F.min_by(F.struct("node", "size", "root"), order).alias("p")
        ).select("key", "p.*")
        other = rest.filter("whole").select("key", "node", "size", "root").unionAll(pivots)
        other = other.select(
            "key", F.col("node").alias("r_node"), F.col("size").alias("r_size"), F.col("root").alias("r_root")
        )
        met = rest.join(other, "key").filter((F.col("root") != F.col("r_root")) & short)
        pairs = met.select(F.least("node", "r_node").alias("a"), F.greatest("node", "r_node").alias("b")).distinct()
        found = stored(_verified(pairs, nodes, read, width, similarity), "wide-links")
        links = found if links is None else links.unionAll(found)
        if turn == TURNS:
            break
        roots = components(links, "wide-edges").withColumnRenamed("u", "node").withColumnRenamed("root", "up")
        now = rest.filter("not whole").select("key", "node", "size").join(roots, "node", "left")
        left = stored(_open(now.select("key", "node", "size", F.coalesce("up", "node").alias("root"))), "wide-open")
    return links


def similar_groups(
    docs: DataFrame,
    width: int = 5,
    similarity: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
    crowded: int = CROWDED,
) -> DataFrame:
    """(doc_id, group_id): one row per document; a group is named by its smallest doc_id."""
    read = _read(docs, id_col, text_col)
    counts = read.sparkSession.sparkContext.broadcast(cell_counts(read, width))
    hashed = stored(_hashed(read, width, similarity, counts), "wide")
    counts.destroy()  # in the driver too
    nodes = stored(hashed.groupBy("node", "size", *WORDS).agg(F.min("doc_id").alias("first")), "wide-nodes")
    entries = hashed.select("node", "size", F.explode("keys").alias("key"))
    # Most keys are met by one node; they leave before anything but keys and nodes is shuffled.
    ends = entries.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    shared = stored(ends.filter("low <> high").select("key"), "wide-shared")
    entries = entries.join(sized(shared, 16), "key", "left_semi").distinct()
    entries = stored(_open(entries.withColumn("root", F.col("node"))), "wide-entries")
    met = stored(nodes.join(entries.select("node").distinct(), "node", "left_semi"), "wide-met")
    links = wide_links(entries, met, read, width, similarity, crowded)
    if links is None:
        links = entries.select(F.col("node").alias("a"), F.col("root").alias("b"))
    linked = components(links, "wide-edges").withColumnRenamed("u", "node")
    rooted = nodes.select("node", "first").join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = rooted.groupBy("root").agg(F.min("first").alias("group_id"))
    return hashed.select("doc_id", "node").join(rooted.join(named, "root").select("node", "group_id"), "node").select(
        "doc_id", "group_id"
    )
