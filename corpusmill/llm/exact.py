"""Exact duplicates through an extendible-hash index on shared files.

The directory maps a prefix of a text's hash to a bucket. Buckets that hold
more than ``bucket_rows`` entries are split by one more bit, which doubles the
directory where that is needed; a bucket whose entries all share one hash stays
as it is. An entry stands for all rows of one hash and is counted before any
shuffle, so a group of copies, however large, is one entry. Each owner task
takes the buckets of a key range and writes them as one index file. Hashes met
by more than one row are chained: their texts are compared byte by byte (a
grouping on the text itself, combined on the map side), and each distinct text
of a chain becomes one link of it.

Defined results: a null text counts as empty; of equal texts the row with the
largest doc_id stays, a row with a null doc_id only if all are null; rows that
repeat the largest doc_id of their group all stay, being one document. An empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tables import stored

BUCKET_ROWS = 200_000
MAX_DEPTH = 48


def _prefix(depth: Column | int) -> Column:
    """The first bits of the hash as a number."""
    shift = F.lit(64) - (F.lit(depth) if isinstance(depth, int) else depth)
    return F.call_function("shiftrightunsigned", F.col("h"), shift.cast("int"))


def directory(entries: DataFrame, bucket_rows: int = BUCKET_ROWS) -> list[tuple[int, int]]:
    """(prefix, depth) of every bucket, from the depth-1 split downwards.

    Only counts per prefix are looked at, and one number per bucket reaches the
    driver: a few bytes for every ``bucket_rows`` entries.
    """
    rows = entries.count()
    depth = max(1, (max(rows, 1) // bucket_rows).bit_length())
    done: list[tuple[int, int]] = []
    wide = None
    while True:
        held = entries if wide is None else entries.join(F.broadcast(wide), _prefix(depth - 1) == F.col("_wide"))
        counts = held.groupBy(_prefix(depth).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
        over = [r["p"] for r in counts if r["n"] > bucket_rows and depth < MAX_DEPTH]
        done += [(r["p"], depth) for r in counts if r["p"] not in set(over)]
        if not over:
            return done
        wide = entries.sparkSession.createDataFrame([(p,) for p in over], "_wide bigint")
        depth += 1


def _bucket(buckets: list[tuple[int, int]]) -> Column:
    """Bucket number of a hash: the bucket with its longest known prefix."""
    found = F.lit(-1).cast("bigint")
    by_depth: dict[int, list[int]] = {}
    for p, depth in buckets:
        by_depth.setdefault(depth, []).append(p)
    for depth in sorted(by_depth):
        # (prefix + 1) << (MAX_DEPTH - depth) is the bucket's upper bound at the largest depth
        found = F.when(_prefix(depth).isin(by_depth[depth]), _prefix(depth) * (1 << (MAX_DEPTH - depth))).otherwise(
            found
        )
    return found


def build_index(rows: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Stored index (h, n, last, bucket) of hashed rows (h, doc_id), one file per owner task."""
    entries = stored(
        rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last")), "exact-entries"
    )
    buckets = directory(entries, bucket_rows)
    owned = entries.withColumn("bucket", _bucket(buckets))
    owners = max(1, len(buckets))
    return stored(owned.repartitionByRange(owners, "bucket", "h").sortWithinPartitions("bucket", "h"), "exact-index")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    read = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("h", F.xxhash64("text"))
    index = build_index(read.select("h", "doc_id"), bucket_rows)
    # Always a merge join: the choice of join must not change with the number of hashes met twice.
    met = index.filter("n > 1").select("h").hint("merge")
    chains = stored(
        read.join(met, "h", "left_semi")
        .groupBy("h", "text")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id"))
        .select("h", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"),
        "exact-chains",
    )
    hashed = read.select("doc_id", "h", F.sha2("text", 256).alias("text_sha256"))
    found = hashed.join(chains.withColumn("_met", F.lit(True)), ["h", "text_sha256"], "left")
    keep = F.when(F.col("_met"), F.col("keep_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
