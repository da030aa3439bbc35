"""Benchmark decontamination by spaced seeds.

A token is a maximal run of letters and digits, lower-cased. A document is
contaminated if some ``WINDOW`` tokens in a row match as many in a row of a
benchmark item with at most ``SUBSTITUTIONS`` of them different. Each mask
ignores fixed positions of a span of tokens; the two masks are chosen so that
any such window, wherever its substitutions are, keeps the tokens of one mask
at some place (tests enumerate all placements). So hashes of masked spans,
joined between documents and benchmark, find every window, and a hit is
verified against the benchmark tokens around it.

Benchmark seeds with equal surroundings are one entry however many items share
them, and entries go out in blocks of bounded size, each broadcast to one pass
over all documents. Documents are never shuffled. All work is in SQL functions.

Defined results: null and empty texts match nothing, on both sides; items
shorter than the window are never matched; rows that repeat a doc_id are one
document; a null doc_id is reported as one document without an id. Empty tables
give no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tables import stored

WINDOW = 13
SUBSTITUTIONS = 2
MASKS = ("11010111", "111001011")
BLOCK_ENTRIES = 100_000
STRETCH = 64


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+")
    return F.filter(parts, lambda x: x != "")


def _numbers(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(hashes: Column, mask: str, first: Column | None = None, many: int | None = None) -> Column:
    """Hash of every masked span, in order of its first token; with ``first``, of ``many`` spans from there."""
    used = [i for i, c in enumerate(mask) if c == "1"]
    first = F.lit(0) if first is None else first
    last = F.size(hashes) - len(mask)
    last = last if many is None else F.least(last, first + (many - 1))
    starts = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        starts, lambda i: F.xxhash64(F.lit(mask), *[F.get(hashes, i + offset) for offset in used])
    )


def entries(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(seed, before, around, item_id): masked spans of the benchmark with the tokens around them.

    ``around`` holds every token that shares a window with the span, ``before``
    how many of them precede it. Equal entries of several items become one, with
    the smallest item_id.
    """
    base = items.select(F.col(id_col).alias("item_id"), _numbers(tokens(F.col(text_col))).alias("h")).filter(
        F.size("h") >= WINDOW
    )
    parts = []
    for mask in MASKS:
        slack = WINDOW - len(mask)
        first = F.greatest(F.col("at") - slack, F.lit(0))
        part = (
            base.select("item_id", "h", F.posexplode(_seeds(F.col("h"), mask)).alias("at", "seed"))
            .withColumn("before", F.col("at") - first)
            .withColumn("around", F.slice("h", first + 1, F.col("before") + WINDOW))
        )
        parts.append(part.select("seed", "before", "around", "item_id"))
    both = parts[0]
    for part in parts[1:]:
        both = both.unionAll(part)
    return both.groupBy("seed", "before", "around").agg(F.min("item_id").alias("item_id"))


def _stretches(numbered: DataFrame) -> DataFrame:
    """(doc_id, begin, lead, h): stretches of a document's tokens, each with those that its spans' windows reach.

    ``begin`` is the place of its first token, the spans of the stretch begin ``lead`` tokens later. A row with a span
    so carries a bounded number of tokens, however long the document is.
    """
    before = lambda s: F.least(s, F.lit(WINDOW - min(map(len, MASKS))))
    starts = F.sequence(F.lit(0), F.greatest(F.size("h") - 1, F.lit(0)), F.lit(STRETCH))
    stretch = lambda s: F.struct(
        (s - before(s)).alias("begin"),
        before(s).alias("lead"),
        F.slice("h", s - before(s) + 1, before(s) + STRETCH + WINDOW).alias("h"),
    )
    return numbered.select("doc_id", F.explode(F.transform(starts, stretch)).alias("s")).select("doc_id", "s.*")


def _verified() -> tuple[Column, Column]:
    """Whether some window of the aligned tokens, all inside the document, has few enough differences."""
    differs = lambda a, b: F.when(b.isNull(), SUBSTITUTIONS + 1).when(a == b, 0).otherwise(1)
    same = F.zip_with("around", "aligned", differs)
    starts = F.sequence(F.lit(1), F.size("around") - WINDOW + 1)
    differences = lambda s: F.aggregate(F.slice("same", s, WINDOW), F.lit(0), lambda a, x: a + x)
    return F.exists(starts, lambda s: differences(s) <= SUBSTITUTIONS), same


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_entries: int = BLOCK_ENTRIES,
) -> DataFrame:
    """(doc_id, contaminated, item_id, n_spots, first_token): one row per contaminated document.

    ``item_id`` is the smallest item that the document overlaps, ``n_spots`` the
    number of token positions with a verified hit, ``first_token`` the first.
    """
    known = stored(entries(items).filter(F.size("around") >= WINDOW), "seeds")
    blocks = max(1, -(-known.count() // block_entries))
    base = _stretches(docs.select(F.col(id_col).alias("doc_id"), _numbers(tokens(F.col(text_col))).alias("h")))
    hashed = F.concat(
        *[
            F.transform(
                _seeds(F.col("h"), mask, F.col("lead"), STRETCH),
                lambda seed, i: F.struct((F.col("lead") + i).alias("at"), seed.alias("seed")),
            )
            for mask in MASKS
        ]
    )
    test, same = _verified()
    found = []
    for block in range(blocks):
        own = known.filter(F.pmod(F.xxhash64("seed", "around"), F.lit(blocks)) == block)
        spans = base.select("doc_id", "begin", "h", F.explode(hashed).alias("s")).select(
            "doc_id", "begin", "h", F.col("s.at").alias("at"), F.col("s.seed").alias("seed")
        )
        hits = spans.join(F.broadcast(own), "seed")
        # Aligned tokens; null before the first or after the last of the document.
        first = F.col("at") - F.col("before")
        aligned = F.transform(
            F.sequence(F.lit(0), F.size("around") - 1),
            lambda i: F.when(first + i >= 0, F.get("h", first + i)),
        )
        checked = (
            hits.withColumn("aligned", aligned)
            .withColumn("same", same)
            .filter(test)
            .select("doc_id", "item_id", (F.col("begin") + F.col("at")).alias("at"))
        )
        found.append(checked)
    every = found[0]
    for part in found[1:]:
        every = every.unionAll(part)
    return (
        every.groupBy("doc_id", "at")
        .agg(F.min("item_id").alias("item_id"))
        .groupBy("doc_id")
        .agg(
            F.min("item_id").alias("item_id"),
            F.count(F.lit(1)).alias("n_spots"),
            F.min("at").alias("first_token"),
        )
        .select("doc_id", F.lit(True).alias("contaminated"), "item_id", "n_spots", "first_token")
    )
