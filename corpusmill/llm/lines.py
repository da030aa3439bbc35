"""Near-duplicate lines by a segment-partition edit join, in SQL functions only.

Lines of at least ``MIN_CHARS`` characters (trimmed) within one edit of each
other are linked; classes are the components of these links, equal lines being
one node. Of each class the first occurrence by (doc_id, position) stays and
all others go; shorter lines always stay.

With a threshold of one edit a line is split into two segments, one of which an
edit leaves as it is. The index holds each line's segments by length and side.
Lines of the same length probe with their own segments; a line one longer
probes with the substrings at which the shorter one's segments can lie. Pairs
that meet are verified by banded bit-parallel edit distance on the part outside
the common segment: one word of 2k+1 diagonals per number of errors.

The segment in doubt is cut into parts, round by round, until it is short and
few lines are left in an entry, or it is a single character; lines that agree
but for one character are all linked to the smallest. Most pairs that are
further apart part company on the way, and what is verified is short. So no entry, however large, is paired with itself, no link is lost,
and the rows of a round are in proportion to its lines.

Defined results: a null text stays null, an empty one empty; rows that repeat
both doc_id and text are one document and keep the same lines; a null doc_id
comes last in the order. Lines are compared by 64-bit hashes of their text. An
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.components import components
from corpusmill.llm.tables import sized, stored

MIN_CHARS = 20
CROWDED = 24
SHORT = 16
PARTS = 8


def _occurrences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, at, line, h): the lines that can be copies."""
    return (
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.xxhash64(text_col).alias("text_hash"),
            F.posexplode(F.split(text_col, "\n")).alias("at", "raw"),
        )
        .select("doc_id", "text_hash", "at", F.trim("raw").alias("line"))
        .filter(F.length("line") >= MIN_CHARS)
        .withColumn("h", F.xxhash64("line"))
    )


def _part(line: Column | str, start: Column, length: Column) -> Column:
    """Substring from a position counted from 0."""
    return F.substring(line, start + 1, length)


def _key(base: Column, low: Column, high: Column, line: Column | str, size: Column, own: bool | Column) -> Column:
    """Index key: all of a line but the piece [low, high), which is one longer in a probing line."""
    extra = F.lit(0 if own else 1) if isinstance(own, bool) else F.when(own, 0).otherwise(1)
    tail = high + extra
    return F.xxhash64(base, low, high, _part(line, F.lit(0), low), _part(line, tail, size - tail))


def _postings(lines: DataFrame) -> DataFrame:
    """(h, key, own): two index segments and two probing substrings per line."""
    size = F.length("line")
    zero = F.lit(0)

    def both(base: Column, own: bool) -> list[Column]:
        middle = (base / 2).cast("int")
        return [
            _key(base, middle, base, "line", size, own),
            _key(base, zero, middle, "line", size, own),
        ]

    probing = [F.when(size > MIN_CHARS, k) for k in both(size - 1, False)]
    keys = lines.groupBy("h").agg(
        *[F.first(k).alias(f"k{i}") for i, k in enumerate([*both(size, True), *probing])]
    )
    cell = lambda i: F.struct(F.col(f"k{i}").alias("key"), F.lit(i < 2).alias("own"), F.lit(i % 2).alias("side"))
    return keys.select("h", F.explode(F.array(*map(cell, range(4)))).alias("e")).select("h", "e.*").filter(
        F.col("key").isNotNull()
    )


def _met(postings: DataFrame) -> DataFrame:
    """Postings of keys that an index entry shares with another line, with their number."""
    met = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("owned"))
    return postings.join(met.filter("n > 1 and owned").select("key", "n").hint("merge"), "key")


def within(left: Column, right: Column, edits: int) -> Column:
    """Whether two texts are at most ``edits`` apart: banded bit-parallel edit distance.

    Bit d of word e says that diagonal d - edits is reached with at most e
    errors after the characters read so far. A character that agrees keeps a
    diagonal; an error moves to the same (substitution), the previous (left
    longer) or the next one (right longer).
    """
    band = range(2 * edits + 1)
    mask = (1 << len(band)) - 1
    shift = lambda c, by: F.call_function("shiftleft" if by > 0 else "shiftright", c, F.lit(abs(by)))

    def spread(words: list[Column]) -> list[Column]:
        """Characters skipped on the right cost an error each."""
        out = [words[0]]
        for word in words[1:]:
            out.append(word.bitwiseOR(out[-1]).bitwiseOR(shift(out[-1], 1)).bitwiseAND(F.lit(mask)))
        return out

    pack = lambda words: F.struct(*[w.cast("int").alias(f"e{i}") for i, w in enumerate(words)])
    start = pack(spread([F.lit(1 << edits), *[F.lit(0)] * edits]))

    def agreeing(i: Column) -> Column:
        """The diagonals on which the i-th character of the left text agrees."""
        mine = F.substring(left, i, F.lit(1))
        equal = F.lit(0)
        for d in band:
            other = F.substring(right, F.greatest(i + (d - edits), F.lit(0)), F.lit(1))
            inside = (i + (d - edits)).between(F.lit(1), F.length(right))
            equal = equal.bitwiseOR(F.when(inside & (mine == other), F.lit(1 << d)).otherwise(F.lit(0)))
        return equal

    def step(state: Column, equal: Column) -> Column:
        before = [state[f"e{e}"] for e in range(edits + 1)]
        after = [before[0].bitwiseAND(equal)]
        for e in range(1, edits + 1):
            after.append(before[e].bitwiseAND(equal).bitwiseOR(before[e - 1]).bitwiseOR(shift(before[e - 1], -1)))
        return pack(spread(after))

    places = F.when(F.length(left) > 0, F.sequence(F.lit(1), F.length(left))).otherwise(F.array().cast("array<int>"))
    # Made once a character: in the step the expression would stand, and be computed, several times.
    ended = F.aggregate(F.transform(places, agreeing), start, step)
    gap = F.length(right) - F.length(left)
    last = ended[f"e{edits}"]
    at_end = F.call_function("shiftright", last, (gap + edits).cast("int")).bitwiseAND(F.lit(1)) == 1
    return F.when(F.abs(gap) <= edits, at_end).otherwise(F.lit(False))


def _verified(few: DataFrame) -> DataFrame:
    """Links (a, b) of small entries."""
    piece = _part("line", F.col("low"), F.col("high") - F.col("low") + F.when(F.col("own"), 0).otherwise(1))
    rows = few.select("key", "h", "own", piece.alias("piece"))
    left = rows.filter("own").select("key", F.col("h").alias("a"), F.col("piece").alias("p"))
    right = rows.select("key", F.col("h").alias("b"), F.col("own").alias("b_own"), F.col("piece").alias("q"))
    pairs = left.join(right, "key").filter(F.when(F.col("b_own"), F.col("a") < F.col("b")).otherwise(F.lit(True)))
    return pairs.filter(within(F.col("p"), F.col("q"), 1)).select("a", "b")


def _one_character(rows: DataFrame) -> DataFrame:
    """Links of entries whose lines agree but for a single character."""
    least = rows.filter("own").groupBy("key").agg(F.min("h").alias("a"))
    stars = rows.filter("own").join(least, "key").filter("a <> h").select("a", F.col("h").alias("b"))
    mine = rows.filter("own").select("key", F.col("h").alias("a"), _part("line", F.col("low"), F.lit(1)).alias("c"))
    longer = rows.filter("not own").select(
        "key",
        F.col("h").alias("b"),
        F.explode(
            F.array_distinct(
                F.array(_part("line", F.col("low"), F.lit(1)), _part("line", F.col("low") + 1, F.lit(1)))
            )
        ).alias("c"),
    )
    return stars.unionAll(mine.join(longer, ["key", "c"]).select("a", "b"))


def _narrowed(many: DataFrame) -> DataFrame:
    """The parts of the piece in doubt, each with the rest of the line as key."""
    bound = lambda j: F.col("low") + ((F.col("high") - F.col("low")) * j / PARTS).cast("int")
    parts = F.array(*[F.struct(bound(j).alias("low"), bound(j + 1).alias("high")) for j in range(PARTS)])
    rows = (
        many.select("h", "line", "own", "base", F.explode(parts).alias("r"))
        .filter("r.low < r.high")
        .select("h", "line", "own", "base", F.col("r.low").alias("low"), F.col("r.high").alias("high"))
    )
    key = _key(F.col("base"), F.col("low"), F.col("high"), "line", F.length("line"), F.col("own"))
    # A longer line may come to one key by two ways.
    return rows.withColumn("key", key).dropDuplicates(["key", "h", "own"])


def edit_links(lines: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Links (a, b) between hashes of lines (line, h) that connect all lines within one edit."""
    met = stored(_met(_postings(lines)), "lines-met")
    wanted = stored(met.select("h").distinct(), "lines-wanted")
    texts = stored(
        lines.select("h", "line").join(sized(wanted, 16), "h", "left_semi").dropDuplicates(["h"]), "lines-texts"
    )
    base = F.length("line") - F.when(F.col("own"), 0).otherwise(1)
    middle = (F.col("base") / 2).cast("int")
    rows = (
        met.join(texts.hint("merge"), "h")
        .withColumn("base", base)
        .withColumn("low", F.when(F.col("side") == 0, middle).otherwise(0))
        .withColumn("high", F.when(F.col("side") == 0, F.col("base")).otherwise(middle))
        .drop("side")
    )
    links = None
    while True:
        single = F.col("high") - F.col("low") <= 1
        small = (F.col("n") <= crowded) & (F.col("high") - F.col("low") <= SHORT)
        now = rows.filter(small & ~single)
        # Stored round by round: one plan of all rounds is large, and the driver plans it anew after each of its stages.
        found = stored(_verified(now).unionAll(_one_character(rows.filter(single))), "lines-links")
        links = found if links is None else links.unionAll(found)
        many = rows.filter(~small & ~single)
        if many.isEmpty():
            return links
        rows = stored(_met(_narrowed(many)), "lines-narrowed")


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(h, first, n, lines): every line that has a copy, and the first occurrence and size of its class."""
    found = _occurrences(docs, id_col, text_col)
    place = F.struct(
        F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("doc_id"),
        F.col("text_hash").alias("text_hash"), F.col("at").alias("at"),
    )
    nodes = stored(
        found.groupBy("h").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")), "lines-nodes"
    )
    linked = components(edit_links(found.select("line", "h")), "lines-edges").withColumnRenamed("u", "h")
    member = linked.unionAll(linked.select(F.col("root").alias("h"), "root").distinct())
    classed = nodes.join(member.hint("merge"), "h", "left").filter((F.col("n") > 1) | F.col("root").isNotNull())
    classed = classed.withColumn("root", F.coalesce("root", "h"))
    whole = classed.groupBy("root").agg(
        F.min("first").alias("first"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("lines")
    )
    return classed.select("h", "root").join(whole.filter("n > 1"), "root").select("h", "first", "n", "lines")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with the repeated lines taken out, and ``_lines`` and ``_dropped`` counts."""
    classes = stored(line_classes(docs, id_col, text_col), "lines-classes")
    found = _occurrences(docs, id_col, text_col).drop("line")
    kept = (
        (F.col("first.doc_id").eqNullSafe(F.col("doc_id")))
        & (F.col("first.text_hash") == F.col("text_hash"))
        & (F.col("first.at") == F.col("at"))
    )
    gone = (
        found.join(sized(classes, 64), "h")
        .filter(~kept)
        .groupBy(F.col("doc_id").alias("_gone_id"), F.col("text_hash").alias("_gone_hash"))
        .agg(F.collect_set("at").alias("_gone"))
        .hint("merge")
    )
    same = F.col(id_col).eqNullSafe(F.col("_gone_id")) & (F.xxhash64(text_col) == F.col("_gone_hash"))
    gone_at = F.coalesce("_gone", F.array().cast("array<int>"))
    # The lines and positions are made once a document: a lambda would make them anew for each line.
    every = F.split(text_col, "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), gone_at)
    both = F.array(F.struct(every.alias("every"), left.alias("left")))
    rest = F.transform(both, lambda d: F.array_join(F.transform(d["left"], lambda i: F.get(d["every"], i)), "\n"))[0]
    return (
        docs.join(gone, same, "left")
        .withColumn("_lines", F.coalesce(F.size(F.split(text_col, "\n")), F.lit(0)))
        .withColumn("_dropped", F.size(gone_at))
        .withColumn(text_col, F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(rest))
        .drop("_gone_id", "_gone_hash", "_gone")
    )
