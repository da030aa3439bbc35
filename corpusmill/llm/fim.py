"""Fill-in-the-middle transformation with memoised, content-defined chunks.

A text is cut into prefix, middle and suffix at borders of its lines (or
between its characters), at places that a hash of the id draws, and put together again in one
of two orders. To find the borders, the text's bytes are cut into chunks where
a rolling hash over the last ``WINDOW`` bytes has ``CHUNK_BITS`` zero bits, so
passages that texts share give the same chunks wherever they stand. Each chunk
has a summary: how many line ends and characters it has and whether it ends
with a line end. Summaries are remembered by the chunk's hash next to the
chunk itself; a chunk that has the hash but not the bytes of the remembered
one is counted anew. The summaries of a text's chunks add up to its number of
lines, and their running sums lead to the one chunk in which a border lies;
only that chunk is searched.

The memory of a task holds at most two generations of ``CACHE_BYTES`` / 2 of chunks.

Defined results: a null text counts as empty, and empty texts are plain; a null
doc_id draws like the empty id; rows that repeat a doc_id are treated one by
one. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tables import slices

SEED = 7
FIM_PERCENT = 100
SPM_PERCENT = 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

WINDOW = 32
CHUNK_BITS = 11
LONGEST_CHUNK = 1 << 14
CACHE_BYTES = 32 << 20

# A random number for each byte value.
_GEAR = np.random.default_rng(11).integers(0, 1 << 32, 256, np.uint64).astype(np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """At each byte the sum of the random numbers of the last WINDOW bytes, each doubled once for every byte since.

    Sums over twice as many bytes come from two sums each, so five steps make 32.
    """
    out = _GEAR[data]
    span = 1
    while span < WINDOW:
        longer = out.copy()
        longer[span:] += out[:-span] << np.uint32(span)
        out, span = longer, 2 * span
    return out


def borders(data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Ends of the chunks of each text that begins at one of the starts (the last entry ends the data).

    A text's first WINDOW - 1 bytes have no full window, so no chunk ends there.
    """
    high = rolling(data) >> np.uint32(32 - CHUNK_BITS)
    cuts = np.flatnonzero(high == 0) + 1
    out = []
    for begin, end in zip(starts, starts[1:], strict=False):
        own = cuts[np.searchsorted(cuts, begin + WINDOW) : np.searchsorted(cuts, end)]
        own = np.concatenate([[begin], own, [end]]) if end > begin else np.array([begin])
        if len(own) > 1 and np.diff(own).max() > LONGEST_CHUNK:
            parts = [np.arange(a, b, LONGEST_CHUNK) for a, b in zip(own, own[1:], strict=False)]
            own = np.concatenate([*parts, own[-1:]])
        out.append(own[1:])
    return out


def summary(chunk: bytes) -> tuple[int, int, bool]:
    """(line ends, characters, whether it ends with a line end); characters are counted by their first bytes."""
    if chunk.isascii():
        characters = len(chunk)
    else:
        characters = int(np.count_nonzero(np.frombuffer(chunk, np.int8) >= -64))
    return chunk.count(b"\n"), characters, chunk.endswith(b"\n")


class ChunkMemory:
    """Summaries of chunks by hash, each next to the bytes that it was made from."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.held = limit // 2, 0
        self.young: dict[int, tuple[bytes, tuple[int, int, bool]]] = {}
        self.old: dict[int, tuple[bytes, tuple[int, int, bool]]] = {}
        self.hits = self.clashes = self.misses = 0

    def __call__(self, chunk: bytes) -> tuple[int, int, bool]:
        key = xxhash.xxh3_64_intdigest(chunk)
        entry = self.young.get(key)
        if entry is None:
            entry = self.old.get(key)
            if entry is None:
                self.misses += 1
                entry = (chunk, summary(chunk))
            elif entry[0] == chunk:
                self.hits += 1
            self._keep(key, entry)
        elif entry[0] == chunk:
            self.hits += 1
        if entry[0] != chunk:
            self.clashes += 1
            return summary(chunk)
        return entry[1]

    def _keep(self, key: int, entry: tuple[bytes, tuple[int, int, bool]]) -> None:
        if self.held + len(entry[0]) > self.limit:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[key] = entry
        self.held += len(entry[0])


class Text:
    """A text as chunks with running counts of units; finds the border after any number of them.

    A unit is a line with its end, the last one perhaps without, or with ``by_line`` False a character.
    """

    def __init__(self, data: bytes, ends: list[int], memory: ChunkMemory, by_line: bool = True):
        self.data, self.ends, self.by_line = data, ends, by_line
        found = [memory(data[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
        self.lines = list(accumulate(x[0] for x in found))
        self.characters = list(accumulate(x[1] for x in found))
        open_end = bool(found) and not found[-1][2]
        self.units = (self.lines[-1] + open_end if by_line else self.characters[-1]) if found else 0

    def border(self, units: int) -> tuple[int, int]:
        """(bytes, characters) before the border that lies after so many units."""
        if units <= 0:
            return 0, 0
        if units >= self.units:
            return len(self.data), self.characters[-1] if self.characters else 0
        counts = self.lines if self.by_line else self.characters
        chunk = bisect_left(counts, units)
        begin = self.ends[chunk - 1] if chunk else 0
        left = units - (counts[chunk - 1] if chunk else 0)
        before = self.characters[chunk - 1] if chunk else 0
        body = np.frombuffer(self.data, np.int8, self.ends[chunk] - begin, begin)
        if self.by_line:
            inside = int(np.flatnonzero(body == 10)[left - 1]) + 1
            return begin + inside, before + int(np.count_nonzero(body[:inside] >= -64))
        # The border lies before the next character's first byte; that may be in a later chunk.
        firsts = np.flatnonzero(body >= -64)
        if left < len(firsts):
            return begin + int(firsts[left]), units
        at = self.ends[chunk]
        while at < len(self.data) and self.data[at] & 0xC0 == 0x80:
            at += 1
        return at, units


def draws(id_col: str, seed: int = SEED) -> list[Column]:
    """Four numbers below 2**32 from the SHA-256 of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    digest = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(4)]


def transformed(
    docs: DataFrame,
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
    seed: int = SEED,
    by_line: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): one row per document.

    ``n`` is the number of units. A text stays ``plain`` if it is empty, holds one of the three marks
    or isn't drawn; the two numbers are then null. Form ``psm`` is prefix, suffix, middle, ``spm`` suffix, prefix, middle.
    """
    marks = [x.encode() for x in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = ChunkMemory()
        for part in slices(batches):
            texts = [x or b"" for x in part.column("text").cast(pa.binary()).to_pylist()]
            starts = np.cumsum([0, *map(len, texts)])
            found = borders(np.frombuffer(b"".join(texts), np.uint8), starts)
            rows = []
            numbers = zip(*(part.column(f"h{k}").to_pylist() for k in range(1, 5)), strict=True)
            for data, begin, ends, (h1, h2, h3, h4) in zip(texts, starts[:-1].tolist(), found, numbers, strict=True):
                text = Text(data, (ends - begin).tolist(), memory, by_line) if data else None
                n = text.units if text else 0
                if not data or h3 % 100 >= fim_percent or any(x in data for x in marks):
                    rows.append((n, "plain", None, None, data))
                    continue
                a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
                (at, before), (to, until) = text.border(a), text.border(b)
                prefix, middle, suffix = data[:at], data[at:to], data[to:]
                if h4 % 100 < spm_percent:
                    rows.append((n, "spm", before, until - before, b"".join((s, suffix, p, prefix, m, middle))))
                else:
                    rows.append((n, "psm", before, until - before, b"".join((p, prefix, s, suffix, m, middle))))
            n, form, before, inside, output = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()),
                 pa.array(inside, pa.int64()), pa.array(output, pa.string())],
                names,
            )

    read = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
        *[h.alias(f"h{k}") for k, h in enumerate(draws(id_col, seed), 1)],
    )
    id_type = read.schema["doc_id"].dataType.simpleString()
    return read.mapInArrow(
        cut, f"doc_id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    )


def restored(form: Column, output: Column) -> Column:
    """The text, from form and output alone; texts that aren't plain hold no mark, so the first of each is the border."""
    after_first = F.locate(SUFFIX, output), F.locate(PREFIX, output)
    second = F.when(form == "psm", after_first[0]).otherwise(after_first[1])
    last = F.locate(MIDDLE, output)
    width = len(MIDDLE)
    first_part = F.substr(output, F.lit(1 + width), second - 1 - width)
    second_part = F.substr(output, second + width, last - second - width)
    middle = F.substr(output, last + width)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(first_part, middle, second_part))
        .otherwise(F.concat(second_part, middle, first_part))
    )


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256): one row per document."""
    rows = transformed(docs, id_col=id_col, text_col=text_col)
    back = restored(F.col("form"), F.col("output"))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )


ORACLE = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), cut AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units,
         ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM drawn
), placed AS (
  SELECT *, len(units) AS n,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
         least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b
  FROM cut
), parts AS (
  SELECT doc_id, text, n, form, array_to_string(list_slice(units, 1, a), '') AS prefix,
         array_to_string(list_slice(units, a + 1, b), '') AS middle,
         array_to_string(list_slice(units, b + 1, n), '') AS suffix
  FROM placed
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
