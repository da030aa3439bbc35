"""Packing token sequences: shortest-pack-first over the length histogram.

Documents are tokenised in one Arrow pass that cuts them into pieces of at most
``capacity`` ids. Only the histogram of piece lengths (at most ``capacity``
numbers) is packed: lengths go longest first into the pack with the most room,
and packs of equal content are one pattern with a count. Every piece then finds
its place by the rank it has among the pieces of its length. Ranks are counted
inside a task while it writes, and offsets of tasks are running sums, so
nothing is sorted or collected.

Defined results: a null text counts as empty and gives the end id alone; rows
that repeat a doc_id, or have a null one, are packed like any other. An empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusmill.llm.tables import pieces, release, stored
from corpusmill.llm.words import byte_alphabet, plain_words

CAPACITY = 2048
END_ID = 1
CACHED_WORDS = 150_000

@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class _Words(dict):
    """Word to its ids as little-endian bytes; forgets all when full."""

    def __init__(self, path: str):
        import tiktoken

        super().__init__()
        vocabulary = _tokenizer(path).get_vocab(with_added_tokens=False)
        byte_of = {c: b for b, c in byte_alphabet().items()}
        ranks = {}
        for token, number in vocabulary.items():
            body, end = (token[:-4], b"\xff") if token.endswith("</w>") and len(token) > 4 else (token, b"")
            ranks[bytes(byte_of[c] for c in body) + end] = number
        self._pieces = tiktoken.Encoding("words", pat_str=".+", mergeable_ranks=ranks, special_tokens={})._core_bpe

    def __missing__(self, word: str) -> bytes:
        ids = self._pieces.encode_single_piece(word.encode() + b"\xff")
        value = np.array(ids, "<u4").tobytes()
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value
        return value


@lru_cache(maxsize=1)
def _words(path: str) -> _Words:
    return _Words(path)


def token_bytes(text: str, path: str) -> bytes:
    """Ids of a text as little-endian unsigned 32-bit numbers, without the end id.

    Words that ``plain_words`` cuts are looked up; the cut and the ids are those
    of the tokenizer file. All other texts are encoded by the tokenizer itself.
    """
    words = plain_words(text, path)
    if words is None:
        return np.array(_tokenizer(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    return b"".join(map(_words(path).__getitem__, words))


def token_pieces(docs: DataFrame, path: str, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """One row per piece, with its rank among the pieces of its length in its task."""
    end = np.array([END_ID], "<u4").tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "task_rank"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for part, texts in pieces(batches):
            rows: list[tuple] = []
            for doc_id, text in zip(part.column(0).to_pylist(), texts, strict=True):
                ids = token_bytes(text, path) + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    length = min(capacity, total - start)
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((doc_id, start, length, crc, total, task, int(seen[length])))
                    seen[length] += 1
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
        _words(path).clear()
        release()  # what the words took, for the next tasks of this worker

    read = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return read.mapInArrow(cut, ", ".join(f"{x} bigint" for x in names))


def pack_histogram(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in order) and how many sequences have each.

    Works on numbers of packs, never on single packs: the steps depend on the
    number of different lengths, not on how many pieces there are.
    """
    room: list[dict[tuple[int, ...], int]] = [{} for _ in range(capacity + 1)]
    for length in range(capacity, 0, -1):
        left = counts.get(length, 0)
        free = capacity
        while left:
            while free >= length and not room[free]:
                free -= 1
            if free < length:
                pattern, many, free_now = (), left, capacity
            else:
                pattern, many = room[free].popitem()
                free_now = free
            used = min(left, many)
            if pattern and many > used:
                room[free_now][pattern] = many - used
            target = room[free_now - length]
            grown = (*pattern, length)
            target[grown] = target.get(grown, 0) + used
            left -= used
            free = max(free, free_now - length)
    return [item for packs in room for item in sorted(packs.items())]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int]]:
    """(length, first rank, first sequence, offset) of every slot of every pattern."""
    next_rank: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, many in patterns:
        offset = 0
        for length in pattern:
            rank = next_rank.get(length, 0)
            out.append((length, rank, sequence, offset))
            next_rank[length] = rank + many
            offset += length
        sequence += many
    return sorted(out)


def packed(
    docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row per piece."""
    cut = stored(token_pieces(docs, path, capacity, id_col, text_col), "pieces")
    by_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = places(pack_histogram(histogram, capacity))
    earlier = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    offsets = by_task.select(
        "length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    ranked = cut.join(offsets, ["length", "task"]).withColumn("rank", F.col("before") + F.col("task_rank"))

    length_of, first_rank, first_sequence, offset_of = (
        np.array(x, np.int64) for x in (zip(*slots, strict=True) if slots else [[]] * 4)
    )
    begin = np.searchsorted(length_of, np.arange(capacity + 2))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            slot = np.zeros(len(length), np.int64)
            for one in np.unique(length):
                at, (a, b) = length == one, begin[one : one + 2]
                slot[at] = a + np.searchsorted(first_rank[a:b], rank[at], side="right") - 1
            sequence = first_sequence[slot] + rank - first_rank[slot]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in names), pa.array(sequence), pa.array(offset_of[slot])],
                [*names, "sequence_id", "offset"],
            )

    return ranked.select(*names, "rank").mapInArrow(
        placed, ", ".join(f"{x} bigint" for x in [*names, "sequence_id", "offset"])
    )
