"""Language-model scores by partial matching over bytes, next to a unigram base.

The model is a trie of byte contexts with the counts of every symbol that
followed them in the training texts. A symbol is coded in the longest context;
one that context hasn't met costs an escape (method C: as likely as the number
of different symbols met there) and moves to the next shorter context, where
symbols of the longer one are excluded. Below the empty context all remaining
byte values are equally likely. The byte 0xFF, which UTF-8 never uses, starts
and ends every text.

Contexts have at most two bytes, so the trie has at most 2**24 leaves whatever
the corpus: its counts are summed by Spark over all training texts, and only
they are broadcast. With fixed counts the cost of a symbol depends on its
context alone, so each worker expands the trie once into a table of costs.
``adaptive_cost`` is the other mode: counts that grow while a text is read.

The base needs a count for every word of every text. The most frequent words,
at most ``HEAD``, travel to the tasks; all others meet their counts in a
shuffle join, with one row for each different word of a text. So a word that is
in every text is never a shuffle key.

Defined results: a null text counts as empty (one end token); a null doc_id
counts as held out; rows that repeat a doc_id are scored one by one. With no
training text at all N and V are zero, so each token's base is log10(0.1/0.1) = 0, and all
bytes are equally likely. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tables import pieces, remainder, stored

HEAD = 250_000
FLUSH_WORDS = 400_000
EDGE = b"\xff\xff"
END_WORD = b""


def _framed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram code of every coded symbol, and where each text's symbols begin.

    Texts are laid out as FF FF text FF FF text FF; the code that would span the
    second FF of a separator is left out.
    """
    data = np.frombuffer(EDGE + EDGE.join(texts) + b"\xff", np.uint8).astype(np.int32)
    codes = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    sizes = np.fromiter((len(x) + 2 for x in texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    keep = np.ones(len(codes), bool)
    keep[ends[:-1] - 1] = False
    starts = np.concatenate(([0], np.cumsum(sizes - 1)[:-1]))
    return codes[keep], starts


def corpus_counts(docs: DataFrame) -> DataFrame:
    """(word, code, n) over training rows: words, or trigram codes where word is null."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        trigrams = np.zeros(1 << 24, np.uint32)

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(list(words), pa.binary()),
                    pa.nulls(len(words), pa.int64()),
                    pa.array(words.values(), pa.int64()),
                ],
                ["word", "code", "n"],
            )

        for _, texts in pieces(batches):
            encoded = [x.encode("utf-8", "replace") for x in texts]
            for x in encoded:
                words.update(x.lower().split())
            words[END_WORD] += len(encoded)
            code, n = np.unique(_framed(encoded)[0], return_counts=True)
            trigrams[code] += n.astype(np.uint32)
            if len(words) > FLUSH_WORDS:
                yield flushed()
                words.clear()
        if words:
            yield flushed()
        code = np.flatnonzero(trigrams)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(code), pa.binary()), pa.array(code), pa.array(trigrams[code].astype(np.int64))],
            ["word", "code", "n"],
        )

    partial = docs.mapInArrow(counted, "word binary, code bigint, n bigint")
    return partial.groupBy("word", "code").agg(F.sum("n").alias("n"))


def _frequent(words: DataFrame, head: int) -> DataFrame:
    """At most ``head`` words, all those above a count; found by a histogram of counts, without a sort."""
    step = F.floor(F.log2("n") * 64).cast("int")
    held, least = 0, None
    for row in sorted(words.groupBy(step.alias("s")).count().collect(), reverse=True):  # a few thousand steps
        held += row["count"]
        if held > head:
            break
        least = row["s"]
    return words.filter(step >= least) if least is not None else words.limit(0)


def _level(counts: np.ndarray, excluded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each met symbol and of an escape, per row."""
    open_ = np.where(excluded, 0.0, counts)
    total, kinds = open_.sum(axis=-1, keepdims=True), (open_ > 0).sum(axis=-1, keepdims=True)
    whole = np.maximum(total + kinds, 1)
    return open_ / whole, np.where(total > 0, kinds / whole, 1.0)


def cost_table(code: np.ndarray, n: np.ndarray) -> np.ndarray:
    """log10 probability of every symbol after every two bytes, flat by trigram code."""
    context, row = np.unique(code >> 8, return_inverse=True)
    two = np.zeros((len(context), 256))
    two[row, code & 255] = n
    one = np.zeros((256, 256))
    np.add.at(one, ((code >> 8) & 255, code & 255), n)
    zero = one.sum(axis=0)

    def mixed(rows: np.ndarray | None, last: np.ndarray) -> np.ndarray:
        out = np.zeros((len(last), 256))
        left, met = np.ones((len(last), 1)), np.zeros((len(last), 256), bool)
        for counts in ([] if rows is None else [rows]) + [one[last], np.broadcast_to(zero, (len(last), 256))]:
            p, escape = _level(counts, met)
            out += left * p
            left = left * escape
            met |= counts > 0
        unmet = ~met
        return out + left * unmet / np.maximum(unmet.sum(axis=1, keepdims=True), 1)

    with np.errstate(divide="ignore"):
        table = np.tile(np.log10(mixed(None, np.arange(256))).astype(np.float32), (256, 1))
        for at in range(0, len(context), 2048):
            part = slice(at, at + 2048)
            table[context[part]] = np.log10(mixed(two[part], context[part] & 255))
    return table.reshape(-1)


def adaptive_cost(text: str, order: int = 2, counts: dict[bytes, Counter] | None = None) -> float:
    """log10 probability of a text by a trie that learns while it reads, from ``counts`` or nothing."""
    trie = {k: Counter(v) for k, v in (counts or {}).items()}
    data, total = b"\xff" * order + text.encode("utf-8", "replace") + b"\xff", 0.0
    for at in range(order, len(data)):
        symbol, excluded, found = data[at], set(), False
        for length in range(order, -1, -1):
            node = trie.setdefault(data[at - length : at], Counter())
            met = {s: c for s, c in node.items() if s not in excluded}
            whole = sum(met.values()) + len(met)
            if not found and symbol in met:
                total, found = total + math.log10(met[symbol] / whole), True
            elif not found and met:
                total += math.log10(len(met) / whole)
                excluded |= met.keys()
            node[symbol] += 1
        if not found:
            total -= math.log10(256 - len(excluded))
    return total


_EXPANDED: dict = {}


def _expanded(name: str, sent: Broadcast) -> tuple:
    """Cost table and word values, expanded once per worker and model."""
    if name not in _EXPANDED:
        code, n, common, value = sent.value
        _EXPANDED.clear()
        _EXPANDED[name] = cost_table(code, n), dict(zip(common, value.tolist(), strict=True))
    return _EXPANDED[name]


def ppm_scores(
    docs: DataFrame, held_out_of: int = 10, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): one row per document."""
    read = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        (remainder(id_col, held_out_of) == 0).alias("held_out"),
    )
    counts = stored(corpus_counts(read.filter("not held_out").select("text")), "ppm-counts")
    words = counts.filter("code is null").select("word", "n")
    size = words.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens, kinds = size[0] or 0, size[1]
    whole = math.log10(tokens + 0.1 * (kinds + 1))
    trie = counts.filter("code is not null").select("code", "n").toArrow()  # 2**24 rows at most
    frequent = _frequent(words, head).toArrow()
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(
        (
            trie["code"].to_numpy(), trie["n"].to_numpy(),
            frequent["word"].to_pylist(), np.log10(frequent["n"].to_numpy() + 0.1) - whole,
        )
    )

    name = uuid.uuid4().hex
    names = ["key", "doc_id", "held_out", "n_tokens", "n_head", "head_score", "score", "words", "times"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, values_of = _expanded(name, sent)
        of_word = values_of.get
        key = TaskContext.get().partitionId() << 40
        for part, texts in pieces(batches):
            encoded = [x.encode("utf-8", "replace") for x in texts]
            codes, starts = _framed(encoded)
            score = np.add.reduceat(table[codes].astype(np.float64), starts)
            rows, offsets, rare, times = [], [0], [], []
            for x in encoded:
                found = x.lower().split()
                values = list(map(of_word, found))
                known = [v for v in values if v is not None]
                tail = Counter([w for w, v in zip(found, values, strict=True) if v is None])
                end = of_word(END_WORD)
                rows.append((len(found) + 1, len(known) + (end is not None), sum(known) + (end or 0.0)))
                if end is None:
                    tail[END_WORD] += 1
                rare += tail.keys()
                times += tail.values()
                offsets.append(len(rare))
            total, n_head, head_score = zip(*rows, strict=True)
            offsets = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(key, key + len(rows))), part.column("doc_id"), part.column("held_out"),
                    pa.array(total, pa.int64()), pa.array(n_head, pa.int64()),
                    pa.array(head_score, pa.float64()), pa.array(score),
                    pa.ListArray.from_arrays(offsets, pa.array(rare, pa.binary())),
                    pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
                ],
                names,
            )
            key += len(rows)

    id_type = read.schema["doc_id"].dataType.simpleString()
    rows = stored(
        read.mapInArrow(
            scored,
            f"key bigint, doc_id {id_type}, held_out boolean, n_tokens bigint, n_head bigint, "
            "head_score double, score double, words array<binary>, times array<int>",
        ),
        "ppm-rows",
    )
    rare = rows.select("key", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "key", F.col("w.words").alias("word"), F.col("w.times").alias("times")
    )
    count = F.coalesce("n", F.lit(0))
    tails = (
        rare.join(words, "word", "left")
        .groupBy("key")
        .agg(
            F.sum(F.col("times") * (F.log10(count + 0.1) - F.lit(whole))).alias("tail_score"),
            F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("n_tail"),
        )
    )
    return (
        rows.drop("words", "times")
        .join(tails, "key", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_head") + F.coalesce("n_tail", F.lit(0))).alias("n_known"),
            F.lit(tokens).cast("bigint").alias("train_tokens"),
            (F.col("head_score") + F.coalesce("tail_score", F.lit(0.0))).alias("base_score"),
            "score",
        )
    )
