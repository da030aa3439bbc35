"""Importance resampling towards a target: bit-sliced sums of hashed n-gram gains.

Runs of one to ``ORDER`` words are hashed into ``BUCKETS`` buckets. Counts of
the buckets over the corpus and over the target give each bucket a whole-number
gain; a document's weight is the sum of gains over its features. It is worked
out bit by bit: bit i of a document's counts is one plane of BUCKETS bits, bit j of
the positive (and of the negative) gains another, and the weight is the sum of
2**(i + j) times the bits that both planes share, the negative ones subtracted. All
is whole numbers, so the weights are exact.

The CRC-32 of a run of words needs no joined string: the checksum of two strings
put together is that of the first, carried over as many zero bytes as the second
has, with that of the second. Carrying is linear over bits, four table look-ups for each
width, so all runs of a block are hashed at once from the checksums of its words.

Texts of any length are read in stretches of ``STRETCH`` bytes that end between words;
a stretch begins with the last words of the one before, whose own runs are not counted again.
Buckets are summed inside every task before Spark adds the tasks' sums; the driver holds two numbers a bucket.

The largest scores are found without sorting the table: an approximate
quantile with a known error leaves little more than the share that is drawn, which
is ranked by ranges. The scores are written once, so that counting, quantile and
ranking see the same rows.

Defined results: a null text has no words, hence weight 0; a null doc_id draws like the
empty id and comes after all others of its score; rows that repeat a doc_id are scored one by one, and
those of one score are ranked by doc_id, then number of features and weight. An empty table gives
no rows, an empty target gains from the corpus alone; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tables import slices, stored
from corpusmill.plans.ranking import range_rank

BUCKETS = 10_000
ORDER = 3
SEED = 42
LEAST_WORDS = 20
PERCENT = 5
GAIN_SCALE = 1000

STRETCH = 4 << 20
SHORT = 64
BLOCK = 128
ACCURACY = 10_000

_WORD_BYTE = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_SPACE_CRC = np.uint32(zlib.crc32(b" "))


# ---- checksums of blocks


def _crc_table() -> np.ndarray:
    """CRC-32 remainder of each byte value, by the reversed polynomial."""
    rest = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        rest = np.where(rest & 1, np.uint32(0xEDB88320), np.uint32(0)) ^ (rest >> np.uint32(1))
    return rest


_TABLE = _crc_table()


def word_checksums(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of the words of a block: byte after byte for all short words together, long ones one by one."""
    order = np.argsort(-np.minimum(sizes, SHORT + 1), kind="stable")
    at, left = starts[order], sizes[order]
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    begin = int(np.searchsorted(-left, -SHORT))  # longer ones come first
    for k in range(min(SHORT, int(left[begin])) if begin < len(left) else 0):
        end = int(np.searchsorted(-left, -k))
        own = crc[begin:end]
        crc[begin:end] = _TABLE[(own ^ data[at[begin:end] + k]) & np.uint32(255)] ^ (own >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for i in range(begin):
        crc[i] = zlib.crc32(data[at[i] : at[i] + left[i]])
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _applied(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given as four tables of 256 (the last two axes), on every number."""
    return (
        tables[..., 0, :][crc & np.uint32(255)]
        ^ tables[..., 1, :][(crc >> np.uint32(8)) & np.uint32(255)]
        ^ tables[..., 2, :][(crc >> np.uint32(16)) & np.uint32(255)]
        ^ tables[..., 3, :][crc >> np.uint32(24)]
    )


@lru_cache(maxsize=1)
def _carries() -> tuple[np.ndarray, np.ndarray]:
    """Tables that carry a checksum over 0 to SHORT + 1 zero bytes, and over each power of two of them."""
    bytes_ = np.arange(256, dtype=np.uint32)
    same = np.stack([bytes_ << np.uint32(8 * k) for k in range(4)])
    small = [same]
    for _ in range(SHORT + 1):
        x = small[-1]
        small.append(_TABLE[x & np.uint32(255)] ^ (x >> np.uint32(8)))
    powers = [small[1]]
    for _ in range(31):
        powers.append(_applied(powers[-1], powers[-1]))
    return np.stack(small), np.stack(powers)


def carried(crc: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Checksums carried over so many zero bytes each."""
    small, powers = _carries()
    near = np.minimum(widths, SHORT + 1)
    flat = small.reshape(-1)
    base = near.astype(np.int64) << 10
    out = (
        flat[base + (crc & np.uint32(255))]
        ^ flat[base + 256 + ((crc >> np.uint32(8)) & np.uint32(255))]
        ^ flat[base + 512 + ((crc >> np.uint32(16)) & np.uint32(255))]
        ^ flat[base + 768 + (crc >> np.uint32(24))]
    )
    far = np.flatnonzero(widths > SHORT + 1)
    if len(far):
        rest, value = widths[far] - (SHORT + 1), out[far]
        for bit in range(32):
            on = (rest >> bit) & 1 == 1
            value[on] = _applied(powers[bit], value[on])
        out[far] = value
    return out


# ---- features


class Block:
    """The features of texts that lie one after the other in a block of bytes.

    ``text`` and ``bucket`` have an entry per feature, ``words`` a count per text. The first
    ``known[i]`` words of text i only lead into runs; runs that end with them are not counted.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, known: np.ndarray, buckets: int, order: int):
        data = _LOWER[data]
        inside = _WORD_BYTE[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = starts[:-1][starts[:-1] < len(data)]
        first[begins] = inside[begins]
        at = np.flatnonzero(first)
        # A word ends at the next byte that isn't in one, or where another begins.
        stop = np.flatnonzero(~inside)
        ends = np.concatenate([at[1:], [len(data)]])
        end = np.concatenate([stop, [len(data)]])[np.searchsorted(stop, at)]
        sizes = np.minimum(end, ends) - at
        owner = np.searchsorted(starts, at, side="right") - 1
        self.words = np.bincount(owner, minlength=len(starts) - 1)
        self.starts_of_words = at
        place = np.arange(len(at)) - np.concatenate([[0], np.cumsum(self.words)])[owner]
        counted = place >= known[owner]
        crc = word_checksums(data, at, sizes)
        spaced = carried(np.full(len(at), _SPACE_CRC, np.uint32), sizes) ^ crc  # of a space and the word
        texts, cells = [owner[counted]], [crc[counted] % np.uint32(buckets)]
        run = crc
        for length in range(2, order + 1):
            # Runs of this length, by the word that ends them.
            run = carried(run[:-1], sizes[length - 1 :] + 1) ^ spaced[length - 1 :]
            fits = counted[length - 1 :] & (place[length - 1 :] >= length - 1)
            texts.append(owner[length - 1 :][fits])
            cells.append(run[fits] % np.uint32(buckets))
        self.text, self.bucket = np.concatenate(texts), np.concatenate(cells).astype(np.int64)
        self.words = np.maximum(self.words - known, 0)


def blocks(part: pa.RecordBatch, buckets: int, order: int, stretch: int = STRETCH) -> Iterator[tuple[np.ndarray, Block]]:
    """(rows, block) of the texts of a batch; a text longer than a stretch comes in several blocks."""
    texts = [x or b"" for x in part.column("text").cast(pa.binary()).to_pylist()]
    sizes = [len(x) for x in texts]
    at = 0
    while at < len(texts):
        if sizes[at] > stretch:
            yield from _long(at, np.frombuffer(texts[at], np.uint8), buckets, order, stretch)
            at += 1
            continue
        to, total = at, 0
        while to < len(texts) and sizes[to] <= stretch and (to == at or total + sizes[to] <= stretch):
            total += sizes[to]
            to += 1
        data = np.frombuffer(b"".join(texts[at:to]), np.uint8)
        starts = np.cumsum([0, *sizes[at:to]])
        yield np.arange(at, to), Block(data, starts, np.zeros(to - at, np.int64), buckets, order)
        at = to


def _long(row: int, data: np.ndarray, buckets: int, order: int, stretch: int) -> Iterator[tuple[np.ndarray, Block]]:
    begin, known = 0, 0
    while begin < len(data):
        end, width = len(data), stretch
        while begin + width < len(data):
            # Back to a place between words; a word longer than the stretch widens it.
            outside = np.flatnonzero(~_WORD_BYTE[data[begin : begin + width]])
            if len(outside) and outside[-1] > width // 2:
                end = begin + int(outside[-1])
                break
            width *= 2
        block = Block(data[begin:end], np.array([0, end - begin]), np.array([known]), buckets, order)
        yield np.array([row]), block
        lead = block.starts_of_words[max(0, len(block.starts_of_words) - (order - 1)) :]
        if end == len(data):
            return
        begin, known = (begin + int(lead[0]), len(lead)) if len(lead) else (end, 0)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket that has any."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in slices(batches):
            for _, block in blocks(part, buckets, order):
                total += np.bincount(block.bucket, minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])

    return texts.select("text").mapInArrow(counted, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket the floor of a thousand logarithms of how much likelier the target is, smoothed by one."""
    width, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    ratio = (((t + 1) * (s_all + width)) / ((s + 1) * (t_all + width)) for s, t in zip(corpus.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(GAIN_SCALE * math.log(x)) for x in ratio], np.int64)


# ---- bit planes


def planes(rows: np.ndarray) -> np.ndarray:
    """Bit planes of rows of whole numbers from 0: axes bit, row, and 64 columns a word."""
    bits = max(int(rows.max(initial=0)).bit_length(), 1)
    out = np.zeros((bits, len(rows), -(-rows.shape[1] // 64)), np.uint64)
    view = out.view(np.uint8).reshape(bits, len(rows), -1)
    for i in range(bits):
        packed = np.packbits((rows >> i) & 1, axis=1)
        view[i, :, : packed.shape[1]] = packed
    return out


def plane_sums(counts: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> np.ndarray:
    """Sum of count times gain for every row of counts, by common bits of planes."""
    total = np.zeros(len(counts), np.int64)
    for i, own in enumerate(planes(counts)):
        for sign, gain in ((1, positive), (-1, negative)):
            for j, plane in enumerate(gain[:, 0]):
                total += sign * (np.bitwise_count(own & plane).sum(axis=1, dtype=np.int64) << (i + j))
    return total


def weighed(docs: DataFrame, gain: np.ndarray, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight): one row per document."""
    positive, negative = planes(np.maximum(gain, 0)[None]), planes(np.maximum(-gain, 0)[None])
    buckets = len(gain)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            weight, words = (np.zeros(part.num_rows, np.int64) for _ in range(2))
            for rows, block in blocks(part, buckets, order):
                words[rows] += block.words
                # Features by text, then a dense table of counts for a few texts at a time.
                by_text = np.argsort(block.text, kind="stable")
                text, bucket = block.text[by_text], block.bucket[by_text]
                for at in range(0, len(rows), BLOCK):
                    a, b = np.searchsorted(text, [at, at + BLOCK])
                    many = min(BLOCK, len(rows) - at)
                    cells = np.bincount((text[a:b] - at) * buckets + bucket[a:b], minlength=many * buckets)
                    cells = cells.astype(np.min_scalar_type(int(cells.max()))).reshape(many, buckets)
                    weight[rows[at : at + BLOCK]] += plane_sums(cells, positive, negative)
            features = sum(np.maximum(words - k, 0) for k in range(order))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(words), pa.array(features), pa.array(weight)],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = read.schema["doc_id"].dataType.simpleString()
    return read.mapInArrow(summed, f"doc_id {id_type}, n_words bigint, n_features bigint, weight bigint")


def _array(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    table = counts.toArrow()  # a row per bucket at most
    out[table["bucket"].to_numpy()] = table["n"].to_numpy()
    return out


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    order: int = ORDER,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): one row per document; undrawn ones have no rank.

    The score is the weight with Gumbel noise from a hash of seed and id, so the largest scores are a draw without
    replacement in proportion to the importance. ``percent`` of the documents of ``least_words`` words are drawn.
    """
    corpus = _array(bucket_counts(docs.select(F.col(text_col).alias("text")), buckets, order), buckets)
    gain = gains(corpus, _array(bucket_counts(target.select(F.col(text_col).alias("text")), buckets, order), buckets))
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    noise = F.floor(F.lit(-float(GAIN_SCALE)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    rows = stored(
        weighed(docs, gain, order, id_col, text_col).withColumn("score", F.col("weight") + noise), "dsir-scores"
    )
    names = ["doc_id", "n_features", "weight", "score"]
    able = F.col("n_words") >= least_words
    found = rows.agg(
        F.count(F.when(able, 1)).alias("n"),
        # The value's place is off by at most a share of 1 / ACCURACY, so twice that below is on the safe side.
        F.percentile_approx(F.when(able, F.col("score")), max(0.0, 1 - percent / 100 - 2 / ACCURACY), ACCURACY).alias("least"),
    ).first()
    drawn = percent * found["n"] // 100
    undrawn = F.lit(None).cast("bigint").alias("rank")
    if drawn == 0:
        return rows.select(*names, undrawn)
    high = able & (F.col("score") >= found["least"])
    order_by = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    ranked = range_rank(rows.filter(high).select(*names), [], order_by, "rank")
    kept = F.when(F.col("rank") <= drawn, F.col("rank")).cast("bigint").alias("rank")
    return ranked.select(*names, kept).unionAll(rows.filter(~high).select(*names, undrawn))


ORACLE = r"""
WITH RECURSIVE
crc_rows AS (
  SELECT b, b AS c, 0 AS step FROM range(256) t(b)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM crc_rows WHERE step < 8
),
crc_table AS (SELECT list(c ORDER BY b) AS t FROM crc_rows WHERE step = 8),
worded AS (
  SELECT 's' AS side, row_number() OVER () AS k, doc_id, text FROM documents
  UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark
),
cut AS (
  SELECT side, k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM worded
),
features AS (
  SELECT side, k, unnest(list_concat(w,
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f
  FROM cut
),
counted AS (SELECT side, k, f, count(*) AS n FROM features GROUP BY ALL),
hexed AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM counted)),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(x), 2), lambda i: ('0x' || x[i:i + 1])::BIGINT)),
                  lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 10000 AS bucket
  FROM hexed, crc_table
),
bucketed AS (SELECT side, k, bucket, n FROM counted JOIN hashed USING (f)),
sums AS (
  SELECT b AS bucket, coalesce(sum(n) FILTER (side = 's'), 0) AS s, coalesce(sum(n) FILTER (side = 't'), 0) AS t
  FROM range(10000) r(b) LEFT JOIN bucketed ON bucket = b GROUP BY b
),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + 10000)) / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000))))::BIGINT AS gain
  FROM sums
),
weights AS (
  SELECT k, sum(n * gain)::BIGINT AS weight FROM bucketed JOIN gains USING (bucket) WHERE side = 's' GROUP BY k
),
scored AS (
  SELECT doc_id, len(w) AS words, len(w) + greatest(len(w) - 1, 0) + greatest(len(w) - 2, 0) AS n_features,
         coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5)
                                                    / 4294967296)))::BIGINT AS score
  FROM cut LEFT JOIN weights USING (k) WHERE side = 's'
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
         count(*) OVER (PARTITION BY words >= 20) AS many
  FROM scored
)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
       CASE WHEN words >= 20 AND place <= 5 * many // 100 THEN place END AS rank
FROM ranked
"""
