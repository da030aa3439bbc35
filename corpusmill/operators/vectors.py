"""Embedding operators: centroids, categories, outliers, duplicates, mislabels.

Vectors arrive as ``(label, item_id, embedding array<float>)``. Wide vectors
are read by map-only passes wherever possible; what is shuffled afterwards is
the narrow result (distance, pair, flag).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_schema

from corpusmill.functions import vectors as V
from corpusmill.functions.constants import CATEGORIES, CORRUPTED
from corpusmill.functions.numeric import round_to, rounded, softmax
from corpusmill.plans.lineage import cut, written
from corpusmill.plans.sizing import BROADCAST_BYTES, join_small, small_table

PARTIAL_GROUPS = 2048
SUM_SALTS = 16
TILE = 4096
LOCAL_PAIRS = 200_000
END_SAMPLE = 20_000


# -- D2 ----------------------------------------------------------------------


def _partial_sums(schema: pa.Schema, group: Sequence[str], vector: str):
    """Arrow mapper that adds up unit vectors per group inside a partition."""

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def flush() -> pa.RecordBatch:
            columns = [pa.array([key[i] for key in held], schema.field(name).type)
                       for i, name in enumerate(group)]
            columns.append(pa.array([v[0] for v in held.values()], pa.int64()))
            columns.append(pa.array([v[1] for v in held.values()], pa.list_(pa.float64())))
            held.clear()
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = V.unit_rows(V.matrix(batch.column(batch.schema.get_field_index(vector))))
            keys = batch.select(list(group)).to_pandas()
            for key, index in keys.groupby(list(group), sort=False, dropna=False).indices.items():
                key = key if isinstance(key, tuple) else (key,)
                key = tuple(k.item() if isinstance(k, np.generic) else k for k in key)
                total = rows[index].sum(axis=0)
                if key in held:
                    held[key][0] += len(index)
                    held[key][1] += total
                else:
                    held[key] = [len(index), total]
            if len(held) >= PARTIAL_GROUPS:
                yield flush()
        if held:
            yield flush()

    return mapper


def centroids(
    vectors: DataFrame, group: Sequence[str] = ("label",), vector: str = "embedding"
) -> DataFrame:
    """Mean of the unit vectors of each group, renormalised: ``(*group, n, centroid)``.

    One partial sum per (partition, group) leaves the scan as an array and is
    added to others in two steps, first ``SUM_SALTS`` ways, so a dominant label
    costs as many rows as there are partitions, whatever the dimension.
    """
    keys = T.StructType([vectors.schema[c] for c in group])
    out = T.StructType(
        [*keys.fields, T.StructField("n", T.LongType()),
         T.StructField("total", T.ArrayType(T.DoubleType()))]
    )
    partial = (
        vectors.filter(F.col(vector).isNotNull())
        .select(*group, vector)
        .mapInArrow(_partial_sums(to_arrow_schema(out), list(group), vector), out)
    )
    salted = T.StructType([*out.fields, T.StructField("_salt", T.IntegerType())])
    halves = (
        partial.withColumn("_salt", F.spark_partition_id() % SUM_SALTS)
        .groupBy(*group, "_salt")
        .applyInArrow(_added(to_arrow_schema(salted), [*group, "_salt"]), salted)
    )
    whole = halves.drop("_salt").groupBy(*group).applyInArrow(_added(to_arrow_schema(out), group), out)
    return whole.select(*group, "n", V.l2_normalise(F.col("total")).alias("centroid"))


def _added(schema: pa.Schema, keys: Sequence[str]):
    """Arrow grouped mapper: one row with the sums of counts and arrays."""

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = V.matrix(table.column("total")).sum(axis=0)
        row = dict(zip(keys, (k.as_py() for k in key)))
        row |= {"n": sum(table.column("n").to_pylist()), "total": total.tolist()}
        return pa.Table.from_pylist([row], schema=schema)

    return add


def pack(
    table: DataFrame, order: Sequence[str], vector: str, max_bytes: int = BROADCAST_BYTES
) -> tuple[DataFrame, Broadcast] | None:
    """A small table of vectors as ``(keys + _index, broadcast unit matrix)``.

    None when the vectors exceed ``max_bytes``; at most that much is fetched.
    Callers that can't do without take :func:`ordered_blocks`.
    """
    spark = table.sparkSession
    head = table.select(vector).limit(1).collect()
    dim = len(head[0][0]) if head else 1
    limit = max(1, max_bytes // (8 * max(dim, 1)))
    rows = table.select(*order, vector).limit(limit + 1).toArrow()
    if rows.num_rows > limit:
        return None
    rows = rows.sort_by([(c, "ascending") for c in order])
    values = V.unit_rows(V.matrix(rows.column(vector))) if rows.num_rows else np.zeros((0, dim))
    keys = rows.select(list(order)).append_column(
        "_index", pa.array(np.arange(rows.num_rows, dtype=np.int32))
    )
    schema = T.StructType(
        [*[table.schema[c] for c in order], T.StructField("_index", T.IntegerType())]
    )
    return spark.createDataFrame(keys, schema=schema), spark.sparkContext.broadcast(values)


def ordered_blocks(
    cents: DataFrame, label: str, max_bytes: int = BROADCAST_BYTES
) -> list[tuple[DataFrame, Broadcast]]:
    """The centroids in label order, packed in blocks of at most ``max_bytes`` (one vector at least)."""
    sizes = cents.select(F.size("centroid")).limit(1).collect()
    names = sorted(r[0] for r in cents.select(label).collect())
    step = max(1, max_bytes // (8 * max(sizes[0][0] if sizes else 1, 1)))
    bounds = [(names[i], names[min(i + step, len(names)) - 1]) for i in range(0, len(names), step)]
    return [pack(cents.filter(F.col(label).between(a, b)), (label,), "centroid", max_bytes) for a, b in bounds]


def class_scores(
    vectors: DataFrame,
    cents: DataFrame,
    label: str = "label",
    vector: str = "embedding",
    max_bytes: int = BROADCAST_BYTES,
) -> Column:
    """Cosines of a row's vector to all centroids, one array in label order."""
    parts = [V.similarities(F.col(vector), block) for _, block in ordered_blocks(cut(cents), label, max_bytes)]
    return F.concat(*parts) if parts else F.array().cast("array<double>")


# -- D6 ----------------------------------------------------------------------


def own_distances(
    vectors: DataFrame,
    cents: DataFrame,
    group: Sequence[str] = ("label",),
    vector: str = "embedding",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``distance`` = 1 - cosine to the centroid of the row's own group."""
    present = vectors.filter(F.col(vector).isNotNull())
    packed = pack(cents, group, "centroid", max_bytes)
    if packed is None:
        joined = present.join(cents.select(*group, "centroid"), list(group))
        return joined.withColumn(
            "distance", V.pair_distance(F.col(vector), F.col("centroid"))
        ).drop("centroid")
    index, reference = packed
    return (
        present.join(F.broadcast(index), list(group))
        .withColumn("distance", V.own_distance(F.col(vector), F.col("_index"), reference))
        .drop("_index")
    )


def outliers(
    vectors: DataFrame,
    sigma: float = 1.5,
    min_items: int = 3,
    group: Sequence[str] = ("label",),
    item: str = "item_id",
    vector: str = "embedding",
    cents: DataFrame | None = None,
) -> DataFrame:
    """``(*group, item, distance, is_outlier)``: strictly beyond mean + sigma * std.

    Groups below ``min_items`` get distance 0 and no outlier. The vectors are
    read twice (centroids, distances), once when ``cents`` are given; the
    narrow distances are written once.
    """
    cents = centroids(vectors, group, vector) if cents is None else cents
    narrow = cut(
        own_distances(vectors, cents, group, vector).select(*group, item, "distance")
    )
    stats = narrow.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_n"),
        (F.avg("distance") + F.lit(float(sigma)) * F.stddev_pop("distance")).alias("_limit"),
    )
    enough = F.col("_n") >= min_items
    return join_small(narrow, stats, group).select(
        *group,
        item,
        F.when(enough, round_to(F.col("distance"), 4)).otherwise(F.lit(0.0)).alias("distance"),
        (enough & (F.col("distance") > F.col("_limit"))).alias("is_outlier"),
    )


# -- D3 / D4 / D5 -------------------------------------------------------------


def zero_shot(
    vectors: DataFrame,
    prototypes: DataFrame,
    categories: Sequence[str] = CATEGORIES,
    good: str = "good",
    margin: float = 0.005,
    vector: str = "embedding",
) -> DataFrame:
    """Add ``category``, ``confidence`` and ``scores`` (category -> probability).

    ``prototypes`` has one ``(category, embedding)`` row per category. The best
    negative wins unless it leads ``good`` by less than ``margin``.
    """
    order = list(categories)
    fetched = prototypes.filter(F.col("category").isin(*order)).limit(len(order) + 1).collect()
    by_name = {row["category"]: row["embedding"] for row in fetched}
    if len(fetched) != len(order) or set(by_name) != set(order):
        raise ValueError("prototypes must hold exactly one row per category")
    values = V.unit_rows(np.array([by_name[c] for c in order], dtype=np.float64))
    reference = vectors.sparkSession.sparkContext.broadcast(values)

    good_at = order.index(good)
    negatives = [i for i in range(len(order)) if i != good_at]
    probs = F.col("_probs")
    rivals = F.array(*[probs[i] for i in negatives])
    lead = F.array_max(rivals)
    rival = F.element_at(
        F.array(*[F.lit(i) for i in negatives]), F.array_position(rivals, lead).cast("int")
    )
    chosen = F.when(lead - probs[good_at] < margin, F.lit(good_at)).otherwise(rival)
    names = F.array(*[F.lit(c) for c in order])
    return (
        vectors.filter(F.col(vector).isNotNull())
        .withColumn("_sims", V.similarities(F.col(vector), reference))
        .withColumn("_probs", softmax(F.col("_sims")))
        .withColumn("_chosen", chosen)
        .withColumn("category", F.element_at(names, F.col("_chosen") + 1))
        .withColumn("confidence", round_to(F.element_at(probs, F.col("_chosen") + 1), 4))
        .withColumn(
            "scores",
            F.map_from_arrays(names, F.transform(probs, lambda p: rounded(p, 4))),
        )
        .drop("_sims", "_probs", "_chosen")
    )


def with_corrupted(
    classified: DataFrame,
    items: DataFrame,
    keys: Sequence[str] = ("label", "item_id"),
    unreadable: Column | None = None,
) -> DataFrame:
    """Add a ``corrupted`` row (confidence 1, no scores) per unreadable item."""
    unreadable = F.col("width") <= 0 if unreadable is None else unreadable
    empty = F.create_map().cast("map<string,double>")
    broken = items.filter(unreadable).select(
        *keys,
        F.lit(CORRUPTED).alias("category"),
        F.lit(1.0).alias("confidence"),
        empty.alias("scores"),
    )
    return classified.select(*keys, "category", "confidence", "scores").unionByName(broken)


def category_summary(
    classified: DataFrame,
    categories: Sequence[str] = CATEGORIES,
    group: Sequence[str] = ("label",),
) -> DataFrame:
    """Per group: ``total`` (corrupted included) and one count per category."""
    counts = [F.count_if(F.col("category") == c).alias(c) for c in categories]
    return classified.groupBy(*group).agg(F.count(F.lit(1)).alias("total"), *counts)


# -- D9 / D10 -----------------------------------------------------------------


def mislabeled(
    vectors: DataFrame,
    margin: float = 0.1,
    label: str = "label",
    item: str = "item_id",
    vector: str = "embedding",
    max_bytes: int = BROADCAST_BYTES,
    cents: DataFrame | None = None,
) -> DataFrame:
    """``(label, item, own_distance, nearest_label, nearest_distance, suspected)``.

    Centroids travel in broadcast blocks of at most ``max_bytes``, in label
    order. One block is a map-only pass; several blocks are scanned one by one
    and their minima merged per item. Fewer than two labels give no rows.
    """
    cents = cut(centroids(vectors, (label,), vector)) if cents is None else cents
    present = vectors.filter(F.col(vector).isNotNull())
    if cents.count() < 2:
        present = present.filter(F.lit(False))
    blocks = ordered_blocks(cents, label, max_bytes) or [pack(cents, (label,), "centroid")]
    found = [_nearest_in_block(present, *block, label, item, vector) for block in blocks]
    best = found[0]
    for other in found[1:]:
        best = best.unionByName(other)
    if len(found) > 1:
        best = (
            best.groupBy(label, item)
            .agg(
                F.max("own_distance").alias("own_distance"),
                F.min(F.struct("nearest_distance", "nearest_label")).alias("_best"),
            )
            .select(label, item, "own_distance", "_best.nearest_label", "_best.nearest_distance")
        )
    gap = F.col("own_distance") - F.col("nearest_distance")
    return best.select(
        label,
        item,
        round_to(F.col("own_distance"), 4).alias("own_distance"),
        "nearest_label",
        round_to(F.col("nearest_distance"), 4).alias("nearest_distance"),
        (gap > F.lit(float(margin))).alias("suspected"),
    )


def _nearest_in_block(present, index, reference, label, item, vector) -> DataFrame:
    """Nearest foreign centroid of one block (inf when it holds no other label)."""
    names = index.select(
        F.col("_index").cast("double").alias("_at"), F.col(label).alias("nearest_label")
    )
    own = F.coalesce("_index", F.lit(-1))
    return (
        present.join(F.broadcast(index), label, "left")
        .withColumn("_near", V.nearest_other(F.col(vector), own, reference))
        .select(
            label,
            item,
            F.col("_near")[0].alias("_at"),
            F.col("_near")[1].alias("nearest_distance"),
            F.col("_near")[2].alias("own_distance"),
        )
        .join(F.broadcast(names), "_at")
        .drop("_at")
    )


def mislabel_summary(found: DataFrame, label: str = "label") -> DataFrame:
    """Suspected items per label with a grand total (null label)."""
    per_label = (
        found.filter("suspected").groupBy(label).agg(F.count(F.lit(1)).alias("suspected_count"))
    )
    none = F.lit(None).cast(found.schema[label].dataType).alias(label)
    total = per_label.agg(F.coalesce(F.sum("suspected_count"), F.lit(0)).alias("suspected_count"))
    return per_label.unionByName(total.select(none, "suspected_count"))


# -- D7 / D8 -----------------------------------------------------------------


def split_copies(
    vectors: DataFrame,
    group: Sequence[str] = ("label",),
    item: str = "item_id",
    vector: str = "embedding",
    score: str | None = None,
    scores: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Separate bit-identical vectors: ``(distinct rows, copies, sizes)``.

    The pairs of all vectors follow from those of the distinct ones and the
    copies: a copy has the pairs of its representative, and copies of one set
    are pairs of similarity 1.

    Each set of copies is represented by its best item (highest ``score``,
    then smallest id). ``copies`` lists the others as ``(*group, kept, removed)``,
    ``sizes`` the number ``n`` of distinct vectors per group. Sets are found on
    a 128-bit hash with map-side aggregation, so a set that holds a third of
    the rows costs one row per partition; the narrow sets are written once.
    ``score`` is a column of ``scores``, joined to the narrow hashes only, or
    of the vectors themselves.
    """
    hashed = vectors.filter(F.col(vector).isNotNull()).withColumns(
        {"_h1": F.xxhash64(vector), "_h2": F.xxhash64(F.reverse(vector))}
    )
    narrow = hashed.drop(vector)
    if scores is not None:
        narrow = narrow.join(scores.select(*group, item, score), [*group, item], "left")
    value = F.coalesce(F.col(score), F.lit(0.0)) if score else F.lit(0.0)
    every = cut(
        narrow.withColumn("_score", value).groupBy(*group, "_h1", "_h2").agg(
            F.count(F.lit(1)).alias("_copies"),
            F.min(F.struct((-F.col("_score")).alias("s"), F.col(item).alias("i"))).alias("_best"),
        )
    )
    sets = every.filter(F.col("_copies") > 1).select(
        *group, "_h1", "_h2", F.col("_best.i").alias("kept")
    )
    sizes = every.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    marked = join_small(hashed, sets, [*group, "_h1", "_h2"], "left")
    is_copy = F.col("kept").isNotNull() & (F.col("kept") != F.col(item))
    distinct = marked.filter(~is_copy).drop("kept", "_h2")
    copies = marked.filter(is_copy).select(*group, "kept", F.col(item).alias("removed"))
    return distinct, copies, sizes


def _plain(ids: pa.ChunkedArray) -> np.ndarray:
    """Whole numbers as such, so that pairs need no Python objects; other ids as objects."""
    if pa.types.is_integer(ids.type) and not ids.null_count:
        return ids.to_numpy()
    return np.asarray(ids.to_pylist(), dtype=object)


def _tile_pairs(group: Sequence[str], item: str, vector: str, threshold: float, schema: pa.Schema):
    """Arrow grouped mapper: pairs above the threshold inside one tile pair."""

    def mapper(key: tuple, table: pa.Table) -> pa.Table:
        same = key[-2].as_py() == key[-1].as_py()
        second = np.asarray(table.column("_second").combine_chunks(), dtype=bool)
        rows = V.unit_rows(V.matrix(table.column(vector)))
        ids = _plain(table.column(item))
        left = np.arange(len(ids)) if same else np.nonzero(~second)[0]
        right = left if same else np.nonzero(second)[0]
        out_a, out_b, out_s = [], [], []
        for part in V.blocks(len(left), max(1, len(right))):
            sims = rows[left[part]] @ rows[right].T
            at, bt = np.nonzero(sims > threshold)
            value = sims[at, bt]
            a, b = ids[left[part][at]], ids[right[bt]]
            if same:
                keep = a < b
                a, b, value = a[keep], b[keep], value[keep]
            swap = np.asarray(a > b, dtype=bool)
            out_a.append(np.where(swap, b, a))
            out_b.append(np.where(swap, a, b))
            out_s.append(value)
        count = sum(map(len, out_s))
        columns = [pa.array([k.as_py()] * count, schema.field(i).type)
                   for i, k in enumerate(key[: len(group)])]
        for name, parts in (("item_a", out_a), ("item_b", out_b), ("similarity", out_s)):
            flat = np.concatenate(parts) if parts else []
            columns.append(pa.array(flat, schema.field(name).type))
        return pa.Table.from_arrays(columns, schema=schema)

    return mapper


def near_pairs(
    distinct: DataFrame,
    threshold: float = 0.95,
    group: Sequence[str] = ("label",),
    item: str = "item_id",
    vector: str = "embedding",
    tile: int = TILE,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Exact pairs of one group with cosine strictly above ``threshold``.

    Output ``(*group, item_a, item_b, similarity)`` with item_a < item_b.
    Every group is cut into tiles of about ``tile`` vectors and every pair of
    tiles is one task-sized matrix product, so a dominant label becomes many
    equal units. Only pairs above the threshold leave a task. Feed it the
    distinct rows of :func:`split_copies`, so that identical vectors do not
    multiply, and its ``sizes``, which saves counting them again.
    """
    narrow = distinct.filter(F.col(vector).isNotNull()).select(*group, item, vector)
    if sizes is None:
        sizes = narrow.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    tiles = sizes.select(*group, F.ceil(F.col("n") / F.lit(tile)).cast("int").alias("_tiles"))
    keyed = join_small(narrow, tiles, group).withColumn(
        "_tile", F.pmod(F.xxhash64(item), F.col("_tiles")).cast("int")
    )
    paired = keyed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
    paired = paired.select(
        *group,
        F.least("_tile", "_other").alias("_a"),
        F.greatest("_tile", "_other").alias("_b"),
        (F.col("_tile") > F.col("_other")).alias("_second"),
        item,
        vector,
    )
    out = T.StructType(
        [
            *[distinct.schema[c] for c in group],
            T.StructField("item_a", distinct.schema[item].dataType),
            T.StructField("item_b", distinct.schema[item].dataType),
            T.StructField("similarity", T.DoubleType()),
        ]
    )
    mapper = _tile_pairs(list(group), item, vector, float(threshold), to_arrow_schema(out))
    return paired.groupBy(*group, "_a", "_b").applyInArrow(mapper, out)


def _greedy_local(group: Sequence[str]):
    """Walk the ranked pairs of one bounded group."""

    def resolve(pairs: pd.DataFrame) -> pd.DataFrame:
        pairs = pairs.sort_values(["_neg", "item_a", "item_b"], kind="stable")
        gone: set = set()
        kept, removed, keep_row = [], [], []
        for a, b, loser in zip(pairs["item_a"], pairs["item_b"], pairs["_loser"]):
            a_gone, b_gone = a in gone, b in gone
            keep_row.append(not (a_gone and b_gone))
            out = a if a_gone else b if b_gone else loser
            if not (a_gone or b_gone):
                gone.add(loser)
            removed.append(out)
            kept.append(b if out == a else a)
        result = pairs[list(group)].assign(kept=kept, removed=removed, similarity=-pairs["_neg"])
        return result[np.asarray(keep_row, dtype=bool)]

    return resolve


def _walk(group: Sequence[str]):
    """The first ends removed by a stretch of one group's ranked pairs, each with the pair that did it."""

    def walk(pairs: pd.DataFrame) -> pd.DataFrame:
        pairs = pairs.sort_values(["_neg", "item_a", "item_b"], kind="stable")
        gone: set = set()
        taken = np.zeros(len(pairs), dtype=bool)
        for at, (a, b, loser) in enumerate(zip(pairs["item_a"], pairs["item_b"], pairs["_loser"])):
            if a not in gone and b not in gone:
                gone.add(loser)
                taken[at] = True
        return pairs.loc[taken, [*group, "_loser", "_neg", "item_a", "item_b"]]

    return walk


def _stretch_ends(open_pairs: DataFrame, sizes: DataFrame, group: Sequence[str], stretch: int) -> DataFrame:
    """``(*group, _end)``: the place up to which a group has about ``stretch`` open pairs, null for all of them.

    Places are those of a sample by hash, in which a group has ``END_SAMPLE``
    pairs or a few more or less, whatever its size.
    """
    cells = 1 << 40
    share = F.least(F.lit(1.0), F.lit(float(END_SAMPLE)) / F.col("_n"))
    sample = join_small(open_pairs, sizes.filter(F.col("_n") > stretch), group).filter(
        F.pmod(F.xxhash64("item_a", "item_b"), F.lit(cells)) < share * cells
    )
    inside = W.partitionBy(*group).orderBy("_neg", "item_a", "item_b")
    first = sample.withColumn("_at", F.row_number().over(inside)).filter(
        F.col("_at") <= F.greatest(F.lit(1.0), share * stretch)
    )
    ends = first.groupBy(*group).agg(F.max(F.struct("_neg", "item_a", "item_b")).alias("_end"))
    return cut(join_small(sizes, ends, group, "left"))


def _greedy_stretches(pairs: DataFrame, group: Sequence[str], stretch: int) -> DataFrame:
    """The same walk for groups too large for one task, a stretch of ranked pairs at a time.

    One task walks the first ``stretch`` undecided pairs of its group, about
    that many; what they remove settles most pairs that follow, which are
    dropped before the next stretch. So the stretches are few: those that are
    walked hold the most similar pairs, and few vectors are left that are as
    near to each other. In the end every pair is compared with the places at
    which its ends were removed.
    """
    order = F.struct("_neg", "item_a", "item_b")
    lost = T.StructType(
        [*[pairs.schema[c] for c in group], *[pairs.schema[c] for c in ("_loser", "_neg", "item_a", "item_b")]]
    )
    open_pairs, found = pairs, None
    while True:
        sizes = cut(open_pairs.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")))
        if sizes.isEmpty():
            break
        ends = _stretch_ends(open_pairs, sizes, group, stretch)
        placed = join_small(open_pairs, ends.select(*group, "_end"), group, "left")
        now = F.col("_end").isNull() | (order <= F.col("_end"))
        walked = placed.filter(now).drop("_end").groupBy(*group).applyInPandas(_walk(group), lost)
        removed = written(walked.select(*group, F.col("_loser").alias("_gone"), order.alias("_by")))
        found = removed if found is None else found.unionByName(removed)
        later = placed.filter(~now).drop("_end")
        gone, fits = small_table(removed.select(*group, "_gone"))
        for end in ("item_a", "item_b"):
            side = gone.withColumnRenamed("_gone", end)
            later = later.join(F.broadcast(side) if fits else side, [*group, end], "left_anti")
        open_pairs = written(later)
    settled = pairs
    if found is None:
        found = written(settled.select(*group, F.col("item_a").alias("_gone"), order.alias("_by")).limit(0))
    gone, fits = small_table(found)
    for end in ("a", "b"):
        side = gone.withColumnsRenamed({"_gone": f"item_{end}", "_by": f"_by_{end}"})
        settled = settled.join(F.broadcast(side) if fits else side, [*group, f"item_{end}"], "left")
    a_gone = F.coalesce(F.col("_by_a") < order, F.lit(False))
    b_gone = F.coalesce(F.col("_by_b") < order, F.lit(False))
    removed = F.when(a_gone, F.col("item_a")).when(b_gone, F.col("item_b")).otherwise(F.col("_loser"))
    return (
        settled.filter(~(a_gone & b_gone))
        .withColumn("removed", removed)
        .select(
            *group,
            F.when(F.col("removed") == F.col("item_a"), F.col("item_b"))
            .otherwise(F.col("item_a")).alias("kept"),
            "removed",
            (-F.col("_neg")).alias("similarity"),
        )
    )


def resolve_duplicates(
    pairs: DataFrame,
    scores: DataFrame,
    group: Sequence[str] = ("label",),
    item: str = "item_id",
    score: str = "composite_score",
    copies: DataFrame | None = None,
    local_pairs: int = LOCAL_PAIRS,
    stretch: int = LOCAL_PAIRS,
) -> DataFrame:
    """Greedy ``(*group, kept, removed, similarity)`` records.

    Pairs are taken by similarity, highest first, then by ids. The better
    score stays, the smaller id on a tie; a pair with one end already removed
    is recorded, a pair with both removed is not. Groups with at most
    ``local_pairs`` pairs are walked in one task each, larger ones by about
    ``stretch`` pairs at a time with the same outcome. Scores go to the pairs by
    broadcast if they fit. ``copies`` adds one record per exact copy.
    """
    value = F.coalesce(F.col(score), F.lit(0.0))
    known, fits = small_table(scores.select(*group, F.col(item).alias("_item"), value.alias("_s")))
    scored = pairs
    for end in ("a", "b"):
        side = known.withColumnsRenamed({"_item": f"item_{end}", "_s": f"_s_{end}"})
        scored = scored.join(F.broadcast(side) if fits else side, [*group, f"item_{end}"], "left")
    s_a, s_b = F.coalesce("_s_a", F.lit(0.0)), F.coalesce("_s_b", F.lit(0.0))
    ranked = written(
        scored.select(
            *group,
            "item_a",
            "item_b",
            (-F.col("similarity")).alias("_neg"),
            F.when(s_b > s_a, F.col("item_a")).otherwise(F.col("item_b")).alias("_loser"),
        )
    )
    per_group = cut(ranked.groupBy(*group).agg((F.count(F.lit(1)) > local_pairs).alias("_large")))
    marked = join_small(ranked, per_group, group)
    out = T.StructType(
        [
            *[pairs.schema[c] for c in group],
            T.StructField("kept", pairs.schema["item_a"].dataType),
            T.StructField("removed", pairs.schema["item_a"].dataType),
            T.StructField("similarity", T.DoubleType()),
        ]
    )
    result = (
        marked.filter(~F.col("_large")).drop("_large")
        .groupBy(*group).applyInPandas(_greedy_local(group), out)
    )
    if not per_group.filter("_large").isEmpty():
        large = marked.filter("_large").drop("_large")
        result = result.unionByName(_greedy_stretches(large, group, max(1, stretch)))
    if copies is not None:
        result = result.unionByName(copies.withColumn("similarity", F.lit(1.0)))
    return result.withColumn("similarity", round_to(F.col("similarity"), 4))


def near_duplicates(
    vectors: DataFrame,
    scores: DataFrame | None = None,
    threshold: float = 0.95,
    group: Sequence[str] = ("label",),
    item: str = "item_id",
    vector: str = "embedding",
    score: str = "composite_score",
    find: Callable[..., DataFrame] | None = None,
) -> DataFrame:
    """Copies and near pairs of every group resolved to kept/removed records.

    ``find`` makes the pairs, for example ``pivots.pruned_pairs`` for vectors in clusters.
    """
    if scores is None:
        scores = vectors.select(*group, item, F.lit(0.0).alias(score))
    distinct, copies, sizes = split_copies(vectors.select(*group, item, vector), group, item, vector, score, scores)
    if find is None:
        pairs = near_pairs(distinct, threshold, group, item, vector, sizes=sizes)
    else:
        pairs = find(distinct, threshold, group, item, vector)
    return resolve_duplicates(
        pairs, scores, group, item, score, copies if threshold < 1.0 else None
    )


# -- D11 ----------------------------------------------------------------------


def encode(
    items: DataFrame,
    encoder: Callable[..., np.ndarray],
    payload: str,
    keys: Sequence[str] = ("label", "item_id"),
    batch_size: int = 64,
    setup: Callable[[], object] | None = None,
) -> DataFrame:
    """Run a caller-supplied encoder over the payload column in batches.

    ``encoder`` maps a Series of up to ``batch_size`` payloads to a (rows, dim)
    array, row for row. ``setup`` runs once per task (loading a model); what it
    returns is handed to the encoder before the payloads.
    """
    out = T.StructType(
        [*[items.schema[c] for c in keys], T.StructField("embedding", T.ArrayType(T.FloatType()))]
    )

    def mapper(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = () if setup is None else (setup(),)
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                part = frame.iloc[start : start + batch_size]
                values = np.asarray(encoder(*state, part[payload]), dtype=np.float32)
                if len(values) != len(part):
                    raise ValueError("the encoder must return one vector per payload")
                yield part[list(keys)].assign(embedding=list(values))

    return items.select(*keys, payload).mapInPandas(mapper, out)
