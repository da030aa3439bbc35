"""Sourcing from an observation catalogue: eligibility, quotas, manifests.

Tables: ``taxa(taxon_id, name, rank, ancestry, active)``,
``observations(observation_uuid, taxon_id, latitude, longitude, quality_grade,
observer_id, observed_on)`` and ``photos(photo_id, observation_uuid, extension,
position, width, height)``. What a loop over labels would ask one query at a
time is asked once for all labels here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusmill.functions import constants as C
from corpusmill.functions.hashing import shuffle_key
from corpusmill.functions.numeric import in_box
from corpusmill.functions.text import has_extension, slug, stem
from corpusmill.plans.lineage import cut
from corpusmill.plans.ranking import range_rank, top_n
from corpusmill.plans.sizing import join_small, small_table

Box = tuple[float, float, float, float]
BURST = ("observer_id", "observed_on", "_lat", "_lon")
PHOTO = ("photo_id", "extension", "position", "latitude", "longitude")


# -- A1, A2, A12, A13: taxa ----------------------------------------------------


def in_clade(ancestry: Column, clade_id: int) -> Column:
    """The clade occurs in the path, but not as its first element."""
    return ancestry.like(f"%/{clade_id}/%") | ancestry.like(f"%/{clade_id}")


def eligible_labels(
    observations: DataFrame,
    taxa: DataFrame,
    box: Box = C.EUROPE_BOX,
    clade_id: int = C.CLADE_ID,
    min_obs: int = C.MIN_OBSERVATIONS,
) -> DataFrame:
    """Species of a clade with enough research observations inside the box.

    Observations are counted per taxon before the join, so the join and the
    ordering see one row per taxon.
    """
    counts = (
        observations.filter(
            (F.col("quality_grade") == "research")
            & in_box(F.col("latitude"), F.col("longitude"), box)
        )
        .groupBy("taxon_id")
        .agg(F.count(F.lit(1)).alias("obs_count"))
        .filter(F.col("obs_count") >= min_obs)
    )
    species = taxa.filter((F.col("rank") == "species") & in_clade(F.col("ancestry"), clade_id))
    return (
        species.select("taxon_id", "name")
        .join(counts, "taxon_id")
        .orderBy(F.col("obs_count").desc(), "taxon_id")
    )


def resolve_taxa(names: DataFrame, taxa: DataFrame, name: str = "name") -> DataFrame:
    """Species taxon of each name: active ones first, then the smallest id."""
    choice = (
        taxa.filter(F.col("rank") == "species")
        .groupBy(F.col("name").alias(name))
        .agg(F.min(F.struct((-F.col("active").cast("int")).alias("a"), "taxon_id")).alias("_t"))
        .select(name, F.col("_t.taxon_id").alias("taxon_id"))
    )
    return names.join(choice, name)


def ancestor_of_rank(
    taxa: DataFrame,
    of: DataFrame | None = None,
    rank: str = "family",
    default: str = "Unknown",
    alias: str = "family",
) -> DataFrame:
    """``(taxon_id, family)`` for the taxa listed in ``of`` (all when omitted)."""
    wanted = taxa if of is None else taxa.join(of.select("taxon_id").distinct(), "taxon_id", "left_semi")
    ranked = taxa.filter(F.col("rank") == rank).select(
        F.col("taxon_id").alias("_ancestor"), F.col("name").alias("_name")
    )
    path = wanted.select(
        "taxon_id", F.explode(F.split("ancestry", "/")).alias("_step")
    ).select("taxon_id", F.expr("try_cast(_step AS bigint)").alias("_ancestor"))
    found = (
        join_small(path, ranked, ["_ancestor"])
        .groupBy("taxon_id")
        .agg(F.min_by("_name", "_ancestor").alias(alias))
    )
    return wanted.select("taxon_id").join(found, "taxon_id", "left").na.fill(default, [alias])


# -- A3 - A8: photos -----------------------------------------------------------


def eligible_photos(
    photos: DataFrame,
    observations: DataFrame,
    box: Box | None = None,
    max_position: int = 0,
    min_width: int = C.MIN_PHOTO_WIDTH,
    min_height: int = C.MIN_PHOTO_HEIGHT,
) -> DataFrame:
    """Photos of research observations that pass position, size and box tests."""
    seen = observations.filter(F.col("quality_grade") == "research")
    if box is not None:
        seen = seen.filter(in_box(F.col("latitude"), F.col("longitude"), box))
    large = photos.filter(
        (F.col("position") <= max_position)
        & (F.col("width") >= min_width)
        & (F.col("height") >= min_height)
    )
    return large.select("photo_id", "observation_uuid", "extension", "position").join(
        seen.select("observation_uuid", "taxon_id", "latitude", "longitude", "observer_id", "observed_on"),
        "observation_uuid",
    )


def dedupe_bursts(candidates: DataFrame, group: Sequence[str] = ("taxon_id",)) -> DataFrame:
    """One photo (the smallest id) per observer, day and place within a label."""
    placed = candidates.withColumns({"_lat": F.round("latitude", 2), "_lon": F.round("longitude", 2)})
    best = F.min_by(F.struct(*PHOTO), "photo_id").alias("_photo")
    return placed.groupBy(*group, *BURST).agg(best).select(
        *group, "observer_id", "observed_on", "_photo.*"
    )


def count_available(candidates: DataFrame, group: Sequence[str] = ("taxon_id",)) -> DataFrame:
    """Number of bursts per label, without materialising their photos."""
    placed = candidates.withColumns({"_lat": F.round("latitude", 2), "_lon": F.round("longitude", 2)})
    return (
        placed.select(*group, *BURST).distinct()
        .groupBy(*group).agg(F.count(F.lit(1)).alias("available"))
    )


def sample_per_label(
    candidates: DataFrame, n: int, seed: int = 42, group: Sequence[str] = ("taxon_id",)
) -> DataFrame:
    """n pseudo-random photos per label."""
    order = [shuffle_key(F.col("photo_id"), seed), F.col("photo_id")]
    return top_n(candidates, group, order, n).drop("rn")


def existing_ids(items: DataFrame, extensions: Sequence[str] = C.MERGED_EXTENSIONS) -> DataFrame:
    """``(label, photo_id)`` of items whose file stem is an integer."""
    return (
        items.filter(has_extension(F.col("name"), extensions))
        .select("label", stem(F.col("name")).alias("_stem"))
        .select("label", F.expr("try_cast(_stem AS bigint)").alias("photo_id"))
        .filter(F.col("photo_id").isNotNull())
        .distinct()
    )


def exclude_existing(
    candidates: DataFrame, existing_items: DataFrame, extensions: Sequence[str] = C.MERGED_EXTENSIONS
) -> DataFrame:
    """Candidates (with ``label``) whose photo is not among the items of the label."""
    return candidates.join(
        existing_ids(existing_items, extensions), ["label", "photo_id"], "left_anti"
    )


def count_items(items: DataFrame, extensions: Sequence[str] = C.MERGED_EXTENSIONS) -> DataFrame:
    """Items per label over all splits, by accepted extension."""
    return (
        items.filter(has_extension(F.col("name"), extensions))
        .groupBy("label").agg(F.count(F.lit(1)).alias("existing"))
    )


# -- A9 - A11: quotas ----------------------------------------------------------


def label_needs(meta: DataFrame, counts: DataFrame, target: int, min_download: int = 0) -> DataFrame:
    """Labels below target with ``existing`` and ``needed``.

    ``meta`` carries the resolved ``taxon_id``; labels without one are skipped.
    """
    needed = F.greatest(F.lit(0), F.lit(target) - F.col("existing"))
    if min_download > 0:
        needed = F.when(needed > 0, F.greatest(needed, F.lit(min_download))).otherwise(needed)
    return (
        meta.filter(F.col("taxon_id").isNotNull())
        .join(counts.select("label", "existing"), "label", "left")
        .withColumn("existing", F.coalesce("existing", F.lit(0)))
        .withColumn("needed", needed.cast("bigint"))
        .filter(F.col("needed") > 0)
    )


def _largest(needs: DataFrame) -> int:
    return needs.agg(F.max("needed")).first()[0] or 0


def fill_tiers(
    photos: DataFrame,
    observations: DataFrame,
    needs: DataFrame,
    existing_items: DataFrame,
    box: Box = C.EUROPE_BOX,
    max_position: int = 0,
    relax_below: int = C.RELAX_BELOW,
    seed: int = 42,
    tiers: tuple[str, str] = ("europe", "worldwide"),
) -> DataFrame:
    """Photos that fill each label's need: the box first, then the whole world.

    ``(label, photo_id, extension, source)``. When only primary photos are
    allowed and fewer than ``relax_below`` are left worldwide, later positions
    of that label are admitted too.
    """
    needs, _ = small_table(needs.select("label", "taxon_id", "needed"))
    largest = _largest(needs)
    reach = max(max_position, C.RELAXED_POSITION) if max_position == 0 else max_position
    wanted = join_small(observations, needs.select("taxon_id"), ["taxon_id"], "left_semi")
    pool = eligible_photos(photos, wanted, None, reach)
    base = cut(exclude_existing(join_small(pool, needs, ["taxon_id"]), existing_items))

    order = [shuffle_key(F.col("photo_id"), seed), F.col("photo_id")]
    group = ("label", "needed")
    inside = base.filter(
        (F.col("position") <= max_position) & in_box(F.col("latitude"), F.col("longitude"), box)
    )
    first = cut(
        top_n(dedupe_bursts(inside, group), ["label"], order, largest, "needed")
        .select("label", "photo_id", "extension")
    )

    found = first.groupBy("label").agg(F.count(F.lit(1)).alias("_found"))
    left = (
        needs.join(found, "label", "left")
        .withColumn("_left", F.col("needed") - F.coalesce("_found", F.lit(0)))
        .filter(F.col("_left") > 0)
        .select("label", "_left")
    )
    rest = join_small(base.join(first.select("label", "photo_id"), ["label", "photo_id"], "left_anti"),
                      left, ["label"])
    limit = F.lit(max_position)
    if max_position == 0:
        available = count_available(rest.filter(F.col("position") <= 0), ("label",))
        rest = join_small(rest, available, ["label"], "left")
        relaxed = F.coalesce("available", F.lit(0)) < relax_below
        limit = F.when(relaxed, F.lit(C.RELAXED_POSITION)).otherwise(F.lit(0))
    second = top_n(
        dedupe_bursts(rest.filter(F.col("position") <= limit), ("label", "_left")),
        ["label"], order, largest, "_left",
    ).select("label", "photo_id", "extension")
    return first.withColumn("source", F.lit(tiers[0])).unionByName(
        second.withColumn("source", F.lit(tiers[1]))
    )


def fill_priority(
    photos: DataFrame,
    observations: DataFrame,
    needs: DataFrame,
    priority: Sequence[str] = C.PRIORITY_LABELS,
    inner: Box = C.FRANCE_BOX,
    outer: Box = C.EUROPE_BOX,
    seed: int = 42,
) -> DataFrame:
    """Photos per label; priority labels take the inner box first.

    ``needs`` is ``(label, name, taxon_id, needed)``. A photo found in both
    boxes counts for the inner one. Output adds ``tier`` (1 inner, 2 outer).
    Photos and observations are joined once; both boxes are one aggregation.
    """
    needs, _ = small_table(needs.select("label", "name", "taxon_id", "needed"))
    group = ("label", "needed")
    wanted = join_small(observations, needs.select("taxon_id"), ["taxon_id"], "left_semi")
    pool = join_small(eligible_photos(photos, wanted, outer, 0), needs, ["taxon_id"])
    inside = in_box(F.col("latitude"), F.col("longitude"), inner) & F.col("name").isin(*priority)
    placed = pool.withColumns({"_lat": F.round("latitude", 2), "_lon": F.round("longitude", 2)})
    photo = F.struct("photo_id", "extension")
    bursts = placed.groupBy(*group, *BURST).agg(
        F.min_by(photo, F.when(inside, F.col("photo_id"))).alias("_near"), F.min_by(photo, "photo_id").alias("_far")
    )
    tiers = F.array(*[F.struct(F.lit(i).alias("tier"), F.col(c).alias("p")) for i, c in ((1, "_near"), (2, "_far"))])
    both = (
        bursts.select(*group, F.explode(tiers).alias("t"))
        .filter("t.p IS NOT NULL")
        .groupBy(*group, F.col("t.p.photo_id").alias("photo_id"))
        .agg(F.min("t.tier").alias("tier"), F.first("t.p.extension").alias("extension"))
    )
    order = [F.col("tier"), shuffle_key(F.col("photo_id"), seed), F.col("photo_id")]
    return top_n(both, ["label"], order, _largest(needs), "needed").select(
        "label", "photo_id", "extension", "tier"
    )


# -- A15, A16, A19: labels -----------------------------------------------------


def dense_label_map(labels: DataFrame, label: str = "label") -> DataFrame:
    """Distinct labels in ascending order numbered from 0."""
    names, fits = small_table(labels.select(label).distinct())
    if fits:
        one = W.partitionBy(F.lit(0)).orderBy(label)
        return names.withColumn("idx", F.row_number().over(one) - 1)
    return range_rank(names, [], [F.col(label)], "idx").withColumn("idx", (F.col("idx") - 1).cast("int"))


def label_metadata(labels: DataFrame, taxa: DataFrame, names: DataFrame) -> DataFrame:
    """Slug, family and common names of ``(taxon_id, name)`` labels."""
    family = ancestor_of_rank(taxa, labels)
    return (
        labels.select("taxon_id", F.col("name").alias("scientific_name"))
        .join(family, "taxon_id", "left")
        .join(names.select("scientific_name", "english_name", "french_name"), "scientific_name", "left")
        .select(
            slug(F.col("scientific_name")).alias("label"),
            "scientific_name",
            F.coalesce("family", F.lit("Unknown")).alias("family"),
            "english_name",
            "french_name",
        )
    )


def metadata_completeness(meta: DataFrame) -> DataFrame:
    """One row: labels, and labels with both common names filled."""
    filled = (F.length("english_name") > 0) & (F.length("french_name") > 0)
    return meta.agg(F.count(F.lit(1)).alias("labels"), F.count_if(filled).alias("filled"))


def filter_labels(df: DataFrame, names: Sequence[str], column: str = "name") -> DataFrame:
    """Rows whose name (or slug) is listed, ignoring case and underscores."""
    wanted = sorted({n.lower().replace(" ", "_") for n in names})
    return df.filter(slug(F.col(column)).isin(*wanted))


# -- A17, A18: manifests -------------------------------------------------------


def build_manifest(
    needs: DataFrame, picks: DataFrame, tiers: tuple[str, str] = ("europe", "worldwide")
) -> DataFrame:
    """One row per label; its photo list is bounded by the label's need."""
    photo = F.struct("source", "photo_id", "extension")
    per_label = picks.groupBy("label").agg(
        F.count_if(F.col("source") == tiers[0]).alias("found_primary"),
        F.count_if(F.col("source") == tiers[1]).alias("found_fallback"),
        F.array_sort(F.collect_list(photo)).alias("photos"),
    )
    none = F.array().cast("array<struct<source:string,photo_id:bigint,extension:string>>")
    return needs.join(per_label, "label", "left").select(
        *needs.columns,
        F.coalesce("found_primary", F.lit(0)).alias("found_primary"),
        F.coalesce("found_fallback", F.lit(0)).alias("found_fallback"),
        F.coalesce("photos", none).alias("photos"),
    )


def manifest_summary(manifest: DataFrame) -> DataFrame:
    """One row of totals over the manifest."""
    return manifest.agg(
        F.count(F.lit(1)).alias("labels"),
        F.coalesce(F.sum(F.size("photos")), F.lit(0)).alias("photos"),
        F.coalesce(F.sum("found_primary"), F.lit(0)).alias("primary"),
        F.coalesce(F.sum("found_fallback"), F.lit(0)).alias("fallback"),
        F.count_if(F.size("photos") >= F.col("needed")).alias("satisfied"),
    )


def insufficient_labels(manifest: DataFrame) -> DataFrame:
    """Labels that stay below their need, the emptiest first."""
    found = F.size("photos").cast("bigint")
    return (
        manifest.filter(found < F.col("needed"))
        .select("label", "existing", "needed", found.alias("found"))
        .orderBy("found", "label")
    )


def pending_transfers(manifest: DataFrame, existing_files: DataFrame) -> DataFrame:
    """Source key and destination of the manifest photos not yet on disk.

    ``existing_files`` is ``(label, name)``; the destination suffix is lower-cased.
    """
    photos = manifest.select("label", F.explode("photos").alias("_p")).select("label", "_p.*")
    named = photos.withColumns(
        {
            "source_key": F.concat(F.lit("photos/"), F.col("photo_id").cast("string"),
                                   F.lit("/medium."), F.col("extension")),
            "name": F.concat(F.col("photo_id").cast("string"), F.lit("."), F.lower("extension")),
        }
    )
    wanted = cut(named)
    present = join_small(
        existing_files.select("label", "name"), wanted.select("label", "name"), ["label", "name"], "left_semi"
    )
    return wanted.join(present, ["label", "name"], "left_anti").select(
        "label", "photo_id", "source_key", F.concat_ws("/", "label", "name").alias("destination")
    )
