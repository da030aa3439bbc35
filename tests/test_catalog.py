"""Catalogue sourcing on hand-made tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from corpusmill.functions.text import display_name, has_extension, label_from_file_name, slug, stem
from corpusmill.operators import catalog as O
from corpusmill.sources.catalog import SCHEMAS

DAY = datetime.date(2024, 5, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def world(spark, spots):
    """One observation and photo per (photo_id, taxon, position, lat, observer)."""
    obs = [(f"o{p}", t, lat, 0.0, "research", who, DAY) for p, t, _, lat, who in spots]
    pho = [(p, f"o{p}", "JPG", pos, 500, 500) for p, _, pos, _, _ in spots]
    return spark.createDataFrame(pho, SCHEMAS["photos"]), spark.createDataFrame(obs, SCHEMAS["observations"])


def needs(spark, data):
    return spark.createDataFrame(data, "label string, name string, taxon_id bigint, needed bigint")


def none_existing(spark):
    return spark.createDataFrame([], "label string, name string")


def test_names(spark):
    df = spark.createDataFrame([("Parus major", "great_tit__12.JPG", "x.tar.gz")], "a string, b string, c string")
    got = df.select(slug(F.col("a")), display_name(slug(F.col("a"))), label_from_file_name(F.col("b")), label_from_file_name(F.col("c")),
                    stem(F.col("c")), has_extension(F.col("b"), ["jpg"]), has_extension(F.lit("jpg"), ["jpg"])).first()
    assert tuple(got) == ("parus_major", "Parus Major", "Great tit", "", "x.tar", True, False)


def test_clade_and_threshold(spark):
    taxa = spark.createDataFrame(
        [(10, "A", "species", "1/3/7", True), (11, "B", "species", "1/3", True), (12, "C", "species", "3/7", True), (13, "D", "genus", "1/3", True)],
        SCHEMAS["taxa"],
    )
    _, obs = world(spark, [(i, 10 + i % 4, 0, 35.0 if i < 12 else 34.9, i) for i in range(16)])
    assert rows(O.eligible_labels(obs, taxa, min_obs=3)) == [(10, "A", 3), (11, "B", 3)]
    assert O.eligible_labels(obs, taxa, min_obs=4).count() == 0


def test_burst_keeps_one_photo(spark):
    photos, obs = world(spark, [(1, 7, 0, 40.001, 5), (2, 7, 0, 40.004, 5), (3, 7, 0, 40.02, 5), (4, 7, 0, 40.001, 6), (5, 7, 0, None, 6), (6, 7, 0, None, 6)])
    cand = O.eligible_photos(photos, obs)
    assert [r["photo_id"] for r in O.dedupe_bursts(cand).orderBy("photo_id").collect()] == [1, 3, 4, 5]
    assert O.count_available(cand).first()["available"] == 4


def test_inactive_homonym_and_family(spark):
    taxa = spark.createDataFrame(
        [(1, "Fam", "family", "9", True), (5, "X", "species", "9/1", False), (6, "X", "species", "9/1", True), (7, "Y", "species", None, False)],
        SCHEMAS["taxa"],
    )
    names = spark.createDataFrame([("X",), ("Y",), ("Z",)], "name string")
    assert rows(O.resolve_taxa(names, taxa)) == [("X", 6), ("Y", 7)]
    assert rows(O.ancestor_of_rank(taxa)) == [(1, "Unknown"), (5, "Fam"), (6, "Fam"), (7, "Unknown")]


def test_exclusion_counts_integer_stems_of_the_label(spark):
    cand = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1)], "label string, photo_id bigint")
    held = spark.createDataFrame([("a", "1.JPG"), ("a", "img_2.jpg"), ("a", "3.txt")], "label string, name string")
    assert rows(O.exclude_existing(cand, held)) == [("a", 2), ("a", 3), ("b", 1)]
    assert rows(O.count_items(held)) == [("a", 2)]


def test_needs(spark):
    meta = spark.createDataFrame([("a", 1), ("b", 2), ("c", None), ("d", 4)], "label string, taxon_id bigint")
    counts = spark.createDataFrame([("a", 100), ("b", 98)], "label string, existing bigint")
    got = O.label_needs(meta, counts, 100, 10).select("label", "existing", "needed")
    assert rows(got) == [("b", 98, 10), ("d", 0, 100)]


def test_second_tier_fills_the_rest(spark):
    inside = [(i, 7, 0, 40.0, i) for i in range(3)]
    outside = [(100 + i, 7, 0, 10.0, 100 + i) for i in range(60)]
    photos, obs = world(spark, inside + outside)
    got = O.fill_tiers(photos, obs, needs(spark, [("a", "A", 7, 10)]), none_existing(spark))
    assert {r["source"]: r["count"] for r in got.groupBy("source").count().collect()} == {"europe": 3, "worldwide": 7}
    assert got.filter("source = 'europe'").agg(F.max("photo_id")).first()[0] == 2


@pytest.mark.parametrize("available,relaxed", [(49, True), (50, False)])
def test_auto_relax_below_fifty(spark, available, relaxed):
    first = [(i, 7, 0, 10.0, i) for i in range(available)]
    later = [(1000 + i, 7, 2, 10.0, 1000 + i) for i in range(30)]
    photos, obs = world(spark, first + later)
    got = O.fill_tiers(photos, obs, needs(spark, [("a", "A", 7, 200)]), none_existing(spark))
    assert got.count() == available + (30 if relaxed else 0)


def test_priority_prefers_the_inner_box(spark):
    photos, obs = world(spark, [(1, 7, 0, 45.0, 1), (2, 7, 0, 60.0, 2), (3, 7, 0, 61.0, 3), (4, 8, 0, 45.0, 4), (5, 8, 0, 60.0, 5)])
    want = needs(spark, [("a", "Parus major", 7, 2), ("b", "Other", 8, 2)])
    got = O.fill_priority(photos, obs, want)
    a = rows(got.filter("label = 'a'").select("photo_id", "tier"))
    assert a[0] == (1, 1) and len(a) == 2 and a[1][1] == 2
    assert rows(got.filter("label = 'b'").select("photo_id", "tier")) == [(4, 2), (5, 2)]


def test_manifest_and_transfers(spark):
    want = needs(spark, [("a", "A", 7, 2), ("b", "B", 8, 3)]).select("label", F.lit(1).alias("existing"), "needed")
    picks = spark.createDataFrame([("a", 5, "JPG", "europe"), ("a", 6, "jpg", "worldwide")], "label string, photo_id bigint, extension string, source string")
    manifest = O.build_manifest(want, picks)
    assert tuple(O.manifest_summary(manifest).first()) == (2, 2, 1, 1, 1)
    assert rows(O.insufficient_labels(manifest)) == [("b", 1, 3, 0)]
    disk = spark.createDataFrame([("a", "5.jpg")], "label string, name string")
    assert rows(O.pending_transfers(manifest, disk)) == [("a", 6, "photos/6/medium.jpg", "a/6.jpg")]
