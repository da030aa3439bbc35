"""Catalogue queries.

Roles: region, nation and supplier form the taxonomy (class, family, species),
orders are observations, lineitem rows are photos, and the returned line items
are photos the corpus holds already.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.constants import EUROPE_BOX
from corpusmill.functions.text import slug
from corpusmill.operators import catalog as O
from corpusmill.workloads.tables import table

TARGET = 210
MIN_DOWNLOAD = 20
PRIORITY = tuple(f"Supplier {i:09d}" for i in range(0, 100, 3))


def taxa(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region").selectExpr(
        "CAST(r_regionkey + 1 AS BIGINT) AS taxon_id", "r_name AS name", "'class' AS rank",
        "'900' AS ancestry", "true AS active",
    )
    nations = table(spark, sf_dir, "nation").selectExpr(
        "CAST(100 + n_nationkey AS BIGINT) AS taxon_id", "n_name AS name", "'family' AS rank",
        "concat('900/', n_regionkey + 1) AS ancestry", "true AS active",
    )
    species = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "1000 + s_suppkey AS taxon_id", "replace(s_name, '#', ' ') AS name", "'species' AS rank",
            "concat('900/', n_regionkey + 1, '/', 100 + n_nationkey) AS ancestry",
            "s_acctbal > 0 AS active",
        )
    )
    return regions.unionByName(nations).unionByName(species)


def observations(spark, sf_dir):
    cents = "CAST(round(o_totalprice * 100) AS BIGINT)"
    return table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS observation_uuid",
        "1000 + o_custkey % 100 AS taxon_id",
        "o_custkey AS observer_id",
        "CAST(o_orderdate AS DATE) AS observed_on",
        f"30 + {cents} % 45 + ({cents} % 4) / 1000.0D AS latitude",
        f"-30 + ({cents} div 45) % 80 + ({cents} % 3) / 1000.0D AS longitude",
        "CASE WHEN o_orderstatus = 'P' THEN 'needs_id' ELSE 'research' END AS quality_grade",
    )


PHOTO_ID = "((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey"


def photos(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"{PHOTO_ID} AS photo_id",
        "CAST(l_orderkey AS STRING) AS observation_uuid",
        "CASE WHEN l_linestatus = 'O' THEN 'jpg' ELSE 'JPG' END AS extension",
        "l_linenumber - 1 AS position",
        "200 + CAST(l_quantity AS BIGINT) * 20 AS width",
        "300 + CAST(floor(l_extendedprice) AS BIGINT) % 900 AS height",
    )


def existing(spark, sf_dir):
    """Items the corpus holds: integer and other stems, four extensions."""
    return (
        table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .selectExpr(
            "concat('supplier_', lpad(CAST(o_custkey % 100 AS STRING), 9, '0')) AS label",
            f"""CASE WHEN l_tax < 0.01 THEN concat({PHOTO_ID}, '.tiff')
                     WHEN l_tax < 0.03 THEN concat('img_', {PHOTO_ID}, '.webp')
                     WHEN l_tax < 0.05 THEN concat({PHOTO_ID}, '.JPG')
                     ELSE concat({PHOTO_ID}, '.png') END AS name""",
        )
    )


def labels(spark, sf_dir):
    return taxa(spark, sf_dir).filter("rank = 'species'").select("taxon_id", "name")


def common_names(spark, sf_dir):
    return table(spark, sf_dir, "supplier").selectExpr(
        "replace(s_name, '#', ' ') AS scientific_name",
        "CASE WHEN s_suppkey % 3 > 0 THEN concat('en ', s_suppkey) END AS english_name",
        "CASE WHEN s_suppkey % 4 > 0 THEN concat('fr ', s_suppkey) END AS french_name",
    )


def needs(spark, sf_dir):
    meta = labels(spark, sf_dir).withColumn("label", slug(F.col("name")))
    counts = O.count_items(existing(spark, sf_dir))
    return O.label_needs(meta, counts, TARGET, MIN_DOWNLOAD)


def eligible_labels(spark, sf_dir):
    return O.eligible_labels(observations(spark, sf_dir), taxa(spark, sf_dir))


def _candidates(spark, sf_dir, max_position=1):
    return O.eligible_photos(photos(spark, sf_dir), observations(spark, sf_dir), EUROPE_BOX, max_position)


def _labelled(df):
    name = F.lpad((F.col("taxon_id") - 1000).cast("string"), 9, "0")
    return df.withColumn("label", F.concat(F.lit("supplier_"), name))


def eligible_photos(spark, sf_dir):
    return _candidates(spark, sf_dir).select(
        "photo_id", "taxon_id", "extension", "position", "observer_id", "observed_on", "latitude", "longitude"
    )


def burst_dedupe(spark, sf_dir):
    return O.dedupe_bursts(_candidates(spark, sf_dir)).select(
        "taxon_id", "observer_id", "observed_on", "photo_id", "extension"
    )


def sampled_photos(spark, sf_dir):
    return O.sample_per_label(O.dedupe_bursts(_candidates(spark, sf_dir)), 15).select("taxon_id", "photo_id")


def excluded_candidates(spark, sf_dir):
    return O.exclude_existing(_labelled(_candidates(spark, sf_dir)), existing(spark, sf_dir)).select(
        "label", "photo_id"
    )


def available_counts(spark, sf_dir):
    kept = O.exclude_existing(_labelled(_candidates(spark, sf_dir)), existing(spark, sf_dir))
    return O.count_available(kept, ("label",))


def existing_counts(spark, sf_dir):
    return O.count_items(existing(spark, sf_dir))


def label_needs(spark, sf_dir):
    return needs(spark, sf_dir).select("label", "existing", "needed")


def tier_fill(spark, sf_dir):
    return O.fill_tiers(
        photos(spark, sf_dir), observations(spark, sf_dir), needs(spark, sf_dir), existing(spark, sf_dir)
    )


def priority_fill(spark, sf_dir):
    return O.fill_priority(photos(spark, sf_dir), observations(spark, sf_dir), needs(spark, sf_dir), PRIORITY)


def resolved_taxa(spark, sf_dir):
    """Every species name twice: once per taxon and once as a later homonym."""
    base = taxa(spark, sf_dir)
    homonyms = base.filter("rank = 'species'").selectExpr(
        "taxon_id + 500000 AS taxon_id", "name", "rank", "ancestry", "taxon_id % 2 = 0 AS active"
    )
    return O.resolve_taxa(labels(spark, sf_dir).select("name"), base.unionByName(homonyms))


def label_families(spark, sf_dir):
    return O.ancestor_of_rank(taxa(spark, sf_dir))


def label_slugs(spark, sf_dir):
    return labels(spark, sf_dir).select("name", slug(F.col("name")).alias("label"))


def label_map(spark, sf_dir):
    return O.dense_label_map(labels(spark, sf_dir).select(slug(F.col("name")).alias("label")))


def _metadata(spark, sf_dir):
    return O.label_metadata(labels(spark, sf_dir), taxa(spark, sf_dir), common_names(spark, sf_dir))


def label_metadata(spark, sf_dir):
    return _metadata(spark, sf_dir)


def metadata_completeness(spark, sf_dir):
    return O.metadata_completeness(_metadata(spark, sf_dir))


def _manifest(spark, sf_dir):
    return O.build_manifest(needs(spark, sf_dir), tier_fill(spark, sf_dir))


def manifest_summary(spark, sf_dir):
    return O.manifest_summary(_manifest(spark, sf_dir))


def insufficient_labels(spark, sf_dir):
    return O.insufficient_labels(_manifest(spark, sf_dir))


def pending_transfers(spark, sf_dir):
    """Photos with an even part key count as transferred already."""
    done = _labelled(
        photos(spark, sf_dir).join(observations(spark, sf_dir), "observation_uuid")
    ).select(
        "label",
        F.when(F.col("photo_id") % 20000 < 10000, F.concat(F.col("photo_id").cast("string"), F.lit("."), F.lower("extension")))
        .otherwise(F.lit("none")).alias("name"),
    )
    return O.pending_transfers(_manifest(spark, sf_dir), done).select("label", "source_key", "destination")


def filtered_labels(spark, sf_dir):
    return O.filter_labels(labels(spark, sf_dir), ["SUPPLIER 000000001", "supplier_000000007", "none"])


QUERIES = {
    f.__name__: f
    for f in (
        eligible_labels, eligible_photos, burst_dedupe, sampled_photos, excluded_candidates,
        available_counts, existing_counts, label_needs, tier_fill, priority_fill, resolved_taxa,
        label_families, label_slugs, label_map, label_metadata, metadata_completeness,
        manifest_summary, insufficient_labels, pending_transfers, filtered_labels,
    )
}

TAXA_SQL = """
species AS (SELECT 1000 + s_suppkey AS taxon_id, replace(s_name, '#', ' ') AS name, n_nationkey, n_name, n_regionkey,
                   lower(replace(s_name, '#', '_')) AS label, s_acctbal > 0 AS active, s_suppkey
            FROM supplier JOIN nation ON s_nationkey = n_nationkey)
"""

OBS_SQL = """
obs AS (SELECT o_orderkey, 1000 + o_custkey % 100 AS taxon_id, o_custkey AS observer_id,
               CAST(o_orderdate AS DATE) AS observed_on,
               30 + CAST(round(o_totalprice * 100) AS BIGINT) % 45 + (CAST(round(o_totalprice * 100) AS BIGINT) % 4) / 1000.0::DOUBLE AS latitude,
               -30 + (CAST(round(o_totalprice * 100) AS BIGINT) // 45) % 80 + (CAST(round(o_totalprice * 100) AS BIGINT) % 3) / 1000.0::DOUBLE AS longitude
        FROM orders WHERE o_orderstatus <> 'P'),
pho AS (SELECT ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS photo_id, l_orderkey,
               CASE WHEN l_linestatus = 'O' THEN 'jpg' ELSE 'JPG' END AS extension, l_linenumber - 1 AS position
        FROM lineitem
        WHERE 200 + CAST(l_quantity AS BIGINT) * 20 >= 400
          AND 300 + CAST(floor(l_extendedprice) AS BIGINT) % 900 >= 400),
cand AS (SELECT photo_id, taxon_id, extension, position, observer_id, observed_on, latitude, longitude,
                'supplier_' || lpad(CAST(taxon_id - 1000 AS VARCHAR), 9, '0') AS label
         FROM pho JOIN obs ON l_orderkey = o_orderkey),
euro AS (SELECT * FROM cand WHERE position <= 1 AND latitude BETWEEN 35 AND 72 AND longitude BETWEEN -25 AND 45)
"""

EXISTING_SQL = """
have AS (SELECT 'supplier_' || lpad(CAST(o_custkey % 100 AS VARCHAR), 9, '0') AS label,
                ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS photo_id, l_tax
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'),
held AS (SELECT DISTINCT label, photo_id FROM have WHERE l_tax >= 0.03),
counts AS (SELECT label, count(*) AS existing FROM have WHERE l_tax >= 0.01 GROUP BY label)
"""

NEEDS_SQL = f"""
needs AS (SELECT label, name, taxon_id, coalesce(existing, 0) AS existing,
                 greatest({TARGET} - coalesce(existing, 0), {MIN_DOWNLOAD}) AS needed
          FROM species LEFT JOIN counts USING (label) WHERE coalesce(existing, 0) < {TARGET})
"""

FILL_SQL = """
base AS (SELECT c.*, n.needed FROM cand c JOIN needs n USING (label, taxon_id)
         WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.label = c.label AND h.photo_id = c.photo_id)),
b1 AS (SELECT label, needed, min(photo_id) AS photo_id, arg_min(extension, photo_id) AS extension
       FROM base WHERE position <= 0 AND latitude BETWEEN 35 AND 72 AND longitude BETWEEN -25 AND 45
       GROUP BY label, needed, observer_id, observed_on, round(latitude, 2), round(longitude, 2)),
first_tier AS (SELECT * FROM b1 QUALIFY row_number() OVER (PARTITION BY label ORDER BY md5(photo_id || ':42'), photo_id) <= needed),
gap AS (SELECT n.label, n.needed - count(f.photo_id) AS missing
        FROM needs n LEFT JOIN first_tier f USING (label) GROUP BY n.label, n.needed),
rest AS (SELECT b.*, g.missing FROM base b JOIN gap g USING (label)
         WHERE g.missing > 0 AND NOT EXISTS (SELECT 1 FROM first_tier f WHERE f.label = b.label AND f.photo_id = b.photo_id)),
avail AS (SELECT label, count(DISTINCT (observer_id, observed_on, round(latitude, 2), round(longitude, 2))) AS n
          FROM rest WHERE position <= 0 GROUP BY label),
b2 AS (SELECT r.label, r.missing, min(photo_id) AS photo_id, arg_min(extension, photo_id) AS extension
       FROM rest r LEFT JOIN avail a USING (label)
       WHERE position <= CASE WHEN coalesce(a.n, 0) < 50 THEN 2 ELSE 0 END
       GROUP BY r.label, r.missing, observer_id, observed_on, round(latitude, 2), round(longitude, 2)),
second_tier AS (SELECT * FROM b2 QUALIFY row_number() OVER (PARTITION BY label ORDER BY md5(photo_id || ':42'), photo_id) <= missing),
filled AS (SELECT label, photo_id, extension, 'europe' AS source FROM first_tier
           UNION ALL SELECT label, photo_id, extension, 'worldwide' FROM second_tier),
man AS (SELECT n.label, n.existing, n.needed, count(f.photo_id) AS found,
               count(*) FILTER (WHERE f.source = 'europe') AS p, count(*) FILTER (WHERE f.source = 'worldwide') AS w
        FROM needs n LEFT JOIN filled f USING (label) GROUP BY ALL)
"""

_ALL = f"{TAXA_SQL}, {OBS_SQL}, {EXISTING_SQL}, {NEEDS_SQL}"
_PRIORITY_SQL = ", ".join(f"'{p}'" for p in PRIORITY)

ORACLES = {
    "eligible_labels": f"""WITH {TAXA_SQL}, {OBS_SQL}
      SELECT s.taxon_id, s.name, count(*) AS obs_count FROM obs JOIN species s USING (taxon_id)
      WHERE n_regionkey = 2 AND latitude BETWEEN 35 AND 72 AND longitude BETWEEN -25 AND 45
      GROUP BY ALL HAVING count(*) >= 50""",
    "eligible_photos": f"""WITH {OBS_SQL}
      SELECT photo_id, taxon_id, extension, position, observer_id, observed_on, latitude, longitude FROM euro""",
    "burst_dedupe": f"""WITH {OBS_SQL}
      SELECT taxon_id, observer_id, observed_on, min(photo_id) AS photo_id, arg_min(extension, photo_id) AS extension
      FROM euro GROUP BY taxon_id, observer_id, observed_on, round(latitude, 2), round(longitude, 2)""",
    "sampled_photos": f"""WITH {OBS_SQL},
      d AS (SELECT taxon_id, min(photo_id) AS photo_id FROM euro
            GROUP BY taxon_id, observer_id, observed_on, round(latitude, 2), round(longitude, 2))
      SELECT taxon_id, photo_id FROM d
      QUALIFY row_number() OVER (PARTITION BY taxon_id ORDER BY md5(photo_id || ':42'), photo_id) <= 15""",
    "excluded_candidates": f"""WITH {OBS_SQL}, {EXISTING_SQL}
      SELECT label, photo_id FROM euro ANTI JOIN held USING (label, photo_id)""",
    "available_counts": f"""WITH {OBS_SQL}, {EXISTING_SQL},
      k AS (SELECT * FROM euro ANTI JOIN held USING (label, photo_id))
      SELECT label, count(DISTINCT (observer_id, observed_on, round(latitude, 2), round(longitude, 2))) AS available
      FROM k GROUP BY label""",
    "existing_counts": f"WITH {EXISTING_SQL} SELECT label, existing FROM counts",
    "label_needs": f"WITH {_ALL} SELECT label, existing, needed FROM needs",
    "tier_fill": f"WITH {_ALL}, {FILL_SQL} SELECT label, photo_id, extension, source FROM filled",
    "priority_fill": f"""WITH {_ALL},
      pool AS (SELECT c.*, n.name, n.needed FROM cand c JOIN needs n USING (label, taxon_id)
               WHERE position = 0 AND latitude BETWEEN 35 AND 72 AND longitude BETWEEN -25 AND 45),
      near AS (SELECT label, needed, min(photo_id) AS photo_id, arg_min(extension, photo_id) AS extension, 1 AS tier
               FROM pool WHERE name IN ({_PRIORITY_SQL})
                 AND latitude BETWEEN 41.3 AND 51.1 AND longitude BETWEEN -5.1 AND 9.6
               GROUP BY label, needed, observer_id, observed_on, round(latitude, 2), round(longitude, 2)),
      far AS (SELECT label, needed, min(photo_id) AS photo_id, arg_min(extension, photo_id) AS extension, 2 AS tier
              FROM pool GROUP BY label, needed, observer_id, observed_on, round(latitude, 2), round(longitude, 2)),
      both_tiers AS (SELECT label, needed, photo_id, min(extension) AS extension, min(tier) AS tier
               FROM (SELECT * FROM near UNION ALL SELECT * FROM far) GROUP BY label, needed, photo_id)
      SELECT label, photo_id, extension, tier FROM both_tiers
      QUALIFY row_number() OVER (PARTITION BY label ORDER BY tier, md5(photo_id || ':42'), photo_id) <= needed""",
    "resolved_taxa": f"""WITH {TAXA_SQL}
      SELECT name, CASE WHEN active OR taxon_id % 2 = 1 THEN taxon_id ELSE taxon_id + 500000 END AS taxon_id
      FROM species""",
    "label_families": f"""WITH {TAXA_SQL}
      SELECT taxon_id, n_name AS family FROM species
      UNION ALL SELECT CAST(r_regionkey + 1 AS BIGINT), 'Unknown' FROM region
      UNION ALL SELECT CAST(100 + n_nationkey AS BIGINT), 'Unknown' FROM nation""",
    "label_slugs": f"WITH {TAXA_SQL} SELECT name, label FROM species",
    "label_map": f"""WITH {TAXA_SQL}
      SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS idx FROM species""",
    "label_metadata": f"""WITH {TAXA_SQL}
      SELECT label, name AS scientific_name, n_name AS family,
             CASE WHEN s_suppkey % 3 > 0 THEN 'en ' || s_suppkey END AS english_name,
             CASE WHEN s_suppkey % 4 > 0 THEN 'fr ' || s_suppkey END AS french_name FROM species""",
    "metadata_completeness": """SELECT count(*) AS labels,
      count(*) FILTER (WHERE s_suppkey % 3 > 0 AND s_suppkey % 4 > 0) AS filled FROM supplier""",
    "manifest_summary": f"""WITH {_ALL}, {FILL_SQL}
      SELECT count(*) AS labels, CAST(sum(found) AS BIGINT) AS photos, CAST(sum(p) AS BIGINT) AS "primary",
             CAST(sum(w) AS BIGINT) AS fallback, count(*) FILTER (WHERE found >= needed) AS satisfied FROM man""",
    "insufficient_labels": f"""WITH {_ALL}, {FILL_SQL}
      SELECT label, existing, needed, found FROM man WHERE found < needed""",
    "pending_transfers": f"""WITH {_ALL}, {FILL_SQL},
      done AS (SELECT DISTINCT ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS photo_id
               FROM lineitem WHERE l_partkey % 2 = 0)
      SELECT label, 'photos/' || photo_id || '/medium.' || extension AS source_key,
             label || '/' || photo_id || '.' || lower(extension) AS destination
      FROM filled ANTI JOIN done USING (photo_id)""",
    "filtered_labels": f"""WITH {TAXA_SQL}
      SELECT taxon_id, name FROM species WHERE name IN ('Supplier 000000001', 'Supplier 000000007')""",
}
