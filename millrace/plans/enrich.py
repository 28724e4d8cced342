"""The two derived tables between raw tables and marts: counties of plants, and scored candidate pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import geo as G
from millrace.operators import linkage as L
from millrace.plans import models as M

COUNTRIES = ("United States", "Canada")


# ---------------------------------------------------------------- counties


def plant_sites(plants: DataFrame, countries: tuple[str, ...] = COUNTRIES) -> DataFrame:
    """One row per plant of the raw table, whose rows are production units."""
    alike = ("plant_name_english", "municipality", "country_area", "latitude", "longitude", "coordinate_accuracy")
    kept = plants.where(F.col("country_area").isin(*countries))
    return kept.groupBy("plant_id").agg(*(M.any_of(c) for c in alike), F.min("subnational_unit_province_state").alias("state_name"), F.bool_or("has_coordinates").alias("has_coordinates"))


def county_plants(plantgen: DataFrame) -> DataFrame:
    """Plants in each county of the census; those without a county are one row with a null code."""
    return plantgen.groupBy(F.col("st_cnty_fips").alias("county_fips")).agg(F.count("*").alias("plantgen_plants"))


def with_known_county(sites: DataFrame, plantgen: DataFrame) -> DataFrame:
    """Flag ``in_plantgen_county``; false without a county."""
    known = county_plants(plantgen).where("county_fips is not null").select("county_fips", F.lit(True).alias("in_plantgen_county"))
    return sites.join(known, "county_fips", "left").withColumn("in_plantgen_county", F.coalesce("in_plantgen_county", F.lit(False)))


def plant_county(plants: DataFrame, polygons: DataFrame, plantgen: DataFrame) -> DataFrame:
    """Every plant with its county, or the nearest one and the metres to it, a status, and whether the census has plants there."""
    state = F.min("state") if "state" in polygons.columns else F.lit(None).cast("string")
    names = polygons.groupBy(F.col("geo_id").alias("county_fips")).agg(F.min("name").alias("county_name"), state.alias("county_state"))
    placed = G.assign_polygons(plant_sites(plants), polygons, "plant_id", "latitude", "longitude")
    renamed = {"geo_id": "county_fips", "nearest_geo_id": "nearest_county_fips", "nearest_distance_m": "nearest_county_distance_m"}
    named = placed.withColumnsRenamed(renamed).join(names, "county_fips", "left")
    return with_known_county(named, plantgen).select(
        "plant_id", "plant_name_english", "municipality", "state_name", "country_area", "latitude", "longitude", "coordinate_accuracy", "has_coordinates", "county_fips", "county_name", "county_state",
        "nearest_county_fips", "nearest_county_distance_m", "county_assignment_status", "in_plantgen_county",
    )


def geo_coverage(enriched: DataFrame, plantgen: DataFrame) -> DataFrame:
    """One row of counts: how far coordinates lead to a county, and what blocking by county can tell apart at best."""
    has, county, known = F.coalesce("has_coordinates", F.lit(False)), F.col("county_fips").isNotNull(), F.col("in_plantgen_county")
    reach = enriched.agg(
        F.count("*").alias("plants_total"), F.count_if(has).alias("plants_with_coordinates"), F.count_if(~has).alias("plants_without_coordinates"), F.count_if(county).alias("county_assigned"),
        F.count_if(has & ~county).alias("county_unassigned"), F.count_if(known).alias("matched_plantgen_county"), F.count_if(county & ~known).alias("unmatched_plantgen_county"),
    )
    n = F.col("plantgen_plants")
    total = lambda test: F.coalesce(F.sum(F.when(test, n)), F.lit(0)).cast("bigint")
    ceiling = county_plants(plantgen).agg(
        F.count("*").alias("plantgen_counties_total"), F.count_if(n == 1).alias("plantgen_counties_with_one_plant"), F.count_if(n > 1).alias("plantgen_counties_with_many_plants"),
        total(n > 1).alias("plantgen_plants_in_shared_counties"), total(n == 1).alias("plantgen_plants_alone_in_county"),
    )
    return reach.crossJoin(ceiling)  # one row each


def coverage_by_accuracy(enriched: DataFrame) -> DataFrame:
    county = F.col("county_fips").isNotNull()
    return enriched.groupBy("coordinate_accuracy").agg(F.count("*").alias("plants"), F.count_if(county).alias("assigned"), F.count_if("in_plantgen_county").alias("matched"))


def unassigned_by_country(enriched: DataFrame) -> DataFrame:
    """Plants whose coordinates lie in no county."""
    return enriched.where(F.col("has_coordinates") & F.col("county_fips").isNull()).groupBy("country_area").agg(F.count("*").alias("plants"))


def without_coordinates(enriched: DataFrame) -> DataFrame:
    return enriched.where(~F.coalesce("has_coordinates", F.lit(False))).select("plant_id")


# ---------------------------------------------------------------- candidates


def candidates(units: DataFrame, counties: DataFrame, plantgen: DataFrame, max_random: int = 1_000_000, seed: int = 17) -> DataFrame:
    """Scored pairs of staged plants and census plants, with the weights estimated from the same pairs."""
    left, right = M.unique_or_raise(M.gspt_frame(units, counties), "unique_id"), M.unique_or_raise(M.plantgen_frame(plantgen), "unique_id")
    comparisons = L.plant_comparisons()
    gammas = [c.gamma() for c in comparisons]
    pairs = L.block_pairs(left, right).select("*", *gammas)
    weights = L.estimate(pairs, L.random_pairs(left, right, max_random, seed).select(*gammas), comparisons, left.count(), right.count())
    scored = L.score(pairs, comparisons, weights, {"zip5": L.term_frequencies(left, right, "zip5")})
    return scored.select("unique_id_l", "unique_id_r", "match_probability", "match_weight", *(f"gamma_{c.name}" for c in comparisons))
