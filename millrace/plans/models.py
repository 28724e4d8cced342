"""Staging views and marts as functions of frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import rows as R

CAPACITIES = ("crude_steel", "bof_steel", "eaf_steel", "iron")


def any_of(c: str) -> Column:
    """A value of the group: the least one, so that results don't depend on row order."""
    return F.min(c).alias(c)


def stg_plantgen(raw: DataFrame) -> DataFrame:
    start = F.col("plant_start_yr")
    status = F.when(start.isNull(), "absent").when(start == 9999, "unknown").otherwise("reported")
    return raw.select(
        "plant_id", "plant_name", "city", "county", "state", F.col("st_cnty_fips").alias("county_fips"), "zip_code", "street_address",
        T.plausible_year(start).alias("start_year"), status.alias("start_year_status"), T.plausible_year(F.col("shutdown_yr")).alias("shutdown_year"), "aisi_code", "specialty_grade", "source_file",
    )


def stg_gspt_plant_unit(raw: DataFrame, countries: tuple[str, ...] = ("United States", "Canada")) -> DataFrame:
    measured = {f"{c}_capacity": f"nominal_{c}_capacity_ttpa" for c in CAPACITIES}
    values = [x for name, c in measured.items() for x in (T.sentinel_value(F.col(c)).alias(f"{name}_ttpa"), T.sentinel_status(F.col(c)).alias(f"{name}_status"))]
    return raw.where(F.col("country_area").isin(*countries)).select(
        "plant_id", F.col("source_row").alias("unit_id"), F.col("plant_name_english").alias("plant_name"), F.col("other_plant_names_english").alias("other_plant_names"),
        "owner", "owner_permid", "owner_gem_id", "parent", F.col("municipality").alias("city"), F.col("subnational_unit_province_state").alias("state_name"), "country_area",
        "location_address", "coordinates", "coordinate_accuracy", "has_coordinates", "latitude", "longitude", "capacity_operating_status", "main_production_process", "main_production_equipment",
        "start_date", T.plausible_year(F.col("start_date")).alias("start_year"), T.sentinel_status(F.col("start_date")).alias("start_year_status"), T.plausible_year(F.col("retired_date")).alias("retired_year"),
        *values, T.sentinel_value(F.col("workforce_size")).alias("workforce_size"), T.sentinel_status(F.col("workforce_size")).alias("workforce_size_status"), "source_file",
    )


def stg_gspt_production(raw: DataFrame, units: DataFrame) -> DataFrame:
    kept = raw.join(units.select("plant_id").distinct(), "plant_id", "left_semi")
    return kept.select("plant_id", "year", "metric", "value_ttpa", T.sentinel_status(F.col("value_raw")).alias("value_status"), "value_raw", "source_file")


def stg_furnace_year(raw: DataFrame, version: str = "owner_filled_2025") -> DataFrame:
    kept = raw.where((F.col("source_version") == version) & (F.col("alignment_status") != "unaligned_no_key"))
    one = R.first_per_key(kept, ["furnace_type", "facility_id", "year", "fid"], [F.asc_nulls_last("source_row"), F.asc_nulls_last("owner")])
    return one.select(
        "furnace_key", "furnace_type", "facility_id", "fid", "year", F.col("owner").alias("owner_raw"), "owner_verbatim", T.normalize_owner(F.col("owner")).alias("owner_normalized"), "owner_has_replacement_char",
        F.col("corrected_cl_clean").alias("facility_aliases"), F.col("corrected_cl").alias("facility_aliases_as_written"), "encoding_degraded", "encoding_lossy", "main_product_line", "no_of_furnaces",
        "not_melting", "power_kwh_per_metric_ton", "year_list", "data_id", "source_version", "source_file",
    )


def stg_plant_county(raw: DataFrame) -> DataFrame:
    return raw.select("plant_id", "county_fips", "county_name", "county_state", "nearest_county_fips", "nearest_county_distance_m", "county_assignment_status", "in_plantgen_county", "coordinate_accuracy", "has_coordinates", "country_area")


def dim_plant(units: DataFrame, counties: DataFrame, plantgen: DataFrame) -> DataFrame:
    u = units.join(counties.select("plant_id", "county_fips", "county_name", "county_assignment_status"), "plant_id", "left")
    gspt = u.groupBy("plant_id").agg(
        *(any_of(c) for c in ("plant_name", "city", "state_name", "country_area")), F.min("location_address").alias("street_address"), F.lit(None).cast("string").alias("zip_code"),
        *(any_of(c) for c in ("county_fips", "county_name", "latitude", "longitude", "coordinate_accuracy")), F.bool_or("has_coordinates").alias("has_coordinates"), any_of("county_assignment_status"),
        F.min("start_year").alias("start_year"), F.max("retired_year").alias("retired_year"), F.count("*").alias("production_unit_count"),
    ).select(F.concat(F.lit("gspt:"), "plant_id").alias("plant_key"), F.lit("gspt").alias("source_system"), F.col("plant_id").alias("source_plant_id"), "*").drop("plant_id")
    none = lambda kind: F.lit(None).cast(kind)
    other = plantgen.select(
        F.concat(F.lit("plantgen:"), "plant_id").alias("plant_key"), F.lit("plantgen").alias("source_system"), F.col("plant_id").alias("source_plant_id"), "plant_name", "city", F.col("state").alias("state_name"),
        F.lit("United States").alias("country_area"), "street_address", "zip_code", "county_fips", F.col("county").alias("county_name"), none("double").alias("latitude"), none("double").alias("longitude"),
        none("string").alias("coordinate_accuracy"), F.lit(False).alias("has_coordinates"), F.lit("not_applicable").alias("county_assignment_status"), "start_year", F.col("shutdown_year").alias("retired_year"), F.lit(1).cast("bigint").alias("production_unit_count"),
    )
    return gspt.unionByName(other)


def dim_production_unit(units: DataFrame) -> DataFrame:
    plant = F.concat(F.lit("gspt:"), "plant_id")
    measures = [x for c in CAPACITIES for x in (f"{c}_capacity_ttpa", f"{c}_capacity_status")]
    return units.select(
        F.concat_ws(":", plant, F.col("unit_id").cast("string")).alias("production_unit_key"), plant.alias("plant_key"), "plant_id", "unit_id", "capacity_operating_status", "main_production_process",
        "main_production_equipment", "start_year", "start_year_status", "retired_year", *measures, "workforce_size", "workforce_size_status",
    )


def dim_owner(units: DataFrame) -> DataFrame:
    grouped = units.where("owner_permid is not null").groupBy("owner_permid").agg(any_of("owner_gem_id"), F.min("owner").alias("owner_name"), F.min("parent").alias("parent_name"), F.count_distinct("plant_id").alias("plant_count"))
    return grouped.select("owner_permid", "owner_gem_id", "owner_name", T.normalize_owner(F.col("owner_name")).alias("owner_name_normalized"), "parent_name", "plant_count")


def dim_furnace(furnaces: DataFrame) -> DataFrame:
    facility = F.concat_ws("-", "furnace_type", "facility_id")
    grouped = furnaces.groupBy("furnace_type", "facility_id", "fid").agg(
        F.min("year").alias("first_year_seen"), F.max("year").alias("last_year_seen"), F.count("*").alias("observed_years"), any_of("facility_aliases"),
        F.bool_or("encoding_degraded").alias("any_name_encoding_degraded"), F.bool_or("encoding_lossy").alias("any_name_encoding_lossy"),
    )
    return grouped.select(F.concat_ws("-", facility, F.coalesce("fid", F.lit("x"))).alias("furnace_key"), facility.alias("facility_key"), "*")


def fct_furnace_year(furnaces: DataFrame, dim: DataFrame) -> DataFrame:
    d = dim.select("furnace_key", "facility_key", "furnace_type", "facility_id", F.coalesce("fid", F.lit("x")).alias("__fid"))
    joined = furnaces.drop("furnace_key").withColumn("__fid", F.coalesce("fid", F.lit("x"))).join(d, ["furnace_type", "facility_id", "__fid"])
    return joined.select(
        "furnace_key", "facility_key", "furnace_type", "facility_id", "fid", "year", "owner_raw", "owner_normalized", "owner_has_replacement_char", "facility_aliases", "encoding_degraded", "encoding_lossy",
        "main_product_line", "no_of_furnaces", "not_melting", "power_kwh_per_metric_ton", "source_version",
    )


def fct_plant_production_year(production: DataFrame) -> DataFrame:
    return production.select(F.concat(F.lit("gspt:"), "plant_id").alias("plant_key"), "plant_id", "year", "metric", "value_ttpa", "value_status", "value_raw")


def dim_facility_ownership_scd2(facts: DataFrame) -> DataFrame:
    spans = R.islands(facts, "facility_key", "year", "owner_normalized", lowest=["owner_raw"], any_true=["owner_has_replacement_char"], same=["furnace_type", "facility_id"])
    return spans.select(
        F.concat(F.col("facility_key"), F.lit("-v"), F.col("version_number").cast("string")).alias("ownership_key"), "facility_key", "furnace_type", "facility_id", "version_number", "owner_normalized", "owner_raw",
        "valid_from_year", "valid_to_year", "last_observed_year", "is_current", F.col("owner_has_replacement_char").alias("has_encoding_damage"),
    )


def fct_ownership_change(spans: DataFrame) -> DataFrame:
    return R.ownership_changes(spans, "facility_key", "owner_normalized", "owner_raw", same=["furnace_type", "facility_id", "has_encoding_damage"]).drop("version_number")


def fct_ownership_noise(raw: DataFrame, facts: DataFrame, changes: DataFrame, version: str = "owner_filled_2025") -> DataFrame:
    kept = raw.where((F.col("source_version") == version) & (F.col("alignment_status") != "unaligned_no_key"))
    grain = kept.groupBy("furnace_type", "facility_id", "year", "fid").agg(F.count("*").alias("n"), F.count_distinct("owner_verbatim").alias("owners"))
    seen = facts.where("owner_normalized is not null").groupBy("facility_key", "year").agg(F.min("owner_raw").alias("raw"), F.min("owner_normalized").alias("norm"))
    by = Window.partitionBy("facility_key").orderBy("year")
    moved = lambda c: F.count_if(F.col(f"last_{c}").isNotNull() & ~F.col(c).eqNullSafe(F.col(f"last_{c}")))
    lagged = seen.withColumns({"last_raw": F.lag("raw").over(by), "last_norm": F.lag("norm").over(by)})
    row = lambda level, stage, n, text: (F.lit(level).alias("level"), F.lit(stage).alias("stage"), n.alias("noisy_units"), F.lit(text).alias("measures"))
    return (
        grain.agg(*row(0, "raw source, before dedup", F.count_if(F.expr("n > 1")), "furnace-years the source supplies more than once"))
        .union(grain.agg(*row(0, "raw source: repeats disagreeing on owner", F.count_if(F.expr("owners > 1")), "of those, the ones whose owner spelling differs before trimming")))
        .union(lagged.agg(*row(1, "after dedup", moved("raw"), "consecutive-year changes in the raw owner string")))
        .union(lagged.agg(*row(2, "after normalisation", moved("norm"), "consecutive-year changes in the normalised owner name")))
        .union(changes.agg(*row(3, "after classification", F.count_if(F.col("change_class") == "credible_transfer"), "transitions surviving typo, refinement, oscillation and gap filters")))
        .orderBy("level", "stage")
    )


def bridge_plant_xref(candidates: DataFrame, units: DataFrame) -> DataFrame:
    """A row per candidate pair and one per plant that was never compared; no verdict."""
    plants = units.groupBy("plant_id").agg(any_of("country_area"), F.bool_or("has_coordinates").alias("__has"), F.min("coordinate_accuracy").alias("__accuracy"))
    gammas = [c for c in candidates.columns if c.startswith("gamma_")]
    pairs = candidates.select(F.col("unique_id_l").alias("plant_id"), F.col("unique_id_r").alias("plantgen_plant_id"), "match_probability", "match_weight", *gammas)
    lone = F.col("plantgen_plant_id").isNull()
    reason = (
        F.when(lone & (F.col("country_area") == "Canada"), "no US county, no US ZIP, no shared state: PLANTGEN is a US census")
        .when(lone & (~F.col("__has") | (F.col("__accuracy") == "approximate")), "no usable geography and no ZIP: placeholder coordinates")
        .when(lone, "no blocking key matched any PLANTGEN record").when(F.col("gamma_county") >= 2, "county").when(F.col("gamma_zip5") == 1, "zip").otherwise("state")
    )
    return plants.join(pairs, "plant_id", "left").select(
        F.col("plant_id").alias("gspt_plant_id"), F.concat(F.lit("gspt:"), "plant_id").alias("gspt_plant_key"), "plantgen_plant_id", F.concat(F.lit("plantgen:"), "plantgen_plant_id").alias("plantgen_plant_key"),
        "match_probability", "match_weight", *gammas, F.when(lone, "never_compared").otherwise("candidate").alias("resolution_status"), reason.alias("blocking_reason"), "country_area",
    )


# ---------------------------------------------------------------- comparison frames

COMPARISON_COLUMNS = ("unique_id", "source_dataset", "plant_name", "city", "aliases", "other_names", "state", "zip5", "street", "start_year", "county_fips", "county_fips_effective", "county_distance_m", "country_area")


def known_names(first: Column, others: Column) -> Column:
    """All distinct names, sorted; nulls are none."""
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(F.array(first), others))))


def gspt_frame(units: DataFrame, counties: DataFrame) -> DataFrame:
    """One row per plant; an approximate position gives no geography, and one inside a county has distance 0."""
    one = units.groupBy("plant_id").agg(*(any_of(c) for c in ("plant_name", "city", "state_name", "location_address", "country_area")), F.array_join(F.array_sort(F.collect_set("other_plant_names")), "; ").alias("others"), any_of("start_date"))
    c = counties.groupBy("plant_id").agg(*(any_of(x) for x in ("county_fips", "nearest_county_fips", "nearest_county_distance_m", "coordinate_accuracy")))
    usable = ~F.col("coordinate_accuracy").eqNullSafe("approximate")
    name, names = T.normalize_text(F.col("plant_name")), T.split_aliases(F.col("others"))
    return one.join(c, "plant_id", "left").select(
        F.col("plant_id").alias("unique_id"), F.lit("gspt").alias("source_dataset"), name.alias("plant_name"), T.normalize_text(F.col("city")).alias("city"), known_names(name, T.other_names(names, name)).alias("aliases"),
        T.other_names(names, name).alias("other_names"), T.normalize_subdivision(F.col("state_name")).alias("state"), T.extract_zip(F.col("location_address")).alias("zip5"),
        T.normalize_street(F.col("location_address")).alias("street"), T.parse_year(F.col("start_date")).cast("bigint").alias("start_year"), F.when(usable, F.col("county_fips")).alias("county_fips"),
        F.when(usable, F.coalesce("county_fips", "nearest_county_fips")).alias("county_fips_effective"),
        F.when(usable, F.when(F.col("county_fips").isNotNull(), 0.0).otherwise(F.col("nearest_county_distance_m"))).alias("county_distance_m"), "country_area",
    )


def plantgen_frame(plantgen: DataFrame) -> DataFrame:
    name, city = T.normalize_text(F.col("plant_name")), T.normalize_text(F.col("city"))
    return plantgen.select(
        F.col("plant_id").alias("unique_id"), F.lit("plantgen").alias("source_dataset"), name.alias("plant_name"), city.alias("city"), known_names(name, F.array(city)).alias("aliases"), F.array().cast("array<string>").alias("other_names"),
        T.normalize_subdivision(F.col("state")).alias("state"), F.col("zip_code").alias("zip5"), T.normalize_street(F.col("street_address")).alias("street"), F.col("start_year").cast("bigint").alias("start_year"),
        "county_fips", F.col("county_fips").alias("county_fips_effective"), F.when(F.col("county_fips").isNotNull(), 0.0).alias("county_distance_m"), F.lit("United States").alias("country_area"),
    )


def unique_or_raise(df: DataFrame, *key: str) -> DataFrame:
    if (bad := df.groupBy(*key).count().where("count > 1").first()) is not None:
        raise ValueError(f"{key} is not unique: {bad}")
    return df
