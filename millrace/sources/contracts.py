"""Table contracts: a schema with checks that one aggregation (and one per key) verifies before a write."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, LongType, StringType, StructField, StructType


class ContractError(ValueError):
    pass


@dataclass(frozen=True)
class Contract:
    name: str
    schema: StructType
    unique: tuple[tuple[str, ...], ...] = ()
    patterns: dict[str, str] = field(default_factory=dict)
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def project(self, df: DataFrame) -> DataFrame:
        """The contract's columns in its order; missing ones are named."""
        require(df, self.schema.names, self.name)
        return df.select(*self.schema.names)

    def rules(self) -> dict[str, Column]:
        """A violation predicate per rule; null values break only the not-null rules."""
        out = {f"{f.name} is not null": F.col(f.name).isNull() for f in self.schema if not f.nullable}
        out |= {f"{c} matches {p}": ~F.col(c).rlike(p) for c, p in self.patterns.items()}
        out |= {f"{c} between {a} and {b}": ~F.col(c).between(a, b) for c, (a, b) in self.ranges.items()}
        return out | {f"{c} in {list(v)}": ~F.col(c).isin(*v) for c, v in self.allowed.items()}

    def violations(self, df: DataFrame) -> DataFrame:
        """(rule, violations) of every rule, with one pass for row rules and one per unique key."""
        rules = self.rules()
        counted = df.agg(*(F.count_if(F.coalesce(p, F.lit(False))).alias(f"r{i}") for i, p in enumerate(rules.values()))) if rules else None
        out = None
        if counted is not None:
            pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("violations")) for i, n in enumerate(rules))))
            out = counted.select(pairs.alias("x")).select("x.*")
        for key in self.unique:
            extra = df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").agg(F.lit(f"unique {list(key)}").alias("rule"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("violations"))
            out = extra if out is None else out.union(extra)
        return out if out is not None else df.sparkSession.createDataFrame([], "rule string, violations long")

    def validate(self, df: DataFrame) -> DataFrame:
        """The frame itself, or an error that names every broken rule."""
        extra, lost = set(df.columns) - set(self.schema.names), set(self.schema.names) - set(df.columns)
        wrong = [f"{f.name}: {df.schema[f.name].dataType.simpleString()} instead of {f.dataType.simpleString()}" for f in self.schema if f.name in df.columns and df.schema[f.name].dataType.simpleString() != f.dataType.simpleString()]
        broken = [] if lost else [f"{r['rule']}: {r['violations']}" for r in self.violations(df).where("violations > 0").collect()]
        if extra or lost or wrong or broken:
            raise ContractError(f"{self.name}: unexpected columns {sorted(extra)}, missing columns {sorted(lost)}, types {wrong}, rules {broken}")
        return df.select(*self.schema.names)


def require(df: DataFrame, columns: Sequence[str], source: str) -> None:
    if lost := [c for c in columns if c not in df.columns]:
        raise ContractError(f"{source} lacks the columns {lost}; it has {df.columns}")


def fields(text: str, kind: DataType = StringType(), nullable: bool = True) -> list[StructField]:  # noqa: B008
    return [StructField(n, kind, nullable) for n in text.split()]


#: The four bronze tables.
PLANTGEN = Contract(
    "plantgen",
    StructType(
        fields("plant_id plant_name county state st_cnty_fips state_fips cnty_fips", nullable=False)
        + fields("msa83 msa93 pmsa83 pmsa93 phone_number street_address city zip_code aisi_code")
        + fields("plant_start_yr shutdown_yr specialty_grade", LongType())
        + fields("source_file", nullable=False)
    ),
    unique=(("plant_id",),),
    patterns={"st_cnty_fips": r"^\d{5}$", "state_fips": r"^\d{2}$", "cnty_fips": r"^\d{3}$", "zip_code": r"^\d{5}$"},
)
PRODUCTION = Contract(
    "gspt_production",
    StructType(fields("plant_id", nullable=False) + fields("plant_name_english") + fields("year", LongType(), False) + fields("metric", nullable=False) + fields("value_ttpa", DoubleType()) + fields("value_raw source_file", nullable=False)),
    unique=(("plant_id", "year", "metric"),),
    ranges={"year": (2019, 2022)},
    allowed={"metric": ("crude_steel", "bof_steel", "eaf_steel", "ohf_steel", "iron", "bf", "dri")},
)
PLANTS = Contract(
    "gspt_plants",
    StructType(
        fields("plant_id plant_name_english country_area coordinates", nullable=False)
        + fields("other_plant_names_english owner owner_permid owner_gem_id parent municipality subnational_unit_province_state location_address coordinate_accuracy capacity_operating_status main_production_process main_production_equipment start_date retired_date")
        + fields("nominal_crude_steel_capacity_ttpa nominal_bof_steel_capacity_ttpa nominal_eaf_steel_capacity_ttpa nominal_iron_capacity_ttpa workforce_size")
        + fields("latitude longitude", DoubleType()) + fields("has_coordinates", BooleanType(), False) + fields("source_row", LongType(), False) + fields("source_file", nullable=False)
    ),
    unique=(("source_row",),),
    ranges={"latitude": (-90, 90), "longitude": (-180, 180)},
)
FURNACES = Contract(
    "furnace_years",
    StructType(
        fields("furnace_key") + fields("furnace_type", nullable=False) + fields("facility_id fid") + fields("year", LongType(), False)
        + fields("owner owner_verbatim main_product_line data_id no_of_furnaces_raw") + fields("no_of_furnaces", LongType()) + fields("power_kwh_per_metric_ton", DoubleType())
        + fields("corrected_cl corrected_cl_clean year_list", ArrayType(StringType()), False) + fields("encoding_degraded encoding_lossy owner_has_replacement_char not_melting", BooleanType(), False)
        + fields("align_key") + fields("corrected_cl_name_version alignment_status source_version source_file", nullable=False) + fields("source_row", LongType(), False)
    ),
    unique=(("source_version", "furnace_type", "source_row"),),
    patterns={"furnace_key": r"^(BOF|EAF):\d+$"},
    ranges={"year": (2012, 2023)},
    allowed={"furnace_type": ("BOF", "EAF"), "alignment_status": ("aligned", "unaligned_no_key", "unaligned_no_match")},
)
CONTRACTS = {c.name: c for c in (PLANTGEN, PLANTS, PRODUCTION, FURNACES)}
