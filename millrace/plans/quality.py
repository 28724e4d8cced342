"""Assertions as frames that must be empty, and checks that pass, fail, or say that they could not run."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.linkage import confusion
from millrace.operators.rows import overlapping


def not_null(df: DataFrame, c: str) -> DataFrame:
    return df.where(F.col(c).isNull())


def unique(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def accepted_values(df: DataFrame, c: str, values: list[str]) -> DataFrame:
    return df.where(~F.col(c).isin(*values))


def accepted_range(df: DataFrame, c: str, low: float, high: float) -> DataFrame:
    return df.where(~F.col(c).between(low, high))


def relationships(df: DataFrame, c: str, parent: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(c).isNotNull()).join(parent.select(F.col(key).alias(c)).distinct(), c, "left_anti")


def one_current(spans: DataFrame, entity: str) -> DataFrame:
    return spans.groupBy(entity).agg(F.count_if("is_current").alias("n")).where("n <> 1")


def no_overlap(spans: DataFrame, entity: str) -> DataFrame:
    return overlapping(spans, entity)


def no_verdict_column(df: DataFrame, words: tuple[str, ...] = ("verdict", "is_match", "matched")) -> list[str]:
    return [c for c in df.columns if any(w in c for w in words)]


def unresolved_without_key(bridge: DataFrame) -> DataFrame:
    return bridge.where((F.col("resolution_status") == "never_compared") & F.col("plantgen_plant_key").isNotNull())


def repeats_removed(bronze: DataFrame, staged: DataFrame, expected: int, version: str = "owner_filled_2025") -> DataFrame:
    """A row with both counts unless staging dropped exactly as many repeats as are known."""
    kept = (F.col("source_version") == version) & (F.col("alignment_status") != "unaligned_no_key")
    counts = bronze.agg(F.count_if(kept).alias("bronze_rows")).crossJoin(staged.agg(F.count("*").alias("staged_rows")))
    return counts.withColumn("removed", F.col("bronze_rows") - F.col("staged_rows")).where(F.col("removed") != expected)


def no_null_facility(facts: DataFrame) -> DataFrame:
    return not_null(facts.select("furnace_key", "facility_id"), "facility_id")


def transfer_survives(changes: DataFrame, facility: str, year: int) -> DataFrame:
    """Changes of a facility in the year of a known transfer that are not called credible: an excursion before it must not take it along."""
    known = (F.col("facility_key") == facility) & (F.col("change_year") == year)
    return changes.where(known & (F.col("change_class") != "credible_transfer")).select("facility_key", "change_year", "from_owner_raw", "to_owner_raw", "change_class")


def verdict_columns(df: DataFrame) -> DataFrame:
    """The columns that state a verdict, as rows; none of the frame's own rows is read, but it must be there."""
    named = df.sparkSession.createDataFrame([(c,) for c in no_verdict_column(df)], "column string")
    return named.union(df.limit(0).select(F.lit("").alias("column")))


def distinguishable(df: DataFrame, c: str, least: int = 2) -> DataFrame:
    return df.agg(F.count_distinct(c).alias("n")).where(F.col("n") < least)


@dataclass
class CheckResult:
    name: str
    passed: bool
    severity: str = "ERROR"
    status: str = "OK"
    metadata: dict[str, object] = field(default_factory=dict)


def is_number(x: object) -> bool:
    return isinstance(x, (int, float)) and not isinstance(x, bool) and x == x  # noqa: PLR0124


def read_baseline(path: str) -> dict[str, float]:
    if not os.path.exists(path):
        return {}
    with open(path) as f:
        return {k: v for k, v in json.load(f).items() if is_number(v)}


def write_baseline(path: str, values: dict[str, float]) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w") as f:
        json.dump(values, f, indent=1, sort_keys=True)


def bridge_reconciles(bridge: DataFrame, candidates: DataFrame) -> CheckResult:
    r = bridge.agg(F.count("*").alias("rows"), F.count_if(F.col("resolution_status") == "never_compared").alias("alone")).crossJoin(candidates.agg(F.count("*").alias("pairs"))).first().asDict()
    return CheckResult("bridge_reconciles", r["rows"] == r["pairs"] + r["alone"], metadata=r)


def furnace_reconciles(raw: DataFrame, facts: DataFrame, version: str = "owner_filled_2025") -> CheckResult:
    """Bronze rows are facts plus what each named filter took."""
    other = ~F.col("source_version").eqNullSafe(version)
    bare = ~other & (F.col("alignment_status") == "unaligned_no_key")
    kept = ~other & ~bare
    grain = F.struct("furnace_type", "facility_id", "year", "fid")
    a = raw.agg(F.count("*").alias("bronze"), F.count_if(other).alias("other_version"), F.count_if(bare).alias("without_key"), F.count_if(kept).alias("kept"), F.count_distinct(F.when(kept, grain)).alias("distinct"))
    r = a.crossJoin(facts.agg(F.count("*").alias("facts"))).first().asDict()
    r["repeats"] = r["kept"] - r["distinct"]
    return CheckResult("furnace_reconciles", r["bronze"] == r["facts"] + r["other_version"] + r["without_key"] + r["repeats"], metadata=r)


def coverage_has_not_regressed(df: DataFrame, c: str, baseline: str, key: str) -> CheckResult:
    """A ratchet: coverage may rise, and then raises the baseline; without one it is established with a warning."""
    n, total = df.agg(F.count(c), F.count("*")).first()
    known = read_baseline(baseline)
    if key not in known:
        write_baseline(baseline, {**known, key: n})
        return CheckResult("coverage", True, "WARN", "ESTABLISHED", {"covered": n, "rows": total})
    if n > known[key]:
        write_baseline(baseline, {**known, key: n})
    return CheckResult("coverage", n >= known[key], metadata={"covered": n, "rows": total, "baseline": known[key]})


def noise_is_bounded(changes: DataFrame, low: float = 0.30, high: float = 0.95) -> CheckResult:
    n, credible = changes.agg(F.count("*"), F.count_if(F.col("change_class") == "credible_transfer")).first()
    if not n:
        return CheckResult("noise", False, status="EMPTY")
    share = (n - credible) / n
    return CheckResult("noise", low <= share <= high, metadata={"rejected_share": share})


def precision_against_labels(labelled: DataFrame, stratum: str = "high_confidence", least: float = 0.85) -> CheckResult:
    """A gate on one stratum.  Without labels it is skipped, which is not a pass."""
    rows = {r["stratum"]: r.asDict() for r in confusion(labelled, ["stratum"]).collect()}
    if stratum not in rows or rows[stratum]["precision"] is None:
        return CheckResult("precision", False, "WARN", "SKIPPED - not evaluable", rows)
    return CheckResult("precision", rows[stratum]["precision"] >= least, "WARN", metadata=rows)


def banner(summary: dict[str, object]) -> str:
    if not summary.get("decided"):
        return "NO LABELS: nothing here is evaluated"
    return "SYNTHETIC LABELS ONLY: these figures say nothing about quality" if summary.get("all_synthetic") else "human labels"
