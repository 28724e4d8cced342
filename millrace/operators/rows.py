"""Row operators: first row per key, gaps and islands, unpivot, set status, order-stable numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, null being a key too; Spark limits the groups before and after the shuffle."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(by)).where("__rank = 1").drop("__rank")


def islands(df: DataFrame, entity: str, at: str, value: str, lowest: Sequence[str] = (), any_true: Sequence[str] = (), same: Sequence[str] = ()) -> DataFrame:
    """Type-2 history of ``value`` per entity from one row per entity and year.

    Rows without a value are no observation, so they also leave a gap.  A version starts at the first
    row, at a change, and after a gap of more than a year.  ``valid_to`` is exclusive and null when
    current.  One exchange on the entity serves all windows and both aggregations.
    """
    seen = df.where(F.col(value).isNotNull())
    year = seen.groupBy(entity, at).agg(F.min(value).alias(value), *(F.min(c).alias(c) for c in (*lowest, *same)), *(F.bool_or(c).alias(c) for c in any_true))
    by_year = Window.partitionBy(entity).orderBy(at)
    before, then = F.lag(value).over(by_year), F.lag(at).over(by_year)
    starts = before.isNull() | ~F.col(value).eqNullSafe(before) | (F.col(at) - then > 1)
    marked = year.withColumn("__start", starts.cast("int"))
    numbered = marked.withColumn("version_number", F.sum("__start").over(by_year.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint"))
    spans = numbered.groupBy(entity, "version_number").agg(
        *(F.min(c).alias(c) for c in (*same, value, *lowest)), F.min(at).alias("valid_from_year"), F.max(at).alias("last_observed_year"), *(F.bool_or(c).alias(c) for c in any_true)
    )
    after = F.lead("valid_from_year").over(Window.partitionBy(entity).orderBy("version_number"))
    return spans.withColumns({"valid_to_year": after, "is_current": after.isNull()})


def overlapping(spans: DataFrame, entity: str) -> DataFrame:
    """Pairs of versions of one entity whose half-open intervals overlap; must be empty."""
    a, b = spans.alias("a"), spans.alias("b")
    end = lambda x: F.coalesce(F.col(f"{x}.valid_to_year"), F.lit(9999))
    on = (F.col(f"a.{entity}") == F.col(f"b.{entity}")) & (F.col("a.version_number") < F.col("b.version_number")) & (F.col("a.valid_from_year") < end("b")) & (F.col("b.valid_from_year") < end("a"))
    return a.join(b, on).select(F.col(f"a.{entity}").alias(entity), F.col("a.version_number").alias("left_version"), F.col("b.version_number").alias("right_version"))


def ownership_changes(spans: DataFrame, entity: str, value: str, raw: str | None = None, max_years: int = 3, same: Sequence[str] = ()) -> DataFrame:
    """Transitions between versions with one class each.

    An excursion is a version whose neighbours agree and which lasts at most ``max_years``; both of its
    transitions are legs of it.  Only windows over the entity: no self-join.
    """
    by = Window.partitionBy(entity).orderBy("version_number")
    lag, lead = (lambda c: F.lag(c).over(by)), (lambda c: F.lead(c).over(by))
    own = F.col(value)
    years = F.col("__until") - F.col("valid_from_year")
    framed = spans.withColumns({"__before": lag(value), "__after": lead(value), "__until": lead("valid_from_year"), **({"__raw": lag(raw)} if raw else {})})
    away = framed.withColumn("__years", F.when((F.col("__before") == F.col("__after")) & ~F.col("__before").eqNullSafe(own) & (years <= max_years), years))
    legs = away.withColumn("round_trip_years", F.least("__years", lag("__years")))
    distance = F.levenshtein(F.col("__before"), own)
    contained = F.contains(own, F.col("__before")) | F.contains(F.col("__before"), own)
    trip = F.col("round_trip_years").isNotNull()

    def ladder(*names: str) -> Column:
        return F.when(F.col("__before") == own, names[0]).when(distance <= 2, names[1]).when(contained, names[2]).when(trip, names[3]).otherwise(names[4])

    return legs.where(F.col("__before").isNotNull()).select(
        entity, *same, "version_number", F.col("valid_from_year").alias("change_year"),
        *([F.col("__raw").alias("from_owner_raw"), F.col(raw).alias("to_owner_raw")] if raw else []),
        F.col("__before").alias("from_owner_normalized"), own.alias("to_owner_normalized"),
        trip.alias("in_round_trip"), "round_trip_years", distance.cast("bigint").alias("normalized_edit_distance"),
        ladder("observation_gap", "likely_typo", "name_refinement", "round_trip", "credible_transfer").alias("change_class"),
        F.when(F.col("__before") == own, "derived").otherwise("heuristic_unvalidated").alias("classification_confidence"),
        ladder(
            "equality (not a heuristic)", "edit_distance<=2 (hand-set, no labels)", "substring containment (hand-set, no labels)",
            f"leg of an A->B->A excursion of {max_years} years or less (hand-set, no labels)", "none of the above filters matched",
        ).alias("classification_rule"),
    )


def align_vintages(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Left rows with columns of the first right row of the same key; the left row count can't change."""
    build = first_per_key(right.where(F.col(key).isNotNull()), [key], order).select(key, *(F.col(c).alias(f"{c}_clean") for c in columns), F.lit(True).alias("__found"))
    found = F.coalesce(F.col("__found"), F.lit(False))
    status = F.when(F.col(key).isNull(), "unaligned_no_key").when(found, "aligned").otherwise("unaligned_no_match")
    return left.join(build, key, "left").withColumn("alignment_status", status).drop("__found")


def with_row_number(df: DataFrame, file: str, block: str | None = None, name: str = "source_row") -> DataFrame:
    """Rows numbered from 1 in the order of files, their blocks, and rows in a block.

    Blocks are numbered apart from each other; only their row counts meet, one row for each block.
    """
    keys = [file, *([block] if block else [])]
    marked = df.withColumn("__at", F.monotonically_increasing_id())
    counts = marked.groupBy(*keys).agg(F.count("*").alias("__n"))
    earlier = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*keys, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    within = F.row_number().over(Window.partitionBy(*keys).orderBy("__at"))
    return marked.withColumn("__within", within).join(before, keys).withColumn(name, (F.col("__before") + F.col("__within")).cast("bigint")).drop("__at", "__within", "__before")


def draw(df: DataFrame, stratum: str, key: str, quotas: dict[str, int], seed: int) -> DataFrame:
    """At most the quota of rows of each stratum, by a hash of seed and key; strata without a quota go whole."""
    by = Window.partitionBy(stratum).orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"||{seed}"))), key)
    rank = F.row_number().over(by)
    whole = df.where(~F.col(stratum).isin(list(quotas)) | F.col(stratum).isNull()).withColumn("draw_rank", rank.cast("bigint"))
    if not quotas:
        return whole
    quota = F.lit(0)
    for name, n in quotas.items():
        quota = F.when(F.col(stratum) == name, n).otherwise(quota)
    # The constant bound lets Spark limit each stratum before it moves.
    some = df.where(F.col(stratum).isin(list(quotas))).withColumn("__rank", rank).where(F.col("__rank") <= max(quotas.values())).where(F.col("__rank") <= quota)
    return whole.unionByName(some.withColumn("draw_rank", F.col("__rank").cast("bigint")).drop("__rank"))
