"""Probabilistic linkage of two frames: blocking, ordered comparison levels, EM, scores (Fellegi and Sunter 1969)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import any_level
from millrace.functions.udfs import jaro_winkler

KEYS = ("county_fips", "zip5", "state")


def with_key_flag(frame: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return frame.withColumn("has_blocking_key", F.coalesce(*(F.col(k).cast("string") for k in keys)).isNotNull())


def sided(frame: DataFrame, side: str) -> DataFrame:
    return frame.select(*(F.col(c).alias(f"{c}_{side}") for c in frame.columns))


#: Tasks that share the right records of a key.
DEALS = 16
#: Members of a class at most: more equal records make several classes, so that no row grows with them.
MEMBERS = 1000


def classes(frame: DataFrame, columns: Sequence[str], id_col: str = "unique_id", members: int | None = None) -> DataFrame:
    """Records that are equal in the columns as one, with its number of ``copies``; its id is the least of theirs.

    Counts and extremes of pairs need a pair of classes once, whatever the copies.  With ``members``, a class is of at most so many
    records, whose ids are its ``ids``.
    """
    copies = F.count("*").alias("copies")
    if members is None:
        return frame.groupBy(*columns).agg(F.min(id_col).alias(id_col), copies)
    part = F.floor((F.row_number().over(Window.partitionBy(*columns).orderBy(id_col)) - 1) / members).alias("__part")
    return frame.select(id_col, *columns, part).groupBy(*columns, "__part").agg(F.min(id_col).alias(id_col), copies, F.array_sort(F.collect_list(id_col)).alias("ids")).drop("__part")


def by_repeats(frame: DataFrame, id_col: str = "unique_id") -> tuple[DataFrame, DataFrame]:
    """Records whose id no other record has, and the rest."""
    counted = frame.withColumn("__n", F.count("*").over(Window.partitionBy(id_col)))
    return counted.where("__n = 1").drop("__n"), counted.where("__n > 1").drop("__n")


def members_of(pairs: DataFrame) -> DataFrame:
    """Every pair of records of pairs of classes that hold their ``ids``; the left side varies fastest."""
    ids = pairs.withColumn("unique_id_r", F.explode("ids_r")).withColumn("unique_id_l", F.explode("ids_l"))
    return ids.drop("ids_l", "ids_r", "copies_l", "copies_r")


def block_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str] = KEYS, id_col: str = "unique_id") -> DataFrame:
    """Every pair that some rule makes, once, with the first rule in ``blocked_by``.

    One equi-join per key, from which pairs of earlier keys are left out; one OR join would plan as a
    nested loop.  The right records of a key are dealt over tasks, each of which gets the left ones: the
    pairs cost more than the frames, by whose size a frequent key, or all keys, would fill one task.
    Records without any key meet the whole other side: that part is a rule of the model, and Spark runs
    it as a nested loop over the few keyless rows.
    """
    spark = left.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    l, r = sided(with_key_flag(left, keys), "l"), sided(with_key_flag(right, keys), "r")
    in_order = [f"{k}_r" for k in reversed(keys)]  # records of like keys follow each other, and so do their pairs
    same = lambda k: F.col(f"{k}_l") == F.col(f"{k}_r")
    dealt_l = l.withColumn("__deal_l", F.explode(F.sequence(F.lit(0), F.lit(DEALS - 1))))
    dealt_r = r.withColumn("__deal_r", F.pmod(F.xxhash64(f"{id_col}_r"), F.lit(DEALS)).cast("int"))
    passes = []
    for i, k in enumerate(keys):
        earlier = any_level(*(same(e) for e in keys[:i])) if i else F.lit(False)
        a = dealt_l.where(F.col(f"{k}_l").isNotNull()).repartition(parts, f"{k}_l", "__deal_l")
        b = dealt_r.where(F.col(f"{k}_r").isNotNull()).repartition(parts, f"{k}_r", "__deal_r").sortWithinPartitions(*in_order)
        passes.append(a.join(b, same(k) & (F.col("__deal_l") == F.col("__deal_r"))).where(~earlier).drop("__deal_l", "__deal_r").withColumn("blocked_by", F.lit(k)))
    r = r.repartition(parts, f"{id_col}_r").sortWithinPartitions(*in_order)
    bare_l, bare_r = l.where(~F.col("has_blocking_key_l")), r.where(~F.col("has_blocking_key_r"))
    passes.append(bare_l.crossJoin(r).withColumn("blocked_by", F.lit("fallback")))
    passes.append(l.where("has_blocking_key_l").crossJoin(bare_r).withColumn("blocked_by", F.lit("fallback")))
    out = passes[0]
    for p in passes[1:]:
        out = out.unionByName(p)
    return out.drop("has_blocking_key_l", "has_blocking_key_r")


def blocking_report(left: DataFrame, right: DataFrame, pairs: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row: cartesian size, blocked pairs, fallback pairs by inclusion and exclusion, reduction ratio."""
    count = lambda df, n: with_key_flag(df, keys).agg(F.count("*").alias(f"n_{n}"), F.count_if(~F.col("has_blocking_key")).alias(f"bare_{n}"))
    one = count(left, "l").crossJoin(count(right, "r")).crossJoin(pairs.agg(F.count("*").alias("blocked_pairs")))
    full = F.col("n_l") * F.col("n_r")
    fallback = F.col("bare_l") * F.col("n_r") + F.col("bare_r") * F.col("n_l") - F.col("bare_l") * F.col("bare_r")
    return one.select(full.alias("cartesian_pairs"), "blocked_pairs", fallback.alias("fallback_pairs"), (F.lit(1.0) - F.try_divide(F.col("blocked_pairs").cast("double"), full.cast("double"))).alias("reduction_ratio"))


@dataclass(frozen=True)
class Comparison:
    """Levels from best to worst; the last is "else".  A null test falls through; ``null`` gives gamma -1.

    Where ``never`` holds, no level does: a test that spares most pairs the others.
    """

    name: str
    null: Column
    levels: tuple[tuple[str, Column], ...]
    trained_out_by: tuple[str, ...] = ()
    never: Column | None = None

    def gamma(self) -> Column:
        out = F.when(self.null, -1)
        if self.never is not None:
            out = out.when(F.coalesce(self.never, F.lit(False)), 0)
        top = len(self.levels)
        for i, (_, test) in enumerate(self.levels):
            out = out.when(F.coalesce(test, F.lit(False)), top - i)
        return out.otherwise(0).cast("int").alias(f"gamma_{self.name}")

    def labels(self) -> dict[int, str]:
        return {**{len(self.levels) - i: name for i, (name, _) in enumerate(self.levels)}, 0: "else"}


def both(c: str) -> tuple[Column, Column]:
    return F.col(f"{c}_l"), F.col(f"{c}_r")


def exact(name: str, column: str, **options: tuple[str, ...]) -> Comparison:
    l, r = both(column)
    return Comparison(name, l.isNull() | r.isNull(), (("exact", l == r),), **options)


def edit_distance(name: str, column: str, limits: Sequence[int] = (1, 3)) -> Comparison:
    l, r = both(column)
    near = [(f"levenshtein_{n}", F.levenshtein(l, r, n) >= 0) for n in limits]  # bounded: -1 beyond n
    return Comparison(name, l.isNull() | r.isNull(), (("exact", l == r), *near), never=F.levenshtein(l, r, max(limits)) < 0 if limits else None)


def closest(name: str, columns: Sequence[str], limits: Sequence[float] = (0.92, 0.85)) -> Comparison:
    """Best agreement over all pairings of the columns; null only if each like-named pairing is."""
    pairs = [(F.col(f"{a}_l"), F.col(f"{b}_r")) for a in columns for b in columns]
    missing = [l.isNull() | r.isNull() for l, r in (both(c) for c in columns)]
    gone = missing[0]
    for m in missing[1:]:
        gone = gone & m
    best = F.greatest(*(jaro_winkler(l, r) for l, r in pairs))
    return Comparison(name, gone, (("exact", any_level(*(l == r for l, r in pairs))), *((f"jaro_winkler_{n}", best >= n) for n in limits)))


def alias(name: str, names: str, values: Sequence[str]) -> Comparison:
    """Either side's list of names against the other side's values: an equal name, a name with a value among its words, else."""
    sides = [(F.col(f"{names}_{a}"), F.col(f"{v}_{b}")) for a, b in (("l", "r"), ("r", "l")) for v in values]
    element = any_level(*(F.array_contains(ns, v) for ns, v in sides))
    has_word = lambda ns, v: F.exists(ns, lambda n: F.coalesce(F.array_contains(F.split(n, " "), v), F.lit(False)))
    word = any_level(*(has_word(ns, v) for ns, v in sides))
    l, r = both(names)
    return Comparison(name, l.isNull() & r.isNull(), (("element", element), ("word", word)))


def within(name: str, column: str, limits: Sequence[int] = (3,)) -> Comparison:
    l, r = both(column)
    gap = F.abs(l - r)
    return Comparison(name, l.isNull() | r.isNull(), (("same", gap == 0), *((f"within_{n}", gap <= n) for n in limits)))


def area(name: str, exact_col: str, effective: str, distance: str, metres: Sequence[int] = (500, 5000), **options: tuple[str, ...]) -> Comparison:
    """The same area, or the same once each side's nearest area within a distance counts."""
    l, r = both(exact_col)
    le, re_ = both(effective)
    far = F.greatest(*(F.coalesce(c, F.lit(1e9)) for c in both(distance)))
    return Comparison(name, le.isNull() | re_.isNull(), (("exact", l == r), *((f"near_{m}m", (le == re_) & (far <= m)) for m in metres)), **options)


def plant_comparisons() -> list[Comparison]:
    return [
        exact("zip5", "zip5", trained_out_by=("zip5",)), edit_distance("street", "street"), closest("place", ["plant_name", "city"]), alias("alias_place", "other_names", ["plant_name", "city"]),
        within("start_year", "start_year"), area("county", "county_fips", "county_fips_effective", "county_distance_m", trained_out_by=("county_fips",)),
    ]


# ---------------------------------------------------------------- estimation


def numbered(df: DataFrame, id_col: str, parts: int = 64) -> DataFrame:
    """Rows numbered from 0 without a single sort: by a hash of the id, then by id; only the parts' counts meet."""
    part = F.pmod(F.xxhash64(id_col), F.lit(parts))
    dealt = df.withColumn("__part", part)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("__part").agg(F.count("*").alias("__n")).select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(id_col)) - 1
    return dealt.withColumn("__within", within).join(F.broadcast(starts), "__part").withColumn("__number", F.col("__before") + F.col("__within")).drop("__part", "__within", "__before")


def random_pairs(left: DataFrame, right: DataFrame, max_pairs: int = 1_000_000, seed: int = 17, id_col: str = "unique_id") -> DataFrame:
    """Pairs at random, whatever their blocking keys: all of them if there are at most ``max_pairs``, else a seeded draw of about so many.

    Pairs are drawn as numbers and joined to the numbered frames by equality: no product of the frames is made.
    """
    n, m = left.count(), right.count()
    spark = left.sparkSession
    many = min(n * m, max_pairs)
    at = spark.range(many)
    if n * m <= max_pairs:
        pairs = at.select(F.floor(F.col("id") / F.lit(max(1, m))).cast("bigint").alias("__l"), (F.col("id") % F.lit(max(1, m))).alias("__r"))
    else:
        pick = lambda k, salt: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(salt)), F.lit(k))
        pairs = at.select(pick(n, 0).alias("__l"), pick(m, 1).alias("__r")).distinct()
    l, r = (sided(numbered(df, id_col), s) for df, s in ((left, "l"), (right, "r")))
    return pairs.join(l, F.col("__l") == F.col("__number_l")).join(r, F.col("__r") == F.col("__number_r")).drop("__l", "__r", "__number_l", "__number_r")


def u_from_random(pairs: DataFrame, comparisons: Sequence[Comparison]) -> dict[str, dict[int, float | None]]:
    """u: the share of each level among pairs at random, which are overwhelmingly no matches."""
    counts = patterns(pairs, comparisons)
    return {c.name: shares(counts, i, sorted(c.labels())) for i, c in enumerate(comparisons)}


Pattern = tuple[int, ...]


def number(pairs: DataFrame) -> Column:
    """How many pairs of records the rows stand for: pairs of classes for the product of their copies, below zero for pairs to take off."""
    return (F.sum(F.col("copies_l") * F.col("copies_r")) if {"copies_l", "copies_r"} <= set(pairs.columns) else F.count("*")).alias("n")


def patterns(pairs: DataFrame, comparisons: Sequence[Comparison]) -> dict[Pattern, int]:
    """Counts of gamma vectors: at most the product of the level counts, whatever the number of pairs."""
    names = [f"gamma_{c.name}" for c in comparisons]
    return {tuple(r[:-1]): r[-1] for r in pairs.groupBy(*names).agg(number(pairs)).where("n > 0").collect()}


@dataclass
class Weights:
    """m and u by comparison and level; None where there was no evidence (a factor of one, never a guess)."""

    prior: float
    m: dict[str, dict[int, float | None]] = field(default_factory=dict)
    u: dict[str, dict[int, float | None]] = field(default_factory=dict)

    def factor(self, name: str, level: int) -> float:
        m, u = self.m.get(name, {}).get(level), self.u.get(name, {}).get(level)
        return 1.0 if level < 0 or not m or not u else m / u

    def weight(self, pattern: Pattern, names: Sequence[str]) -> float:
        return math.log2(self.prior / (1 - self.prior)) + sum(math.log2(self.factor(n, g)) for n, g in zip(names, pattern, strict=True))


def shares(counts: dict[Pattern, float], at: int, levels: Sequence[int]) -> dict[int, float | None]:
    by = {g: 0.0 for g in levels}
    for p, n in counts.items():
        if p[at] >= 0:
            by[p[at]] += n
    total = sum(by.values())
    return {g: (n / total if total and n else None) for g, n in by.items()}


def expectation_maximisation(counts: dict[Pattern, int], names: Sequence[str], levels: dict[str, Sequence[int]], u: dict[str, dict[int, float | None]], use: Sequence[str], prior: float, rounds: int = 50, tolerance: float = 1e-6) -> dict[str, dict[int, float | None]]:
    """m of the comparisons in ``use`` with u fixed, over pattern counts: exact, and no Spark job per round.

    Starting values fall by level; a level without observations ends as None.
    """
    m = {n: {g: (g + 1) ** 3 / sum((h + 1) ** 3 for h in levels[n]) for g in levels[n]} for n in use}
    at = {n: names.index(n) for n in use}
    for _ in range(rounds):
        weighted: dict[Pattern, float] = {}
        for p, n in counts.items():
            yes, no = prior, 1 - prior
            for c in use:
                if (g := p[at[c]]) >= 0 and u[c].get(g):
                    yes *= m[c].get(g) or 1e-12
                    no *= u[c][g]
            weighted[p] = n * yes / (yes + no)
        total = sum(weighted.values())
        prior = min(max(total / max(1, sum(counts.values())), 1e-9), 1 - 1e-9)
        new = {c: shares(weighted, at[c], levels[c]) for c in use}
        moved = max((abs((new[c][g] or 0) - (m[c][g] or 0)) for c in use for g in levels[c]), default=0)
        m = new
        if moved < tolerance:
            break
    return m


def estimate(pairs: DataFrame, random: DataFrame, comparisons: Sequence[Comparison], n_left: int, n_right: int, keys: Sequence[str] = KEYS) -> Weights:
    """u from pairs at random, m from one EM pass per blocking key.

    A pass leaves out what its key decides.  Several passes' estimates of a level are averaged; a level
    that no pass saw stays None.  The prior is the largest share of true pairs that ids allow.
    """
    names = [c.name for c in comparisons]
    levels = {c.name: sorted(c.labels()) for c in comparisons}
    out = Weights(1 / max(n_left, n_right, 2))
    out.u = u_from_random(random, comparisons)
    equal = [F.coalesce(F.col(f"{k}_l") == F.col(f"{k}_r"), F.lit(False)).alias(f"__same_{k}") for k in keys]
    gammas = [F.col(f"gamma_{n}") for n in names]
    rows = pairs.groupBy(*gammas, *equal).agg(number(pairs)).where("n > 0").collect()  # one pass for all keys: at most patterns x 2**keys rows
    seen: dict[str, dict[int, list[float]]] = {n: {g: [] for g in levels[n]} for n in names}
    for key in keys:
        counts: dict[Pattern, int] = {}
        for row in rows:
            if row[f"__same_{key}"]:
                p = tuple(row[: len(names)])
                counts[p] = counts.get(p, 0) + row["n"]
        use = [c.name for c in comparisons if key not in c.trained_out_by]
        if counts:
            for n, by in expectation_maximisation(counts, names, levels, out.u, use, 0.1).items():
                for g, v in by.items():
                    if v is not None:
                        seen[n][g].append(v)
    out.m = {n: {g: (sum(v) / len(v) if v else None) for g, v in by.items()} for n, by in seen.items()}
    return out


def m_from_labels(labelled: DataFrame, comparisons: Sequence[Comparison], weights: Weights) -> Weights:
    """m anew as shares of levels among labelled matches; u and prior stay."""
    names = [c.name for c in comparisons]
    counts = patterns(labelled.where("verdict = 'match'"), comparisons)
    return Weights(weights.prior, {n: shares(counts, i, sorted(weights.u[n])) for i, n in enumerate(names)}, weights.u)


def term_frequencies(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Relative frequency of each value in both frames together."""
    both_sides = left.select(column).union(right.select(column)).where(F.col(column).isNotNull())
    total = both_sides.agg(F.count("*").alias("__total"))
    return both_sides.groupBy(column).agg(F.count("*").alias("n")).crossJoin(F.broadcast(total)).select(column, (F.col("n") / F.col("__total")).alias("tf"))


def score(pairs: DataFrame, comparisons: Sequence[Comparison], weights: Weights, frequencies: dict[str, DataFrame] | None = None) -> DataFrame:
    """match_weight and match_probability of each pair.

    Scores are made per pattern and looked up, so that equal gamma vectors get bit-equal scores.  With
    frequencies of a column, agreement on a rare value weighs more than on a frequent one.
    """
    names = [c.name for c in comparisons]
    levels = [sorted(c.labels()) for c in comparisons]
    out = pairs
    parts = [F.lit(math.log2(weights.prior / (1 - weights.prior)))]
    for n, ls in zip(names, levels, strict=True):
        ladder = F.lit(0.0)
        for g in ls:
            ladder = F.when(F.col(f"gamma_{n}") == g, F.lit(math.log2(weights.factor(n, g)))).otherwise(ladder)
        parts.append(ladder)
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    for column, table in (frequencies or {}).items():
        u = weights.u[column].get(1)
        if u:
            out = out.join(table.select(F.col(column).alias(f"{column}_l"), F.col("tf").alias(f"__tf_{column}")), f"{column}_l", "left")
            total = total + F.when((F.col(f"gamma_{column}") == 1) & F.col(f"__tf_{column}").isNotNull(), F.log2(F.lit(u) / F.col(f"__tf_{column}"))).otherwise(F.lit(0.0))
    return out.withColumn("match_weight", total).withColumn("match_probability", F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(2.0), -F.col("match_weight")))).drop(*(f"__tf_{c}" for c in frequencies or {}))


def comparator_report(pairs: DataFrame, comparisons: Sequence[Comparison], weights: Weights, counts: dict[Pattern, int] | None = None) -> DataFrame:
    """A row per level: m, u, Bayes factor, weight, pairs there, low support, unestimated; nothing is filled in.

    ``counts`` are the pairs' patterns, if they are known already.
    """
    spark = pairs.sparkSession
    counts = patterns(pairs, comparisons) if counts is None else counts
    rows = []
    for i, c in enumerate(comparisons):
        for g, label in c.labels().items():
            m, u = weights.m.get(c.name, {}).get(g), weights.u.get(c.name, {}).get(g)
            n = sum(v for p, v in counts.items() if p[i] == g)
            bf = m / u if m and u else None
            rows.append((c.name, g, label, m, u, bf, math.log2(bf) if bf else None, n, n < 10, m is None or u is None))
    return spark.createDataFrame(rows, "comparison string, gamma int, label string, m double, u double, bayes_factor double, match_weight double, pairs long, low_support boolean, unestimated boolean")


def best_per_record(scored: DataFrame, side: str, other: str, p: str = "match_probability") -> DataFrame:
    """The best pair of each record; ties go to the smaller id of the other side."""
    by = Window.partitionBy(side).orderBy(F.desc(p), other)
    return scored.withColumn("__rank", F.row_number().over(by)).where("__rank = 1").drop("__rank")


# ---------------------------------------------------------------- labels and evaluation

AMBIGUOUS = (0.1, 0.9)
STRATA = ("ambiguous", "contested", "cook_county", "high_confidence", "low_confidence", "unsampled")


def with_contested(pairs: DataFrame, bar: float = 0.9, left: str = "unique_id_l", right: str = "unique_id_r", p: str = "match_probability") -> DataFrame:
    """Flag ``contested``: a pair and another one of either of its records both claim at least ``bar``.

    Claims are counted before they move and joined back, so that a record with very many pairs fills no task.
    """
    high = pairs.where(F.col(p) >= bar)
    several = lambda c: high.groupBy(F.col(c).alias("__id")).agg(F.count("*").alias("__n")).where("__n > 1").select("__id", F.lit(True).alias(f"__{c}"))
    l, r = several(left).withColumnRenamed("__id", "__il"), several(right).withColumnRenamed("__id", "__ir")
    joined = pairs.join(l, F.col(left) == F.col("__il"), "left").join(r, F.col(right) == F.col("__ir"), "left")
    return joined.withColumn("contested", (F.col(p) >= bar) & F.coalesce(f"__{left}", f"__{right}", F.lit(False))).drop("__il", "__ir", f"__{left}", f"__{right}")


def strata(pairs: DataFrame, special: Column, bar: float = 0.9, **names: str) -> DataFrame:
    """The first stratum that holds for each pair."""
    p = F.col(names.get("p", "match_probability"))
    marked = with_contested(pairs, bar, **names).withColumnRenamed("contested", "__contested")
    ladder = (
        F.when((p >= AMBIGUOUS[0]) & (p < AMBIGUOUS[1]), "ambiguous").when(F.col("__contested"), "contested").when(special, "cook_county")
        .when(p >= 0.99, "high_confidence").when(p < 0.01, "low_confidence").otherwise("unsampled")
    )
    return marked.withColumn("stratum", ladder).drop("__contested")


def confusion(labelled: DataFrame, group: Sequence[str | Column] = (), p: str = "match_probability", threshold: Column | float = 0.5, truth: Column | None = None) -> DataFrame:
    """Counts, precision, recall and F1; null where undefined."""
    yes = F.col("verdict") == "match" if truth is None else truth
    said = F.col(p) >= threshold
    counts = labelled.groupBy(*group).agg(
        F.count_if(said & yes).alias("tp"), F.count_if(said & ~yes).alias("fp"), F.count_if(~said & yes).alias("fn"), F.count_if(~said & ~yes).alias("tn")
    )
    ratio = lambda a, b: F.try_divide(F.col(a).cast("double"), (F.col(a) + F.col(b)).cast("double"))
    rated = counts.withColumns({"precision": ratio("tp", "fp"), "recall": ratio("tp", "fn")})
    f1 = F.when((F.col("precision") > 0) & (F.col("recall") > 0), 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
    return rated.withColumn("f1", f1)


def precision_recall(labelled: DataFrame, thresholds: Sequence[float], **options: object) -> DataFrame:
    """A confusion row per threshold, from one pass."""
    steps = F.explode(F.array(*(F.lit(float(t)) for t in thresholds)))
    return confusion(labelled.withColumn("threshold", steps), ["threshold"], threshold=F.col("threshold"), **options)


def histogram(df: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """Counts in left-closed buckets, empty ones too."""
    names = [f"[{a:g}, {b:g})" for a, b in zip(edges[:-1], edges[1:], strict=True)]
    at = F.lit(None).cast("string")
    for name, a, b in zip(names, edges[:-1], edges[1:], strict=True):
        at = F.when((F.col(column) >= a) & (F.col(column) < b), name).otherwise(at)
    counts = df.groupBy(at.alias("bucket")).agg(F.count("*").alias("n"))
    every = df.sparkSession.createDataFrame([(n, i) for i, n in enumerate(names)], "bucket string, position int")
    return every.join(F.broadcast(counts), "bucket", "left").select("bucket", "position", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def composition(queue: DataFrame, everything: DataFrame, names: Sequence[str] = STRATA) -> DataFrame:
    """Drawn and available pairs per stratum, empty strata too, and a total row."""
    have = everything.groupBy("stratum").agg(F.count("*").alias("available"))
    drawn = queue.groupBy("stratum").agg(F.count("*").alias("drawn"))
    every = queue.sparkSession.createDataFrame([(n,) for n in names], "stratum string")
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
    rows = every.join(F.broadcast(have), "stratum", "left").join(F.broadcast(drawn), "stratum", "left").groupBy("stratum").agg(zero("available"), zero("drawn"))
    return rows.union(rows.agg(F.lit("TOTAL").alias("stratum"), zero("available"), zero("drawn")))
