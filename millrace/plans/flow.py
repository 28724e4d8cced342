"""Named steps with dependencies, run in order, from Python or the command line."""

from __future__ import annotations

import argparse
import graphlib
import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from millrace.plans import enrich as E
from millrace.plans import models as M
from millrace.sources import readers as S
from millrace.sources.contracts import CONTRACTS
from millrace.sources.lake import Lake, LakeConfig


@dataclass
class Flow:
    steps: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = field(default_factory=dict)

    def step(self, name: str, function: Callable[..., DataFrame], *needs: str) -> None:
        self.steps[name] = (function, needs)

    def order(self, targets: Iterable[str] | None = None) -> list[str]:
        graph = {n: {d for d in needs if d in self.steps} for n, (_, needs) in self.steps.items()}
        whole = list(graphlib.TopologicalSorter(graph).static_order())
        if targets is None:
            return whole
        wanted: set[str] = set()
        todo = list(targets)
        while todo:
            n = todo.pop()
            if n not in wanted and n in self.steps:
                wanted.add(n)
                todo += self.steps[n][1]
        return [n for n in whole if n in wanted]

    def run(self, given: dict[str, DataFrame], save: Callable[[str, DataFrame], DataFrame] = lambda _, df: df, targets: Iterable[str] | None = None) -> dict[str, DataFrame]:
        done = dict(given)
        for n in self.order(targets):
            function, needs = self.steps[n]
            if lost := [d for d in needs if d not in done]:
                raise ValueError(f"{n} needs {lost}")
            done[n] = save(n, function(*(done[d] for d in needs)))
        return done


def mart_flow() -> Flow:
    f = Flow()
    f.step("stg_plantgen", M.stg_plantgen, "raw.plantgen")
    f.step("stg_gspt_plant_unit", M.stg_gspt_plant_unit, "raw.gspt_plants")
    f.step("stg_gspt_production", M.stg_gspt_production, "raw.gspt_production", "stg_gspt_plant_unit")
    f.step("stg_furnace_year", M.stg_furnace_year, "raw.furnace_years")
    f.step("stg_plant_county", M.stg_plant_county, "geo.gspt_plant_county")
    f.step("dim_plant", M.dim_plant, "stg_gspt_plant_unit", "stg_plant_county", "stg_plantgen")
    f.step("dim_production_unit", M.dim_production_unit, "stg_gspt_plant_unit")
    f.step("dim_owner", M.dim_owner, "stg_gspt_plant_unit")
    f.step("dim_furnace", M.dim_furnace, "stg_furnace_year")
    f.step("fct_furnace_year", M.fct_furnace_year, "stg_furnace_year", "dim_furnace")
    f.step("fct_plant_production_year", M.fct_plant_production_year, "stg_gspt_production")
    f.step("dim_facility_ownership_scd2", M.dim_facility_ownership_scd2, "fct_furnace_year")
    f.step("fct_ownership_change", M.fct_ownership_change, "dim_facility_ownership_scd2")
    f.step("fct_ownership_noise", M.fct_ownership_noise, "raw.furnace_years", "fct_furnace_year", "fct_ownership_change")
    f.step("bridge_plant_xref", M.bridge_plant_xref, "resolution.gspt_plantgen_candidates", "stg_gspt_plant_unit")
    return f


GEO, PAIRS, BOUNDARIES = "geo.gspt_plant_county", "resolution.gspt_plantgen_candidates", "geo.counties"


def whole_flow() -> Flow:
    """The marts and the two derived tables that they need."""
    f = mart_flow()
    f.step(GEO, E.plant_county, "raw.gspt_plants", BOUNDARIES, "raw.plantgen")
    f.step(PAIRS, E.candidates, "stg_gspt_plant_unit", "stg_plant_county", "stg_plantgen")
    return f


@dataclass(frozen=True)
class Sources:
    """Where the source files are: paths, and for furnaces (kind, version, path) of each file."""

    plantgen: str | None = None
    gspt_plants: str | None = None
    gspt_production: str | None = None
    furnace_years: tuple[tuple[str, str, str], ...] = ()
    counties: str | None = None
    sheets: dict[str, str] = field(default_factory=dict)
    clean_version: str = "gspt_2024"

    @classmethod
    def read(cls, path: str) -> Sources:
        with open(path) as f:
            found = json.load(f)
        return cls(**found | {"furnace_years": tuple(tuple(x) for x in found.get("furnace_years", ()))})


@dataclass(frozen=True)
class LoadResult:
    table: str
    rows: int
    snapshot: int


def bronze(spark: SparkSession, sources: Sources, name: str) -> DataFrame:
    """A raw table under its contract; a file that breaks it is an error that names every broken rule."""
    if name == "furnace_years":
        df = S.read_furnace_years(spark, sources.furnace_years, sources.clean_version)
    elif name == "plantgen":
        df = S.read_plantgen(spark, sources.plantgen)
    else:
        df = S.READERS[name](spark, getattr(sources, name), sources.sheets.get(name))
    contract = CONTRACTS[name]
    return contract.validate(contract.project(df))


def ingest(spark: SparkSession, config: LakeConfig, sources: Sources, tables: Iterable[str] | None = None) -> list[LoadResult]:
    """Replace raw tables, and the boundaries, by what the files say.  Without names: all whose files are known."""
    lake, done = Lake(spark, config), []
    for name in tables or [t for t in (*CONTRACTS, "counties") if getattr(sources, t)]:
        if name not in CONTRACTS and name != "counties" or not getattr(sources, name):
            raise ValueError(f"no source for {name!r}")
        df = S.read_polygons(spark, sources.counties) if name == "counties" else bronze(spark, sources, name)
        namespace = "geo" if name == "counties" else "raw"
        number = lake.write(df, namespace, name)
        done.append(LoadResult(f"{namespace}.{name}", lake.read(namespace, name).count(), number))
    return done


def run_all(spark: SparkSession, config: LakeConfig, targets: Iterable[str] | None = None) -> list[str]:
    """Build derived tables, staging views and marts from the lake's raw tables, or only what the targets need.

    Without boundaries in the lake, its own table of plants' counties is taken as it is.
    """
    lake, flow = Lake(spark, config), whole_flow()
    given = {f"{n}.{t}": lake.read(n, t) for n, t in lake.tables() if n not in ("staging", "marts")}
    if BOUNDARIES not in given and GEO in given:
        del flow.steps[GEO]
    wanted = flow.order(targets)

    def save(name: str, df: DataFrame) -> DataFrame:
        if name.startswith("stg_"):
            df.createOrReplaceTempView(name)
            return df
        namespace, _, table = name.rpartition(".")
        lake.write(df, namespace or "marts", table)
        return lake.read(namespace or "marts", table)

    flow.run(given, save, targets)
    return sorted(wanted)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="millrace", description="Load source files into a lake and build its tables.")
    verbs = parser.add_subparsers(dest="verb", required=True)
    for verb, text in (("ingest", "load raw tables"), ("geo", "counties of plants"), ("resolve", "scored candidate pairs"), ("build", "everything, or the steps named"), ("all", "load, then build everything")):
        p = verbs.add_parser(verb, help=text)
        p.add_argument("lake")
        if verb in ("ingest", "all"):
            p.add_argument("sources", help="a JSON file with the paths of the source files")
        if verb in ("ingest", "build"):
            p.add_argument("names", nargs="*")
    args = parser.parse_args(argv)
    spark, config = SparkSession.builder.appName("millrace").getOrCreate(), LakeConfig(args.lake)
    if args.verb in ("ingest", "all"):
        for r in ingest(spark, config, Sources.read(args.sources), getattr(args, "names", None) or None):
            print(f"{r.table}: {r.rows} rows, snapshot {r.snapshot}")
    if args.verb != "ingest":
        targets = {"geo": [GEO], "resolve": [PAIRS]}.get(args.verb) or getattr(args, "names", None) or None
        print("\n".join(run_all(spark, config, targets)))


if __name__ == "__main__":
    main()
