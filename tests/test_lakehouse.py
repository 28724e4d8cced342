"""Readers, contracts, lake, marts, checks, linkage, geometry and streams on small tables with known defects."""

import json
import random
import zipfile
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions import text as T
from millrace.functions.udfs import alias_list, jaro_winkler_of
from millrace.operators import evaluation as E
from millrace.operators import geo as G
from millrace.operators import kinds as K
from millrace.operators import linkage as L
from millrace.operators import rows as R
from millrace.plans import enrich as N
from millrace.plans import models as M
from millrace.plans import quality as Q
from millrace.plans import queries as QU
from millrace.plans.flow import Flow, main, mart_flow, run_all
from millrace.plans.queries import ORACLE_SQL, QUERIES
from millrace.sources import readers as S
from millrace.sources.contracts import PLANTGEN, PRODUCTION, Contract, ContractError, fields
from millrace.sources.lake import Lake, LakeConfig
from millrace.streaming.arrivals import batches_of, decisions_by_pair, latest_decisions, on_new_vintage, vintages


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


@pytest.mark.parametrize(
    ("f", "values", "expected"),
    [
        (T.zip5, ["6607", "601.0", "16003-1234", "", "N/A", None, "06607"], ["06607", "00601", "16003", None, None, None, "06607"]),
        (lambda x: T.pad_fips(x, 5), ["1001", "123456", "9001.0", "x"], ["01001", "123456", "09001", None]),
        (T.clean_text, ["  a ", "", "\t", None], ["a", None, None, None]),
        (T.leading_int, ["1", "1 (#5)", "1*", "3 (not melting)", "Not melting", None], [1, 1, 1, 3, None, None]),
        (T.not_melting, ["3 (not melting)", "Not melting", "1", None], [True, True, False, False]),
        (T.sentinel_status, [None, "Unknown", ">0", "1,000", "2022-06"], ["absent", "unknown", "bounded", "reported", "unparsed"]),
        (T.plausible_year, ["2022-06", "9999", "20191", ">2019"], [2022, None, 2019, 2019]),
        (T.parse_year, ["2022-06", "9999", "20191", ">2019"], [2022, None, None, 2019]),
        (T.normalize_owner, ["Nucor Corp.", "Nucor Corp", "Standard Steel ? Burnham", "Inc"], ["nucor", "nucor", "standard steel burnham", None]),
        (T.extract_zip, ["12345 Main St, Town 54321-0001", "none here"], ["54321", None]),
        (T.normalize_street, ["6500 S Boundary Rd, X", "6500 South Boundary Road"], ["6500 s boundary rd", "6500 s boundary rd"]),
        (T.normalize_text, ["Höganäs  AB!", "nan"], ["höganäs ab", None]),
        (T.to_float, ["1,000.5", "unknown", ">0", " 7 "], [1000.5, None, None, 7.0]),
        (T.normalize_subdivision, ["Ohio", "oh", "Atlantis"], ["OH", "OH", None]),
    ],
)
def test_text(spark, f, values, expected):
    assert column(spark, values, f) == expected


def test_encoding_flags(spark):
    df = spark.createDataFrame([("Nucor Steel–South Carolina", "Nucor Steel?South Carolina"), ("Höganäs", "H?an?"), ("plain", "plain"), ("a?", "a?")], "o string, c string")
    got = df.select(T.is_degraded(F.col("o"), F.col("c")), T.is_lossy(F.col("o"), F.col("c"))).collect()
    assert [tuple(r) for r in got] == [(True, False), (True, True), (False, False), (False, False)]


def test_python_literals_and_jaro_winkler():
    assert alias_list("['a', \"b's\", '']") == ["a", "b's"]
    assert alias_list(None) == [] and alias_list("[") == ["["] and alias_list("x") == ["x"]
    assert round(jaro_winkler_of("martha", "marhta"), 6) == 0.961111
    assert jaro_winkler_of("", "") == 0.0


CSV = "PlantID,PlantName,County,State,StCntyFIPS,StateFIPS,CntyFIPS,MSA83,MSA93,PMSA83,PMSA93,PlantStartYr,PhoneNumber,StreetAddress,City,ZipCode,AISICode,ShutdownYr,SpecialtyGrade\n0001,Laplace,Orleans,LA,9001,9,1,,,,,9999,,1 Main Street,LaPlace,6607,A1,,1\n2,Two,Cook,IL,17031,17,31,,,,,1901,,,Two,601.0,,1999,\n"


def test_plantgen_csv_and_contract(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text(CSV)
    df = S.read_plantgen(spark, str(path))
    rows = {r["plant_id"]: r for r in PLANTGEN.validate(PLANTGEN.project(df)).collect()}
    assert rows["0001"]["zip_code"] == "06607" and rows["0001"]["st_cnty_fips"] == "09001" and rows["2"]["zip_code"] == "00601" and rows["2"]["specialty_grade"] is None
    (tmp_path / "bad.csv").write_text(CSV.replace("PlantName", "Other"))
    with pytest.raises(ContractError, match="plant_name"):
        S.read_plantgen(spark, str(tmp_path / "bad.csv"))
    with pytest.raises(ContractError, match="unique"):
        PLANTGEN.validate(PLANTGEN.project(df.union(df)))


def workbook(path, rows):
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    cell = lambda r, c, v: "" if v is None else f'<c r="{chr(65 + c)}{r + 1}" t="inlineStr"><is><t>{v}</t></is></c>'
    body = "".join(f"<row>{''.join(cell(i, j, v) for j, v in enumerate(row))}</row>" for i, row in enumerate(rows))
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{ns}"><sheets><sheet name="S" sheetId="1"/></sheets></workbook>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{ns}"><sheetData>{body}</sheetData></worksheet>')


PRODUCTION_ROWS = [
    [None, None, "2019", None, "2020", None],
    ["Plant ID", "Plant name (English)", "Crude steel production 2019 (ttpa)", "BOF steel production 2019 (ttpa)", "Crude steel production 2020 (ttpa)", "BOF steel production 2020 (ttpa)"],
    ["P1", "Alpha works", "1000", "unknown", "1100.5", None],
    ["P2", "Beta works", None, "20", "unknown", "&gt;0"],
]


def test_two_row_header(spark, tmp_path):
    workbook(tmp_path / "w.xlsx", PRODUCTION_ROWS)
    df = S.read_production(spark, str(tmp_path / "w.xlsx"), "S")
    rows = {(r["plant_id"], r["year"], r["metric"]): r["value_ttpa"] for r in PRODUCTION.validate(PRODUCTION.project(df)).collect()}
    assert len(rows) == 6 and rows["P1", 2020, "crude_steel"] == 1100.5 and rows["P2", 2020, "bof_steel"] is None
    wrong = [["2018" if v == "2019" else v for v in PRODUCTION_ROWS[0]], *PRODUCTION_ROWS[1:]]
    for broken, message in ((wrong, "stands over"), ([PRODUCTION_ROWS[0], ["x", *PRODUCTION_ROWS[1][1:]], PRODUCTION_ROWS[2]], "Plant ID"), (PRODUCTION_ROWS[:2], "fewer than 3")):
        workbook(tmp_path / "b.xlsx", broken)
        with pytest.raises(ValueError, match=message):
            S.read_production(spark, str(tmp_path / "b.xlsx"))


def test_sheet_header_collision(spark, tmp_path):
    workbook(tmp_path / "s.xlsx", [["Plant ID", "Plant.ID"], ["1", "2"]])
    with pytest.raises(ValueError, match="plant_id"):
        S.read_sheet(spark, str(tmp_path / "s.xlsx"))
    workbook(tmp_path / "t.xlsx", [["Plant ID", "Name"], ["1", "x"], ["2", None]])
    assert [tuple(r) for r in S.read_sheet(spark, str(tmp_path / "t.xlsx")).orderBy("source_row").collect()] == [(1, "1", "x"), (2, "2", None)]


def test_furnace_vintages(spark, tmp_path):
    (tmp_path / "old.csv").write_text("Corrected C/L,ID,Year,Year List,Owner,No. of furnaces\n\"['Höganäs']\",1,2015,\"['2015']\",NA,1 (#5)\n\"['Plain']\",NA,2015,[],Own,3 (not melting)\n")
    (tmp_path / "new.csv").write_text("Corrected.C.L,ID,Year,Year.List,Owner,No..of.furnaces\n\"['H?an?']\",1,2015,\"['2015']\",N?w Corp,1\n\"['H?an?']\",1,2015,\"['2015']\",N?w Corp ,1\n")
    both = S.read_furnaces(spark, "BOF", "clean", str(tmp_path / "old.csv")).unionByName(S.read_furnaces(spark, "BOF", "owner_filled_2025", str(tmp_path / "new.csv")))
    got = S.align_furnaces(both, "clean").orderBy("source_version", "source_row").collect()
    assert [r["alignment_status"] for r in got] == ["aligned", "unaligned_no_key", "aligned", "aligned"]
    assert got[2]["encoding_degraded"] and got[2]["encoding_lossy"] and got[2]["corrected_cl_clean"] == ["Höganäs"] and got[2]["owner_has_replacement_char"]
    audit = S.encoding_audit(S.align_furnaces(both, "clean")).first()
    assert (audit["degraded_rows"], audit["lossy_rows"], audit["degraded_facilities"], audit["damaged_owners"]) == (2, 2, 1, 2)
    one = M.stg_furnace_year(S.align_furnaces(both, "clean"))
    assert one.count() == 1


def test_lake(spark, tmp_path):
    lake = Lake(spark, LakeConfig(f"file://{tmp_path}/lake"))
    with pytest.raises(ValueError, match="no table"):
        lake.create_views()
    df = spark.createDataFrame([(1, "a")], "i long, s string")
    assert lake.write(df, "raw", "x") == 1 and lake.write(df.union(df), "raw", "x") == 2
    assert lake.read("raw", "x").count() == 2 and lake.read("raw", "x", 1).count() == 1
    with pytest.raises(ValueError, match="frozen"):
        lake.write(df.drop("s"), "raw", "x")
    lake.register("raw", "x", 1)
    assert lake.read("raw", "x").count() == 1
    lake.register("raw", "x")
    assert lake.create_views() == ["raw_x"] and spark.table("raw_x").count() == 2
    assert [tuple(r) for r in lake.counts().collect()] == [("raw", "x", 2)]


def facts(spark, rows):
    return spark.createDataFrame([(f, "EAF", f, y, o, o, False) for f, y, o in rows], "facility_key string, furnace_type string, facility_id string, year long, owner_raw string, owner_normalized string, owner_has_replacement_char boolean")


HISTORY = [("f", y, o) for y, o in ((2012, "aaaaaa"), (2013, "bbbbbb"), (2014, "bbbbbb"), (2015, "aaaaaa"), (2016, "cccccccc"), (2017, "cccccccd"), (2019, "cccccccd"), (2020, "cccccccd steel"), (2021, None), (2022, "cccccccd steel"))]


def test_history_and_changes(spark):
    spans = M.dim_facility_ownership_scd2(facts(spark, HISTORY))
    assert Q.no_overlap(spans.withColumn("version_number", F.col("version_number")), "facility_key").count() == 0 and Q.one_current(spans, "facility_key").count() == 0
    changes = {r["change_year"]: r["change_class"] for r in M.fct_ownership_change(spans).collect()}
    assert changes == {2013: "round_trip", 2015: "round_trip", 2016: "credible_transfer", 2017: "likely_typo", 2019: "observation_gap", 2020: "name_refinement", 2022: "observation_gap"}
    assert Q.noise_is_bounded(M.fct_ownership_change(spans)).passed
    assert not Q.noise_is_bounded(M.fct_ownership_change(spans).limit(0)).passed
    broken = spans.withColumn("valid_to_year", F.col("valid_to_year") + 1)
    assert Q.no_overlap(broken, "facility_key").count() > 0
    assert Q.one_current(spans.withColumn("is_current", F.lit(True)), "facility_key").count() == 1


def test_assertions_fail_when_they_must(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    assert Q.not_null(df, "k").count() == 1 and Q.unique(df, "k").count() == 1 and Q.accepted_values(df, "v", ["a", "b"]).count() == 1
    assert Q.accepted_range(df, "k", 2, 3).count() == 2 and Q.relationships(df, "k", df.where("false"), "k").count() == 2 and Q.distinguishable(df, "k").count() == 1
    assert Q.no_verdict_column(df.withColumn("verdict", F.lit(1))) == ["verdict"]
    contract = Contract("c", StructType(fields("v", nullable=False)), allowed={"v": ("a",)})
    assert {r["rule"]: r["violations"] for r in contract.violations(df).collect()} == {"v is not null": 0, "v in ['a']": 2}


def test_coverage_ratchet(spark, tmp_path):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    path = str(tmp_path / "b" / "base.json")
    assert Q.coverage_has_not_regressed(df, "k", path, "k").status == "ESTABLISHED"
    assert Q.coverage_has_not_regressed(df, "k", path, "k").passed and not Q.coverage_has_not_regressed(df.where("k is null"), "k", path, "k").passed


LABELLED = [(0.99, "match"), (0.97, "no_match"), (0.30, "match"), (0.001, "no_match"), (0.001, "match")]


def test_confusion(spark):
    df = spark.createDataFrame(LABELLED, "match_probability double, verdict string")
    r = L.confusion(df).first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"], r["precision"], round(r["recall"], 6), round(r["f1"], 6)) == (1, 1, 2, 1, 0.5, 0.333333, 0.4)
    assert L.precision_recall(df, [0.1, 0.9]).count() == 2
    assert L.confusion(df.limit(0)).first()["precision"] is None
    skipped = Q.precision_against_labels(df.limit(0).withColumn("stratum", F.lit("x")))
    assert not skipped.passed and skipped.status.startswith("SKIPPED")


def test_strata(spark):
    rows = [("G1", "P1", 0.999), ("G1", "P2", 0.995), ("G2", "P3", 0.5), ("G2", "P4", 0.2), ("G3", "COOK1", 0.0001), ("G3", "P5", 0.0001), ("G4", "P6", 0.9995), ("G5", "P7", 0.000001)]
    df = spark.createDataFrame(rows, "unique_id_l string, unique_id_r string, match_probability double")
    got = {(r[0], r[1]): r["stratum"] for r in L.strata(df, F.col("unique_id_r") == "COOK1").collect()}
    assert list(got.values()).count("contested") == 2 and got["G2", "P3"] == "ambiguous" and got["G3", "COOK1"] == "cook_county" and got["G3", "P5"] == "low_confidence" and got["G4", "P6"] == "high_confidence"
    drawn = R.draw(L.strata(df, F.lit(False)).withColumn("pair_id", F.concat_ws("|", "unique_id_l", "unique_id_r")), "stratum", "pair_id", {"contested": 1}, 1)
    assert drawn.where("stratum = 'contested'").count() == 1 and drawn.count() == 7


def test_linkage_recovers_weights():
    names, levels = ["a", "b", "c"], {n: [0, 1] for n in "abc"}
    m, u = {"a": 0.9, "b": 0.8, "c": 0.7}, {"a": 0.05, "b": 0.1, "c": 0.2}
    counts = {}
    for p in [(x, y, z) for x in (0, 1) for y in (0, 1) for z in (0, 1)]:
        yes = no = 1.0
        for n, g in zip(names, p, strict=True):
            yes *= m[n] if g else 1 - m[n]
            no *= u[n] if g else 1 - u[n]
        counts[p] = round(1e6 * (0.2 * yes + 0.8 * no))
    fixed = {n: {1: u[n], 0: 1 - u[n]} for n in names}
    got = L.expectation_maximisation(counts, names, levels, fixed, names, 0.1, 500, 1e-10)
    assert all(abs(got[n][1] - m[n]) < 0.01 for n in names)


def test_resolution_end_to_end(spark):
    units = spark.createDataFrame(
        [("G1", "Alpha Works", "Gary", "Indiana", "1 Main Street, Gary, IN 46402", "United States", "Alpha; Old Alpha", "1901"), ("G2", "Beta", None, None, None, "Canada", None, None)],
        "plant_id string, plant_name string, city string, state_name string, location_address string, country_area string, other_plant_names string, start_date string",
    )
    counties = spark.createDataFrame([("G1", "18089", None, None, "exact"), ("G2", None, None, None, "approximate")], "plant_id string, county_fips string, nearest_county_fips string, nearest_county_distance_m double, coordinate_accuracy string")
    left = M.unique_or_raise(M.gspt_frame(units, counties), "unique_id")
    plantgen = spark.createDataFrame([("1", "Alpha Works", "Gary", "IN", "46402", "1 Main St", 1901, "18089"), ("2", "Gamma", "Cleveland", "OH", "44101", "9 Lake Ave", 1950, "39035")], "plant_id string, plant_name string, city string, state string, zip_code string, street_address string, start_year int, county_fips string")
    right = M.plantgen_frame(plantgen)
    assert left.columns == right.columns == list(M.COMPARISON_COLUMNS)
    comparisons = L.plant_comparisons()
    pairs = L.block_pairs(left, right)
    got = pairs.select("*", *(c.gamma() for c in comparisons))
    assert {(r["unique_id_l"], r["unique_id_r"]): r["blocked_by"] for r in got.collect()} == {("G1", "1"): "county_fips", ("G2", "1"): "fallback", ("G2", "2"): "fallback"}
    best = got.where("unique_id_l = 'G1'").first()
    assert [best[f"gamma_{c.name}"] for c in comparisons] == [1, 3, 3, 0, 2, 3]
    weights = L.estimate(got, got, comparisons, 2, 2)
    scored = L.score(got, comparisons, weights, {"zip5": L.term_frequencies(left, right, "zip5")})
    assert scored.where("match_probability between 0 and 1").count() == 3
    report = L.comparator_report(got, comparisons, weights)
    assert report.where("unestimated and match_weight is not null").count() == 0
    bridge = M.bridge_plant_xref(scored.where("unique_id_l = 'G1'"), units.withColumn("has_coordinates", F.lit(True)).withColumn("coordinate_accuracy", F.lit("exact")))
    assert Q.bridge_reconciles(bridge, scored.where("unique_id_l = 'G1'")).passed and Q.unresolved_without_key(bridge).count() == 0


def square(spark, crs="EPSG:4269"):
    ring = [{"x": x, "y": y} for x, y in ((-96.0, 39.0), (-95.0, 39.0), (-95.0, 40.0), (-96.0, 40.0))]
    other = [{"x": p["x"] + 1, "y": p["y"]} for p in ring]
    return spark.createDataFrame([("A", "a", 0, [ring], crs), ("B", "b", 1, [other], crs)], "geo_id string, name string, position int, rings array<array<struct<x: double, y: double>>>, crs string")


def test_polygons(spark, tmp_path):
    points = spark.createDataFrame([(1, 39.5, -95.5), (2, 39.5, -95.0), (3, None, None), (4, 41.0, -95.5)], "i long, lat double, lon double")
    got = {r["i"]: r for r in G.assign_polygons(points, square(spark), "i", "lat", "lon").collect()}
    assert got[1]["geo_id"] == "A" and got[2]["geo_id"] is None and got[2]["nearest_geo_id"] == "A" and got[2]["nearest_distance_m"] < 1e-3
    assert [got[i]["county_assignment_status"] for i in (1, 2, 3)] == ["assigned", "outside_county_boundaries", "no_coordinates"]
    assert 109_000 < got[4]["nearest_distance_m"] < 113_000
    with pytest.raises(ValueError, match="reference system"):
        G.point_in_polygon(points, square(spark, None), "i", "lon", "lat")
    shape = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1]]]}
    (tmp_path / "p.json").write_text(json.dumps({"crs": {"properties": {"name": "EPSG:4269"}}, "features": [{"properties": {"GEOID": "01001", "NAME": "X"}, "geometry": shape}]}))
    assert S.read_polygons(spark, str(tmp_path / "p.json")).first()["geo_id"] == "01001"


def test_decision_log(spark, tmp_path):
    path = tmp_path / "log.jsonl"
    for d in (S.decision("G1", "P1", "unsure", "ann"), S.decision("G1", "P1", "match", "bob"), *S.decide_group("G2", ["P3", "P4"], "P3", "ann")):
        S.append_decision(d, str(path))
    path.write_text(path.read_text() + "\n")
    log = S.read_decisions(spark, str(path))
    now = {r["pair_id"]: r["verdict"] for r in S.current_decisions(log).collect()}
    assert now == {"G1|P1": "match", "G2|P3": "match", "G2|P4": "no_match"}
    summary = S.log_summary(log).first().asDict()
    assert (summary["lines"], summary["decided"], summary["superseded"], summary["annotators"], summary["any_synthetic"]) == (4, 3, 1, ["ann", "bob"], False)
    assert Q.banner(summary) == "human labels" and Q.banner({}).startswith("NO LABELS")
    path.write_text('{"pair_id": "a|b", "verdict": "match"}\n{broken\n')
    with pytest.raises(ValueError, match="line 2"):
        S.read_decisions(spark, str(path))
    with pytest.raises(ValueError):
        S.decision("a", "b", "maybe", "x")
    with pytest.raises(ValueError):
        S.decision("a", "b", "match", " ")


def test_flow_order_and_marts(spark, tmp_path):
    flow = Flow()
    flow.step("b", lambda a: a.withColumn("x", F.lit(1)), "a")
    flow.step("c", lambda b: b.limit(1), "b")
    assert flow.order(["b"]) == ["b"] and flow.run({"a": spark.range(2)})["c"].count() == 1
    assert mart_flow().order()[-1] and len(mart_flow().steps) == 15
    lake = Lake(spark, LakeConfig(f"file://{tmp_path}/lake"))
    (tmp_path / "p.csv").write_text(CSV)
    lake.write(PLANTGEN.project(S.read_plantgen(spark, str(tmp_path / "p.csv"))), "raw", "plantgen")
    assert run_all(spark, LakeConfig(f"file://{tmp_path}/lake"), ["stg_plantgen"]) == ["stg_plantgen"]
    assert {r["start_year_status"] for r in spark.table("stg_plantgen").collect()} == {"unknown", "reported"}


PLANT_HEADER = (
    "Plant ID;Plant name (English);Other plant names (English);Owner;Owner PermID;Owner GEM ID;Parent;Municipality;Subnational unit (province/state);Country/area;Location address;Coordinates;Coordinate accuracy;"
    "Capacity operating status;Main production process;Main production equipment;Start date;Retired date;Nominal crude steel capacity (ttpa);Nominal BOF steel capacity (ttpa);"
    "Nominal EAF steel capacity (ttpa);Nominal iron capacity (ttpa);Workforce size"
).split(";")


def plant(i, name, state, country, at, accuracy="exact", **more):
    row = dict.fromkeys(PLANT_HEADER) | {"Plant ID": i, "Plant name (English)": name, "Subnational unit (province/state)": state, "Country/area": country, "Coordinates": at, "Coordinate accuracy": accuracy, "Owner": "Own Corp"}
    return list((row | more).values())


def test_from_files_to_marts(spark, tmp_path, capsys):
    workbook(tmp_path / "plants.xlsx", [
        PLANT_HEADER, plant("P1", "Alpha Works", "Connecticut", "United States", "39.5, -95.5"), plant("P1", "Alpha Works", "Connecticut", "United States", "39.5, -95.5"),
        plant("P2", "Beta", "Ohio", "United States", "41.0, -95.5", "approximate"), plant("P3", "Gamma", "Ontario", "Canada", "unknown"), plant("P4", "Delta", None, "France", "1, 1"),
    ])
    workbook(tmp_path / "made.xlsx", PRODUCTION_ROWS)
    (tmp_path / "plantgen.csv").write_text(CSV)
    (tmp_path / "old.csv").write_text("Corrected C/L,ID,FID,Year,Year List,Owner,Owner2,Main Product Line,Data ID,No. of furnaces,Power (KWh/Metric Ton)\n\"['Plain']\",1,1,2015,\"['2015']\",Own,,x,1,1,1\n")
    (tmp_path / "new.csv").write_text((tmp_path / "old.csv").read_text() + "\"['Plain']\",1,1,2016,\"['2016']\",Other Corp,,x,1,1,1\n")
    ring = lambda x: [[x, 39.0], [x + 1, 39.0], [x + 1, 40.0], [x, 40.0], [x, 39.0]]
    shapes = [{"properties": {"GEOID": g, "NAME": g, "STUSPS": "CT"}, "geometry": {"type": "Polygon", "coordinates": [ring(x)]}} for g, x in (("09001", -96.0), ("09003", -95.0))]
    (tmp_path / "counties.json").write_text(json.dumps({"crs": {"properties": {"name": "EPSG:4269"}}, "features": shapes}))
    at = lambda name: f"{tmp_path}/{name}"
    (tmp_path / "sources.json").write_text(json.dumps({
        "plantgen": at("plantgen.csv"), "gspt_plants": at("plants.xlsx"), "gspt_production": at("made.xlsx"), "counties": at("counties.json"),
        "furnace_years": [["BOF", "gspt_2024", at("old.csv")], ["BOF", "owner_filled_2025", at("new.csv")]],
    }))
    root = f"file://{tmp_path}/lake"
    main(["all", root, at("sources.json")])
    said = capsys.readouterr().out
    assert "raw.gspt_plants: 5 rows, snapshot 1" in said and "geo.counties: 2 rows, snapshot 1" in said
    lake = Lake(spark, LakeConfig(root))
    assert {t for n, t in lake.tables() if n == "marts"} == {n for n in mart_flow().steps if not n.startswith("stg_")}
    geo = lake.read("geo", "gspt_plant_county")
    got = {r["plant_id"]: r for r in geo.collect()}
    assert set(got) == {"P1", "P2", "P3"}
    assert (got["P1"]["county_fips"], got["P1"]["county_state"], got["P1"]["in_plantgen_county"], got["P1"]["nearest_county_fips"]) == ("09001", "CT", True, None)
    assert (got["P2"]["county_fips"], got["P2"]["nearest_county_fips"], got["P2"]["in_plantgen_county"]) == (None, "09001", False) and got["P2"]["nearest_county_distance_m"] > 100_000
    assert [got[p]["county_assignment_status"] for p in ("P1", "P2", "P3")] == ["assigned", "outside_county_boundaries", "no_coordinates"]
    report = N.geo_coverage(geo, lake.read("raw", "plantgen")).first().asDict()
    assert (report["plants_total"], report["plants_with_coordinates"], report["county_assigned"], report["county_unassigned"], report["matched_plantgen_county"]) == (3, 2, 1, 1, 1)
    assert [r["plant_id"] for r in N.without_coordinates(geo).collect()] == ["P3"]
    assert [tuple(r) for r in N.unassigned_by_country(geo).collect()] == [("United States", 1)]
    assert {tuple(r) for r in N.coverage_by_accuracy(geo).collect()} == {("exact", 2, 1, 1), ("approximate", 1, 0, 0)}
    pairs, bridge = lake.read("resolution", "gspt_plantgen_candidates"), lake.read("marts", "bridge_plant_xref")
    assert len(pairs.columns) == 10 and pairs.count() and Q.bridge_reconciles(bridge, pairs).passed and Q.verdict_columns(bridge).isEmpty()
    staged = spark.table("stg_furnace_year")
    assert Q.repeats_removed(lake.read("raw", "furnace_years"), staged, 0).isEmpty() and Q.repeats_removed(lake.read("raw", "furnace_years"), staged, 1).first()["removed"] == 0
    main(["geo", root])
    assert lake.snapshots("geo", "gspt_plant_county") == [1, 2] and lake.snapshots("marts", "dim_plant") == [1]
    with pytest.raises(ValueError, match="no source"):
        main(["ingest", root, at("sources.json"), "nothing"])


def test_assertions_of_the_build(spark):
    changes = spark.createDataFrame([("BOF-70", 2022, "a", "c", "excursion"), ("BOF-70", 2018, "a", "b", "excursion"), ("BOF-71", 2022, "a", "b", "refinement")], "facility_key string, change_year long, from_owner_raw string, to_owner_raw string, change_class string")
    assert [r["change_year"] for r in Q.transfer_survives(changes, "BOF-70", 2022).collect()] == [2022]
    assert Q.transfer_survives(changes.withColumn("change_class", F.lit("credible_transfer")), "BOF-70", 2022).isEmpty()
    facts = spark.createDataFrame([("BOF-1-x", "1"), ("BOF--x", None)], "furnace_key string, facility_id string")
    assert [r["furnace_key"] for r in Q.no_null_facility(facts).collect()] == ["BOF--x"]
    assert [r["column"] for r in Q.verdict_columns(facts.withColumn("is_match", F.lit(1))).collect()] == ["is_match"] and Q.verdict_columns(facts).isEmpty()


def test_nearest_by_blocks(spark):
    """Any number of blocks gives the plain search's answer, ties and points inside included."""
    ring = lambda x, y, r: [[{"x": x + a * r, "y": y + b * r} for a, b in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0))]]
    shapes = [(f"g{i}", i, ring(float(i * 7 % 20), float(i * 5 % 20), 1.0 + i % 3)) for i in range(30)] + [("same", 40, ring(0.0, 0.0, 1.0)), ("none", 41, [])]
    polygons = spark.createDataFrame(shapes, "geo_id string, position int, rings array<array<struct<x: double, y: double>>>")
    spots = [(2**53 + i, float(i * 3 % 23) - 1.5, float(i * 11 % 29) - 2.25) for i in range(60)] + [(5, None, 1.0)]
    points = spark.createDataFrame(spots, "i long, x double, y double")
    expected = {}
    for i, x, y in spots[:-1]:
        rings = [(g, p, G.rings_of(r)) for g, p, r in shapes if r]
        expected[i] = min((0.0 if G.inside(x, y, r) else round(G.edge_distance(x, y, r), 6), p, g) for g, p, r in rings)
    for block in (5_000_000, 40):
        got = {r["i"]: (r["nearest_distance_m"], r["nearest_geo_id"]) for r in G.nearest_polygon(points, polygons, "i", "x", "y", False, block).collect()}
        assert got == {i: (m, g) for i, (m, _, g) in expected.items()}
    nothing = G.nearest_polygon(points, polygons.limit(0), "i", "x", "y", False)
    assert nothing.where("nearest_geo_id is null and nearest_distance_m is null").count() == 60


def test_classes_stand_for_their_pairs(spark):
    """Pairs of classes, counted by their copies or expanded to their members, are the pairs of the records."""
    keys = [("1", "z", "s", "main st"), ("1", "y", "s", "main sq"), (None, None, None, "main st"), ("2", None, "s", None)]
    frame = lambda n, first: spark.createDataFrame([(f"{first}{i}", *keys[i % 4]) for i in range(n)], "unique_id string, county_fips string, zip5 string, state string, street string")
    l, r, columns = frame(11, "l"), frame(18, "r"), ("county_fips", "zip5", "state", "street")
    steps = [L.exact("zip5", "zip5"), L.edit_distance("street", "street")]
    compared = lambda a, b: L.block_pairs(a, b).select("*", *(c.gamma() for c in steps))
    whole = compared(l, r)
    pairs = compared(L.classes(l, columns), L.classes(r, columns))
    assert pairs.count() < whole.count() and L.patterns(pairs, steps) == L.patterns(whole, steps)
    small = L.members_of(compared(L.classes(l, columns, members=2), L.classes(r, columns, members=2)))
    names = ("unique_id_l", "unique_id_r", "blocked_by", "gamma_zip5", "gamma_street")
    assert sorted(map(str, small.select(*names).collect())) == sorted(map(str, whole.select(*names).collect()))
    assert [row["copies"] for row in L.classes(l, columns).orderBy("unique_id").collect()] == [3, 3, 3, 2]
    p = spark.createDataFrame([(0.1, 3), (0.5, 1), (None, 4)], "p double, n long")
    every = p.select("p", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    assert E.quantiles(p, "p", copies="n").collect() == E.quantiles(every, "p").collect()


def odd_records(spark, n, first, seed):
    """Records with nulls everywhere, repeated ones, and texts that few, but some, of the other side are near to."""
    draw = random.Random(seed)
    street = lambda: draw.choice([None, "", "ab", "12 main st", f"{draw.randint(10, 40)} main st", f"{draw.randint(1, 9)} oak road {first}", f"{first * 6} {draw.randint(1, 99)}"])
    maybe = lambda v, p=0.2: None if draw.random() < p else v
    rows = []
    for i in range(n):
        keys = [maybe(str(draw.randint(1, 3))), maybe(str(draw.randint(1, 4))), maybe(str(draw.randint(1, 2)))] if draw.random() > 0.1 else [None] * 3
        rows.append((f"{first}{i}", *keys, street(), maybe(draw.choice([0, 1970, 1972, 1975, 1990])), maybe(str(draw.randint(1, 3))), maybe(draw.choice([0.0, 400.0, 500.0, 4000.0, 5001.0, float("nan"), -1.0]))))
    kinds = "unique_id string, county_fips string, zip5 string, state string, street string, start_year long, county_fips_effective string, county_distance_m double"
    return spark.createDataFrame(rows, kinds)


def odd_sides(spark):
    l, r = odd_records(spark, 60, "l", 1), odd_records(spark, 80, "r", 2)
    stepped = [L.classes(QU.stepped(f), QU.COMPARED) for f in (l, r)]
    return l, r, stepped, L.block_pairs(l, r).select("*", *(c.gamma() for c in QU.comparisons()))


def test_near_texts(spark):
    """The similarity join gives exactly the pairs within the distance, short and empty texts and hot pieces too."""
    draw = random.Random(5)
    words = lambda n: sorted({"".join(draw.choice("ab1é") for _ in range(draw.randint(0, 9))) for _ in range(n)} | {"", "a", "12", "12345678"})
    a, b = words(80), words(90)
    l, r = (spark.createDataFrame([(x,) for x in [*v, None, v[0]]], "t string") for v in (a, b))
    for limit in (1, 3):
        every = l.select(F.col("t").alias("l")).distinct().crossJoin(r.select(F.col("t").alias("r")).distinct()).where(F.levenshtein("l", "r") <= limit)
        got = K.near_values(l, r, "t", limit).collect()
        assert len(got) == len(set(got)) and {tuple(x) for x in got} == {tuple(x) for x in every.collect()}


def test_pairs_are_counted_by_kind(spark):
    """Counts of gammas, beside equal keys too, are those of the pairs themselves, and no pair is made."""
    _, _, stepped, pairs = odd_sides(spark)
    counted = K.counted_pairs(*stepped, **QU.KINDS).select("*", *(c.gamma() for c in QU.comparisons()))
    by = [*QU.GAMMAS, *((F.coalesce(F.col(f"{k}_l") == F.col(f"{k}_r"), F.lit(False))).alias(k) for k in L.KEYS)]
    rows = lambda df: sorted(tuple(x) for x in df.groupBy(*by).agg(L.number(df)).where("n <> 0").collect())
    assert rows(counted) == rows(pairs)
    assert len({x[1] for x in rows(pairs)}) == 5
    assert L.patterns(counted, QU.comparisons()) == L.patterns(pairs, QU.comparisons())
    many = [f.withColumn("copies", F.col("copies") * 1_000_000) for f in stepped]
    whole = K.counted_pairs(*many, **QU.KINDS)
    assert whole.agg(L.number(whole)).first()[0] == pairs.count() * 10**12


@pytest.mark.parametrize("own", ["l", "r"])
def test_pairs_are_counted_by_class(spark, own):
    """Every class has the scores of its own pairs, as many as each has, whether a text is near or not."""
    l, r, stepped, pairs = odd_sides(spark)
    valued = lambda p: QU.scored(p.select("*", *(c.gamma() for c in QU.comparisons())), *p.columns)
    mine, counts = K.counted_by_class(*stepped, own, **QU.KINDS, valued=valued, value="match_probability")
    expected = {}
    for row in QU.scored(pairs, f"unique_id_{own}").collect():
        expected.setdefault(row[0], Counter())[row[1]] += 1
    got = {}
    for row in counts.collect():
        got.setdefault(row[0], Counter())[row[1]] += row[2]
    alike = (*QU.KINDS["equal"], *QU.KINDS["plain"], "street", "near")
    every = K.placed(QU.stepped({"l": l, "r": r}[own]), K.near_values(*stepped, "street", 3), own, "street", 3)
    of = mine.select(*(F.col(c).alias(f"of_{c}") for c in alike), F.col("unique_id").alias("first"), "copies")
    placed = every.join(of, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in alike]).select("unique_id", "first").collect()
    assert len(placed) == every.count() == mine.agg(F.sum("copies")).first()[0]
    assert {i: got.get(first) for i, first in placed} == {i: expected.get(i) for i, _ in placed}


def shuffled(spark, df):
    """Rows that a run of the frame writes to exchanges."""
    sc = spark.sparkContext
    store, jvm = sc._jsc.sc().statusStore(), sc._jvm
    written = lambda: {s.stageId(): s.shuffleWriteRecords() for s in map(stages().apply, range(stages().size()))}
    stages = lambda: store.stageList(None, False, False, sc._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    before = set(written())
    n = df.count()
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return n, sum(v for k, v in written().items() if k not in before)


def tables_with_repeats(folder):
    """Suppliers and customers of which some share a key, and two rows are equal throughout."""
    duckdb.sql("SELECT i % 23 AS s_suppkey, 'Supplier#' || i % 4 AS s_name, (i % 7)::INT AS s_nationkey, (i * 37 % 900)::DOUBLE AS s_acctbal FROM (SELECT unnest(range(30)) AS i UNION ALL SELECT 29) ORDER BY i").write_parquet(f"{folder}/supplier.parquet")
    duckdb.sql("SELECT i % 170 AS c_custkey, 'Customer#' || i % 6 AS c_name, (i % 9)::INT AS c_nationkey, (i * 53 % 1300)::DOUBLE AS c_acctbal, 'x' AS c_mktsegment FROM (SELECT unnest(range(200)) AS i UNION ALL SELECT 5) ORDER BY i").write_parquet(f"{folder}/customer.parquet")


def same_as_sql(spark, folder, name):
    c = duckdb.connect()
    for f in ("supplier", "customer"):
        c.execute(f"CREATE VIEW {f} AS SELECT * FROM '{folder}/{f}.parquet'")
    cursor = c.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    return Counter(map(tuple, QUERIES[name](spark, str(folder)).select(*columns).collect())) == Counter(cursor.fetchall())


def tables_with_names(folder):
    """Suppliers and customers of names of their own, of which a few are near to one of the other side."""
    duckdb.sql("SELECT i::BIGINT AS s_suppkey, CASE WHEN i % 40 = 3 THEN 'Cust#' || i * 7 ELSE 'Supplier#' || i END AS s_name, (i * 7 % 25)::INT AS s_nationkey, (i * 37 % 9000)::DOUBLE AS s_acctbal FROM (SELECT unnest(range(300)) AS i)").write_parquet(f"{folder}/supplier.parquet")
    duckdb.sql("SELECT i::BIGINT AS c_custkey, CASE WHEN i % 90 = 5 THEN 'Cust#' || i ELSE 'Customer#' || i END AS c_name, (i * 11 % 25)::INT AS c_nationkey, (i * 53 % 9900)::DOUBLE AS c_acctbal, 'x' AS c_mktsegment FROM (SELECT unnest(range(4000)) AS i)").write_parquet(f"{folder}/customer.parquet")


#: Queries about pairs whose rows are fewer than these, with the frame that they count from.
COUNTED = {
    "q_gamma_patterns": lambda spark, folder: QU.class_gammas(spark, folder),
    "q_overall_quantiles": lambda spark, folder: QU.scored(QU.class_gammas(spark, folder), "copies_l"),
    "q_em_weights": lambda spark, folder: QU.class_gammas(spark, folder),
    "q_by_crowding": lambda spark, folder: QU.scored_classes(spark, folder, "r")[1],
    "q_watched_areas": lambda spark, folder: QU.scored_classes(spark, folder, "r")[1],
    "q_outcomes": lambda spark, folder: QU.scored_classes(spark, folder, "l")[1],
}


@pytest.mark.parametrize("name", COUNTED)
def test_pairs_are_counted_not_made(spark, tmp_path, name):
    """Records that all differ are counted by kind: no row is made for each pair of them, and the results are the SQL's."""
    tables_with_names(tmp_path)
    if name in ORACLE_SQL:
        assert same_as_sql(spark, tmp_path, name)
    assert COUNTED[name](spark, str(tmp_path)).count() < QU.gammas(*QU.records(spark, str(tmp_path))).count() / 3


@pytest.mark.parametrize("name", ["q_gamma", "q_score_fixed"])
def test_far_names_make_no_classes(spark, tmp_path, name):
    """All pairs of records of names of their own, from classes that only near names tell apart."""
    tables_with_names(tmp_path)
    assert same_as_sql(spark, tmp_path, name)
    l, r = QU.records(spark, str(tmp_path))
    few = [f.withColumns({"start_year": F.lit(None).cast("long"), "zip5": F.lit("1")}) for f in (l.where("street not like 'cust %'"), r)]
    pairs = QU.placed_gammas(*few)
    assert pairs.count() < QU.gammas(*few).count() / 3
    assert pairs.agg(F.sum(F.size("ids_l").cast("long") * F.size("ids_r"))).first()[0] == L.block_pairs(*few).count()


def test_labelled_pairs_are_not_moved(spark, tmp_path):
    """Decisions on pairs with ids of their own are not shuffled with the pairs; with repeated ids, each decision still meets each pair."""
    folder = "/root/testdata/sf0.01"
    decided, moved = shuffled(spark, QUERIES["q_labelled_pairs"](spark, folder))
    assert decided > 7000 and moved < 2 * decided
    tables_with_repeats(tmp_path)
    assert same_as_sql(spark, tmp_path, "q_labelled_pairs")


def test_pairs_of_a_key_are_dealt_and_written_in_order(spark, tmp_path):
    """Without broadcasts, a key's pairs come from several tasks, and the left id varies fastest, which files of pairs need to stay small."""
    duckdb.sql("SELECT i AS s_suppkey, 'S' AS s_name, (i % 3)::INT AS s_nationkey, (i % 3 * 700)::DOUBLE AS s_acctbal FROM range(240) t(i)").write_parquet(f"{tmp_path}/supplier.parquet")
    duckdb.sql("SELECT i AS c_custkey, 'C' AS c_name, (i % 3)::INT AS c_nationkey, (i % 2 * 700)::DOUBLE AS c_acctbal, 'x' AS c_mktsegment FROM range(1, 301) t(i)").write_parquet(f"{tmp_path}/customer.parquet")
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        rows = QUERIES["q_blocking"](spark, str(tmp_path)).select("unique_id_r").collect()
        assert len(rows) > 20_000 and sum(a != b for a, b in zip(rows, rows[1:], strict=False)) < len(rows) / 10
        assert same_as_sql(spark, tmp_path, "q_blocking")
        l, r = (spark.range(n).selectExpr("CAST(id AS STRING) AS unique_id", "CAST(id DIV 1000 AS STRING) AS county_fips", "CAST(id DIV 1000 AS STRING) AS zip5", "CAST(id DIV 1000 AS STRING) AS state") for n in (40, 50))
        tasks = L.block_pairs(l, r).groupBy(F.spark_partition_id()).count().collect()
        assert sum(t["count"] for t in tasks) == 2000 and max(t["count"] for t in tasks) < 1000
    finally:
        spark.conf.set(setting, before)


def test_nearest_by_less_than_rounding(spark):
    """Of two polygons whose distances round alike, the nearer one wins; equal distances go to the smaller position, from either end of an edge."""
    ring = lambda *corners: [[{"x": x, "y": y} for x, y in corners]]
    shapes = [("far", 0, ring((0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0))), ("near", 1, ring((4.0, 0.0), (8.0, 0.0), (8.0, 4.0), (4.0, 4.0)))]
    slanted = [("b", 1, ring((20.0, 0.3), (21.0, 1.0), (22.0, 0.0))), ("a", 0, ring((22.0, 0.0), (21.0, 1.0), (20.0, 0.3)))]
    polygons = spark.createDataFrame(shapes + slanted, "geo_id string, position int, rings array<array<struct<x: double, y: double>>>")
    points = spark.createDataFrame([(1, 4.0008, 4.8), (2, 3.9992, 4.8), (3, 4.0, 4.8), (4, 20.4, 2.1), (5, 21.7, 1.9)], "i long, x double, y double")
    for block in (5_000_000, 4):
        got = {r["i"]: (r["nearest_geo_id"], r["nearest_distance_m"]) for r in G.nearest_polygon(points, polygons, "i", "x", "y", False, block).collect()}
        assert [got[i] for i in (1, 2, 3)] == [("near", 0.8), ("far", 0.8), ("far", 0.8)] and got[4][0] == got[5][0] == "a"


def test_streams(spark, tmp_path):
    root = tmp_path / "raw"
    seen = []
    for v in ("v1", "v2"):
        (root / f"source_version={v}").mkdir(parents=True)
        (root / f"source_version={v}" / "f.csv").write_text("x")
        on_new_vintage(spark, str(root), str(tmp_path / "check"), seen.append).awaitTermination()
    (root / "source_version=v1" / "late.csv").write_text("x")
    on_new_vintage(spark, str(root), str(tmp_path / "check"), seen.append).awaitTermination()
    assert seen == ["v1", "v2"] == vintages(spark, str(root))  # a late file of a known vintage fires nothing
    logs = tmp_path / "logs"
    logs.mkdir()
    for i, verdict in enumerate(("unsure", "match")):
        (logs / f"{i}.jsonl").write_text(json.dumps(S.decision("a", "b", verdict, "x")) + "\n")
        decisions_by_pair(spark, str(logs), str(tmp_path / "check2"), str(tmp_path / "out")).awaitTermination()
    assert [r["verdict"] for r in latest_decisions(spark, str(tmp_path / "out")).collect()] == ["match"]
    two = [S.decision("a", "b", v, "x", decided_at=at) for v, at in (("unsure", "2030"), ("no_match", "2020"))]
    (logs / "2.jsonl").write_text("\n".join(map(json.dumps, two)) + "\nnot json\n")
    decisions_by_pair(spark, str(logs), str(tmp_path / "check2"), str(tmp_path / "out")).awaitTermination()
    assert [r["verdict"] for r in latest_decisions(spark, str(tmp_path / "out")).collect()] == ["no_match"]  # the last line, whatever its time
    assert len(batches_of(spark, str(tmp_path / "out"))) == 2  # this snapshot and the one before
    (tmp_path / "out" / "batch-2" / "_SUCCESS").unlink()  # a driver lost while it wrote
    assert [r["verdict"] for r in latest_decisions(spark, str(tmp_path / "out")).collect()] == ["match"]


def test_pointers_are_never_replaced(spark, tmp_path):
    lake = Lake(spark, LakeConfig(str(tmp_path)))
    for n in range(4):
        lake.write(spark.range(n), "raw", "t")
    assert lake.read("raw", "t").count() == 3 and len(lake.pointers("raw", "t")) == 2
    (tmp_path / "raw" / "t" / "current-9.json.new").write_text("half a poin")
    assert lake.read("raw", "t").count() == 3
    lake.register("raw", "t", 2)
    assert lake.read("raw", "t").count() == 1


def test_sheets_are_found_by_their_relation(tmp_path):
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(tmp_path / "w.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="B" sheetId="2" r:id="rId7"/><sheet name="A" sheetId="1" r:id="rId5"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId5" Target="worksheets/sheet1.xml"/><Relationship Id="rId7" Target="/xl/worksheets/sheet3.xml"/></Relationships>')
        for n, text in ((1, "a"), (3, "b")):
            z.writestr(f"xl/worksheets/sheet{n}.xml", f'<worksheet xmlns="{main}"><sheetData><row><c t="inlineStr"><is><t>{text}</t></is></c></row></sheetData></worksheet>')
    data = (tmp_path / "w.xlsx").read_bytes()
    assert [list(S.sheet_rows(data, n)) for n in ("A", "B", None)] == [[["a"]], [["b"]], [["b"]]]
    assert S.production_columns([None, "2019"], ["Plant ID", " Crude  Steel  Production 2019 (TTPA) "]) == [(1, 2019, "crude_steel")]


def test_queues_and_labels(spark, tmp_path):
    rows = [(f"G{i}", f"P{i}", i / 40, "ambiguous" if 4 <= i < 36 else "high_confidence" if i >= 36 else "low_confidence") for i in range(40)]
    pairs = E.with_pair_id(spark.createDataFrame(rows, "unique_id_l string, unique_id_r string, match_probability double, stratum string"))
    drawn = E.queue(pairs, 7, {"high_confidence": 2, "low_confidence": 2})
    got = [(r["stratum"], r["pair_id"]) for r in drawn.collect()]
    assert Counter(s for s, _ in got) == {"ambiguous": 32, "high_confidence": 2, "low_confidence": 2} and got == sorted(got, key=lambda x: (["ambiguous", "high_confidence", "low_confidence"].index(x[0]), x[1]))
    E.export_queue(drawn, str(tmp_path / "q"))
    assert spark.read.option("header", True).csv(str(tmp_path / "q")).count() == 36
    made = E.synthetic_labels(pairs, 3, error=0.0)
    assert made.where("not synthetic").count() == 0 and made.where("verdict = 'unsure'").count() == 5 and made.where("verdict = 'match'").count() == 17
    assert E.synthetic_labels(pairs, 3, error=1.0).where("verdict = 'match'").count() == 18
    joined = E.labelled_pairs(made, pairs, drawn)
    assert joined.count() == 40 and joined.where("stratum is null").count() == 4
    few = L.random_pairs(pairs.selectExpr("unique_id_l AS unique_id"), pairs.selectExpr("unique_id_r AS unique_id"), max_pairs=100)
    assert 90 < few.count() <= 100 and few.distinct().count() == few.count()
    gspt = spark.createDataFrame([("G1", *"abcdefgh"), ("G1", *"bbcdefgh")], ["plant_id", *E.LEFT_FIELDS])
    plantgen = spark.createDataFrame([("P1", *"abcdefgh")], ["plant_id", *E.RIGHT_FIELDS])
    seen = E.readable(pairs, gspt, plantgen)
    assert seen.count() == 40 and [r["gspt_name"] for r in seen.where("gspt_name is not null").collect()] == ["a"]


def test_layers_do_not_import_the_corpus_operators():
    from pathlib import Path

    for f in (Path(__file__).parents[1] / "millrace").rglob("*.py"):
        if "llm" not in f.parts:
            assert "millrace.llm" not in f.read_text()
