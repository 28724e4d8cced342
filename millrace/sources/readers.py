"""Readers: text-typed CSV, workbook sheets, two-row headers, polygons, decision logs, vintage directories."""

from __future__ import annotations

import io
import json
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from millrace.functions import text as T
from millrace.functions.udfs import parse_alias_list
from millrace.operators.rows import align_vintages, with_row_number
from millrace.sources.contracts import require

# Headers that no rule splits right.
PLANTGEN_COLUMNS = {
    "PlantID": "plant_id", "PlantName": "plant_name", "County": "county", "State": "state", "StCntyFIPS": "st_cnty_fips", "StateFIPS": "state_fips", "CntyFIPS": "cnty_fips",
    "MSA83": "msa83", "MSA93": "msa93", "PMSA83": "pmsa83", "PMSA93": "pmsa93", "PlantStartYr": "plant_start_yr", "PhoneNumber": "phone_number", "StreetAddress": "street_address",
    "City": "city", "ZipCode": "zip_code", "AISICode": "aisi_code", "ShutdownYr": "shutdown_yr", "SpecialtyGrade": "specialty_grade",
}
# What the production sheet measures.
METRICS = {"Crude steel": "crude_steel", "BOF steel": "bof_steel", "EAF steel": "eaf_steel", "OHF steel": "ohf_steel", "Iron": "iron", "BF": "bf", "DRI": "dri"}


def canonical_name(header: str) -> str:
    return re.sub(r"[^0-9a-zA-Z]+", "_", header).strip("_").lower()


def canonicalise(df: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    names = [(overrides or {}).get(c, canonical_name(c)) for c in df.columns]
    if doubles := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"several headers become {doubles}: {df.columns}")
    return df.toDF(*names)


def read_text_csv(spark: SparkSession, path: str | Sequence[str], null_tokens: Sequence[str] = ("",), overrides: dict[str, str] | None = None) -> DataFrame:
    """Every column as text under its canonical name, so that identifiers keep their zeros; null tokens become null."""
    header = spark.read.option("header", True).csv(path).columns
    schema = StructType([StructField(c, StringType()) for c in header])
    raw = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("multiLine", True).option("escape", '"').csv(path)
    numbered = canonicalise(raw, overrides)
    return numbered.select(*(T.null_tokens(F.col(c), list(null_tokens)).alias(c) for c in numbered.columns), F.col("_metadata.file_path").alias("source_file"))


def read_plantgen(spark: SparkSession, path: str) -> DataFrame:
    df = read_text_csv(spark, path, overrides=PLANTGEN_COLUMNS)
    require(df, list(PLANTGEN_COLUMNS.values()), "plantgen")
    whole = ["plant_start_yr", "shutdown_yr", "specialty_grade"]
    texts = {c: T.clean_text(F.col(c)) for c in PLANTGEN_COLUMNS.values() if c not in whole}
    codes = {"zip_code": T.zip5(F.col("zip_code")), "st_cnty_fips": T.pad_fips(F.col("st_cnty_fips"), 5), "state_fips": T.pad_fips(F.col("state_fips"), 2), "cnty_fips": T.pad_fips(F.col("cnty_fips"), 3)}
    return df.withColumns({**texts, **codes, **{c: T.leading_int(F.col(c)) for c in whole}})


# ---------------------------------------------------------------- workbooks

SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def sheet_rows(data: bytes, sheet: str | None = None) -> Iterator[list[str | None]]:
    """Rows of a workbook's sheet, every cell as text, from the zipped XML alone."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{SHEET}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{SHEET}si")]
        sheets = {s.get("name"): s.get(RELATION) for s in ET.fromstring(z.read("xl/workbook.xml")).iter(f"{SHEET}sheet")}
        if sheet is not None and sheet not in sheets:
            raise ValueError(f"no sheet {sheet!r}; there are {list(sheets)}")
        related = sheets[sheet] if sheet else next(iter(sheets.values()), None)
        part = "worksheets/sheet1.xml"  # without relations there is one sheet
        if "xl/_rels/workbook.xml.rels" in names:  # the order of names says nothing about the numbers of parts
            targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
            part = targets.get(related, part)
        with z.open(part.lstrip("/") if part.startswith("/") else f"xl/{part}") as f:
            for _, row in ET.iterparse(f):
                if row.tag != f"{SHEET}row":
                    continue
                cells: dict[int, str | None] = {}
                for at, c in enumerate(row.iter(f"{SHEET}c")):
                    letters = re.match(r"[A-Z]+", c.get("r") or "")
                    if letters:
                        at = 0
                        for ch in letters[0]:
                            at = at * 26 + ord(ch) - 64
                        at -= 1
                    value, kind = c.find(f"{SHEET}v"), c.get("t")
                    if kind == "inlineStr":
                        cells[at] = "".join(t.text or "" for t in c.iter(f"{SHEET}t"))
                    elif value is not None and value.text is not None:
                        cells[at] = shared[int(value.text)] if kind == "s" else value.text
                yield [cells.get(i) for i in range(max(cells, default=-1) + 1)]
                row.clear()


class WorkbookSource(DataSource):
    """``spark.read.format("millrace_workbook").option("path", ...).option("sheet", ...)``: row number and cells."""

    @classmethod
    def name(cls) -> str:
        return "millrace_workbook"

    def schema(self) -> str:
        return "source_row long, cells array<string>"

    def reader(self, schema: StructType) -> DataSourceReader:
        return WorkbookReader(self.options)


class WorkbookReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.sheet = options["path"], options.get("sheet")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(self.path)]

    def read(self, partition: InputPartition) -> Iterator[Row]:
        from pyarrow import fs

        disk, at = fs.FileSystem.from_uri(partition.value if "://" in partition.value else f"file://{partition.value}")
        with disk.open_input_stream(at) as f:
            for i, cells in enumerate(sheet_rows(f.read(), self.sheet)):
                yield Row(source_row=i, cells=cells)


def read_sheet(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """A sheet with one header row: text columns under canonical names, and source_row from 1."""
    spark.dataSource.register(WorkbookSource)
    reader = spark.read.format("millrace_workbook").option("path", path)
    grid = (reader.option("sheet", sheet) if sheet else reader).load()
    header = grid.where("source_row = 0").first()
    if header is None:
        raise ValueError(f"{path} is empty")
    columns = [F.try_element_at("cells", F.lit(i + 1)).alias(h) for i, h in enumerate(header["cells"]) if h]
    return canonicalise(grid.where("source_row > 0").select("source_row", *columns))


def read_gspt_plants(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    df = read_sheet(spark, path, sheet)
    require(df, ["plant_id", "plant_name_english", "country_area", "coordinates"], "gspt_plants")
    lat, lon = T.split_coordinates(F.col("coordinates"))
    texts = {c: T.clean_text(F.col(c)) for c in df.columns if c != "source_row"}
    return df.withColumns(texts).withColumns({"latitude": lat, "longitude": lon, "has_coordinates": lat.isNotNull() & lon.isNotNull(), "source_file": F.lit(path)})


LABEL = re.compile(r"^(?P<metric>.+?)\s+production\s+(?P<year>\d{4})\s*\(ttpa\)$", re.I)


def production_columns(banner: Sequence[str | None], labels: Sequence[str | None]) -> list[tuple[int, int, str]]:
    """(position, year, metric) of the value columns; a year over a label that says another is an error."""
    if "Plant ID" not in labels:
        raise ValueError("the header has no 'Plant ID'")
    year: str | None = None
    known = {k.lower(): v for k, v in METRICS.items()}
    found = []
    for i, label in enumerate(labels):
        over = banner[i] if i < len(banner) else None
        year = over if over not in (None, "") else year
        if not label or label in ("Plant ID", "Plant name (English)"):
            continue
        m = LABEL.match(label.strip())
        metric = known.get(" ".join(m["metric"].lower().split())) if m else None
        if not m or not metric:
            raise ValueError(f"unknown production column {label!r}")
        if year is None or int(float(year)) != int(m["year"]):
            raise ValueError(f"the year {year} stands over {label!r}")
        found.append((i, int(m["year"]), metric))
    return found


def read_production(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """A sheet whose first row has years and whose second has labels, in long form; blank cells give no row."""
    spark.dataSource.register(WorkbookSource)
    reader = spark.read.format("millrace_workbook").option("path", path)
    grid = (reader.option("sheet", sheet) if sheet else reader).load()
    head = {r["source_row"]: r["cells"] for r in grid.where("source_row < 3").collect()}
    if len(head) < 3:
        raise ValueError(f"{path} has fewer than 3 rows")
    return unpivot_production(grid.where("source_row > 1"), head[0], head[1]).withColumn("source_file", F.lit(path))


def unpivot_production(grid: DataFrame, banner: Sequence[str | None], labels: Sequence[str | None]) -> DataFrame:
    columns = production_columns(banner, labels)
    cell = lambda name: F.try_element_at("cells", F.lit(labels.index(name) + 1)) if name in labels else F.lit(None).cast("string")
    values = F.explode(F.array(*(F.struct(F.lit(y).cast("bigint").alias("year"), F.lit(m).alias("metric"), F.try_element_at("cells", F.lit(i + 1)).alias("value_raw")) for i, y, m in columns)))
    long = grid.select(cell("Plant ID").alias("plant_id"), cell("Plant name (English)").alias("plant_name_english"), values.alias("v")).select("plant_id", "plant_name_english", "v.*")
    kept = long.where(F.col("plant_id").isNotNull() & T.clean_text(F.col("value_raw")).isNotNull())
    return kept.withColumn("value_ttpa", T.to_float(F.col("value_raw")))


# ---------------------------------------------------------------- furnace vintages

FURNACE_COLUMNS = ("year", "id", "corrected_c_l", "year_list")


def read_furnaces(spark: SparkSession, kind: str, version: str, path: str) -> DataFrame:
    raw = read_text_csv(spark, path, ("", "NA", "N/A"))
    require(raw, FURNACE_COLUMNS, f"{kind} {version}")
    text = lambda c: F.col(c) if c in raw.columns else F.lit(None).cast("string")
    facility, fid = T.drop_float_suffix(T.clean_text(text("id"))), T.drop_float_suffix(T.clean_text(text("fid")))
    year = T.leading_int(text("year"))
    numbered = with_row_number(raw, "source_file")
    key = F.concat(F.lit(f"{kind}:"), facility)
    return numbered.select(
        key.alias("furnace_key"), F.lit(kind).alias("furnace_type"), facility.alias("facility_id"), fid.alias("fid"), year.alias("year"),
        T.clean_text(text("owner")).alias("owner"), text("owner").alias("owner_verbatim"), T.clean_text(text("main_product_line")).alias("main_product_line"), T.clean_text(text("data_id")).alias("data_id"),
        text("no_of_furnaces").alias("no_of_furnaces_raw"), T.leading_int(text("no_of_furnaces")).alias("no_of_furnaces"), T.to_float(text("power_kwh_metric_ton")).alias("power_kwh_per_metric_ton"),
        parse_alias_list(text("corrected_c_l")).alias("corrected_cl"), parse_alias_list(text("year_list")).alias("year_list"),
        T.replacement_char(text("owner")).alias("owner_has_replacement_char"), T.not_melting(text("no_of_furnaces")).alias("not_melting"),
        F.concat_ws(":", key, year.cast("string"), F.coalesce(fid, F.lit("-"))).alias("__key"), F.lit(version).alias("source_version"), "source_file", "source_row",
    ).withColumn("align_key", F.when(F.col("furnace_key").isNotNull() & F.col("year").isNotNull(), F.col("__key"))).drop("__key")


def read_furnace_years(spark: SparkSession, files: Sequence[tuple[str, str, str]], clean_version: str = "gspt_2024") -> DataFrame:
    """All vintages, (kind, version, path) each, one below the other and aligned with the intact one."""
    frames = [read_furnaces(spark, *f) for f in files]
    if not frames:
        raise ValueError("no furnace file is named")
    return align_furnaces(reduce(DataFrame.unionByName, frames), clean_version)


def align_furnaces(frame: DataFrame, clean_version: str) -> DataFrame:
    """Names as the intact vintage spells them, and flags for what the other one lost."""
    clean = frame.where(F.col("source_version") == clean_version)
    joined = align_vintages(frame, clean, "align_key", ["corrected_cl"], ["source_file", "source_row"])
    found = F.col("alignment_status") == "aligned"
    own, other = F.col("corrected_cl"), F.col("corrected_cl_clean")
    flags = {
        "encoding_degraded": F.when(found, T.any_pair(other, own, T.is_degraded)).otherwise(F.lit(False)),
        "encoding_lossy": F.when(found, T.any_pair(other, own, T.is_lossy)).otherwise(F.lit(False)),
        "corrected_cl_name_version": F.when(found, F.lit(clean_version)).otherwise(F.col("source_version")),
        "corrected_cl_clean": F.coalesce(other, own),
    }
    return joined.withColumns(flags)


def encoding_audit(frame: DataFrame) -> DataFrame:
    """Counts of damage: it warns and never stops a load."""
    return frame.agg(
        F.count("*").alias("rows"), F.count_if("encoding_degraded").alias("degraded_rows"), F.count_if("encoding_lossy").alias("lossy_rows"),
        F.count_distinct(F.when(F.col("encoding_degraded"), F.struct("furnace_type", "facility_id"))).alias("degraded_facilities"), F.count_if("owner_has_replacement_char").alias("damaged_owners"),
    )


# ---------------------------------------------------------------- polygons, logs, directories


def read_polygons(spark: SparkSession, path: str, id_key: str = "GEOID", name_key: str = "NAME", state_key: str = "STUSPS") -> DataFrame:
    """GeoJSON polygons and multipolygons; a file without a reference system is refused."""
    data = json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))
    crs = (data.get("crs") or {}).get("properties", {}).get("name") or data.get("crs_name")
    if not crs:
        raise ValueError(f"{path} names no coordinate reference system")
    rows = []
    for i, f in enumerate(data["features"]):
        shape = f["geometry"]
        parts = [shape["coordinates"]] if shape["type"] == "Polygon" else shape["coordinates"]
        rows.append((str(f["properties"][id_key]), f["properties"].get(name_key), f["properties"].get(state_key), i, [[{"x": float(p[0]), "y": float(p[1])} for p in ring] for part in parts for ring in part], crs))
    return spark.createDataFrame(rows, "geo_id string, name string, state string, position int, rings array<array<struct<x: double, y: double>>>, crs string")


VERDICTS = ("match", "no_match", "unsure")
DECISION = "pair_id string, unique_id_l string, unique_id_r string, verdict string, annotator string, probability_shown double, stratum string, queue_seed bigint, notes string, decided_at string, synthetic boolean"


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """The log with line numbers; blank lines are skipped, a corrupt one is an error with its number."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"))
    numbered = with_row_number(lines, "__file", "__block", "line").where(F.trim("value") != "")
    parsed = numbered.select("line", "value", F.from_json("value", DECISION + ", _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}).alias("d"))
    bad = parsed.where("d is null or d._corrupt is not null or d.pair_id is null").orderBy("line").first()
    if bad is not None:
        raise ValueError(f"{path}, line {bad['line']}: not a decision")
    return parsed.select("line", "d.*").drop("_corrupt")


def decision(left: str, right: str, verdict: str, annotator: str, **more: object) -> dict[str, object]:
    if verdict not in VERDICTS:
        raise ValueError(f"the verdict {verdict!r} is none of {VERDICTS}")
    if not annotator.strip():
        raise ValueError("a decision needs an annotator")
    return {"pair_id": f"{left}|{right}", "unique_id_l": left, "unique_id_r": right, "verdict": verdict, "annotator": annotator, "synthetic": False, "decided_at": datetime.now(timezone.utc).isoformat()} | more


def append_decision(record: dict[str, object], path: str) -> None:
    with open(path, "a", encoding="utf-8") as f:
        f.write(json.dumps(record, ensure_ascii=False) + "\n")


def decide_group(left: str, rights: Sequence[str], chosen: str | None, annotator: str, **more: object) -> list[dict[str, object]]:
    """Decisions on all candidates of a record at once: the chosen one matches, the others don't."""
    return [decision(left, r, "match" if r == chosen else "no_match", annotator, **more) for r in rights]


def current_decisions(log: DataFrame) -> DataFrame:
    """The latest line of each pair."""
    rest = [c for c in log.columns if c != "pair_id"]
    return log.groupBy("pair_id").agg(F.max_by(F.struct(*rest), "line").alias("d")).select("pair_id", "d.*")


def log_summary(log: DataFrame) -> DataFrame:
    now = current_decisions(log)
    verdicts = [F.count_if(F.col("verdict") == v).alias(v) for v in VERDICTS]
    state = now.agg(F.count("*").alias("decided"), *verdicts, F.array_sort(F.collect_set("annotator")).alias("annotators"), F.coalesce(F.bool_and("synthetic"), F.lit(False)).alias("all_synthetic"), F.coalesce(F.bool_or("synthetic"), F.lit(False)).alias("any_synthetic"))
    return log.agg(F.count("*").alias("lines")).crossJoin(state).withColumn("superseded", F.col("lines") - F.col("decided"))


READERS: dict[str, Callable[..., DataFrame]] = {"plantgen": read_plantgen, "gspt_plants": read_gspt_plants, "gspt_production": read_production, "furnace_years": read_furnaces}
