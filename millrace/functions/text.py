"""Column functions over messy text.  All of them run in the JVM; null in, null out unless said otherwise."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
MIN_YEAR, MAX_YEAR = 1700, 2030

# Spellings of "not recorded".
SENTINELS = ["", "unknown", "n/a", "na", "none", "null", "nan", "-"]
UNKNOWN_WORDS = ["unknown", "n/a", "na", "none", "-"]
# Legal forms that carry no identity.
LEGAL_FORMS = r"\b(inc|incorporated|corp|corporation|co|company|ltd|limited|llc|lp|plc|group|holdings?|sa|ag|nv|bv)\b"
# Abbreviations of street words and directions.
STREET_TOKENS = {
    "street": "st", "str": "st", "road": "rd", "avenue": "ave", "av": "ave", "boulevard": "blvd", "drive": "dr", "highway": "hwy", "parkway": "pkwy", "lane": "ln",
    "route": "rt", "rte": "rt", "north": "n", "south": "s", "east": "e", "west": "w", "northeast": "ne", "northwest": "nw", "southeast": "se", "southwest": "sw", "post office": "po",
}
# Subdivisions of the United States and Canada with their postal codes.
SUBDIVISIONS = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA", "colorado": "CO", "connecticut": "CT", "delaware": "DE", "district of columbia": "DC",
    "florida": "FL", "georgia": "GA", "hawaii": "HI", "idaho": "ID", "illinois": "IL", "indiana": "IN", "iowa": "IA", "kansas": "KS", "kentucky": "KY", "louisiana": "LA", "maine": "ME",
    "maryland": "MD", "massachusetts": "MA", "michigan": "MI", "minnesota": "MN", "mississippi": "MS", "missouri": "MO", "montana": "MT", "nebraska": "NE", "nevada": "NV",
    "new hampshire": "NH", "new jersey": "NJ", "new mexico": "NM", "new york": "NY", "north carolina": "NC", "north dakota": "ND", "ohio": "OH", "oklahoma": "OK", "oregon": "OR",
    "pennsylvania": "PA", "puerto rico": "PR", "rhode island": "RI", "south carolina": "SC", "south dakota": "SD", "tennessee": "TN", "texas": "TX", "utah": "UT", "vermont": "VT",
    "virginia": "VA", "washington": "WA", "west virginia": "WV", "wisconsin": "WI", "wyoming": "WY",
    "alberta": "AB", "british columbia": "BC", "manitoba": "MB", "new brunswick": "NB", "newfoundland and labrador": "NL", "northwest territories": "NT", "nova scotia": "NS", "nunavut": "NU",
    "ontario": "ON", "prince edward island": "PE", "quebec": "QC", "québec": "QC", "saskatchewan": "SK", "yukon": "YT",
}


def literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for x in chain.from_iterable(values.items())))


def clean_text(x: Column) -> Column:
    """Without white space at the ends; empty becomes null."""
    return F.nullif(F.regexp_replace(x, r"(?U)^\s+|\s+$", ""), F.lit(""))


def null_tokens(x: Column, tokens: list[str]) -> Column:
    return F.when(x.isin(tokens), None).otherwise(x)


def drop_float_suffix(x: Column) -> Column:
    return F.regexp_replace(x, r"\.0+$", "")


def zip5(x: Column) -> Column:
    """Five digits with lost leading zeros restored; null unless the text starts with a digit."""
    digits = F.nullif(F.regexp_extract(drop_float_suffix(clean_text(x)), r"^(\d{1,9})", 1), F.lit(""))
    return F.lpad(F.substring(digits, 1, 5), 5, "0")


def pad_fips(x: Column, width: int) -> Column:
    """Leading digits, padded with zeros; longer values stay, so that a contract can reject them."""
    digits = F.nullif(F.regexp_extract(drop_float_suffix(clean_text(x)), r"^(\d+)", 1), F.lit(""))
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def split_coordinates(x: Column) -> tuple[Column, Column]:
    pattern = r"^\s*(-?\d+(?:\.\d+)?)\s*,\s*(-?\d+(?:\.\d+)?)\s*$"
    part = lambda i: F.regexp_extract(x, pattern, i).try_cast("double")
    return part(1), part(2)


def leading_int(x: Column) -> Column:
    return F.regexp_extract(x, r"^\s*(\d+)", 1).try_cast("bigint")


def not_melting(x: Column) -> Column:
    return F.coalesce(F.contains(F.lower(x), F.lit("not melting")), F.lit(False))


def has_non_ascii(x: Column) -> Column:
    return F.coalesce(x.rlike(r"[^\x00-\x7F]"), F.lit(False))


def replacement_char(x: Column) -> Column:
    return F.coalesce(F.contains(x, F.lit("?")), F.lit(False))


def is_degraded(original: Column, candidate: Column) -> Column:
    """The candidate has question marks where the original has letters outside ASCII."""
    return has_non_ascii(original) & replacement_char(candidate) & ~replacement_char(original)


def is_lossy(original: Column, candidate: Column) -> Column:
    return is_degraded(original, candidate) & F.coalesce(F.length(original) != F.length(candidate), F.lit(False))


def any_pair(original: Column, candidate: Column, test) -> Column:  # noqa: ANN001
    """Whether the test holds for some pair of two lists of equal, positive length."""
    hit = F.exists(F.zip_with(original, candidate, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda p: test(p["a"], p["b"]))
    return F.coalesce((F.size(original) > 0) & (F.size(original) == F.size(candidate)) & hit, F.lit(False))


def to_float(x: Column) -> Column:
    """A number with thousands separators, or null."""
    bare = F.regexp_replace(F.regexp_replace(x, r"(?U)^\s+|\s+$", ""), ",", "")
    return F.when(bare.rlike(NUMBER), bare.try_cast("double"))


def sentinel_value(x: Column) -> Column:
    bare = F.replace(F.trim(x), F.lit(","), F.lit(""))
    return F.when(bare.rlike(NUMBER), bare.try_cast("double"))


def sentinel_status(x: Column) -> Column:
    """absent, unknown, bounded, reported or unparsed; the first that holds."""
    bare = F.trim(x)
    return (
        F.when(x.isNull(), "absent")
        .when(F.lower(bare).isin(UNKNOWN_WORDS), "unknown")
        .when(bare.like(">%") | bare.like("<%"), "bounded")
        .when(sentinel_value(x).isNotNull(), "reported")
        .otherwise("unparsed")
    )


def year_in_range(year: Column) -> Column:
    return F.when(year.between(MIN_YEAR, MAX_YEAR), year)


def plausible_year(x: Column) -> Column:
    """The first four digits anywhere, if they are a year."""
    return year_in_range(F.regexp_extract(x.cast("string"), r"(\d{4})", 1).try_cast("int"))


def parse_year(x: Column) -> Column:
    """Four digits that stand alone, if they are a year."""
    return year_in_range(F.regexp_extract(x.cast("string"), r"(?U)\b(\d{4})\b", 1).try_cast("int"))


def normalize_owner(x: Column) -> Column:
    bare = F.regexp_replace(F.lower(x.cast("string")), LEGAL_FORMS, "")
    return F.nullif(F.trim(F.regexp_replace(bare, "[^a-z0-9]+", " ")), F.lit(""))


def is_sentinel(x: Column) -> Column:
    return x.isNull() | F.lower(F.regexp_replace(x.cast("string"), r"(?U)^\s+|\s+$", "")).isin(SENTINELS)


def clean(x: Column) -> Column:
    """White space collapsed; spellings of "not recorded" become null."""
    return F.when(~is_sentinel(x), F.trim(F.regexp_replace(x.cast("string"), r"(?U)\s+", " ")))


def normalize_text(x: Column) -> Column:
    words = F.regexp_replace(F.lower(clean(x)), r"(?U)[^\w\s]", " ")
    return F.nullif(F.trim(F.regexp_replace(words, r"(?U)\s+", " ")), F.lit(""))


def normalize_subdivision(x: Column) -> Column:
    """A postal code as it is, or that of a full name."""
    bare = clean(x)
    codes = sorted(set(SUBDIVISIONS.values()))
    return F.when(F.upper(bare).isin(codes), F.upper(bare)).otherwise(F.try_element_at(literal_map(SUBDIVISIONS), F.lower(bare)))


def extract_zip(x: Column) -> Column:
    """The last group of five digits that stands alone: street numbers come first."""
    return F.try_element_at(F.regexp_extract_all(clean(x), F.lit(r"\b(\d{5})(?:-\d{4})?\b"), 1), F.lit(-1))


def normalize_street(x: Column) -> Column:
    words = F.split(normalize_text(F.substring_index(clean(x), ",", 1)), " ")
    known = literal_map(STREET_TOKENS)
    return F.nullif(F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(known, w), w)), " "), F.lit(""))


def split_aliases(x: Column) -> Column:
    """Names between ; or |, normalised; never null."""
    names = F.transform(F.split(F.coalesce(clean(x), F.lit("")), r"[;|]"), normalize_text)
    return F.filter(names, lambda n: n.isNotNull())


def other_names(names: Column, primary: Column) -> Column:
    """Distinct names without the primary one, sorted."""
    rest = F.array_distinct(names)
    return F.array_sort(F.when(primary.isNull(), rest).otherwise(F.array_except(rest, F.array(primary))))


def any_level(*tests: Column) -> Column:
    return reduce(lambda a, b: a | b, (F.coalesce(t, F.lit(False)) for t in tests))
