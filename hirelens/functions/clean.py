"""Row cleaning as column expressions: nothing leaves the JVM but the exact ratio of names (`fuzzy`)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..schemas import CHECKED, DERIVED, NEEDED
from . import fuzzy

# The results have to agree on them.
KEY_ALIASES = {
    "contract_type": "contract",
    "contract": "contract",
    "contract type": "contract",
    "expires": "closes",
    "closes": "closes",
    "closing_date": "closes",
    "placed on": "placed_on",
    "name": "job_title",
    "type___role": "type_role",
    "extra_type___role": "type_role",
    "subject_area_s": "subject_area",
    "subject_area": "subject_area",
    "extra_subject_area": "subject_area",
    "extra_subject_area_s": "subject_area",
    "location_s": "location",
    "location": "location",
    "extra_location_s": "extra_location",
}
UK_REGIONS = ["Northern England", "London Midlands of England Scotland", "South West England", "South East England", "Wales", "Republic of Ireland", "Northern Ireland"]
STUDENT_ROLES = ["phd", "masters"]
UNIVERSITY_WORDS = ["university", "school", "college"]
SALARY = "£[0-9]?[0-9][0-9],[0-9][0-9][0-9]"
LOWEST_SALARY = 8000
MATCH_RATIO = 0.70

#: Day-first, after ordinal suffixes are gone; ISO dates are read as what they are.
DATE_FORMATS = ["yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "d MMMM yyyy", "d MMM yyyy", "MMMM d yyyy", "MMM d yyyy", "MMMM yyyy", "MMM yyyy"]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Unicode white space off both ends."""
    return F.regexp_replace(F.regexp_replace(col(c), r"(?U)^\s+", ""), r"(?U)\s+$", "")


def heading_slug(c: Column | str) -> Column:
    """Lower case, ASCII punctuation to spaces, trailing space off, spaces to underscores (not collapsed)."""
    spaced = F.regexp_replace(F.lower(col(c)), r"[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]", " ")
    return F.replace(F.regexp_replace(spaced, r"(?U)\s+$", ""), F.lit(" "), F.lit("_"))


def location_slug(c: Column | str) -> Column:
    """nloc_ and the lower-cased name without & and comma, one underscore for each run of spaces."""
    return F.concat(F.lit("nloc_"), F.regexp_replace(F.lower(F.translate(col(c), "&,", "")), " +", "_"))


def matching_key(c: Column | str) -> Column:
    key = F.lower(F.regexp_replace(col(c), r"(?U)\s+$", ""))
    names = F.create_map(*[F.lit(x) for pair in KEY_ALIASES.items() for x in pair])
    return F.coalesce(names[key], key)


def aliased_keys(fields: Column | str) -> Column:
    """The map with its keys under their better names; of two values for one name the later wins."""
    return F.map_from_entries(F.transform(F.map_entries(col(fields)), lambda e: F.struct(matching_key(e["key"]).alias("key"), e["value"].alias("value"))))


def parse_date(c: Column | str, dayfirst_iso: bool = False) -> Column:
    """A timestamp, or null where no format fits. dayfirst_iso reads yyyy-MM-dd as year, day, month where that is a date."""
    plain = F.regexp_replace(F.regexp_replace(strip(c), r"(?i)\b(\d{1,2})(st|nd|rd|th)\b", "$1"), r"(?i)^(mon|tues|wednes|thurs|fri|satur|sun)day,?\s+", "")
    plain = F.regexp_replace(F.replace(plain, F.lit(","), F.lit(" ")), r"\s+", " ")
    formats = (["yyyy-dd-MM"] if dayfirst_iso else []) + DATE_FORMATS
    return F.coalesce(*[F.try_to_timestamp(plain, F.lit(f)) for f in formats])


def blank(c: Column | str) -> Column:
    """Null, blank or "not specified"."""
    return col(c).isNull() | F.lower(strip(c)).isin("", "not specified")


def salary(c: Column | str) -> Column:
    """struct(min, max, invalid): of one or two amounts like £nn,nnn. Null min and max where there is none."""
    text = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?U)\s+", " ")
    amounts = F.array_sort(F.transform(F.regexp_extract_all(text, F.lit(SALARY), 0), lambda x: F.translate(x, "£,", "").cast("double")))
    n = F.size(amounts)
    good = n.between(1, 2) & (F.try_element_at(amounts, F.lit(1)) >= LOWEST_SALARY)
    invalid = blank(c) | ((n == 0) & text.rlike("[0-9]")) | ((n > 0) & ~F.coalesce(good, F.lit(False)))
    return F.struct(F.when(good, F.try_element_at(amounts, F.lit(1))).alias("min"), F.when(good, F.try_element_at(amounts, F.lit(-1))).alias("max"), invalid.alias("invalid"))


def median_salary(low: Column | str, high: Column | str) -> Column:
    return (col(low) + col(high)) / 2


def duration_days(placed_on: Column | str, closes: Column | str) -> Column:
    return F.datediff(col(closes), col(placed_on))


def in_uk(c: Column | str) -> Column:
    return F.when(col(c).isin(UK_REGIONS), F.lit(True))


def not_student(type_role: Column | str) -> Column:
    """False where a role is a student's, true otherwise; null roles are no students' (false), as an absent role is."""
    student = F.exists(col(type_role), lambda x: F.lower(F.regexp_replace(x, r"(?U)\s+$", "")).isin(STUDENT_ROLES))
    return F.coalesce(~student, F.lit(False))


def missing_attributes(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, missing): a row for each named column that is null or blank."""
    flags = F.filter(F.array(*[F.when(blank(F.col(c).cast("string")), F.lit(c)) for c in columns]), lambda x: x.isNotNull())
    return df.select(F.col(key), F.explode(flags).alias("missing"))


def clean_rows(df: DataFrame, dayfirst_iso: bool = False, extra: tuple[str, ...] = ()) -> DataFrame:
    """Cleaned adverts. Absent needed columns count as blank; needed columns, derived ones and the named extra ones are output.

    Validity, dates, salary (a funding amount overrides the salary text), and the fallbacks between them; invalid_code is sorted,
    and null where nothing is invalid.
    """
    have = set(df.columns)
    text = {c: F.col(c) if c in have else F.lit(None).cast("string") for c in NEEDED}
    flat = lambda c: F.array_join(text[c], ",") if c in have and isinstance(df.schema[c].dataType, ArrayType) else text[c]
    prepared = df.select(
        *[(strip(text[c]) if c in have and isinstance(df.schema[c].dataType, StringType) else text[c]).alias(c) for c in NEEDED if c not in ("placed_on", "closes")],
        parse_date(text["placed_on"].cast("string"), dayfirst_iso).alias("placed_on"),
        parse_date(text["closes"].cast("string"), dayfirst_iso).alias("closes"),
        salary(text["salary"]).alias("_s"),
        salary(text["funding_amount"]).alias("_f"),
        *[F.when(blank(flat(c).cast("string")), F.lit(c)).alias(f"_bad_{c}") for c in CHECKED],
        *[F.col(c) for c in extra if c in have and c not in NEEDED],
    )
    low, high = F.coalesce("_f.min", "_s.min"), F.coalesce("_f.max", "_s.max")
    funded = ~blank("funding_amount")
    bad = [F.col(f"_bad_{c}") for c in CHECKED if c != "contract"]
    bad.append(F.when(~funded, F.col("_bad_contract")))
    bad += [F.when(F.col(c).isNull(), F.lit(c)) for c in ("placed_on", "closes")]
    bad.append(F.when(F.col("_bad_employer").isNotNull(), F.lit("type_role")))
    # No amount found: an invalid or blank funding amount counts against the salary.
    bad.append(F.when(low.isNull() & (F.col("_s.invalid") | F.col("_f.invalid")), F.lit("salary")))
    codes = F.array_sort(F.filter(F.array(*bad), lambda x: x.isNotNull()))
    out = prepared.select(
        *[(F.when(F.col("_bad_contract").isNotNull() & funded, F.lit("funding")).otherwise(F.col(c)) if c == "contract" else F.col(c)).alias(c) for c in NEEDED],
        F.when(F.size(codes) > 0, codes).alias("invalid_code"),
        low.alias("salary_min"),
        high.alias("salary_max"),
        median_salary(low, high).alias("salary_median"),
        duration_days("placed_on", "closes").alias("duration_ad_days"),
        *[F.col(c) for c in extra if c in have and c not in NEEDED],
    )
    more = {"uk_university": "string", "uk_postcode": "string", "not_student": "boolean", "in_uk": "boolean"}
    return out.withColumns({c: F.lit(None).cast(t) for c, t in more.items() if c not in out.columns}).select(*NEEDED, *DERIVED, *[c for c in extra if c in out.columns and c not in NEEDED])


def closest_match(df: DataFrame, column: str, names: list[str] | DataFrame, output: str = "match") -> DataFrame:
    """df with the most similar of the names (ratio of MATCH_RATIO or more, the first of equals) as its last column, in place of one
    of that name. names is a list, or a table of name and position however long. Each distinct value is matched once and joined back;
    a null value has no match."""
    if isinstance(names, list):
        names = df.sparkSession.createDataFrame(list(enumerate(names)), "position long, name string")
    rows = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), df[column].alias("value"))
    found = fuzzy.closest_names(rows.select("value"), names, round(100 * MATCH_RATIO))
    kept = [F.col("row").getField(c).alias(c) for c in df.columns if c != output]
    return rows.join(found, "value", "left").select(*kept, F.col("name").alias(output))


def uk_university(df: DataFrame, column: str, names: list[str]) -> DataFrame:
    """uk_university: the employer where it names a university, school or college before any dash, else the closest listed name."""
    words = F.split(F.lower(F.split(F.col(column), "-")[0]), r"[^a-z]+")
    matched = closest_match(df, column, names, "_closest")
    keyword = F.arrays_overlap(words, F.array(*[F.lit(x) for x in UNIVERSITY_WORDS]))
    return matched.withColumn("uk_university", F.when(keyword, F.col(column)).otherwise(F.col("_closest"))).drop("_closest")


def mongo_date(c: Column | str) -> Column:
    """A date from an extended-JSON date, either ISO text or milliseconds."""
    text = col(c).cast("string")
    return F.coalesce(F.to_date(F.timestamp_millis(text.try_cast("bigint"))), text.substr(1, 10).try_cast("date"))


def contract_type(c: Column | str) -> Column:
    """Permanent, or FixedTerm for any other; null stays null."""
    return F.when(col(c).isNull(), None).when(col(c) == "Permanent", "Permanent").otherwise("FixedTerm")


def valid_prediction() -> Column:
    """Whether probability and both its bounds lie in [0, 1]."""
    return reduce(lambda a, b: a & b, [F.coalesce(F.col(c).between(0, 1), F.lit(False)) for c in ("probability", "probability_lower", "probability_upper")])


# What a training row's contract has to name.
CONTRACTS = "(?i)(Fixed-Term|Permanent|Temporary)"


def valid_training() -> Column:
    """Rating tags and layout among the known ones, contract among the known words."""
    tags = ["No", "Some", "Insufficient Evidence", "Most"]
    return F.coalesce(F.col("tags_1").isin(tags) & F.col("tags_2").isin(tags) & F.col("enhanced").isin("normal", "enhanced") & F.col("contract").rlike(CONTRACTS), F.lit(False))


def rating(c: Column | str) -> Column:
    """No 1, Some 2, Most 3; anything else has no rank."""
    return F.when(col(c) == "No", 1).when(col(c) == "Some", 2).when(col(c) == "Most", 3).cast("int")


def month_key(c: Column | str) -> Column:
    return F.date_format(F.trunc(col(c), "MM"), "yyyy-MM-dd")


def month_label(c: Column | str) -> Column:
    return F.date_format(col(c), "MMM yyyy")


def readable_date(c: Column | str) -> Column:
    """A snapshot's name as a date where it starts with one, else unchanged."""
    return F.coalesce(F.date_format(col(c).substr(1, 10).try_cast("date"), "d MMM yyyy"), col(c))


def alert_level(c: Column | str) -> Column:
    return F.when(col(c) > 0.80, "High").when(col(c) > 0.60, "Medium").otherwise("Low")


def verdict(precision: Column, recall: Column) -> Column:
    """Of two alert levels: High, Low, HighLow or LowHigh."""
    return F.when((precision == "High") & (recall == "High"), "High").when(precision == "High", "HighLow").when(recall == "High", "LowHigh").otherwise("Low")


def verdict_alert(c: Column | str) -> Column:
    return F.when(col(c).isin("High", "Low"), col(c)).otherwise("Medium")


def title_matches(title: Column | str, keywords: list[str]) -> Column:
    """Every keyword in the title, whatever the case."""
    lowered = F.lower(col(title))
    return reduce(lambda a, b: a & b, [lowered.contains(k.lower()) for k in keywords])


def not_phd(title: Column | str) -> Column:
    return ~col(title).contains("PhD")


def job_date(*columns: str) -> Column:
    return F.coalesce(*[F.col(c) for c in columns])
