import datetime

import pytest
from pyspark.sql import functions as F

from hirelens.functions import clean as C


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f("v").alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("text", "low", "high", "invalid"),
    [
        ("£35,845 to £40,322", 35845.0, 40322.0, False),
        ("£100,000", 100000.0, 100000.0, False),
        ("Competitive", None, None, False),
        ("Grade 7", None, None, True),
        ("£30,000 £31,000 £32,000", None, None, True),
        ("£05,000", None, None, True),
        (None, None, None, True),
        ("not specified", None, None, True),
    ],
)
def test_salary(spark, text, low, high, invalid):
    s = one(spark, text, C.salary)
    assert (s["min"], s["max"], s["invalid"]) == (low, high, invalid)


@pytest.mark.parametrize(("text", "slug"), [("Type / Role:", "type___role"), ("Subject Area(s):", "subject_area_s"), ("Closes:", "closes")])
def test_slug(spark, text, slug):
    from hirelens.functions.html import slug as plain

    assert one(spark, text, C.heading_slug) == slug == plain(text)


def test_levels_and_verdicts(spark):
    levels = [one(spark, x, C.alert_level, "double") for x in (0.8001, 0.80, 0.6001, 0.60)]
    assert levels == ["High", "Medium", "Medium", "Low"]
    df = spark.createDataFrame([("High", "High"), ("High", "Low"), ("Medium", "High"), ("Low", "Medium")], "p string, r string")
    found = df.select(C.verdict(F.col("p"), F.col("r")).alias("v")).withColumn("a", C.verdict_alert("v")).collect()
    assert [tuple(x) for x in found] == [("High", "High"), ("HighLow", "Medium"), ("LowHigh", "Medium"), ("Low", "Low")]


def test_months(spark):
    assert one(spark, datetime.date(2017, 1, 31), C.month_key, "date") == "2017-01-01"
    assert one(spark, datetime.date(2017, 1, 31), C.month_label, "date") == "Jan 2017"
    assert one(spark, None, C.month_key, "date") is None
    assert one(spark, "2020-04-12_rse", C.readable_date) == "12 Apr 2020"
    assert one(spark, "latest", C.readable_date) == "latest"


@pytest.mark.parametrize(
    ("text", "day"),
    [("2020-04-12", "2020-04-12"), ("3rd April 2020", "2020-04-03"), ("12/4/2020", "2020-04-12"), ("Monday, 6 Apr 2020", "2020-04-06"), ("April 2020", "2020-04-01"), ("soon", None), (None, None)],
)
def test_dates(spark, text, day):
    got = one(spark, text, C.parse_date)
    assert (got and got.date().isoformat()) == day


def test_dayfirst_reading_of_iso(spark):
    assert one(spark, "2020-04-12", lambda c: C.parse_date(c, True)).date().isoformat() == "2020-12-04"
    assert one(spark, "2020-04-13", lambda c: C.parse_date(c, True)).date().isoformat() == "2020-04-13"


def test_clean_rows(spark):
    columns = "jobid string, name_ string, description string, job_title string, employer string, location string, salary string, funding_amount string, hours array<string>, contract string, placed_on string, closes string, subject_area array<string>"
    rows = [
        ("1", "x", " text ", "Engineer", "Uni", "Leeds", "£30,000 to £35,000", None, ["Full Time"], "Permanent", "1 March 2020", "2020-03-31", ["IT"]),
        ("2", "x", "", None, " Not specified", "Leeds", "Grade 7", "£12,000", None, "", "soon", None, []),
        ("3", "x", "d", "t", "e", "l", "Competitive", "", ["a"], "Fixed", "1/2/2020", "2/2/2020", ["s"]),
    ]
    a, b, c = C.clean_rows(spark.createDataFrame(rows, columns)).orderBy("jobid").collect()
    assert (a.salary_min, a.salary_max, a.salary_median, a.duration_ad_days, a.invalid_code, a.description) == (30000.0, 35000.0, 32500.0, 30, None, "text")
    assert (b.salary_min, b.contract) == (12000.0, "funding")
    assert b.invalid_code == ["closes", "description", "employer", "hours", "job_title", "placed_on", "subject_area", "type_role"]
    assert c.invalid_code == ["salary"]


def test_maps_and_flags(spark):
    assert one(spark, {"Expires ": "b", "Other": "c"}, C.aliased_keys, "map<string,string>") == {"closes": "b", "other": "c"}
    assert one(spark, "Wales", C.in_uk) is True
    assert one(spark, "Asia & Middle East", C.location_slug) == "nloc_asia_middle_east"
    assert [one(spark, x, C.not_student, "array<string>") for x in (["PhD "], ["Academic"], None)] == [False, True, False]
    assert one(spark, "1583020800000", C.mongo_date) == datetime.date(2020, 3, 1)
    assert one(spark, "2020-03-01T10:00:00Z", C.mongo_date) == datetime.date(2020, 3, 1)


def test_closest_university(spark):
    df = spark.createDataFrame([("Univ of Aberdeen",), ("University of Leeds - Physics",), ("Aberdeen Universty",), ("Bakery",), (None,)], "employer string")
    found = {r.employer: r.uk_university for r in C.uk_university(df, "employer", ["University of Aberdeen", "Aberdeen University"]).collect()}
    assert found["University of Leeds - Physics"] == "University of Leeds - Physics"
    assert found["Aberdeen Universty"] == "Aberdeen University"
    assert found["Bakery"] is None
    assert found[None] is None
