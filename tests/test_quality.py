"""A form filled in by people: 12 rows, 3 blank, 1 heading, 8 projects, 4 of them with one fault each."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.operators import quality as dq
from sluicework.operators import shape

PROJECT = T.StructType([
    T.StructField("Title", T.StringType()),
    T.StructField("Priority", T.StringType()),
    T.StructField("Status", T.StringType()),
    T.StructField("Color", T.StringType()),
    T.StructField("ProgressPercent", T.IntegerType()),
    T.StructField("MilestoneDate", T.TimestampNTZType()),
])
LONG = "Everybody is on it, and it will be done when the summer is over, we think."
ROWS = [
    ("Billing", "High", "Running", "Yellow", "65", "2026-06-15"),
    ("Archive", "High", "At risk", "Red", "45", "Late july 2026"),
    ("Phone app", "High", LONG, "Yellow", "80", "2026-06-10"),
    ("Warehouse", "High", "Delayed", "DarkRed", "1", "2026-07-15"),
    ("", None, None, None, None, None),
    ("Website", "Medium", "Planned", "Green", "20", "2026-06-20"),
    ("Intranet", "Medium", "Running", "Green", "unknown", "2026-08-01"),
    (None, None, None, None, None, None),
    ("NEW PROJECTS:", None, None, None, None, None),
    ("Portal", "Low", None, "Green", "0", "2026-09-01"),
    ("Training", "Low", "Planned", "Green", "100", None),
    ("", "", None, None, None, None),
]
RULES = [
    dq.not_null("Title"),
    dq.one_of("Priority", ["Low", "Medium", "High"]),
    dq.one_of("Color", ["Green", "Yellow", "Red"]),
    dq.max_length("Status", 50),
    dq.convertible("ProgressPercent", T.IntegerType()),
    dq.in_range("ProgressPercent", T.IntegerType(), 0, 100),
    dq.convertible("MilestoneDate", T.TimestampNTZType()),
    dq.Unique("Title_key", ("Title",), "row_no"),
]


@pytest.fixture
def form(spark):
    schema = ", ".join(f"{c} string" for c in PROJECT.names)
    rows = spark.createDataFrame(ROWS, schema)
    kept = shape.drop_blank_rows(rows)
    assert kept.count() == 9
    projects = shape.skip_headings(kept, "Title")
    assert projects.count() == 8
    return projects.withColumn("row_no", F.xxhash64("Title"))


def test_four_rows_land_and_four_come_back(form):
    checked = dq.check(form, RULES)
    good = dq.accepted(checked, PROJECT)
    assert good.count() == 4 and good.schema["ProgressPercent"].dataType == T.IntegerType()
    back = {r["Title"]: r for r in dq.rejected(checked).collect()}
    assert {t: r["ImportError"] for t, r in back.items()} == {
        "Archive": "MilestoneDate_type", "Phone app": "Status_length",
        "Warehouse": "Color_list", "Intranet": "ProgressPercent_type",
    }
    assert back["Archive"]["MilestoneDate"] == "Late july 2026" and back["Phone app"]["Status"] == LONG
    assert {(r["reason"], r["n"]) for r in dq.summary(checked).collect()} == {
        ("MilestoneDate_type", 1), ("Status_length", 1), ("Color_list", 1), ("ProgressPercent_type", 1),
    }


def test_after_the_repair_five_land_and_three_come_back(form):
    checked = dq.repair(form, RULES, "Color_list", "Color", F.lit("Red"))
    good = {r["Title"]: r["Color"] for r in dq.accepted(checked, PROJECT).collect()}
    assert len(good) == 5 and good["Warehouse"] == "Red"
    assert {r["Title"] for r in dq.rejected(checked).collect()} == {"Archive", "Phone app", "Intranet"}


def test_a_repair_that_fails_again_hands_back_the_original(form):
    checked = dq.repair(form, RULES, "Color_list", "Color", F.lit("Pink"))
    back = {r["Title"]: r for r in dq.rejected(checked).collect()}
    assert back["Warehouse"]["Color"] == "DarkRed" and back["Warehouse"]["ImportError"] == "Color_list"


def test_all_or_nothing(spark, form, tmp_path):
    checked = dq.check(form, RULES)
    path = str(tmp_path / "target")
    with pytest.raises(Exception, match="batch rejected"):
        dq.all_or_nothing(checked, PROJECT).write.parquet(path)
    assert not list((tmp_path / "target").glob("*.parquet")), "nothing of the batch may land"
    with pytest.raises(Exception, match="batch rejected"):
        dq.all_or_nothing(checked, PROJECT).count()
    good = form.filter(~F.col("Title").isin("Archive", "Phone app", "Warehouse", "Intranet"))
    dq.all_or_nothing(dq.check(good, RULES), PROJECT).write.mode("overwrite").parquet(path)
    assert spark.read.parquet(path).count() == 4


def test_split_in_one_pass(spark, form, tmp_path):
    path = str(tmp_path / "split")
    dq.write_split(dq.check(form, RULES), path)
    assert spark.read.parquet(f"{path}/accepted=true").count() == 4
    assert spark.read.parquet(f"{path}/accepted=false").filter("size(reasons) = 1").count() == 4


def test_null_passes_every_rule_but_not_null(spark):
    df = spark.createDataFrame([(None,) * 6 + (1,)], ", ".join(f"{c} string" for c in PROJECT.names) + ", row_no int")
    assert dq.check(df, RULES).first()["reasons"] == ["Title_null"]


def test_the_first_good_row_keeps_the_key(spark):
    rows = [(1, "a", "Pink"), (2, "a", "Red"), (3, "a", "Red"), (4, "b", "Red"), (5, None, "Red"), (6, None, "Red")]
    df = spark.createDataFrame(rows, "n int, Title string, Color string")
    rules = [dq.one_of("Color", ["Red"], "color"), dq.Unique("key", ("Title",), "n")]
    got = {r["n"]: r["reasons"] for r in dq.check(df, rules).collect()}
    assert got == {1: ["color"], 2: [], 3: ["key"], 4: [], 5: [], 6: []}


def test_several_faults_are_all_named(spark):
    df = spark.createDataFrame([("t", "Huge", "x", "Pink", "101", "never", 1)],
                               ", ".join(f"{c} string" for c in PROJECT.names) + ", row_no int")
    assert dq.check(df, RULES).first()["reasons"] == [
        "Color_list", "MilestoneDate_type", "Priority_list", "ProgressPercent_range",
    ]
