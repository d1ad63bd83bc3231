"""Times of day: as text in any session, as TIME where the session has that type."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.functions import clock, content

GOOD = ["00:00:00", "10", "10:11", "T10:11:12", "101112", "1011", "10:11:12.5", "10:11:12,123456", "23:59:59.999999"]
BAD = ["", "24:00", "10:60", "10:11:61", "1:02", "10:1112", "1011:12", "noon", "10:11:12+02:00", "10:11:12.", " 10:11"]


def test_text_of_a_time(spark):
    df = spark.createDataFrame([(t,) for t in [*GOOD, *BAD, None, "10:11:12.1234567"]], "t string")
    got = {r["t"]: r["v"] for r in df.select("t", clock.iso_time(F.col("t")).alias("v")).collect()}
    for text in GOOD:
        assert datetime.time.fromisoformat(got[text]) == datetime.time.fromisoformat(text)
    assert all(got[text] is None for text in [*BAD, None])
    assert got["10:11:12.1234567"] == "10:11:12.123456"


def test_time_type(spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    try:
        df = spark.createDataFrame([(t,) for t in [*GOOD, *BAD, None]], "t string")
        lenient = content.converted(F.col("t"), T.TimeType(6), strict=False)
        found = df.select("t", lenient.cast("string").alias("v")).collect()
        assert {r["t"] for r in found if r["v"] is not None} == set(GOOD)
        for r in found:
            if r["v"] is not None:
                assert datetime.time.fromisoformat(r["v"]) == datetime.time.fromisoformat(r["t"])
        strict = content.converted(F.col("t"), T.TimeType(6), what="starts")
        with pytest.raises(Exception, match="starts: cannot convert"):
            df.select(strict.cast("string")).collect()
    finally:
        spark.conf.unset("spark.sql.timeType.enabled")
