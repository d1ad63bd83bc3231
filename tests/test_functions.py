import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.functions import clock, content, markup, text, wkt


def ts(value):
    return F.to_timestamp_ntz(F.lit(value))


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_minutes_count_boundaries_not_whole_minutes(spark):
    row = one(
        spark,
        clock.minutes_between(ts("2024-01-01 08:00:30"), ts("2024-01-01 09:00:00")).alias("a"),
        clock.minutes_between(ts("2024-01-01 09:00:00"), ts("2024-01-01 08:00:30")).alias("b"),
        clock.minutes_between(ts("2023-12-31 23:59:59"), ts("2024-01-01 00:00:00")).alias("c"),
        clock.hours_between(ts("2024-01-01 08:15:00"), ts("2024-01-01 09:00:00")).alias("h"),
    )
    assert row[:] == (60, -60, 1, 0.75)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_time_expressions_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = one(
            spark,
            # 02:30 does not exist in New York on this day
            clock.minutes_between(ts("2024-03-10 01:30:00"), ts("2024-03-10 03:30:00")).alias("a"),
            clock.millis_text(ts("2024-03-10 02:30:59.999999")).alias("b"),
            clock.epoch_micros(ts("1970-01-01 00:00:01.000002")).alias("c"),
            clock.millis_text(ts("2024-01-01 00:00:00")).alias("d"),
        )
        assert row[:] == (120, "2024-03-10 02:30:59.999", 1000002, "2024-01-01 00:00:00.000")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_milliseconds_are_cut_not_rounded(spark):
    row = one(
        spark,
        clock.to_millis(ts("2024-01-01 00:00:07.179999")).alias("a"),
        clock.to_millis(ts("1969-12-31 23:59:59.999999")).alias("b"),
        clock.sub_milli_micros(ts("2024-01-01 00:00:07.179575")).alias("c"),
    )
    assert row["a"] == datetime.datetime(2024, 1, 1, 0, 0, 7, 179000)
    assert row["b"] == datetime.datetime(1969, 12, 31, 23, 59, 59, 999000)
    assert row["c"] == 575


def test_iso_text(spark):
    cases = {
        "2011-01-03T17:13:19.040": datetime.datetime(2011, 1, 3, 17, 13, 19, 40000),
        "2011-01-03 17:13": datetime.datetime(2011, 1, 3, 17, 13),
        "2011-01-03": datetime.datetime(2011, 1, 3),
        "2011-01-03T17:13:19.123456": datetime.datetime(2011, 1, 3, 17, 13, 19, 123456),
        "2011": None, "Late july 2026": None, "2011-13-01": None, "2011-01-03T17:13:19Z": None,
    }
    row = one(spark, *[clock.iso_timestamp(F.lit(c)).alias(f"c{i}") for i, c in enumerate(cases)])
    assert list(row) == list(cases.values())


def test_converted_values(spark):
    def value(t, kind):
        return content.converted(F.lit(t), kind)

    row = one(
        spark, value("12", T.IntegerType()).alias("i"), value("12.34", T.DecimalType(10, 2)).alias("d"),
        value("True", T.BooleanType()).alias("t"), value("yes", T.BooleanType()).alias("f"),
        value("2024-02-29", T.DateType()).alias("day"), value("1.5", T.DoubleType()).alias("x"),
        value(None, T.IntegerType()).alias("n"), value("", T.StringType()).alias("s"),
    )
    assert row["i"] == 12 and str(row["d"]) == "12.34" and row["t"] and row["f"] is False
    assert row["day"] == datetime.date(2024, 2, 29) and row["x"] == 1.5
    assert row["n"] is None and row["s"] == ""


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_bad_value_is_an_error_or_null_whatever_the_ansi_setting(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="amount: cannot convert 'unknown' to int"):
            one(spark, content.converted(F.lit("unknown"), T.IntegerType(), what="amount"))
        lenient = content.converted(F.lit("unknown"), T.IntegerType(), strict=False)
        assert one(spark, lenient)[0] is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_a_type_without_conversion_is_an_error():
    with pytest.raises(TypeError, match="no conversion"):
        content.converted(F.lit("x"), T.ArrayType(T.StringType()))


def test_mail_address(spark):
    address = text.mail_address(F.lit("Jörg"), F.lit("Müller"), F.lit("Bad Tölz Süd"))
    assert one(spark, address)[0] == "Jörg.Müller@badtoelzsued.de"


def test_text_helpers(spark):
    row = one(
        spark, text.is_heading(F.lit("NEW:")).alias("a"), text.is_heading(F.lit(None).cast("string")).alias("b"),
        text.occurrences(F.lit("a,b,,c"), ",").alias("c"), text.file_stem(F.lit("IT.v2.xlsx")).alias("d"),
        text.same_id(F.lit("AB-1"), F.lit("ab-1")).alias("e"), text.clamp(F.lit(120), 0, 100).alias("f"),
        text.clamp(F.lit(None).cast("int"), 0, 100).alias("g"), text.blank_to_null(F.lit("  ")).alias("h"),
    )
    assert row[:] == (True, False, 3, "IT.v2", True, 100, None, None)


def test_attributes_resolve_references(spark):
    line = """  <row Id="1" Name='it&apos;s' About="a&#9;b&#xA;c\\d &lt;p&gt; &amp;lt; &#38;lt; &#x1D544;" Tm="ypercubeᵀᴹ" Empty="" />"""
    got = one(spark, markup.attributes(F.lit(line), fold=True))[0]
    assert got == {
        "id": "1", "name": "it's", "about": "a\tb\nc\\d <p> &lt; &lt; 𝕄", "tm": "ypercubeᵀᴹ", "empty": "",
    }


@pytest.mark.parametrize("line", ['<row Id="1"', '<row Id=1 />', '<row Id="a" Name="b<c" />'])
def test_a_malformed_row_is_an_error(spark, line):
    with pytest.raises(Exception, match="malformed row"):
        one(spark, markup.attributes(F.lit(line)))


def test_row_line_round_trip(spark):
    value = 'tab\t newline\n "quotes" \'single\' <tag> & back\\slash'
    line = markup.row_line(A=F.lit(value), B=F.lit(None).cast("string"), C=F.lit(7))
    assert one(spark, markup.attributes(line))[0] == {"A": value, "C": "7"}


@pytest.mark.parametrize("kind, points", [
    ("POINT (13.4 52.50)", 1),
    ("LINESTRING (1 2, 3 4, 5 6)", 3),
    ("MULTILINESTRING ((1 2, 3 4), (5 6, 7 8, 9 10))", 5),
    ("POLYGON ((0 0, 1 0, 1 1, 0 0), (0.1 0.1, 0.2 0.1, 0.2 0.2, 0.1 0.1))", 8),
    ("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5), (5.1 5.1, 5.2 5.1, 5.2 5.2, 5.1 5.1)))", 12),
    ("LINESTRING EMPTY", 0),
    ("", 0),
])
def test_wkt_round_trip(spark, kind, points):
    parsed = wkt.parse_wkt(F.lit(kind))
    row = one(
        spark, wkt.to_wkt(parsed).alias("again"), wkt.point_count(parsed).alias("n"),
        wkt.is_empty(parsed).alias("empty"), parsed["srid"].alias("srid"),
    )
    assert row["again"] == kind and row["n"] == points and row["empty"] == (points == 0)
    assert row["srid"] == 4326


@pytest.mark.parametrize("geojson, expected", [
    ('{"type":"Point","coordinates":[13.4,52.5]}', "POINT (13.4 52.5)"),
    ('{"type":"LineString","coordinates":[[1,2],[3,4]]}', "LINESTRING (1 2, 3 4)"),
    ('{"type":"MultiLineString","coordinates":[[[1,2],[3,4]],[[5,6],[7,8]]]}',
     "MULTILINESTRING ((1 2, 3 4), (5 6, 7 8))"),
    ('{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}', "POLYGON ((0 0, 1 0, 1 1, 0 0))"),
    ('{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[0,0]]],[[[2,2],[3,2],[2,2]]]]}',
     "MULTIPOLYGON (((0 0, 1 0, 0 0)), ((2 2, 3 2, 2 2)))"),
])
def test_geojson_to_wkt(spark, geojson, expected):
    assert one(spark, wkt.to_wkt(wkt.parse_geojson(F.lit(geojson))))[0] == expected


def test_an_unknown_geojson_type_is_an_error(spark):
    with pytest.raises(Exception, match="unknown geometry type: Circle"):
        one(spark, wkt.parse_geojson(F.lit('{"type":"Circle","coordinates":[1,2]}')))


def test_segments_with_one_position_are_no_lines(spark):
    def track(*segments):
        return wkt.track_wkt(F.array(*[F.array(*[F.lit(p) for p in s]) for s in segments]))

    row = one(
        spark, track(["1 2"]).alias("a"), track(["1 2", "3 4"], ["5 6"]).alias("b"),
        track(["1 2", "3 4"], ["5 6", "7 8"]).alias("c"), wkt.line_wkt(F.array(F.lit("1 2"))).alias("d"),
    )
    assert row[:] == ("", "LINESTRING (1 2, 3 4)", "MULTILINESTRING ((1 2, 3 4), (5 6, 7 8))", "")
