import datetime
import hashlib
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.functions import wkt
from sluicework.operators import profile, reconcile
from sluicework.sources import blobs, collections, geofiles, lines, workbooks
from sluicework.functions.content import fingerprint
from workbook import write_workbook

USERS = T.StructType([
    T.StructField("Id", T.IntegerType()),
    T.StructField("AboutMe", T.StringType()),
    T.StructField("Age", T.IntegerType()),
    T.StructField("CreationDate", T.TimestampNTZType()),
    T.StructField("DisplayName", T.StringType()),
    T.StructField("LastAccessDate", T.TimestampNTZType()),
    T.StructField("EmailHash", T.StringType()),
    T.StructField("Location", T.StringType()),
])
USERS_FILE = """﻿<?xml version="1.0" encoding="utf-8"?>
<users>
  <row Id="-1" CreationDate="2011-01-03T17:00:00.000" DisplayName="ypercubeᵀᴹ" LastAccessDate="2011-01-03T17:13:19.040" Location="on the server farm" AboutMe="&lt;p&gt;tab&#x9;newline&#xA;back\\slash&lt;/p&gt;" />
  <row Id="2" CreationDate="2011-01-03T20:14:55.013" DisplayName="O'Brien &amp; Co" LastAccessDate="2011-01-04T01:02:03.999" />
  {"Id": "9"}
</users>
"""
BADGES = T.StructType([
    T.StructField("Id", T.IntegerType()), T.StructField("Name", T.StringType()),
    T.StructField("CreationDate", T.TimestampNTZType()),
])


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_xml_rows_of_a_file(spark, tmp_path):
    rows = {r["Id"]: r for r in lines.import_files(spark, write(tmp_path / "Users.xml", USERS_FILE), USERS).collect()}
    assert set(rows) == {-1, 2}, "the JSON line in an XML file is no row"
    first = rows[-1]
    assert first["AboutMe"] == "<p>tab\tnewline\nback\\slash</p>" and first["DisplayName"] == "ypercubeᵀᴹ"
    assert first["CreationDate"] == datetime.datetime(2011, 1, 3, 17, 0)
    assert first["LastAccessDate"].microsecond == 40000
    assert first["Age"] is None and first["EmailHash"] is None
    assert rows[2]["Location"] is None and rows[2]["DisplayName"] == "O'Brien & Co"


def test_json_rows_with_names_in_any_case_and_a_column_map(spark, tmp_path):
    text = '{"ID": 1, "name": "Teacher", "Date": "2011-01-03T20:14:55.013"}\n\n{"id": "2", "NAME": null}\n'
    rows = lines.import_files(spark, write(tmp_path / "b.json", text), BADGES, {"CREATIONDATE": "date"}).collect()
    assert sorted((r["Id"], r["Name"]) for r in rows) == [(1, "Teacher"), (2, None)]
    assert {r["CreationDate"] for r in rows} == {datetime.datetime(2011, 1, 3, 20, 14, 55, 13000), None}


def got_d(rows):
    return next(r["file"][-5:] for r in rows if r["Id"] == 7)


def test_formats_are_told_per_file_by_the_first_telling_line(spark, tmp_path):
    write(tmp_path / "a.txt", '<?xml version="1.0"?>\n<r>\n<row Id="1" Name="x" />\n</r>\n')
    write(tmp_path / "b.txt", '{"Id": 2, "Name": "y"}\n{"Id": 3}\n')
    write(tmp_path / "c.txt", '\n# notes\n{"Id": 5}\n{"Id": 6}\n')
    write(tmp_path / "d [1].txt", '\n<?xml version="1.0"?>\n<row Id="7" />\n')
    pattern = str(tmp_path / "*.txt")
    formats = {r["file"][-5:]: r["format"] for r in lines.file_formats(lines.read_lines(spark, pattern)).collect()}
    assert sorted(formats.values()) == ["json", "json", "xml", "xml"] and formats["c.txt"] == "json"
    got = lines.import_files(spark, pattern, BADGES, keep_file=True).collect()
    assert sorted((r["file"][-5:], r["Id"]) for r in got) == sorted([
        ("a.txt", 1), ("b.txt", 2), ("b.txt", 3), ("c.txt", 5), ("c.txt", 6), (got_d(got), 7)])
    write(tmp_path / "e.txt", "notes\nmore notes\n")
    with pytest.raises(ValueError, match="no line tells the format of .*e.txt"):
        lines.import_files(spark, pattern, BADGES)
    known = lines.import_files(spark, str(tmp_path / "a.txt"), BADGES, format="xml")
    assert known.count() == 1


def test_one_bad_value_is_an_error_not_a_row_of_nulls(spark, tmp_path):
    path = write(tmp_path / "u.xml", '<?xml version="1.0"?>\n<row Id="x1" Name="n" />\n')
    with pytest.raises(Exception, match="Id: cannot convert 'x1' to int"):
        lines.import_files(spark, path, BADGES).collect()
    assert lines.import_files(spark, path, BADGES, strict=False).first()[:] == (None, "n", None)


@pytest.mark.parametrize("line", ['<row Id="1"', '<row Id=1 />', '<row Id="1" Name="a<b" />', '<row Id="1" Name="&none;" />'])
def test_a_malformed_line_is_an_error(spark, tmp_path, line):
    path = write(tmp_path / "u.xml", f'<?xml version="1.0"?>\n<rows>\n{line}\n</rows>\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        lines.import_files(spark, path, BADGES).collect()


def test_names_match_in_any_case_under_either_setting(spark, tmp_path):
    path = write(tmp_path / "u.xml", '<?xml version="1.0"?>\n  <row ID="7" nAmE="x" date="2024-01-01T00:00:00" ></row>\n')
    got = []
    for setting in ("false", "true"):
        spark.conf.set("spark.sql.caseSensitive", setting)
        try:
            got.append(lines.import_files(spark, path, BADGES, {"CreationDate": "Date"}).first()[:])
        finally:
            spark.conf.unset("spark.sql.caseSensitive")
    assert got == [(7, "x", datetime.datetime(2024, 1, 1))] * 2


def test_attribute_presence(spark, tmp_path):
    rows = lines.read_lines(spark, write(tmp_path / "Users.xml", USERS_FILE))
    got = {r["attribute"]: r["n"] for r in profile.attribute_presence(rows).collect()}
    assert got == {"Id": 2, "CreationDate": 2, "DisplayName": 2, "LastAccessDate": 2, "Location": 1, "AboutMe": 1}


GPX_11 = """<?xml version="1.0" encoding="UTF-8"?>
<gpx xmlns="http://www.topografix.com/GPX/1/1" version="1.1">
  <wpt lat="52.5200" lon="13.4050"><ele>34</ele><name>Start</name></wpt>
  <rte><name>One point</name><rtept lat="1" lon="2"/></rte>
  <rte><rtept lat="1" lon="2"/><rtept lat="3" lon="4"/></rte>
  <trk><name><![CDATA[Mauer & Weg]]></name>
    <trkseg><trkpt lat="1.10" lon="2.20"><ele>1</ele></trkpt><trkpt lat="3.30" lon="4.40"/></trkseg>
    <trkseg><trkpt lat="5" lon="6"/></trkseg>
  </trk>
</gpx>"""
GPX_10 = """<gpx xmlns="http://www.topografix.com/GPX/1/0" version="1.0">
  <trk><trkseg><trkpt lat="1" lon="2"/><trkpt lat="3" lon="4"/></trkseg>
       <trkseg><trkpt lat="5" lon="6"/><trkpt lat="7" lon="8"/></trkseg></trk>
</gpx>"""
GPX_PREFIXED = """<g:gpx xmlns:g="http://www.topografix.com/GPX/1/1"><g:wpt lat="9" lon="8"><g:name>P</g:name></g:wpt></g:gpx>"""


def test_gpx_files_of_any_namespace(spark, tmp_path):
    write(tmp_path / "a.gpx", GPX_11)
    write(tmp_path / "b.gpx", "﻿" + GPX_10)
    write(tmp_path / "c.gpx", GPX_PREFIXED)
    write(tmp_path / "d.gpx", '<gpx xmlns="http://www.topografix.com/GPX/1/1"></gpx>')
    write(tmp_path / "notes.txt", "no GPX")
    rows = {tuple(r) for r in geofiles.read_gpx(spark, str(tmp_path / "*.gpx")).collect()}
    assert rows == {
        ("a.gpx", "Waypoint", "Start", "POINT (13.4050 52.5200)"),
        ("a.gpx", "Route", "One point", ""),
        ("a.gpx", "Route", None, "LINESTRING (2 1, 4 3)"),
        ("a.gpx", "Track", "Mauer & Weg", "LINESTRING (2.20 1.10, 4.40 3.30)"),
        ("b.gpx", "Track", None, "MULTILINESTRING ((2 1, 4 3), (6 5, 8 7))"),
        ("c.gpx", "Waypoint", "P", "POINT (8 9)"),
    }


def test_gpx_points_equal_the_points_in_the_text_and_load_as_geometry(spark, tmp_path):
    write(tmp_path / "a.gpx", GPX_11)
    tours = geofiles.read_gpx(spark, str(tmp_path / "*.gpx")).withColumn("g", wkt.parse_wkt(F.col("wkt")))
    commas = F.when(F.col("wkt") == "", 0).otherwise(F.regexp_count("wkt", F.lit(",")) + 1)
    checked = tours.select((wkt.point_count(F.col("g")) == commas).alias("ok"), wkt.is_empty(F.col("g")).alias("e"))
    assert [tuple(r) for r in checked.collect()].count((True, True)) == 1
    assert checked.filter("not ok").count() == 0 and checked.count() == 4


def test_geojson_features(spark, tmp_path):
    ring = [[i / 7, -i / 3] for i in range(400)]
    features = [
        {"type": "Feature", "properties": {"name": "A", "ISO3166-1-Alpha-3": "AAA"},
         "geometry": {"type": "Polygon", "coordinates": [ring]}},
        {"type": "Feature", "properties": {"name": "B"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[ring[:4]], [ring[:5]]]}},
    ]
    path = write(tmp_path / "c.geojson", json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    got = geofiles.read_geojson(spark, path, name="name", iso="ISO3166-1-Alpha-3")
    rows = {r["name"]: r for r in got.collect()}
    assert rows["A"]["iso"] == "AAA" and rows["B"]["iso"] is None
    assert json.loads(rows["A"]["geometry"]) == features[0]["geometry"] and len(rows["A"]["geometry"]) > 4000
    assert ": " not in rows["B"]["geometry"]
    points = got.select("name", wkt.point_count(wkt.parse_geojson(F.col("geometry"))).alias("n"))
    assert {tuple(r) for r in points.collect()} == {("A", 400), ("B", 9)}
    assert profile.length_profile(got, "geometry").first()["n_over"] == 1


def test_binary_files_are_identical_by_length_and_md5(spark, tmp_path):
    blob = bytes(range(256)) * 40
    (tmp_path / "p1.jpg").write_bytes(blob)
    (tmp_path / "p2.jpg").write_bytes(blob[:-1])
    (tmp_path / "readme.md").write_text("not a photo")
    files = blobs.read_binary(spark, str(tmp_path / "*.jpg"))
    rows = {r["name"]: r for r in files.select("name", "length", *fingerprint(F.col("content"))).collect()}
    assert set(rows) == {"p1.jpg", "p2.jpg"} and rows["p1.jpg"]["length"] == len(blob) == rows["p1.jpg"]["n_bytes"]
    assert rows["p1.jpg"]["md5"] == hashlib.md5(blob).hexdigest() != rows["p2.jpg"]["md5"]


TIMESHEET = [
    ["Please fill in one row per task"],
    None,
    ["date", "time_from", "time_to", "project", "task"],
    [45658, 0.375, 0.5, "ERP", "Meeting with O'Brien"],
    [45659.0, "13:00", "17:30:15", "ERP", 'Say "hi" & <bye>'],
    None,
    ["2025-01-03", 0.354166666666667, 0.999988425925926, None, None],
]


@pytest.mark.parametrize("shared", [True, False])
def test_timesheets_of_many_workbooks(spark, tmp_path, shared):
    write_workbook(tmp_path / "IT.xlsx", {"Ann": TIMESHEET, "Bob": TIMESHEET[:4]}, shared)
    write_workbook(tmp_path / "Human Resources.xlsx", {"Eve": TIMESHEET[:5]}, shared)
    (tmp_path / "Report.txt").write_text("report")
    got = workbooks.read_timesheets(spark, str(tmp_path / "*.xlsx"))
    assert got.columns == ["Department", "Person", "Start", "End", "Project", "Task"]
    rows = {(r["Department"], r["Person"], r["Start"]): r for r in got.collect()}
    assert len(rows) == 3 + 1 + 2
    first = rows["IT", "Ann", datetime.datetime(2025, 1, 1, 9)]
    assert first["End"] == datetime.datetime(2025, 1, 1, 12) and first["Task"] == "Meeting with O'Brien"
    second = rows["Human Resources", "Eve", datetime.datetime(2025, 1, 2, 13)]
    assert second["End"] == datetime.datetime(2025, 1, 2, 17, 30, 15) and second["Task"] == 'Say "hi" & <bye>'
    last = rows["IT", "Ann", datetime.datetime(2025, 1, 3, 8, 30)]
    assert last["End"] == datetime.datetime(2025, 1, 3, 23, 59, 59) and last["Project"] is None
    minutes = profile.minutes_by(got, ["Department"], "Start", "End")
    assert {tuple(r) for r in minutes.collect()} == {("IT", 180 + 270 + 929 + 180), ("Human Resources", 450)}


def test_sheets_keep_blank_rows_until_they_are_dropped(spark, tmp_path):
    write_workbook(tmp_path / "f.xlsx", {"Status": TIMESHEET, "Other": TIMESHEET})
    rows = workbooks.read_sheets(spark, str(tmp_path / "f.xlsx"), sheet="Status")
    assert [(r["row_no"], len(r["cells"])) for r in rows.orderBy("row_no").collect()] == [(4, 5), (5, 5), (6, 0), (7, 3)]


def test_no_workbooks_give_no_rows_but_the_columns(spark, tmp_path):
    got = workbooks.read_timesheets(spark, str(tmp_path / "*.xlsx"))
    assert got.count() == 0 and "Department" in got.columns


def test_documents_with_different_keys(spark, tmp_path):
    write(tmp_path / "a.json", '{"_id": 1, "Location": "Canada", "Tags": [{"T": "x"}]}\n')
    write(tmp_path / "b.json", '{"_id": 2, "Website": "w", "Place": {"City": "Ulm"}}\n{"_id": 3, "Location": "Canada"}\n')
    docs = collections.read_collection(spark, str(tmp_path / "*.json"))
    rows = {r["_id"]: r for r in docs.collect()}
    assert rows[1]["Website"] is None and rows[2]["Place"]["City"] == "Ulm" and rows[1]["Tags"][0]["T"] == "x"
    found = collections.find(docs, {"Location": "Canada"}, {"_id": 1}, [("_id", -1)], first=1)
    assert [tuple(r) for r in found.collect()] == [(3,)]
    assert collections.find(docs, {"Place.City": "Ulm"}).count() == 1
    assert collections.find(docs, {"Location": None}).count() == 1
    assert "Tags" not in collections.find(docs, project={"Tags": 0}).columns
    skipped = collections.find(docs, sort=[("_id", 1)], skip=1, first=5)
    assert [r["_id"] for r in skipped.collect()] == [2, 3]


def test_every_row_of_a_large_file_arrives(spark, tmp_path):
    body = "".join(f'  <row Id="{i}" Name="n&amp;{i}" Date="2024-01-01T00:00:00.{i % 1000:03d}" />\n' for i in range(12220))
    path = write(tmp_path / "big.xml", f'﻿<?xml version="1.0"?>\n<rows>\n{body}</rows>\n')
    got = lines.import_files(spark, path, BADGES, {"CreationDate": "Date"})
    expected = spark.range(12220).select(
        F.col("id").cast("int").alias("Id"), F.concat(F.lit("n&"), "id").alias("Name"),
        (F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))
         + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("id") % 1000 / 1000).cast("decimal(18,6)"))).alias("CreationDate"),
    )
    result = reconcile.rows_equal(got, expected).first()
    assert result["equal"] and result["n_left"] == 12220
