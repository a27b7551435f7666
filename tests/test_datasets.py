"""The declared data sets on literal raw rows."""

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quarryline.datasets import boundaries, postcodes, price_paid, road_collisions, schools, street_crime
from quarryline.operators import codebook
from quarryline.sources.text import text_schema

AS_OF = date(2024, 11, 5)
NOW = datetime(2024, 11, 5, 12)


def _sale(**changes):
    row = dict(zip(price_paid.COLUMNS, ("{id}", "250000", "2020-05-06 00:00", " AB1 2CD ", "D", "Y", "F", "1", None, "Road", None, "Town", "Dist", "KENT", "A", "A"), strict=True))
    return {**row, **changes}


def test_price_paid(spark):
    raw = spark.createDataFrame([tuple(_sale().values()), tuple(_sale(old_new=None, price="1").values())], text_schema(price_paid.COLUMNS))
    sales = price_paid.clean(raw, NOW)
    first = sales.first()
    assert sales.columns == [*price_paid.COLUMNS, "datetime_download"]
    assert (first["price"], first["date"], first["postcode"], first["property_type"]) == (250000.0, date(2020, 5, 6), "AB1 2CD", "detached")
    assert sales.filter("old_new is null").count() == 1 and first["datetime_download"] == NOW
    assert price_paid.unknown_codes(raw).count() == 0


@pytest.mark.parametrize("change", [{"property_type": "Z"}, {"price": "dear"}, {"date": "2020"}])
def test_price_paid_is_strict(spark, change):
    raw = spark.createDataFrame([tuple(_sale(**change).values())], text_schema(price_paid.COLUMNS))
    with pytest.raises(PySparkException):
        price_paid.clean(raw, NOW).collect()
    if "property_type" in change:
        assert price_paid.unknown_codes(raw).first()["unknown"] == ["property_type"]


def test_price_paid_files_and_periods(spark, tmp_path):
    lines = ['"{A}","1","2020-05-06 00:00","AB1","D","Y","F","1","","Road","","T","D","K","A","A"', '"{B}","2","2021-05-06 00:00","","S","N","L","1","","Road","","T","D","K","B","A"']
    (tmp_path / "pp-2020.csv").write_text("\n".join(lines) + "\n")
    sales = price_paid.clean(price_paid.read_raw(spark, str(tmp_path / "pp-*.csv")), NOW)
    wanted = price_paid.years(spark, AS_OF)
    assert wanted.count() == 30 and wanted.agg(F.max("period")).first()[0] == date(2024, 1, 1)
    path = str(tmp_path / "landed")
    assert price_paid.land(sales, wanted, path).count() == 30
    assert price_paid.land(sales, wanted, path).count() == 0  # years without sales are landed too
    back = price_paid.read(spark, path)
    assert back.filter("postcode = ''").count() == 1 and back.count() == 2
    assert price_paid.manifest(wanted).orderBy("period").first()["file_name"] == "pp-1995.csv"


CRIME = ("c1", "2020-03", "Devon & Cornwall Police", "Dyfed-Powys Police", "-0.5", "51.5", "On", "E01", "Area", "Violent crime", None, None)


def test_street_crime(spark):
    raw = spark.createDataFrame([CRIME, (None, "2020-03", "Kent Police", None, None, None, "", None, None, "Drugs", "x", "y")], text_schema(street_crime.RAW_COLUMNS))
    rows = street_crime.clean(raw, NOW).orderBy("crime_type").collect()
    assert rows[1]["force_reported_by"] == "devon_and_cornwall_police" and rows[1]["force_falls_within"] == "dyfed_powys_police"
    assert rows[1]["crime_type"] == "violence_and_sexual_offences" and rows[1]["month"] == date(2020, 3, 1) == rows[1]["date"]
    assert rows[0]["force_falls_within"] is None and rows[0]["crime_type"] == "drugs"
    bad = spark.createDataFrame([(*CRIME[:9], "Piracy", None, None)], text_schema(street_crime.RAW_COLUMNS))
    with pytest.raises(PySparkException, match="Piracy"):
        street_crime.clean(bad, NOW).collect()


def test_street_crime_domains():
    assert len(street_crime.FORCE_CODES) == 45 and len(street_crime.CRIME_CODES) == 17 and len(street_crime.DOMAINS["crime_type"]) == 15


def test_street_crime_reads_only_street_files(spark, tmp_path):
    header = ",".join(street_crime.RAW_COLUMNS)
    line = ",".join(v or "" for v in CRIME)
    for name in ("2020-03-kent-street.csv", "2020-03-kent-outcomes.csv", "2020-03-x-street-outcomes.csv", "kent-street.csv"):
        (tmp_path / "2020-03").mkdir(exist_ok=True)
        (tmp_path / "2020-03" / name).write_text(f"{header}\n{line}\n")
    raw = street_crime.read_raw(spark, str(tmp_path))
    assert raw.count() == 1
    (tmp_path / "2020-03" / "2020-04-kent-street.csv").write_text(f"{header}\n{line}\n{line}\n")
    by_month = [street_crime.read_raw(spark, str(tmp_path), m).count() for m in ([date(2020, 3, 1)], [date(2020, 4, 1)], [date(2020, 3, 1), date(2020, 4, 1)])]
    assert by_month == [1, 2, 3]
    stamped = street_crime.clean(street_crime.read_raw(spark, str(tmp_path)), F.col("_metadata.file_modification_time"))
    assert stamped.filter("datetime_download > TIMESTAMP_NTZ '2020-01-01 00:00:00'").count() == 3
    crimes = street_crime.clean(raw, NOW)
    path = str(tmp_path / "landed")
    assert street_crime.land(crimes, street_crime.months(spark, AS_OF), path).count() > 100
    assert street_crime.read(spark, path).first()["period"] == date(2020, 3, 1)


def test_months_and_archives(spark):
    months = street_crime.months(spark, AS_OF)
    ends = months.agg(F.min("period"), F.max("period"), F.count("period")).first()
    assert tuple(ends) == (date(2010, 12, 1), date(2024, 5, 1), 162)
    found = {str(r["period"])[:7]: (r["archive"], r["archive_is_fallback"]) for r in street_crime.archive_of_month(months, street_crime.archives(spark)).collect()}
    assert found["2010-12"] == ("2010-12_2017-04", False) and found["2017-05"] == ("2017-05_2020-04", False)
    assert found["2023-04"] == ("2020-05_2023-04", False) and found["2023-05"] == ("latest", True)
    urls = {r["label"]: r["url"] for r in street_crime.archive_urls(street_crime.archives(spark)).collect()}
    assert urls["2010-12_2017-04"] == "https://data.police.uk/data/archive/2017-04.zip"


@pytest.mark.parametrize(
    ("start", "end", "expected"),
    [("2015-06-01", "2019-02-01", "2015-06-01_2019-02-01.zip"), (None, None, "latest_2031-08-09.zip"), ("2015-06-01", None, None), (None, "2019-02-01", None)],
)
def test_archive_name(spark, start, end, expected):
    df = spark.createDataFrame([(start, end)], "s string, e string").selectExpr("CAST(s AS DATE) AS s", "CAST(e AS DATE) AS e")
    named = df.select(street_crime.archive_name(F.col("s"), F.col("e"), F.lit("2031-08-09").cast("date")))
    if expected:
        assert named.first()[0] == expected
    else:
        with pytest.raises(PySparkException, match="should both be null or neither"):
            named.collect()


def test_archive_digests(spark):
    rows = [("a", bytearray(b"x"), "9dd4e461268c8034f5c8564e155c67a6"), ("b", bytearray(b"y"), "9dd4e461268c8034f5c8564e155c67a6"), ("c", bytearray(b"z"), None)]
    checked = street_crime.verify(spark.createDataFrame(rows, "label string, content binary, expected string"))
    assert {r["label"]: r["state"] for r in checked.collect()} == {"a": "ok", "b": "mismatch", "c": "unverified"}


BOOK = [
    ("accident", "accident_severity", "1", "Fatal"), ("accident", "accident_severity", "2", "Serious"),
    ("accident", "enhanced_collision_severity", "5", "Very Serious"), ("accident", "enhanced_collision_severity", "-1", "Missing"),
    ("vehicle", "vehicle_type", "9", "Car"), ("casualty", "casualty_class", "3", "Pedestrian"),
]


def test_road_collisions(spark, tmp_path):
    book = spark.createDataFrame(BOOK, ["table", "field name", "code/format", "label"])
    raw = {
        "collision": "accident_index,accident_year,accident_reference,date,time,latitude,accident_severity,enhanced_severity_collision,first_road_number,speed_limit,extra\n"
        "2020A,2020,01A,05/06/2020,17:30,51.5,2,5,-1,-1,keep\n2020B,2020,02,xx,-1,NULL,2,-1,7,30,\n",
        "vehicle": "accident_index,accident_reference,vehicle_reference,vehicle_type,age_of_driver,engine_capacity_cc,escooter_flag,dir_from_e\n2020A,01A,1,9,-1,-1,0,-1\n2020A,01A,2,8,44,1600,true,x\n",
        "casualty": "accident_index,accident_reference,vehicle_reference,casualty_class,age_of_casualty\n2020A,01A,1,3,-1\n",
    }
    paths = {}
    for table, content in raw.items():
        paths[table] = str(tmp_path / f"{table}-1979-latest-published-year.csv")
        (tmp_path / f"{table}-1979-latest-published-year.csv").write_text(content)
    root = str(tmp_path / "derived")
    road_collisions.derive(spark, paths, book, root)
    tables = road_collisions.read(spark, root)
    a, b = tables["collision"].orderBy("accident_index").collect()
    assert (a["severity"], a["first_road_number"], a["speed_limit"], a["time"], a["date"]) == ("Serious - Very Serious", None, -1, "17:30:00", date(2020, 6, 5))
    assert (b["severity"], b["first_road_number"], b["latitude"], b["time"], b["date"], b["extra"]) == ("Serious", 7, None, None, None, None)
    assert a["accident_reference"] == "01A" and a["extra"] == "keep"
    v1, v2 = tables["vehicle"].orderBy("vehicle_reference").collect()
    assert (v1["vehicle_type"], v1["age_of_driver"], v1["engine_capacity_cc"], v1["escooter_flag"], v1["dir_from_e"]) == ("Car", None, -1, False, None)
    assert (v2["vehicle_type"], v2["age_of_driver"], v2["escooter_flag"]) == (None, 44, True)
    assert tables["casualty"].first()["age_of_casualty"] == -1
    titled = road_collisions.read(spark, root, ["vehicle"], "title")
    assert list(titled) == ["vehicle"] and "Age Of Driver" in titled["vehicle"].columns
    joined = tables["casualty"].join(tables["vehicle"], ["accident_index", "vehicle_reference"])
    assert joined.count() == 1


def test_road_declarations():
    assert {t: len(s) for t, s in road_collisions.SCHEMAS.items()} == {"vehicle": 34, "collision": 37, "casualty": 21}


def test_directory_has_93_columns(spark):
    rules = postcodes.RECODED
    direct = postcodes.direct_columns(NOW)
    assert len(rules) + len(postcodes.CODE_COLUMNS) + len(direct) == 93
    assert len({r.output for r in rules} | set(postcodes.CODE_COLUMNS.values()) | set(direct)) == 93


def _directory(spark, tmp_path, **changes):
    folder = tmp_path / "Documents"
    folder.mkdir()
    for part in dict.fromkeys(r.file_part for r in postcodes.RECODED):
        body = "code,label,label2,label3\n" + "".join(f"X{i},{part[:5]} {i},second {i},third {i}\n" for i in range(70)) + "X1,last,last 2,last 3\nX99,,,\n"
        (folder / f"{part} 11_24.csv").write_text(body)
    base = {"pcds": "AB1 2CD", "pcd": "AB12CD", "pcd2": "AB1 2CD", "dointr": "198001", "doterm": "", "lat": "99.999999", "long": "0.000000", "oseast1m": "", "osnrth1m": "5", "osgrdind": "9", "usertype": "0", "ctry": "W92000004", "imd": "0"}
    codes = {s: "X1" for s in postcodes.CODE_COLUMNS if s not in base}
    codes |= {"oscty": "", "ur01ind": " ", "streg": None, "ced": "X_new", "lep2": "E99999999", "calncv": "E56000035", "itl": "second 3"}
    row = {**base, **codes, **changes}
    raw = spark.createDataFrame([tuple(row.values())], text_schema(row))
    files = {p: postcodes.read_lookup(spark, path) for p, path in postcodes.lookup_files(spark, str(folder)).items()}
    return raw, files


def test_directory(spark, tmp_path):
    raw, files = _directory(spark, tmp_path)
    directory = postcodes.clean_directory(raw, files, NOW)
    row = directory.first()
    assert len(directory.columns) == 93
    assert row["county"] == row["urban_rural_indicator_census_2001"] == row["standard_statistical_region"] == row["county_electoral_division"] == row["cancer_alliance"] == "Unknown"
    assert row["local_authority"] == "last" and row["region"] == "last 2" and row["output_area_classification_subgroup_census_2011"] == "last 3"
    assert row["local_enterprise_partnership_overlap"] == "(pseudo) England (UA/MD/LB)" and row["international_territorial_level"] == "third 3"
    assert row["is_live"] is True and row["date_end"] is None and row["date_start"] == date(1980, 1, 1)
    assert row["easting"] is None and row["northing"] == 5 and row["index_of_multiple_deprivation"] is None
    assert row["county_code"] == "" and row["county_electoral_division_code"] == "X_new" and abs(row["latitude"] - 99.999999) < 1e-4
    cleared = postcodes.clean_directory(raw, files, NOW, null_island=True).first()
    assert cleared["latitude"] is None and cleared["longitude"] is None
    root = str(tmp_path / "out")
    assert postcodes.land_directory(directory, root, "2024-11-01") and not postcodes.land_directory(directory, root, "2024-11-01")


def test_directory_is_strict(spark, tmp_path):
    raw, files = _directory(spark, tmp_path, oslaua="nowhere")
    with pytest.raises(PySparkException, match="unmapped oslaua: nowhere"):
        postcodes.clean_directory(raw, files, NOW).collect()


def test_directory_watch_sees_codes_whose_labels_are_not_selected(spark, tmp_path):
    raw, files = _directory(spark, tmp_path, oslaua="nowhere", ctry="W92000004", pfa="also nowhere")
    watch = codebook.DomainWatch()
    directory = postcodes.clean_directory(raw, files, NOW, watch=watch).select("postcode", "local_authority_code")
    root = tmp_path / "out"
    with pytest.raises(ValueError, match="oslaua: 1 rows, such as 'nowhere'"):
        postcodes.land_directory(directory, str(root), "2024-11-01", watch)
    assert not (root / "release=2024-11-01").exists()
    assert {c for c, n, _ in watch.counts() if n} == {"oslaua", "pfa"}


def test_watched_directory_without_unknown_codes(spark, tmp_path):
    raw, files = _directory(spark, tmp_path)
    watch = codebook.DomainWatch()
    directory = postcodes.clean_directory(raw, files, NOW, watch=watch)
    assert postcodes.land_directory(directory, str(tmp_path / "out"), "2024-11-01", watch)
    assert [c for c, n, _ in watch.counts() if n] == [] and len(watch.counts()) > 5
    plain = postcodes.clean_directory(raw, files, NOW)
    assert spark.read.parquet(str(tmp_path / "out" / "release=2024-11-01")).first() == plain.first()


def test_lookup_file_must_be_unique(spark, tmp_path):
    _directory(spark, tmp_path)
    (tmp_path / "Documents" / "copy of County names and codes UK as at 12_24.csv").write_text("a,b\n")
    with pytest.raises(ValueError, match="exactly one"):
        postcodes.lookup_files(spark, str(tmp_path / "Documents"))


def test_boundary_catalogue(spark):
    assert len(boundaries.CATALOGUE) == 46 and boundaries.catalogue(spark).filter("rows_per_request < 2000").count() == 4
    layer = boundaries.CATALOGUE["LAD_MAY_2024_UK_BFC"]
    assert (layer.key, layer.rows_per_request, layer.short_name) == ("boundaries_lad_may_2024_uk_bfc", 50, "LAD24")
    counts = spark.createDataFrame([(520,)], "count bigint")
    manifest = boundaries.chunk_manifest(counts, layer, "http://server").orderBy("chunk").collect()
    assert len(manifest) == 11 and (manifest[10]["id_start"], manifest[10]["id_end"], manifest[3]["label"]) == (501, 520, "03")
    assert manifest[0]["url"].endswith("query?outFields=*&where=1%3D1+AND+OBJECTID+BETWEEN+1+AND+50&f=geojson")
    landed = spark.range(1, 521).filter("id <> 77").withColumnRenamed("id", "object")
    gaps = boundaries.chunk_gaps(boundaries.chunk_manifest(counts, layer, "x"), landed, layer, "object").collect()
    assert [(r["chunk"], r["n_landed"]) for r in gaps] == [(1, 49)]


def test_services(spark):
    body = '{"services": [{"name": "A", "type": "FeatureServer", "url": "u"}, {"name": "B", "type": "MapServer", "url": "v"}]}'
    got = boundaries.services(spark.createDataFrame([(body,)], "body string"), "body").collect()
    assert [tuple(r) for r in got] == [("A", "FeatureServer", "u"), ("B", "MapServer", "v")]


def test_schools(spark):
    years = [r[0].year for r in schools.years(spark, AS_OF).orderBy("period").collect()]
    assert years == [y for y in range(1992, 2024) if y not in (1995, 2020)]
    page = "<input name='datatypes' value='ks4'><input name='datatypes' value='abs'>"
    typed = schools.data_types(schools.years(spark, AS_OF).withColumn("html", F.lit(page)), "html")
    rows = {r["period"].year: r for r in schools.manifest(typed, "data_types").collect()}
    assert "fileformat=xls&year=1992-1993" in rows[1993]["url"] and "filters=ABS,KS4&fileformat=csv" in rows[2011]["url"]
    assert rows[2010]["url_meta"] is None and rows[2011]["file_name_meta"] == "2011-01-01_meta.zip"


def _member(folder, archive, name, rows):
    place = folder / archive
    place.mkdir(exist_ok=True)
    lines = [",".join(street_crime.RAW_COLUMNS)]
    lines += [f"{r},2021-07,Kent Police,Kent Police,,,Somewhere,E1,Area,Drugs,," for r in rows]
    (place / name).write_text("\n".join(lines) + "\n")


def test_a_month_is_read_from_its_archive_alone(spark, tmp_path):
    _member(tmp_path, "2020-05_2023-04", "2021-07-kent-street.csv", ["a", "b"])
    _member(tmp_path, "2020-05_2023-04", "2021-07-kent-street-outcomes.csv", ["no"])
    _member(tmp_path, "2020-05_2023-04", "2021-08-kent-street.csv", ["no"])
    _member(tmp_path, "latest", "2021-07-kent-street.csv", ["no"])
    _member(tmp_path, "latest", "2024-02-kent-street.csv", ["c"])
    wanted = spark.createDataFrame([(date(2021, 7, 1),), (date(2024, 2, 1),), (date(2024, 3, 1),)], "period date")
    files = street_crime.member_files(spark, str(tmp_path), wanted, street_crime.archives(spark))
    raw = street_crime.read_members(spark, files)
    got = sorted((r["Crime ID"], str(r["period"]), r["archive"]) for r in raw.collect())
    assert got == [("a", "2021-07-01", "2020-05_2023-04"), ("b", "2021-07-01", "2020-05_2023-04"), ("c", "2024-02-01", "latest")]
    assert raw.filter("downloaded is null").count() == 0
    none = street_crime.read_members(spark, files.filter("false"))
    assert none.columns == raw.columns and none.count() == 0
