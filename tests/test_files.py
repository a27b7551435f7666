"""Readers, listings and incremental landing on small files."""

import json
import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quarryline import session
from quarryline.datasets import boundaries
from quarryline.operators import quality
from quarryline.sinks import landing, paths
from quarryline.sources import files, text


def _write(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content)
    return str(path)


def test_quoted_empty_is_not_missing(spark, tmp_path):
    path = _write(tmp_path / "a.csv", 'x,y\n"",1\n,2\nnull,3\n"a ""b"", c",4\n" d ",5\n')
    rows = {r["y"]: r["x"] for r in text.read_csv(spark, path, ["x", "y"]).collect()}
    assert rows == {"1": "", "2": None, "3": "null", "4": 'a "b", c', "5": " d "}


def test_ragged_line_fails(spark, tmp_path):
    path = _write(tmp_path / "a.csv", "x,y\n1,2\n1,2,3\n")
    with pytest.raises(Exception, match="MALFORMED"):
        text.read_csv(spark, path, ["x", "y"]).collect()


def test_typed_read(spark, tmp_path):
    good = _write(tmp_path / "g.csv", "n,d\n1,2020-01-02\n,\n")
    rows = text.read_csv_typed(spark, good, {"n": "int", "d": "date"})
    assert rows.dtypes == [("n", "int"), ("d", "date")] and rows.filter("n is null and d is null").count() == 1
    bad = _write(tmp_path / "b.csv", "n,d\nx,2020-01-02\n")
    with pytest.raises(PySparkException):
        text.read_csv_typed(spark, bad, {"n": "int", "d": "date"}).collect()
    assert text.profile_types(spark, good)["n"] == "int"


def test_blank_header_fields_keep_their_place(spark, tmp_path):
    path = _write(tmp_path / "h.csv", "a,,c,\nx,y,z,\n")
    assert text.header_of(spark, path) == ["a", "column_2", "c", "column_4"]
    assert text.header_of(spark, path, 1) == ["x", "y", "z", "column_4"]


def test_sidecar_header_and_glob(spark, tmp_path):
    header = _write(tmp_path / "Doc" / "headers.csv", "PC,EA,NO\nPostcode,Eastings,Northings\n")
    _write(tmp_path / "Data" / "CSV" / "ab.csv", '"AB1",1,2\n')
    _write(tmp_path / "Data" / "CSV" / "cd.csv", '"CD1",3,4\n')
    df = text.read_csv_sidecar(spark, str(tmp_path / "Data/CSV/*.csv"), header)
    assert df.columns == ["Postcode", "Eastings", "Northings"]
    assert sorted(r[0] for r in df.collect()) == ["AB1", "CD1"]


def test_file_order_follows_the_file(spark, tmp_path):
    path = _write(tmp_path / "a.csv", "code,label\n" + "".join(f"c{i % 3},v{i}\n" for i in range(30)))
    df = text.read_csv(spark, path, ["code", "label"]).withColumn("at", text.file_order())
    last = df.groupBy("code").agg(F.max_by("label", "at").alias("label"))
    assert {r["code"]: r["label"] for r in last.collect()} == {"c0": "v27", "c1": "v28", "c2": "v29"}


def test_listing_keys_and_latest(spark, tmp_path):
    for i, name in enumerate(["vehicle-1979.csv", "casualty-1979.csv", "guide-2024.csv", "note.txt"]):
        path = _write(tmp_path / "raw" / name, "x\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    listed = files.listing(spark, str(tmp_path / "raw"), "*.csv")
    keyed = files.keyed(listed, exclude=["guide-2024"])
    assert {r["key"]: r["name"] for r in keyed.collect()} == {"vehicle": "vehicle-1979.csv", "casualty": "casualty-1979.csv"}
    assert files.latest(listed).first()["path"].endswith("guide-2024.csv")


def test_member_rules(values):
    names = ["2020-01-kent-street.csv", "2020-01-kent-outcomes.csv", "2020-02-kent-street.csv", "2020-01-street.csv.old", "x2020-01-street.csv"]
    t = F.col("t")
    assert values(names, files.is_member(t, F.lit("2020-01-01").cast("date"))) == [True, False, False, True, False]
    assert values(["Doc/Ward names.csv", "Doc/Ward names.txt"], files.contains_member(t, "Ward names")) == [True, False]


def test_exactly_one(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, None)], "k int, name string")
    assert sorted(tuple(r) for r in quality.exactly_one(df, ["k"], "name").collect()) == [(1, "a"), (2, "b")]
    many = df.unionByName(df)
    with pytest.raises(PySparkException, match="expected exactly one name, found 2"):
        quality.exactly_one(many, ["k"], "name").collect()
    assert quality.match_counts(many, ["k"], "name").count() == 2
    is_a = F.col("name") == "a"
    assert [tuple(r) for r in quality.match_counts(df, ["k"], "name", is_a).collect()] == [(2, 0)]
    with pytest.raises(PySparkException, match="expected exactly one name, found 0"):
        quality.exactly_one(df, ["k"], "name", is_a).collect()


def test_chunk_gaps_sees_strays(spark):
    manifest = spark.createDataFrame([(0, 1, 3), (1, 4, 5)], "chunk bigint, id_start bigint, id_end bigint")
    ids = spark.createDataFrame([(i,) for i in (1, 2, 3, 3, 4, 6, 7, 8, 9)] + [(None,)], "id bigint")
    got = quality.chunk_gaps(manifest, ids, "id", 3).select("chunk", "n_declared", "n_landed", "n_stray")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 2, 1, 1), (2, 0, 0, 3)]


def test_geojson_chunks(spark, tmp_path):
    layer = boundaries.CATALOGUE["LAD_MAY_2024_UK_BFC"]
    for chunk in range(2):
        feature = (
            '{"type":"Feature","id":%d,"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]},'
            '"properties":{"LAD24CD":"E%d","LAD24NM":"Name %d","other":1}}' % (chunk, chunk, chunk)
        )
        _write(tmp_path / f"{layer.key}.{chunk}.geojson", '{\n "type":"FeatureCollection",\n "features":[\n%s\n]}' % feature)
    df = boundaries.read_layer(spark, str(tmp_path), layer, boundaries.DISTRICT_PROPERTIES)
    assert sorted((r["LAD24CD"], r["LAD24NM"], r["geometry"]["type"]) for r in df.collect()) == [("E0", "Name 0", "Polygon"), ("E1", "Name 1", "Polygon")]
    assert boundaries.edges(df, "LAD24CD").count() == 6
    assert boundaries.read_latest(spark, str(tmp_path)).count() == 1
    assert boundaries.generalised_rings(df, "LAD24CD").count() == 2


PROPERTIES = "name string, n bigint"


def _features(n, spaced=""):
    rng = random.Random(4)
    for i in range(n):
        ring = [[round(rng.uniform(-9, 3), 5), i / 7] for _ in range(rng.randrange(4, 60))]
        name = rng.choice(["plain", 'quoted "type":"Feature", as it were', "Feature", '{\\"type\\":\\"Feature\\"', "line\nend", "é]}{"])
        geometry = None if i % 50 == 9 else {"type": "Polygon", "coordinates": [ring]}
        rest = {"id": i, "geometry": geometry, "properties": {"n": i, "name": name, "other": [1, {"type": "x"}]}}
        yield f'{{{spaced}"type":{spaced}"Feature",' + json.dumps(rest, indent=1 if i % 3 == 0 else None)[1:]


@pytest.mark.parametrize("spaced", ["", " ", "\n  "])
def test_one_large_geojson_file_is_read_by_many_tasks(spark, tmp_path, spaced):
    body = f'{{"type":{spaced}"FeatureCollection","crs":{{"name":"x"}},\n"features":[' + ",\n".join(_features(3_000, spaced)) + '],"end":[1]}'
    path = _write(tmp_path / "a.geojson", body)
    _write(tmp_path / "b.geojson", '{"type":"FeatureCollection","features":[]}')
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    cut, whole = (files.read_geojson(session, str(tmp_path / "*.geojson"), PROPERTIES, whole=w) for w in (False, True))
    assert cut.schema == whole.schema
    # The text of coordinates may differ by blanks.
    rows, expected = (sorted(repr((r["id"], r["name"], r["n"], r["geometry"] and json.loads(r["geometry"]["coordinates"]))) for r in df.collect()) for df in (cut, whole))
    assert rows == expected and len(rows) == 3_000
    tasks = [r["n"] for r in files.read_geojson(session, path, PROPERTIES).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(tasks) >= 5 and max(tasks) < 1_000


def test_features_that_begin_otherwise_are_not_lost(spark, tmp_path):
    first = _write(tmp_path / "a.geojson", '{"type":"FeatureCollection","features":[%s]}' % ",".join(_features(3)))
    other = '{"type":"FeatureCollection","features":[{"id":"x","type":"Feature","properties":{"n":1}}]}'
    second = _write(tmp_path / "b.geojson", other)
    with pytest.raises(PySparkException, match="does not begin with its type"):
        files.read_geojson(spark, [first, second], PROPERTIES).collect()
    assert files.read_geojson(spark, [first, second], PROPERTIES, whole=True).count() == 4
    assert [r["id"] for r in files.read_geojson(spark, second, PROPERTIES).collect()] == ["x"]  # no border there: read whole
    mixed = _write(tmp_path / "c.geojson", other.replace("]}", ',{"type":"Feature","id":"y","properties":{"n":2}},{"id":"z","type":"Feature"}]}'))
    with pytest.raises(PySparkException, match="does not begin with its type"):
        files.read_geojson(spark, mixed, PROPERTIES, border='{"type":"Feature"').collect()


def test_status_and_payload(spark):
    manifest = spark.createDataFrame([("k", "http://a", 200), ("k2", "http://b", 404), ("k3", None, None)], "key string, url string, status int")
    bad = quality.bad_status(manifest, "status", "key", "url")
    assert [r["message"] for r in bad.orderBy("key").collect()] == ["bad response for k2 at http://b: 404", "bad response for k3 at null: null"]
    quality.require_none(bad.filter("status = 200"), "fine")
    with pytest.raises(ValueError, match="responses"):
        quality.require_none(bad, "responses")


# ---- landing ---------------------------------------------------------------


def _periods(spark, *rows):
    return spark.createDataFrame(rows, "p string, v int").select(F.to_date("p").alias("period"), "v")


def test_land_only_what_is_missing(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = _periods(spark, ("2020-01-01", 1), ("2020-01-01", 2), ("2021-01-01", 3))
    wanted = rows.select("period").distinct()
    early = "period < '2021-01-01'"
    with pytest.raises(PySparkException, match="outside the calendar: 2021-01-01"):
        landing.land(rows, wanted.filter(early), path, "period")
    assert landing.outside_calendar(rows, wanted.filter(early), "period").count() == 1
    assert landing.land(rows.filter(early), wanted.filter(early), path, "period").count() == 1
    changed = rows.withColumn("v", F.col("v") * 10)
    late = landing.land(changed, wanted, path, "period")
    assert [str(r[0]) for r in late.collect()] == ["2021-01-01"]
    assert sorted(r["v"] for r in landing.read_complete(spark, path).collect()) == [1, 2, 30]
    assert landing.land(changed, wanted, path, "period").count() == 0
    undated = rows.withColumn("period", F.lit(None).cast("date"))
    assert landing.land(undated, wanted, path, "period").count() == 0  # nothing is missing, nothing is read
    later = wanted.unionByName(spark.createDataFrame([("2022-01-01",)], "p string").select(F.to_date("p").alias("period")))
    with pytest.raises(PySparkException, match="outside the calendar: null"):
        landing.land(undated, later, path, "period")
    assert landing.land(changed, later, path, "period").count() == 1  # a year without rows is landed once
    assert landing.land(undated, later, path, "period").count() == 0
    landing.remove_file(spark, f"{path}/_SUCCESS")
    with pytest.raises(FileNotFoundError):
        landing.read_complete(spark, path)


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", ["commit_version", "move_folder", "touch", "remove_folder"])
def test_a_stopped_landing_is_whole_or_absent(spark, tmp_path, monkeypatch, step):
    """Stopped before, between and after the moves; one of three years has no rows."""
    path = str(tmp_path / "t")
    wanted = spark.sql("select explode(sequence(date'2019-01-01', date'2022-01-01', interval 1 year)) as period")
    rows = spark.sql("select * from values (1, date'2019-01-01'), (2, date'2020-01-01'), (3, date'2022-01-01') t(v, period)")
    landing.land(rows.filter("v = 1"), wanted.filter("period < date'2020-01-01'"), path, "period")
    done = []

    def stop(*args):
        if len(done) == (1 if step == "move_folder" else 0):  # after the first of two moves
            raise Stopped
        done.append(args)
        real(*args)

    real = getattr(landing, step)
    with monkeypatch.context() as patch, pytest.raises(Stopped):
        patch.setattr(landing, step, stop)
        landing.land(rows, wanted, path, "period")
    landed = {str(r[0])[:4] for r in landing.landed_periods(spark, path, "period").collect()}
    if step == "commit_version":
        assert landed == {"2019"} and [r["v"] for r in landing.read_complete(spark, path).collect()] == [1]
    else:
        assert landed == {"2019", "2020", "2021", "2022"}
        assert landing.is_complete(spark, path) == (step == "remove_folder")
    # The next run finishes it; what was landed is not written again.
    changed = rows.withColumn("v", rows.v * 10)
    assert landing.land(changed, wanted, path, "period").count() == (3 if step == "commit_version" else 0)
    values = sorted(r["v"] for r in landing.read_complete(spark, path).collect())
    assert values == ([1, 20, 30] if step == "commit_version" else [1, 2, 3])
    assert not landing.recover(spark, path)


def test_incomplete_table_is_refused(spark, tmp_path):
    path = tmp_path / "t"
    landing.write_table(spark.range(3), str(path))
    assert landing.is_complete(spark, str(path)) and landing.read_complete(spark, str(path)).count() == 3
    (path / "_SUCCESS").unlink()
    with pytest.raises(FileNotFoundError):
        landing.read_complete(spark, str(path))
    assert not landing.is_complete(spark, str(tmp_path / "none"))


def test_shared_folder_is_the_named_one(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    folder = session.shared_folder(spark)
    assert named is None or folder == named
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_scratch_scope_removes_what_it_pinned(spark):
    kept = session.pin(spark.range(5))
    with session.scratch_scope(spark) as outer:
        path = session.scratch_path(spark, "x")
        assert path.startswith(outer)
        spark.range(3).write.parquet(path)
        pinned = session.pin(spark.range(7))
        with session.scratch_scope(spark) as inner:
            assert inner.startswith(outer)
            session.pin(spark.range(2))
        assert not paths.exists(spark, inner)
        # An inner block leaves the outer one's files and pins later ones beside them.
        again = session.pin(pinned.where("id > 0"))
        assert again.count() == 6 and pinned.count() == 7 and spark.read.parquet(path).count() == 3
        assert paths.matching_paths(spark, f"{outer}/*/rdd-*")
    assert not paths.exists(spark, outer)
    assert kept.count() == 5 and session.pin(spark.range(4)).count() == 4


def test_scratch_scope_removes_after_an_error(spark):
    before = session.shared_folder(spark)
    with pytest.raises(RuntimeError, match="stop"), session.scratch_scope(spark) as folder:
        session.pin(spark.range(2))
        raise RuntimeError("stop")
    assert not paths.exists(spark, folder) and session.shared_folder(spark) == before
