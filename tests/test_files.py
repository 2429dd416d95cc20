"""Readers and writers on files the tests write themselves."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import d, reading
from helpers import readings as readings_table
from tideline.operators.state import feed_to_state
from tideline.sources import readers, writers

XML = """<?xml version="1.0" encoding="ISO-8859-1"?>
<pdv_liste>
 <pdv id="1" latitude="4612345" longitude="212345" cp="01000" pop="R">
  <adresse>5 rue de l'Été</adresse><ville>Bourg-en-Bresse</ville>
  <prix nom="E10" id="5" maj="2025-01-02 08:01:00" valeur="1.789"/>
  <prix nom="SP98" id="6" maj="2025-01-02 08:01:00" valeur=""/>
  <prix nom="E85" id="3" valeur="0.859"/>
 </pdv>
 <pdv id="2" latitude="" longitude="512345.5" cp="69300" pop="A">
  <adresse>Aire d'Août</adresse><ville>Château</ville>
  <prix nom="Gazole" id="1" maj="2025-01-03T09:30:00" valeur="1.6"/>
 </pdv>
 <pdv id="3" cp="75001" pop="R"><adresse>x</adresse><ville>Paris</ville>
  <prix nom="Gazole" id="1" maj="2025-01-03 10:00:00" valeur="1.7"/></pdv>
 <pdv id="4" latitude="1" longitude="1" cp="75001" pop="R"><adresse>y</adresse><ville>Paris</ville></pdv>
</pdv_liste>
"""


@pytest.fixture
def station_file(tmp_path):
    path = tmp_path / "stations.xml"
    path.write_bytes(XML.encode("iso-8859-1"))
    return str(path)


def test_station_xml(spark, station_file):
    rows = {(r.entity, r.product): r for r in readers.read_station_xml(spark, station_file).collect()}
    assert set(rows) == {("1", "E10"), ("1", "E85"), ("2", "Gazole"), ("3", "Gazole")}
    first = rows["1", "E10"]
    assert (first.address, first.city, first.postal_code) == ("5 rue de l'Été", "Bourg-en-Bresse", "01000")
    assert (first.latitude, first.longitude, first.price) == (46.12345, 2.12345, 1.789)
    assert first.observed_at == datetime(2025, 1, 2, 8, 1)
    assert rows["1", "E85"].observed_at is None
    assert rows["2", "Gazole"].latitude is None and rows["2", "Gazole"].longitude == 5.123455
    assert rows["2", "Gazole"].observed_at == datetime(2025, 1, 3, 9, 30)
    assert rows["3", "Gazole"].latitude is None


def test_station_xml_with_more_attributes(spark, station_file):
    rows = readers.read_station_xml(spark, station_file, more={"_cp": "code", "_phone": "phone"}).collect()
    assert {r.code for r in rows} == {"01000", "69300", "75001"} and {r.phone for r in rows} == {None}


def test_station_xml_feed(spark, station_file):
    feed = readers.read_station_xml(spark, station_file, require_time=True)
    assert feed.where("product = 'E85'").count() == 0 and feed.count() == 3


def checked(spark, tmp_path, files):
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    readings, quarantine = readers.read_station_xml_checked(spark, str(tmp_path / "*.xml"))
    return (
        sorted((r.entity, r.product, r.price, r.observed_at, r.city) for r in readings.collect()),
        sorted((r.file, r.kind, r.entity, r.product) for r in quarantine.collect()),
    )


WHOLE = XML.encode("iso-8859-1")


def test_checked_reader_gives_the_same_readings(spark, tmp_path, station_file):
    plain = readers.read_station_xml(spark, station_file)
    mine, quarantine = readers.read_station_xml_checked(spark, station_file, more={"_phone": "phone"})
    assert sorted(map(repr, mine.drop("phone").collect())) == sorted(map(repr, plain.collect())) and quarantine.count() == 0
    assert mine.schema.names[:-1] == plain.schema.names


def test_broken_stations_cost_no_other(spark, tmp_path):
    files = {
        "cut.xml": WHOLE[: WHOLE.index(b"<ville>Ch") + 12],  # ends within the second station
        "tag.xml": WHOLE.replace(b"<adresse>Aire d'Ao\xfbt</adresse>", b"<adresse>Aire</ville>"),
        "end.xml": WHOLE.replace(b"</pdv>", b"", 1),  # the first station never ends
        "text.xml": b"not xml at all",
        "none.xml": b"",
    }
    readings, quarantine = checked(spark, tmp_path, files)
    per_entity = [r[0] for r in readings]
    assert per_entity == ["1"] * 4 + ["2"] + ["3"] * 2  # 1 in cut and tag (two prices), 2 in end, 3 in tag and end
    assert [(f, k) for f, k, _, _ in quarantine] == [("cut.xml", "record"), ("end.xml", "record"), ("tag.xml", "record")]
    assert {r[4] for r in readings if r[0] == "2"} == {"Ch\xe2teau"}


def test_unreadable_values_are_listed(spark, tmp_path):
    data = WHOLE.replace(b'valeur="1.789"', b'valeur="1,78x"').replace(b'maj="2025-01-03T09:30:00"', b'maj="gestern"')
    readings, quarantine = checked(spark, tmp_path, {"a.xml": data.replace(b'id="3" cp', b"cp")})
    assert [r[:3] for r in readings] == [("1", "E85", 0.859), ("2", "Gazole", 1.6)] and readings[1][3] is None
    assert quarantine == [("a.xml", "entity", None, None), ("a.xml", "price", "1", "E10"), ("a.xml", "time", "2", "Gazole")]


def test_holidays(spark, tmp_path):
    (tmp_path / "h.json").write_text('{"2031-01-01": "1er janvier",\n "2031-05-01": "1er mai"}', encoding="utf-8")
    found = readers.read_holidays_json(spark, str(tmp_path / "h.json")).orderBy("day").collect()
    assert [r.day for r in found] == [date(2031, 1, 1), date(2031, 5, 1)]


def test_reference_prices(spark, tmp_path):
    (tmp_path / "ref.csv").write_text(
        "Back to Contents,Data 1\nSourcekey,RBRTE\nDate,Price\n2021-12-31,77.2\n2022-01-03 00:00:00,78.25\n2022-01-04,\n"
        "2022-01-05,80.1\n"
    )
    found = [(r.day, r.ref) for r in readers.read_ref_csv(spark, str(tmp_path / "ref.csv")).orderBy("day").collect()]
    assert found == [(d("2022-01-03"), 78.25), (d("2022-01-05"), 80.1)]


def test_quotes(spark):
    quotes = spark.createDataFrame([("2025-01-02 00:00:00", 75.125), ("2025-01-03 00:00:00", 75.375)], "Date string, Close double")
    landed = quotes.withColumn("Date", F.col("Date").cast("timestamp_ntz"))
    assert [r.ref for r in readers.read_quotes(landed).orderBy("day").collect()] == [75.12, 75.38]


def test_breaks(spark, tmp_path):
    (tmp_path / "v.csv").write_text(
        "date,vacances_zone_a,vacances_zone_b,vacances_zone_c,nom_vacances\n2022-12-31,True,True,True,Noel\n"
        "2023-01-01,True,False,,Noel\n2023-02-01,false,true,FALSE,\n"
    )
    rows = readers.read_breaks_csv(spark, str(tmp_path / "v.csv")).orderBy("day").collect()
    assert [tuple(r) for r in rows] == [(d("2023-01-01"), 1, 0, None), (d("2023-02-01"), 0, 1, 0)]


def test_communes(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        "code_commune_INSEE,nom_commune_postal,code_postal,libelle,latitude,longitude,region\n"
        "01001,L ABERGEMENT,1400,x,46.15,4.92,ARA\n69034,CALUIRE,69300,x,45.79,4.84,ARA\n"
    )
    found = readers.read_communes_csv(spark, str(tmp_path / "c.csv")).orderBy("code").collect()
    assert tuple(found[0]) == ("L ABERGEMENT", "01400", 46.15, 4.92) and len(found[1]) == 4


def test_yearly_glob(spark, tmp_path):
    for year in (2023, 2024):
        spark.range(3).selectExpr("cast(id as string) as entity", f"{year}.0D as price").write.parquet(
            str(tmp_path / f"readings_{year}.parquet")
        )
    found = readers.read_parquet(spark, str(tmp_path / "readings_*.parquet"))
    assert found.count() == 6 and found.where("product is null").count() == 6


def predictions(spark, day, price):
    return spark.createDataFrame([("s", d(day), price)], "entity string, day date, price double")


def test_publishing_again_changes_nothing(spark, tmp_path):
    """S16, T14: one archive partition per day, replaced as a whole."""
    root = str(tmp_path)
    writers.publish_snapshot(predictions(spark, "2025-01-02", 1.5), root, "2025-01-02")
    writers.publish_snapshot(predictions(spark, "2025-01-03", 1.6), root, "2025-01-03")
    writers.publish_snapshot(predictions(spark, "2025-01-03", 1.7), root, "2025-01-03")
    archive = spark.read.parquet(f"{root}/archive")
    assert sorted((str(r.day), r.price) for r in archive.collect()) == [("2025-01-02", 1.5), ("2025-01-03", 1.7)]
    latest = spark.read.parquet(f"{root}/latest").collect()
    assert [(r.entity, r.day, r.price) for r in latest] == [("s", d("2025-01-03"), 1.7)]
    assert (tmp_path / "archive" / "day=2025-01-03").is_dir()


def test_an_empty_day_replaces_its_partition(spark, tmp_path):
    root = str(tmp_path)
    writers.publish_snapshot(predictions(spark, "2025-01-02", 1.5), root, "2025-01-02")
    writers.publish_snapshot(predictions(spark, "2025-01-03", 1.6), root, "2025-01-03")
    writers.publish_snapshot(predictions(spark, "2025-01-03", 1.6).where("false"), root, "2025-01-03")
    archive = spark.read.parquet(f"{root}/archive")
    assert [(str(r.day), r.price) for r in archive.collect()] == [("2025-01-02", 1.5)]


def state(spark, day, price):
    rows = [reading("s", f"{day} 09:00:00", price)]
    return feed_to_state(readings_table(spark, rows))


def test_state_versions(spark, tmp_path):
    """S17: a run writes a new version and can read the previous one while doing so."""
    root = str(tmp_path)
    writers.write_state(state(spark, "2025-01-02", 1.5), root, "2025-01-02")
    for price in (1.6, 1.7):  # the second run repeats the first
        previous = writers.read_state(spark, root, before="2025-01-03")
        writers.write_state(previous.union(state(spark, "2025-01-03", price)), root, "2025-01-03")
    assert writers.read_state(spark, root, before="2025-01-03").count() == 1
    found = writers.read_state(spark, root, before="2025-01-04")
    assert sorted((str(r.day), r.price) for r in found.collect()) == [("2025-01-02", 1.5), ("2025-01-03", 1.7)]


def test_zstd(spark, tmp_path):
    writers.write_table(predictions(spark, "2025-01-02", 1.5), str(tmp_path / "t"))
    assert list((tmp_path / "t").glob("*.zstd.parquet"))
    writers.write_table(predictions(spark, "2025-01-02", 1.5), str(tmp_path / "s"), codec="snappy")
    assert list((tmp_path / "s").glob("*.snappy.parquet"))
