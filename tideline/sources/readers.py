"""Files to typed tables. Every reader declares its schema; malformed values become NULL, not errors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.scalars import half_even, scaled_coordinate
from tideline.schema import READING_SCHEMA


def _fields(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


STATION_XML = T.StructType(
    [
        *_fields("_id", "_latitude", "_longitude", "_cp", "_pop", "adresse", "ville"),
        T.StructField("prix", T.ArrayType(T.StructType(_fields("_nom", "_maj", "_valeur")))),
    ]
)


def read_station_xml(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    row_tag: str = "pdv",
    charset: str = "ISO-8859-1",
    require_time: bool = False,
    more: Mapping[str, str] | None = None,
) -> DataFrame:
    """Station XML as readings, one row per price.

    Prices without a value are skipped, with ``require_time`` (the daily feed) also those without a time. Coordinates
    are stored times 100,000; an empty one is NULL. Stations without a price give no row.
    ``more`` names further text columns by attribute (``_name``) or element of the station.
    """
    more = dict(more or {})
    known = STATION_XML.fieldNames()
    schema = T.StructType([*STATION_XML.fields, *_fields(*[name for name in more if name not in known])])
    stations = (
        spark.read.format("xml")
        .schema(schema)
        .option("rowTag", row_tag)
        .option("charset", charset)
        .load(path if isinstance(path, str) else ",".join(path))
    )
    prices = stations.withColumn("p", F.explode("prix"))
    observed = F.col("p._maj").try_cast("timestamp_ntz")
    readings = prices.select(
        F.col("_id").alias("entity"),
        F.col("p._nom").alias("product"),
        observed.alias("observed_at"),
        F.nullif(F.trim("p._valeur"), F.lit("")).try_cast("double").alias("price"),
        scaled_coordinate(F.col("_latitude")).alias("latitude"),
        scaled_coordinate(F.col("_longitude")).alias("longitude"),
        F.col("_cp").alias("postal_code"),
        F.col("_pop").alias("road_type"),
        F.col("ville").alias("city"),
        F.col("adresse").alias("address"),
        *[F.col(name).alias(column) for name, column in more.items()],
    ).where("price is not null")
    return readings.where("observed_at is not null") if require_time else readings


QUARANTINE_COLUMNS = ("file", "kind", "entity", "product", "detail")


def read_station_xml_checked(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    row_tag: str = "pdv",
    charset: str = "ISO-8859-1",
    more: Mapping[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Readings as :func:`read_station_xml` gives them, and what was not believed.

    Stations are cut out of the text by their end tags and parsed one by one, so a broken one costs no other, whether a
    file was cut short or a tag is missing in its middle. The quarantine has one row per find: ``file``, ``kind``, ``entity``,
    ``product``, ``detail``. Kinds: ``record`` (not well-formed or without an end; the text), ``entity`` (a station without an
    id), ``price`` and ``time`` (a value that is there but can't be read; such a price gives no reading, such a time a
    reading without one). Prices without a value are usual and not listed. A file that ends just behind a whole element of
    a station leaves that station with what it has.
    """
    more = dict(more or {})
    known = STATION_XML.fieldNames()
    fields = [*STATION_XML.fields, *_fields(*[name for name in more if name not in known])]
    schema = T.StructType([*fields, T.StructField("_corrupt", T.StringType())])
    found = spark.read.option("lineSep", f"</{row_tag}>").text(path if isinstance(path, str) else list(path))
    text = F.decode(F.col("value").cast("binary"), charset)
    pieces = found.select(F.col("_metadata.file_name").alias("file"), text.alias("text"))
    # before a station's last start tag stands other markup, stations without content, or one that never ended
    last = F.regexp_extract("text", rf"(?s)^.*(<{row_tag}[ \t\r\n>].*)$", 1)
    cut = pieces.withColumn("station", last).withColumn("before", F.substring("text", F.lit(1), F.length("text") - F.length("station")))
    ended = F.concat("station", F.lit(f"</{row_tag}>"))
    options = {"rowTag": row_tag, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = cut.where("station <> ''").withColumn("s", F.from_xml(ended, schema.simpleString(), options))
    broken = F.col("s").isNull() | F.col("s._corrupt").isNotNull()
    stations = parsed.where(~broken).select("file", "s.*")

    unended = cut.select("file", F.regexp_extract("before", rf"(?s)(<{row_tag}(?:\s[^>]*[^/>])?>.*)$", 1).alias("detail"))
    records = parsed.where(broken).select("file", F.col("station").alias("detail")).unionByName(unended.where("detail <> ''"))
    prices = stations.withColumn("p", F.explode("prix"))
    price = F.nullif(F.trim("p._valeur"), F.lit(""))
    read = prices.withColumns({"price_text": price, "time_text": F.nullif(F.trim("p._maj"), F.lit(""))}).withColumns(
        {"price": F.col("price_text").try_cast("double"), "observed_at": F.col("time_text").try_cast("timestamp_ntz")}
    )

    def finds(rows: DataFrame, kind: str, detail: str) -> DataFrame:
        return rows.select("file", F.lit(kind).alias("kind"), F.col("_id").alias("entity"), F.col("p._nom").alias("product"), F.col(detail).alias("detail"))

    nothing = F.lit(None).cast("string")
    quarantine = (
        records.select("file", F.lit("record").alias("kind"), nothing.alias("entity"), nothing.alias("product"), "detail")
        .unionByName(stations.where("_id is null").select(
            "file", F.lit("entity").alias("kind"), nothing.alias("entity"), nothing.alias("product"), F.col("adresse").alias("detail")))
        .unionByName(finds(read.where("price_text is not null and price is null"), "price", "price_text"))
        .unionByName(finds(read.where("time_text is not null and observed_at is null"), "time", "time_text"))
    )
    readings = read.where("price is not null and _id is not null").select(
        F.col("_id").alias("entity"),
        F.col("p._nom").alias("product"),
        "observed_at",
        "price",
        scaled_coordinate(F.col("_latitude")).alias("latitude"),
        scaled_coordinate(F.col("_longitude")).alias("longitude"),
        F.col("_cp").alias("postal_code"),
        F.col("_pop").alias("road_type"),
        F.col("ville").alias("city"),
        F.col("adresse").alias("address"),
        *[F.col(name).alias(column) for name, column in more.items()],
    )
    return readings, quarantine


def json_keys(documents: DataFrame, column: str, into: str) -> DataFrame:
    """One row per key of a JSON object held as text, the other columns repeated."""
    as_map = F.from_json(F.col(column), T.MapType(T.StringType(), T.StringType()))
    return documents.select("*", F.explode(F.map_keys(as_map)).alias(into)).drop(column)


def read_holidays_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object ``{"YYYY-MM-DD": label}`` as the table ``day``."""
    text = spark.read.text(path, wholetext=True)
    return json_keys(text, "value", "day").select(F.col("day").try_cast("date").alias("day")).where("day is not null")


def read_ref_csv(
    spark: SparkSession, path: str, *, header_rows: int = 2, since: str = "2022-01-01", digits: int | None = None
) -> DataFrame:
    """The exported price sheet as ``day, ref``: header rows and rows without a price fall away with their NULLs."""
    sheet = spark.read.schema("day string, ref string").csv(path)
    ref = F.col("ref").try_cast("double")
    typed = sheet.select(
        F.substring("day", 1, 10).try_cast("date").alias("day"),
        (ref if digits is None else half_even(ref, digits)).alias("ref"),
    )
    return typed.where((F.col("day") >= F.lit(since).cast("date")) & F.col("ref").isNotNull())


def read_quotes(table: DataFrame, *, date_column: str = "Date", value_column: str = "Close") -> DataFrame:
    """Landed market quotes as ``day, ref``, rounded to two decimals (ties to even)."""
    return table.select(
        F.col(date_column).cast("date").alias("day"),
        half_even(F.col(value_column).cast("double"), 2).alias("ref"),
    )


def read_breaks_csv(spark: SparkSession, path: str, *, since: str = "2023-01-01") -> DataFrame:
    """School-break CSV with a header: ``day`` and three INT flags; rows from ``since`` on."""
    zones = ("vacances_zone_a", "vacances_zone_b", "vacances_zone_c")
    raw = spark.read.option("header", True).option("enforceSchema", False).schema(
        ", ".join(f"{c} string" for c in ("date", *zones, "nom_vacances"))
    ).csv(path)
    flags = [
        F.col(z).try_cast("boolean").cast("int").alias(f"break_zone_{z[-1]}") for z in zones
    ]
    return raw.select(F.col("date").try_cast("date").alias("day"), *flags).where(
        F.col("day") >= F.lit(since).cast("date")
    )


def read_communes_csv(spark: SparkSession, path: str) -> DataFrame:
    """Commune CSV with a header, four columns kept: ``commune, code, latitude, longitude``."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(
        F.col("nom_commune_postal").alias("commune"),
        F.lpad("code_postal", 5, "0").alias("code"),
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"),
    )


def read_parquet(spark: SparkSession, path: str, schema: T.StructType = READING_SCHEMA) -> DataFrame:
    """Parquet by path or glob with a declared schema: no inference job, missing columns read as NULL."""
    return spark.read.schema(schema).parquet(path)
