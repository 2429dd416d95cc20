"""The comparator: cheapest stations around a postal code."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.scalars import map_link
from tideline.operators.geo import within_radius


class UnknownCode(ValueError):
    """The postal code is not in the table of communes."""


def lookup_code(spark: SparkSession, communes: DataFrame, code: str) -> DataFrame:
    """The commune of a postal code; of several, the first by name. The code is a bound parameter."""
    return spark.sql(
        "select commune, latitude, longitude from {communes} where code = :code order by commune, latitude, longitude"
        " limit 1",
        args={"code": code},
        communes=communes,
    )


def cheapest_around(
    spark: SparkSession, communes: DataFrame, predictions: DataFrame, *, code: str, product: str, radius_km: float
) -> DataFrame:
    """Stations within ``radius_km`` of the code selling the product, cheapest first.

    Raises :class:`UnknownCode` for text that is not five digits and for a code without a commune. One row is brought to the driver: the centre.
    """
    if not re.fullmatch("[0-9]{5}", code):
        raise UnknownCode(code)
    centre = lookup_code(spark, communes, code).first()
    if centre is None:
        raise UnknownCode(code)
    found = within_radius(predictions, centre.latitude, centre.longitude, radius_km * 1000, product=product)
    return found.orderBy("price", "entity").select(
        map_link(F.col("address"), F.col("city")).alias("map_link"),
        "entity", "price", "predicted_price", "trend", "predicted_delta", "postal_code", "city", "address",
        F.rint("distance_m").cast("bigint").alias("distance_m"),
    )
