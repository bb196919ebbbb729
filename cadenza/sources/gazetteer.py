"""Stored answers of a reverse geocoder, as address columns of the positions near them."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.operators.projection import computed_once
from cadenza.operators.ranking import top_n
from cadenza.session import checkpointed

# Result column and its place in an answer.
ADDRESS_FIELDS = {
    "ADDR": "formatted_address",
    "PRVC": "addressComponent.province",
    "CTY": "addressComponent.city",
    "CTY_CD": "addressComponent.citycode",
    "DISTRICT": "addressComponent.district",
    "AD_CD": "addressComponent.adcode",
    "TOWN_SHIP": "addressComponent.township",
    "TOWN_CD": "addressComponent.towncode",
    "NB_NM": "addressComponent.neighborhood.name",
    "NB_TP": "addressComponent.neighborhood.type",
    "BD_NM": "addressComponent.building.name",
    "BD_TP": "addressComponent.building.type",
    "STREET": "addressComponent.streetNumber.street",
    "STREET_NB": "addressComponent.streetNumber.number",
    "STREET_LOC": "addressComponent.streetNumber.location",
    "STREET_DRCTION": "addressComponent.streetNumber.direction",
    "STREET_DSTANCE": "addressComponent.streetNumber.distance",
    "BUS_INFO": "addressComponent.businessAreas",
}

_ANSWER = """
formatted_address string,
addressComponent struct<
  province: string, city: string, citycode: string, district: string, adcode: string,
  township: string, towncode: string, businessAreas: string,
  neighborhood: struct<name: string, type: string>,
  building: struct<name: string, type: string>,
  streetNumber: struct<street: string, number: string, location: string,
                       direction: string, distance: string>>
"""


def degrees(text: Column) -> Column:
    """A coordinate as an exact number."""
    return text.try_cast("decimal(18,9)")


def _cell(coordinate: Column, digits: int) -> Column:
    """The number of the grid cell of ``digits`` decimals that a coordinate lies in."""
    return F.floor(coordinate * (10**digits)).cast("bigint")


def _around(cell: Column) -> Column:
    return F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda n: cell + n))


def parse_answers(answers: DataFrame) -> DataFrame:
    """(lat, lng) as numbers, the answer's text, and the address columns, from (lat, lng, answer).

    A missing field is ''. Text without an address component is a failed answer and is
    left out.
    """
    answered = computed_once(
        answers, F.struct(F.from_json("answer", _ANSWER).alias("found")), "lat", "lng", "answer"
    ).where(F.col("found.addressComponent").isNotNull())
    return answered.select(
        "lat",
        "lng",
        "answer",
        *[
            F.coalesce(F.col(f"found.{place}"), F.lit("")).alias(name)
            for name, place in ADDRESS_FIELDS.items()
        ],
    )


def nearest_answers(positions: DataFrame, answers: DataFrame, levels: Sequence[int]) -> DataFrame:
    """(X, Y) and the address columns of the answer nearest to each position.

    ``positions`` has distinct (X, Y) as text, ``answers`` (lat, lng, answer). ``levels`` are grids
    by their decimals, finest first. In a grid a position meets the answers of its cell and the
    eight around it, so the nearest one within a cell's width is found whichever side of an edge it
    is on; a position without one goes on to the next grid. So all answers within the last
    grid's width are reached, and crowded places are settled in small cells. Distance is
    in degrees; of equal ones the least coordinates, then the least text. Failed answers do not
    count; only answers near an open position are parsed.
    """
    open_ = positions.select("X", "Y", degrees(F.col("X")).alias("_x"), degrees(F.col("Y")).alias("_y"))
    open_ = checkpointed(open_.where(F.col("_x").isNotNull() & F.col("_y").isNotNull()))
    known = answers.select(
        degrees(F.col("lat")).alias("lat"), degrees(F.col("lng")).alias("lng"), "answer"
    )
    parts = []
    for digits in levels:
        cells = {"_i": _cell(F.col("lat"), digits), "_j": _cell(F.col("lng"), digits)}
        asked = open_.withColumn("_i", _around(_cell(F.col("_x"), digits)))
        asked = asked.withColumn("_j", _around(_cell(F.col("_y"), digits)))
        near = known.withColumns(cells).join(asked.select("_i", "_j"), ["_i", "_j"], "left_semi")
        # One answer of a place, before places and positions meet.
        parsed = top_n(parse_answers(near), 1, ["lat", "lng"], [F.asc("answer")]).withColumns(cells)
        north, east = F.col("lat") - F.col("_x"), F.col("lng") - F.col("_y")
        width = Decimal(1).scaleb(-digits)
        # Numbers of nine decimals below a cell's width have exact squares.
        square = sum((c.cast("decimal(12,9)") * c.cast("decimal(12,9)") for c in (north, east)))
        met = asked.join(parsed.drop("rank"), ["_i", "_j"]).withColumn("_square", square)
        met = met.where(F.col("_square") <= F.lit(width * width))
        order = [F.asc(name) for name in ("_square", "lat", "lng", "answer")]
        best = top_n(met, 1, ["X", "Y"], order).select("X", "Y", *ADDRESS_FIELDS)
        best = checkpointed(best)
        parts.append(best)
        if digits != levels[-1]:
            open_ = checkpointed(open_.join(best.select("X", "Y"), ["X", "Y"], "left_anti"))
    return reduce(DataFrame.unionByName, parts)
