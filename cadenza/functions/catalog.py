"""Cleaning rules for the song catalog's JSON and list texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NO_ALBUM = "暂无专辑"
DEFAULT_COMPANY = "乐心曲库"

_PEOPLE = "array<struct<name:string,id:string>>"
_OPEN_TITLE, _CLOSE_TITLE = "《", "》"


def _elements(text: Column) -> Column:
    """The objects of a JSON array; NULL when the text is anything else."""
    return F.when(F.ltrim(text).startswith("["), F.from_json(text, _PEOPLE))


def album_name(text: Column) -> Column:
    """Name in the first element of a JSON array, NULL if that element has none.

    Other text gives its first ``《title》`` with the marks, or the no-album label.
    """
    first = F.get(_elements(text), F.lit(0))
    opened = F.locate(_OPEN_TITLE, text)
    closed = F.locate(_CLOSE_TITLE, text)
    titled = F.substring(text, opened, closed - opened + 1)
    return (
        F.when(first.isNotNull(), first["name"])
        .when((opened > 0) & (closed > opened), titled)
        .otherwise(F.lit(NO_ALBUM))
    )


def singer_field(text: Column, position: int, field: str) -> Column:
    """``field`` of the singer at ``position``: '' without such a singer, NULL when the
    singer has no such field."""
    singer = F.get(_elements(text), F.lit(position))
    return F.when(singer.isNotNull(), singer[field]).otherwise(F.lit(""))


def company_name(text: Column) -> Column:
    """``name`` of a JSON object, NULL if it has none; the default company when the
    text is not an object."""
    return F.when(
        F.json_object_keys(text).isNotNull(), F.get_json_object(text, "$.name")
    ).otherwise(F.lit(DEFAULT_COMPANY))


def product_types(text: Column) -> Column:
    """``[8.0,9.0]`` as integers, cut toward zero; an empty array for blank text."""
    listed = F.regexp_replace(F.regexp_replace(text, r"^\[|\]$", ""), ",+$", "")
    numbers = F.transform(
        F.split(listed, ","), lambda item: item.try_cast("double").try_cast("int")
    )
    return F.when(F.length(F.trim(listed)) > 0, numbers).otherwise(
        F.array().cast("array<int>")
    )
