"""Projections that later filters do not recompute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, fields: Column, *keep: str) -> DataFrame:
    """The struct ``fields`` as columns, after the columns ``keep``.

    A filter on a plain projection is pushed below it and evaluates the expression a
    second time. A generator's output stays where it is, so costly parsing runs once.
    """
    return df.select(*keep, F.inline(F.array(fields)))
