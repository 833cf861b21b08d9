"""Places where a user puts own rules: functions of columns or DataFrames, so that Catalyst plans them with the rest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from ..functions import scalars as S

WidthRule = Callable[[Column, Column], tuple[Column, Column]]
Table = Callable[[DataFrame], DataFrame]


def with_widths(roads: DataFrame, width: Column, importance: Column, rule: WidthRule = S.road_width) -> DataFrame:
    """roads with width and method by the rule, which takes the columns of a source width and an importance."""
    found, method = rule(width, importance)
    return roads.withColumn("width", found).withColumn("method", method)


def with_assets(wanted: DataFrame, assets: DataFrame, select: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """wanted with the asset that select(wanted, assets) gives for its id, null where it gives none."""
    return wanted.join(select(wanted, assets).select("id", "asset"), "id", "left")


def produced(zones: DataFrame, context: Table, sources: Table, tiles: Table) -> DataFrame:
    """zones through the three steps of a production, each a function of the rows before it."""
    return zones.transform(context).transform(sources).transform(tiles)
