"""Comma-delimited list columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from hitlake.functions.keys import constant_map, try_integer


def split_list(column: str | Column) -> Column:
    """``'100,101'`` as an array of its items; NULL stays NULL."""
    return F.split(column, ",")


def name_or_item(name: Column, item: Column) -> Column:
    """The looked-up name, or the item itself when there is none."""
    return F.coalesce(name, item)


def resolve_items(items: Column, names: Mapping[int, str]) -> Column:
    """Replace each item of an array by its name, from a small constant map, inside the row."""
    if not names:
        return items
    mapping = constant_map(names)
    return F.transform(items, lambda item: name_or_item(mapping[try_integer(item)], item))
