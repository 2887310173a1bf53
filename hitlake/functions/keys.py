"""Key expressions for lookup joins."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Fixed value: what a cast from string to an integer type accepts, apart from the range of the type.
_INTEGER = r"^[\s\p{Cntrl}]*[+-]?[0-9]+[\s\p{Cntrl}]*$"


def try_integer(column: Column, kind: T.DataType | None = None) -> Column:
    """A string as an integer, or NULL.

    The pattern spares the cast most strings that are no numbers: a failing ``try_cast`` is many times
    slower than one that succeeds.
    """
    return F.when(column.rlike(_INTEGER), column.try_cast(kind or T.LongType()))


def constant_map(names: Mapping[int, str]) -> Column:
    """A short id-to-name table as one constant, which the optimizer computes once."""
    entries = json.dumps([{"id": key, "name": name} for key, name in names.items()])
    return F.map_from_entries(F.from_json(F.lit(entries), "array<struct<id: bigint, name: string>>"))


def lookup_key(column: Column, key_type: T.DataType, id_type: T.DataType) -> Column:
    """A hit column as a lookup key.

    Numbers are widened.  A string against a numeric id is tried as a number, so ``' 2 '`` matches 2 and
    ``google.com`` matches nothing, without failing under ANSI mode.
    """
    if key_type == id_type:
        return column
    if isinstance(key_type, T.StringType):
        if isinstance(id_type, T.IntegralType):
            return try_integer(column, id_type)
        return column.try_cast(id_type)
    return column.cast(id_type)
