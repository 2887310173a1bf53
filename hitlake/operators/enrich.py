"""Enrich hits with the names behind their lookup ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlake.functions.keys import constant_map, lookup_key
from hitlake.functions.lists import name_or_item, resolve_items, split_list
from hitlake.operators.lookup_join import BROADCAST_BYTES, INLINE_ROWS, Lookup, join_lookup, prepare
from hitlake.sources.schema import DEFAULT_ROLES

# Above this width, joins carry the hit as one struct rather than copying it column by column.
_PACK_WIDTH = 100


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def enrich(
    hits: DataFrame,
    lookups: Mapping[str, DataFrame | Lookup],
    roles: Sequence[tuple[str, str]] = DEFAULT_ROLES,
    unique: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    tasks: int | None = None,
) -> DataFrame:
    """Join each ``(lookup, column)`` role in turn.

    The column becomes ``<column>_id`` in its place; the name found comes last, as ``<column>``, in role
    order.  Every lookup is ``id``, ``name`` and may serve several roles.  An id that a lookup repeats
    multiplies hits; ``unique`` makes that an error.  Lookups from :func:`prepare` are not measured again.

    For a narrow result, select the columns needed first: wide hits are carried through the joins as one
    value, and short lookups with unique ids are resolved in the row, as copying a wide row costs more
    than the lookup.
    """
    roles = list(roles)
    keys = [key for _, key in roles]
    if len(set(keys)) != len(keys):
        raise ValueError("a column can have one role only")
    columns = hits.columns
    missing = [key for key in keys if key not in columns]
    if missing:
        raise ValueError(f"no such hit columns: {missing}")
    if not roles:
        return hits
    wide = len(columns) > _PACK_WIDTH
    tables = {table: lookups[table] for table, _ in roles}
    raw = {table: lookup for table, lookup in tables.items() if not isinstance(lookup, Lookup)}
    unchecked = [t for t, lookup in tables.items() if unique and isinstance(lookup, Lookup) and not lookup.unique]
    if unchecked:
        raise ValueError(f"lookups prepared without a check for repeated ids: {unchecked}")
    if raw:
        tables |= prepare(raw, unique, INLINE_ROWS if wide else 0)

    types = {field.name: field.dataType for field in hits.schema}
    after = {c: f"{c}_id" if c in keys else c for c in columns}
    # Text expressions: building hundreds of column objects takes seconds.
    kept = [f"{_quoted(c)} AS {_quoted(name)}" for c, name in after.items()]
    found, joins = [], []
    for i, (table, key) in enumerate(roles):
        lookup = tables[table]
        typed = lookup_key(F.col(key), types[key], lookup.frame.schema["id"].dataType)
        small = lookup.n_bytes <= broadcast_bytes
        if wide and small and lookup.names is not None:
            found.append(constant_map(lookup.names)[typed.cast("bigint")].alias(f"_n{i}"))
        else:
            found.append(typed.alias(f"_k{i}"))
            # Hot keys are counted on the hits alone, not on the joins so far.
            counted = None if small else hits.select(typed.alias(f"_k{i}"))
            joins.append((lookup.frame, f"_k{i}", f"_n{i}", small, tasks, counted))
    if wide and joins:
        frame = hits.select(F.expr(f"struct({', '.join(kept)})").alias("_row"), *found)
        row = [F.inline(F.array("_row"))]
    else:
        frame = hits.select(*[F.expr(text) for text in kept], *found)
        row = [_quoted(name) for name in after.values()]
    for join in joins:
        frame = join_lookup(frame, *join)
    return frame.select(*row, *[F.col(f"_n{i}").alias(key) for i, key in enumerate(keys)])


def list_lookup(
    hits: DataFrame,
    column: str,
    lookup: DataFrame,
    inline_rows: int = 200,
    broadcast_bytes: int = BROADCAST_BYTES,
    tasks: int | None = None,
) -> DataFrame:
    """Resolve a comma-delimited id list: ``<column>_id`` keeps the text, ``<column>`` is an array of names.

    An item without a name stays as it is; order and repeats are kept.  Ids must be unique.

    A lookup of up to ``inline_rows`` rows is resolved inside the row, with no join.  Beyond that, each
    distinct list is resolved once, and the hits are joined with the resolved lists like with any other
    lookup; hits are never exploded, and a group is never more than the items of one list.
    """
    columns = hits.columns
    ready = prepare({column: lookup}, unique=True, inline_rows=inline_rows)[column]
    renamed = [F.col(c).alias(f"{c}_id" if c == column else c) for c in columns]
    small = ready.n_bytes <= broadcast_bytes
    if small and ready.names is not None:
        return hits.select(*renamed, resolve_items(split_list(column), ready.names).alias(column))

    lists = hits.select(F.col(column).alias("id")).where("id IS NOT NULL").distinct()
    items = lists.select("id", F.posexplode(split_list("id")).alias("pos", "item"))
    keyed = items.withColumn("key", lookup_key(F.col("item"), T.StringType(), lookup.schema["id"].dataType))
    named = join_lookup(keyed, lookup, "key", "found", small, tasks)
    entry = F.struct("pos", name_or_item(F.col("found"), F.col("item")).alias("name"))
    in_order = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["name"])
    resolved = named.groupBy("id").agg(in_order.alias("name"))
    small = prepare({column: resolved})[column].n_bytes <= broadcast_bytes
    joined = join_lookup(hits, resolved, column, "_names", small, tasks)
    return joined.select(*renamed, F.col("_names").alias(column))
