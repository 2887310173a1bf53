from collections import Counter

import pytest
from pyspark.sql import types as T

from hitlake.sources.schema import DEFAULT_ROLES, hit_schema, schema_from_spec


def test_width_and_types():
    schema = hit_schema()
    assert len(schema) == len(set(schema.names)) == 680
    kinds = Counter(type(field.dataType) for field in schema)
    assert kinds == {T.StringType: 618, T.LongType: 32, T.ShortType: 27, T.BooleanType: 2, T.TimestampType: 1}
    assert all(field.nullable for field in schema)
    assert sum(name.startswith("post_") for name in schema.names) == 293


def test_order_and_families():
    names = hit_schema().names
    assert names[:5] == ["accept_language", "browser", "browser_height", "browser_width", "c_color"]
    assert names[-3:] == ["weekly_visitor", "yearly_visitor", "zip"]
    at = names.index("evar1")
    assert names[at : at + 100] == [f"evar{i}" for i in range(1, 101)]
    at = names.index("hier5")
    assert names[at : at + 4] == ["hier5", "hit_source", "hit_time_gmt", "hitid_high"]
    at = names.index("post_pagename")
    assert names[at : at + 3] == ["post_pagename", "post_pagename_no_url", "post_partner_plugins"]


def test_twins_share_types_but_one():
    types = {field.name: field.dataType for field in hit_schema()}
    odd = [n for n in types if f"post_{n}" in types and types[n] != types[f"post_{n}"]]
    assert odd == ["cust_visid"]
    assert types["post_cust_visid"] == T.ShortType()


def test_roles_name_columns():
    names = hit_schema().names
    assert len(DEFAULT_ROLES) == 12
    assert len({table for table, _ in DEFAULT_ROLES}) == 11
    assert all(column in names for _, column in DEFAULT_ROLES)


def test_own_spec():
    schema = schema_from_spec("b:S a10 a9:L")
    assert [(f.name, f.dataType.simpleString()) for f in schema] == [
        ("b", "smallint"),
        ("a10", "string"),
        ("a9", "bigint"),
    ]
    with pytest.raises(ValueError, match="twice"):
        schema_from_spec("a1..3 a2")
