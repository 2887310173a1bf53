import random

import pytest
from conftest import rows

from hitlake.operators.enrich import enrich, list_lookup
from hitlake.operators.lookup_join import prepare, spread_join
from hitlake.sources.bundle import as_lookup


def lookup(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id bigint, name string")


def test_columns_and_misses(spark):
    hits = spark.createDataFrame([(1, 2, "x"), (9, None, "y")], "a smallint, b bigint, c string")
    lookups = {"one": lookup(spark, (1, "one")), "two": lookup(spark, (2, "two"))}
    out = enrich(hits, lookups, [("two", "b"), ("one", "a")])
    assert out.columns == ["a_id", "b_id", "c", "b", "a"]
    assert dict(out.dtypes)["a_id"] == "smallint"
    assert rows(out) == [(1, 2, "x", "two", "one"), (9, None, "y", None, None)]


def test_string_keys_under_both_ansi_modes(spark):
    keys = ["google.com", " 2 ", "2", "1,2", "", None, "99999999999999999999", "2.0", "\t2", "+2"]
    hits = spark.createDataFrame([(k,) for k in keys], "ref_domain string")
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            out = enrich(hits, {"referrer_type": lookup(spark, (2, "two"))}, [("referrer_type", "ref_domain")])
            assert {r["ref_domain_id"]: r["ref_domain"] for r in out.collect()} == {
                k: "two" if k in (" 2 ", "2", "\t2", "+2") else None for k in keys
            }
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_one_lookup_in_two_roles(spark):
    hits = spark.createDataFrame([(1, "2"), (2, "x")], "ref_type smallint, ref_domain string")
    kinds = {"referrer_type": lookup(spark, (1, "site"), (2, "search"))}
    out = enrich(hits, kinds, [("referrer_type", "ref_type"), ("referrer_type", "ref_domain")])
    assert rows(out) == [(1, "2", "site", "search"), (2, "x", "search", None)]


def test_repeated_ids_multiply_hits_unless_unique(spark):
    hits = spark.createDataFrame([(1,), (2,)], "k bigint")
    twice = {"t": lookup(spark, (1, "a"), (1, "b"), (None, "n"), (None, "m"))}
    assert rows(enrich(hits, twice, [("t", "k")])) == [(1, "a"), (1, "b"), (2, None)]
    with pytest.raises(ValueError, match="'t' holds an id more than once"):
        enrich(hits, twice, [("t", "k")], unique=True)
    nulls = {"t": lookup(spark, (1, "a"), (None, "n"), (None, "m"))}
    assert rows(enrich(hits, nulls, [("t", "k")], unique=True)) == [(1, "a"), (2, None)]


def test_bad_roles(spark):
    hits = spark.createDataFrame([(1,)], "k bigint")
    some = {"t": lookup(spark, (1, "a"))}
    with pytest.raises(ValueError, match="one role"):
        enrich(hits, some, [("t", "k"), ("t", "k")])
    with pytest.raises(ValueError, match="no such hit columns"):
        enrich(hits, some, [("t", "z")])
    assert enrich(hits, some, []).columns == ["k"]


def test_role_order_changes_only_column_order(spark):
    rng = random.Random(7)
    data = [(i, rng.choice([None, 1, 2, 3]), str(rng.choice([1, 2, "x"]))) for i in range(50)]
    hits = spark.createDataFrame(data, "n int, a bigint, b string")
    lookups = {"t": lookup(spark, (1, "one"), (2, "two"))}
    roles = [("t", "a"), ("t", "b")]
    there, back = enrich(hits, lookups, roles), enrich(hits, lookups, roles[::-1])
    assert there.columns != back.columns
    assert rows(there) == rows(back.select(there.columns))
    assert there.count() == len(data)


def test_wide_hits_are_packed_with_the_same_result(spark):
    narrow = spark.range(20).selectExpr("id % 5 AS k", "string(id % 4) AS s", "id AS n")
    wide = narrow.select("*", *[narrow["n"].alias(f"c{i}") for i in range(120)])
    lookups = {"t": lookup(spark, (1, "one"), (2, "two"), (2, "again"))}
    roles = [("t", "k"), ("t", "s")]
    out = enrich(wide, lookups, roles)
    assert out.columns == ["k_id", "s_id", "n", *[f"c{i}" for i in range(120)], "k", "s"]
    assert rows(out.select("k_id", "s_id", "n", "k", "s")) == rows(enrich(narrow, lookups, roles))
    assert out.where("c7 <> n").count() == 0


@pytest.mark.parametrize("key_type", ["bigint", "string"])
def test_big_lookups_with_hot_keys(spark, key_type):
    """Most hits share one key or have none; the shuffle join gives what the broadcast join gives."""
    data = [(i, 1 if i % 3 == 0 else None if i % 3 == 1 else i) for i in range(3000)]
    # Equal copies of one row are hot too.
    data += [(-1, 7)] * 1500
    hits = spark.createDataFrame(data, "n int, k bigint").selectExpr("n", f"CAST(k AS {key_type}) AS k")
    names = {"t": lookup(spark, *[(i, f"name {i}") for i in range(2000)], (1, "again"), (7, "again"))}
    roles = [("t", "k")]
    small = enrich(hits, names, roles)
    big = enrich(hits, names, roles, broadcast_bytes=0, tasks=64)
    assert "_salt" in big._jdf.queryExecution().optimizedPlan().toString()
    assert rows(big) == rows(small)


def test_hot_rows_land_in_many_tasks(spark):
    hits = spark.createDataFrame([(7,)] * 6400, "k bigint").repartition(32)
    # Keep the repartitioned rows apart from the optimizer's view of them.
    seen = spread_join(hits, lookup(spark, (7, "x")).withColumnRenamed("id", "i"), "k", "i", tasks=16)
    plan = seen._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and seen.where("name = 'x'").count() == 6400


def test_chain_counts_hot_keys_on_the_hits_alone(spark):
    data = [(i, 1 if i % 2 else i, i % 3) for i in range(900)]
    hits = spark.createDataFrame(data, "n int, a bigint, b bigint")
    names = {"t": lookup(spark, *[(i, f"name {i}") for i in range(900)])}
    roles = [("t", "a"), ("t", "b")]
    assert rows(enrich(hits, names, roles, broadcast_bytes=0, tasks=32)) == rows(enrich(hits, names, roles))


def test_prepare(spark):
    given = {"a": lookup(spark, (1, "xx"), (1, "yy")), "b": lookup(spark), "c": lookup(spark, (1, "x"), (2, None))}
    ready = prepare(given, inline_rows=2)
    assert ready["a"].n_bytes > 2 * 48 and ready["b"].n_bytes == 0
    assert [ready[t].names for t in "abc"] == [None, {}, {1: "x"}]
    assert prepare(given, inline_rows=1)["c"].names is None


@pytest.mark.parametrize("inline_rows", [0, 1000])
def test_prepared_lookups_in_wide_hits(spark, inline_rows):
    wide = spark.range(6).selectExpr("id AS k", "string(id) AS s", *[f"id AS c{i}" for i in range(120)])
    odd = "it's a \\ \"name\", é\t\U0001f600"
    given = {"t": lookup(spark, (1, odd), (2, None), (None, "none")), "r": lookup(spark, (3, "x"), (3, "y"))}
    out = enrich(wide, prepare(given, inline_rows=inline_rows), [("t", "k"), ("r", "s")])
    assert out.columns == ["k_id", "s_id", *[f"c{i}" for i in range(120)], "k", "s"]
    expected = [(0, "0", None, None), (1, "1", odd, None), (2, "2", None, None), (3, "3", None, "x")]
    expected += [(3, "3", None, "y"), (4, "4", None, None), (5, "5", None, None)]
    assert rows(out.select("k_id", "s_id", "k", "s")) == expected


LISTS = ["100,101,100", "101", "", None, "x,100", ",", " 100 ,102", "999", "100,101,100"]
EVENTS = {"100": "view", "101": "click"}


@pytest.mark.parametrize("inline_rows, broadcast_bytes", [(200, 1 << 20), (1, 1 << 20), (200, 0), (1, 0)])
def test_list_lookup(spark, inline_rows, broadcast_bytes):
    hits = spark.createDataFrame(list(enumerate(LISTS)), "n int, event_list string")
    names = lookup(spark, (100, "view"), (101, "click"), (102, None), (None, "none"))
    out = list_lookup(hits, "event_list", names, inline_rows, broadcast_bytes, tasks=32)
    assert out.columns == ["n", "event_list_id", "event_list"]
    expected = [
        (i, text, None if text is None else [EVENTS.get(t.strip(), t) for t in text.split(",")])
        for i, text in enumerate(LISTS)
    ]
    assert sorted((tuple(r) for r in out.collect())) == expected


def test_list_lookup_wants_unique_ids(spark):
    hits = spark.createDataFrame([("1",)], "l string")
    with pytest.raises(ValueError, match="more than once"):
        list_lookup(hits, "l", lookup(spark, (1, "a"), (1, "b")))


def test_list_lookup_without_names(spark):
    hits = spark.createDataFrame([("1,2",)], "l string")
    assert rows(list_lookup(hits, "l", lookup(spark))) == [("1,2", ["1", "2"])]


def test_as_lookup(spark):
    frame = spark.createDataFrame([(1, "a")], "k int, v string")
    assert as_lookup(frame, "k", "v").dtypes == [("id", "bigint"), ("name", "string")]


def test_no_hits(spark):
    none = spark.createDataFrame([], "k bigint, l string")
    names = {"t": lookup(spark, (1, "a"))}
    assert rows(enrich(none, names, [("t", "k")], broadcast_bytes=0, tasks=16)) == []
    assert rows(enrich(none.where("false"), names, [("t", "k")], broadcast_bytes=0, tasks=16)) == []
    assert rows(list_lookup(none, "l", names["t"], inline_rows=0, tasks=16)) == []
