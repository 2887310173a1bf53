"""The standard feed at its full width of 680 columns, through the whole load."""

from collections import Counter

from conftest import write_bundle, write_gz
from pyspark.sql import types as T

from hitlake.plans.load import LoadReport, load
from hitlake.sources.schema import DEFAULT_ROLES, hit_schema


def line(**values):
    return "\t".join(str(values.get(name, "")) for name in hit_schema().names)


def test_load_at_full_width(spark, tmp_path):
    hits = [
        line(date_time="2024-01-01 10:00:00", browser=1, color=2, ref_type=1, ref_domain="site.com", plugins="1,2"),
        line(date_time="2024-01-01 23:59:59", browser=3, ref_domain="2", plugins="2", evar100="last", zip="z"),
        line(browser=1, connection_type=2, javascript=1, os=2, language=1, country=1, resolution=2, search_engine=1),
        line(),
    ]
    write_gz(tmp_path / "in" / "01-suite_20240101-000000.tsv.gz", hits)
    write_gz(tmp_path / "in" / "01-suite_20240102-000000.tsv.gz", [line(zip="next day")])
    tables = {table for table, _ in DEFAULT_ROLES}
    write_bundle(
        tmp_path / "in" / "suite_20240101-000000-lookup_data.tar.gz",
        {f"{table}.tsv": f"1\t{table} 1\n2\t{table} 2\n".encode() for table in tables},
    )
    lake = str(tmp_path / "lake")
    assert load(spark, str(tmp_path / "in"), lake, str(tmp_path / "ledger")) == LoadReport(1, 3, 3)

    out = spark.read.parquet(lake)
    keys = [column for _, column in DEFAULT_ROLES]
    renamed = [f"{name}_id" if name in keys else name for name in hit_schema().names]
    assert out.columns == [*renamed, *keys, "date"] and len(out.columns) == 693
    kinds = {field.name: field.dataType for field in out.schema}
    assert kinds["plugins_id"] == kinds["ref_domain_id"] == T.StringType()
    assert Counter(type(kinds[key]) for key in keys) == {T.StringType: 12}

    found = [row.asDict() for row in out.select(*renamed, *keys, out.date.cast("string")).collect()]
    first, second, third = sorted(found, key=lambda r: str(r["date_time"]))
    assert (first["browser"], first["color"], first["ref_type"]) == ("browser 1", "color_depth 2", "referrer_type 1")
    assert (first["ref_domain_id"], first["ref_domain"]) == ("site.com", None)
    assert (first["plugins_id"], first["plugins"]) == ("1,2", None)
    assert (second["browser_id"], second["browser"]) == (3, None)
    assert (second["ref_domain"], second["plugins"]) == ("referrer_type 2", "plugins 2")
    assert (second["evar100"], second["zip"], second["date"]) == ("last", "z", "2024-01-01")
    assert third["date"] is None
    named = dict(DEFAULT_ROLES)
    assert [third[named[t]] for t in ("connection_type", "javascript_version", "operating_systems")] == [
        "connection_type 2",
        "javascript_version 1",
        "operating_systems 2",
    ]
    assert [third[c] for c in ("language", "country", "resolution", "search_engine")] == [
        "language 1",
        "country 1",
        "resolution 2",
        "search_engine 1",
    ]
