import pytest
from conftest import rows, write_bundle

from hitlake.sources.bundle import lookup_table, parse_lines, read_bundle, read_lookups


def test_golden_bundle(spark, tmp_path):
    path = tmp_path / "suite_20240101-000000-lookup_data.tar.gz"
    browser = b"1\tChrome\n2\tFire\xfffox\nbad\n3\tx\ty\n"
    write_bundle(path, {"folder": None, "browser.tsv": browser, "color_depth.tsv": b"1\t8"})
    lookups = read_lookups(spark, str(path), ["browser", "color_depth", "browser"])
    assert lookups.columns == ["table", "id", "name"]
    assert rows(lookups) == [("browser", 1, "Chrome"), ("browser", 2, "Firefox"), ("color_depth", 1, "8")]
    assert rows(lookup_table(lookups, "color_depth")) == [(1, "8")]
    assert dict(lookup_table(lookups, "browser").dtypes) == {"id": "bigint", "name": "string"}


def test_members_are_matched_by_full_name(spark, tmp_path):
    path = tmp_path / "lookup_data.tar.gz"
    write_bundle(path, {"sub/browser.tsv": b"1\tno", "browser.tsv.old": b"2\tno", "os.tsv": b"x\tbad id"})
    assert rows(read_lookups(spark, str(path), ["browser"])) == []


def test_long_members_stream_in_batches(spark, tmp_path):
    path = tmp_path / "lookup_data.tar.gz"
    body = "\n".join(f"{i}\tname {i}" for i in range(20_000)).encode()
    write_bundle(path, {"resolution.tsv": body, "empty.tsv": b""})
    found = read_lookups(spark, str(path), ["resolution", "empty"])
    assert found.count() == found.select("id").distinct().count() == 20_000
    assert read_bundle(spark, str(path)).select("member").distinct().count() == 1


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_id_that_is_no_integer(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        lines = spark.createDataFrame([("1\ta",), ("x\tb",), ("",), ("2",), (" 3 \tc",)], "line string")
        with pytest.raises(Exception, match="lookup id is not an integer: x"):
            parse_lines(lines).collect()
        assert rows(parse_lines(lines, lenient=True)) == [(1, "a"), (3, "c")]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
