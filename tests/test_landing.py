import datetime as dt

import pytest
from conftest import rows

from hitlake.plans.ledger import mark_done, pending, read_ledger
from hitlake.sources.landing import (
    classify,
    closed_days,
    closed_files,
    day_batches,
    file_pages,
    latest_bundle,
    list_landing,
    removable,
)

NAMES = [
    "incoming/01-suite_20240101-000000.tsv.gz",
    "incoming/01-my_suite_20240101-010000.tsv.gz",
    "incoming/01-suite_20240102-000000.tsv.gz",
    "incoming/01-suite_20240103-000000.tsv.gz",
    "incoming/suite_20240101-000000-lookup_data.tar.gz",
    "incoming/suite_20240102-000000-lookup_data.tar.gz",
    "incoming/suite_2024-01-01.txt",
    "incoming/suite_2024-01-02.txt",
]


def listing(spark, names=NAMES):
    return classify(spark.createDataFrame([(n, 10) for n in names], "path string, length bigint"))


def test_list_a_folder(spark, tmp_path):
    for name in NAMES:
        file = tmp_path / name
        file.parent.mkdir(exist_ok=True)
        file.write_bytes(b"12345")
    (tmp_path / "incoming" / "deeper").mkdir()
    (tmp_path / "incoming" / "deeper" / "01-suite_20240104-000000.tsv.gz").write_bytes(b"1")
    (tmp_path / "incoming" / "empty.txt").write_bytes(b"")
    found = list_landing(spark, str(tmp_path / "incoming"))
    assert found.columns == ["path", "length", "modificationTime"]
    ends = sorted(r["path"].split("/incoming/")[1] for r in found.collect())
    assert ends == sorted([n.split("/", 1)[1] for n in NAMES] + ["deeper/01-suite_20240104-000000.tsv.gz"])
    assert {r["length"] for r in found.collect()} == {1, 5}
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()


def test_kinds_and_days(spark):
    found = {r["path"]: (r["kind"], r["feed_date"]) for r in listing(spark).collect()}
    assert found[NAMES[0]] == ("data", "20240101")
    assert found[NAMES[1]] == ("data", "20240101")
    assert found[NAMES[4]] == ("lookup", None)
    assert found[NAMES[6]] == ("other", None)


def test_data_file_without_a_day_fails(spark):
    with pytest.raises(Exception, match="data file without a day in its name: incoming/odd.tsv.gz"):
        listing(spark, ["incoming/odd.tsv.gz"]).collect()


def test_batches(spark):
    assert rows(day_batches(listing(spark))) == [
        ("20240101", 2, NAMES[1], NAMES[0], 20),
        ("20240102", 1, NAMES[2], NAMES[2], 10),
        ("20240103", 1, NAMES[3], NAMES[3], 10),
    ]


def test_closed_days(spark):
    assert rows(closed_days(listing(spark))) == [("20240101",), ("20240102",)]
    assert rows(closed_days(listing(spark, NAMES[:2]))) == []
    assert rows(closed_days(listing(spark, NAMES[:2]), include_open=True)) == [("20240101",)]


def test_latest_bundle(spark):
    assert latest_bundle(listing(spark)) == NAMES[5]
    with pytest.raises(ValueError, match="no lookup bundle"):
        latest_bundle(listing(spark, NAMES[:4]))


def test_removable_keeps_the_last(spark):
    assert rows(removable(listing(spark)).select("path")) == [(NAMES[6],), (NAMES[7],), (NAMES[4],)]
    assert rows(removable(listing(spark, NAMES[:5]))) == []


@pytest.mark.parametrize("size", [1, 2, 3, 4, 100])
def test_pages_cover_every_file_once_in_day_order(spark, size):
    pages = list(file_pages(closed_files(listing(spark), include_open=True), size))
    assert all(len(page) <= size for page in pages)
    flat = [(r["feed_date"], r["path"]) for page in pages for r in page]
    assert flat == [
        ("20240101", NAMES[1]),
        ("20240101", NAMES[0]),
        ("20240102", NAMES[2]),
        ("20240103", NAMES[3]),
    ]


def test_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    files = listing(spark)
    assert read_ledger(spark, path).count() == 0
    assert pending(files, read_ledger(spark, path)).count() == len(NAMES)
    mark_done(files.where("feed_date = '20240101'"), path)
    mark_done(removable(files), path)
    ledger = read_ledger(spark, path)
    assert ledger.count() == 5
    assert all(isinstance(r["loaded_at"], dt.datetime) for r in ledger.collect())
    left = rows(pending(files, ledger).select("path"))
    assert left == [(NAMES[2],), (NAMES[3],), (NAMES[5],)]
