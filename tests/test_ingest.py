"""Ingest of text with broken records and changing columns."""

import os

import pytest

from claimlake.sources.ingest import ingest_batch, ingest_checked


@pytest.fixture
def delivered(tmp_path):
    def make(**files):
        for name, text in files.items():
            (tmp_path / "in").mkdir(exist_ok=True)
            (tmp_path / "in" / name.replace("_", ".")).write_text(text, encoding="utf-8")
        return str(tmp_path / "in")

    return make


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_bad_csv_lines_all_go_to_the_sink(spark, delivered, tmp_path):
    path = delivered(a_csv='Claim Item ID,v\n1,a\n2\n3,b,c\n4,"d,e"\n\n5,\n', b_csv="Claim Item ID,v\n6,f\n,,,\n")
    bronze, audit = str(tmp_path / "bronze"), str(tmp_path / "audit")
    ingest_batch(spark, path, bronze, audit, "20240101_120000")
    good, bad = spark.read.parquet(bronze), spark.read.parquet(audit)
    assert rows(good.drop("run_date")) == [("1", "a"), ("4", "d,e"), ("5", None), ("6", "f")]
    assert rows(bad.select("record", "reason")) == [(",,,", "more fields than columns"), ("2", "fewer fields than columns"), ("3,b,c", "more fields than columns")]
    assert {r["file"].rsplit("/", 1)[1] for r in bad.collect()} == {"a.csv", "b.csv"}
    ingest_batch(spark, path, bronze, audit, "20240101_120000")
    assert (spark.read.parquet(bronze).count(), spark.read.parquet(audit).count()) == (4, 3)


def test_csv_columns_are_merged_by_name(spark, delivered):
    found = ingest_checked(spark, delivered(a_csv="k,v\n1,a\n", b_csv="v,new,k\nb,x,2\nbroken\n"))
    assert sorted(found.rows.columns) == ["k", "new", "v"]
    assert rows(found.rows.select("k", "v", "new")) == [("1", "a", None), ("2", "b", "x")]
    assert rows(found.unread.select("record", "reason")) == [("broken", "fewer fields than columns")]


def test_json_records(spark, delivered):
    found = ingest_checked(spark, delivered(a_json='{"k": 1, "v": "a"}\n{"k": 2, "v"\nnothing\n', b_json='{"k": 3, "later": 2.50}\n'), "json")
    assert rows(found.rows.select("k", "v", "later")) == [("1", "a", None), ("3", None, "2.50")]
    assert rows(found.unread.select("record", "reason")) == [("nothing", "no JSON object"), ('{"k": 2, "v"', "no JSON object")]


def test_all_good_all_bad_and_nothing(spark, delivered, tmp_path):
    found = ingest_checked(spark, delivered(a_csv="k,v\n1,a\n"))
    assert (found.rows.count(), found.unread.count()) == (1, 0)
    found = ingest_checked(spark, delivered(a_csv="k,v\n1\n"))
    assert (found.rows.count(), found.unread.count()) == (0, 1)
    found = ingest_checked(spark, delivered(a_csv=""))
    assert (found.rows.count(), found.unread.count()) == (0, 0)
    with pytest.raises(ValueError):
        ingest_checked(spark, str(tmp_path), "xlsx")


def test_many_records_are_all_in_one_route(spark, tmp_path):
    lines = spark.range(5000).selectExpr("CASE WHEN id % 7 = 0 THEN concat(id, ',x,y') WHEN id % 11 = 0 THEN concat(id) ELSE concat(id, ',v') END AS value")
    lines.repartition(6).write.text(str(tmp_path / "in"))
    found = ingest_checked(spark, str(tmp_path / "in"), schema=spark.createDataFrame([], "k string, v string").schema, header=False)
    bad = {i for i in range(5000) if i % 7 == 0 or i % 11 == 0}
    assert {int(r["record"].split(",")[0]) for r in found.unread.collect()} == bad and found.unread.count() == len(bad)
    assert {int(r["k"]) for r in found.rows.collect()} == set(range(5000)) - bad and found.rows.count() == 5000 - len(bad)


def test_a_batch_leaves_no_staged_copy(spark, delivered, tmp_path):
    bronze, audit = str(tmp_path / "bronze"), str(tmp_path / "audit")
    found = ingest_batch(spark, delivered(a_csv="k,v\n1,a\n2\n"), bronze, audit, "20240101_120000")
    assert not os.path.exists(found.staged)
    assert rows(found.rows) == [("1", "a")] and rows(found.unread.select("record", "reason")) == [("2", "fewer fields than columns")]
    (tmp_path / "in" / "a.csv").write_text("k,v\n3\n")
    found = ingest_batch(spark, str(tmp_path / "in"), bronze, audit, "20240101_130000")
    assert (found.rows.count(), found.unread.count()) == (0, 1) and not os.path.exists(found.staged)
