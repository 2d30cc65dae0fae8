"""Merging batches into Parquet tables: keys, months, repeats, deletes."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from claimlake.session import checkpoint_dir
from claimlake.sources.readers import latest_run, partition_folders, path_exists, read_latest
from claimlake.sources.writers import write_bronze
from claimlake.streaming.file_index import FileIndex, file_name
from claimlake.streaming.incremental import merge_batch, upsert

COLS = "claim_item_id long, amount int, service_month string"


@pytest.fixture
def table(spark):
    path = os.path.join(checkpoint_dir(spark), f"up-{uuid.uuid4().hex}")

    def merge(rows, **more):
        upsert(spark, path, spark.createDataFrame(rows, COLS), **more)
        return sorted(((r[0], r[1], r[2]) for r in spark.read.schema(COLS).parquet(path).collect()), key=str)

    merge.path = path
    return merge


def test_a_claim_that_leaves_its_month_alone(spark, table):
    table([(1, 5, "2021-01"), (2, 6, "2021-02")])
    assert table([(1, 7, "2021-02")]) == [(1, 7, "2021-02"), (2, 6, "2021-02")]
    assert set(partition_folders(spark, table.path, "service_month")) == {"2021-02"}


def test_rows_without_a_key_do_not_multiply(table):
    rows = [(None, 5, "2021-01"), (None, 6, "2021-01"), (None, 5, None)]
    assert table(rows) == table(rows) == sorted(rows, key=str)


def test_last_row_of_a_key_in_a_batch(table):
    assert table([(1, 5, "2021-01"), (1, 9, "2021-02"), (1, 7, "2021-01")], order_col="amount") == [(1, 9, "2021-02")]


def test_deletes_and_tables_without_partitions(table):
    table([(1, 5, "a"), (2, 6, "a")], partition_col=None)
    assert table([(1, -1, "a"), (3, 8, "b")], partition_col=None, deleted=F.col("amount") < 0) == [(2, 6, "a"), (3, 8, "b")]


def test_null_month_is_left_behind(spark, table):
    table([(1, 5, None), (2, 6, "2021-02")])
    assert table([(1, 5, "2021-02")]) == [(1, 5, "2021-02"), (2, 6, "2021-02")]


def test_two_batches_of_a_day_and_the_latest(spark):
    path = os.path.join(checkpoint_dir(spark), f"br-{uuid.uuid4().hex}")
    for run, n in (("20240101_080000", 2), ("20240101_120000", 3), ("20240101_120000", 4)):
        write_bronze(spark.range(n), path, run)
    assert spark.read.parquet(path).count() == 6
    assert latest_run(spark, path) == "20240101_120000" and read_latest(spark, path).count() == 4


def test_read_latest_hides_no_fault(spark, tmp_path):
    missing = str(tmp_path / "none")
    assert not path_exists(spark, missing) and read_latest(spark, missing, schema="a int").count() == 0
    with pytest.raises(FileNotFoundError):
        read_latest(spark, missing)
    broken = tmp_path / "bronze" / "run_date=1"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        read_latest(spark, str(tmp_path / "bronze"), schema="a int").collect()


def test_checkpoint_folder_is_asked_for_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    sc = SimpleNamespace(getConf=lambda: {}, master="spark://far:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(sparkContext=sc))


def test_claim_ids_never_collide_or_overflow(spark):
    """The fixture's id over keys far beyond BIGINT packing."""
    from claimlake.sources import fixture as fx

    keys = [(o, n, p, s) for o in (1, 9_000_000, 17_000_000, 10**11) for n in (1, 7) for p in (1, 10, 10**9) for s in (1, 10**8, 10**9)]
    line = spark.createDataFrame([(o, n, p, s, "A", 5.0, 10.0, 0.1) for o, n, p, s in keys],
                                 "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_returnflag string, l_quantity double, l_extendedprice double, l_discount double")
    orders = line.select(F.col("l_orderkey").alias("o_orderkey"), F.lit(3).alias("o_custkey")).distinct()
    supplier = line.select(F.col("l_suppkey").alias("s_suppkey"), F.lit("S").alias("s_name"), F.lit(1).alias("s_nationkey")).distinct()
    nation = spark.createDataFrame([(1, "N")], "n_nationkey int, n_name string")
    raw = spark.sql(fx.spark_lens_sql(), lineitem=line, orders=orders, supplier=supplier, nation=nation)
    ids = [r[0] for r in raw.select(F.col("claim_item_id").cast("decimal(38,0)")).collect()]
    assert None not in ids and len(set(ids)) == len(ids) > len(keys)


def data_files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) if "_index" not in d for f in fs if f.endswith(".parquet")}


@pytest.fixture
def many(spark):
    """A table of 4 months and some 40 files."""
    path = os.path.join(checkpoint_dir(spark), f"up-{uuid.uuid4().hex}")
    rows = spark.range(8000).selectExpr("id AS claim_item_id", "cast(id % 7 AS int) AS amount", "concat('2021-0', 1 + id % 4) AS service_month")
    out = rows.repartitionByRange(40, "service_month", F.xxhash64(F.concat(F.lit("k"), F.col("claim_item_id").cast("string"))))
    out.write.partitionBy("service_month").parquet(path)
    return path


def test_a_thousandth_of_the_keys_rewrites_only_their_files(spark, many):
    before = data_files(many)
    assert len(before) >= 40
    holds = spark.read.schema(COLS).parquet(many).where(F.col("claim_item_id").isin(5, 17, 4000, 7999)).select("_metadata.file_path").distinct().count()
    batch = spark.createDataFrame([(5, 100, "2021-02"), (17, 100, "2021-01"), (4000, -1, "2021-01"), (7999, 100, "2021-04"), (9000, 100, "2021-03")], COLS)
    done = merge_batch(spark, many, batch, deleted=F.col("amount") < 0, images=many + "-images")
    after = data_files(many)
    assert len(done.rewritten) == holds <= 4 and len(set(before) - set(after)) == holds
    assert all(after[f] == t for f, t in before.items() if f in after)
    got = {r[0]: (r[1], r[2]) for r in spark.read.schema(COLS).parquet(many).collect()}
    assert len(got) == 8000 and got[5] == (100, "2021-02") and got[17] == (100, "2021-01") and 4000 not in got and got[9000] == (100, "2021-03")
    assert {(r["claim_item_id"], r["_sign"]) for r in done.changes.collect()} == {(5, -1), (5, 1), (17, -1), (17, 1), (4000, -1), (7999, -1), (7999, 1), (9000, 1)}
    again = merge_batch(spark, many, batch, deleted=F.col("amount") < 0, images=many + "-images")
    assert again.rewritten == [] and again.changes.count() == 8


def test_new_keys_rewrite_no_file(spark, many):
    before = data_files(many)
    assert merge_batch(spark, many, spark.createDataFrame([(k, 1, "2021-09") for k in range(10_000, 10_050)], COLS)).rewritten == []
    assert before.items() <= data_files(many).items()


def test_filters_rule_files_out_before_they_are_read(spark, many):
    """Keys of a hash-ordered table meet one file a month by range; the filter leaves few of these."""
    index = FileIndex(spark, many)
    keyed = lambda df: df.withColumn("_k", F.concat(F.lit("k"), F.col("claim_item_id").cast("string")))
    here = index.update(keyed)
    ask = lambda ids: index.candidates(spark.createDataFrame([(f"k{i}",) for i in ids], "_k string"), here)
    assert len(ask(range(50_000, 50_100))) <= 8  # of 400 pairs of key and file in range, one in 120
    held = {r[0]: r[1] for r in spark.read.parquet(many).select("claim_item_id", file_name()).collect()}
    for i in (1, 2, 3, 777, 4242):
        assert held[i] in ask([i])  # a file that holds a key is never ruled out


def test_many_unknown_keys_name_no_file_and_the_index_has_one_entry_a_row(spark, many):
    """A lookup's work does not hang on the files a key's hash lies between."""
    index = FileIndex(spark, many)
    keyed = lambda df: df.withColumn("_k", F.concat(F.lit("k"), F.col("claim_item_id").cast("string")))
    here = index.update(keyed)
    keys = lambda a, b: spark.range(a, b).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("_k"))
    assert index.candidates(keys(50_000, 90_000), here) == []
    assert index.candidates(keys(0, 8000), here) == sorted(here)
    assert spark.read.parquet(os.path.join(many, "_index", "held")).count() == 8000
    assert index.update(keyed) == here and spark.read.parquet(os.path.join(many, "_index", "held")).count() == 8000


@pytest.mark.parametrize("cut", ["before", "within"])
def test_a_swap_that_was_cut_off_is_finished_by_the_next_merge(spark, many, monkeypatch, cut):
    batch = spark.createDataFrame([(5, 100, "2021-02"), (6, 100, "2021-01")], COLS)

    def fail(*a):
        raise RuntimeError("lost")

    monkeypatch.setattr("claimlake.streaming.file_index." + {"before": "finish", "within": "_delete"}[cut], fail)
    if cut == "before":
        monkeypatch.setattr("claimlake.streaming.incremental.X.finish", lambda *a: None)
        monkeypatch.setattr("claimlake.streaming.file_index.finish", lambda *a: None)
        merge_batch(spark, many, batch)
        assert spark.read.schema(COLS).parquet(many).where("amount = 100").count() == 0
    else:
        with pytest.raises(RuntimeError):
            merge_batch(spark, many, batch)
        assert spark.read.schema(COLS).parquet(many).count() > 8000
    monkeypatch.undo()
    merge_batch(spark, many, spark.createDataFrame([(7, 100, "2021-04")], COLS))
    got = spark.read.schema(COLS).parquet(many)
    assert got.where("amount = 100").count() == 3 and got.select("claim_item_id").distinct().count() == got.count() == 8000


def test_a_new_column_is_null_where_nothing_was_rewritten(spark, table):
    table([(1, 5, "2021-01"), (2, 6, "2021-02")])
    wide = COLS + ", note string"
    upsert(spark, table.path, spark.createDataFrame([(1, 7, "2021-01", "x")], wide))
    assert sorted(tuple(r) for r in spark.read.schema(wide).parquet(table.path).select("claim_item_id", "amount", "note").collect()) == [(1, 7, "x"), (2, 6, None)]


def test_keys_without_partitions_go_by_file_too(spark, table):
    table([(k, 0, "a") for k in range(200)], partition_col=None)
    before = data_files(table.path)
    assert len(table([(3, 9, "a")], partition_col=None)) == 200
    assert len(set(before) - set(data_files(table.path))) == 1
