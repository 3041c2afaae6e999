"""Snapshots, .tbl text and source configuration."""

from __future__ import annotations

import datetime as dt
import os
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.plans.snapshots import SnapshotDamaged, SnapshotNotFound, SnapshotStore
from strata.sources import JdbcConfig, SourceConfigError, TblSource, read_tbl, split_table_name, write_tbl
from strata.sources.jdbc import REQUIRED_SETTINGS, JdbcSource

T1 = "2023-01-01T12:00:00.000000"
T2 = "2023-01-02T12:00:00.000000"


def _frame(spark, stamp, n):
    return spark.createDataFrame([(i, f"v{i}", stamp) for i in range(n)], "k long, v string, etl_inserted string")


def test_latest_wins_and_named_partition(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root)
    store.write(_frame(spark, T1, 3), "bronze", "t")
    store.write(_frame(spark, T2, 5), "bronze", "t")
    latest = store.read_latest("bronze", "t")
    assert latest.count() == 5
    assert {r.etl_inserted for r in latest.collect()} == {T2}
    assert dict(latest.dtypes)["etl_inserted"] == "string"  # never inferred as a timestamp
    assert store.latest_stamp("bronze", "t") == T2
    assert store.stamps("bronze", "t") == [T1, T2]  # '2023-01-01T12:00:00' is stored as '...T12%3A00%3A00...'
    assert store.latest_stamp("bronze", "t") == latest.agg(F.max("etl_inserted")).first()[0]
    first = store.read_partition("bronze", "t", {"etl_inserted": T1})
    assert first.count() == 3
    assert latest.columns == ["k", "v", "etl_inserted"]


def test_latest_read_prunes_partitions(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root)
    store.write(_frame(spark, T1, 3), "bronze", "t")
    store.write(_frame(spark, T2, 3), "bronze", "t")
    latest = store.read_latest("bronze", "t")
    assert len(latest.inputFiles()) >= 1 and all("2023-01-02T" in f for f in latest.inputFiles())
    assert latest.where(F.col("etl_inserted") == T1)._jdf.queryExecution().optimizedPlan().toString().startswith("LocalRelation <empty>")


def test_rewriting_a_stamp_is_idempotent(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root)
    store.write(_frame(spark, T1, 3), "silver", "t")
    store.write(_frame(spark, T2, 4), "silver", "t")
    store.write(_frame(spark, T2, 4), "silver", "t")
    assert store.read_partition("silver", "t", {"etl_inserted": T2}).count() == 4
    assert store.read_partition("silver", "t", {"etl_inserted": T1}).count() == 3  # other stamp kept


def test_a_stored_table_leaves_no_shuffle_files(spark, tmp_root):
    """What a table was built with goes once it is written, while the session goes on; later tables need the disk."""
    files = lambda: {f for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("|").split("|") if "/shuffle_" in f}
    store, before = SnapshotStore(spark, tmp_root), files()
    record = store.write_stamp(spark.range(20_000).repartition(7, "id").withColumn("etl_inserted", F.lit(T1)), "silver", "t", T1)
    for _ in range(40):  # Spark's cleaner has a thread of its own
        if not files() - before:
            break
        time.sleep(0.5)
    assert record.rows == 20_000 and not files() - before
    assert store.read_latest("silver", "t").count() == 20_000


def test_stored_files_are_packed_whatever_the_session_writes(spark, tmp_root):
    codec = spark.conf.get("spark.sql.parquet.compression.codec")
    spark.conf.set("spark.sql.parquet.compression.codec", "snappy")
    try:
        records = [SnapshotStore(spark, f"{tmp_root}/{x.get('compression')}", **x).write_stamp(_frame(spark, T1, 3), "bronze", "t", T1) for x in ({}, {"compression": "gzip"})]
    finally:
        spark.conf.set("spark.sql.parquet.compression.codec", codec)
    assert all(f.endswith(".zstd.parquet") for f, _ in records[0].files) and all(f.endswith(".gz.parquet") for f, _ in records[1].files)


def test_multi_key_partitions(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root)
    df = spark.createDataFrame([(1, "a", "x", T1), (2, "b", "y", T1)], "k long, v string, region string, etl_inserted string")
    store.write(df, "gold", "m", partition_keys=("etl_inserted", "region"))
    got = store.read_partition("gold", "m", {"etl_inserted": T1, "region": "y"}).collect()
    assert [r.k for r in got] == [2]


def test_missing_snapshot_raises(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root)
    with pytest.raises(SnapshotNotFound):
        store.read_latest("gold", "nothing_here")
    os.makedirs(store.path("gold", "empty").replace("file:", ""), exist_ok=True)
    with pytest.raises(SnapshotNotFound):
        store.read_latest("gold", "empty")


def test_tbl_trailing_delimiter_empty_field_and_missing_file(spark, tmp_root):
    d = tmp_root.replace("file:", "")
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/nation.tbl", "w") as f:
        f.write("0|ALGERIA|0| haggle. carefully final deposits|\n1|ARGENTINA|1||\n")
    with pytest.raises(FileNotFoundError, match="region.tbl"):
        TblSource(spark, tmp_root).table("region")
    src = TblSource(spark, tmp_root, allow_missing=True)
    rows = {r.n_nationkey: r for r in src.table("nation").collect()}
    assert rows[0].n_name == "ALGERIA" and rows[0].n_comment == " haggle. carefully final deposits"
    assert rows[1].n_comment is None
    assert src.table("nation").columns == ["n_nationkey", "n_name", "n_regionkey", "n_comment"]
    empty = src.table("region")
    assert empty.count() == 0 and empty.columns == ["r_regionkey", "r_name", "r_comment"]


def test_tbl_round_trip_keeps_types(spark, tmp_root):
    df = spark.createDataFrame(
        [(1, Decimal("12.30"), dt.date(1998, 12, 1), None)], "k long, amt decimal(15,2), d date, s string")
    path = f"{tmp_root}/x.tbl"
    write_tbl(df, path)
    lines = spark.read.text(path).collect()
    assert lines[0].value == "1|12.30|1998-12-01||"
    back = read_tbl(spark, path, df.schema).collect()
    assert back == df.collect()


def test_source_settings_error_lists_every_missing_name():
    with pytest.raises(SourceConfigError) as e:
        JdbcConfig.from_env({"UPS_HOST": "h", "UPS_PORT": "5432"})
    msg = str(e.value)
    assert all(k in msg for k in ("UPS_DATABASE", "UPS_USERNAME", "UPS_PASSWORD"))
    assert "UPS_HOST" not in msg
    cfg = JdbcConfig.from_env({k: "v" for k in REQUIRED_SETTINGS})
    assert cfg.url == "jdbc:postgresql://v:v/v"


def test_table_name_resolution():
    assert split_table_name("customer") == ("public", "customer")
    assert split_table_name("tpch.orders") == ("tpch", "orders")
    with pytest.raises(ValueError):
        split_table_name("a.b.c")


def test_jdbc_reader_options(spark):
    src = JdbcSource(spark, JdbcConfig("db", "5432", "tpch", "u", "p"))
    opts = src.options("lineitem")
    assert opts["dbtable"] == "public.lineitem" and opts["url"] == "jdbc:postgresql://db:5432/tpch"


def test_stamp_with_escaped_characters_round_trips(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root)
    odd = "2024-05-06 07:08:09%x/y"
    store.write(_frame(spark, odd, 2), "bronze", "odd")
    assert store.latest_stamp("bronze", "odd") == odd
    assert store.read_latest("bronze", "odd").count() == 2


def test_parquet_source_casts_to_ddl_types(spark, tmp_root):
    from strata.sources import ParquetSource

    raw = spark.createDataFrame([(1, 2, 12.345, dt.datetime(1998, 1, 2, 0, 0))],
                                "o_orderkey int, o_custkey int, o_totalprice double, o_orderdate timestamp")
    raw.write.parquet(f"{tmp_root}/orders.parquet")
    df = ParquetSource(spark, tmp_root).table("orders")
    types = dict(df.dtypes)
    assert types == {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "decimal(15,2)",
                     "o_orderdate": "date"}
    assert df.first().o_totalprice == Decimal("12.35")


def test_tbl_source_reads_dbgen_chunks_and_compressed_files(spark, tmp_root):
    import gzip

    d = tmp_root.replace("file:", "") + "/chunks"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/region.tbl.1", "w") as f:
        f.write("0|AFRICA|c0|\n1|AMERICA|c1|\n")
    with open(f"{d}/region.tbl.2", "w") as f:
        f.write("2|ASIA|c2|\n")
    with gzip.open(f"{d}/nation.tbl.gz", "wt") as f:
        f.write("0|ALGERIA|0|x|\n1|ARGENTINA|1||\n")
    with open(f"{d}/part.tbl", "w") as f:
        f.write("1|p|M|B|T|5|BOX|1.50||\n")
    with open(f"{d}/partsupp.tbl", "w") as f:
        f.write("1|2|3|4.00|c|\n")
    src = TblSource(spark, tmp_root + "/chunks")
    assert sorted(r.r_name for r in src.table("region").collect()) == ["AFRICA", "AMERICA", "ASIA"]
    assert src.table("nation").count() == 2
    assert src.table("part").count() == 1  # part.tbl* does not pick up partsupp.tbl
    assert src.table("partsupp").first().ps_supplycost == Decimal("4.00")


def _broken(spark, stamp, n):
    """Rows of which the last one fails in the middle of the write."""
    return _frame(spark, stamp, n).withColumn("v", F.when(F.col("k") < n - 1, F.col("v")).otherwise(F.raise_error(F.lit("broken row"))))


def test_a_crashed_write_leaves_the_older_snapshot(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root)
    store.write_stamp(_frame(spark, T1, 3), "bronze", "t", T1)
    with pytest.raises(Exception, match="broken row"):
        store.write_stamp(_broken(spark, T2, 9), "bronze", "t", T2)
    # A driver that dies leaves its attempt: files, but no record.
    left = store.stage(_frame(spark, T2, 9), "bronze", "t", T2)
    os.makedirs(store.partition_path("bronze", "t", "2024-01-01T00:00:00.000000").removeprefix("file:"))
    assert store.stamps("bronze", "t") == [T1] and store.read_latest("bronze", "t").count() == 3
    assert store.staged(left).count() == left.rows == 9
    assert [p for p in store.vacuum("bronze", "t")] == [left.path] and store.read_latest("bronze", "t").count() == 3
    with pytest.raises(SnapshotNotFound):
        store.read_partition("bronze", "t", {"etl_inserted": T2})


def test_a_write_adds_no_shuffle(spark, tmp_root):
    """Each file holds the rows of one partition of the table's last step, in their order."""
    df = spark.range(1000).withColumn("b", F.col("id") % 50).repartition(4, "b").sortWithinPartitions("id")
    store = SnapshotStore(spark, tmp_root)
    record = store.stage(df, "silver", "t", T1)
    files = store.staged(record).select("id", "b", F.input_file_name().alias("f")).toPandas().groupby("f")
    kept = [(f["id"].tolist(), set(f["b"])) for _, f in files]
    assert record.rows == 1000 and sum(len(b) for _, b in kept) == 50
    assert all(ids == sorted(ids) for ids, _ in kept)


def test_the_fact_of_failed_writes_is_built_once(spark, monkeypatch):
    """The broken and the unpublished attempts take the stored rows: only the first write reads the sources."""
    from strata import queries
    from tests.conftest import SF_SMALL

    staged, stage = [], SnapshotStore.stage

    def kept(self, df, *a, **k):
        staged.append(df.inputFiles())
        return stage(self, df, *a, **k)

    monkeypatch.setattr(SnapshotStore, "stage", kept)
    want = queries.q_fct_orders(spark, SF_SMALL)
    assert queries.q_snapshot_failed_writes(spark, SF_SMALL).exceptAll(want).isEmpty()
    assert [any("lineitem.parquet" in f for f in files) for files in staged] == [True, False, False, False]


def test_a_failed_rerun_leaves_the_earlier_rows(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root)
    first = store.write_stamp(_frame(spark, T1, 3), "bronze", "t", T1)
    with pytest.raises(Exception, match="broken row"):
        store.write_stamp(_broken(spark, T1, 9), "bronze", "t", T1)
    assert store.read_latest("bronze", "t").count() == 3
    reader = store.read_latest("bronze", "t")
    store.write_stamp(_frame(spark, T1, 0), "bronze", "t", T1)
    assert store.read_latest("bronze", "t").count() == 0 and store.stamps("bronze", "t") == [T1]
    assert reader.count() == 3  # a reader of the earlier record still has its files
    assert store.vacuum("bronze", "t") == [first.path] and store.read_latest("bronze", "t").count() == 0


def test_a_table_written_from_its_own_snapshot(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root)
    store.write_stamp(_frame(spark, T1, 5), "bronze", "t", T1)
    store.write_stamp(store.read_latest("bronze", "t").where("k > 1"), "bronze", "t", T1)
    assert store.read_latest("bronze", "t").count() == 3


def test_a_lost_file_is_an_error_not_fewer_rows(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root)
    record = store.write_stamp(_frame(spark, T1, 100).repartition(4), "bronze", "t", T1)
    assert record.rows == 100 and record == store.record("bronze", "t", T1) and sum(n for _, n in record.files) > 0
    os.remove(f"{store.path('bronze', 't').removeprefix('file:')}/{record.path}/{record.files[0][0]}")
    with pytest.raises(SnapshotDamaged, match=record.files[0][0]):
        store.read_latest("bronze", "t")


def test_named_partition_over_all_snapshots(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root)
    kind = "k long, region string, etl_inserted string"
    store.write(spark.createDataFrame([(1, "x", T1), (2, "y", T1), (3, "y", T2)], kind), "gold", "m", partition_keys=("etl_inserted", "region"))
    assert sorted(r.k for r in store.read_partition("gold", "m", {"region": "y"}).collect()) == [2, 3]
    assert store.stamps("gold", "m") == [T1, T2] and store.record("gold", "m", T1).rows == 2


def test_tbl_lines_that_do_not_fit(spark, tmp_root):
    from strata.sources import RejectedLines

    d = tmp_root.removeprefix("file:")
    os.makedirs(d, exist_ok=True)
    good, bad = ["0|ALGERIA|0|x|", "1|ARGENTINA|1||"], ["x|BRAZIL|1|c|", "3|CANADA|1|c", "4|EGYPT|4|c|d|", "5|ETHIOPIA|0|c|d", "", "6|FRANCE|three|c|"]
    with open(f"{d}/nation.tbl", "w") as f:
        f.write("\n".join(good + bad) + "\n")
    bad = [b for b in bad if b]  # an empty line is no line
    src = TblSource(spark, tmp_root, max_rejects=5, reject_dir=f"{tmp_root}/rejects")
    SnapshotStore(spark, f"{tmp_root}/lake").write_stamp(src.table("nation"), "bronze", "nation", T1)
    assert sorted(r.n_name for r in SnapshotStore(spark, f"{tmp_root}/lake").read_latest("bronze", "nation").collect()) == ["ALGERIA", "ARGENTINA"]
    assert src.settle("nation") == len(bad) == 5
    rows = {r.line: r for r in spark.read.parquet(f"{tmp_root}/rejects/nation").collect()}
    assert set(rows) == set(bad) and all(r.file.endswith("nation.tbl") and r.split_offset == 0 for r in rows.values())
    assert {b: rows[b].reason for b in bad} == {
        bad[0]: "n_nationkey is not int: x", bad[1]: "4 fields, not 5", bad[2]: "6 fields, not 5", bad[3]: "text after the last delimiter: d", bad[4]: "n_regionkey is not int: three"}
    strict = TblSource(spark, tmp_root, max_rejects=4)
    strict.table("nation").write.format("noop").mode("overwrite").save()
    with pytest.raises(RejectedLines, match="5 lines do not fit, 4 may"):
        strict.settle("nation")
    with pytest.raises(Exception, match="line does not fit"):
        read_tbl(spark, f"{tmp_root}/nation.tbl", src.schemas["nation"]).collect()
    assert src.table("nation").select("n_name").count() == 4  # types are those of the columns read; the number of fields is always checked


def _database(rows):
    """An in-process stand-in for the database, which only this process sees; answers the pushed-down queries."""
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE SCHEMA public")
    con.execute("CREATE TABLE public.orders (o_orderkey BIGINT)")
    con.executemany("INSERT INTO public.orders VALUES (?)", [(r,) for r in rows]) if rows else None
    return con


@pytest.mark.parametrize("keys", [
    list(range(1000)),
    [0] + [10**12 + i for i in range(998)] + [10**15],                 # nearly all keys in a sliver of their range
    [i * i * i for i in range(1000)],
    [7] * 400 + list(range(-300, 300)),                                 # one key holds 40 % of the rows
    [None] * 50 + list(range(950)),
])
def test_key_ranges_hold_as_many_rows_each(spark, keys):
    con = _database(keys)
    src = JdbcSource(spark, JdbcConfig("db", "5432", "tpch", "u", "p"), num_partitions=10)
    asked = []

    def query(sql):
        asked.append(sql)
        rows = con.execute(sql).fetchall()
        assert len(rows) <= 1024
        return rows

    predicates = src.predicates("orders", query)
    counts = [con.execute(f"SELECT count(*) FROM public.orders WHERE {p}").fetchall()[0][0] for p in predicates]
    assert sum(counts) == len(keys)  # every row in one range
    hot = max(keys.count(k) for k in set(keys))
    assert max(counts) <= max(100 if hot == 1 else hot, 100) + keys.count(None) and len(predicates) >= 8 - (hot > 1)
    assert len(asked) < 30


def test_number_of_key_ranges_follows_the_rows(spark):
    con = _database(range(1000))
    query = lambda sql: con.execute(sql).fetchall()
    config = JdbcConfig("db", "5432", "tpch", "u", "p")
    assert len(JdbcSource(spark, config, rows_per_partition=50).predicates("orders", query)) == 20
    assert JdbcSource(spark, config).predicates("orders", query) == []
    assert JdbcSource(spark, config, num_partitions=1).predicates("orders", None) == []
    assert JdbcSource(spark, config, rows_per_partition=5).predicates("orders", lambda sql: _database([]).execute(sql).fetchall()) == []


def test_commit_settings_by_the_roots_scheme():
    from strata.session import committer_conf

    assert committer_conf(None) == committer_conf("/lake") == committer_conf("file:/lake") == committer_conf("hdfs://n/lake") == {}
    assert committer_conf("s3a://b/lake")["spark.hadoop.fs.s3a.committer.name"] == "magic"
    for root, scheme in (("s3a://b/x", "s3a"), ("abfss://c@a/x", "abfs"), ("gs://b/x", "gs")):
        conf = committer_conf(root)
        assert f"spark.hadoop.mapreduce.outputcommitter.factory.scheme.{scheme}" in conf and conf["spark.sql.sources.commitProtocolClass"].endswith("PathOutputCommitProtocol")
