import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from countcast.sinks import database as db_sink
from countcast.sinks.scratch import scratch_folder, stored
from countcast.sinks.tables import write_by_category, write_by_day, write_table
from countcast.sources.database import DRIVER, Server, Split, read_table, subquery
from countcast.sources.shards import Shard, denied_table, shards, transactions_table, union_shards, years_back
from countcast.sources.tables import read_daily, read_features
from tests.helpers import daily, rows_of


class Recorder:
    """Stands in for Spark's reader and writer and keeps what it is told; no database is contacted."""

    def __init__(self):
        self.seen = {}

    read = write = property(lambda self: self)

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def mode(self, mode):
        self.seen["mode"] = mode
        return self

    def load(self):
        return self

    def save(self):
        self.seen["saved"] = True


def test_subquery_text():
    assert subquery("[dbo].[Den2024]", "MCC, FECHAOP") == "(SELECT MCC, FECHAOP FROM [dbo].[Den2024]) AS t"
    assert subquery("a x", "x.k, y.v", "JOIN b y ON x.k = y.k", "x.k IN (1,2)") == \
        "(SELECT x.k, y.v FROM a x JOIN b y ON x.k = y.k WHERE x.k IN (1,2)) AS t"


def test_database_read_options():
    server = Server("jdbc:sqlserver://host", "me", "secret")
    seen = read_table(Recorder(), server, "Denegadas", "t", "a", split=Split("FECHAOP", dt.date(2024, 1, 1), dt.date(2025, 1, 1), 12)).seen
    assert seen == {
        "format": "jdbc", "url": "jdbc:sqlserver://host;databaseName=Denegadas", "driver": DRIVER, "user": "me",
        "password": "secret", "encrypt": "true", "trustServerCertificate": "true", "dbtable": "(SELECT a FROM t) AS t",
        "fetchsize": "100000", "partitionColumn": "FECHAOP", "lowerBound": "2024-01-01", "upperBound": "2025-01-01",
        "numPartitions": "12"}
    assert "secret" not in repr(server)


def test_integrated_login():
    seen = read_table(Recorder(), Server("jdbc:sqlserver://host"), "Year2024", "t", "a").seen
    assert seen["url"] == "jdbc:sqlserver://host;databaseName=Year2024;integratedSecurity=true"
    assert "user" not in seen and "numPartitions" not in seen


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_database_write_options(mode):
    recorder = Recorder()
    db_sink.save_table(recorder, Server("jdbc:x", "me", "pw"), "DBPrediction", "[dbo].[Predicciones]", mode, connections=8)
    assert recorder.seen["saved"] and recorder.seen["mode"] == mode and recorder.seen["batchsize"] == "10000"
    assert recorder.seen["dbtable"] == "[dbo].[Predicciones]" and recorder.seen["numPartitions"] == "8"


def test_shards():
    assert list(years_back("2024-01-10", 30)) == [2023, 2024]
    found = shards(range(2023, 2027), doubled_from=2024, single_years=[2026])
    assert found == [Shard(2023), Shard(2024), Shard(2024, 2), Shard(2025), Shard(2025, 2), Shard(2026)]
    assert denied_table(Shard(2024)) == ("Denegadas", "[dbo].[Den2024]")
    assert transactions_table(Shard(2024, 2)) == ("Year2024-2", "[dbo].[Año2024-2]")


def test_union_matches_columns_by_name(spark):
    frames = {1: spark.createDataFrame([(1, "a")], "n int, s string"), 2: spark.createDataFrame([("b", 2)], "s string, n int")}
    assert rows_of(union_shards([Shard(1), Shard(2)], lambda s: frames[s.year])) == {(1, "a"): 1, (2, "b"): 1}


def test_table_by_category(spark, folder):
    df = daily(spark, ("1", "2024-01-02", 4, 1), ("1", "2024-01-01", 3, 1), ("2", "2024-01-01", 1, -1))
    write_by_category(df, folder)
    assert rows_of(read_daily(spark, folder)) == rows_of(df)
    assert {p for p in os.listdir(folder) if "=" in p} == {"mcc=1", "mcc=-1"}
    one = read_features(spark, folder, 1)
    assert one.count() == 2 and "mcc=-1" not in "".join(r[0] for r in one.select(F.input_file_name()).collect())
    write_by_category(daily(spark, ("9", "2024-01-01", 7, 1)), folder, replace_only_written=True)
    assert rows_of(read_daily(spark, folder).select("merchant_id", "mcc")) == {("9", 1): 1, ("2", -1): 1}
    write_by_category(daily(spark, ("9", "2024-01-02", 7, 1)), folder, mode="append")
    assert read_daily(spark, folder).count() == 3
    write_by_category(daily(spark, ("5", "2024-01-01", 7, 3)), folder)
    assert rows_of(read_daily(spark, folder).select("merchant_id", "mcc")) == {("5", 3): 1}


def test_hot_category_is_split_over_tasks(spark, folder):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    try:
        rows = spark.range(200_000).selectExpr(
            "cast(id % 97 as string) AS merchant_id", "date_add(DATE'2000-01-01', cast(id % 5000 as int)) AS day",
            "id AS total", "if(id % 3 = 0, cast(id % 50 as int), 7) AS mcc")
        write_by_category(rows, folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(f"{folder}/mcc=7") if f.endswith(".parquet")]
    assert len(files) > 1 and read_daily(spark, folder).count() == 200_000


def test_results_by_day_replace_only_their_day(spark, folder):
    write_by_day(daily(spark, ("1", "2024-01-01", 1, 1), ("1", "2024-01-02", 2, 1)), folder)
    write_by_day(daily(spark, ("1", "2024-01-02", 5, 1)), folder)
    assert sorted(r.total for r in spark.read.parquet(folder).collect()) == [1, 5]


def test_stored_tables_lie_in_the_shared_folder(spark):
    df = stored(spark.range(3).withColumn("k", F.col("id") % 2), "numbers", "k")
    assert scratch_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_folder(spark) in df.inputFiles()[0] and df.count() == 3


def test_plain_table(spark, folder):
    write_table(spark.range(3), folder)
    write_table(spark.range(2), folder)
    assert spark.read.parquet(folder).count() == 2
