import warnings
import threading

import pytest
from pyspark.sql import Row, functions as F

from tidewright import JobError, SchemaMismatch
from tidewright.sinks import append_to_table, write_evolving_table, write_files
from tidewright.sinks.jdbc import write_jdbc
from tidewright.sources import read_files, read_table
from tidewright.sources.jdbc import jdbc_options, read_jdbc
from tidewright.sources.kafka import kafka_options


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def db(spark, folder):
    name = "db_" + folder.replace("/", "_").replace("-", "_")
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_files_round_trip(spark, folder):
    df = spark.range(100).selectExpr("id", "id % 3 as p")
    for _ in range(2):
        write_files(df, f"{folder}/out", partition_by=["p"])
    assert rows(read_files(spark, f"{folder}/out", columns=["id", "p"])) == rows(df.selectExpr("id", "int(p)"))
    write_files(df, f"{folder}/csv", "csv", "append", options={"header": "true"})
    assert read_files(spark, [f"{folder}/csv", f"{folder}/csv"], "csv", {"header": True}).count() == 200
    assert read_files(spark, "unused", options={"paths": [f"{folder}/out"]}).count() == 100


def test_odd_column_names(spark, folder, db):
    df = spark.range(6).selectExpr("id as `an id`", "id % 2 as `a.b`", "'x' as `p q`")
    write_files(df, f"{folder}/out", partition_by=["p q"])
    assert spark.read.parquet(f"{folder}/out").columns == ["an id", "a.b", "p q"]
    for batch in (df, df.withColumn("new one", F.lit(1)), df.withColumn("st", F.struct(F.lit(1).alias("x y")))):
        write_evolving_table(batch, db, "odd", "append", ["p q"])
    wider = df.withColumn("st", F.struct(F.lit(1).alias("x y"), F.lit(2).alias("z.z")))
    write_evolving_table(wider, db, "odd", "append", ["p q"])
    append_to_table(spark.table(f"{db}.odd").limit(2), db, "odd")
    table = spark.table(f"{db}.odd")
    assert table.columns == ["an id", "a.b", "new one", "st", "p q"] and table.count() == 26
    assert table.schema["st"].dataType.fieldNames() == ["x y", "z.z"]


def test_a_large_partition_is_cut_into_several_files(spark, folder):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    try:
        df = spark.range(0, 40000, 1, 16).selectExpr("id", "if(id % 100 = 0, 1, 0) as p", "uuid() as t")
        write_files(df, f"{folder}/out", partition_by=["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    out = spark.read.parquet(f"{folder}/out").withColumn("f", F.input_file_name())
    files = {r.p: r.n for r in out.groupBy("p").agg(F.count_distinct("f").alias("n")).collect()}
    assert files[0] > 1 and files[1] <= 3 and out.count() == 40000


def test_append_by_name(spark, db):
    spark.sql(f"create database {db}")
    spark.sql(f"create table {db}.t (a int, b string) using parquet")
    for _ in range(2):
        append_to_table(spark.sql("select 'x' as b, 1 as a, 9 as extra"), db, "t")
    assert rows(read_table(spark, db, "t")) == [(1, "x"), (1, "x")]


def test_evolve_and_append(spark, db):
    write = lambda query: write_evolving_table(spark.sql(query), db, "t", "append")
    write("select 1 as id, 10 as v, null as dropped")
    write("select 'w2' as w, '20' as v, 2 as id")
    write("select 3 as id, 'oops' as v")
    table = spark.table(f"{db}.t")
    assert table.schema.simpleString() == "struct<id:int,v:int,w:string>"
    assert rows(table) == [(1, 10, None), (2, 20, "w2"), (3, None, None)]


def test_nested_evolution_keeps_old_rows(spark, db):
    def write(query, mode="append"):
        write_evolving_table(spark.sql(query), db, "t", mode, ["p"])

    write("select 1 as id, named_struct('a', 1) as st, array(named_struct('x', 1)) as xs, 'p1' as p")
    write(
        "select 2 as id, named_struct('b', 'n', 'a', 5) as st, array(named_struct('y', 2, 'x', 3)) as xs, 'p2' as p,"
        " 'new' as top"
    )
    table = spark.table(f"{db}.t")
    assert rows(table.select("id", "st", "xs", "top", "p")) == [
        (1, Row(a=1, b=None), [Row(x=1, y=None)], None, "p1"),
        (2, Row(a=5, b="n"), [Row(x=3, y=2)], "new", "p2"),
    ]
    write("select 3 as id, cast(null as struct<a:int>) as st, cast(null as array<struct<x:int>>) as xs, 'p1' as p")
    assert spark.table(f"{db}.t").count() == 3
    assert not spark.catalog.tableExists(f"{db}.t__evolving")


def test_overwrite_replaces_only_the_partitions_of_the_batch(spark, db):
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")

    def write(query):
        write_evolving_table(spark.sql(query), db, "t", "overwrite", ["p"])

    write("select id, if(id < 2, 'p1', 'p2') as p from range(4)")
    write("select 9L as id, 'p2' as p, 'z' as extra")
    assert rows(spark.table(f"{db}.t").select("id", "extra", "p")) == [
        (0, None, "p1"), (1, None, "p1"), (9, "z", "p2")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_overwrite_without_partitions_replaces_all(spark, db):
    write_evolving_table(spark.range(5), db, "t")
    write_evolving_table(spark.range(2), db, "t")
    assert rows(spark.table(f"{db}.t")) == [(0,), (1,)]


def test_a_table_can_be_overwritten_from_itself(spark, db):
    write_evolving_table(spark.range(5), db, "t")
    write_evolving_table(spark.table(f"{db}.t").filter("id > 2"), db, "t")
    assert rows(spark.table(f"{db}.t")) == [(3,), (4,)]


def test_kind_clash_writes_nothing(spark, db):
    write_evolving_table(spark.sql("select 1 as id, named_struct('a', array(1)) as st"), db, "t")
    for batch in ("select 2 as id, array(1) as st", "select 2 as id, named_struct('a', 1) as st"):
        with pytest.raises(SchemaMismatch):
            write_evolving_table(spark.sql(batch), db, "t", "append")
    assert spark.table(f"{db}.t").count() == 1


def test_without_fill_nulls(spark, db):
    write_evolving_table(spark.sql("select 1 as id, 2 as v"), db, "t", "append", fill_nulls=False)
    write_evolving_table(spark.sql("select 'n' as w, 3 as id"), db, "t", "append", fill_nulls=False)
    assert rows(spark.table(f"{db}.t")) == [(1, 2, None), (3, None, "n")]


def test_interrupted_evolution_is_finished(spark, db, folder):
    write_evolving_table(spark.sql("select 1 as id"), db, "t", "append", path=f"{folder}/t")
    spark.sql(f"create table {db}.t__evolving (id int, w string) using parquet location '{folder}/t'")
    write_evolving_table(spark.sql("select 5 as id"), db, "t", "append", path=f"{folder}/t")
    assert not spark.catalog.tableExists(f"{db}.t__evolving")
    spark.sql(f"create table {db}.t__evolving (id int, w string) using parquet location '{folder}/t'")
    spark.sql(f"drop table {db}.t")
    write_evolving_table(spark.sql("select 2 as id, 'x' as w"), db, "t", "append", path=f"{folder}/t")
    assert rows(spark.table(f"{db}.t")) == [(1, None), (2, "x"), (5, None)]


def test_a_table_in_the_way_is_not_dropped(spark, db):
    write_evolving_table(spark.sql("select 1 as id, named_struct('a', 1) as st"), db, "t", "append")
    spark.range(3).write.saveAsTable(f"{db}.t__evolving")
    with pytest.raises(JobError):
        write_evolving_table(spark.sql("select 2 as id, named_struct('b', 1) as st"), db, "t", "append")
    assert spark.table(f"{db}.t__evolving").count() == 3 and spark.table(f"{db}.t").count() == 1


def test_json_tables(spark, db):
    for mode in ("append", "overwrite"):
        write_evolving_table(spark.sql("select 1 as id, 'x' as p"), db, "j", mode, ["p"], format="json")
    assert rows(spark.table(f"{db}.j")) == [(1, "x")]


def test_iceberg_calls(spark, db, monkeypatch):
    """Iceberg itself is absent: what would be asked of it."""
    calls = []

    class Writer:
        def __init__(self, frame, name):
            calls.append(("writeTo", name, frame.columns))

        def __getattr__(self, name):
            return lambda *given: calls.append((name, *[str(g) for g in given])) or self

    monkeypatch.setattr(type(spark.range(1)), "writeTo", lambda frame, name: Writer(frame, name))
    batch = spark.sql("select 1 as id, null as nothing, 'x' as p")
    write_evolving_table(batch, db, "i", "append", ["p"], path="s3://b/i", format="iceberg")
    assert calls[0] == ("writeTo", f"`{db}`.`i`", ["id", "p"]) and calls[1] == ("using", "iceberg")
    assert ("tableProperty", "write.distribution-mode", "hash") in calls
    assert calls[-2:] == [("tableProperty", "location", "s3://b/i"), ("create",)]
    spark.sql(f"create table {db}.i (id int, p string) using parquet")
    for mode, last in (("append", "append"), ("overwrite", "overwritePartitions")):
        calls.clear()
        write_evolving_table(spark.sql("select 'n' as new, 'x' as p"), db, "i", mode, format="iceberg")
        assert calls == [("writeTo", f"`{db}`.`i`", ["id", "p", "new"]), ("option", "merge-schema", "true"), (last,)]
    with pytest.raises(SchemaMismatch):
        write_evolving_table(spark.sql("select array(1) as id"), db, "i", "append", format="iceberg")


def test_refusals(spark, db):
    with pytest.raises(JobError):
        write_evolving_table(spark.range(1), db, "t", "ignore")
    with pytest.raises(SchemaMismatch):
        write_evolving_table(spark.sql("select null as a"), db, "t")


@pytest.mark.parametrize("options, warned", [({}, True), ({"numPartitions": 4}, True), ({"numPartitions": 1}, False), ({"partitionColumn": "a"}, False)])
def test_a_table_read_over_one_connection_is_named(spark, options, warned):
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        # There is no such driver.
        with pytest.raises(Exception):
            read_jdbc(spark, table="t", connection_url="jdbc:nothing:x", options=options)
    assert any("one task" in str(w.message) for w in seen) == warned


def test_jdbc_options():
    assert jdbc_options("t", "jdbc:x", options={"numPartitions": 8, "flag": True}) == {
        "url": "jdbc:x", "dbtable": "t", "numPartitions": "8", "flag": "true"}
    derived = jdbc_options(
        "t", None, "postgresql", "shop", {"rds_iam": {"host": "h", "port": 5432, "username": "u"}, "password": "p"})
    assert derived == {"url": "jdbc:postgresql://h:5432/shop", "dbtable": "t", "user": "u", "password": "p",
                       "ssl": "true", "sslmode": "require"}
    for bad in ({"table": None}, {"table": "t"}, {"table": "t", "auth": {"host": "h", "port": 1}}):
        with pytest.raises(JobError):
            jdbc_options(**bad)


def test_jdbc_writer_gets_the_options():
    class Writer:
        def __getattr__(self, name):
            return lambda *a, **k: calls.append((name, a, k)) or self

    calls = []
    frame = type("Frame", (), {"write": Writer()})()
    write_jdbc(frame, "append", table="t", connection_url="jdbc:x")
    assert calls == [("format", ("jdbc",), {}), ("options", (), {"url": "jdbc:x", "dbtable": "t"}),
                     ("mode", ("append",), {}), ("save", (), {})]


def test_kafka_options():
    assert kafka_options("h:9092", "t", {"startingOffsets": "earliest"}) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest"}
    with pytest.raises(JobError):
        kafka_options("h", None)


def test_nested_evolution_keeps_the_description(spark, db, folder):
    spark.sql(f"CREATE DATABASE {db}")
    spark.sql(
        f"""CREATE TABLE {db}.told (id int COMMENT 'it\\'s a key', ts timestamp, st struct<a:int>) USING json
        OPTIONS (timestampFormat 'dd/MM/yyyy HH:mm') COMMENT 'told' LOCATION '{folder}/told' TBLPROPERTIES ('kept' = 'yes')"""
    )
    spark.sql(f"INSERT INTO {db}.told VALUES (1, timestamp'2024-03-02 10:20:00', named_struct('a', 1))")
    batch = spark.sql("SELECT 2 id, timestamp'2024-03-03 10:20:00' ts, named_struct('a', 2, 'b', 'x') st")
    write_evolving_table(batch, db, "told", "append")
    found = spark.table(f"{db}.told").selectExpr("id", "date_format(ts, 'd H:m') at", "st.b").orderBy("id").collect()
    assert [tuple(row) for row in found] == [(1, "2 10:20", None), (2, "3 10:20", "x")]
    assert spark.sql(f"SHOW TBLPROPERTIES {db}.told ('kept')").first()["value"] == "yes"
    assert spark.catalog.getTable(f"{db}.told").description == "told"
    assert spark.catalog.listColumns(f"{db}.told")[0].description == "it's a key"


def test_impossible_casts_are_refused_before_the_table_changes(spark, db):
    write_evolving_table(spark.sql("SELECT 1 id"), db, "dated")
    with pytest.raises(SchemaMismatch):
        write_evolving_table(spark.sql("SELECT date'2024-01-01' id, 'x' more"), db, "dated")
    assert spark.table(f"{db}.dated").columns == ["id"]


def test_two_writers_keep_other_partitions(spark, db):
    for name in ("one", "two"):
        write_evolving_table(spark.range(4).selectExpr("id", "id % 4 p"), db, name, partition_by=["p"])
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting, None)

    def overwrite(name):
        for p in range(2):
            batch = spark.range(1).selectExpr("id + 100 id", f"cast({p} as bigint) p")
            write_evolving_table(batch, db, name, mode="overwrite", partition_by=["p"])

    writers = [threading.Thread(target=overwrite, args=[name]) for name in ("one", "two")]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    for name in ("one", "two"):
        assert sorted(row["id"] for row in spark.table(f"{db}.{name}").collect()) == [2, 3, 100, 100]
    assert spark.conf.get(setting, None) == before
