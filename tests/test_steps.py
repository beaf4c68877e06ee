import pytest
from pyspark.sql import Row, functions as F

from tidewright import JobError
from tidewright.operators import (
    add_column, aggregate, drop_columns, filter_rows, join, partition_columns, rename, select, sql,
)


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(1, "a", 2.0), (2, "b", None), (3, None, 4.0)], "id int, s string, v double")


def values(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_filter(df):
    assert values(filter_rows(df, "id > 1 and v is null")) == [(2, "b", None)]
    assert values(filter_rows(df, F.col("id") == 3)) == [(3, None, 4.0)]
    assert values(filter_rows(df, lambda d: d.id < 2)) == [(1, "a", 2.0)]
    assert filter_rows(df).count() == filter_rows(df, True).count() == 3


def test_select_and_drop(spark, df):
    assert select(df, ["v", "id"]).columns == ["v", "id"]
    nested = spark.sql("select named_struct('a', named_struct('b', 7)) as st")
    assert select(nested, ["st.a.b"]).collect() == [Row(b=7)]
    assert drop_columns(df, ["s", "nope"]).columns == ["id", "v"]


def test_rename_is_simultaneous(df):
    assert rename(df, {"id": "s", "s": "id", "nope": "x"}).columns == ["s", "id", "v"]
    assert rename(df, {"id": "s", "s": "w"}).columns == ["s", "w", "v"]
    assert rename(df, {}) is df


def test_add_column(df):
    assert add_column(df, "w", "id * 2").columns == ["id", "s", "v", "w"]
    assert [r.id for r in add_column(df, "id", F.col("id") + 1).orderBy("id").collect()] == [2, 3, 4]
    assert add_column(df, "w").schema["w"].dataType.typeName() == "void"


def test_sql_leaves_no_views_behind(spark, df):
    df.limit(0).createOrReplaceTempView("mine")
    out = sql(spark, {"mine": df, "other_view": df}, "select a.id from mine a join other_view b on a.id = b.id")
    assert values(out) == [(1,), (2,), (3,)]
    assert spark.table("mine").count() == 0
    assert not spark.catalog.tableExists("other_view")
    spark.catalog.dropTempView("mine")


def test_sql_removes_views_after_an_error(spark, df):
    with pytest.raises(Exception):
        sql(spark, {"broken_view": df}, "select nope from broken_view")
    assert not spark.catalog.tableExists("broken_view")


def test_aggregate(df):
    out = aggregate(df, [], {"b": "count(v)", "a": "sum(id)"})
    assert out.columns == ["a", "b"] and out.collect() == [Row(a=6, b=2)]
    assert aggregate(df, ["s"], {"n": F.count("*")}).columns == ["s", "n"]
    with pytest.raises(JobError):
        aggregate(df, ["s"])


KINDS = ["inner", "cross", "left", "left_outer", "leftouter", "right", "right_outer", "full", "outer", "full_outer",
         "semi", "left_semi", "anti", "left_anti"]


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(0, 300, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 20).alias("k"),
        F.col("id").alias("a"))
    right = spark.range(0, 200, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 99).when(F.col("id") % 40 == 1, None).otherwise(F.col("id") % 31).alias("k"),
        F.col("id").alias("b"))
    return left, right


@pytest.mark.parametrize("how", KINDS)
@pytest.mark.parametrize("hot_rows", [None, 5, 50])
def test_join(sides, how, hot_rows):
    left, right = sides
    plain = left.join(right, "k", how)
    ours = join(left, right, "k", how, hot_rows)
    assert ours.columns == plain.columns
    assert values(ours) == values(plain)


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_join_two_keys_hot(spark, sides, how):
    left, right = (s.withColumn("j", F.col("k") % 2) for s in sides)
    assert values(join(left, right, ["k", "j"], how, 5)) == values(left.join(right, ["k", "j"], how))


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_join_with_many_null_keys_and_a_shared_column(sides, how):
    left, right = (s.withColumn("k", F.when(F.col("k") % 3 != 0, F.col("k"))).withColumn("x", F.lit(n))
                   for n, s in enumerate(sides))
    plain, ours = left.join(right, "k", how), join(left, right, "k", how, 20)
    assert ours.columns == plain.columns == ["k", "a", "x", "b", "x"]
    assert values(ours) == values(plain)


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_join_of_different_key_types(spark, how):
    nan = float("nan")
    left = spark.createDataFrame([(1, 1.5), (1, nan), (2, nan), (None, 2.0)] * 4, "k int, f double")
    right = spark.createDataFrame([(1, 1.5, "a"), (2**40, nan, "b"), (2, nan, "c")] * 4, "K bigint, f double, v string")
    plain, ours = left.join(right, ["k", "f"], how), join(left, right, ["k", "f"], how, 3)
    assert ours.columns == plain.columns
    assert values(ours.select(F.expr("cast(k as string)"), F.expr("cast(f as string)"), "v")) == values(
        plain.select(F.expr("cast(k as string)"), F.expr("cast(f as string)"), "v"))


@pytest.mark.parametrize("how", ["left", "full"])
def test_join_of_odd_names(spark, how):
    left = spark.range(30).selectExpr("if(id < 20, 1, id) as `a key`", "id as `v 1`")
    right = spark.range(30).selectExpr("if(id < 15, 1, id + 5) as `a key`", "id as `v 2`")
    plain, ours = left.join(right, "a key", how), join(left, right, "a key", how, 5)
    assert values(ours) == values(plain) and ours.columns == plain.columns


def test_join_refuses(sides):
    left, right = sides
    with pytest.raises(JobError):
        join(left, right, "k", "sideways")
    with pytest.raises(JobError):
        join(left, right, [])


def test_partition_columns(spark):
    df = spark.sql("select timestamp'2024-02-29 23:59:59' as event_time, 7 as month")
    assert partition_columns(df, ["day", "month", "year"]).drop("event_time").collect() == [
        Row(month=7, day=29, year=2024)]
    assert partition_columns(df, []) is df
    with pytest.raises(JobError):
        partition_columns(df, ["hour"])
    with pytest.raises(JobError):
        partition_columns(df, ["year"], "nope")


def test_partition_columns_from_text(spark):
    df = spark.createDataFrame([("2024-02-03 04:05:06",), ("zz",)], "t string")
    assert values(partition_columns(df, ["year"], "t")) == [("2024-02-03 04:05:06", 2024), ("zz", None)]


def test_ingestion_timestamp(spark):
    out = partition_columns(spark.range(1), ["year"], create_timestamp=True)
    assert out.columns == ["id", "ingestion_timestamp", "year"]
    assert partition_columns(spark.range(1), [], create_timestamp=True).columns == ["id"]
