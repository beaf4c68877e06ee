"""What the plans look like, apart from what they return."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidewright import work
from tidewright.plans import job
from tidewright.operators import join, window

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    formatted = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(formatted)


@pytest.fixture
def conf(spark):
    changed = []

    def change(key, value):
        changed.append((key, spark.conf.get(key, None)))
        spark.conf.set(key, value)

    yield change
    for key, value in reversed(changed):
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["filter_select"](spark, SF_DIR))
    assert "GreaterThan(l_quantity,25.0)" in text and "EqualTo(l_returnflag,R)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in text


@pytest.mark.parametrize("name", ["join_inner", "join_full", "join_range", "join_theta", "setops", "subqueries",
                                  "window_global", "window_whole_group", "window_rank_split", "agg_distinct_filter"])
def test_no_products(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_global_aggregate_is_a_scalar(spark):
    text = plan(window(spark.range(100), "n", "count(*)"))
    assert "Window" not in text and "Subquery" in text


def test_skewed_join_partitions_are_split(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20000")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    left = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("a"))
    right = spark.range(0, 200_000, 1, 8).select(F.col("id").alias("k"), F.col("id").alias("b"))
    for how in ("inner", "left", "left_semi"):
        joined = join(left, right, "k", how)
        joined._jdf.queryExecution().toRdd().count()
        assert "(skew=true)" in joined._jdf.queryExecution().executedPlan().toString(), how
    for forced in (False, True):
        with work.settings(spark, job._WHILE_WRITING if forced else {}):
            counted = join(left, right, "k").groupBy("k").agg(F.max("a"), F.max("b"))
            counted._jdf.queryExecution().toRdd().count()
        assert ("(skew=true)" in counted._jdf.queryExecution().executedPlan().toString()) == forced


def test_hot_window_rows_spread_over_buckets(spark):
    frame = spark.range(0, 50_000, 1, 8).select(F.lit(1).alias("g"), F.col("id").alias("o"))
    numbered = window(frame, "n", "row_number()", ["g"], ["o"], hot_rows=5_000)
    sizes = [r["count"] for r in numbered.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 25_000 and sum(sizes) == 50_000


def test_staging(spark, folder):
    assert work.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    plain = work.stage(spark.sql("select 1 as a, named_struct('b', array(2)) as st"))
    assert plain.inputFiles() and plain.first().asDict(True) == {"a": 1, "st": {"b": [2]}}
    odd = work.stage(spark.sql("select 1 as a, null as v, make_interval(1) as i"))
    assert odd.select("a").first().a == 1 and "Scan ExistingRDD" in plan(odd).replace("RDDScan", "Scan ExistingRDD")
