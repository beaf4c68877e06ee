"""User functions, and JSON documents behind URLs."""

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from catalogue.registry import query, result, step
from tidewright.sources import fetch_records

# These functions run in tasks and travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@query("SELECT event_id, user_id, event_type, value FROM events")
def http_json_read(spark, sf_dir):
    """Each event as a document behind a URL that carries it."""
    events = result(spark, sf_dir, "events")
    address = F.expr("concat('data:application/json,', replace(url_encode(to_json(struct("
                     "event_id, user_id, event_type, value))), '+', '%20'))")
    return fetch_records(events, address, "event_id bigint, user_id bigint, event_type string, value double",
                         parallelism=spark.sparkContext.defaultParallelism)


@F.pandas_udf(DoubleType())
def halved(value: pd.Series) -> pd.Series:
    return value / 2


@query("SELECT event_id, value / 2 AS half FROM events WHERE value / 2 > 10")
def pandas_udf_step(spark, sf_dir):
    return result(
        spark, sf_dir, "events",
        step("filter", condition="tw_halved(value) > 10"),
        step("add_column", name="half", expression="tw_halved(value)"),
        step("select", columns=["event_id", "half"]),
        functions={"tw_halved": halved},
    )


@F.pandas_udf(DoubleType())
def spread(value: pd.Series) -> float:
    return float(value.max() - value.min())


@query("""
    WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT event_type, CAST(max(n) - min(n) AS DOUBLE) AS spread FROM d GROUP BY event_type
""")
def pandas_udaf_step(spark, sf_dir):
    # Python gathers a group whole, so it is given counts per day, not rows.
    return result(
        spark, sf_dir, "events",
        step("add_column", name="day", expression="cast(ts as date)"),
        step("aggregate", group_by=["event_type", "day"], aggs={"n": "count(*)"}),
        step("aggregate", group_by=["event_type"], aggs={"spread": "tw_spread(n)"}),
        functions={"tw_spread": spread},
    )


class Halves:
    def eval(self, whole: int):
        yield "low", whole // 2
        yield "high", whole - whole // 2


@query("""
    SELECT event_id, part, CASE part WHEN 'low' THEN user_id // 2 ELSE user_id - user_id // 2 END AS share
    FROM events, (VALUES ('low'), ('high')) p(part)
""")
def udtf_step(spark, sf_dir):
    return result(
        spark, sf_dir, "events",
        step("sql", query="SELECT event_id, part, share FROM events, LATERAL tw_halves(user_id)"),
        functions={"tw_halves": F.udtf(Halves, returnType="part string, share bigint")},
    )
