"""Queries whose plain form would gather a large group in one task."""

import json
import os

from pyspark.sql import functions as F

from catalogue.registry import job, query, result, step
from catalogue.windows import _window
from tidewright import Job
from tidewright.functions import variants
from tidewright.operators import sketches
from tidewright.operators.asof import join_as_of
from tidewright.operators.overlaps import join_overlapping
from tidewright.work import new_folder

# Interpolated values may lie between two rounded ones, so they are moved off by a billionth first.
_SHARES = {"lowest": 0.0, "tenth": 0.1, "middle": 0.5, "high": 0.99}


@query("""
    SELECT l_returnflag, count(*) AS n,
           round(quantile_cont(l_extendedprice, 0.0) + 1e-9, 4) AS lowest, round(quantile_cont(l_extendedprice, 0.1) + 1e-9, 4) AS tenth,
           round(quantile_cont(l_extendedprice, 0.5) + 1e-9, 4) AS middle, round(quantile_cont(l_extendedprice, 0.99) + 1e-9, 4) AS high,
           round(quantile_cont(l_quantity, 0.5) + 1e-9, 4) AS quantity
    FROM lineitem GROUP BY l_returnflag
""")
def aggregate_percentiles_split(spark, sf_dir):
    """Exact percentiles of three return flags, each a hot group."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    prices = {name: f"percentile(l_extendedprice, {share})" for name, share in _SHARES.items()}
    return result(
        spark, sf_dir, "lineitem",
        step("aggregate", group_by=["l_returnflag"], hot_rows=rows // 20,
             aggs={**prices, "quantity": "median(l_quantity)", "n": "count(*)"}),
        *[step("add_column", name=name, expression=f"round({name} + 1e-9, 4)") for name in [*_SHARES, "quantity"]],
    )


_MERGED = """
    SELECT event_id,
           arg_max(value, event_id) FILTER (WHERE value > 50) OVER w AS latest_large,
           arg_min(value, hash_order) OVER w AS lowest,
           round(covar_samp(value, event_id) OVER w + 1e-9, 4) AS related,
           round(covar_pop(value, user_id) OVER w + 1e-9, 4) AS together,
           first_value(k IGNORE NULLS) OVER w AS first_large,
           last_value(k IGNORE NULLS) OVER w AS last_large,
           count(*) FILTER (WHERE value > 50) OVER w AS n_large,
           bit_xor(user_id) OVER w AS mixed
    FROM (SELECT *, (event_id * 7919) % 104729 AS hash_order, CASE WHEN value > 80 THEN event_id END AS k FROM events)
    WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)
"""


def _merged(spark, sf_dir, hot_rows):
    columns = {
        "latest_large": "max_by(value, event_id) FILTER (WHERE value > 50)",
        "lowest": "min_by(value, (event_id * 7919) % 104729)",
        "related": "covar_samp(value, event_id)",
        "together": "covar_pop(value, user_id)",
        "first_large": "first_value(case when value > 80 then event_id end) ignore nulls",
        "last_large": "last_value(case when value > 80 then event_id end) ignore nulls",
        "n_large": "count(*) FILTER (WHERE value > 50)",
        "mixed": "bit_xor(user_id)",
    }
    order = [{"column": "ts"}, {"column": "event_id"}]
    return result(
        spark, sf_dir, "events",
        *[_window(name, expression, ["event_type"], order, hot_rows) for name, expression in columns.items()],
        *[step("add_column", name=name, expression=f"round({name} + 1e-9, 4)") for name in ("related", "together")],
        step("select", columns=["event_id", *columns]),
    )


@query(_MERGED)
def window_merged_states(spark, sf_dir):
    return _merged(spark, sf_dir, None)


@query(_MERGED)
def window_merged_states_split(spark, sf_dir):
    return _merged(spark, sf_dir, spark.read.parquet(f"{sf_dir}/events.parquet").count() // 10)


# A third of the users is one key, most rows of which several tasks share.
_ORACLE_HOT = "WITH e AS (SELECT *, CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS who FROM events)"


@query(_ORACLE_HOT + """
    , clicks AS (SELECT who, ts AS click_ts, max(event_id) AS click_id FROM e WHERE event_type = 'click' GROUP BY who, ts)
    SELECT p.event_id, c.click_ts, c.click_id
    FROM (SELECT * FROM e WHERE event_type = 'purchase') p ASOF LEFT JOIN clicks c ON p.who = c.who AND p.ts >= c.click_ts
""")
def join_as_of_tables(spark, sf_dir):
    """For each purchase the latest click at or before it, under a key that a third of all rows have."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("who", F.expr("if(user_id % 3 = 0, 0L, user_id)"))
    clicks = events.where("event_type = 'click'").selectExpr("who", "ts as click_ts", "event_id as click_id")
    purchases = events.where("event_type = 'purchase'").select("event_id", "who", "ts")
    found = join_as_of(purchases, clicks, "who", "ts", "click_ts", tie_by=["click_id"])
    return found.select("event_id", "click_ts", "click_id")


@query("""
    WITH open AS (SELECT o_orderkey AS a, o_custkey, CAST(o_orderdate AS DATE) AS a_from,
                         CAST(CAST(o_orderdate AS DATE) + CAST(CASE WHEN o_orderkey % 100 = 0 THEN 7000 ELSE o_orderkey % 30 END AS INTEGER) AS DATE) AS a_to
                  FROM orders),
         lines AS (SELECT l_orderkey AS b, l_linenumber, o_custkey, CAST(l_shipdate AS DATE) AS b_from,
                          CAST(CAST(l_shipdate AS DATE) + 1 AS DATE) AS b_to
                   FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT a, b, l_linenumber FROM open JOIN lines ON open.o_custkey = lines.o_custkey AND a_from <= b_to AND b_from <= a_to
""")
def join_overlapping_spans(spark, sf_dir):
    """Orders still open, for days or for two decades, while a line of the same customer is under way."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    days = "cast(if(o_orderkey % 100 = 0, 7000, o_orderkey % 30) as int)"
    open_ = orders.selectExpr("o_orderkey as a", "o_custkey", "cast(o_orderdate as date) as a_from",
                              f"date_add(cast(o_orderdate as date), {days}) as a_to")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").join(orders, F.expr("l_orderkey = o_orderkey"))
    lines = lines.selectExpr("l_orderkey as b", "l_linenumber", "o_custkey", "cast(l_shipdate as date) as b_from",
                             "date_add(cast(l_shipdate as date), 1) as b_to")
    found = join_overlapping(open_, lines, ("a_from", "a_to"), ("b_from", "b_to"), "o_custkey")
    return found.select("a", "b", "l_linenumber")


@query("SELECT event_type, count(*) AS n, true AS users_within, true AS median_within FROM events GROUP BY event_type")
def sketches_of_two_runs(spark, sf_dir):
    """Two bookmarked runs keep sketches of what is new; merged, they are held against the exact answers."""
    landing, kept = new_folder(spark, "landing"), new_folder(spark, "sketches")
    measures = {"users": ("distinct", "user_id"), "middle": ("quantiles", "value")}

    def summed(spark, frames):
        return sketches.sketch(frames["events"], ["event_type"], measures)

    config = {
        "sources": [{"name": "events", "source_type": "file", "path": landing}],
        "transforms": [step("custom", function=summed)],
        "sink": {"sink_type": "file", "path": kept, "mode": "append"},
        "bookmark": "enabled", "state_path": new_folder(spark, "bookmark"),
    }
    for part in (0, 1):
        job(sf_dir, "events", step("filter", condition=f"event_id % 2 = {part}"),
            sink={"sink_type": "file", "path": landing, "mode": "append"}).run(spark)
        Job.from_dict(config).run(spark)
    merged = sketches.merge(spark.read.parquet(kept), ["event_type"], measures)
    read = sketches.estimate(merged, ["event_type"], measures, [0.5])
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    guessed = read.select("event_type", "users", F.get("middle", F.lit(0)).alias("middle"))
    # What share of the values is up to the one given for the median.
    checked = events.join(F.broadcast(guessed), "event_type").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("exact"), F.first("users").alias("users"),
        F.count_if(F.expr("value < middle")).alias("below"), F.count_if(F.expr("value <= middle")).alias("upto"),
    )
    slack = sketches.RANK_ERROR
    return checked.select(
        "event_type", "n",
        F.expr(f"abs(users / exact - 1) <= {sketches.DISTINCT_ERROR}").alias("users_within"),
        F.expr(f"below / n <= 0.5 + {slack} and upto / n >= 0.5 - {slack}").alias("median_within"),
    )


@query("""
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
           CASE WHEN event_id % 2 = 1 THEN event_type END AS kind, CASE WHEN event_id % 2 = 1 THEN user_id END AS who
    FROM events
""")
def json_variant_evolving(spark, sf_dir):
    """JSON of two batches; the second has parts that the table learns of then."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    database = "variants_" + os.path.basename(new_folder(spark, "db")).replace("-", "_")
    spark.sql(f"CREATE DATABASE {database}")
    batches = [
        events.where("event_id % 2 = 0").select("event_id", "props"),
        events.where("event_id % 2 = 1").selectExpr(
            "event_id", "to_json(named_struct('by', named_struct('kind', event_type, 'who', user_id), 'k', from_json(props, 'k int').k)) as props"
        ),
    ]
    for at, batch in enumerate(batches):
        known = spark.table(f"{database}.events").schema["props"].dataType if at else None
        Job.from_dict({
            "sources": [{"name": "batch", "source_type": "frame", "frame": variants.typed(batch, "props", known)}],
            "sink": {"sink_type": "table", "database": database, "table": "events", "mode": "append"},
        }).run(spark)
    return spark.table(f"{database}.events").selectExpr("event_id", "props.k as k", "props.by.kind as kind", "props.by.who as who")


@query("SELECT event_id, user_id, event_type, value FROM events")
def http_api_pages(spark, sf_dir):
    """Events as an API gives them: eight lists of pages, each page with the address of the next."""
    folder = new_folder(spark, "api").removeprefix("file:")
    folder = "/" + folder.lstrip("/")
    lists, pages = 8, 3
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", "value")
    numbered = events.withColumn("list", F.pmod("event_id", F.lit(lists))).withColumn("page", F.expr(f"pmod(event_id div {lists}, {pages})"))

    def written(rows):
        for (number, page), group in rows.groupby(["list", "page"]):
            after = f"file://{folder}/{number}-{page + 1}.json" if page + 1 < pages else None
            os.makedirs(folder, exist_ok=True)
            with open(f"{folder}/{number}-{page}.json", "w") as file:
                json.dump({"items": group.drop(columns=["list", "page"]).to_dict("records"), "next": after}, file)
        return rows[["list"]][:0]

    numbered.groupBy("list").applyInPandas(written, "list long").count()
    source = {"name": "events", "source_type": "api", "url": [f"file://{folder}/{number}-0.json" for number in range(lists)],
              "schema": "event_id bigint, user_id bigint, event_type string, value double",
              "options": {"next": "$.next", "records": "$.items"}}
    return Job.from_dict({"sources": [source]}).result(spark)
